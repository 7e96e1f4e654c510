"""Cross-tokenizer alignment: tokens of two vocabularies linked by their bytes,
and the corpus-wide count of every linked pair of ids by minimal perfect hashing."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, encoded, word_table
from .common import by_bytes, saved

#: Pairs in a bucket of the hash, on average: one dense vector of counts each.
BUCKET_PAIRS = 8192
#: Pairs whose hash, keys and counts are sent to the tasks at a time; more pairs take more rounds.
ROUND_PAIRS = 4 << 20
#: Count vectors that are summed in one task.
FAN_IN = 64
#: Words that a worker keeps encoded beside the sentencepiece model.
KEPT_WORDS = 400_000
_GOLDEN = 0x9E3779B97F4A7C15


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A well-mixed 64-bit number of each key; never equal for different keys of one seed."""
    x = keys.astype(np.uint64) + np.uint64(_GOLDEN * (seed + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------- tokens


class Pieces:
    """Ids and bytes of a sentencepiece model."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@functools.cache
def pieces(path: str) -> Pieces:
    """One model a worker process."""
    return Pieces(path)


def tokens(rows: Iterator[tuple[object, str | None]], path_a: str, path_b: str,
           chunk: int = 1_000_000) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
    """(key, A ids, B ids) of every text; without ids where the joined bytes of
    either side are not a blank and the text."""
    bytes_a, b = word_table(path_a, keep_special=False).vocab.token_bytes, pieces(path_b)
    texts: dict[int, tuple[object, str]] = {}

    def numbered():
        for i, (key, text) in enumerate(rows):
            texts[i] = (key, text or "")
            yield i, f" {text}" if text else ""

    def both(ready):
        listed = [texts.pop(i) for i, _ in ready]
        for (key, text), (_, ids_a), ids_b in zip(listed, ready, b.encode([t for _, t in listed]), strict=True):
            whole = b" " + text.encode()
            if not text or b"".join([b.bytes[i] for i in ids_b]) != whole or b"".join([bytes_a[i] for i in ids_a.tolist()]) != whole:
                ids_a, ids_b = ids_a[:0], []
            yield key, ids_a, np.array(ids_b, np.int32)

    ready, size = [], 0
    for i, ids_a in encoded(numbered(), path_a, keep_special=False, chunk=chunk, most=2_000_000, kept=KEPT_WORDS):
        ready.append((i, ids_a))
        size += len(texts[i][1])
        if size >= chunk:
            yield from both(ready)
            ready, size = [], 0
    yield from both(ready)


@dataclass
class Widths:
    """Bytes of every token of both vocabularies."""

    a: np.ndarray
    b: np.ndarray

    @classmethod
    def load(cls, path_a: str, path_b: str) -> Widths:
        return cls(np.array([len(t) for t in Vocabulary.load(path_a).token_bytes], np.int64),
                   np.array([len(t) for t in Pieces(path_b).bytes], np.int64))

    @property
    def kind(self) -> str:
        """How ids are packed."""
        return "<u2" if max(len(self.a), len(self.b)) <= 1 << 16 else "<u4"


# ---------------------------------------------------------------- links


@dataclass
class Links:
    """The links of some documents one after another: between two neighbouring
    token ends of either side lie the bytes of exactly one linked pair."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    at_a: np.ndarray  # of each link
    at_b: np.ndarray
    both_end: np.ndarray
    per_doc: np.ndarray

    @property
    def keys(self) -> np.ndarray:
        return (self.ids_a[self.at_a] << 32) | self.ids_b[self.at_b]


def links(ids_a: np.ndarray, ids_b: np.ndarray, docs_a: np.ndarray, width: Widths) -> Links:
    """``docs_a``: the count of A ids of each document; both sides have the same bytes."""
    ends_a, ends_b = np.cumsum(width.a[ids_a]), np.cumsum(width.b[ids_b])
    total = int(ends_a[-1]) if len(ends_a) else 0
    is_a, is_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
    is_a[ends_a], is_b[ends_b] = True, True
    ends = np.flatnonzero(is_a | is_b)
    a, b = is_a[ends], is_b[ends]
    stops = np.append(0, ends_a)[np.cumsum(docs_a)]
    per_doc = np.diff(np.append(0, np.searchsorted(ends, stops, "right")))
    return Links(ids_a, ids_b, np.cumsum(a) - a, np.cumsum(b) - b, a & b, per_doc)


@functools.cache
def _digits(size: int) -> np.ndarray:
    """The decimal digits of each number below ``size``, zero bytes before them, and one free column."""
    n = len(str(size))
    text = np.array([f"{i:>{n}}" for i in range(size)], f"S{n}").view(np.uint8).reshape(size, n)
    return np.concatenate([np.where(text == 0x20, 0, text), np.zeros((size, 1), np.uint8)], axis=1).astype(np.uint8)


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray, own: Links) -> list[bytes]:
    """Each document's groups as `a1,a2|b1;a3|b2,b3`."""
    if not len(ids_a):
        return [b""] * len(docs_a)
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[own.at_a[own.both_end]], last_b[own.at_b[own.both_end]] = True, True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    upto_a, upto_b = np.cumsum(np.bincount(group_a)), np.append(0, np.cumsum(np.bincount(group_b)))
    place_a = np.arange(len(ids_a)) + upto_b[group_a]
    place_b = np.arange(len(ids_b)) + upto_a[group_b]
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[place_a], code[place_b] = ids_a, ids_b
    flat = _digits(1 << int(code.max()).bit_length())[code]
    flat[place_a, -1] = np.where(last_a, ord("|"), ord(","))
    flat[place_b, -1] = np.where(last_b, ord(";"), ord(","))
    ends = np.cumsum(np.count_nonzero(flat, axis=1))
    raw, out, at = flat[flat != 0].tobytes(), [], 0
    stops = np.append(0, ends)[np.cumsum(docs_a + docs_b)].tolist()
    for stop in stops:
        out.append(raw[at:stop - 1] if stop > at else b"")
        at = stop
    return out


# ---------------------------------------------------------------- the hash


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """A minimal perfect hash of distinct keys: (keys in hash order, levels).

    Level by level the keys are thrown into twice as many slots; a slot with
    one key is taken, the others' keys go on.  A key's number is the rank of
    its slot among the taken ones of all levels.
    """
    ordered, levels = [], []
    while len(keys):
        slot = (mixed(keys, len(levels) + 1) % np.uint64(2 * len(keys))).astype(np.int64)
        alone = np.bincount(slot, minlength=2 * len(keys)) == 1
        taken = alone[slot]
        levels.append(alone)
        ordered.append(keys[taken][np.argsort(slot[taken])])
        keys = keys[~taken]
    return np.concatenate(ordered) if ordered else keys, levels


class PairHash:
    """The hashes of some buckets, and the key that each number belongs to."""

    def __init__(self, rows: list[tuple[int, bytes, bytes, list[int]]], buckets: int):
        """rows: (bucket, keys in hash order, slots as packed bits, slots of each level)."""
        self.buckets = buckets
        self.first = np.full(buckets, -1, np.int64)  # number of a bucket's first key
        depth = max([0, *(len(sizes) for *_, sizes in rows)])
        self.base, self.slots = np.zeros((depth, buckets), np.int64), np.zeros((depth, buckets), np.int64)
        at, place, keys, bits = 0, 0, [], []
        for bucket, own, packed, sizes in rows:
            self.first[bucket] = at
            keys.append(np.frombuffer(own, "<i8"))
            at += len(keys[-1])
            bits.append(np.unpackbits(np.frombuffer(packed, np.uint8))[:sum(sizes)])
            for level, n in enumerate(sizes):
                self.base[level, bucket], self.slots[level, bucket] = place, n
                place += n
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        taken = np.concatenate(bits) if bits else np.empty(0, np.uint8)
        self.number = np.where(taken, np.cumsum(taken) - 1, -1).astype(np.int32)

    @classmethod
    def collected(cls, hashes: DataFrame, buckets: int) -> PairHash:
        rows = hashes.orderBy("bucket").collect()
        return cls([(r["bucket"], bytes(r["keys"]), bytes(r["slots"]), r["sizes"]) for r in rows], buckets)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it has none here: the key found there is compared."""
        out = np.full(len(keys), -1, np.int64)
        bucket = (mixed(keys, 0) % np.uint64(self.buckets)).astype(np.int64)
        open_ = np.flatnonzero(self.first[bucket] >= 0)
        for level in range(len(self.base)):
            if not len(open_):
                break
            own = bucket[open_]
            slots = self.slots[level, own]
            there = slots > 0
            open_, own, slots = open_[there], own[there], slots[there]
            slot = (mixed(keys[open_], level + 1) % slots.astype(np.uint64)).astype(np.int64)
            number = self.number[self.base[level, own] + slot]
            hit = number >= 0
            out[open_[hit]] = number[hit]
            open_ = open_[~hit]
        known = out >= 0
        out[known] = np.where(self.keys[out[known]] == keys[known], out[known], -1)
        return out


# ---------------------------------------------------------------- the job


def _lists(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after another, and how many each row has, of a column of packed ids."""
    rows = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return (np.concatenate(rows) if rows else np.empty(0, kind)).astype(np.int64), np.array([len(x) for x in rows], np.int64)


def _linked(batches: Iterator[pa.RecordBatch], width: Widths):
    for batch in by_bytes(batches, column="a", limit=1 << 20):
        (a, docs_a), (b, docs_b) = _lists(batch.column("a"), width.kind), _lists(batch.column("b"), width.kind)
        yield batch, a, b, docs_a, docs_b, links(a, b, docs_a, width)


def _tokenised(docs: DataFrame, path_a: str, path_b: str, width) -> DataFrame:
    """row, doc_id and the packed ids of both sides, written as a table."""
    doc_id = docs.schema["doc_id"]

    def run(batches):
        def listed():
            for batch in by_bytes(batches):
                yield from zip(zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), strict=True),
                               batch.column("text").to_pylist(), strict=True)

        out, size, pack = [], 0, width.value.kind
        for (row, key), a, b in tokens(listed(), path_a, path_b):
            out.append((row, key, a.astype(pack).tobytes(), b.astype(pack).tobytes()))
            size += len(a)
            if size > 1 << 20:
                yield packed(out)
                out, size = [], 0
        if out:
            yield packed(out)

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)],
                                          schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType
    kind = StructType([StructField("row", LongType()), doc_id, StructField("a", BinaryType()), StructField("b", BinaryType())])
    target = to_arrow_schema(kind)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return saved(rows.mapInArrow(run, kind))


def _distinct_pairs(table: DataFrame, width) -> DataFrame:
    """The distinct pair keys (A id * 2^32 + B id), written as a table."""

    def run(batches):
        held = np.empty(0, np.int64)
        for *_, own in _linked(batches, width.value):
            held = np.union1d(held, own.keys)
            if len(held) > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(held)], ["key"])
                held = held[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held)], ["key"])

    return saved(table.select("a", "b").mapInArrow(run, "key long").distinct())


def _hashed_pairs(keys: DataFrame, buckets: int) -> DataFrame:
    """One row a bucket: its keys in hash order, slots and level sizes, written as a table."""

    def deal(batches):
        for batch in batches:
            own = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array((mixed(own, 0) % np.uint64(buckets)).astype(np.int32)), batch.column("key")],
                                             ["bucket", "key"])

    def build(table: pa.Table) -> pa.Table:
        ordered, levels = build_hash(table.column("key").to_numpy())
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
                         "keys": pa.array([ordered.astype("<i8").tobytes()], pa.binary()),
                         "slots": pa.array([np.packbits(np.concatenate(levels)).tobytes()], pa.binary()),
                         "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int32()))})

    dealt = keys.mapInArrow(deal, "bucket int, key long")
    return saved(dealt.groupBy("bucket").applyInArrow(build, "bucket int, keys binary, slots binary, sizes array<int>"))


def _counts(table: DataFrame, width, shared) -> DataFrame:
    """(bucket, counts): how often each pair of the round is linked, in dense
    vectors by hash number, summed over the tasks as a tree."""

    def run(batches):
        pairs = shared.value
        dense = np.zeros(len(pairs.keys), np.int64)
        for *_, own in _linked(batches, width.value):
            at = pairs.find(own.keys)
            dense += np.bincount(at[at >= 0], minlength=len(dense))
        part = TaskContext.get().partitionId()
        own = np.flatnonzero(pairs.first >= 0)
        own = own[np.argsort(pairs.first[own])]
        vectors = np.split(dense, pairs.first[own][1:]) if len(own) else []
        rows = [(b, v.astype("<i8").tobytes()) for b, v in zip(own.tolist(), vectors, strict=True) if v.any()]
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows[i:i + 64]], pa.int32()),
                                              pa.array([part] * len(rows[i:i + 64]), pa.int32()),
                                              pa.array([v for _, v in rows[i:i + 64]], pa.binary())], ["bucket", "part", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<i8") for x in rows.column("counts").to_pylist())
        return pa.table({"bucket": rows.column("bucket")[:1], "part": pa.array([rows.column("part")[0].as_py()], pa.int32()),
                         "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    sums = saved(table.select("a", "b").mapInArrow(run, "bucket int, part int, counts binary"))
    parts = (sums.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        parts = math.ceil(parts / FAN_IN)
        sums = saved(sums.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("bucket", "part").applyInArrow(
            add, "bucket int, part int, counts binary"))
    return sums.select("bucket", "counts")


def _vector(counts: DataFrame, pairs: PairHash) -> np.ndarray:
    """The counts of a round in hash order; at most about ROUND_PAIRS numbers."""
    out = np.zeros(len(pairs.keys), np.int64)
    for row in counts.collect():
        own = np.frombuffer(row["counts"], "<i8")
        first = pairs.first[row["bucket"]]
        out[first:first + len(own)] = own
    return out


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _looked_up(table: DataFrame, width, shared, whole: bool) -> DataFrame:
    """The rows of the result as far as the round's pairs go; what does not
    depend on counts only if ``whole``."""

    def sums(values: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(values))[np.append(0, np.cumsum(per_doc))])

    def run(batches):
        pairs, counts, best = shared.value
        for batch, a, b, docs_a, docs_b, own in _linked(batches, width.value):
            keys = own.keys
            at = pairs.find(keys)
            known = at >= 0
            count = np.where(known, counts[at] if len(counts) else 0, 0)
            top = known & (count == best[keys & 0xFFFFFFFF])
            numbers = [docs_a, docs_b, sums(own.both_end, own.per_doc), own.per_doc] if whole else [0 * docs_a] * 4
            shas = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(a, b, docs_a, docs_b, own)
                    ] if whole else [""] * len(docs_a)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (
                    *numbers, sums(top, own.per_doc), sums(count, own.per_doc))), pa.array(shas, pa.string())],
                ["row", "doc_id", *NUMBERS, "groups_sha256"])

    from pyspark.sql.types import LongType, StringType, StructField, StructType
    kind = StructType([table.schema["row"], table.schema["doc_id"], *(StructField(n, LongType()) for n in NUMBERS),
                       StructField("groups_sha256", StringType())])
    return table.select("row", "doc_id", "a", "b").mapInArrow(run, kind)


def align_documents(docs: DataFrame, path_a: str, path_b: str, round_pairs: int = ROUND_PAIRS,
                    bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256.

    ``path_a`` is a byte-level BPE of the tokenizers library, which gets a
    blank and the text, ``path_b`` a sentencepiece model, which adds the blank
    itself.  The ids of both are written once.  A first pass over them links
    tokens whose bytes overlap and gathers the distinct pairs of ids; these
    get a minimal perfect hash, bucket by bucket.  A second alignment counts
    links in dense vectors by hash number, summed as a tree; the last one
    looks the counts up, comparing the key found at each number.

    Tasks hold the hash, keys and counts of about ``round_pairs`` pairs at a
    time; more pairs take more rounds, whose sums per row are added.

    Null and empty texts, and texts whose joined token bytes differ from a
    blank and the text, have no tokens: zeros and an empty groups_sha256.
    Rows under one doc_id are rows of their own.  An empty table gives an
    empty result; other columns are not read.
    """
    sc = docs.sparkSession.sparkContext
    width = sc.broadcast(Widths.load(path_a, path_b))
    table = _tokenised(docs, path_a, path_b, width)
    keys = _distinct_pairs(table, width)
    total = keys.count()
    buckets = max(1, math.ceil(total / bucket_pairs))
    hashes = _hashed_pairs(keys, buckets)
    # a dense vector is as long as the round: no more of them than the data are worth, but enough for all cores
    stored = table.agg(F.sum(F.octet_length("a") + F.octet_length("b"))).first()[0] or 0
    tasks = max(2 * sc.defaultParallelism, math.ceil(stored / (64 * min(total, round_pairs) + 1)))
    best = np.zeros(len(width.value.b), np.int64)
    rounds, step = [], max(1, round_pairs // bucket_pairs)
    for first in range(0, buckets, step):
        own = hashes.where(F.col("bucket").between(first, first + step - 1))
        pairs = PairHash.collected(own, buckets)
        counts = _counts(table.coalesce(tasks), width, sc.broadcast(pairs))
        np.maximum.at(best, pairs.keys & 0xFFFFFFFF, _vector(counts, pairs))
        rounds.append((own, counts))
    out = None
    for number, (own, counts) in enumerate(rounds):
        pairs = PairHash.collected(own, buckets)
        rows = _looked_up(table, width, sc.broadcast((pairs, _vector(counts, pairs), best)), number == 0)
        out = rows if out is None else out.unionByName(rows)
    if len(rounds) > 1:
        out = out.groupBy("row", "doc_id").agg(*[F.sum(n).cast("long").alias(n) for n in NUMBERS],
                                               F.max("groups_sha256").alias("groups_sha256"))
    return out.drop("row")
