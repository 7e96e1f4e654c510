"""Repeated passages by suffix arrays of sharded contexts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import attach, bit_filter, by_bytes, marked, maybe_in, saved
from .jaccard import mix

#: Bytes of the grams that anchor windows; bytes handled at once in a worker, few enough for a core's cache.
GRAM, SLICE = 16, 1 << 16
#: A byte that no UTF-8 text has; it ends each context of a shard.
BREAK = 0xFF
FILTER_BITS = 1 << 26
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def anchored_runs(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first, last, key) of runs of window starts that share an anchor.

    A window of ``length`` bytes is anchored at its gram of smallest hash, the
    leftmost of equals: equal windows have equal anchors at equal places.
    Each start is in exactly one run.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    if total < length:
        return (np.empty(0, np.int64),) * 4
    raw = b"".join([*pieces, bytes(GRAM)])
    word = np.ndarray((total + 8,), "<u8", raw, strides=(1,))
    hashes = mix(word[:total] * _A + (word[8:] ^ _B) * _B)
    low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(total, dtype=np.uint64)
    span, width = length - GRAM + 1, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    open_at = np.zeros(total + 1, np.int32)
    open_at += np.bincount(ends - np.minimum(sizes, length - 1), minlength=total + 1).astype(np.int32)
    open_at -= np.bincount(ends, minlength=total + 1).astype(np.int32)
    starts = np.flatnonzero(np.cumsum(open_at[:-1]) == 0)
    if not len(starts):
        return (np.empty(0, np.int64),) * 4
    anchor = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1))
    head = np.flatnonzero(new)
    first, last = starts[head], starts[np.append(head[1:], len(starts)) - 1]
    piece = np.searchsorted(ends, first, "right")
    base = (ends - sizes)[piece]
    return piece, first - base, last - base, hashes[anchor[head]].view(np.int64)


def text_slices(rows: Iterator[tuple], length: int) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """Texts in slices of at most SLICE window starts, gathered to about SLICE
    bytes: ((row, base), ...) and the slices' bytes."""
    heads, pieces, size = [], [], 0
    for row, raw in rows:
        for base in range(0, max(1, len(raw) - length + 1), SLICE):
            piece = raw[base:base + SLICE + length - 1]
            heads.append((row, base))
            pieces.append(piece)
            size += len(piece)
            if size >= SLICE:
                yield heads, pieces
                heads, pieces, size = [], [], 0
    if pieces:
        yield heads, pieces


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of contexts that each end in BREAK (each break unlike any
    other) by Larsson-Sadakane refinement: groups of suffixes equal in the
    first h bytes are sorted by the groups h bytes on, h doubling; groups of
    one are settled and not touched again."""
    n = len(text)
    raw = np.append(text, np.zeros(8, np.uint8))
    word, ended = np.zeros(n, np.uint64), np.zeros(n, bool)
    for k in range(8):
        byte = raw[k:k + n].astype(np.uint64)
        word |= np.where(ended, np.uint64(0), byte) << np.uint64(56 - 8 * k)
        ended |= byte == BREAK
    order = np.argsort(word, kind="stable")
    sorted_word, sorted_end = word[order], ended[order]
    head = np.append(True, (sorted_word[1:] != sorted_word[:-1]) | sorted_end[1:])
    start_of = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    group = np.empty(n, np.int64)
    group[order] = start_of
    single = head & np.append(head[1:], True)
    left = np.flatnonzero(~single)
    h = 8
    while len(left):
        at = order[left]
        key = group[at] * np.int64(n + 1) + group[np.minimum(at + h, n - 1)]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[left] = at
        new = np.append(True, key[1:] != key[:-1])
        group_start = left[np.maximum.accumulate(np.where(new, np.arange(len(left)), 0))]
        group[at] = group_start
        alone = new & np.append(new[1:], True)
        left = left[~alone]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kasai's common prefixes in text order, and each suffix's predecessor:
    one byte on, a prefix is at most one shorter.  All contexts go in step.
    Prefixes end at the break."""
    n = len(text)
    raw = np.append(text, np.zeros(8, np.uint8)).tobytes()
    word = np.ndarray((n + 1,), "<u8", raw, strides=(1,))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    first = np.cumsum(sizes) - sizes
    rest = np.repeat(first + sizes - 1, sizes) - np.arange(n)
    prefix = np.zeros(n, np.int64)
    run = np.zeros(len(sizes), np.int64)
    for step in range(int(sizes.max()) - 1):
        here = np.flatnonzero(sizes - 1 > step)
        i = first[here] + step
        j = before[i]
        size = np.maximum(run[here] - 1, 0)
        size[j < 0] = 0
        most = np.where(j < 0, 0, np.minimum(rest[i], rest[np.maximum(j, 0)]))
        size = np.minimum(size, most)
        go = np.flatnonzero(size + 8 <= most)
        while len(go):
            same = word[i[go] + size[go]] == word[j[go] + size[go]]
            go = go[same]
            size[go] += 8
            go = go[size[go] + 8 <= most[go]]
        go = np.flatnonzero(size < most)
        while len(go):
            go = go[text[i[go] + size[go]] == text[j[go] + size[go]]]
            size[go] += 1
            go = go[size[go] < most[go]]
        prefix[i] = size
        run[here] = size
    return prefix, before


def may_repeat(contexts: list[bytes], length: int) -> np.ndarray:
    """Whether a context has a window whose fingerprint, a polynomial modulo
    2^64, occurs again in these contexts; equal windows have equal ones."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    base = 0x9E3779B97F4A7C15
    steps = np.full((2, len(text) + 1), np.array([[base], [pow(base, -1, 1 << 64)]], np.uint64))
    steps[:, 0] = 1
    powers, unpowers = np.cumprod(steps, axis=1, dtype=np.uint64)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(mix(text.astype(np.uint64) + _A) * powers[:-1], out=sums[1:])
    per = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), per)
    start = np.arange(len(owner)) + (np.cumsum(sizes) - sizes - (np.cumsum(per) - per))[owner]
    prints = (sums[start + length] - sums[start]) * unpowers[start]
    ordered = np.sort(prints)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.zeros(len(sizes), bool)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, prints), len(twice) - 1)
        out[owner[twice[at] == prints]] = True
    return out


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """Of each context, the starts whose ``length`` bytes also start elsewhere
    in these contexts.  Contexts without a repeated fingerprint stay out of
    the suffix array."""
    may = may_repeat(contexts, length)
    found = iter(array_starts([c for c, m in zip(contexts, may.tolist(), strict=True) if m], length) if may.any() else ())
    return [next(found) if m else np.empty(0, np.int64) for m in may.tolist()]


def array_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """The same by suffix array and common prefixes of all of them."""
    sizes = np.array([len(c) + 1 for c in contexts], np.int64)
    text = np.frombuffer(b"".join(c + b"\xff" for c in contexts), np.uint8)
    order = suffix_array(text)
    prefix, before = common_prefixes(text, order, sizes)
    again = np.zeros(len(text), bool)
    hit = np.flatnonzero(prefix >= length)
    again[hit] = True
    again[before[hit]] = True
    return [np.flatnonzero(x) for x in np.split(again, np.cumsum(sizes)[:-1])]


def sorted_windows(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all contexts in suffix-array order, with context and start."""
    sizes = np.array([len(c) + 1 for c in contexts], np.int64)
    text = np.frombuffer(b"".join(c + b"\xff" for c in contexts), np.uint8)
    order = suffix_array(text)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(text)) - (np.cumsum(sizes) - sizes)[owner]
    full = order[start[order] + length < sizes[owner[order]]]
    windows = np.lib.stride_tricks.sliding_window_view(text, length)[full]
    marked_end = np.concatenate([windows, np.ones((len(full), 1), np.uint8)], axis=1)  # keeps closing zero bytes
    return np.ascontiguousarray(marked_end).view(f"S{length + 1}").ravel(), owner[full], start[full]


def shared_starts(one: list[bytes], two: list[bytes], length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Starts of windows that two shards share, by binary search of the one's
    sorted windows in the other's."""
    a, a_owner, a_start = sorted_windows(one, length)
    b, b_owner, b_start = sorted_windows(two, length)

    def found(x, y):
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        return y[at] == x if len(y) else np.zeros(len(x), bool)

    in_b, in_a = found(a, b), found(b, a)
    return ([np.sort(a_start[in_b & (a_owner == k)]) for k in range(len(one))],
            [np.sort(b_start[in_a & (b_owner == k)]) for k in range(len(two))])


def ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers, as (first, last)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist(), strict=True))


def repeated_spans(docs: DataFrame, length: int = 200, shard_contexts: int = 8000) -> DataFrame:
    """(doc_id, row_key, spans) of the rows of ``docs`` with bytes covered by a
    string of ``length`` UTF-8 bytes that also starts anywhere else; spans are
    maximal, (start, end) in order.  row_key hashes doc_id and text.

    Every window belongs to its anchor, the gram of smallest hash in it.  Only
    runs of windows whose anchor occurs again (a bit filter lets few others
    through) send their context, the bytes that their windows cover; equal
    windows thus meet under one anchor.  Contexts are dealt to shards by
    anchor, each with a suffix array; an anchor with more contexts than a
    shard takes gets several, merged pairwise by binary search.  Contexts that
    occur more than once repeat as a whole, and are sent once.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "row_key", F.xxhash64("doc_id", "text"))

    def slices(batches):
        rows = (((i, k), t.encode("utf-8", "surrogatepass")) for b in by_bytes(batches)
                for i, k, t in zip(b.column("doc_id").to_pylist(), b.column("row_key").to_pylist(),
                                   b.column("text").to_pylist(), strict=True))
        return text_slices(rows, length)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pieces in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(anchored_runs(pieces, length)[3])], ["key"])

    repeated = base.mapInArrow(keys, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    place = F.pmod(F.col("key"), F.lit(FILTER_BITS))
    bitmap = repeated.select(F.floor(place / 32768).cast("int").alias("bucket"), (place % 32768).alias("bit")).groupBy(
        "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # at most 2 048 rows of 4 KB
    bits = bytearray(FILTER_BITS // 8)
    for row in bitmap:
        bits[row["bucket"] * 4096:row["bucket"] * 4096 + len(row["bits"])] = row["bits"]
    shared = spark.sparkContext.broadcast(bytes(bits))

    id_type = docs.schema["doc_id"].dataType.simpleString()

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint8)
        for heads, pieces in slices(batches):
            piece, first, last, key = anchored_runs(pieces, length)
            place = key & np.int64(FILTER_BITS - 1)
            on = np.flatnonzero((table[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
            out = []
            for p, a, z, k in zip(piece[on].tolist(), first[on].tolist(), last[on].tolist(), key[on].tolist(), strict=True):
                (doc_id, row_key), offset = heads[p]
                context = pieces[p][a:z + length]
                out.append((doc_id, row_key, offset + a, z - a + 1, k, xxhash.xxh3_128_digest(context), context))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    names = ["doc_id", "row_key", "first", "starts", "key", "ctx", "context"]
    kinds = [to_arrow_type(docs.schema["doc_id"].dataType), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    found = saved(base.mapInArrow(runs, f"doc_id {id_type}, row_key long, first long, starts long, key long, ctx binary, "
                                        "context binary"))
    # the contexts' bytes are only moved for one occurrence of each that shares its anchor with others
    facts = saved(found.groupBy("ctx").agg(F.min("key").alias("key"), F.count("*").alias("copies"),
                                           F.min(F.struct("row_key", "first")).alias("at")))
    per_key = saved(facts.groupBy("key").agg(F.count("*").alias("contexts")).where("contexts > 1"))
    several = saved(facts.join(per_key, "key").select("key", "ctx", "contexts", "at.row_key", "at.first"))
    at = ["ctx", "row_key", "first"]
    texts = maybe_in(found.select(*at, "context"), bit_filter(several, *at), *at)
    texts = texts.groupBy(*at).agg(F.first("context").alias("context"))
    mixed = saved(texts.join(several, at).select("key", "ctx", "context", "contexts"))
    shards = max(1, math.ceil(mixed.count() / shard_contexts))
    out_schema = "ctx binary, ranges array<struct<first:long,last:long>>"

    def frame(table: pd.DataFrame, starts: list[np.ndarray]) -> pd.DataFrame:
        rows = [(c, [{"first": a, "last": z} for a, z in ranges(s)]) for c, s in zip(table["ctx"], starts, strict=True)
                if len(s)]
        return pd.DataFrame(rows, columns=["ctx", "ranges"])

    def inside(table: pd.DataFrame) -> pd.DataFrame:
        return frame(table, repeated_starts([bytes(c) for c in table["context"]], length))

    def across(table: pd.DataFrame) -> pd.DataFrame:
        one, two = table[table["part"] == table["i"]], table[table["part"] != table["i"]]
        if not len(one) or not len(two):
            return pd.DataFrame([], columns=["ctx", "ranges"])
        a, b = shared_starts([bytes(c) for c in one["context"]], [bytes(c) for c in two["context"]], length)
        return pd.concat([frame(one, a), frame(two, b)])

    parts = F.ceil(F.col("contexts") / F.lit(shard_contexts)).cast("int")
    dealt = mixed.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("ctx"), F.col("parts")).cast("int"))
    small = dealt.where("parts = 1").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    repeats = small.groupBy("shard").applyInPandas(inside, out_schema)
    large = dealt.where("parts > 1")
    repeats = repeats.unionByName(large.groupBy("key", "part").applyInPandas(inside, out_schema))
    pairs = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("other <> part").select(
        "key", "ctx", "context", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    repeats = repeats.unionByName(pairs.groupBy("key", "i", "j").applyInPandas(across, out_schema))
    repeats = repeats.groupBy("ctx").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))

    known = saved(facts.select("ctx", "copies").join(repeats, "ctx", "left").where("copies > 1 OR ranges IS NOT NULL"))
    hits = attach(found.select("doc_id", "row_key", "first", "starts", "ctx"), known, "ctx", "copies", "row_key",
                  max(1, found.count())).where("copies IS NOT NULL")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), (F.col("starts") - 1).alias("last")))
    spans = hits.select("doc_id", "row_key", "first", F.explode(F.when(F.col("copies") > 1, whole).otherwise(
        F.col("ranges"))).alias("r")).select("doc_id", "row_key", (F.col("first") + F.col("r.first")).alias("start"),
                                             (F.col("first") + F.col("r.last") + length).alias("end"))
    listed = spans.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = F.aggregate(
        "spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]), F.concat(
            F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))).otherwise(
                    F.concat(acc, F.array(x))))
    return listed.select("doc_id", "row_key", joined.alias("spans"))


def cut_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """All rows and columns of ``docs``, with spans (removed byte ranges), kept,
    the UTF-8 bytes that remain, and kept_text, these without the rest of
    characters that lost some of their bytes.

    Null and empty texts and texts shorter than ``length`` bytes keep all
    bytes; repeated rows are occurrences of each other, under one
    doc_id too.  An empty table gives an empty result.  Columns named spans,
    kept, kept_text or row_key are replaced.
    """
    found = saved(repeated_spans(docs, length))
    docs = docs.drop("spans", "kept", "kept_text", "row_key")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", text))
    hit = found.select("row_key").distinct()
    both = marked(keyed, bit_filter(hit, "row_key"), "row_key", name="_hit")
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    clear = both.where("not _hit").select(*docs.columns, none.alias("spans"), text.cast("binary").alias("kept"), text.alias("kept_text"))
    other = found.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), "spans")
    rest = both.where("_hit").drop("_hit")
    rest = rest.join(other, (rest["row_key"] == other["_key"]) & rest["doc_id"].eqNullSafe(other["_id"]), "left")
    rest = rest.select(*docs.columns, F.coalesce("spans", none).alias("spans"), text.cast("binary").alias("kept"),
                       text.alias("kept_text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, "kept"):
            kept = []
            for raw, spans in zip(b.column("kept").to_pylist(), b.column("spans").to_pylist(), strict=True):
                edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(raw)]
                kept.append(b"".join([raw[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)]))
            b = b.set_column(b.schema.get_field_index("kept"), "kept", pa.array(kept, pa.binary()))
            yield b.set_column(b.schema.get_field_index("kept_text"), "kept_text", pa.array(
                [k.decode("utf-8", "ignore") for k in kept], pa.string()))

    return clear.unionByName(rest.mapInArrow(cut, rest.schema))

