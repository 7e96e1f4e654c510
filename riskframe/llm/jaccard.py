"""N-gram Jaccard join on count vectors: tiles by block projections, R-trees inside."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, by_bytes, components, filled, has_bit, key_bits, only_ids, saved

#: Groups of the count vectors in the R-trees.
GROUPS = 128
#: Groups of the finer vectors that are compared before whole sets move: the
#: few groups tell sets of thousands of shingles apart only poorly.
FINE_GROUPS = 2048
LEAF = 16
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Words(dict):
    """64-bit hashes of words; starts anew beyond so many, which bounds a worker's memory."""

    MOST = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.MOST:
            self.clear()
        out = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


_WORDS = _Words()


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles: A-Z lower-cased, words between
    blanks (space and U+0009 to U+000D); fewer words are one shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    width = min(words, len(h))
    acc = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        acc = mix(acc * _A + h[i:len(h) - width + 1 + i])
    return np.unique(acc)


class Bands:
    """Bands of set sizes, a quarter wider each, and each band's block count.

    Sets of x and y shingles with similarity num / den or more differ in at
    most (x + y)(den - num) / (den + num) shingles.  With one block of groups
    more than that, some block has equal counts in both vectors.  With
    ``spare`` blocks more, some such block is not empty, unless both sets
    leave more than ``spare`` blocks empty.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges = [1]

    def edge(self, k: int) -> int:
        while len(self.edges) <= k:
            e = self.edges[-1]
            self.edges.append(max(e + 1, e * 5 // 4))
        return self.edges[k]

    def most_changes(self, k: int) -> int:
        return 2 * (self.edge(k + 1) - 1) * (self.den - self.num) // (self.den + self.num)

    def spare(self, k: int) -> int:
        changes = self.most_changes(k)
        return 1 + changes // 16 if changes else 0

    def blocks(self, k: int) -> int:
        return self.most_changes(k) + 1 + self.spare(k)

    def of(self, size: int) -> list[int]:
        """A set's own band, and the higher ones where a similar set may be."""
        k = 0
        while self.edge(k + 1) <= size:
            k += 1
        out = [k]
        while size * self.den >= self.num * self.edge(out[-1] + 1):
            out.append(out[-1] + 1)
        return out


def tile_keys(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """One key a block for each band of the set: the counts of the block's
    finest groups, one for each shingle hash.  Equal projections have equal
    keys.  Empty blocks, which are alike in all sets, get a key only where
    there are more of them than the band's spare ones."""
    high, out = hashes >> np.uint64(32), [np.empty(0, np.uint64)]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes * _B + _C), out=sums[1:])
    for k in bands.of(len(hashes)):
        blocks = bands.blocks(k)
        group = (high * np.uint64(blocks)) >> np.uint64(32)
        border = np.searchsorted(group, np.arange(blocks + 1, dtype=np.uint64))
        block = np.arange(blocks, dtype=np.uint64)
        keys = mix(sums[border[1:]] - sums[border[:-1]] + block * _A + np.uint64((k + 1) * int(_C) % (1 << 64)))
        full = border[1:] > border[:-1]
        out.append(keys[full] if blocks - np.count_nonzero(full) <= bands.spare(k) else keys)
    return np.concatenate(out).view(np.int64)


#: Bytes of a key that the search for repeated keys moves; with the bucket they
#: tell keys apart but for chance, and a chance match only keeps a key.
KEY_BYTES = 5
#: Text bytes whose keys go to one bucket, and keys that a worker holds at once.
BUCKET_TEXT = 32 << 20
KEYS_HELD = 1 << 18


def dealt(keys: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """One row a bucket: the low bytes of its keys, each at most twice."""
    every = np.concatenate([np.empty(0, np.int64), *keys]).view(np.uint64)
    every.sort()
    third = np.zeros(len(every), bool)
    third[2:] = every[2:] == every[:-2]
    every = every[~third]
    bucket = ((every >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = (np.append(first, len(every)) * KEY_BYTES).tolist()
    low = every.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first], pa.int64()),
         pa.array([low[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary())], ["bucket", "keys"])


def repeated(table: pd.DataFrame) -> pd.DataFrame:
    """The low bytes of a bucket's keys that occur more than once, as numbers."""
    low = np.frombuffer(b"".join(table["keys"]), np.uint8).reshape(-1, KEY_BYTES)
    keys = np.zeros((len(low), 8), np.uint8)
    keys[:, :KEY_BYTES] = low
    keys = keys.view("<i8").ravel()
    keys.sort()
    return pd.DataFrame({"key": np.unique(keys[1:][keys[1:] == keys[:-1]])}, dtype="int64")


def set_class(hashes: np.ndarray) -> int:
    """A 64-bit id of the set: equal for equal sets."""
    with np.errstate(over="ignore"):
        total = mix(hashes * _C + _A).sum(dtype=np.uint64) + np.uint64(len(hashes)) * _B
    return int(mix(np.array([total]))[0].view(np.int64))


def count_vector(hashes: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Shingles of the set in each of so many groups (by their hash; a power of two)."""
    return np.bincount((hashes >> np.uint64(64 - groups.bit_length() + 1)).astype(np.int64), minlength=groups)


def packed_vector(hashes: np.ndarray, groups: int = GROUPS) -> bytes:
    """The count vector in a byte a group; 255 stands for that many or more."""
    return np.minimum(count_vector(hashes, groups), 255).astype(np.uint8).tobytes()


def unpacked_vectors(packed: list[bytes]) -> np.ndarray:
    """Upper bounds of the counts: a full byte bounds nothing (no text has 2^30 words)."""
    groups = len(packed[0]) if packed else GROUPS
    out = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, groups).astype(np.int32)
    out[out == 255] = 1 << 30
    return out


class CountTree:
    """A packed R-tree over count vectors: leaves of LEAF points, ordered by
    size and then by the widest coordinates; boxes keep their upper corners
    and their range of sizes."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        spread = np.argsort(-vectors.var(axis=0))[:2]
        self.order = np.arange(len(sizes))
        if len(sizes) > LEAF:
            slabs = max(1, math.isqrt(math.ceil(len(sizes) / LEAF)))
            slab = np.argsort(np.argsort(sizes, kind="stable")) * slabs // len(sizes)
            self.order = np.lexsort((vectors[:, spread[1]], vectors[:, spread[0]], slab))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        self.levels = []
        top, low, high = self.vectors, self.sizes, self.sizes
        while len(top) > 1 or not self.levels:
            cut = np.arange(0, len(top), LEAF)
            top, low, high = (np.maximum.reduceat(top, cut), np.minimum.reduceat(low, cut),
                              np.maximum.reduceat(high, cut))
            self.levels.append((top, low, high))

    def candidates(self, vector: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """Points whose overlap, bounded by the sum of coordinate minima, may do."""
        def may(top, low, high):
            return ((np.minimum(top, vector).sum(axis=1) * (num + den) >= num * (size + low))
                    & (high * den >= num * size) & (low * num <= den * size))

        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[level]
            at = at[may(top[at], low[at], high[at])]
            below = len(self.levels[level - 1][0]) if level else len(self.sizes)
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < below]
        at = at[may(self.vectors[at], self.sizes[at], self.sizes[at])]
        return self.order[at]


def local_links(vectors: np.ndarray, sizes: np.ndarray, free: np.ndarray, num: int, den: int,
                sets: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Links that connect what is linked within these sets, as a forest: pairs
    whose overlap bound suffices, verified where the ``sets`` are given.  Pairs
    without a ``free`` member are not looked at, nor pairs already connected."""
    group, links = np.arange(len(sizes)), []
    if sets is None and len(sizes) <= LEAF and free.all():  # a tree of one leaf: its points directly
        bound = np.minimum(vectors[:, None], vectors[None]).sum(axis=2) * (num + den)
        pairs = np.argwhere(np.triu(bound >= num * (sizes[:, None] + sizes[None]), 1))
        for i, j in pairs.tolist():
            if group[i] != group[j]:
                links.append((i, j))
                group[group == group[j]] = group[i]
        return links
    tree = CountTree(vectors, sizes)
    for i in np.flatnonzero(free).tolist():
        near = tree.candidates(vectors[i], int(sizes[i]), num, den)
        for j in near[group[near] != group[i]].tolist():
            if group[i] == group[j]:
                continue
            if sets is not None:
                both = np.concatenate([sets[i], sets[j]])
                both.sort()
                overlap = np.count_nonzero(both[1:] == both[:-1])
                if overlap * (num + den) < num * int(sizes[i] + sizes[j]):
                    continue
            links.append((i, j))
            group[group == group[j]] = group[i]
    return links


def _unpacked(table: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, list | None]:
    """cls, count vectors, sizes and, where the table has them, the sets."""
    sets = None
    if "hashes" in table:
        sets = [np.asarray(h, np.int64).view(np.uint64) for h in table["hashes"]]
        vectors = np.stack([count_vector(x) for x in sets])
    else:
        vectors = unpacked_vectors(table["vec"].tolist())
    return table["cls"].to_numpy(), vectors, table["n"].to_numpy(np.int64), sets


def links_within(members: DataFrame, payload: str, anchored: Callable[[DataFrame], DataFrame], num: int, den: int,
                 chunk_sets: int, chunk_mass: int, sizes: DataFrame | None = None) -> DataFrame:
    """(a, b) links that connect what is linked inside each ``root`` group of
    ``members`` (root, cls, n and a payload: ``vec`` or ``hashes``).

    Groups of at most a chunk are done whole, many to a task.  Larger ones are
    first linked to one anchor (``anchored`` adds anchor and linked); then only
    chunk pairs with a member that is not linked to it are joined, so that no
    task holds more than two chunks.  ``sizes`` (root, m, mass and what
    ``anchored`` needs) saves counting; too large a count does no harm.
    """
    edge = "a long, b long"
    if sizes is None:
        sizes = saved(members.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("mass")))
    large = (F.col("m") > chunk_sets) | (F.col("mass") > chunk_mass)
    facts = sizes.agg(F.sum("m").alias("m"), F.sum("mass").alias("mass"), F.count_if(large).alias("big")).first()
    bundles = max(1, math.ceil(max((facts["m"] or 0) / chunk_sets, (facts["mass"] or 0) / chunk_mass)))
    few = sizes.where(large).select("root")
    few = F.broadcast(few) if facts["big"] <= 100_000 else few  # 8 bytes a row
    small = (members.join(few, "root", "left_anti") if facts["big"] else members).withColumn(
        "bundle", F.pmod(F.xxhash64("root"), F.lit(bundles)).cast("int"))

    def within(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["root", "cls"])
        cls, vectors, sizes, sets = _unpacked(table)
        cut = np.flatnonzero(np.diff(table["root"].to_numpy())) + 1
        first, last = np.append(0, cut), np.append(cut, len(table))
        pairs = first[last - first == 2]
        may = (np.minimum(vectors[pairs], vectors[pairs + 1]).sum(axis=1) * (num + den)
               >= num * (sizes[pairs] + sizes[pairs + 1]))
        found = [] if sets is not None else [(cls[i], cls[i + 1]) for i in pairs[may].tolist()]
        more = np.flatnonzero(last - first > 2) if sets is None else np.arange(len(first))
        for a, b in zip(first[more].tolist(), last[more].tolist(), strict=True):
            found += [(cls[a + i], cls[a + j]) for i, j in local_links(
                vectors[a:b], sizes[a:b], np.ones(b - a, bool), num, den, sets and sets[a:b])]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    links = small.groupBy("bundle").applyInPandas(within, edge)
    if not facts["big"]:
        return links

    own = members.join(F.broadcast(sizes.where(large)) if facts["big"] <= 10_000 else sizes.where(large), "root")
    own = saved(anchored(own))
    links = links.unionByName(own.where("linked AND cls <> anchor").select(
        F.col("cls").alias("a"), F.col("anchor").alias("b")))
    parts = (own.groupBy("root").agg(
        *[F.ceil(F.greatest(F.sum(F.when(when, 1).otherwise(0)) / chunk_sets,
                            F.sum(F.when(when, F.col("n")).otherwise(0)) / chunk_mass)).cast("int").alias(name)
          for name, when in (("free_parts", ~F.col("linked")), ("star_parts", F.col("linked")))])
        .where("free_parts > 0"))
    own = own.join(parts, "root")
    columns = ["root", "cls", "n", payload]
    free = own.where("not linked").withColumn("part", F.pmod(F.xxhash64("cls"), F.col("free_parts")).cast("int"))
    pairs = free.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("free_parts") - 1))).select(
        *columns, F.lit(True).alias("free"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    around = free.withColumn("j", F.explode(F.sequence(F.lit(-1), -F.col("star_parts")))).select(
        *columns, F.lit(True).alias("free"), F.col("part").alias("i"), "j")
    star = own.where("linked").withColumn("j", (-1 - F.pmod(F.xxhash64("cls"), F.col("star_parts"))).cast("int"))
    star = star.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("free_parts") - 1))).select(
        *columns, F.lit(False).alias("free"), "i", "j")

    def between(table: pd.DataFrame) -> pd.DataFrame:
        cls, vectors, sizes, sets = _unpacked(table)
        found = local_links(vectors, sizes, table["free"].to_numpy(bool), num, den, sets)
        return pd.DataFrame([(cls[i], cls[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    return links.unionByName(pairs.unionByName(around).unionByName(star)
                             .groupBy("root", "i", "j").applyInPandas(between, edge))


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100,
                    chunk_sets: int = 1024, chunk_shingles: int = 1_000_000, keyed: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id, the
    smallest doc_id reachable by links of similarity num / den or more; with
    ``keyed`` also row_key, a hash of doc_id and text, and kept, true of the
    row of smallest (doc_id, row_key) of each group and of rows that link with
    nothing.  Wholly repeated rows share their key and their decision.

    Each distinct set has tile keys: similar sets share a tile.  A first pass
    finds the keys that occur more than once from their low bytes, moved in
    sorted runs; only these stay.  In a tile, a count-vector R-tree bounds overlaps by sums of coordinate minima,
    and the pairs that may do connect the sets to clusters.  The clusters are
    parted once more by the same bound on finer vectors; only in what is left
    of them do whole sets move: the trees are used again and the surviving pairs
    verified on the sets, until all that is linked is connected.

    Null and empty texts have no shingles and link with nothing; a row without
    doc_id has component_id null.  Rows repeated under one doc_id are
    documents of their own that share an id.  An empty table gives an empty
    result; other columns are not read.
    """
    bands = Bands(num, den)

    def all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in by_bytes(batches):
            for text in batch.column("text").to_pylist():
                x = shingles(text, words)
                if len(x):
                    held.append(tile_keys(x, bands))
                    count += len(held[-1])
                if count > KEYS_HELD:
                    yield dealt(held, buckets)
                    held, count = [], 0
        yield dealt(held, buckets)

    base = docs.select("doc_id", "text", *([F.xxhash64("doc_id", filled()).alias("row_key")] if keyed else []))
    row = ["doc_id", "row_key"] if keyed else ["doc_id"]
    named = base.where("doc_id IS NOT NULL")
    buckets = max(64, (named.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_TEXT)
    again = saved(named.mapInArrow(all_keys, "bucket long, keys binary").groupBy("bucket").applyInPandas(
        repeated, "key long"))
    context = docs.sparkSession.sparkContext
    may = context.broadcast(key_bits(again))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(may.value, np.uint8)
        for batch in by_bytes(batches):
            found = [shingles(t, words) for t in batch.column("text").to_pylist()]
            keys = [has_bit(bits, tile_keys(x, bands)) if len(x) else np.empty(0, np.int64) for x in found]
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in row], pa.array([len(x) for x in found], pa.int64()),
                 pa.array([set_class(x) if len(x) else None for x in found], pa.int64()),
                 pa.array([packed_vector(x) for x in found], pa.binary()),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int64), *keys])))],
                [*row, "n_shingles", "cls", "vec", "keys"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    key_type = ", row_key long" if keyed else ""
    rows = saved(base.mapInArrow(
        sketch, f"doc_id {id_type}{key_type}, n_shingles long, cls long, vec binary, keys array<long>"))
    total = rows.count()
    live = rows.where("cls IS NOT NULL AND doc_id IS NOT NULL")
    classes = saved(live.groupBy("cls").agg(F.min(F.struct(*row)).alias("first"), F.count("*").alias("copies"),
                                            F.max("n_shingles").alias("n"), F.max("vec").alias("vec"),
                                            F.max("keys").alias("keys")))
    shared = saved(classes.select(F.explode("keys").alias("root"), "cls").groupBy("root").agg(
        F.min("cls").alias("anchor"), F.count("*").alias("m")).where("m > 1"))
    tiles = context.broadcast(key_bits(shared.select(F.col("root").alias("key"))))

    def in_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The keys of copies of one set alone are no tiles."""
        bits = np.frombuffer(tiles.value, np.uint8)
        for batch in batches:
            keys = [has_bit(bits, np.asarray(k.values, np.int64)) for k in batch.column("keys")]
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            kept = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int64), *keys])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("cls", "n", "vec")], kept],
                                             ["cls", "n", "vec", "keys"])

    members = classes.select("cls", "n", "vec", "keys").mapInArrow(
        in_tiles, "cls long, n long, vec binary, keys array<long>").select(
        F.explode("keys").alias("root"), "cls", "n", "vec")

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (unpacked_vectors(batch.column(c).to_pylist()) for c in ("vec", "anchor_vec"))
            sizes = batch.column("n").to_numpy() + batch.column("anchor_n").to_numpy()
            linked = np.minimum(one, two).sum(axis=1) * (num + den) >= num * sizes
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("root", "anchor", "cls", "n", "vec")]
                                             + [pa.array(linked)], ["root", "anchor", "cls", "n", "vec", "linked"])

    def near_anchor(own: DataFrame) -> DataFrame:
        anchors = own.where("cls = anchor").select("root", F.col("n").alias("anchor_n"), F.col("vec").alias("anchor_vec"))
        return own.join(anchors, "root").mapInArrow(
            bounded, "root long, anchor long, cls long, n long, vec binary, linked boolean")

    clusters = components(links_within(members, "vec", near_anchor, num, den, 2 * chunk_sets, 1 << 60,
                                       shared.withColumn("mass", F.col("m"))))

    def fine_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            found = [x for x in (shingles(t, words) for t in batch.column("text").to_pylist()) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_class(x) for x in found], pa.int64()), pa.array([len(x) for x in found], pa.int64()),
                 pa.array([packed_vector(x, FINE_GROUPS) for x in found], pa.binary())], ["cls", "n", "vec"])

    def clustered(groups: DataFrame, sets: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                  payload: str) -> DataFrame:
        """root, cls, n and payload of each set of the ``groups`` (v, root), from its texts."""
        holders = classes.join(groups, classes["cls"] == groups["v"]).select(F.col("first.doc_id").alias("doc_id"))
        texts = only_ids(docs.select("doc_id", "text"), saved(holders.distinct()))
        found = texts.mapInArrow(sets, f"cls long, n long, {payload}").join(groups, F.col("cls") == F.col("v"))
        return saved(found.select("root", "cls", "n", payload.split()[0]).dropDuplicates(["cls"]))

    fine = clustered(clusters, fine_of, "vec binary")
    of_root = saved(fine.groupBy("root").agg(F.min("cls").alias("anchor"), F.count("*").alias("m"))
                    .withColumn("mass", F.col("m")))
    clusters = components(links_within(fine, "vec", near_anchor, num, den, chunk_sets, 1 << 60, of_root))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            found = [shingles(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_class(x) if len(x) else None for x in found], pa.int64()),
                 pa.array([len(x) for x in found], pa.int64()),
                 pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["cls", "n", "hashes"])

    sets = clustered(clusters, sets_of, "hashes array<long>")

    def near_root(own: DataFrame) -> DataFrame:
        roots = own.where("cls = root").select("root", F.col("n").alias("root_n"), F.col("hashes").alias("root_hashes"))
        overlap = F.size(F.array_intersect("hashes", "root_hashes"))
        return own.join(roots, "root").select("root", F.col("root").alias("anchor"), "cls", "n", "hashes", (
            overlap * (num + den) >= num * (F.col("n") + F.col("root_n"))).alias("linked"))

    links = links_within(sets, "hashes", near_root, num, den, chunk_sets, chunk_shingles)
    linked = components(links)
    grouped = classes.join(linked, classes["cls"] == linked["v"], "left").select(
        "cls", "first", "copies", F.coalesce("root", "cls").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("keeper"), F.count("*").alias("classes"))
    grouped = attach(grouped, saved(smallest.where("classes > 1")), "root", "classes", "cls", total)
    grouped = saved(grouped.select("cls", "copies", F.coalesce("keeper", "first").alias("keeper"))
                    .where("copies > 1 OR keeper <> first OR classes > 1"))
    out = attach(rows.select(*row, "n_shingles", "cls"), grouped, "cls", "copies", "doc_id", total,
                 joins=F.col("cls").isNotNull())
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("keeper.doc_id", "doc_id")).alias("component_id")
    kept = F.col("doc_id").isNull() | F.col("keeper").isNull() | (F.struct(*row) == F.col("keeper"))
    return out.select("doc_id", "n_shingles", component, *(["row_key", kept.alias("kept")] if keyed else []))
