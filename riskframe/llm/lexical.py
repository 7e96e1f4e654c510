"""Ranked lexical search: an Aho-Corasick automaton of all item terms is run
over the texts themselves; there is no index of the documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_bytes, hashed

#: What separates terms, as a class of a regular expression: fixed by the contract.
SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (item, term) pairs that one automaton serves, on average.
BLOCK_PAIRS = 200_000
_DOCUMENTS, _TERMS = -1, -2


def guard_table() -> bytes:
    """Byte by byte: letters small, digits and bytes beyond ASCII as they are,
    all else a blank, the guard at both ends of every term."""
    keep = set(range(0x80, 0x100)) | set(b"0123456789") | set(LOWER.encode())
    small = {ord(a): ord(b) for a, b in zip(UPPER, LOWER, strict=True)}
    return bytes(small.get(b, b if b in keep else 0x20) for b in range(256))


def term_list(text: str = "text") -> Column:
    """The distinct terms of a column, with DataFrame functions."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[^{SEPARATORS}]+"), F.lit(0)))


class Scanner:
    """Counts terms in texts: the automaton of the terms, each with a blank
    before and after, so that neighbours share their guard."""

    def __init__(self, terms: list[str]):
        self.table, self.size = guard_table(), len(terms)
        self.automaton = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.automaton.add_word(f" {term.encode().decode('latin-1')} ", i)
        if terms:
            self.automaton.make_automaton()

    def counts(self, text: bytes | None) -> tuple[int, Counter]:
        """How many terms a text has at all, and how often it holds each listed one."""
        if not text:
            return 0, Counter()
        plain = text.translate(self.table)
        inside = np.frombuffer(plain, np.uint8) != 0x20
        n = int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[0])
        if not n or not self.size:
            return n, Counter()
        return n, Counter(map(itemgetter(1), self.automaton.iter(f" {plain.decode('latin-1')} ")))


@dataclass
class Block:
    """Some items: their terms numbered, and the items of every term."""

    items: list
    terms: list[str]
    first: np.ndarray
    holders: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[object, list[str]]]) -> Block:
        terms = sorted({t for _, own in rows for t in own})
        number = {t: i for i, t in enumerate(terms)}
        pairs = sorted((number[t], i) for i, (_, own) in enumerate(rows) for t in own)
        owners = np.array([t for t, _ in pairs], np.int64)
        return cls([k for k, _ in rows], terms, np.searchsorted(owners, np.arange(len(terms) + 1)),
                   np.array([i for _, i in pairs], np.int64))


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))), in doubles."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)


def document_length(n: int, documents: int, total: int, slope: int = 50) -> int:
    """m of a document of ``n`` terms: 100 for one of average length."""
    return 100 - slope + (slope * n * documents) // total


class Best:
    """The k highest scores of every item; equal ones by ascending id, null last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held, self.room = 0, 4 * k * items + 100_000

    def add(self, item: np.ndarray, score: np.ndarray, key: np.ndarray, none: np.ndarray) -> None:
        good = score >= self.least[item]
        self.parts.append((item[good], score[good], key[good], none[good]))
        self.held += len(self.parts[-1][0])
        if self.held > self.room:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        item, score, key, none = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((key, none, -score, item))
        item, score, key, none = item[order], score[order], key[order], none[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.k - 1
        self.least[item[last]] = score[last]
        top = place < self.k
        self.parts = [(item[top], score[top], key[top], none[top])]
        self.held = int(top.sum())
        return self.parts[0]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in by_bytes(batches):
        yield batch, batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def _statistics(docs: DataFrame, terms: list[str]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents of each listed term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        scanner = Scanner(shared.value)
        df, documents, total = np.zeros(len(shared.value), np.int64), 0, 0
        for _, texts in _texts(batches):
            for text in texts:
                n, found = scanner.counts(text)
                documents += n > 0
                total += n
                df[list(found)] += 1
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([_DOCUMENTS, _TERMS, *seen.tolist()], pa.int32()),
                                          pa.array([documents, total, *df[seen].tolist()], pa.int64())], ["term", "n"])

    sums = dict(docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n")).collect())
    df = np.array([sums.get(i, 0) for i in range(len(terms))], np.int64)
    return sums.get(_DOCUMENTS, 0), sums.get(_TERMS, 0), df


def _block_ranks(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """(item, doc_id, score) of at most ``k`` documents a task and item."""
    spark = docs.sparkSession
    documents, total, df = _statistics(docs, block.terms)
    shared = spark.sparkContext.broadcast((block, weights(df, documents), documents, total, k))
    kind = docs.schema["doc_id"].dataType

    def rank(batches):
        block, weight, documents, total, k = shared.value
        scanner, items = Scanner(block.terms), len(block.items)
        best, per_term = Best(items, k), np.diff(block.first)
        most = max(1, (1 << 22) // max(items, 1))
        keys, none, lengths, found, spent = [], [], [], [], 0
        fill = None

        def score():
            nonlocal keys, none, lengths, found, spent
            if not keys:
                return
            which = np.repeat(np.arange(len(found)), [len(f) for f in found])
            term = np.fromiter((t for f in found for t in f), np.int64, len(which))
            tf = np.fromiter((c for f in found for c in f.values()), np.int64, len(which))
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.array(lengths, np.int64)[which]))
            times = per_term[term]
            ends = np.cumsum(times)
            at = np.repeat(block.first[term] - ends + times, times) + np.arange(ends[-1] if len(ends) else 0)
            sums = np.zeros(len(found) * items, np.int64)
            np.add.at(sums, np.repeat(which, times) * items + block.holders[at], np.repeat(value, times))
            hit = np.flatnonzero(sums)
            ids = np.array(keys)
            best.add(hit % items, sums[hit], ids[hit // items], np.array(none)[hit // items])
            keys, none, lengths, found, spent = [], [], [], [], 0

        for batch, texts in _texts(batches):
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            if fill is None:
                fill = "" if pa.types.is_string(batch.schema.field("doc_id").type) else 0
            for key, text in zip(ids, texts, strict=True):
                n, terms = scanner.counts(text)
                if not terms:
                    continue
                keys.append(fill if key is None else key)
                none.append(key is None)
                lengths.append(document_length(n, documents, total))
                found.append(terms)
                spent += int(per_term[list(terms)].sum())
                if len(keys) >= most or spent > 1 << 22:
                    score()
        score()
        if best.parts:
            item, value, key, none = best.settle()
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array([None if x else y for x, y in zip(none.tolist(), key.tolist(), strict=True)],
                                                      arrow), pa.array(value, pa.int64())], ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType
    arrow = to_arrow_type(kind)
    return docs.select("doc_id", "text").mapInArrow(rank, StructType([
        StructField("item", IntegerType()), StructField("doc_id", kind), StructField("score", LongType())]))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents.

    The items are dealt by hash into blocks of about ``block_pairs`` (item,
    term) pairs, a bounded broadcast (or one item, if that alone is larger);
    one automaton a block is run over all texts twice, first for the document
    frequencies, then for the scores.  A task keeps each item's ``k`` best.

    Null and empty texts have no terms, on both sides; an item without terms,
    or whose terms occur nowhere, has no rows.  Every row of ``docs`` is a
    document of its own, also under one id; rows of ``items`` with one id and
    the same terms are one item, with other terms an item of their own.  A
    null doc_id comes last among equal scores.  An empty table on either side
    gives an empty result; other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    listed = items.select("item_id", F.array_sort(term_list()).alias("terms")).where("size(terms) > 0").distinct()
    pairs = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(pairs / block_pairs))
    dealt = listed.withColumn("block", F.pmod(hashed(F.col("item_id"), F.array_join("terms", " ")), F.lit(blocks)))
    out = None
    for number in range(blocks):
        block = Block.of([(r["item_id"], r["terms"]) for r in dealt.where(F.col("block") == number).collect()])
        found = _block_ranks(docs, block, k)
        names = spark.createDataFrame(list(enumerate(block.items)), _names(items))
        order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        part = Window.partitionBy("item", "part").orderBy(*order)
        found = (found.withColumn("part", F.pmod(hashed(F.col("doc_id"), F.col("score")), F.lit(16)))
                 .withColumn("place", F.row_number().over(part)).where(F.col("place") <= k))
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(
            F.col("rank") <= k)
        rows = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = rows if out is None else out.unionByName(rows)
    return out


def _names(items: DataFrame):
    from pyspark.sql.types import IntegerType, StructField, StructType
    return StructType([StructField("item", IntegerType()), StructField("item_id", items.schema["item_id"].dataType)])


#: The same ranking in DuckDB's SQL.
TWIN = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{SEPARATORS}]+') AS terms FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, terms, len(terms) AS n FROM w WHERE len(terms) > 0),
a AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{SEPARATORS}]+')) AS term
      FROM benchmark),
f AS (SELECT term, count(*) AS df FROM t WHERE term IN (SELECT term FROM i) GROUP BY term),
g AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight FROM f, a),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM d, a),
s AS (SELECT i.item_id, m.doc_id, m.r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM i JOIN g USING (term) JOIN t USING (term) JOIN m ON m.r = t.r GROUP BY i.item_id, m.doc_id, m.r),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50"""
