"""Language identification with hyperdimensional letter n-gram profiles."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes

DIMENSIONS = 1024
SEED = 97
#: Rows of n-gram vectors a worker keeps (4 KB each).
ROWS = 16384


class Space:
    """Random letter vectors of -1 and 1, and the trigram vectors bound from
    them: the first letter rotated twice, the second once, multiplied."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letter = np.zeros(0x110000, bool)
        self.letter[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"]] = True
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((ROWS, dimensions), np.float32)

    def of_letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            rng = np.random.default_rng([self.seed, point])
            self.letters[point] = rng.integers(0, 2, self.dimensions).astype(np.float32) * 2 - 1
        return self.letters[point]

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct letter trigrams and their counts; whatever is no letter is
        one gap, also before and after the text.  None without a letter."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        points = np.where(self.letter[points], points, 0) if len(points) else points
        if not points.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        points = np.concatenate([[0], points, [0]])
        points = points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]
        return np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:], return_counts=True)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors, as often as they occur."""
        out = np.zeros(self.dimensions)
        for a in range(0, len(grams), ROWS // 2):
            part = grams[a:a + ROWS // 2].tolist()
            new = [g for g in part if g not in self.rows]
            if len(self.rows) + len(new) > ROWS:
                self.rows.clear()
                new = part
            for g in new:
                x, y, z = (self.of_letter(g >> s & 0x1FFFFF) for s in (42, 21, 0))
                self.vectors[len(self.rows)] = np.roll(x, 2) * np.roll(y, 1) * z
                self.rows[g] = len(self.rows)
            rows = [self.rows[g] for g in part]
            out += counts[a:a + ROWS // 2].astype(np.float32) @ self.vectors[rows]
        return out


_SPACES: dict[tuple[int, int], Space] = {}


def space(dimensions: int = DIMENSIONS, seed: int = SEED) -> Space:
    if (dimensions, seed) not in _SPACES:
        _SPACES[dimensions, seed] = Space(dimensions, seed)
    return _SPACES[dimensions, seed]


@dataclass
class Profiles:
    """One bundled vector per language, in the languages' order."""

    languages: list[str]
    prototypes: np.ndarray

    def nearest(self, vector: np.ndarray) -> tuple[str, float]:
        """The language of the largest cosine (ties: the first), and that cosine from 0."""
        cosines = self.prototypes @ vector / max(np.linalg.norm(vector), 1e-12)
        best = int(np.argmax(cosines))
        return self.languages[best], float(np.clip(cosines[best], 0, 1))


def fit(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> Profiles:
    """Prototypes from all (text, lang) rows with a lang: each task bundles its
    own rows, Spark sums the partial vectors by language and coordinate; the
    driver gets one vector a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, counts = space(dimensions, seed), {}

        def partial():
            for lang, own in sorted(counts.items()):
                grams = np.fromiter(own.keys(), np.int64, len(own))
                vector = s.bundle(grams, np.fromiter(own.values(), np.int64, len(own)))
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([np.rint(vector).astype(np.int64)],
                                                                             pa.list_(pa.int64()))], ["lang", "v"])
            counts.clear()

        for b in by_bytes(batches):
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                own = counts.setdefault(lang, {})
                grams, n = s.grams(text)
                for g, c in zip(grams.tolist(), n.tolist(), strict=True):
                    own[g] = own.get(g, 0) + c
            if sum(map(len, counts.values())) > 500_000:
                yield from partial()
        yield from partial()

    parts = docs.where("lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(
        run, "lang string, v array<long>")
    sums = parts.select("lang", F.posexplode("v").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x"))
    found = sums.toPandas().sort_values(["lang", "d"])
    names = sorted(found["lang"].unique())
    table = found["x"].to_numpy(np.float64).reshape(len(names), -1) if names else np.empty((0, dimensions))
    keep = np.linalg.norm(table, axis=1) > 0
    table = table[keep]
    return Profiles([n for n, k in zip(names, keep, strict=True) if k],
                    table / np.linalg.norm(table, axis=1, keepdims=True))


def identify(docs: DataFrame, profiles: Profiles, dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, score (cosine, 0 to 1).

    ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned.  Rows repeated under one doc_id are answered each; an empty table
    gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, p = space(dimensions, seed), shared.value
        for b in by_bytes(batches):
            out = []
            for text in b.column("text").to_pylist():
                grams, counts = s.grams(text)
                out.append(p.nearest(s.bundle(grams, counts)) if len(grams) and p.languages else ("und", 0.0))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x for x, _ in out], pa.string()),
                                              pa.array([x for _, x in out], pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
