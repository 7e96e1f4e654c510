"""Quality by ordinal cumulative-link regression on graded ratings."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_bytes

DIMENSIONS = 1 << 18
#: Feature sums are means over the words times this.
SCALE = 8.0
_RUNS = re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """Case and punctuation of a word: ``Word!!`` is ``Aa!``."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", kinds)


def _index(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (DIMENSIONS - 1)


class _Features(dict):
    """Two hashed indices in one number, of a word and of its shape."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        out = self[word] = _index(word.lower()) << 20 | _index("\x00" + shape(word))
        return out


_FEATURES = _Features()
_LINE, _SAME = (_index(x) << 20 | _index(x) for x in ("\x01line", "\x01same"))


def features(text: str | None) -> np.ndarray:
    """Hashed words, word shapes, and marks for each line seen before and each
    word that repeats the one before it."""
    text = text or ""
    words = text.split()
    codes = np.fromiter(map(_FEATURES.__getitem__, words), np.int64, len(words))
    if len(words):
        lines = text.split("\n")
        same = np.count_nonzero(codes[1:] == codes[:-1])
        codes = np.concatenate([codes, np.full(len(lines) - len(set(lines)), _LINE), np.full(same, _SAME)])
    return np.concatenate([codes >> 20, codes & (DIMENSIONS - 1)])


@dataclass
class CumulativeLink:
    """P(grade > k) = sigmoid(f - threshold k): one text score f, ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def text_score(self, feats: np.ndarray) -> float:
        return float(self.weights[feats].sum(dtype=np.float64) * SCALE / len(feats)) if len(feats) else 0.0

    def tails(self, f: float) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..., never increasing."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - f, -50, 50)))


def fit(examples: DataFrame, grades: int = 3, epochs: int = 100, rate: float = 0.3, damping: float = 1e-3,
        decay: float = 1e-6) -> CumulativeLink:
    """Trained on (text, grade 0 .. grades - 1), a bounded sample: AdaGrad on
    the ordinal likelihood, damped so that features of few documents hardly
    move.  Gaps between thresholds are exponentials, so they stay ordered.
    Without examples all weights are 0."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches):
            found = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("grade").cast(pa.int32()), pa.array(found, pa.list_(pa.int64()))],
                                             ["grade", "features"])

    table = examples.mapInArrow(rows, "grade int, features array<long>").toArrow()
    return fit_rows(table["grade"].to_numpy(), [np.asarray(f.values) for f in table["features"]],
                    grades, epochs, rate, damping, decay)


def fit_rows(grade: np.ndarray, words: list[np.ndarray], grades: int, epochs: int, rate: float, damping: float,
             decay: float) -> CumulativeLink:
    order = sorted(range(len(grade)), key=lambda i: (zlib.crc32(words[i].tobytes()), len(words[i]), grade[i]))
    order = np.array([i for i in order if len(words[i])], np.int64)
    weights, first, gaps = np.zeros(DIMENSIONS), -1.0, np.zeros(grades - 2)
    square, extra = np.full(DIMENSIONS, damping ** 2), np.full(grades - 1, damping ** 2)

    def thresholds():
        return first + np.append(0, np.cumsum(np.exp(gaps)))

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    if len(order):
        x, size = np.concatenate([words[i] for i in order]), np.array([len(words[i]) for i in order])
        y = grade[order]
    for _ in range(epochs if len(order) else 0):
        f = np.add.reduceat(weights[x], np.cumsum(size) - size) * SCALE / size
        t = np.concatenate([[-np.inf], thresholds(), [np.inf]])
        low, high = sigmoid(t[y + 1] - f), sigmoid(t[y] - f)
        low[y == grades - 1], high[y == 0] = 1, 0
        p = np.maximum(low - high, 1e-9)
        d_low, d_high = low * (1 - low) / p, high * (1 - high) / p
        pull = (d_low - d_high) / len(y)
        gradient = np.bincount(x, np.repeat(pull * SCALE / size, size), DIMENSIONS) + decay * weights
        square += gradient ** 2
        weights -= rate * gradient / np.sqrt(square)
        by = (np.bincount(y, -d_low, grades)[:-1] + np.bincount(y, d_high, grades)[1:]) / len(y)
        change = np.array([by.sum(), *[by[k + 1:].sum() * np.exp(gaps[k]) for k in range(grades - 2)]])
        extra += change ** 2
        step = 0.3 * rate * change / np.sqrt(extra)
        first -= step[0]
        gaps -= step[1:]
    return CumulativeLink(weights.astype(np.float32), thresholds())


def score_quality(docs: DataFrame, model: CumulativeLink, least: int = 1, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id, expected_grade, tail_prob (P(grade >=
    ``least``)), grade_probs (P(grade >= k), k from 1) and kept (tail_prob at
    least ``threshold``).

    Null and empty texts and texts without words get the probabilities of a
    text score of 0.  Rows repeated under one doc_id are scored each; an empty
    table gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in by_bytes(batches):
            tails = [m.tails(m.text_score(features(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([float(t.sum()) for t in tails], pa.float64()),
                 pa.array([float(t[least - 1]) for t in tails], pa.float64()),
                 pa.array(tails, pa.list_(pa.float64())), pa.array([bool(t[least - 1] >= threshold) for t in tails])],
                ["doc_id", "expected_grade", "tail_prob", "grade_probs", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, expected_grade double, tail_prob double, grade_probs array<double>, kept boolean")
