"""Toxicity by multiple-instance learning: noisy-or over sentence scores."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_bytes

DIMENSIONS = 1 << 22
#: Bytes that end a sentence; all other ASCII that is no letter separates words.
_ENDS = b".!?\n\r"
_TABLE = bytes(0x0A if b in _ENDS else b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))


def word_features(word: bytes) -> list[int]:
    """Hashed indices of the word, its first 3 to 9 bytes and its 4-grams."""
    parts = {b"=" + word, *(b"^" + word[:n] for n in range(3, min(10, len(word)))),
             *(b"~" + word[i:i + 4] for i in range(len(word) - 3))}
    return [zlib.crc32(p) & (DIMENSIONS - 1) for p in parts]


def sentences(text: str | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of each sentence with words its (start, end) in UTF-8 bytes and its
    count of words, and all words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    spans, counts, words, at = [], [], [], 0
    for part in raw.translate(_TABLE).split(b"\n"):
        found = part.split()
        if found:
            spans.append((at, at + len(part)))
            counts.append(len(found))
            words += found
        at += len(part) + 1
    return np.array(spans, np.int64).reshape(-1, 2), np.array(counts, np.int64), words


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class _Scores(dict):
    """Words' summed weights; starts anew beyond a million words."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) > 1_000_000:
            self.clear()
        out = self[word] = sum(self.weights.get(f, 0.0) for f in sorted(word_features(word)))
        return out


@dataclass
class NoisyOr:
    """Sentence logits are sums of word weights; a document is toxic if any of
    its sentences is."""

    weights: dict[int, float]
    bias: float

    def scorer(self) -> _Scores:
        return _Scores(self.weights)

    def sentence_logits(self, counts: np.ndarray, words: list[bytes], scores: _Scores) -> np.ndarray:
        if not len(counts):
            return np.empty(0)
        each = np.fromiter(map(scores.__getitem__, words), np.float64, len(words))
        return np.add.reduceat(each, _starts(counts)) + self.bias

    def score(self, logits: np.ndarray) -> float:
        """1 - product of (1 - p): 0 for a text without words."""
        return float(-np.expm1(-_softplus(logits).sum())) if len(logits) else 0.0


def fit(examples: DataFrame, epochs: int = 400, rate: float = 0.3, damping: float = 1e-3, decay: float = 1e-5,
        least_z: float = 3.0) -> NoisyOr:
    """Trained on (text, grade 0/1), a bounded sample: AdaGrad on the noisy-or
    likelihood of the documents' labels, damped so that features of few
    documents hardly move.  Without examples all weights are 0."""
    return fit_rows(examples.toArrow().to_pylist(), epochs, rate, damping, decay, least_z)


def fit_rows(rows: list[dict], epochs: int, rate: float, damping: float, decay: float, least_z: float) -> NoisyOr:
    rows = sorted(rows, key=lambda r: (r["text"] or "", r["grade"]))
    numbers: dict[bytes, int] = {}
    grade, counts, words = [], [], []
    for row in rows:
        _, own, found = sentences(row["text"])
        if len(own):
            grade.append(float(row["grade"]))
            counts.append(own)
            words.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int32, len(found)))
    if not grade:
        return NoisyOr({}, -5.0)
    of_word = [word_features(w) for w in numbers]
    size = np.array([len(f) for f in of_word])
    flat = np.fromiter((i for f in of_word for i in f), np.int32, int(size.sum()))
    first = _starts(size)
    del of_word
    grade, per_doc = np.array(grade), np.array([len(c) for c in counts])
    counts, words = np.concatenate(counts), np.concatenate(words)

    # only features whose odds differ between the two kinds of documents
    seen, at = np.zeros((2, DIMENSIONS), np.float32), 0
    ends = np.cumsum(np.add.reduceat(counts, _starts(per_doc)))
    for end, g in zip(ends.tolist(), grade.tolist(), strict=True):
        own = np.unique(words[at:end])
        seen[int(g > 0), np.concatenate([flat[first[w]:first[w] + size[w]] for w in own])] += 1
        at = end
    used = np.flatnonzero(seen.sum(axis=0) > 1)
    seen = seen[:, used].astype(np.float64)
    kinds = np.array([[np.sum(grade <= 0)], [np.sum(grade > 0)]])
    odds = np.log((seen + 0.5) / (kinds - seen + 0.5))
    telling = used[np.abs(odds[1] - odds[0]) >= least_z * np.sqrt((1 / (seen + 0.5)).sum(axis=0))]
    kept = np.isin(flat, telling)
    feature, owner = np.searchsorted(telling, flat[kept]), np.repeat(np.arange(len(size)), size)[kept]
    live = np.isin(words, owner)
    sentence_of, words = np.repeat(np.arange(len(counts)), counts)[live], words[live]

    weights, bias = np.zeros(len(telling)), -5.0
    square, bias_square = np.full(len(telling), damping ** 2), damping ** 2
    for _ in range(epochs):
        by_word = np.bincount(owner, weights[feature], len(size))
        z = np.bincount(sentence_of, by_word[words], len(counts)) + bias
        total = np.add.reduceat(_softplus(z), _starts(per_doc))
        outer = np.where(grade > 0, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0)
        pull = np.repeat(outer, per_doc) * _sigmoid(z) / len(grade)
        on_words = np.bincount(words, pull[sentence_of], len(size))
        gradient = np.bincount(feature, on_words[owner], len(telling)) + decay * weights
        square += gradient ** 2
        weights -= rate * gradient / np.sqrt(square)
        bias_square += pull.sum() ** 2
        bias -= rate * pull.sum() / np.sqrt(bias_square)
    return NoisyOr(dict(zip(telling.tolist(), weights.tolist(), strict=True)), float(bias))


def score_toxicity(docs: DataFrame, model: NoisyOr, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id, score (0 to 1) and ``offending``, the byte
    spans (start, end, score) of sentences that score ``threshold`` or more.

    Null and empty texts and texts without words score 0 and offend nowhere.
    Rows repeated under one doc_id are scored each; an empty table gives an
    empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = m.scorer()
        for b in by_bytes(batches):
            scores, found = [], []
            for text in b.column("text").to_pylist():
                where, counts, words = sentences(text)
                z = m.sentence_logits(counts, words, cache)
                scores.append(m.score(z))
                p = _sigmoid(z)
                found.append([{"start": int(where[i, 0]), "end": int(where[i, 1]), "score": float(p[i])}
                              for i in np.flatnonzero(p >= threshold)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64()), pa.array(found, spans)],
                                             ["doc_id", "score", "offending"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, offending array<struct<start:long,end:long,score:double>>")


def keep_clean(docs: DataFrame, model: NoisyOr, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = m.scorer()
        for b in by_bytes(batches):
            scores = [m.score(m.sentence_logits(*sentences(t)[1:], cache)) for t in b.column("text").to_pylist()]
            yield b.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
