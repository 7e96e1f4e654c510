"""Byte-level BPE over whole columns: a vectorised pre-tokeniser, a table of
words already encoded, and a pair occurrence index that encodes new words."""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import by_bytes

#: Classes of code points: white space, letter, number, other, end of text, special token.
SPACE, LETTER, NUMBER, OTHER, END, SPECIAL = range(6)
END_POINT, SPECIAL_POINT = 0x110000, 0x110001
_NO_RANK = 1 << 30


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Vocabulary:
    """Merges, ids and bytes of a byte-level BPE file of the tokenizers library."""

    byte_id: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    left: np.ndarray
    right: np.ndarray
    made: np.ndarray
    token_bytes: list[bytes]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        chars = byte_alphabet()
        back = {c: b for b, c in chars.items()}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *special.values()]) + 1
        token_bytes = [b""] * size
        for token, i in ids.items():
            token_bytes[i] = bytes(back[c] for c in token)
        for token, i in special.items():
            token_bytes[i] = token.encode()
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        keys = (left << 20) | right
        order = np.argsort(keys)
        return cls(np.array([ids[chars[b]] for b in range(256)], np.int64), keys[order], order, left, right, made,
                   token_bytes, special)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a << 20) | b
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NO_RANK)


def encode_words(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and each word's count of ids.

    All words lie in one array.  An index maps each pair that has a merge to
    the positions where it occurs; ranks are applied in ascending order, each
    to all its occurrences at once (overlaps of equal symbols from the left),
    and the pairs that a merge makes join the lists of their own ranks, which
    are always later ones.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64), np.zeros(len(words), np.int64)
    ids = np.empty(total + 1, np.int64)
    ids[:total] = vocab.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    ids[total] = -1
    last = np.cumsum(sizes)[sizes > 0] - 1
    after = np.arange(1, total + 2)
    after[last] = total
    after[total] = total
    before = np.arange(-1, total)
    before[np.append(0, last[:-1] + 1)] = total
    before = np.append(before, total)

    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(positions: np.ndarray) -> None:
        positions = positions[after[positions] != total]
        if not len(positions):
            return
        ranks = vocab.ranks(ids[positions], ids[after[positions]])
        has = ranks < _NO_RANK
        positions, ranks = positions[has], ranks[has]
        if not len(positions):
            return
        if len(positions) > 1:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            firsts = [0, *cuts.tolist()]
            pieces = zip(ranks[firsts].tolist(), firsts, [*firsts[1:], len(ranks)], strict=True)
        else:
            pieces = [(int(ranks[0]), 0, 1)]
        for rank, i, j in pieces:
            if rank in index:
                index[rank].append(positions[i:j])
            else:
                index[rank] = [positions[i:j]]
                heapq.heappush(active, rank)

    add(np.arange(total))
    merged = np.zeros(total + 1, bool)
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        a, b, new = vocab.left[rank], vocab.right[rank], vocab.made[rank]
        at = at[(ids[at] == a) & (ids[after[at]] == b)]
        if not len(at):
            continue
        if a == b:
            at = np.unique(at)
            chained = np.append(False, after[at[:-1]] == at[1:])
            place = np.arange(len(at))
            head = np.maximum.accumulate(np.where(chained, 0, place))
            at = at[(place - head) % 2 == 0]
        gone = after[at]
        then = after[gone]
        ids[at] = new
        ids[gone] = -1
        after[at] = then
        before[then] = at
        merged[at] = True
        prior = before[at]
        prior = prior[(prior != total) & ~merged[prior]]
        merged[at] = False
        add(np.concatenate([at, prior]))
    alive = ids[:total] >= 0
    counts = np.zeros(len(words), np.int64)
    ends = np.cumsum(sizes)
    live = np.append(0, np.cumsum(alive))
    counts = live[ends] - live[ends - sizes]
    return ids[:total][alive], counts


#: Unicode white space: fixed values.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def class_table(path: str) -> np.ndarray:
    """The class of every code point, as the splitting pattern of ``path`` sees it.

    Python's and regex's character data are of different Unicode versions;
    where they disagree, the splitter of the vocabulary file itself decides.
    """
    table = np.full(END_POINT + 2, OTHER, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    initial = {"L": LETTER, "N": NUMBER}
    table[points] = [initial.get(unicodedata.category(chr(c))[0], OTHER) for c in points]
    newer = np.full_like(table, OTHER)
    every = "".join(map(chr, points))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        newer[[ord(c) for c in regex.findall(pattern, every)]] = kind
    unsure = np.flatnonzero(newer != table)
    if len(unsure):
        splitter = Tokenizer.from_file(path).pre_tokenizer
        for c in unsure.tolist():
            pieces = [len(splitter.pre_tokenize_str(x + chr(c))) for x in "a1!"] if c < 0x110000 else [2, 2, 1]
            table[c] = (LETTER, NUMBER, OTHER)[pieces.index(1)]
    table[WHITE] = SPACE
    table[END_POINT], table[SPECIAL_POINT] = END, SPECIAL
    return table


def word_starts(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where words begin: contractions, runs of letters, numbers or others with
    one space before them, and white space, whose last character goes with
    what follows if it is a space."""
    kinds = table[points]
    prior = np.empty_like(kinds)
    prior[0], prior[1:] = END, kinds[:-1]
    follow = np.empty_like(kinds)
    follow[-1], follow[:-1] = END, kinds[1:]
    start = (kinds != prior) | (kinds >= END)
    last_space = (kinds == SPACE) & (follow >= LETTER) & (follow <= OTHER)
    start |= last_space
    joined = np.flatnonzero(last_space & (points == 0x20))
    start[joined + 1] = False
    marks = np.flatnonzero((points == 0x27) & start)
    if len(marks):
        padded = np.append(points, np.array([END_POINT, END_POINT], points.dtype))
        c1, c2 = padded[marks + 1], padded[marks + 2]
        one = np.isin(c1, [ord(c) for c in "stmd"])
        two = np.zeros(len(marks), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (c1 == ord(x)) & (c2 == ord(y))
        size = np.where(one, 2, np.where(two, 3, 0))
        marks, size = marks[size > 0], size[size > 0]
        start[marks + 1] = False
        ends = marks + size
        start[ends[ends < len(start)]] = True
    return start


class WordTable:
    """Words seen so far and their ids.  New words wait until ``settle``, so
    that one index encodes all that a run of texts has gathered."""

    SLOTS = 1 << 20
    #: Beyond so many words or letters the table starts anew, which bounds a worker's memory.
    MOST, MOST_LETTERS = 200_000, 1 << 23

    def __init__(self, path: str, keep_special: bool = True):
        self.vocab = Vocabulary.load(path)
        self.special = dict(self.vocab.special) if keep_special else {}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
                                   ) if self.special else None
        self.table = class_table(path)
        rng = np.random.default_rng(20240501)
        self.values = rng.integers(0, 1 << 63, END_POINT + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.unbase = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self.powers = self.unpowers = np.ones(1, np.uint64)
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.pending: list[bytes] = []
        self.flat = np.empty(1 << 16, np.int32)
        self.used = 0
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int32)
        self.words = 0
        self.slot_key = np.zeros(self.SLOTS, np.uint64)
        self.slot_word = np.full(self.SLOTS, -1, np.int32)
        self.letters = np.empty(1 << 16, np.uint32)  # of all words, one after another
        self.place = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.written = 0
        self.odd: dict[bytes, int] = {}  # words whose key another word has

    def _powers(self, n: int) -> None:
        if len(self.powers) < n:
            full = np.full(max(n, 1 << 16), self.base)
            full[0] = 1
            self.powers = np.cumprod(full, dtype=np.uint64)
            full = np.full(max(n, 1 << 16), self.unbase)
            full[0] = 1
            self.unpowers = np.cumprod(full, dtype=np.uint64)

    def _points(self, texts: list[str]) -> np.ndarray:
        end = np.array([END_POINT], np.uint32)
        out = []
        for text in texts:
            if self.split is not None and self.split.search(text):
                for piece in self.split.split(text):
                    if piece in self.special:
                        out.append(np.array([SPECIAL_POINT + 1 + self.special[piece]], np.uint32))
                    elif piece:
                        out.append(np.frombuffer(piece.encode("utf-32-le"), np.uint32))
            elif text:
                out.append(np.frombuffer(text.encode("utf-32-le"), np.uint32))
            out.append(end)
        return np.concatenate(out)

    def _register(self, spans: list[np.ndarray]) -> None:
        """The letters of new words, numbered on from the last one; they wait to be encoded."""
        first = self.words + len(self.pending)
        sizes = np.array([len(x) for x in spans], np.int64)
        n, m = first + len(spans), self.written + int(sizes.sum())
        if n > len(self.place):
            self.place, self.length = np.resize(self.place, 2 * n), np.resize(self.length, 2 * n)
        if m > len(self.letters):
            self.letters = np.resize(self.letters, 2 * m)
        self.letters[self.written:m] = np.concatenate(spans)
        self.place[first:n] = self.written + np.cumsum(sizes) - sizes
        self.length[first:n] = sizes
        self.written = m
        for span in spans:
            special = int(span[0]) - (SPECIAL_POINT + 1)
            self.pending.append(-1 - special if special >= 0 else span.astype("<u4").tobytes().decode("utf-32-le").encode())

    def _compared(self, numbers: np.ndarray, raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The word numbers that the keys gave, put right where the letters differ."""
        size = stop - start
        wrong = self.length[numbers] != size
        if wrong.any():
            numbers = numbers.copy()
            numbers[wrong] = -1
        same = np.flatnonzero(~wrong)
        sizes = size[same]
        ends = np.cumsum(sizes)
        if len(same):
            step = np.arange(ends[-1])
            own = raw[np.repeat(start[same] - ends + sizes, sizes) + step]
            known = self.letters[np.repeat(self.place[numbers[same]] - ends + sizes, sizes) + step]
            differs = np.flatnonzero(own != known)
            wrong[same[np.unique(np.searchsorted(ends, differs, "right"))]] = True
        for i in np.flatnonzero(wrong).tolist():
            span = raw[start[i]:stop[i]]
            word = span.tobytes()
            if word not in self.odd:
                self.odd[word] = self.words + len(self.pending)
                self._register([span])
            numbers[i] = self.odd[word]
        return numbers

    def look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts one after another, and how many each text has.

        A 64-bit key finds a word's number; the words' letters are then
        compared, since keys of different words may be equal."""
        raw = self._points(texts)
        points = np.minimum(raw, SPECIAL_POINT)
        start = np.flatnonzero(word_starts(points, self.table))
        stop = np.append(start[1:], len(points))
        self._powers(len(points) + 1)
        sums = np.empty(len(points) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.values[points] * self.powers[:len(points)], out=sums[1:])
        keys = _mix((sums[stop] - sums[start]) * self.unpowers[start] + (stop - start).astype(np.uint64))
        del sums
        ends = points[start] == END_POINT
        special = np.flatnonzero(points[start] == SPECIAL_POINT)
        keys[special] = _mix(~raw[start[special]].astype(np.uint64))
        slots = (keys >> np.uint64(44)).astype(np.int64)
        numbers = self.slot_word[slots]
        miss = np.flatnonzero(((self.slot_key[slots] != keys) | (numbers < 0)) & ~ends)
        if len(miss):
            new, first, inverse = np.unique(keys[miss], return_index=True, return_inverse=True)
            found, spans = np.empty(len(new), np.int32), []
            known, after = self.known, self.words + len(self.pending)
            for i, (key, at) in enumerate(zip(new.tolist(), miss[first].tolist(), strict=True)):
                number = known.get(key)
                if number is None:
                    number = known[key] = after + len(spans)
                    spans.append(raw[start[at]:stop[at]])
                found[i] = number
            if spans:
                self._register(spans)
            numbers[miss] = found[inverse]
            self.slot_key[slots[miss]] = keys[miss]
            self.slot_word[slots[miss]] = numbers[miss]
        per_text = np.diff(np.append(-1, np.flatnonzero(ends))) - 1
        return self._compared(numbers[~ends], raw, start[~ends], stop[~ends]), per_text

    def settle(self) -> None:
        """Encode the words that wait."""
        if not self.pending:
            return
        special = [(i, -1 - w) for i, w in enumerate(self.pending) if isinstance(w, int)]
        flat, count = encode_words([b"" if isinstance(w, int) else w for w in self.pending], self.vocab)
        for i, token in reversed(special):
            at = int(count[:i].sum())
            flat, count[i] = np.insert(flat, at, token), 1
        n, m = self.words + len(count), self.used + len(flat)
        if n > len(self.first):
            self.first = np.resize(self.first, 2 * n)
            self.count = np.resize(self.count, 2 * n)
        if m > len(self.flat):
            self.flat = np.resize(self.flat, 2 * m)
        self.first[self.words:n] = self.used + np.cumsum(count) - count
        self.count[self.words:n] = count
        self.flat[self.used:m] = flat
        self.words, self.used, self.pending = n, m, []

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of these words, one after another."""
        counts = self.count[numbers]
        ends = np.cumsum(counts, dtype=np.int64)
        if not len(ends):
            return np.empty(0, np.int32)
        return self.flat[np.repeat(self.first[numbers] - ends + counts, counts) + np.arange(ends[-1])]


_TABLES: dict[tuple[str, bool], WordTable] = {}


def word_table(path: str, keep_special: bool = True) -> WordTable:
    """One table a worker process, kept between tasks."""
    if (path, keep_special) not in _TABLES:
        _TABLES[path, keep_special] = WordTable(path, keep_special)
    return _TABLES[path, keep_special]


#: A word ends between these two characters, whatever stands around them.
_SEAM = regex.compile(r"[A-Za-z](?=[ \n])")


def cut_at_words(text: str, most: int) -> Iterator[str]:
    """A long text in parts of about ``most`` characters that are tokenised
    apart: each ends with a letter and the next begins with a blank."""
    at = 0
    while len(text) - at > most:
        seam = _SEAM.search(text, at + most - 1)
        if seam is None:
            break
        yield text[at:seam.end()]
        at = seam.end()
    yield text[at:] if at else text


def encoded(rows: Iterator[tuple[object, str | None]], path: str, keep_special: bool = True,
            chunk: int = 125_000, most: int = 250_000, kept: int = WordTable.MOST) -> Iterator[tuple[object, np.ndarray]]:
    """(key, ids) of every (key, text), in order; a null text is empty.

    Texts are looked up in chunks of about ``chunk`` characters, longer texts
    in several parts (a run of more characters without a letter before a
    blank is one part); when about ``most`` words wait, or the partition
    ends, the new ones are encoded.
    """
    table = word_table(path, keep_special)
    keys, texts, size = [], [], 0
    waiting: list[tuple[list, np.ndarray, np.ndarray]] = []
    words = 0
    begun: list[np.ndarray] = []

    def gather():
        nonlocal keys, texts, size, words
        numbers, per_text = table.look_up(texts)
        waiting.append((keys, numbers, per_text))
        words += len(numbers)
        keys, texts, size = [], [], 0

    def release():
        nonlocal words
        table.settle()
        for own, numbers, per_text in waiting:
            at = 0
            for (key, ended), n in zip(own, per_text.tolist(), strict=True):
                ids = table.ids(numbers[at:at + n])
                at += n
                if not ended:
                    begun.append(ids)
                elif begun:
                    yield key, np.concatenate([*begun, ids])
                    begun.clear()
                else:
                    yield key, ids
        waiting.clear()
        words = 0
        if table.words > kept or table.written > table.MOST_LETTERS:
            table.clear()

    for key, text in rows:
        parts = [text or ""] if len(text or "") <= chunk else list(cut_at_words(text, chunk))
        for i, part in enumerate(parts, 1):
            keys.append((key, i == len(parts)))
            texts.append(part)
            size += len(part)
            if size >= chunk:
                gather()
                if words >= most:
                    yield from release()
    if texts:
        gather()
    yield from release()
    table.clear()  # a worker that waits for its next task holds no words


def decode(ids: list[int], token_bytes: list[bytes]) -> str:
    return b"".join([token_bytes[i] for i in ids]).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str, derive: Callable[[int, np.ndarray, Vocabulary], tuple] | None = None,
                     schema: str = "ids array<int>") -> DataFrame:
    """doc_id and the ids of every whole text, or what ``derive`` makes of
    (doc_id, ids, vocabulary): the columns of ``schema``.

    One row per row of ``docs``, repeated rows included; null and empty texts
    have no ids; other columns are not read.  An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = word_table(path).vocab
        make = derive or (lambda key, ids, vocab: (ids.tolist(),))
        rows = ((k, t) for b in by_bytes(batches) for k, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(),
                                                          strict=True))
        out: list[tuple] = []
        for key, ids in encoded(rows, path):
            out.append((key, *make(key, ids, vocab)))
            if len(out) >= 2000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _batch(rows):
        target = pa.schema(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)],
                                          schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string
    kind = StructType([docs.schema["doc_id"], *_parse_datatype_string(schema).fields])
    arrow = list(to_arrow_schema(kind))
    return docs.select("doc_id", "text").mapInArrow(run, kind)


def digests(key, ids: np.ndarray, vocab: Vocabulary) -> tuple[int, str, str]:
    """Count and SHA-256 of the ids, and SHA-256 of the text they decode to."""
    listed = ids.tolist()
    text = decode(listed, vocab.token_bytes)
    return (len(listed), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())
