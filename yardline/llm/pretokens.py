"""Byte-level BPE's pre-tokens of many texts at once, by array operations.

The published split pattern of byte-level BPE is a matter of four character classes
(letters, numbers, white space, others) and of the English contractions, so the starts of all
pre-tokens follow from comparing each character's class with its neighbours'.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, compress

import numpy as np
import regex
from tokenizers import pre_tokenizers

LETTER, NUMBER, OTHER, SPACE = range(4)
#: Code points handled at once; bounds the memory of a task whatever the length of its texts.
PIECE_CHARS = 1 << 18
#: Words of a generation that a worker remembers; it holds two.
MAX_WORDS = 60_000
#: Bytes of a word that is handled as two numbers.
_SHORT = 15

_classes: np.ndarray | None = None


def character_classes() -> np.ndarray:
    """Class of every code point, built once in a process; workers get it from the driver as runs.

    The library's own byte-level splitter tells where classes change in the row of all code
    points, so both follow one version of Unicode.
    """
    global _classes
    if _classes is None:
        split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        points = np.array([i for i in range(0x110000) if i != 32 and not 0xD800 <= i < 0xE000])
        table = np.full(0x110000, OTHER, np.uint8)
        for _, (a, b) in split("".join(map(chr, points))):
            c = chr(points[a])
            kind = LETTER if len(split("x" + c)) == 1 else NUMBER if len(split("1" + c)) == 1 else OTHER
            table[points[a:b]] = SPACE if kind == OTHER and len(split("!" + c)) > 1 else kind
        table[32] = SPACE
        _classes = table
    return _classes


def class_runs() -> tuple[np.ndarray, np.ndarray]:
    """The table of classes as runs (first code point, class): small enough to go to workers with their code."""
    table = character_classes()
    first = np.flatnonzero(np.concatenate([[True], table[1:] != table[:-1]])).astype(np.int32)
    return first, table[first]


def use_class_runs(runs: tuple[np.ndarray, np.ndarray]) -> None:
    """Take the table from its runs, unless this worker has it."""
    global _classes
    if _classes is None:
        first, kind = runs
        _classes = np.repeat(kind, np.diff(np.append(first, 0x110000)))


def pieces(text: str, special: tuple[str, ...], size: int = PIECE_CHARS) -> Iterator[tuple[str, bool]]:
    """Parts of a text whose pre-tokens do not depend on each other, and whether one is special.

    Cuts lie at special tokens and, in long texts, between a character and white space after it.
    """
    parts = re.split("(" + "|".join(map(re.escape, special)) + ")", text) if any(s in text for s in special) else [text]
    for k, part in enumerate(parts):
        if k % 2 or len(part) <= size:
            if part:
                yield part, bool(k % 2)
            continue
        at = 0
        cut = regex.compile(r"(?<=\P{White_Space})\p{White_Space}")
        while at < len(part):
            found = cut.search(part, at + size) if len(part) - at > size else None
            end = found.start() if found else len(part)
            yield part[at:end], False
            at = end


def token_starts(codes: np.ndarray, first: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where pre-tokens start (code point indices).

    ``codes``: code points of all pieces, one after the other; ``first``: where pieces start;
    ``whole``: for each piece, whether it is one token as it stands.
    """
    n = len(codes)
    kind = character_classes()[codes]
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    begins[n] = True
    run = begins.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    blank = codes == 32
    starts = run[:n].copy()
    # What follows a blank takes it along; the last character of white space stands alone.
    after = np.flatnonzero(run[1:n] & (kind[:-1] == SPACE) & ~begins[1:n])
    starts[after] = True
    starts[after[blank[after]] + 1] = False
    quotes = np.flatnonzero(codes == 39)
    quotes = quotes[starts[quotes] & run[quotes + 1] & ~begins[quotes + 1]]
    if len(quotes):
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ~begins[np.minimum(quotes + 2, n)] & (
            ((two == ord("e")) & ((one == ord("r")) | (one == ord("v"))))
            | ((one == ord("l")) & (two == ord("l")))
        )
        hit = single | double
        at = quotes[hit]
        ends = at + np.where(single[hit], 2, 3)
        starts[at + 1] = False
        inside = ends < n
        starts[ends[inside]] = True
    if whole.any():
        last = np.append(first[1:], n)
        for a, b in zip(first[whole], last[whole], strict=True):
            starts[a + 1 : b] = False
    return np.flatnonzero(starts)


class ShortWords:
    """Rows of words of up to ``_SHORT`` bytes, each given as two numbers that spell it, found by sorted keys of these."""

    def __init__(self) -> None:
        self.keys, self.low, self.high = (np.zeros(0, np.uint64) for _ in range(3))
        self.order, self.rows = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def find(self, key: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows of the words, -1 for those not held. Of words that share a key only one may be found."""
        if not len(self.keys):
            return np.full(len(key), -1)
        at = self.order[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)]
        return np.where((self.low[at] == low) & (self.high[at] == high), self.rows[at], -1)

    def add(self, key: np.ndarray, low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> None:
        """Hold more words, in ascending order of their keys."""
        at = np.searchsorted(self.keys, key)
        self.order = np.insert(self.order, at, np.arange(len(self.rows), len(self.rows) + len(key)))
        self.keys = np.insert(self.keys, at, key)
        self.low, self.high = np.concatenate([self.low, low]), np.concatenate([self.high, high])
        self.rows = np.concatenate([self.rows, rows])


class WordTable:
    """Token ids of the words seen by this worker, at most ``max_words`` of them in each of two generations.

    A full generation becomes the earlier one: words that are met again come back from it without being
    encoded, and the others go with the next. Short words come as numbers and are looked up by arrays, so
    that only those not seen before become Python objects.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], max_words: int = MAX_WORDS):
        self.encode, self.max_words = encode, max_words
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.short = ShortWords()
        self.start = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)
        self._earlier = self.place, self.short, self.start, self.ids

    def turn(self) -> None:
        """Begin a new generation if this one is full; rows found before no longer hold then."""
        if len(self.start) - 1 > self.max_words:
            full = self.place, self.short, self.start, self.ids
            self.clear()
            self._earlier = full

    def places(self, words: list[bytes]) -> np.ndarray:
        """Rows of the words (which must be distinct or few), after encoding those not seen before."""
        self.turn()
        return self.long_places(words)

    def long_places(self, words: list[bytes]) -> np.ndarray:
        """``places`` in the present generation."""
        place = self.place
        found = list(map(place.get, words))
        if None in found:
            missing = list(dict.fromkeys(compress(words, [row is None for row in found])))
            before = list(map(self._earlier[0].get, missing))
            known = [w for w, row in zip(missing, before, strict=True) if row is not None]
            new = [w for w, row in zip(missing, before, strict=True) if row is None]
            rows = [*self._again(np.array([row for row in before if row is not None], np.int64)), *self._encoded(new)]
            place.update(zip(known + new, map(int, rows), strict=True))
            found = list(map(place.__getitem__, words))
        return np.array(found, np.int64)

    def short_places(
        self, key: np.ndarray, low: np.ndarray, high: np.ndarray, spelled: Callable[[np.ndarray], list[bytes]]
    ) -> np.ndarray:
        """Rows, in the present generation, of distinct short words in ascending order of their keys."""
        rows = self.short.find(key, low, high)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            before = self._earlier[1].find(key[missing], low[missing], high[missing])
            known, new = missing[before >= 0], missing[before < 0]
            rows[known] = self._again(before[before >= 0])
            rows[new] = self._encoded(spelled(new))
            self.short.add(key[missing], low[missing], high[missing], rows[missing])
        return rows

    def _again(self, rows: np.ndarray) -> np.ndarray:
        """New rows with the ids of rows of the earlier generation."""
        _, _, start, ids = self._earlier
        sizes = start[rows + 1] - start[rows]
        return self._add(ids[ragged(start[rows], sizes)], sizes)

    def _encoded(self, words: list[bytes]) -> np.ndarray:
        coded = self.encode(words) if words else []
        sizes = np.array(list(map(len, coded)), np.int64)
        return self._add(np.fromiter(chain.from_iterable(coded), np.int32, int(sizes.sum())), sizes)

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        at = len(self.start) - 1
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        return np.arange(at, at + len(sizes))


def _masks() -> np.ndarray:
    return np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _word_places(data: bytes, at: np.ndarray, size: np.ndarray, table: WordTable) -> np.ndarray:
    """Rows of ``table`` for the words at the given bytes; equal short words are found by sorting.

    A short word is two numbers: its first eight bytes, and its others below its length.
    """
    buffer = np.frombuffer(data + bytes(_SHORT + 9), np.uint8)
    eight = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    masks = _masks()
    known = np.minimum(size, _SHORT + 1)
    low = eight[at] & masks[np.minimum(known, 8)]
    high = eight[at + 8] & masks[np.clip(known - 8, 0, 7)] | known.astype(np.uint64) << np.uint64(56)
    with np.errstate(over="ignore"):
        key = low * np.uint64(0x9E3779B97F4A7C15) ^ (high ^ high >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(key)
    key, low, high = key[order], low[order], high[order]
    is_long = known[order] > _SHORT
    first = is_long.copy()
    first[:1] = True
    first[1:] |= (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    one = np.flatnonzero(first)
    is_long = is_long[one]
    rows = np.zeros(len(one), np.int64)

    def spelled(some: np.ndarray) -> list[bytes]:
        where = order[some]
        return [data[a : a + k] for a, k in zip(at[where].tolist(), size[where].tolist(), strict=True)]

    table.turn()
    plain = one[~is_long]
    rows[~is_long] = table.short_places(key[plain], low[plain], high[plain], lambda new: spelled(plain[new]))
    rows[is_long] = table.long_places(spelled(one[is_long]))
    result = np.empty(len(order), np.int64)
    result[order] = np.repeat(rows, np.diff(np.append(one, len(order))))
    return result


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0]+1, ... of all slices, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def encode_texts(
    texts: list[str], table: WordTable, special: tuple[str, ...] = (), at_once: int = PIECE_CHARS
) -> Iterator[np.ndarray]:
    """Token ids (int32) of each text in turn; special tokens are words of the table as well.

    ``at_once``: code points handled together, whose equal words are looked up once.
    """
    batch: list[tuple[int, str, bool]] = []
    chars = 0
    done: dict[int, list[np.ndarray]] = {}
    following = 0
    for k, text in enumerate(texts):
        done[k] = []
        for part, whole in pieces(text, special):
            batch.append((k, part, whole))
            chars += len(part)
            if chars >= at_once:
                _encode_pieces(batch, table, done)
                batch, chars = [], 0
                while following < k:
                    yield _joined(done.pop(following))
                    following += 1
    if batch:
        _encode_pieces(batch, table, done)
    while following < len(texts):
        yield _joined(done.pop(following))
        following += 1


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, np.int32)])


def _encode_pieces(batch: list[tuple[int, str, bool]], table: WordTable, done: dict[int, list[np.ndarray]]) -> None:
    text = "".join(part for _, part, _ in batch)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    lengths = np.array([len(part) for _, part, _ in batch], np.int64)
    first = np.cumsum(lengths) - lengths
    starts = token_starts(codes, first, np.array([whole for _, _, whole in batch]))
    data = text.encode()
    if len(data) == len(codes):
        at = starts
    else:
        width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        ends = np.cumsum(width, dtype=np.int64)
        at = ends[starts] - width[starts]
    size = np.diff(np.append(at, len(data)))
    rows = _word_places(data, at, size, table)
    begin = table.start[rows]
    count = table.start[rows + 1] - begin
    ids = table.ids[ragged(begin, count)]
    before = np.concatenate([[0], np.cumsum(count)])
    edge = before[np.append(np.searchsorted(starts, first), len(starts))]
    for (k, _, _), a, b in zip(batch, edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        done[k].append(ids[a:b])
