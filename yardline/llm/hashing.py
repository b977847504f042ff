"""Hashes of words and word shingles of many texts, by array operations in 64-bit arithmetic."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers, the same on every machine."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_MULTIPLIER) + np.uint64(seed))


_BYTE = numbers(256, 1)
_powers: dict[str, np.ndarray] = {}


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, kept by each worker."""
    if not _powers or len(_powers["up"]) < count:
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(count, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:count], _powers["down"][:count]


class Slices:
    """Hashes of any slices of a byte array, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self._down = powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:-1], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix(raw + (end - start).astype(np.uint64))


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _pieces(texts: list[str]) -> Iterator[tuple[int, bytes]]:
    """Texts as bytes, long ones cut at white space."""
    for k, text in enumerate(texts):
        data = text.encode()
        while len(data) > PIECE_BYTES:
            cut = max(data.rfind(c, 0, PIECE_BYTES) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= 0:
                cut = min((i for c in b" \n\t\r\x0b\x0c" if (i := data.find(c, 1)) > 0), default=len(data))
            yield k, data[:cut]
            data = data[cut:]
        yield k, data


def word_hashes(texts: list[str]) -> Iterator[np.ndarray]:
    """For each text the hashes of its words, A-Z taken as a-z."""

    def flush(batch: list[tuple[int, bytes]], done: dict[int, list[np.ndarray]]) -> None:
        data = np.frombuffer(b" ".join([d for _, d in batch]), np.uint8)
        inside = np.concatenate([[False], ~_SEPARATOR[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        found = Slices(_LOWER[data])(start, end)
        size = np.array([len(d) + 1 for _, d in batch])
        border = np.searchsorted(start, np.concatenate([[0], np.cumsum(size)]))
        for (k, _), a, b in zip(batch, border[:-1], border[1:], strict=True):
            done[k].append(found[a:b])

    with np.errstate(over="ignore"):
        done: dict[int, list[np.ndarray]] = {k: [] for k in range(len(texts))}
        batch: list[tuple[int, bytes]] = []
        total, following = 0, 0
        for k, data in _pieces(texts):
            batch.append((k, data))
            total += len(data)
            if total >= PIECE_BYTES:
                flush(batch, done)
                batch, total = [], 0
                while following < k:
                    yield np.concatenate(done.pop(following))
                    following += 1
        if batch:
            flush(batch, done)
        while following < len(texts):
            yield np.concatenate(done.pop(following))
            following += 1


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; of all words together where fewer."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        width = min(size, len(words))
        n = len(words) - width + 1
        run = np.full(n, width, np.uint64)
        for k in range(width):
            run = run * np.uint64(_MULTIPLIER) + words[k : k + n]
        return np.unique(mix(run))
