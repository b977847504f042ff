"""BPE encoding by speculation: propose greedily, verify pairs, merge only what fails.

Longest matches from left to right usually are what merging gives. A row of tokens is what merging
gives exactly if each token is merged to itself and no merge across any border between
neighbours comes before the merges that built them. The second test depends on the two
neighbours only, so it is made for all distinct pairs of a batch at once, by array operations on
the tokens' outer edges. Words with a failing pair are merged step by step.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm.pretokens import WordTable, class_runs, encode_texts, use_class_runs
from yardline.llm.text import map_batches, text_slices

#: Rank that no merge has.
NEVER = 1 << 30


def byte_alphabet() -> dict[str, int]:
    """Byte for each character of byte-level vocabularies.

    Printable Latin-1 stands for itself, the other bytes for code points from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        raw = {token: bytes(alphabet[c] for c in token) for token in model["vocab"] if all(c in alphabet for c in token)}
        ids = model["vocab"]
        added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.special = tuple(added)
        count = max([*ids.values(), *added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * count
        for token, i in ids.items():
            if token in raw:
                self.bytes_of[i] = raw[token]
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.special_id = {token.encode(): i for token, i in added.items()}
        self.base = {raw[t][0]: i for t, i in ids.items() if len(raw.get(t, b"")) == 1}
        self.left = np.full(count, -1, np.int64)
        self.right = np.full(count, -1, np.int64)
        self.rank = np.full(count, -1, np.int64)  # single bytes exist before any merge
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.single_way = True
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made, a, b = ids[a + b], ids[a], ids[b]
            self.merge[a, b] = rank, made
            self.single_way &= self.left[made] < 0
            self.left[made], self.right[made], self.rank[made] = a, b, rank
        # A part that is made later than its whole would upset the order of merges.
        whole = np.flatnonzero(self.left >= 0)
        self.single_way &= bool(
            np.all(self.rank[self.left[whole]] < self.rank[whole])
            and np.all(self.rank[self.right[whole]] < self.rank[whole])
        )
        keys = np.array([(a << 32) | b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ranks = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        # A token that merging its own bytes does not give can never be proposed.
        self.reachable = {
            b: i for i, b in enumerate(self.bytes_of)
            if b and (len(b) == 1 and self.base[b[0]] == i or self.left[i] >= 0 and self.merged(b) == [i])
        }
        self.longest = max(map(len, self.reachable))

    def merged(self, word: bytes) -> list[int]:
        """Ids by merging: lowest rank first, then leftmost."""
        ids = [self.base[b] for b in word]
        n = len(ids)
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        heap = [(self.merge[p][0], k) for k in range(n - 1) if (p := (ids[k], ids[k + 1])) in self.merge]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] < 0 or nxt < 0 or (found := self.merge.get((ids[k], ids[nxt]))) is None or found[0] != rank:
                continue
            ids[k], ids[nxt] = found[1], -1
            after[k] = after[nxt]
            if after[k] >= 0:
                before[after[k]] = k
                if (p := self.merge.get((ids[k], ids[after[k]]))) is not None:
                    heapq.heappush(heap, (p[0], k))
            if (b := before[k]) >= 0 and (p := self.merge.get((ids[b], ids[k]))) is not None:
                heapq.heappush(heap, (p[0], b))
        return [i for i in ids if i >= 0]

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of a and b together gives a, b.

        At any time the border lies between one part on the right edge of a and one on the left
        edge of b. A part lives from the merge that makes it to the one that takes it up. A merge
        across the border happens if it comes while both its parts live; among merges of one rank
        the leftmost comes first, so it must be before the one that takes up the left
        part, and not after the one that takes up the right part.
        """
        x, y = a.copy(), b.copy()
        x_end, y_end = np.full(len(a), NEVER), np.full(len(a), NEVER)
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            p, q = x[live], y[live]
            across = self.pair_rank(p, q)
            clash = (across < x_end[live]) & (across <= y_end[live]) & (across < NEVER)
            good[live[clash]] = False
            # Go back in time to the later of the two makings.
            rank_p, rank_q = self.rank[p], self.rank[q]
            open_p = (rank_p >= rank_q) & (rank_p >= 0)
            open_q = (rank_q > rank_p) & (rank_q >= 0)
            i, j = live[open_p], live[open_q]
            x_end[i], y_end[j] = self.rank[x[i]], self.rank[y[j]]
            x[i], y[j] = self.right[x[i]], self.left[y[j]]
            live = live[(open_p | open_q) & ~clash]
        return good

    def proposed(self, word: bytes) -> list[int]:
        """Longest matches from left to right."""
        ids, at, n, known = [], 0, len(word), self.reachable
        while at < n:
            end = min(n, at + self.longest)
            while (i := known.get(word[at:end])) is None:
                end -= 1
            ids.append(i)
            at = end
        return ids

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: proposals, of which those with a failing pair are merged instead."""
        special = self.special_id
        if not self.single_way:
            return [[special[w]] if w in special else self.merged(w) for w in words]
        coded = [[special[w]] if w in special else self.proposed(w) for w in words]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter((i for ids in coded for i in ids), np.int64, int(size.sum()))
        word = np.repeat(np.arange(len(coded)), size)
        inner = np.flatnonzero(word[1:] == word[:-1]) if len(word) else np.zeros(0, np.int64)
        pairs, back = np.unique((flat[inner] << 32) | flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back]
        for k in np.unique(word[inner[~good]]).tolist():
            coded[k] = self.merged(words[k])
        return coded

    def decoded(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text; bytes that are none become the replacement character."""
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        try:
            data.decode()
        except UnicodeDecodeError:
            data = data.decode(errors="replace").encode()
        return data


_workers: dict[str, tuple[Merges, WordTable]] = {}


def worker(path: str) -> tuple[Merges, WordTable]:
    """This Python worker's vocabulary and words, kept from task to task."""
    if path not in _workers:
        merges = Merges(path)
        _workers[path] = merges, WordTable(merges.encode_words)
    return _workers[path]


def encode(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", with_ids: bool = True, with_text: bool = False
) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256 and, as asked for, ids and decoded text.

    One pass over each partition, no shuffle. A null text counts as empty: no ids and the
    digests of nothing. Repeated rows give repeated results, null keys stay, empty tables give
    none; other columns are not read. Long texts go through in pieces. ``path``: vocabulary file,
    readable on each executor.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_text

    runs = class_runs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_class_runs(runs)
        merges, table = worker(path)
        for batch in (part for whole in batches for part in text_slices(whole, 1)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out: dict[str, list] = {"n": [], "ids": [], "sha": [], "dec": [], "decoded": []}
            for ids in encode_texts(texts, table, merges.special):
                data = merges.decoded(ids)
                out["n"].append(len(ids))
                out["sha"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                out["dec"].append(hashlib.sha256(data).hexdigest())
                if with_ids:
                    out["ids"].append(ids)
                if with_text:
                    out["decoded"].append(data.decode())
            columns = [batch.column(0), pa.array(out["n"], pa.int64()), pa.array(out["sha"], pa.string()), pa.array(out["dec"], pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
                names.append("ids")
            if with_text:
                columns.append(pa.array(out["decoded"], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")), run, schema)


def decode_texts(path: str) -> Callable[[list[np.ndarray]], list[str]]:
    """A decoder of id arrays, special tokens included."""
    merges, _ = worker(path)
    return lambda many: [merges.decoded(np.asarray(ids)).decode() for ids in many]
