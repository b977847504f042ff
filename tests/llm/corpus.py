"""Small tables with the awkward cases every operator must take, and plain versions to compare with."""

from __future__ import annotations

import random
import re

WORDS = "river stone cloud table under green maple early night seven quiet paper glass round field ocean torch lemon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, node string, d string, w string, seed string"


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "s", "ed", "ing", "er"]) for _ in range(n)) + "."


def documents() -> list[tuple]:
    """Copies, near copies, shared passages, empty, null, white-space, repeated and very long texts."""
    base, passage = prose(1, 120), prose(2, 60)
    changed = base.split(" ")
    changed[40] = "novelty"
    texts = [
        base, base, " ".join(changed), base.upper(), prose(3, 200), f"{prose(4, 80)} {passage} {prose(5, 30)}",
        f"{prose(6, 50)}\n{passage}\n{prose(7, 90)}", "", None, "   \n\t ", "one", "One", "two words", "déjà vu 漢字 😀 don't <|endoftext|> stop",
        "a b c " * 3000, prose(8, 9000), "x" * 700, f"{passage} {passage}", prose(9, 99), "line one is here\n" * 8, "\x00\x01 \x1f\x0b\x0c\r",
    ]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[4], (None, base, None, None, None), (None, None, None, None, None)]
    return [(*r, "a", "b", "c", "d", "e") for r in rows]


def table(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def shingles(text: str | None, size: int) -> frozenset:
    lowered = (text or "").translate({65 + i: 97 + i for i in range(26)})
    found = words(lowered)
    if not found:
        return frozenset()
    width = min(size, len(found))
    return frozenset(tuple(found[k : k + width]) for k in range(len(found) - width + 1))


def components(sets: dict, percent: int = 80) -> dict:
    """Smallest key reachable over links, by comparing all pairs."""
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def without_repeats(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """Removed bytes, removed runs and remaining bytes of texts in order."""
    seen, out = set(), []
    for data in texts:
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        runs = len(re.findall(b"\1+", bytes(gone)))
        left = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.append((len(data) - len(left), runs, left))
    return out
