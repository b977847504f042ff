"""Secrets in texts: three fixed patterns, and a linear-chain conditional random field over tokens.

A token is a run of letters, digits and joining marks, or a run of other marks. Each is tagged as a secret's
begin, its inside or outside. A tag's score is a sum over features of the token (its shape, its first
characters, itself), of the three words before it and the one after it, and of the text it stands in (how much of it is
assignments and numbers); neighbouring tags add theirs. The best sequence of tags is found by Viterbi's
recursion, run over fixed-size blocks of all texts of a batch at once: blocks' best scores between any
two tags are made first, then chained, then each block is traced back, so the result is that of one pass.

The model is trained here, on at most ``SAMPLE`` windows of ``WINDOW`` characters from the table. What the fixed
patterns find in them counts as secret; further secrets of many forms, with and without a name before
them, and look-alikes that are none (addresses, paths, versions, dates, long names) are planted by a fixed
generator. Weights maximise the likelihood of the tags, less a penalty on their squares.
"""

from __future__ import annotations

import base64
import random
import re
import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm.hashing import Slices
from yardline.llm.text import map_batches, text_slices

# The kinds, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ASSIGN_LEAST = 12
ACCESS = re.compile("AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile("[0-9a-f]{16,}")

#: Windows of the table that the model is trained on, and their characters.
SAMPLE = 1200
WINDOW = 400
TURNS = 60
PENALTY = 2e-4
#: Tokens of a training window, characters that features are made of at a time, tokens in a block of the decoder.
TRAIN_TOKENS = 128
PIECE = 1 << 19
DECODE_BLOCK = 128

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
OUT, BEGIN, INSIDE = 0, 1, 2
_NEVER = -1e6


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of each pattern that do not overlap, without those too short; code points, end exclusive."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


# --- tokens and features ------------------------------------------------------------------

_LOWER, _UPPER, _DIGIT, _JOIN, _OTHER, _MARK, _SPACE = range(7)
_CLASS = np.full(128, _MARK, np.uint8)
_CLASS[: 33] = _SPACE
_CLASS[127] = _SPACE
_CLASS[[ord(c) for c in string.ascii_lowercase]] = _LOWER
_CLASS[[ord(c) for c in string.ascii_uppercase]] = _UPPER
_CLASS[[ord(c) for c in string.digits]] = _DIGIT
_CLASS[[ord(c) for c in "+/_.-"]] = _JOIN
_WIDE_SPACES = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
_VOWEL = np.zeros(128, bool)
_VOWEL[[ord(c) for c in "aeiouyAEIOUY"]] = True

_LENGTHS = np.array([1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 40, 64])
_TURNS = np.array([1, 2, 3, 4, 6, 9, 14])
_WORD_BITS = 14
#: Values of each feature: shape by length; changes of class by length; shares; first characters; the word, the
#: three before it and the one after it; kind of text by strength of shape.
SIZES = (64 * 16, 8 * 16, 6 * 5 * 5, 1 << 10, *[1 << _WORD_BITS] * 5, 16 * 3)
_AT = np.concatenate([[0], np.cumsum(SIZES)])


@dataclass
class Tokens:
    """Tokens of several texts: text number, place in it, and feature values that need no neighbour."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    own: np.ndarray
    word: np.ndarray
    strong: np.ndarray
    sign: np.ndarray
    number: np.ndarray

    @staticmethod
    def joined(parts: Sequence[Tokens]) -> Tokens:
        return Tokens(*(np.concatenate([getattr(p, f) for p in parts]) for f in Tokens.__dataclass_fields__))


def _piece_tokens(texts: Sequence[str], numbers: Sequence[int], starts: Sequence[int]) -> Tokens:
    """Tokens of some pieces of texts, each with its text's number and its place there."""
    if not texts:
        none = np.zeros(0, np.int64)
        return Tokens(none, none, none, np.zeros((0, 4), np.int32), none.astype(np.int32), none, none > 0, none > 0)
    code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    small = np.minimum(code, 127)
    kind = np.where(code < 128, _CLASS[small], _OTHER)
    kind[np.isin(code, _WIDE_SPACES)] = _SPACE
    group = np.where(kind == _SPACE, 0, np.where(kind == _MARK, 1, 2)).astype(np.uint8)
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    after = np.append(edge[1:], len(code))
    inside = group[edge] > 0
    start, end = edge[inside], after[inside]

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return sums[end] - sums[start]

    counts = [total(kind == c) for c in range(6)]
    length = end - start
    turns = np.concatenate([[False], kind[1:] != kind[:-1]])
    changes = total(turns) - turns[start]
    vowels = total(_VOWEL[small] & (code < 128))
    letters = np.maximum(counts[_LOWER] + counts[_UPPER], 1)
    by_length = np.searchsorted(_LENGTHS, length, "right")
    shape = sum((counts[c] > 0).astype(np.int32) << c for c in range(6)) * 16 + by_length
    change = np.searchsorted(_TURNS, changes, "right") * 16 + by_length
    shares = (np.minimum(vowels * 6 // letters, 5) * 5 + np.minimum(counts[_UPPER] * 5 // letters, 4)) * 5
    shares = shares + np.minimum(counts[_DIGIT] * 5 // length, 4)

    low = np.where(kind == _UPPER, code + 32, code)
    data = ((low ^ (low >> 8) * 31) & 255).astype(np.uint8)
    with np.errstate(over="ignore"):
        slices = Slices(data)
        word = (slices(start, end) >> np.uint64(64 - _WORD_BITS)).astype(np.int32)
        head = (slices(start, np.minimum(end, start + 4)) >> np.uint64(54)).astype(np.int32)
    mixed = (counts[_DIGIT] > 0).astype(np.int32) + (counts[_UPPER] > 1) + (changes > 3)
    strong = np.where(length >= 8, np.minimum(mixed, 2), 0)
    sizes = np.array([len(t) + 1 for t in texts])
    begins = np.cumsum(sizes) - sizes
    which = np.searchsorted(begins, start, "right") - 1
    shift = np.array(starts, np.int64)[which] - begins[which]
    sign = (counts[_MARK] > 0) & np.isin(code[start], np.array([ord("="), ord(":")], np.uint32))
    return Tokens(
        np.array(numbers, np.int64)[which], start + shift, end + shift,
        np.stack([shape, change, shares, head], 1).astype(np.int32), word, strong, sign, counts[_DIGIT] > 0,
    )


def _pieces(texts: Sequence[str]) -> Iterator[tuple[list[str], list[int], list[int]]]:
    """Texts in groups of bounded size, long ones cut at white space, which no token holds."""
    some, numbers, starts, size = [], [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE)
            if end < len(text):
                cut = max(text.rfind(c, at + 1, end) for c in " \n\t")
                later = [i for c in " \n\t" if (i := text.find(c, end)) > 0]
                end = cut if cut > at else min(later, default=len(text))
            some.append(text[at:end])
            numbers.append(number)
            starts.append(at)
            size += end - at
            at = end
            if size >= PIECE:
                yield some, numbers, starts
                some, numbers, starts, size = [], [], [], 0
    if some:
        yield some, numbers, starts


def tokens(texts: Sequence[str]) -> Tokens:
    parts = [_piece_tokens(*piece) for piece in _pieces(texts)]
    return Tokens.joined(parts or [_piece_tokens([], [], [])])


def features(found: Tokens) -> np.ndarray:
    """Place of each feature's value in the weights, a row per token."""
    n = len(found.text)
    columns = [found.own[:, k] for k in range(4)]
    columns.append(found.word)
    for back in (1, 2, 3, -1):
        near = np.zeros(n, np.int32)
        if abs(back) < n:
            a, b = (slice(back, None), slice(None, -back)) if back > 0 else (slice(None, back), slice(-back, None))
            near[a] = np.where(found.text[a] == found.text[b], found.word[b], 0)
        columns.append(near)
    count = np.maximum(np.bincount(found.text, minlength=1), 1) if n else np.ones(1)
    signs = np.bincount(found.text, found.sign, minlength=1) / count
    numbers = np.bincount(found.text, found.number, minlength=1) / count
    file = np.searchsorted([0.005, 0.02, 0.08], signs, "right") * 4 + np.searchsorted([0.01, 0.05, 0.15], numbers, "right")
    columns.append(file[found.text] * 3 + found.strong)
    return np.stack(columns, 1) + _AT[:-1]


# --- the model ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Weights by feature value and tag, scores of neighbouring tags, scores of the first tag."""

    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def scores(self, places: np.ndarray) -> np.ndarray:
        total = np.zeros((len(places), 3), np.float32)
        for k in range(places.shape[1]):
            total += self.weights[places[:, k]]
        return total


def viterbi(model: Model, scores: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Best tags of sequences laid end to end; ``starts`` marks first tokens."""
    n = len(scores)
    if not n:
        return np.zeros(0, np.int8)
    blocks = -(-n // DECODE_BLOCK)
    full = blocks * DECODE_BLOCK
    score = np.zeros((full, 3), np.float64)
    score[:n] = scores
    fresh = np.zeros(full, bool)
    fresh[:n] = starts
    # Place in the block first, blocks last, so that every step is over whole arrays of blocks.
    score = np.ascontiguousarray(score.reshape(blocks, DECODE_BLOCK, 3).transpose(1, 2, 0))
    fresh = np.ascontiguousarray(fresh.reshape(blocks, -1).T)
    still = np.where(np.eye(3, dtype=bool), 0.0, -np.inf)
    left = n - (blocks - 1) * DECODE_BLOCK  # places of the last block that hold tokens

    def step(s: int) -> np.ndarray:
        """Scores from each tag to each next one, by block."""
        move = np.where(fresh[s], model.first[None, :, None], model.pairs[:, :, None]) + score[s]
        if s >= left:
            move[:, :, -1] = still
        return move

    best = np.repeat(still[:, :, None], blocks, 2)
    for s in range(DECODE_BLOCK):
        move = step(s)
        ways = [best[:, k, None] + move[k] for k in range(3)]
        best = np.maximum(np.maximum(ways[0], ways[1]), ways[2])
    entry = np.zeros((blocks + 1, 3))
    for b in range(blocks):
        at = (entry[b][:, None] + best[:, :, b]).max(axis=0)
        entry[b + 1] = at - at.max()
    back = np.zeros((DECODE_BLOCK, 3, blocks), np.int8)
    now = entry[:-1].T
    for s in range(DECODE_BLOCK):
        move = step(s)
        none, one, two = (now[k] + move[k] for k in range(3))
        now = np.maximum(none, one)
        back[s] = np.where(two > now, 2, one > none)
        now = np.maximum(now, two)
    # Tag at every place of a block, for each tag it may end in.
    state = np.repeat(np.arange(3, dtype=np.int8)[:, None], blocks, 1)
    traced = np.zeros((DECODE_BLOCK, 3, blocks), np.int8)
    for s in range(DECODE_BLOCK - 1, -1, -1):
        traced[s] = state
        state = np.take_along_axis(back[s], state.astype(np.int64), 0)
    end = int(entry[-1].argmax())
    ends = np.zeros(blocks, np.int64)
    for b in range(blocks - 1, -1, -1):
        ends[b], end = end, int(state[end, b])
    tags = np.take_along_axis(traced, ends[None, None, :], 1)[:, 0]
    return tags.T.reshape(-1)[:n]


def _likelihood(model_parts: tuple, places: np.ndarray, tags: np.ndarray, real: np.ndarray) -> tuple:
    """Gradient of the tags' log-likelihood, by forward and backward sums over padded windows (place by window)."""
    weights, pairs, first = model_parts
    length, windows = tags.shape
    score = np.zeros((length, windows, 3))
    for k in range(places.shape[2]):
        score += weights[places[:, :, k]]
    # Scaled sums: each step's forward chances add up to one.
    local = np.exp(score - score.max(axis=2, keepdims=True))
    move, use = np.exp(pairs), real[:, :, None]
    forward, scale = np.zeros_like(local), np.ones((length, windows, 1))
    now = np.exp(first) * local[0]
    for t in range(length):
        if t:
            now = np.where(use[t], (forward[t - 1] @ move) * local[t], forward[t - 1])
        scale[t] = now.sum(axis=1, keepdims=True)
        forward[t] = now / scale[t]
    ahead, backward = np.zeros_like(local), np.ones((windows, 3))
    error = np.zeros_like(local)
    for t in range(length - 1, -1, -1):
        error[t] = forward[t] * backward
        ahead[t] = np.where(use[t], local[t] * backward / scale[t], 0)
        backward = np.where(use[t], ahead[t] @ move.T, backward)
    error = (np.eye(3)[tags] - error) * use
    to_weights, flat, used = np.zeros_like(weights), error.reshape(-1, 3), real.reshape(-1)
    for k in range(places.shape[2]):
        where = places[:, :, k].reshape(-1)[used] - _AT[k]
        for tag in range(3):
            to_weights[_AT[k] : _AT[k + 1], tag] += np.bincount(where, flat[used, tag], SIZES[k])
    seen = np.bincount((tags[:-1] * 3 + tags[1:])[real[1:]], minlength=9).reshape(3, 3)
    expected = np.einsum("twi,twj->ij", forward[:-1], ahead[1:]) * move
    return to_weights, seen - expected, error[0].sum(axis=0)


def train(texts: Sequence[str], spans: Sequence[Sequence[tuple[int, int]]], turns: int = TURNS) -> Model:
    """Maximum likelihood by adaptive gradient steps; a fixed number of turns over all windows."""
    found = tokens(texts)
    places = features(found)
    tag = np.zeros(len(found.text), np.int64)
    of = np.searchsorted(found.text, np.arange(len(texts) + 1))
    for k, marked in enumerate(spans):
        a, b = of[k], of[k + 1]
        for start, end in marked:
            hit = a + np.flatnonzero((found.start[a:b] < end) & (found.end[a:b] > start))
            tag[hit] = INSIDE
            tag[hit[:1]] = BEGIN
    lengths = np.minimum(np.diff(of), TRAIN_TOKENS)
    kept = np.flatnonzero(lengths)
    width = int(lengths.max(initial=1))
    index = np.minimum(of[:-1][kept] + np.arange(width)[:, None], len(tag) - 1)
    real = np.arange(width)[:, None] < lengths[kept]
    parts = [np.zeros((int(_AT[-1]), 3)), np.zeros((3, 3)), np.zeros(3)]
    parts[1][OUT, INSIDE] = parts[2][INSIDE] = _NEVER
    seen = [np.full_like(p, 1e-3) for p in parts]
    for _ in range(turns):
        steps = _likelihood(tuple(parts), places[index], tag[index] * real, real)
        for p, s, step in zip(parts, seen, steps, strict=True):
            step = np.where(p <= _NEVER, 0, step / len(kept) - PENALTY * p)
            s += step**2
            p += 0.5 * step / np.sqrt(s)
    return Model(parts[0].astype(np.float32), parts[1], parts[2])


# --- training windows ---------------------------------------------------------------------

# Words before a secret, ways to join them, and issuers' prefixes.
NAMES = (
    "password passwd pwd passphrase passcode secret client_secret token access_token auth_token bearer credential credentials "
    "apikey api_key private_key secret_key login signing_key Passwort Kennwort contraseña clave mot_de_passe jeton"
).split()
JOINTS = (" = ", "=", ": ", ":", " is ", " -> ", " => ", " ", ' "', " := ", " was ", ', value "', "\n", " (", " ist ", " es ", " est ")
ISSUERS = ("ghp_", "gho_", "sk-", "sk_live_", "xoxb-", "AIza", "glpat-", "SG.", "ya29.", "npm_", "Bearer ", "Basic ")
PATHS = "usr lib share docs index main config data report archive images static public assets module".split()


def _alphabet(rnd: random.Random) -> str:
    plain = string.ascii_letters + string.digits
    return rnd.choice([plain, plain, plain + "+/", plain + "_-", string.ascii_uppercase + string.digits, "0123456789abcdef", string.ascii_lowercase + string.digits])


def made_secret(rnd: random.Random) -> str:
    """A random secret of one of many forms, with letters and digits both."""
    while True:
        length = rnd.choice([12, 14, 16, 18, 20, 24, 28, 32, 36, 40, 48, 64])
        body = "".join(rnd.choices(_alphabet(rnd), k=length))
        if any(c.isdigit() for c in body) and any(c.isalpha() for c in body):
            break
    form = rnd.random()
    if form < 0.2:
        return rnd.choice(ISSUERS[:-2]) + body
    if form < 0.3:
        coded = [base64.urlsafe_b64encode(rnd.randbytes(rnd.randrange(12, 40))).decode().rstrip("=") for _ in range(3)]
        return "eyJ" + ".".join(coded)
    if form < 0.4:
        k = len(body) // 2
        return body[:k] + rnd.choice("!@#$%&*") + body[k:]
    return body


def look_alike(rnd: random.Random, words: Sequence[str]) -> str:
    """Something long or mixed that is no secret."""
    word = lambda: rnd.choice(words)
    digits = lambda k: "".join(rnd.choices(string.digits, k=k))
    return rnd.choice([
        lambda: f"https://www.{word()}.com/{rnd.choice(PATHS)}/{word()}-{word()}-{digits(5)}",
        lambda: f"/{rnd.choice(PATHS)}/{rnd.choice(PATHS)}/{word()}_{word()}.{rnd.choice(['txt', 'html', 'py', 'csv'])}",
        lambda: f"{word()}.{digits(2)}@{word()}.example.com",
        lambda: f"v{digits(1)}.{digits(2)}.{digits(1)}-{rnd.choice(['beta', 'rc', 'alpha'])}{digits(1)}",
        lambda: f"20{digits(2)}-0{rnd.randrange(1, 9)}-1{digits(1)}T1{digits(1)}:{rnd.randrange(10, 59)}:00Z",
        lambda: "+" + "-".join([digits(2), digits(3), digits(4)]),
        lambda: digits(rnd.randrange(4, 15)),
        lambda: "".join(word().capitalize() for _ in range(rnd.randrange(2, 5))),
        lambda: "_".join(word().lower() for _ in range(rnd.randrange(3, 6))),
        lambda: "-".join(word().lower() for _ in range(rnd.randrange(3, 6))),
        lambda: f"ISBN {digits(3)}-{digits(1)}-{digits(5)}-{digits(3)}-{digits(1)}",
        lambda: f"{rnd.choice(NAMES)} {word()} {word()}",
        lambda: f"{rnd.choice(NAMES)}: {word()}",
        lambda: (word() + word() + word() + word()).lower(),
        lambda: f"{word().upper()}{word().upper()}",
        lambda: rnd.choice("#*$%&|") * rnd.randrange(3, 9) + word(),
    ])()


def training_windows(samples: Sequence[str], seed: int = 11) -> tuple[list[str], list[list[tuple[int, int]]]]:
    """Windows with planted secrets and look-alikes, and the places of all secrets in them.

    Without samples, windows are made of the generator's own words.
    """
    rnd = random.Random(seed)
    if not samples:
        samples = [" ".join(rnd.choices(PATHS, k=40)) for _ in range(SAMPLE // 4)]
    words = [w for s in samples[:200] for w in re.findall(r"[^\W\d_]{3,12}", s)][:4000] or PATHS
    texts, marked = [], []
    for sample in samples:
        gaps = [m.start() for m in re.finditer(r"\s", sample)] or [0]
        inserts = sorted(rnd.sample(gaps, min(len(gaps), rnd.randrange(0, 4))))
        text, spans, last = "", [], 0
        for gap in inserts:
            text += sample[last:gap] + " "
            last = gap
            if rnd.random() < 0.45:
                if rnd.random() < 0.75:
                    text += rnd.choice([str.lower, str.upper, str.capitalize, str])(rnd.choice(NAMES)) + rnd.choice(JOINTS)
                secret = made_secret(rnd)
                text += rnd.choice(["", "", "", '"', "'"])
                spans.append((len(text), len(text) + len(secret)))
                text += secret + rnd.choice(["", "", '"', ",", "."])
            else:
                text += look_alike(rnd, words)
        text += sample[last:]
        spans += [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        spans += [(a, b) for kind, a, b in base_spans(text) if kind != "assign"]
        texts.append(text)
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        marked.append(merged)
    return texts, marked


def sample_windows(docs: DataFrame, text: str, key: str) -> list[str]:
    """At most ``SAMPLE`` windows, one per bucket of hashes, so that copies of a row share a bucket."""
    whole = F.col(f"`{text}`").cast("string")
    seeds = F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("s")
    rows = docs.filter(F.length(whole) > 0).select(F.col(f"`{key}`").cast("string").alias("k"), whole.alias("t"), seeds)
    begin = F.pmod(F.xxhash64("k", "s", F.length("t")), F.greatest(F.length("t") - WINDOW, F.lit(0)) + 1)
    cut = rows.select("k", "s", F.substring(F.col("t"), begin.cast("int") + 1, F.lit(WINDOW)).alias("w"))
    hashed = cut.select(F.xxhash64("k", "s", "w").alias("h"), "w")
    found = hashed.groupBy(F.pmod("h", F.lit(SAMPLE))).agg(F.min(F.struct("h", "w")).alias("m")).select("m.w").collect()
    return sorted(r["w"] for r in found)


# --- the operator -------------------------------------------------------------------------


def tagged_spans(model: Model, texts: Sequence[str]) -> list[list[tuple[int, int]]]:
    """Places of the tagged secrets of each text, full stops at their end left out."""
    found = tokens(texts)
    starts = np.concatenate([[True], found.text[1:] != found.text[:-1]])[: len(found.text)]
    tags = viterbi(model, _scores(model, found), starts)
    begin = np.flatnonzero(tags == BEGIN)
    # A secret goes on over the tokens tagged inside that follow its first.
    stop = np.flatnonzero(np.append(tags, OUT) != INSIDE)
    last = stop[np.searchsorted(stop, begin, "right")] - 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for number, a, b in zip(found.text[begin].tolist(), found.start[begin].tolist(), found.end[last].tolist(), strict=True):
        while b > a + 1 and texts[number][b - 1] in ".,;:\"')":
            b -= 1
        out[number].append((a, b))
    return out


def _scores(model: Model, found: Tokens) -> np.ndarray:
    return model.scores(features(found))


def all_spans(model: Model, texts: Sequence[str]) -> Iterator[list[tuple[str, int, int]]]:
    """Spans of each text by start, then kind: the fixed patterns', and tagged ones that these do not cover."""
    for text, tagged in zip(texts, tagged_spans(model, texts), strict=True):
        base = base_spans(text)
        for a, b in tagged:
            if not any(x <= a and b <= y for _, x, y in base):
                base.append(("crf", a, b))
        yield sorted(base, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def fit(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> Model:
    return train(*training_windows(sample_windows(docs, text, key)))


def find_secrets(docs: DataFrame, model: Model | None = None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and spans (kind, start, end) of every row, whole texts, in code points, end exclusive.

    A null or empty text has no spans. Null and repeated keys stay rows of their own, equal texts give equal spans, and
    tied sequences of tags go to the tag listed first. Very long texts are cut into pieces at white space for features
    only; tags are decided over the whole text. An empty table gives no rows, and its model knows the generator's
    windows alone. Other columns are not read.
    """
    model = model or fit(docs, key=key, text=text)
    kind = docs.schema[key].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in text_slices(whole, 1, PIECE)):
            found = list(all_spans(model, [t or "" for t in batch.column(1).to_pylist()]))
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            flat = [s for f in found for s in f]
            columns = [pa.array([s[k] for s in flat], span.field(k).type) for k in range(3)]
            spans = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=list(span)))
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=[key, "spans"])

    chosen = docs.select(f"`{key}`", F.col(f"`{text}`").cast("string").alias("__text"))
    return map_batches(chosen, run, f"`{key}` {kind}, spans {SPANS}")


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Counts by kind, digest of the fixed patterns' spans, and all spans."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        f"`{key}`",
        *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(of(*KINDS[:3])), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
