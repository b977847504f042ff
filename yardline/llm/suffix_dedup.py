"""Removal of repeated byte strings by longest previous factors, over texts of any total size.

A byte goes if it lies in a string of ``length`` bytes (a window) that also starts earlier, that is
if the longest previous factor at the start of some window over it is at least ``length``. A
suffix order of the whole corpus is not needed for that: equal windows hold the same least
hash of their k-grams, so suffixes are ordered within groups of windows that share it.

1. Each text is cut into segments, runs of windows around one k-gram of least hash. Hashes that occur
   once cannot take part in a match and go, after one count.
2. Equal segments are aggregated: windows of all but the first have an earlier copy. This is
   where large groups of copies and very common passages end.
3. Where different segments share a hash, one copy of each is fetched from its text, the windows of
   each group are put in suffix order, and the nearest smaller positions before and after each
   one there give its longest previous factor. Groups of very many segments (short common strings
   in many contexts) are split by more of their windows' least hashes, on which equal windows agree as well.
4. Pieces of split groups are aggregated like segments. Groups that still hold very many different pieces
   (a string whose windows agree in their hashes, while its contexts differ) are cut into single
   windows, and those are aggregated: what is gathered in one place is always bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.llm.hashing import Slices, mix, powers
from yardline.llm.text import map_batches, materialise, scratch_dir
from yardline.session import remove_scratch

LENGTH = 100
GRAM = 24
#: Bytes cut into segments at once, and bytes of groups whose suffixes are ordered at once, but for the last group's.
PIECE = 1 << 19
SORTED = 1 << 18
#: Segments of a group beyond which it is split; each further hash splits a group by half or more.
GROUP = 1000
#: Low bits that hold a k-gram's place among those handled at once (fewer than 2 * PIECE + LENGTH).
_PLACE_BITS = np.uint64(22)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = Slices(data)._sums
    return mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])


def least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        hashes = np.minimum(hashes[: len(hashes) - span], hashes[span:])
        span *= 2
    rest = width - span
    return np.minimum(hashes[: len(hashes) - rest], hashes[rest:]) if rest else hashes


def cut_segments(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For batches of texts: text number, first window, windows, least hash and content hash of segments."""

    def flush(batch: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        joined = b"".join([d for _, _, d in batch])
        data = np.frombuffer(joined, np.uint8)
        size = np.array([len(d) for _, _, d in batch])
        ends = np.cumsum(size)
        hashes = gram_hashes(data, gram)
        # Ties go to the leftmost, in equal windows the same one; no window recurs inside a segment.
        places = np.arange(len(hashes), dtype=np.uint64)
        low = least(hashes >> _PLACE_BITS << _PLACE_BITS | places, length - gram + 1)
        owner = np.repeat(np.arange(len(batch)), size)
        n = len(low)
        valid = owner[:n] == owner[length - 1 :]
        start = valid.copy()
        start[1:] &= ~valid[:-1] | (low[1:] != low[:-1]) | (owner[1:n] != owner[: n - 1])
        first = np.flatnonzero(start)
        stop = np.append(first[1:], n)
        last = ends[owner[first]] - length + 1  # windows of the piece end here
        stop = np.minimum(stop, last)
        views = memoryview(joined)
        content = np.fromiter(
            (xxhash.xxh3_64_intdigest(views[a : b + length - 1]) for a, b in zip(first.tolist(), stop.tolist(), strict=True)),
            np.uint64, len(first),
        )
        mine = owner[first]
        number = np.array([k for k, _, _ in batch])[mine]
        shift = np.array([o for _, o, _ in batch])[mine] - (ends - size)[mine]
        lowest = hashes[(low[first] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)]
        return number, first + shift, stop - first, lowest, content

    batch: list[tuple[int, int, bytes]] = []
    total = 0
    with np.errstate(over="ignore"):
        for k, data in enumerate(texts):
            for at in range(0, len(data) - length + 1, PIECE):
                batch.append((k, at, data[at : at + PIECE + length - 1]))
                total += len(batch[-1][2])
                if total >= PIECE:
                    yield flush(batch)
                    batch, total = [], 0
        if batch:
            yield flush(batch)


def segments(base: DataFrame, *, length: int, gram: int) -> DataFrame:
    """h (least hash), c (hash of the bytes), d, t (document), s (first window), w (windows)."""
    kind = base.schema["d"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x or "").encode() for x in batch.column(2).to_pylist()]
            for number, start, count, low, content in cut_segments(texts, length, gram):
                at = pa.array(number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(low.view(np.int64)), pa.array(content.view(np.int64)),
                        batch.column(0).take(at), batch.column(1).take(at),
                        pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                    ],
                    names=["h", "c", "d", "t", "s", "w"],
                )

    return map_batches(base.select("d", "t", "body"), run, f"h bigint, c bigint, d {kind}, t bigint, s int, w int")


def smaller_neighbours(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest smaller position before and after each one (-1: none), by pointer jumping."""

    def before(p: np.ndarray) -> np.ndarray:
        to = np.arange(-1, len(p) - 1)
        todo = np.flatnonzero(to >= 0)
        while len(todo := todo[(to[todo] >= 0)]):
            todo = todo[p[to[todo]] > p[todo]]
            to[todo] = to[to[todo]]
        return to

    after = before(position[::-1])[::-1]
    return before(position), np.where(after < 0, -1, len(position) - 1 - after)


def first_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that orders like them, zeros after the last."""
    words = np.zeros(len(data), np.uint64)
    long = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for k in range(8):
        words |= long[k : k + len(data)] << np.uint64(56 - 8 * k)
    return words


def prefix_ranks(words: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
    """For 8, 16, 32, ... bytes: the rank of the string at each place, by doubling, until strings end.

    ``left``: bytes of the string from each place on; a shorter string comes before its continuations.
    """
    n, place = len(words), np.arange(len(words))
    short = np.minimum(left, 8)
    cut = words >> ((8 - short) * 8).astype(np.uint64) << ((8 - short) * 8).astype(np.uint64)
    levels, span = [np.unique(cut, return_inverse=True)[1] * 9 + short], 8
    while span < int(left.max(initial=0)):
        second = np.where(span < left, levels[-1][np.minimum(place + span, n - 1)] + 1, 0)
        levels.append(np.unique(levels[-1] * (9 * n + 18) + second, return_inverse=True)[1])
        span *= 2
    return levels


def common_lengths(words: np.ndarray, levels: list[np.ndarray], left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the strings at places a and b have in common at their start."""
    left_a, left_b, last = left[a], left[b], len(left) - 1
    found = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (found < left_a) & (found < left_b)
        same = inside & (levels[k][np.minimum(a + found, last)] == levels[k][np.minimum(b + found, last)])
        # Equal ranks of strings shorter than the span mean that they end together.
        found += np.where(same, np.minimum(8 << k, left_a - found), 0)
    rest = np.minimum(left_a, left_b) - found
    differ = words[np.minimum(a + found, last)] ^ words[np.minimum(b + found, last)]
    more, open_ = np.zeros(len(a), np.int64), np.ones(len(a), bool)
    for k in range(8):
        open_ &= (differ >> np.uint64(56 - 8 * k)) & np.uint64(255) == 0
        more += open_
    return found + np.minimum(more, rest)


def previous_factors(data: np.ndarray, ends: np.ndarray, place: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Length of the longest previous factor at each ``place`` of ``data``: the longest start of its string
    that also stands at a place of smaller ``position`` (the order in the corpus).

    Of all earlier places the one before and the one after in suffix order share most: the nearest
    of smaller position on either side.
    """
    words, left = first_words(data), ends - np.arange(len(data))
    levels = prefix_ranks(words, left)
    order = np.argsort(levels[-1][place], kind="stable")
    lengths = np.zeros(len(place), np.int64)
    for to in smaller_neighbours(position[order]):
        has = to >= 0
        shared = common_lengths(words, levels, left, place[order[has]], place[order[to[has]]])
        lengths[order[has]] = np.maximum(lengths[order[has]], shared)
    return lengths


def _spans(rows: list[tuple], length: int) -> Iterator[tuple]:
    """(d, t, start, end) that have earlier copies among the segments (d, t, s, bytes)."""
    rows = _with_repeats(rows, length)
    if not rows:
        return
    keys = {k: i for i, k in enumerate(sorted({(x[0], x[1]) for x in rows}, key=lambda k: (k[0] is not None, k)))}
    size = np.array([len(x[3]) for x in rows])
    joined = np.frombuffer(b"".join([x[3] for x in rows]), np.uint8)
    offset = np.cumsum(size) - size
    count = size - length + 1
    owner = np.repeat(np.arange(len(rows)), count)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    rank = np.array([keys[x[0], x[1]] for x in rows])[owner]
    start = np.array([x[2] for x in rows])[owner] + inner
    position = np.empty(len(owner), np.int64)
    position[np.lexsort((start, rank))] = np.arange(len(owner))
    factors = previous_factors(joined, np.repeat(offset + size, size), offset[owner] + inner, position)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (factors >= length).astype(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        while a < b:  # a run of windows may go on in the next segment of the list
            row = rows[owner[a]]
            stop = min(b, a - int(inner[a]) + int(count[owner[a]]))
            yield row[0], row[1], row[2] + int(inner[a]), row[2] + int(inner[stop - 1]) + length
            a = stop


def _with_repeats(rows: list[tuple], length: int) -> list[tuple]:
    """Without segments none of whose windows can recur: each of their hashes is there once."""
    size = np.array([len(x[3]) for x in rows])
    joined = np.frombuffer(b"".join([x[3] for x in rows]), np.uint8)
    count = size - length + 1
    owner = np.repeat(np.arange(len(rows)), count)
    at = np.arange(len(owner)) + (np.cumsum(size) - size - np.cumsum(count) + count)[owner]
    with np.errstate(over="ignore"):
        hashes = Slices(joined)(at, at + length)
    order = np.argsort(hashes)
    twice = np.zeros(len(order), bool)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    twice[order[1:]] |= equal
    twice[order[:-1]] |= equal
    return [rows[k] for k in np.unique(owner[twice]).tolist()]


def suffix_spans(wanted: DataFrame, *, length: int) -> DataFrame:
    """d, t, span for segments (g, d, t, s, bytes) whose windows are compared within each g."""
    kind = wanted.schema["d"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            found = list(_spans([r[1:] for r in rows], length))
            ends = [{"a": a, "b": b} for _, _, a, b in found]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([f[0] for f in found], wanted_type), pa.array([f[1] for f in found], pa.int64()),
                    pa.array(ends, pa.struct([("a", pa.int32()), ("b", pa.int32())])),
                ],
                names=["d", "t", "span"],
            )

        rows: list[tuple] = []
        total, wanted_type = 0, None
        for batch in batches:
            wanted_type = batch.schema.field(1).type
            for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if total >= SORTED and row[0] != rows[-1][0]:
                    yield done(rows)
                    rows, total = [], 0
                rows.append(row)
                total += len(row[4])
        if rows:
            yield done(rows)

    # A stated number of partitions: ordering suffixes takes longer than their bytes tell.
    parts = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = wanted.select("g", "d", "t", "s", "bytes").repartition(parts, "g").sortWithinPartitions("g")
    return map_batches(grouped, run, f"d {kind}, t bigint, span struct<a:int,b:int>")


def _fetched(joined: DataFrame, *, length: int) -> DataFrame:
    """The asked-for segments (g, d, t, s, bytes) of each text."""
    kind = joined.schema["d"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, t, body, asked in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                data = body.encode()
                rows += [(x["h"], d, t, x["s"], data[x["s"] : x["s"] + x["w"] + length - 1]) for x in asked]
                if len(rows) > 5000:
                    yield _batch(rows, batch.schema.field(0).type)
                    rows = []
            if rows:
                yield _batch(rows, batch.schema.field(0).type)

    return map_batches(
        joined.select("d", "t", "body", "asked"), run, f"g bigint, d {kind}, t bigint, s int, bytes binary"
    )


def _pieces(joined: DataFrame, *, length: int, gram: int) -> DataFrame:
    """The asked-for segments in pieces h, c (hash of the bytes), d, t, s, w.

    A piece is a run of windows that agree in their ``depth`` least hashes, which h tells of; of depth 0
    it is a single window, and h stays.
    """
    kind = joined.schema["d"].dataType.simpleString()

    def parts(data: bytes, h: int, depth: int) -> Iterator[tuple[int, int, int]]:
        """Group, first and last window of each piece."""
        if depth == 0:
            yield from ((h, a, a + 1) for a in range(len(data) - length + 1))
            return
        hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
        views = np.lib.stride_tricks.sliding_window_view(hashes, length - gram + 1)
        depth = min(depth, views.shape[1])
        for at in range(0, len(views), 4096):
            lowest = np.sort(np.partition(views[at : at + 4096], depth - 1, axis=1)[:, :depth], axis=1)
            g = np.full(len(lowest), np.uint64(depth))
            for column in lowest.T:
                g = mix(g ^ mix(column))
            cut = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]]).tolist()
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                yield int(g[a].view(np.int64)), at + a, at + b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.uint64(), kind, pa.int64(), pa.int32(), pa.int32()]
            columns = [pa.array([r[k] for r in rows], x) for k, x in enumerate(kinds)]
            columns[1] = pa.array(columns[1].to_numpy().view(np.int64))
            return pa.RecordBatch.from_arrays(columns, names=["h", "c", "d", "t", "s", "w"])

        with np.errstate(over="ignore"):
            for batch in batches:
                rows = []
                for d, t, body, asked in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    data = body.encode()
                    for x in asked:
                        s = x["s"]
                        piece = data[s : s + x["w"] + length - 1]
                        rows += [
                            (g, xxhash.xxh3_64_intdigest(piece[a : b + length - 1]), d, t, s + a, b - a)
                            for g, a, b in parts(piece, x["h"], x["depth"])
                        ]
                        if len(rows) > 5000:
                            yield made(rows, batch.schema.field(0).type)
                            rows = []
                if rows:
                    yield made(rows, batch.schema.field(0).type)

    return map_batches(
        joined.select("d", "t", "body", "asked"), run, f"h bigint, c bigint, d {kind}, t bigint, s int, w int"
    )


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), kind, pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], x) for k, x in enumerate(kinds)], names=["g", "d", "t", "s", "bytes"]
    )


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"


def _finished(frame: DataFrame, *, with_text: bool, keep_open: bool) -> DataFrame:
    """Results beside ``row``; texts that still ask for segments stay as they are if ``keep_open``."""
    fields = [frame.schema["row"], frame.schema["d"], frame.schema["t"]]
    schema = T.StructType([*fields, *T.StructType.fromDDL(_RESULT).fields])
    names = ["row", "d", "t", "body", "spans"]
    if keep_open:
        for name in ("body", "spans", "asked"):
            schema = schema.add(name, frame.schema[name].dataType, True)
        names.append("asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n", "gone", "runs", "sha", "text")}
            wait = []
            asked = batch.column(5).to_pylist() if keep_open else [None] * batch.num_rows
            spans_of = batch.column(4).to_pylist()
            for body, spans, more in zip(batch.column(3).to_pylist(), spans_of, asked, strict=True):
                wait.append(bool(more))
                if more:
                    for values in out.values():
                        values.append(None)
                    continue
                data = (body or "").encode()
                runs = merged([(x["a"], x["b"]) for x in spans or []])
                edges = [0, *(e for r in runs for e in r), len(data)]
                left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out["n"].append(len(data))
                out["gone"].append(len(data) - len(left))
                out["runs"].append(len(runs))
                out["sha"].append(hashlib.sha256(left).hexdigest())
                out["text"].append(left.decode(errors="ignore") if with_text else None)
            columns = [batch.column(k) for k in range(3)]
            columns += [pa.array(out[k], pa.int64()) for k in ("n", "gone", "runs")]
            columns += [pa.array(out[k], pa.string()) for k in ("sha", "text")]
            if keep_open:
                shut = pa.array([not x for x in wait])
                for k in (3, 4, 5):
                    blank = pa.nulls(batch.num_rows, batch.column(k).type)
                    columns.append(pa.compute.if_else(shut, blank, batch.column(k)) if k == 3 else _where(wait, batch.column(k)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return map_batches(frame.select(*names), run, schema)


def _where(keep: list[bool], column: pa.Array) -> pa.Array:
    """The column with nulls where ``keep`` is false."""
    return column.take(pa.array([k if yes else None for k, yes in enumerate(keep)], pa.int64()))


def _aggregated(parts: DataFrame, name: str, *, length: int, within: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Of written parts h, c, d, t, s, w: one row of equal ones (h, c, first, w, n), and spans (d, t, span) of the others."""
    firsts = materialise(
        parts.groupBy("h", "c").agg(F.min(F.struct("d", "t", "s")).alias("first"), F.max("w").alias("w"), F.count("*").alias("n")),
        name, within=within,
    )
    copies = (
        parts.join(firsts.filter("n > 1").select("h", "c", "first"), ["h", "c"])
        .filter(~F.struct("d", "t", "s").eqNullSafe(F.col("first")))
        .select("d", "t", F.struct(F.col("s").alias("a"), (F.col("s") + F.col("w") + length - 1).alias("b")).alias("span"))
    )
    return firsts, copies


def _asked(firsts: DataFrame, group: int, beyond: Callable[[Column], Column], *, within: str | None = None) -> DataFrame:
    """d, t and the segments (s, w, h, depth) asked of that text: depth 1 in groups of up to ``group`` different ones."""
    sizes = materialise(firsts.groupBy("h").agg(F.count("*").alias("size")).filter("size > 1"), "group-sizes", within=within)
    depth = F.when(F.col("size") <= group, 1).otherwise(beyond(F.col("size"))).cast("int")
    return (
        firsts.join(sizes.select("h", depth.alias("depth")), "h")
        .groupBy(F.col("first.d").alias("d"), F.col("first.t").alias("t"))
        .agg(F.collect_list(F.struct(F.col("first.s").alias("s"), "w", "h", "depth")).alias("asked"))
    )


def remove_repeats(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
    with_text: bool = False,
) -> DataFrame:
    """Per row: row (struct of the columns but the text), n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    Texts are UTF-8 bytes; a null text is empty. Of equal windows the one with the smallest key,
    then the smallest start, stays. Null keys come before all others; rows of equal keys are
    documents of their own, ordered as the table holds them. Texts shorter than ``length``
    lose nothing; an empty table gives an empty result. ``kept_text`` (null unless ``with_text``)
    leaves out bytes of characters that a removed span cuts in two.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(
        F.struct(*rest).alias("row"), F.col(f"`{key}`").alias("d"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body")
    )
    odd = docs.groupBy(F.col(f"`{key}`").alias("k")).count().filter("k is null or count > 1")
    if odd.isEmpty():
        base = base.withColumn("t", F.lit(0).cast("long"))
    else:  # written, so that the numbers stay the same in all later reads
        base = materialise(base.withColumn("t", F.monotonically_increasing_id()), "numbered")

    # Tables that nothing reads once texts stand beside what is asked of them.
    early = scratch_dir(docs.sparkSession, "early")
    every = segments(base, length=length, gram=gram)
    # Written, so that the join reads two plain inputs and Spark can split a hash with very many rows.
    repeated = materialise(every.groupBy("h").count().filter("count > 1").select("h"), "repeated", within=early)
    shared = materialise(every.join(repeated, "h"), "segments", within=early)
    firsts, copies = _aggregated(shared, "distinct-segments", length=length, within=early)
    asked = _asked(firsts, group, lambda size: 2 + F.ceil(F.log2(size / group)), within=early)
    copied = copies.groupBy("d", "t").agg(F.collect_list("span").alias("spans"))

    def on(other: DataFrame, a: str, b: str) -> Column:
        return F.col(f"{a}.d").eqNullSafe(F.col(f"{b}.d")) & (F.col(f"{a}.t") == F.col(f"{b}.t"))

    info = materialise(
        copied.alias("x").join(asked.alias("y"), on(asked, "x", "y"), "full").select(
            F.coalesce("x.d", "y.d").alias("d"), F.coalesce("x.t", "y.t").alias("t"), "spans", "asked"
        ),
        "per-document", within=early,
    )
    joined = base.alias("x").join(info.alias("y"), on(info, "x", "y"), "left").select(
        "row", "x.d", "x.t", "body", "spans", "asked"
    )
    state = materialise(_finished(joined, with_text=with_text, keep_open=True), "texts", compression="zstd")
    remove_scratch(docs.sparkSession, early)
    columns = ["row", *T.StructType.fromDDL(_RESULT).fieldNames()]
    closed = state.filter("n_bytes is not null").select(*columns)
    still = state.filter("n_bytes is null")
    small, large = F.filter("asked", lambda x: x["depth"] == 1), F.filter("asked", lambda x: x["depth"] != 1)
    wanted = still.select("d", "t", "body", small.alias("asked"))
    split = still.select("d", "t", "body", large.alias("asked")).filter(F.size("asked") > 0)
    spans = []
    if not split.isEmpty():
        def again(asks: DataFrame, which: Column) -> DataFrame:
            """Texts with what is asked of them after the split."""
            some = asks.select("d", "t", which.alias("asked")).filter(F.size("asked") > 0)
            return split.alias("x").join(some.alias("y"), on(some, "x", "y")).select("x.d", "x.t", "body", "y.asked")

        def repeats(pieces: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
            every = materialise(pieces, f"all-{name}")
            twice = materialise(every.groupBy("h").count().filter("count > 1").select("h"), f"repeated-{name}")
            return _aggregated(materialise(every.join(twice, "h"), name), f"distinct-{name}", length=length)

        distinct, equal = repeats(_pieces(split, length=length, gram=gram), "pieces")
        asks = materialise(_asked(distinct, group, lambda size: F.lit(0)), "asked-pieces")
        _, same = repeats(_pieces(again(asks, large), length=length, gram=gram), "windows")
        spans = [equal, same]
        wanted = wanted.unionByName(again(asks, small))
    found = suffix_spans(_fetched(wanted, length=length), length=length)
    found = reduce(DataFrame.unionByName, spans, found)
    more = found.groupBy("d", "t").agg(F.collect_list("span").alias("more"))
    both = still.alias("x").join(more.alias("y"), on(more, "x", "y"), "left").select(
        "row", "x.d", "x.t", "body",
        F.concat(*(F.coalesce(F.col(c), F.array().cast("array<struct<a:int,b:int>>")) for c in ("spans", "more"))).alias("spans"),
    )
    return closed.unionByName(_finished(both, with_text=with_text, keep_open=False).select(*columns))


def drop_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with repeated strings taken out of their texts; ``n_chars``, if there, counted anew."""
    found = remove_repeats(docs, key=key, text=text, with_text=True, **options)
    new = {text: F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return found.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])
