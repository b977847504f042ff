"""Benchmark decontamination by spaced seeds.

A seed is a mask over a run of words: words at its open places are hashed, the others are ignored,
so a copy in which words were replaced still has seeds in common with its source. Hits of equal
seed hashes give the alignments worth a look, and each alignment is verified word by word around
the hit. Only DataFrame expressions: a text's seeds are made and looked up row by row, and no text
is shuffled while the benchmark's seeds fit a stated size.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm.text import materialise, temp_name

#: Places that count (1) and places that are ignored (0); all masks are of one length. Whichever words an overlap of
#: MIN_WORDS, or a whole item from the masks' length on, may differ in at MIN_PERCENT, one of these is laid beside them.
MASKS = ("11111000", "11101100", "10010111", "01110011")
#: So many aligned words make a window, and so many percent of them must be equal.
MIN_WORDS = 12
MIN_PERCENT = 80
#: Seeds of the benchmark up to which they are broadcast (32 bytes each); beyond it both sides are shuffled.
MAX_BROADCAST_SEEDS = 1_000_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def unseeded(masks: tuple[str, ...], words: int, changed: int) -> list[tuple[int, ...]]:
    """Choices of ``changed`` among ``words`` aligned words whose replacement leaves no seed in common."""
    seeds = [{i + k for k, x in enumerate(m) if x == "1"} for m in masks for i in range(words - len(m) + 1)]
    return [c for c in combinations(range(words), changed) if not any(s.isdisjoint(c) for s in seeds)]


def _masks_of(width: int, masks: tuple[str, ...], min_percent: int) -> tuple[str, ...]:
    """The masks for windows of a width; for those shorter than the masks, all that leave out as many words as may differ."""
    if width >= len(masks[0]):
        return masks
    lost = width - -(-width * min_percent // 100)
    return tuple("".join("0" if k in c else "1" for k in range(width)) for c in combinations(range(width), lost))


def _starts(word: str, span: int) -> Column:
    n = F.size(word)
    return F.when(n >= span, F.sequence(F.lit(0), n - span)).otherwise(F.array().cast("array<int>"))


def _seeds(word: str, at: str, masks: tuple[str, ...], span: int) -> Column:
    """One hash per mask laid at a place; null for masks longer than ``span`` that the text ends inside of."""
    w, i = F.col(word), F.col(at)

    def seed(mask: str) -> Column:
        found = F.xxhash64(F.lit(mask), *[F.get(w, i + k) for k, x in enumerate(mask) if x == "1"])
        return found if len(mask) == span else F.when(i + len(mask) <= F.size(w), found)

    return F.array(*map(seed, masks))


def _seeded(frame: DataFrame, word: str, at: str, masks: tuple[str, ...], *keep: str) -> DataFrame:
    """A row for each seed. The outer form keeps Spark from testing, and so making, the words twice."""
    span = min(map(len, masks))
    placed = frame.select(*keep, word, F.explode_outer(_starts(word, span)).alias(at)).filter(F.col(at).isNotNull())
    found = placed.select(*keep, word, at, F.explode(_seeds(word, at, masks, span)).alias("seed"))
    return found if max(map(len, masks)) == span else found.filter(F.col("seed").isNotNull())


def _low(shift: Column) -> Column:
    return F.greatest(shift, F.lit(0))


def _length(shift: Column, n: Column, m: Column) -> Column:
    return F.least(n, shift + m) - _low(shift)


def _windows(equal: Column, width: Column) -> Column:
    """Equal words in each window of aligned words."""
    return F.transform(
        F.sequence(F.lit(0), F.size(equal) - width),
        lambda a: F.aggregate(F.slice(equal, a + 1, width), F.lit(0), lambda x, y: x + y),
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    min_words: int = MIN_WORDS,
    min_percent: int = MIN_PERCENT,
    max_broadcast: int = MAX_BROADCAST_SEEDS,
) -> DataFrame:
    """Pairs of document and item that overlap: key, item, n_words, n_equal, doc_word, item_word.

    They overlap if in some alignment a window of ``min_words`` words (of the whole item, where
    it is shorter) has at least ``min_percent`` equal words. Of the alignments of a pair the one
    with most words inside such windows is told: n_words of them, n_equal equal words in the
    alignment, doc_word and item_word where it begins. Windows shorter than the masks are sought
    by all their words but those that may differ. Null and empty texts have no words; null keys are looked up like others and
    pair as one document; repeated rows and items give one pair; empty tables give an empty result;
    other columns are not read.
    """
    items = materialise(
        benchmark.select(F.col(f"`{item}`").alias("item"), tokens(F.col(f"`{item_text}`")).alias("iw")).distinct(),
        "benchmark",
    )
    items = items.filter(F.size("iw") > 0)
    sought = items.select("*", F.size("iw").alias("m"), F.least(F.lit(min_words), F.size("iw")).alias("width"))
    # Those that the benchmark has, so that texts are not looked through for others.
    widths = sorted(r["width"] for r in sought.select("width").distinct().collect())
    groups: dict[tuple[str, ...], list[int]] = {}
    for width in widths or [min_words]:
        groups.setdefault(_masks_of(width, masks, min_percent), []).append(width)
    seeded = [_seeded(sought.filter(F.col("width").isin(w)), "iw", "j", laid, "item", "m") for laid, w in groups.items()]
    seeds = materialise(
        reduce(DataFrame.unionByName, seeded).select("seed", "item", "j", "m").distinct(), "benchmark-seeds"
    )
    worded = docs.select(F.col(f"`{key}`").alias("doc"), tokens(F.col(f"`{text}`")).alias("w"))
    hashed = _seeded(worded, "w", "i", tuple(mask for laid in groups for mask in laid), "doc")
    shift, n, m = F.col("shift"), F.size("w"), F.col("m")
    part = F.slice("w", _low(shift) + 1, _length(shift, n, m)).alias("part")
    if seeds.count() <= max_broadcast:
        hits = hashed.join(F.broadcast(seeds), "seed").withColumn("shift", F.col("i") - F.col("j"))
        cut = hits.select("doc", "item", "shift", part)
    else:
        hits = hashed.select("doc", "i", "seed").join(seeds, "seed")
        spots = materialise(hits.select("doc", "item", (F.col("i") - F.col("j")).alias("shift"), "m").distinct(), "hits")
        where = F.col("x.doc").eqNullSafe(F.col("y.doc"))
        met = spots.alias("x").join(worded.alias("y"), where).select("x.doc", "item", "shift", "m", "w")
        cut = met.filter(_length(shift, n, m) > 0).select("doc", "item", "shift", part)
    once = cut.distinct()
    begin = F.greatest(-shift, F.lit(0))
    # Items of one id may differ in text; each is laid beside the words.
    both = once.join(items, "item").select(
        "doc", "item", "shift", F.size("iw").alias("m"), "part",
        F.slice("iw", begin + 1, F.size("part")).alias("words"),
    )
    both = both.withColumn(
        "equal", F.zip_with("part", "words", lambda a, b: F.when(a == b, 1).otherwise(0))
    ).withColumn("width", F.least(F.lit(min_words), F.col("m")))
    counted = both.withColumn(
        "counts",
        F.when(F.size("equal") >= F.col("width"), _windows(F.col("equal"), F.col("width")))
        .otherwise(F.array().cast("array<int>")),
    ).withColumn(
        "good",
        F.filter(
            F.transform("counts", lambda c, a: F.when(100 * c >= min_percent * F.col("width"), a)), lambda a: a.isNotNull()
        ),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("good", lambda a: F.sequence(a, a + F.col("width") - 1)))))
    told = counted.select(
        "doc", "item",
        covered.cast("long").alias("n_words"),
        F.aggregate("equal", F.lit(0), lambda x, y: x + y).cast("long").alias("n_equal"),
        _low(shift).cast("long").alias("doc_word"),
        begin.cast("long").alias("item_word"),
    )
    best = told.groupBy("doc", "item").agg(
        F.max(F.struct("n_words", "n_equal", (-F.col("doc_word")).alias("d"), (-F.col("item_word")).alias("i"))).alias("b")
    )
    # Judged after the sum: a filter before it would be moved down and make the words anew.
    return best.filter("b.n_words > 0").select(
        F.col("doc").alias(key), F.col("item").alias(item), "b.n_words", "b.n_equal",
        (-F.col("b.d")).alias("doc_word"), (-F.col("b.i")).alias("item_word"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """Documents that overlap with no item; all columns stay.

    Rows of null or repeated keys are judged one by one, by a written number.
    """
    odd = docs.groupBy(F.col(f"`{key}`").alias("k")).count().filter("k is null or count > 1")
    rows, by = docs, key
    if not odd.isEmpty():
        by = temp_name("row")
        rows = materialise(docs.withColumn(by, F.monotonically_increasing_id()), "numbered")
    found = materialise(
        overlaps(rows, benchmark, key=by, **options).select(F.col(f"`{by}`").alias("__key")).distinct(), "contaminated"
    )
    left = rows.join(found, F.col(f"`{by}`") == F.col("__key"), "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
