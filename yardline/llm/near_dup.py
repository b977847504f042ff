"""Near duplicates by min-max hashing.

Each permutation gives two signature values, the smallest and the largest image of the text's
shingles; both agree between two texts with probability equal to their Jaccard similarity, and
they are almost independent, so a signature needs half the hash evaluations. Bands of the
signature make candidates, and candidates are confirmed on the full sets.

No pairs are made inside a group: (1) texts of equal sets are one node; (2) in each bucket all
nodes are compared with the one that meets most others; (3) only buckets whose nodes then still
lie in several components are gone through again, comparing nodes outside the largest component
with those of other components; within a large family of loose copies that is done in blocks,
without making rows of pairs. Shingles that no other such node has cannot be common to two of
them, which bounds the similarity of each node and pair from above and rules out the many loose
copies of one text. So every two nodes that share a bucket have been compared, are connected
anyway or cannot be linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from yardline.llm.components import components
from yardline.llm.hashing import mix, numbers, shingle_set, word_hashes
from yardline.llm.text import map_batches, materialise, ship_package, temp_name

#: 40 bands of 5 values miss a pair of similarity 0.8 with probability (1 - 0.8^5)^40, about 1e-7.
PERMUTATIONS = 100
BAND_ROWS = 5
#: Share of equal sketch bytes below which a pair is not confirmed; at similarity 0.8 it lies
#: more than eight standard deviations off.
SKETCH_FLOOR = 0.55
_BLOCK = 4096
#: Open nodes from which a family is compared in blocks rather than by pairs, and nodes of a block.
FAMILY = 64
_FAMILY_BLOCK = 2048


def min_max(shingles: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Smallest, then largest images of the shingles under all permutations."""
    low = np.full(len(factor), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factor), np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        images = shingles[at : at + _BLOCK, None] * factor + shift
        np.minimum(low, images.min(axis=0), out=low)
        np.maximum(high, images.max(axis=0), out=high)
    return np.concatenate([low, high])


def signatures(docs: DataFrame, *, key: str, text: str, words: int, permutations: int, band_rows: int) -> DataFrame:
    """node, n_shingles, f1, f2 (digest of the set), bands, sketch for each row."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"node {kind}, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>, sketch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, shift = numbers(permutations, 11) | np.uint64(1), numbers(permutations, 12)
        rows = 2 * permutations // band_rows
        names = numbers(rows, 13)
        with np.errstate(over="ignore"):
            for batch in batches:
                n, f1, f2, bands, sketches = [], [], [], [], []
                for hashes in word_hashes([t or "" for t in batch.column(1).to_pylist()]):
                    found = shingle_set(hashes, words)
                    n.append(len(found))
                    f1.append(mix(found).sum(dtype=np.uint64))
                    f2.append(np.bitwise_xor.reduce(mix(found + np.uint64(7))) if len(found) else np.uint64(0))
                    if not len(found):
                        bands.append(None)
                        sketches.append(None)
                        continue
                    values = min_max(found, factor, shift)
                    key_of = names.copy()
                    for column in values[: rows * band_rows].reshape(rows, band_rows).T:
                        key_of = mix(key_of ^ mix(column))
                    bands.append(key_of.view(np.int64))
                    sketches.append((mix(values) >> np.uint64(56)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(np.array(f1, np.uint64).view(np.int64)),
                        pa.array(np.array(f2, np.uint64).view(np.int64)),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["node", "n_shingles", "f1", "f2", "bands", "sketch"],
                )

    return map_batches(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")), run, schema)


def full_sets(docs: DataFrame, *, key: str, text: str, words: int) -> DataFrame:
    """node and its sorted distinct shingle hashes."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                shingle_set(h, words).view(np.int64)
                for h in word_hashes([t or "" for t in batch.column(1).to_pylist()])
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    chosen = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string"))
    return map_batches(chosen, run, f"node {kind}, shingles array<bigint>")



def promising(pairs: DataFrame, nodes: DataFrame, *, percent: int, floor: float) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the similarity."""
    a = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (
                    np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3)
                )
                close = (x == y).mean(axis=1) >= floor
                yield batch.select([0, 1]).filter(pa.array(close))

    kind = pairs.schema["a"].dataType.simpleString()
    return map_batches(both.select("a", "b", "sa", "sb"), run, f"a {kind}, b {kind}").distinct()


def confirmed(pairs: DataFrame, docs: DataFrame, *, key: str, text: str, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) that are linked by their full sets."""
    pairs = materialise(pairs, "pairs")
    concerned = materialise(
        pairs.select(F.col("a").alias(key)).union(pairs.select("b")).distinct().withColumnRenamed(key, "__node"), "nodes"
    )
    chosen = docs.select(F.col(f"`{key}`").alias("__node"), F.col(f"`{text}`").alias("__text"))
    # Concerned ids are read from a written table, whose size tells Spark whether to broadcast them.
    sets = materialise(
        full_sets(chosen.join(concerned, "__node", "left_semi"), key="__node", text="__text", words=words).distinct(), "sets"
    )
    return linked_pairs(pairs, sets, percent=percent)


def linked_pairs(pairs: DataFrame, sets: DataFrame, *, percent: int) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    linked = pairs.join(a, "a").join(b, "b").select(
        "a", "b", common.alias("both"), (F.size("x") + F.size("y") - common).alias("either")
    )
    return linked.filter(100 * F.col("both") >= percent * F.col("either")).select("a", "b")


def open_sets(docs: DataFrame, chosen: DataFrame, *, key: str, text: str, words: int) -> DataFrame:
    """Full sets of the chosen nodes, written."""
    chosen = materialise(chosen.select(F.col("node").alias("__node")), "chosen")
    texts = docs.select(F.col(f"`{key}`").alias("__node"), F.col(f"`{text}`").alias("__text"))
    sets = full_sets(texts.join(chosen, "__node", "left_semi"), key="__node", text="__text", words=words)
    return materialise(sets.distinct(), "open-sets")


def shared_shingles(sets: DataFrame) -> DataFrame:
    """node, n (its shingles), s (those that another of the nodes has as well)."""
    single = (
        sets.select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle").agg(F.count("*").alias("k"), F.min("node").alias("node")).filter("k = 1")
        .groupBy("node").agg(F.count("*").alias("single"))
    )
    # Rows that share a key may differ in text: the smallest size and all shingles keep the bound safe.
    sized = sets.groupBy("node").agg(F.min(F.size("shingles")).alias("n"), F.sum(F.size("shingles")).alias("s"))
    return sized.join(single, "node", "left").select("node", "n", (F.col("s") - F.coalesce("single", F.lit(0))).alias("s"))


def family_links(nodes: DataFrame, sets: DataFrame, *, percent: int) -> DataFrame:
    """Links (a, b) between nodes of one family that lie in different components.

    The nodes outside a family's largest component are compared with all of the family, block by
    block: a task holds two blocks of sets and gives one link for each node and component, so
    neither a family nor its pairs ever are in one place or become rows.
    """
    largest = nodes.groupBy("family", "c").agg(F.count("*").alias("k")).groupBy("family").agg(
        F.max(F.struct("k", "c"))["c"].alias("main"), F.sum("k").alias("members")
    )
    full = nodes.join(sets, "node").join(largest, "family")
    blocks = F.ceil(F.col("members") / _FAMILY_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    columns = ["family", "xb", "yb", "node", "c", "shingles"]
    left = full.filter("c <> main").select("*", own.alias("xb"), every.alias("yb"))
    right = full.select("*", own.alias("yb"), every.alias("xb"))
    left, right = (side.select(*[F.col(c).alias(c) for c in columns]) for side in (left, right))

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        if x.num_rows and y.num_rows:
            flat = y.column("shingles").combine_chunks()
            edges = flat.offsets.to_numpy()
            values = flat.values.to_numpy()[edges[0] : edges[-1]]
            starts, size = edges[:-1] - edges[0], np.diff(edges)
            known, place = np.unique(values, return_inverse=True)
            y_nodes, y_parts = y.column("node").to_pylist(), y.column("c").to_numpy()
            for node, part, mine in zip(x.column("node").to_pylist(), x.column("c").to_pylist(), x.column("shingles"), strict=True):
                mine = mine.values.to_numpy()
                at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                mask = np.zeros(len(known), np.int32)
                mask[at[known[at] == mine]] = 1
                both = np.add.reduceat(mask[place], starts)
                close = (100 * both >= percent * (len(mine) + size - both)) & (y_parts != part)
                _, one = np.unique(y_parts[close], return_index=True)
                for k in np.flatnonzero(close)[one].tolist():
                    out_a.append(node)
                    out_b.append(y_nodes[k])
        kind = x.schema.field("node").type
        return pa.table({"a": pa.array(out_a, kind), "b": pa.array(out_b, kind)})

    kind = nodes.schema["node"].dataType.simpleString()
    keys = ["family", "xb", "yb"]
    ship_package(nodes.sparkSession)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    permutations: int = PERMUTATIONS,
    band_rows: int = BAND_ROWS,
    floor: float = SKETCH_FLOOR,
    family: int = FAMILY,
) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable over links), kept.

    Two documents are linked if 100 * common shingles >= ``percent`` * all their shingles. A null
    or empty text has no shingles and is linked with nothing. Rows that share a key count as one
    document. A null key takes no part in links: its component is null and it is kept. Other
    columns are not read; an empty table gives an empty result.
    """
    options = {"key": key, "text": text, "words": words}
    signed = materialise(
        signatures(docs, **options, permutations=permutations, band_rows=band_rows), "signatures"
    )
    shingled = signed.filter("node is not null and n_shingles > 0")
    # Written, so that the joins read two plain inputs and Spark can split a set that very many texts share.
    classes = materialise(shingled.groupBy("f1", "f2").agg(F.min("node").alias("rep")), "classes")
    member = materialise(
        shingled.select("node", "f1", "f2").join(classes, ["f1", "f2"]).select("node", "rep").filter("node <> rep").distinct(),
        "members",
    )
    nodes = materialise(
        shingled.join(classes.select("f1", "f2", F.col("rep").alias("node")), ["node", "f1", "f2"], "left_semi")
        .select("node", "n_shingles", "bands", "sketch").distinct(),
        "nodes",
    )
    places = nodes.select(F.explode("bands").alias("bucket"), "node").distinct()
    crowds = places.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    crowded = materialise(places.join(crowds, "bucket"), "buckets")
    # The node that meets most others leads its buckets: the source of many copies, if it is there.
    weight = crowded.groupBy("node").agg(F.sum("n").alias("weight"))
    leaders = crowded.join(weight, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", "node"))["node"].alias("leader")
    )
    led = materialise(crowded.select("bucket", "node").join(leaders, "bucket"), "led-buckets")
    stars = materialise(
        led.filter("node <> leader")
        .select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct(),
        "stars",
    )
    # A node's family is the leader it meets most often.
    met = led.groupBy("node", "leader").agg(F.count("*").alias("n"))
    families = met.groupBy("node").agg(F.max(F.struct("n", "leader"))["leader"].alias("family"))
    first = materialise(
        confirmed(promising(stars, nodes, percent=percent, floor=floor), docs, **options, percent=percent), "links"
    )
    joined = components(first.select(F.col("a").alias("u"), F.col("b").alias("v")))

    # Buckets whose nodes are in several components yet.
    labelled = led.join(joined, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("c"))
    parts = labelled.groupBy("bucket", "c").agg(F.count("*").alias("n"))
    split = parts.groupBy("bucket").agg(
        F.max(F.struct("n", "c"))["c"].alias("main"), F.count("*").alias("parts")
    ).filter("parts > 1").drop("parts")
    open_places = materialise(labelled.join(split, "bucket"), "open-buckets")
    sets = open_sets(docs, open_places.select("node").distinct(), **options)
    shared = shared_shingles(sets).filter(100 * F.col("s") >= percent * F.col("n"))
    open_nodes = open_places.select("node", "c").distinct().join(shared, "node").join(families, "node")
    crowd = open_nodes.groupBy("family").agg(F.count("*").alias("size")).filter(F.col("size") >= family)
    open_nodes = materialise(
        open_nodes.join(crowd, "family", "left").select("node", "c", "n", "s", "family", F.coalesce("size", F.lit(0)).alias("size")),
        "open-nodes",
    )
    inside = family_links(open_nodes.filter("size > 0"), sets, percent=percent)
    here = open_places.select("bucket", "node", "main").join(open_nodes, "node")
    outer, inner = (
        here.select("bucket", *[F.col(c).alias(c + side) for c in ("node", "c", "n", "s", "family", "size", "main")]) for side in "ab"
    )
    most = F.least("sa", "sb")
    rest = (
        outer.filter("ca <> maina").join(inner, "bucket")
        .filter(
            (F.col("ca") != F.col("cb"))
            & ((F.col("cb") == F.col("mainb")) | (F.col("nodea") < F.col("nodeb")))
            & ((F.col("familya") != F.col("familyb")) | (F.col("sizea") == 0))
            & (100 * most >= percent * (F.col("na") + F.col("nb") - most))
        )
        .select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b")).distinct()
    )
    rest = rest.join(stars, ["a", "b"], "left_anti")
    second = linked_pairs(promising(rest, nodes, percent=percent, floor=floor), sets, percent=percent).union(inside)
    links = joined.select(F.col("node").alias("u"), F.col("component").alias("v")).union(second.select("a", "b")).union(
        member.select("node", "rep")
    )
    final = materialise(components(links), "components")
    return (
        signed.select("node", "n_shingles").join(final, "node", "left")
        .select(
            F.col("node").alias(key),
            "n_shingles",
            F.coalesce("component", "node").alias("component_id"),
            F.coalesce(F.col("component") == F.col("node"), F.lit(True)).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents whose key is their component's smallest: one of each group of near duplicates.

    Where keys repeat or are null, each such row is a document of its own, numbered in a written table: it goes only if
    its own text is linked with one of a smaller key, or of an equal key and a smaller number. A null key counts as 0 or as
    the empty string here, and comes before all others if keys are neither numbers nor strings.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    odd = docs.groupBy(F.col(f"`{key}`").alias("k")).count().filter("k is null or count > 1")
    if odd.isEmpty():
        found = near_duplicates(docs, key=key, text=text, **options)
        gone = materialise(found.filter("not kept").select(F.col(f"`{key}`")), "gone")
        return docs.join(gone, key, "left_anti").select(*columns)
    node, kind, place = temp_name("node"), docs.schema[key].dataType, F.col(f"`{key}`")
    if isinstance(kind, NumericType | StringType):
        place = F.coalesce(place, F.lit("" if isinstance(kind, StringType) else 0).cast(kind))
    numbered = docs.withColumn(node, F.struct(place.alias("k"), F.monotonically_increasing_id().alias("n")))
    numbered = materialise(numbered, "numbered")
    found = near_duplicates(numbered, key=node, text=text, **options)
    gone = materialise(found.filter("not kept").select(node), "gone")
    return numbered.join(gone, node, "left_anti").select(*columns)
