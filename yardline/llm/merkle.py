"""Merkle manifest of a table: a digest per row, a tree per group, a root over groups, a witness per row.

Leaves of a group stand in key order; every eight neighbours become the digest of their joined
digests, level by level, until one node, the group's subroot, remains. Subroots in group order are
joined likewise to the root. A row's witness lists, from the leaf up, the siblings before and after
its path, which is all that is needed to compute the root from the row again.

Leaves are dealt out in blocks of 8^4. A task appends the leaves of a block one by one to a tree
whose subtrees stay open until their eighth node: each leaf has a partial witness, to which every
completed run of siblings adds a step. A block's root is then one more node, appended with the roots
of its group in the next round, until each group has one; the steps found there extend the witnesses
of all leaves of the block. A row crosses to other tasks three times, as key and digests only, and no
task holds more than one block, however large a group is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardline.llm.text import map_batches, materialise

#: Nodes joined to one, and levels within a block.
FAN = 8
LEVELS = 4
#: Rows emitted at a time.
_SLICE = 1024
STEP = "array<struct<before:string,after:string>>"


def joined_digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of texts joined."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as its number of UTF-8 bytes, a colon and itself; null is a dash."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return joined_digest(*[field(f) for f in fields])


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    return F.aggregate(witness, leaf, lambda node, step: joined_digest(step["before"], node, step["after"]))


def proof_digest(witness: Column) -> Column:
    """Digest of all siblings, level by level from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda step: F.concat(step["before"], step["after"])), ""), 256)


class OpenTree:
    """A tree of appended nodes. Open subtrees wait, level by level, for their eighth node; completing a
    run of siblings adds a step to the partial witness of every leaf below it."""

    def __init__(self, witnesses: bool = True):
        self.size = 0
        self.witness: list[list[tuple[str, str]]] | None = [] if witnesses else None
        self._open: list[list[tuple[str, int, int]]] = [[]]

    def append(self, digest: str) -> None:
        if self.witness is not None:
            self.witness.append([])
        self._push(0, (digest, self.size, self.size + 1))
        self.size += 1

    def _push(self, level: int, node: tuple[str, int, int]) -> None:
        if level == len(self._open):
            self._open.append([])
        self._open[level].append(node)
        if len(self._open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        digests = [digest for digest, _, _ in run]
        if self.witness is not None:
            for k, (_, first, end) in enumerate(run):
                step = ("".join(digests[:k]), "".join(digests[k + 1 :]))
                for leaf in range(first, end):
                    self.witness[leaf].append(step)
        whole = hashlib.sha256("".join(digests).encode()).hexdigest()
        self._push(level + 1, (whole, run[0][1], run[-1][2]))

    def close(self, levels: int) -> str:
        """Complete what is open below a level, short runs too, and return the one node there."""
        for level in range(levels):
            if self._open[level]:
                self._complete(level)
        ((root, _, _),) = self._open[levels]
        return root


def levels_of(total: int, levels: int) -> int:
    """Levels that a block is raised by: as many as its group needs, within a block."""
    level, width = 0, 1
    while width < total and level < levels:
        level, width = level + 1, width * FAN
    return level


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Whole blocks side by side in tasks, each in order."""
    return nodes.repartition("group", "block").sortWithinPartitions("group", "block", "position")


def _block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """A node per block: group, position (the block's), total (blocks of the group), digest."""
    kind, size = nodes.schema["group"].dataType.simpleString(), FAN**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at = None, None

        def done() -> pa.RecordBatch:
            group, position, total = at
            return pa.RecordBatch.from_arrays(
                [
                    group,
                    pa.array([position // size], pa.int64()),
                    pa.array([-(-total // size)], pa.int64()),
                    pa.array([tree.close(levels_of(total, levels))], pa.string()),
                ],
                names=["group", "position", "total", "digest"],
            )

        for batch in batches:
            places, totals = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for k, (position, total, digest) in enumerate(zip(places, totals, batch.column(3).to_pylist(), strict=True)):
                if position % size == 0:
                    if tree is not None:
                        yield done()
                    tree, at = OpenTree(witnesses=False), (batch.column(0).slice(k, 1), position, total)
                tree.append(digest)
        if tree is not None:
            yield done()

    chosen = _in_blocks(nodes.select("group", "position", "total", "digest", "block"))
    return map_batches(chosen.drop("block"), run, f"group {kind}, position bigint, total bigint, digest string")


def _extended(nodes: DataFrame, above: DataFrame, carried: Sequence[str], levels: int) -> DataFrame:
    """Nodes with their witness, from steps within their block and the steps above it.

    ``above`` has, per group and block, the witness of the block's root, and ends, by name, what its tree led to.
    Its row comes first among the block's, so no node is joined with a long witness.
    """
    ends = [c for c in above.columns if c not in ("group", "block", "witness")]
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    out = {"group": kinds["group"], **{c: kinds[c] for c in carried}, "position": "bigint", "digest": "string"}
    schema = ", ".join(f"`{c}` {k}" for c, k in out.items()) + f", witness {STEP}" + "".join(f", {c} string" for c in ends)
    first = above.withColumn("position", F.lit(-1).cast("bigint")).withColumnRenamed("witness", "steps")
    both = nodes.select(*out, "block", "total").unionByName(first, allowMissingColumns=True)
    both = _in_blocks(both).drop("block")
    step_type = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def finished(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        head, rows = table.slice(0, 1), table.slice(1)
        if not rows.num_rows:
            return
        steps = [(s["before"], s["after"]) for s in head.column("steps").to_pylist()[0]]
        last = {c: head.column(c).to_pylist()[0] for c in ends}
        tree = OpenTree()
        for digest in rows.column("digest").to_pylist():
            tree.append(digest)
        tree.close(levels_of(rows.column("total")[0].as_py(), levels))
        for start in range(0, rows.num_rows, _SLICE):
            part = rows.slice(start, _SLICE).combine_chunks()
            paths = [[*path, *steps] for path in tree.witness[start : start + part.num_rows]]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype(np.int32)
            flat = [s for path in paths for s in path]
            pairs = pa.StructArray.from_arrays(
                [pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())], fields=list(step_type.value_type)
            )
            columns = [part.column(c).combine_chunks() for c in out]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(pa.array(offsets), pairs), *[pa.array([last[c]] * part.num_rows, pa.string()) for c in ends]],
                names=[*out, "witness", *ends],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = np.flatnonzero(batch.column(batch.schema.get_field_index("position")).to_numpy() == -1).tolist()
            for start, end in zip([0, *at], [*at, batch.num_rows], strict=True):
                if start in at and held:
                    yield from finished(held)
                    held = []
                if end > start:
                    held.append(batch.slice(start, end - start))
        if held:
            yield from finished(held)

    return map_batches(both, run, schema)


def _raised(nodes: DataFrame, levels: int) -> DataFrame:
    """Witness of each node up to its group's one remaining node: group, position, witness, top."""
    largest = nodes.agg(F.max("total")).first()[0] or 0
    if largest <= 1:
        return nodes.select("group", "position", F.array().cast(STEP).alias("witness"), F.col("digest").alias("top"))
    blocks = materialise(_block_roots(nodes, levels), "merkle-blocks")
    above = _raised(_with_block(blocks, levels), levels).withColumnRenamed("position", "block")
    return materialise(_extended(nodes, above, (), levels).select("group", "position", "witness", "top"), "merkle-witnesses")


def _with_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("position", levels * (FAN.bit_length() - 1)))


def _numbered(rows: DataFrame, order: Sequence[str], levels: int) -> DataFrame:
    """Rows with their position in their group, counted over ranges, and the group's total.

    Equal rows are told apart by a number of their own, so that they spread over ranges as well.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in ("group", *order, "tie")]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # Number of the range above 33 bits of the row's place in it.
    placed = materialise(dealt.drop("tie").withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy("group", part).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("group")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("group").alias("base_group"), "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(group).alias("total")
    )
    bases = materialise(bases, "merkle-bases")
    same = F.col("group").eqNullSafe(F.col("base_group")) & (F.shiftright("place", 33) == F.col("part"))
    found = placed.join(bases, same).withColumn("position", F.col("place") + F.col("shift"))
    return _with_block(found.drop("base_group", "part", "shift", "place"), levels)


def manifest(
    rows: DataFrame,
    fields: Sequence[str],
    *,
    key: str = "doc_id",
    group: str = "lang",
    carried: Mapping[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """key, group, carried columns, leaf, position, witness, subroot and root for every row.

    A leaf is the digest of the given fields. Leaves of a group ascend by key, nulls first, rows of equal key by
    leaf; groups ascend by the bytes of their text, null first. A null group is one of its own; null and empty
    fields differ; equal rows have one leaf each, side by side; the only leaf of a group is its subroot,
    the only subroot is the root, and a single row has an empty witness. An empty table gives no rows.
    Texts are hashed where they are read, whole, and only digests go on. ``carried`` are further
    columns over ``rows``; their names and those of other columns never clash with the operator's own.
    """
    extra = dict(carried or {})
    chosen = rows.select(
        F.col(f"`{group}`").cast("string").alias("group"),
        F.struct(F.col(f"`{key}`").alias("key"), *[c.alias(n) for n, c in extra.items()]).alias("row"),
        leaf_digest([F.col(f"`{f}`") for f in fields]).alias("digest"),
    )
    leaves = _numbered(chosen.withColumn("by", F.col("row.key")), ("by", "digest"), levels).drop("by")
    leaves = leaves.select("group", "position", "total", "block", "digest", "row")
    blocks = materialise(_block_roots(leaves, levels), "merkle-blocks")
    in_group = _raised(_with_block(blocks, levels), levels).withColumnRenamed("position", "block")
    # One node per group: appended once more, in the order of groups.
    subroots = in_group.filter("block = 0").select(F.lit("").alias("group"), F.col("group").alias("of"), F.col("top").alias("digest"))
    tops = _numbered(subroots, ("of",), levels)
    found = _raised(tops.select("group", "position", "total", "block", "digest"), levels)
    in_all = tops.select("of", "position").join(found.drop("group").withColumnsRenamed({"witness": "rest", "top": "root"}), "position").drop("position")
    above = in_group.join(in_all, F.col("group").eqNullSafe(F.col("of"))).select(
        "group", "block", F.concat("witness", "rest").alias("witness"), F.col("top").alias("subroot"), "root"
    )
    above = materialise(above, "merkle-above")
    named = [F.col("row.key").alias(key), F.col("group").alias(group), *[F.col(f"row.{n}").alias(n) for n in extra]]
    return _extended(leaves, above, ("row",), levels).select(*named, F.col("digest").alias("leaf"), "position", "witness", "subroot", "root")


_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered_proofs(docs: DataFrame, fields: Sequence[str], *, key: str = "doc_id", group: str = "lang", text: str = "text", levels: int = LEVELS) -> DataFrame:
    """Every row's proof, and whether the root is found again after some rows were changed.

    Where 3 divides the unsigned crc32 of the key in decimal, the capitals A-Z of the text become small
    letters; the leaf is computed again and folded with the witness of the unchanged table. Rows of a null key
    are not changed.
    """
    changed = leaf_digest([F.translate(F.col(f"`{f}`"), *_LOWER) if f == text else F.col(f"`{f}`") for f in fields])
    hit = F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 3 == 0
    proofs = manifest(docs, fields, key=key, group=group, carried={"__changed": F.when(hit, changed)}, levels=levels)
    root = folded(F.coalesce("__changed", "leaf"), F.col("witness"))
    return proofs.select(
        f"`{key}`", "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
