"""Chat formatting with collapse of cumulative snapshots.

Chat logs often hold a conversation many times, each time some turns longer. Every turn gets the
hash of the conversation up to it: a running sum of hashes of (position, role, text). A
conversation whose whole hash is the hash of a proper prefix of another is dropped by an anti-join;
of equal conversations the smallest id stays; what remains is rendered.

Only DataFrame expressions. All turns are dealt out by ranges of their order; positions and sums run within a
range and are carried from range to range, so a conversation of any length is spread over tasks, whatever its
turn numbers are, and is rendered in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardline.llm.text import materialise

#: Turns that make a rendered part, and characters of a text by which turns of one number and role are dealt out.
BLOCK = 1024
PREFIX = 32
START, END = "<|im_start|>", "<|im_end|>"
DEFAULT_ROLE = "user"


def _hash(salt: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(salt), *columns).cast("decimal(20,0)")


def numbered_turns(
    log: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """c (struct of the id), role, text, position and p1, p2 (hash of the conversation up to here).

    Turns of one conversation, number and role whose texts also begin alike share a range; equal rows are one.
    """
    rows = log.select(
        F.struct(F.col(f"`{conversation}`").alias("id")).alias("c"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.nullif(F.lower(F.trim(F.col(f"`{role}`"))), F.lit("")), F.lit(DEFAULT_ROLE)).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).distinct()
    ranges = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, "c", "turn", "role", F.substring("text", 1, PREFIX))
    ordered = dealt.sortWithinPartitions("c", "turn", "role", "text")
    # Number of the range above 33 bits of the row's place in it.
    placed = materialise(ordered.drop("turn").withColumn("place", F.monotonically_increasing_id()), "turn-order")
    placed = placed.withColumn("range", F.shiftright("place", 33))
    earlier = Window.partitionBy("c").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("c", "range").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    bases = materialise(sizes.select("c", "range", (before - F.col("first") + 1).alias("shift")), "turn-bases")
    hashed = placed.join(bases, ["c", "range"]).withColumn("position", F.col("place") + F.col("shift"))
    hashed = materialise(
        hashed.select(
            "c", "range", "role", "text", "position",
            _hash(1, F.col("position"), F.col("role"), F.col("text")).alias("h1"),
            _hash(2, F.col("position"), F.col("role"), F.col("text")).alias("h2"),
        ),
        "turns",
    )
    sums = hashed.groupBy("c", "range").agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
    nothing = F.lit(0).cast("decimal(38,0)")
    carried = materialise(
        sums.select(
            "c", "range", *(F.coalesce(F.sum(f"s{k}").over(earlier).cast("decimal(38,0)"), nothing).alias(f"b{k}") for k in (1, 2))
        ),
        "turn-sums",
    )
    running = Window.partitionBy("c", "range").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return hashed.join(carried, ["c", "range"]).select(
        "c", "role", "text", "position",
        *((F.col(f"b{k}") + F.sum(f"h{k}").over(running)).cast("decimal(38,0)").alias(f"p{k}") for k in (1, 2)),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """c, n_turns, n_copies of conversations that are no proper prefix of another, one of equal ones."""
    whole = turns.groupBy("c").agg(F.max(F.struct("position", "p1", "p2")).alias("w"))
    whole = materialise(whole.select("c", F.col("w.position").alias("n_turns"), "w.p1", "w.p2"), "conversations")
    one = whole.groupBy("n_turns", "p1", "p2").agg(F.min("c").alias("c"), F.count("*").alias("n_copies"))
    inner = (
        turns.join(whole.select("c", "n_turns"), "c").filter(F.col("position") < F.col("n_turns"))
        .select(F.col("position").alias("n_turns"), "p1", "p2").distinct()
    )
    return one.join(inner, ["n_turns", "p1", "p2"], "left_anti").select("c", "n_turns", "n_copies")


def format_chats(
    log: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """Rendered maximal conversations: id, part, n_turns, n_copies (equal ones, itself included), text.

    Turns are ordered by turn, role and text; a repeated row counts once. Roles are lower-cased and
    trimmed, null or blank ones are the user's; a null text is empty; a null turn comes first; rows
    of null id are one conversation. Very long texts are hashed and rendered whole. A conversation of more than ``block`` turns is rendered in
    parts of that many; an empty table gives an empty result; other columns are not read.
    """
    names = {"conversation": conversation, "turn": turn, "role": role, "text": text}
    turns = materialise(numbered_turns(log, **names), "numbered-turns")
    kept = materialise(maximal_conversations(turns), "maximal")
    piece = F.concat(F.lit(START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(f"{END}\n"))
    parts = (
        turns.join(kept, "c")
        .select("c", "n_turns", "n_copies", F.floor((F.col("position") - 1) / block).alias("part"), "position", piece.alias("piece"))
        .groupBy("c", "part", "n_turns", "n_copies")
        .agg(F.sort_array(F.collect_list(F.struct("position", "piece"))).alias("pieces"))
    )
    return parts.select(
        F.col("c.id").alias(conversation), "part", "n_turns", "n_copies",
        F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("text"),
    )
