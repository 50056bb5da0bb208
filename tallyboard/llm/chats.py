"""Logged conversations: snapshots that a longer conversation begins with are dropped, the rest rendered.

A chat log often holds a conversation once for every answer, each time a turn longer. The hash of a
turn prefix is the exclusive or of a 128-bit hash of each (place, role, text), so it rolls along a conversation
in one pass. Identical conversations are collapsed to the smallest id; then an anti-join drops every
conversation whose hash is that of a proper prefix of another. Only hashes are shuffled for that; prefixes
are reduced to distinct ones before it, so a first turn that very many conversations share is one row.

Defined results: turns are ordered by (turn, role, text), nulls first; rows that repeat a whole turn of their
conversation count once; rows with a null id are left out; a null role or text differs from an empty one
in comparison and is rendered as empty; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm.common import col


def _turn_hash(seed: int) -> Column:
    marked = [F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return F.xxhash64(F.lit(seed), F.col("place"), *marked)


def with_prefix_hashes(turns: DataFrame) -> DataFrame:
    """``id, turn, role, text`` with ``place`` (from 1), the hash of all turns up to it, and whether more follow."""
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.dropDuplicates(["id", "turn", "role", "text"]).withColumn("place", F.row_number().over(order))
    return placed.withColumns({"a": _turn_hash(1), "b": _turn_hash(2)}).withColumns({
        "a": F.bit_xor("a").over(so_far), "b": F.bit_xor("b").over(so_far),
        "more": F.lead("place").over(order).isNotNull(),
    })


def maximal(conversations: DataFrame, id_column="conv_id", turn_column="turn", role_column="role", text_column="text") -> DataFrame:
    """``conv_id, n_turns, n_copies, rendered`` of the conversations that are no prefix of another one.

    ``n_copies`` counts the identical conversations, this one included.
    """
    turns = conversations.select(
        col(id_column).cast("long").alias("id"), col(turn_column).cast("long").alias("turn"),
        col(role_column).cast("string").alias("role"), col(text_column).cast("string").alias("text"),
    ).where(F.col("id").isNotNull())
    hashed = with_prefix_hashes(turns)
    whole = hashed.where(~F.col("more")).select("id", "a", "b", "place")
    kept = whole.groupBy("a", "b").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n_copies"), F.max("place").alias("n_turns"))
    prefixes = hashed.where("more").select("a", "b").distinct()
    longest = kept.join(prefixes, ["a", "b"], "left_anti").select("id", "n_copies", F.col("n_turns").cast("long").alias("n_turns"))
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    rendered = hashed.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"))
    return longest.join(rendered, "id").select(
        F.col("id").alias("conv_id"), "n_turns", "n_copies", F.array_join(F.col("lines.line"), "").alias("rendered")
    )
