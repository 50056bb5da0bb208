"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import rows_of
from tallyboard.scratch import stage

#: Rows of a file of edges or parents; many small files would cost more than they hold.
ROWS = 250_000
#: So few edges are joined by one task: a round of their own would cost jobs and no work.
LAST = 4096


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parents: dict[int, int] = {}

    def root(k: int) -> int:
        while parents.setdefault(k, k) != k:
            parents[k] = parents[parents[k]]
            k = parents[k]
        return k

    for a, b in rows_of(batches, "a", "b"):
        low, high = sorted((root(a), root(b)))
        parents[high] = low
    ids = list(parents)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(map(root, ids), pa.int64())], ["id", "parent"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the edges (a, b); the component is the smallest id in it.

    Rounds of contraction: every node takes the first of itself and its neighbours, in an order that is random and new in
    each round, as its parent; parents of parents follow twice, and edges go on between parents. At least half of the nodes leave
    in a round, on long paths too. The last few edges, a fixed number, are joined by one task. At the end the parents are followed back from
    the last round to the first.
    """
    links = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while number := links.count():
        if number <= LAST:
            rounds.append(stage(links.coalesce(1).mapInArrow(_joined, "id long, parent long"), "parents"))
            break
        files = max(1, -(-number // ROWS))
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(len(rounds))).alias("h"), F.col(c).alias("id"))
        first = both.groupBy("a").agg(F.min(order("b")).alias("b"))
        parents = stage(first.select(F.col("a").alias("id"), F.least(order("a"), F.col("b"))["id"].alias("parent")).coalesce(files), "parents")
        for _ in range(2):
            further = parents.select(F.col("id").alias("parent"), F.col("parent").alias("further"))
            parents = parents.join(further, "parent").select("id", F.col("further").alias("parent"))
        parents = stage(parents.coalesce(files), "parents")
        rounds.append(parents)
        links = links.join(parents.withColumnsRenamed({"id": "a", "parent": "c"}), "a").join(parents.withColumnsRenamed({"id": "b", "parent": "d"}), "b")
        links = stage(links.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).where("a != b").distinct().coalesce(files), "edges")
    if not rounds:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = rounds.pop()
    while rounds:
        further = roots.select(F.col("id").alias("parent"), F.col("parent").alias("root"))
        roots = rounds.pop().join(further, "parent", "left").select("id", F.coalesce("root", "parent").alias("parent"))
    roots = stage(roots, "roots")
    return roots.join(roots.groupBy("parent").agg(F.min("id").alias("component")), "parent").select("id", "component")
