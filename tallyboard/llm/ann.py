"""Nearest neighbours by inner product with an inverted multi-index.

1. Vectors get one more component that makes all of them equally long, so the largest inner product is
   the smallest distance. Both halves of a bounded sample are clustered (k-means); a cell is a pair of
   centroids, one of each half. Every vector is put into its cell.
2. A query sorts the centroids of each half by distance and walks the pairs by summed distance with a
   heap, until the cells it met hold ``share`` of all vectors, and at least ``least`` for each neighbour
   wanted. Here copies count once in a cell, so a common vector does not end the walks that meet it.
3. Cells of one first-half centroid are reranked together, by exact inner products of the original
   vectors; each task gives a query's best few, which are merged.

Vectors of a centroid are dealt over several tasks if they are many, so a common vector's copies do not
meet in one task. The driver holds the sample, the codebooks and one count for each cell: fixed sizes.

Defined results: vectors that are null or zero, or hold null or non-finite components, or have another
number of components than most, take no part; rows with the query's own id are no candidates, other repeated
rows are each; ties go
to the smaller id; fewer candidates than ``k`` are all returned, as every walk meets ``least * k`` vectors
where there are so many.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm.common import chunked, col, rows_of
from tallyboard.scratch import stage

SAMPLE = 20_000
#: Vectors that are reranked in one task at a time.
BLOCK = 8192


@dataclass
class Index:
    """Codebooks of both halves (of lengthened vectors), the common length, and how many different vectors each cell has."""

    first: np.ndarray
    second: np.ndarray
    norm: float
    counts: np.ndarray

    def halves(self, vectors: np.ndarray, queries: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the centroids of each half."""
        if queries:
            more = np.zeros(len(vectors))
        else:
            more = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(1), 0))
        half = self.first.shape[1]
        return distances(vectors[:, :half], self.first), distances(np.column_stack([vectors[:, half:], more]), self.second)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.halves(vectors)
        return a.argmin(1), b.argmin(1)


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] + (centers**2).sum(1) - 2 * x @ centers.T, 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """At most ``k`` centroids; fewer if there are fewer different vectors."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centers = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        nearest = distances(x, centers).argmin(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, x)
        number = np.bincount(nearest, minlength=len(centers))[:, None]
        centers = np.where(number > 0, sums / np.maximum(number, 1), centers)
    return centers


def walk(a: np.ndarray, b: np.ndarray, counts: np.ndarray, wanted: int) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by rising ``a[i] + b[j]`` until their cells hold ``wanted`` vectors.

    A pair enters the heap once both its neighbours towards the front have left it, so the heap stays small.
    """
    by_a, by_b = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
    da, db = a[by_a].tolist(), b[by_b].tolist()
    numbers = counts[by_a][:, by_b].tolist()
    heap, reached = [(da[0] + db[0], 0, 0)], [0] * len(da)  # reached: pairs of a row that have left the heap
    held = 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        if numbers[i][j]:
            held += numbers[i][j]
            yield by_a[i], by_b[j]
        if i + 1 < len(da) and reached[i + 1] == j and (j == 0 or reached[i + 1] >= j):
            heapq.heappush(heap, (da[i + 1] + db[j], i + 1, j))
        if j + 1 < len(db) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))


def valid_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    vector = col(vector_column).cast("array<double>")
    fine = (
        vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(vector, lambda v: v != 0)
    )
    found = df.select(col(id_column).cast("long").alias("id"), vector.alias("vector")).where(fine & col(id_column).isNotNull())
    size = found.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return found.where(F.size("vector") == (size[0].n if size else 0))


def matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _assign(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                i, j = sent.value.cells(matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *batch.columns], ["i", "j", "id", "vector"])

    return run


def _probe(sent, wanted: int):
    schema = pa.schema([("i", pa.int32()), ("js", pa.list_(pa.int32())), ("query_id", pa.int64()), ("vector", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            index = sent.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = matrix(batch.column(1))
                a, b = index.halves(vectors, queries=True)
                for k, query in enumerate(batch.column(0).to_pylist()):
                    met: dict[int, list[int]] = {}
                    for i, j in walk(a[k], b[k], index.counts, wanted):
                        met.setdefault(i, []).append(j)
                    for i, js in met.items():
                        yield i, js, query, vectors[k]

        yield from chunked(rows(), schema)

    return run


def rerank(ids: np.ndarray, vectors: np.ndarray, js: np.ndarray, query: int, vector: np.ndarray, near: np.ndarray, cells: list[int], k: int, slack: float):
    """The best ``k`` of the entries in these cells. ``near`` are quick products, off by less than ``slack``, that only preselect."""
    open_ = np.flatnonzero(np.isin(js, cells) & (ids != query))
    if len(open_) > k:
        least = np.partition(near[open_], -k)[-k]
        open_ = open_[near[open_] >= least - slack]
    scores = (vectors[open_] * vector).sum(1)
    best = np.lexsort((ids[open_], -scores))[:k]
    return ids[open_][best], scores[best]


def _rerank(k: int):
    def run(key, entries, queries):
        out = {"query_id": [], "vec_id": [], "score": []}
        if entries.num_rows and queries.num_rows:
            ids, js, vectors = entries.column("id").to_numpy(), entries.column("j").to_numpy(), matrix(entries.column("vector"))
            asked, cells = queries.column("query_id").to_pylist(), queries.column("js").to_pylist()
            wanted = matrix(queries.column("vector"))
            # Rounding errors are in proportion to the lengths of both vectors, also where their product is small.
            slack = 1e-12 * np.sqrt((vectors**2).sum(1).max()) * np.sqrt((wanted**2).sum(1))
            for at in range(0, len(asked), 256):
                near = wanted[at : at + 256] @ vectors.T
                for n in range(at, min(at + 256, len(asked))):
                    found, scores = rerank(ids, vectors, js, asked[n], wanted[n], near[n - at], cells[n], k, slack[n])
                    out["query_id"].append(np.full(len(found), asked[n]))
                    out["vec_id"].append(found)
                    out["score"].append(scores)
        arrays = [pa.array(np.concatenate(v).astype(kind) if v else np.empty(0, kind)) for v, kind in zip(out.values(), ("i8", "i8", "f8"), strict=True)]
        return pa.Table.from_arrays(arrays, names=list(out))

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame | None = None, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
    codewords: int = 64, share: float = 0.5, least: int = 20,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` vectors with the largest inner product.

    ``queries`` has the same two columns (default: all vectors). ``codewords`` is the size of each half's
    codebook. Vectors without any structure need a large ``share``; clustered ones a small one. A walk meets at
    least ``least * k`` different vectors.
    """
    spark = vectors.sparkSession
    entries = valid_vectors(vectors, id_column, vector_column)
    asked = entries if queries is None else valid_vectors(queries, id_column, vector_column)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = [r.vector for r in entries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()]
    if not sample:
        return empty
    x = np.array(sample)
    size = x.shape[1]
    norm = entries.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v))).first()[0] ** 0.5
    half = size // 2
    more = np.sqrt(np.maximum(norm**2 - (x**2).sum(1), 0))
    index = Index(kmeans(x[:, :half], codewords), kmeans(np.column_stack([x[:, half:], more]), codewords), norm, np.zeros((1, 1)))
    sent = spark.sparkContext.broadcast(index)
    placed = stage(entries.mapInArrow(_assign(sent), "i int, j int, id long, vector array<double>"), "index")
    counts = np.zeros((len(index.first), len(index.second)), np.int64)
    rows = np.zeros_like(counts)
    different = placed.groupBy("i", "j", F.xxhash64("vector").alias("h")).count()
    for r in different.groupBy("i", "j").agg(F.count("*").alias("n"), F.sum("count").alias("rows")).collect():  # at most codewords squared
        counts[r.i, r.j], rows[r.i, r.j] = r.n, r.rows
    with_counts = spark.sparkContext.broadcast(Index(index.first, index.second, norm, counts))
    wanted = max(least * k + 1, math.ceil(share * int(counts.sum())))

    probes = asked.where(F.size("vector") == size).mapInArrow(
        _probe(with_counts, wanted), "i int, js array<int>, query_id long, vector array<double>"
    )
    blocks = [max(1, math.ceil(int(n) / BLOCK)) for n in rows.sum(1)]
    block_of = F.element_at(F.array(*[F.lit(n) for n in blocks]), F.col("i") + 1)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), block_of).cast("int"))
    probes = probes.withColumn("block", F.explode(F.sequence(F.lit(0), block_of - 1)))
    found = placed.groupBy("i", "block").cogroup(probes.groupBy("i", "block")).applyInArrow(
        _rerank(k), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
