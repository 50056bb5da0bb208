"""Near copies among vectors: iterative quantisation, multi-index Hamming tables, exact rerank.

1. A bounded sample of unit vectors gives principal axes and, by iterative quantisation, rotations whose signs are
   balanced binary codes. A code has several rotations one after the other.
2. A code is cut into substrings of about as many bits as the number of vectors has. Each is the key of a Hamming table.
   How many tables it takes, and which Hamming distance a suspect may have, is measured on pairs made from the sample at exactly
   the wanted cosine: so many that ``target`` of them would be found.
3. Buckets of a table whose keys differ in at most one bit meet. Only short codes are compared there, in
   blocks of bounded size, and what goes on are pairs of home blocks that hold at least one suspect. A vector's home is
   the fullest of its buckets, so that near copies sit together; a full bucket is many home blocks.
4. Home blocks that are suspected are reranked with the original vectors: one matrix product for two blocks gives
   all cosines, the links of each vector and a spanning forest. Every pair of home blocks is computed once, so no link counts twice.

Equal vectors are one class with a number, so copies never meet one another. A group of near copies costs products
of blocks and never a row for each pair. The driver holds the sample, the rotations and one count for each table.

Defined results: vectors that are null or zero, hold null or non-finite components, or have another number of components
than most, link with nothing and are kept; rows that repeat an id are vectors of their own; a row with a null id links like others,
its component is the smallest id reached (null if there is none) and it is kept only then; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.ann import matrix
from tallyboard.llm.common import chunked, col, rows_of
from tallyboard.llm.graph import components
from tallyboard.scratch import stage

#: Vectors and numbers of the sample.
SAMPLE, SAMPLE_NUMBERS = 10_000, 2_000_000
#: Principal axes of a rotation, bits of a substring, and tables, at most.
AXES, KEY_BITS, TABLES = 128, 24, 48
#: Codes of a bucket, and vectors of a home, in one block.
BLOCK, HOME = 1024, 512
#: Pairs of codes that are compared at a time.
PAIRS = 1 << 21


# --- codes ------------------------------------------------------------------------------------------


def itq(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """A rotation that brings the rows of ``x`` close to corners of a cube (iterative quantisation)."""
    rng = np.random.default_rng(seed)
    r, _ = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
        r = (u @ v).T
    return r


@dataclass
class Codes:
    """Projections of unit vectors whose signs are the bits, cut into ``tables`` keys of ``bits`` bits."""

    mean: np.ndarray
    axes: np.ndarray
    bits: int
    tables: int
    radius: int

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors / np.linalg.norm(vectors, axis=1)[:, None] - self.mean
        signs = (x @ self.axes >= 0)[:, : self.bits * self.tables].reshape(len(x), self.tables, self.bits)
        return (signs @ (1 << np.arange(self.bits))).astype(np.int32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def learn(sample: np.ndarray, number: int, cosine: float, target: float, seed: int = 11) -> Codes:
    """Codes for about ``number`` vectors, with as many tables as pairs at ``cosine`` need to be found with ``target``."""
    x = unit(np.unique(sample, axis=0))
    mean = x.mean(0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    axes = axes[:AXES].T
    low = (x - mean) @ axes
    bits = min(KEY_BITS, max(4, math.ceil(math.log2(max(2, number)))))
    # Partners at exactly this cosine, in random directions.
    rng = np.random.default_rng(seed)
    one = x[rng.integers(0, len(x), 4000)]
    aside = rng.normal(size=one.shape)
    aside -= (aside * one).sum(1)[:, None] * one
    length = np.linalg.norm(aside, axis=1)[:, None]
    two = np.where(length > 1e-12, cosine * one + math.sqrt(1 - cosine**2) * aside / np.maximum(length, 1e-12), one)
    rotated, codes = [], Codes(mean, np.zeros((x.shape[1], 0)), bits, 0, 0)
    found = np.zeros(len(one), bool)
    while codes.tables < TABLES and (codes.tables == 0 or found.mean() < target):
        while codes.axes.shape[1] < bits * (codes.tables + 1):
            rotated.append(axes @ itq(low, seed + len(rotated)))
            codes.axes = np.column_stack(rotated)
        codes.tables += 1
        a, b = codes.keys(one), codes.keys(two)
        found |= np.bitwise_count(a[:, -1] ^ b[:, -1]) <= 1
    apart = np.bitwise_count(a ^ b).sum(1)
    codes.radius = int(np.quantile(apart, 0.5 + target / 2, method="higher")) + 1
    codes.axes = codes.axes[:, : bits * codes.tables]
    return codes


def _coded(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1)) + 0.0  # no negative zero: equal vectors have equal bytes
                keys = sent.value.keys(x)
                raw = [row.tobytes() for row in x.astype("<f8")]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([xxhash.xxh3_128_digest(r) for r in raw], pa.binary()), pa.array(raw, pa.binary()),
                    pa.array([k.tobytes() for k in keys.astype("<i4")], pa.binary()),
                ], ["id", "digest", "vector", "keys"])

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each table of a code."""
    for batch in batches:
        if batch.num_rows:
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), "<i4").reshape(batch.num_rows, -1)
            n, tables = keys.shape
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column("c").to_numpy(), tables)), pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(keys.ravel()),
            ], ["c", "t", "key"])


# --- suspects ---------------------------------------------------------------------------------------


def _suspects(radius: int):
    """Pairs of homes with codes at most ``radius`` bits apart, from pairs of blocks of codes."""

    def compared(homes_a, codes_a, of_a, homes_b, codes_b, of_b, same) -> np.ndarray:
        """``of_*``: where the codes of each row start, with an end; ``same``: rows of one block with itself."""
        na, nb = np.diff(of_a), np.diff(of_b)
        rows = np.repeat(np.arange(len(na)), na * nb)
        k = np.arange(len(rows)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
        i, j = k // nb[rows], k % nb[rows]
        once = ~same[rows] | (i < j)
        i, j = (i + of_a[rows])[once], (j + of_b[rows])[once]
        apart = np.zeros(len(i), np.int32)
        for t in range(codes_a.shape[1]):
            apart += np.bitwise_count(codes_a[i, t] ^ codes_b[j, t])
        i, j = i[apart <= radius], j[apart <= radius]
        found = np.column_stack([homes_a[i], homes_b[j]])
        found.sort(axis=1)
        return np.unique(found, axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = []
            for homes, codes in (("low_homes", "low_codes"), ("high_homes", "high_codes")):
                column = batch.column(homes)
                starts = column.offsets.to_numpy().astype(np.int64)
                raw = np.frombuffer(b"".join(batch.column(codes).flatten().to_pylist()), "<u4").reshape(starts[-1] - starts[0], -1)
                sides.append((column.flatten().to_numpy(), raw, starts - starts[0]))
            same = batch.column("alone").to_numpy(zero_copy_only=False)
            (ha, ca, oa), (hb, cb, ob) = sides
            work = np.cumsum(np.diff(oa) * np.diff(ob))
            cuts = [0, *(np.flatnonzero(np.diff(work // PAIRS)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    found = compared(ha, ca, oa[a : b + 1], hb, cb, ob[a : b + 1], same[a:b])
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["low", "high"])

    return run


# --- rerank -----------------------------------------------------------------------------------------


def cosines(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` have at least this cosine; those next to the bound are summed anew, row by row."""
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    found = (a @ b.T) / na[:, None] / nb
    near = found >= least
    i, j = np.nonzero(np.abs(found - least) < 1e-9)
    near[i, j] = (a[i] * b[j]).sum(1) / (na[i] * nb[j]) >= least
    return near


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what a symmetric matrix of links joins."""
    left, edges = np.ones(len(near), bool), []
    for k in range(len(near)):
        if left[k]:
            left[k] = False
            front = [k]
            while front:
                at = front.pop()
                fresh = np.flatnonzero(near[at] & left)
                left[fresh] = False
                edges.extend((at, int(x)) for x in fresh)
                front.extend(fresh.tolist())
    return edges


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def _linked(least: float):
    """(a, null, n): links of a class in two blocks; (a, b, null): edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for alone, ca, na, va, cb, nb, vb in rows_of(batches, "alone", "low_c", "low_n", "low_v", "high_c", "high_n", "high_v"):
                a, na = np.frombuffer(b"".join(va)).reshape(len(ca), -1), np.array(na)
                b, nb = np.frombuffer(b"".join(vb)).reshape(len(cb), -1), np.array(nb)
                near = cosines(a, b, least)
                if alone:
                    np.fill_diagonal(near, False)
                    yield from ((ca[k], None, int(n)) for k, n in enumerate((near * nb).sum(1)) if n)
                    yield from ((ca[i], ca[j], None) for i, j in forest(near | near.T))
                elif near.any():
                    yield from ((ca[k], None, int(n)) for k, n in enumerate((near * nb).sum(1)) if n)
                    yield from ((cb[k], None, int(n)) for k, n in enumerate((near.T * na).sum(1)) if n)
                    both = np.zeros((len(ca) + len(cb),) * 2, bool)
                    both[: len(ca), len(ca) :] = near
                    both[len(ca) :, : len(ca)] = near.T
                    names = [*ca, *cb]
                    yield from ((names[i], names[j], None) for i, j in forest(both))

        yield from chunked(rows(), _LINKS)

    return run


# --- the job ----------------------------------------------------------------------------------------



def suspected_homes(classes: DataFrame, bits: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(low, high) pairs of homes to rerank, and (home, c, copies, vector) blocks, from classes (c, copies, vector, keys)."""
    entries = stage(classes.select("c", "keys").mapInArrow(_unpacked, "c long, t int, key int"), "codes")
    sizes = entries.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size"))
    sizes = stage(sizes.withColumns({"blocks": F.ceil(F.col("size") / BLOCK).cast("int"), "homes": F.ceil(F.col("size") / HOME).cast("int")}), "buckets")
    placed = stage(entries.join(sizes, ["t", "key"]), "placed")
    fullest = placed.groupBy("c").agg(F.max(F.struct("size", -F.col("t"), "key", "homes")).alias("f"))
    home = F.shiftleft((-F.col("f.col2")).cast("long"), 56).bitwiseOR(F.shiftleft(F.col("f.key").cast("long"), 32)).bitwiseOR(F.pmod(F.xxhash64("c"), F.col("f.homes")))
    homes = stage(classes.join(fullest, "c").select("c", "copies", "vector", "keys", home.alias("home")), "homes")

    codes = placed.select("c", "t", "key", "blocks").join(homes.select("c", "home", "keys"), "c")
    blocks = codes.groupBy("t", "key", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int").alias("block")).agg(F.collect_list(F.struct("home", "keys")).alias("rows"))
    blocks = stage(blocks.select("t", "key", "block", F.col("rows.home").alias("homes"), F.col("rows.keys").alias("codes")), "blocks")
    flips = F.array(*[F.lit(0), *[F.lit(1 << k) for k in range(bits)]])
    moved = sizes.select("t", "key", F.col("blocks").alias("low_blocks"), F.explode(F.transform(flips, lambda x: F.col("key").bitwiseXOR(x))).alias("key2"))
    moved = moved.where(F.col("key") <= F.col("key2"))
    met = moved.join(sizes.select("t", F.col("key").alias("key2"), "blocks"), ["t", "key2"])
    pairs = met.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("low_blocks") - 1)))
    pairs = pairs.withColumn("block2", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    itself = F.col("key") == F.col("key2")
    pairs = pairs.where(~itself | (F.col("block") <= F.col("block2"))).withColumn("alone", itself & (F.col("block") == F.col("block2")))
    low = blocks.withColumnsRenamed({"homes": "low_homes", "codes": "low_codes"})
    high = blocks.withColumnsRenamed({"key": "key2", "block": "block2", "homes": "high_homes", "codes": "high_codes"})
    # A block of one code has nothing to be compared with in itself.
    pairs = pairs.select("t", "key", "block", "key2", "block2", "alone").join(low, ["t", "key", "block"]).where("NOT alone OR size(low_homes) > 1")
    pairs = pairs.join(high, ["t", "key2", "block2"]).repartition(classes.sparkSession.sparkContext.defaultParallelism, "t", "key", "block", "key2", "block2")
    found = pairs.select("low_homes", "low_codes", "high_homes", "high_codes", "alone").mapInArrow(_suspects(radius), "low long, high long")
    suspects = stage(found.distinct(), "suspects")
    held = homes.groupBy("home").agg(F.collect_list(F.struct("c", "copies", "vector")).alias("rows"))
    held = held.select("home", F.col("rows.c").alias("c"), F.col("rows.copies").alias("n"), F.col("rows.vector").alias("v"))
    return suspects, stage(held, "home-blocks")


def near_vectors(
    vectors: DataFrame, cosine: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding", target: float = 0.998,
) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row; links are pairs with at least this cosine, in double precision.

    ``target`` is the share of pairs at exactly the bound that the tables shall find; nearer pairs are found more often.
    """
    spark = vectors.sparkSession
    vector = col(vector_column).cast("array<double>")
    fine = (
        vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(vector, lambda v: v != 0)
    )
    source = vectors.select(col(id_column).cast("long").alias("id"), F.when(fine, vector).alias("vector"))
    sizes = source.where("vector IS NOT NULL").groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    size = sizes[0].n if sizes else -1
    usual = F.coalesce(F.size("vector") == size, F.lit(False))
    alone = source.where(~usual).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if not sizes:
        return alone
    entries = source.where(usual)
    least = min(SAMPLE, max(100, SAMPLE_NUMBERS // size))
    sample = entries.orderBy(F.xxhash64("vector"), "id").limit(least).select("vector").collect()
    codes = learn(np.array([r.vector for r in sample]), sizes[0]["count"], cosine, target)
    sent = spark.sparkContext.broadcast(codes)
    coded = stage(entries.mapInArrow(_coded(sent), "id long, digest binary, vector binary, keys binary"), "coded")
    classes = coded.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.first("vector").alias("vector"), F.first("keys").alias("keys"))
    classes = stage(classes.withColumn("c", F.monotonically_increasing_id()), "classes")

    suspects, homes = suspected_homes(classes, codes.bits, codes.radius)
    low = homes.select(F.col("home").alias("low"), *[F.col(x).alias(f"low_{x}") for x in ("c", "n", "v")])
    high = homes.select(F.col("home").alias("high"), *[F.col(x).alias(f"high_{x}") for x in ("c", "n", "v")])
    met = suspects.join(low, "low").join(high, "high").withColumn("alone", F.col("low") == F.col("high"))
    met = met.repartition(spark.sparkContext.defaultParallelism, "low", "high")
    linked = stage(met.select("alone", *low.columns[1:], *high.columns[1:]).mapInArrow(_linked(cosine), "a long, b long, n long"), "links")
    numbers = linked.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "c")
    reached = components(linked.where("b IS NOT NULL").select("a", "b")).withColumnsRenamed({"id": "c", "component": "of"})
    named = classes.select("c", "digest", "copies", "least").join(numbers, "c", "left").join(reached, "c", "left")
    labels = named.where("of IS NOT NULL").groupBy("of").agg(F.min("least").alias("label"))
    named = named.join(labels, "of", "left").select(
        "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.when(F.col("of").isNull(), F.col("least")).otherwise(F.col("label")).alias("component_id")
    )
    rows = coded.select("id", "digest").join(named, "digest").select(
        "id", "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept")
    )
    return rows.union(alone)
