"""Documents whose word shingles overlap enough, by T-occurrence search (DivideSkip) inside small buckets.

1. Shingles are 64-bit hashes. Documents with equal sets form a class; one member stands for it.
2. Prefix filter: in any common order of shingles, two sets of Jaccard similarity t share at least l of
   their first ``n - ceil(t n) + l``; l is a twentieth of the set here. The order puts rare shingles first:
   a share of all shingles is counted over all documents, and those found in 2, 8, 32... documents are put
   into Bloom filters of bounded size. Shingles in no filter come first; they are in one document only,
   so they are never sent on. A full filter makes the order worse, not the result.
3. Shingles with the same list of documents become one list with a weight. Lists and documents that cannot
   reach their overlap any more are left out in turn. Documents that share lists of weight l are joined to a cluster: first
   neighbours in the lists' order, then, where a list still holds several clusters, all that meet at one of each
   document's rarest lists. A very long list joins all its documents.
4. Whole sets are then fetched for the documents of clusters alone; a Bloom filter of bounded size spares most others the
   shuffle. A cluster of bounded size is a bucket. A large one (a big group of near copies) is dealt by each
   document's first list into buckets of bounded size, each with a few anchors that tie the buckets
   together. Where documents of a cluster are then still of different components, all pairs of blocks
   are searched but for those of one component: nothing is left out.
5. In a bucket, documents are searched one after the other: short inverted lists are merged with a heap,
   the longest ones are only probed by binary search, and a document that reaches the required overlap is
   a link. A component that is linked already is not searched again, so a bucket gives fewer links
   than documents, however many pairs are alike.

Defined results: a text without words, empty or null has an empty set and links with nothing; fewer words
than a shingle has make one shingle; rows that repeat an id are documents of their own that share a
number; a row with a null id has the component of its class, null if it is alone; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm import bloom
from tallyboard.llm.common import chunked, col, rows_of, sequence_hashes
from tallyboard.llm.graph import components
from tallyboard.scratch import Scratch, stage

#: Bits of the largest filter that is sent to every task: 64 MB.
MOST_BITS = 1 << 29
PROBES = 3
#: Shingles in at least so many documents are told apart.
LEVELS = (2, 8, 32, 128, 512, 2048)
#: Shingles in a bucket, and documents.
BUCKET_SHINGLES, BUCKET_DOCS = 500_000, 2000
ANCHORS = 8
#: Documents of a list that are compared by their lists; a longer list is one cluster.
LIST_DOCS = 2000
#: Lists of a group that are compared at a time.
COLUMNS = 2048
#: Rounds in which lists and documents that have become useless are left out.
PRUNING = 3
#: Shingles that a counting task holds before it passes them on.
HELD = 1 << 21


def shingles(text: str | None, words: int) -> np.ndarray:
    """Hashes of the distinct shingles, ascending. Space is what ``bytes.split`` cuts at, lower case is A-Z."""
    found = (text or "").encode().lower().split()
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    return np.unique(sequence_hashes(hashed, min(words, max(1, len(found)))))


# --- the order of shingles ------------------------------------------------------------------------


def wanted_overlap(n: int) -> int:
    """How many prefix shingles a similar pair shares at least, ``n`` being the size of its smaller set."""
    return max(1, n // 20)


def smallest_partner(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def counted_share(percent: int) -> int:
    """Eighths of all shingles that are counted: enough that the rare ones among them fill the prefix."""
    return min(8, -(-8 * 5 * (100 - percent + 5) // 200))


def _counted(words: int, eighths: int, segment_bits: int):
    schema = pa.schema([("segment", pa.int32()), ("hashes", pa.binary()), ("numbers", pa.binary())])

    def passed(held: list[np.ndarray]) -> Iterator[tuple]:
        """Each hash and its number of documents, cut by the highest bits."""
        found, number = np.unique(np.concatenate(held), return_counts=True)
        segments = (found >> np.uint64(64 - segment_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(segments)) + 1
        for part, n in zip(np.split(found, cuts), np.split(np.minimum(number, 65_535).astype("<u2"), cuts), strict=True):
            yield int(part[0] >> np.uint64(64 - segment_bits)), part.astype("<u8").tobytes(), zlib.compress(n.tobytes(), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held, number = [], 0
            for (text,) in rows_of(batches, "text"):
                s = shingles(text, words)
                held.append(s[(s & np.uint64(7)) < eighths])
                number += len(held[-1])
                if number >= HELD:
                    yield from passed(held)
                    held, number = [], 0
            if number:
                yield from passed(held)

        yield from chunked(rows(), schema)

    return run


def _repeated(key, part):
    hashes = np.frombuffer(b"".join(part.column("hashes").to_pylist()), "<u8")
    numbers = np.frombuffer(b"".join(map(zlib.decompress, part.column("numbers").to_pylist())), "<u2")
    found, place = np.unique(hashes, return_inverse=True)
    number = np.bincount(place, numbers, len(found))
    level = np.searchsorted(LEVELS, number, side="right")
    rows = [(k, found[level > k]) for k in range(len(LEVELS))]
    return pa.table({
        "level": pa.array([k for k, _ in rows], pa.int32()), "n": pa.array([len(x) for _, x in rows], pa.int64()),
        "hashes": pa.array([x.tobytes() for _, x in rows], pa.binary()),
    })


def bits_of(hashes: np.ndarray, size: int) -> np.ndarray:
    step = (hashes >> np.uint64(29)) | np.uint64(1)
    return ((hashes[:, None] >> np.uint64(3)) + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(size - 1)


def _filter_parts(sizes: dict[int, int]):
    """The bits of some segments for the filter of each level, cut into parts of a megabyte."""
    schema = pa.schema([("level", pa.int32()), ("part", pa.int32()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: np.zeros(size // 8, np.uint8) for k, size in sizes.items()}
        for level, hashes in rows_of(batches, "level", "hashes"):
            if hashes:
                bits = bits_of(np.frombuffer(hashes, "<u8"), sizes[level]).ravel()
                np.bitwise_or.at(held[level], (bits >> np.uint64(3)).astype(np.int64), (1 << (bits & np.uint64(7))).astype(np.uint8))
        rows = (
            (level, at >> 20, zlib.compress(bits[at : at + (1 << 20)].tobytes(), 1))
            for level, bits in held.items() for at in range(0, len(bits), 1 << 20) if bits[at : at + (1 << 20)].any()
        )
        yield from chunked(rows, schema)

    return run


def _merge_parts(key, part):
    merged = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(x), np.uint8) for x in part.column("bits").to_pylist()])
    return pa.table({
        "level": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()),
        "bits": pa.array([zlib.compress(merged.tobytes(), 1)], pa.binary()),
    })


def repeated_filters(texts: DataFrame, words: int, eighths: int) -> list[np.ndarray]:
    """For each level a Bloom filter of the counted shingles in so many documents or more."""
    files = texts.rdd.getNumPartitions()
    segment_bits = min(16, max(4, math.ceil(math.log2(4 * max(1, files)))))
    counted = texts.mapInArrow(_counted(words, eighths, segment_bits), "segment int, hashes binary, numbers binary")
    repeated = stage(counted.groupBy("segment").applyInArrow(_repeated, "level int, n long, hashes binary"), "repeated-shingles")
    numbers = {r.level: r.n for r in repeated.groupBy("level").agg(F.sum("n").alias("n")).collect()}
    sizes = {k: min(MOST_BITS, 1 << max(13, math.ceil(math.log2(max(1, 12 * numbers.get(k, 0)))))) for k in range(len(LEVELS))}
    out = [np.zeros(sizes[k] // 8, np.uint8) for k in range(len(LEVELS))]
    bits = repeated.coalesce(8).mapInArrow(_filter_parts(sizes), "level int, part int, bits binary")
    # All filters together are at most twice MOST_BITS, as each level holds a part of the one before.
    for r in bits.groupBy("level", "part").applyInArrow(_merge_parts, "level int, part int, bits binary").collect():
        piece = np.frombuffer(zlib.decompress(bytes(r.bits)), np.uint8)
        out[r.level][r.part << 20 : (r.part << 20) + len(piece)] = piece
    return out


def ranks(s: np.ndarray, filters: list[np.ndarray], eighths: int) -> np.ndarray:
    """The common order: 0 for shingles of one document, then by level; uncounted ones come last."""
    out = np.where((s & np.uint64(7)) < eighths, 0, len(LEVELS) + 1)
    left = np.flatnonzero(out == 0)
    for level, filled in enumerate(filters):
        bits = bits_of(s[left], len(filled) * 8)
        inside = ((filled[(bits >> np.uint64(3)).astype(np.int64)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
        left = left[inside]
        out[left] = level + 1
    return out


def prefix(s: np.ndarray, filters: list[np.ndarray], eighths: int, percent: int) -> np.ndarray:
    """The prefix of a set in the common order, without shingles that no other document has."""
    if not len(s):
        return s
    n = len(s) - smallest_partner(len(s), percent) + wanted_overlap(len(s))
    rank = ranks(s, filters, eighths)
    first = np.argsort(rank, kind="stable")[:n]
    first = first[rank[first] > 0]
    return s[first] if len(first) >= wanted_overlap(smallest_partner(len(s), percent)) else s[:0]


def _describe(words: int, eighths: int, percent: int, sent):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("tokens", pa.list_(pa.int64())), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for key, text in rows_of(batches, "id", "text"):
                s = shingles(text, words)
                first = prefix(s, sent.value, eighths, percent)
                whole = s.astype("<u8").tobytes()
                digest = xxhash.xxh3_128_digest(whole) if len(s) else None
                yield key, len(s), digest, first.view(np.int64) if len(first) else None, whole if len(first) else None

        yield from chunked(rows(), schema)

    return run


# --- search in a bucket -----------------------------------------------------------------------------


class Bucket:
    """Sets added one by one; each is searched among those before it."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lists: dict[int, list[int]] = {}
        self.sets: list[int] = []
        self.parents: list[int] = []
        self.roots: set[int] = set()

    def root(self, k: int) -> int:
        while self.parents[k] != k:
            self.parents[k] = self.parents[self.parents[k]]
            k = self.parents[k]
        return k

    def needed(self, n: int, m: int) -> int:
        """The least overlap of two sets that are similar enough."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def search(self, found: list[int], done: set[int]) -> Iterator[int]:
        """One similar set of every component that is not in ``done``."""
        n = len(found)
        least = smallest_partner(n, self.percent)
        lists = sorted((self.lists[x] for x in found if x in self.lists), key=len)
        if len(lists) < least or not self.roots - done:
            return
        # DivideSkip: so many of the longest lists are only probed; at least one hit is needed in the others.
        many = min(least - 1, int(least / (0.01 * math.log2(len(lists[-1]) + 1) + 1)))
        short, long = lists[: len(lists) - many], lists[len(lists) - many :]
        for k, hits in groupby(heapq.merge(*short)):
            m = self.sets[k]
            need = self.needed(n, m)
            if m < least or need > n or self.root(k) in done:
                continue
            hit = sum(1 for _ in hits)
            left = len(long)
            for entries in long:
                if hit >= need or hit + left < need:
                    break
                at = bisect_left(entries, k)
                hit += at < len(entries) and entries[at] == k
                left -= 1
            if hit >= need:
                yield k
                done.add(self.root(k))
                if not self.roots - done:
                    return

    def add(self, found: list[int], same: int | None = None) -> list[int]:
        """Adds a set, of the component of ``same`` if given; gives the sets that link it to other components."""
        done = set() if same is None else {self.root(same)}
        links = list(self.search(found, done))
        k = len(self.sets)
        self.sets.append(len(found))
        self.parents.append(k)
        for x in found:
            self.lists.setdefault(x, []).append(k)
        for other in [*links, *([] if same is None else [same])]:
            root = self.root(other)
            self.roots.discard(root)
            self.parents[root] = k
        self.roots.add(k)
        return links


def _search(percent: int):
    def run(key, part):
        rows = sorted(zip(part.column("n").to_pylist(), part.column("rep").to_pylist(), part.column("label").to_pylist(), part.column("shingles").to_pylist(), strict=True))
        bucket, reps, first = Bucket(percent), [], {}
        a, b = [], []
        for _, rep, label, whole in rows:
            if reps and reps[-1] == rep:  # an anchor that is also of this bucket
                continue
            for k in bucket.add(np.frombuffer(whole, "<u8").tolist(), first.get(label)):
                a.append(reps[k])
                b.append(rep)
            first.setdefault(label, len(reps))
            reps.append(rep)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _searched(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    return rows.groupBy(*keys).applyInArrow(_search(percent), "a long, b long")


def alike(sizes: np.ndarray, bounds: np.ndarray, lists: np.ndarray, weights: np.ndarray, percent: int) -> np.ndarray:
    """For documents with their lists (``bounds`` cut ``lists`` and ``weights``): the first document of each one's component.

    Two documents are joined if they share lists of enough weight and their sizes allow the similarity.
    """
    n = len(sizes)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    _, place, number = np.unique(lists, return_inverse=True, return_counts=True)
    common = number[place] > 1
    columns, column = np.unique(place[common], return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column, weight = owner[common][order], column[order], weights[common][order].astype(np.float32)
    shared = np.zeros((n, n), np.float32)
    # Some columns at a time: their number has no bound.
    for at in range(0, len(columns), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        held, of = np.zeros((n, min(COLUMNS, len(columns) - at)), np.float32), np.zeros(min(COLUMNS, len(columns) - at), np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        of[column[a:b] - at] = weight[a:b]
        shared += (held * of) @ held.T
    small = np.minimum(sizes[:, None], sizes)
    joined = (shared >= np.maximum(1, small // 20)) & (100 * small >= percent * np.maximum(sizes[:, None], sizes))
    first = np.full(n, -1)
    for k in range(n):
        if first[k] < 0:
            front = np.zeros(n, bool)
            front[k] = True
            while front.any():
                first[front] = k
                front = joined[front].any(axis=0) & (first < 0)
    return first


def _joined(percent: int):
    def run(key, part):
        part = part.combine_chunks()
        reps = part.column("rep").to_numpy()
        lists = part.column("lists").chunk(0)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        first = alike(part.column("n").to_numpy(), bounds, lists.flatten().to_numpy(), part.column("weights").chunk(0).flatten().to_numpy(), percent)
        other = first != np.arange(len(first))
        return pa.table({"a": reps[first[other]], "b": reps[other]})

    return run


def shared_lists(described: DataFrame, percent: int) -> DataFrame:
    """(rep, n, list, weight, docs, least): the different lists of documents that share prefix shingles.

    ``weight`` shingles have just these ``docs`` documents, of which ``least`` is the smallest.
    """
    every = described.select("rep", "n", F.explode("tokens").alias("token"))
    tokens = every.groupBy("token").agg(
        F.count(F.lit(1)).alias("docs"), F.min("rep").alias("least"),
        F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"),
    ).where("docs > 1")
    lists = tokens.groupBy("docs", "least", "x", "y").agg(F.min("token").alias("token"), F.count(F.lit(1)).alias("weight"))
    held = every.join(lists.select("token", "weight", "docs", "least"), "token").withColumnRenamed("token", "list")
    return pruned(held, percent)


def pruned(held: DataFrame, percent: int) -> DataFrame:
    """Without documents whose lists do not reach their overlap together, and lists that then have one document."""
    for _ in range(PRUNING):
        held = held.withColumn("all", F.sum("weight").over(Window.partitionBy("rep"))).where(F.col("all") >= least_overlap(percent)).drop("all")
        held = held.withColumn("left", F.count(F.lit(1)).over(Window.partitionBy("list"))).where("left > 1").drop("left")
    return stage(held, "lists")


def least_overlap(percent: int) -> Column:
    """The weight of lists that a document of ``n`` shingles shares with any partner, at least."""
    return F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / 20))


def chained_edges(short: DataFrame, percent: int) -> DataFrame:
    """(a, b): documents that stand next to each other, by size, in lists of enough weight together.

    Near copies are in the same order in all the lists that they share, so most of a group is joined by
    one light row for each document and list.
    """
    before = Window.partitionBy("list").orderBy("n", "rep")
    rows = short.select("rep", "n", "weight", F.lag("rep").over(before).alias("a"), F.lag("n").over(before).alias("less"))
    rows = rows.where(100 * F.col("less") >= percent * F.col("n")).groupBy("a", F.col("rep").alias("b"), "less").agg(F.sum("weight").alias("weight"))
    return rows.where(F.col("weight") >= F.greatest(F.lit(1), F.floor(F.col("less") / 20))).select("a", "b")


def routed_lists(short: DataFrame, percent: int) -> DataFrame:
    """(list, rep, n, lists, weights): each document goes with its rarest lists, and takes along what is not rarer.

    Lists have one order, rare ones first. The commonest of a document, as long as their weights together stay below the least
    overlap, need no way of their own: the rarest list that a pair shares is not among them, in either document. At that
    list the others that the pair shares come later in the order, so what comes before it is not sent.
    """
    order = Window.partitionBy("rep").orderBy("docs", "list")
    placed = short.select(
        "rep", "n", "list", F.row_number().over(order).alias("place"), (F.sum("weight").over(order) - F.col("weight")).alias("before"),
        F.sum("weight").over(Window.partitionBy("rep")).alias("all"),
    )
    ways = placed.where(F.col("before") + least_overlap(percent) <= F.col("all")).select("rep", "n", "list", "place")
    own = short.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("docs", "list", F.col("weight").cast("int").alias("weight")))).alias("own"))
    later = F.slice("own", F.col("place"), F.size("own"))
    return ways.join(own, "rep").select("list", "rep", "n", later["list"].alias("lists"), later["weight"].alias("weights"))


def _half(digests: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8")[::2]


def _wanted(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.holds(sent.value, _half(batch.column("digest")))))

    return run


def sets_of(wanted: DataFrame, described: DataFrame) -> DataFrame:
    """``wanted`` (digest, rep and others; one row a class) with the shingles of each class.

    Most documents are alone; the filter keeps nearly all of their shingles out of the shuffle. The join is by digest and id, so
    a class of many copies does not meet in one task.
    """
    wanted = stage(wanted, "wanted")
    filled = bloom.build(wanted.select("digest"), wanted.count(), lambda batch: _half(batch.column("digest")))
    sent = wanted.sparkSession.sparkContext.broadcast(filled)
    rows = described.where("tokens IS NOT NULL").select(F.col("id").alias("rep"), "digest", "shingles")
    rows = rows.mapInArrow(_wanted(sent), "rep long, digest binary, shingles binary").join(wanted.hint("merge"), ["digest", "rep"])
    return stage(rows.dropDuplicates(["digest", "rep"]).drop("digest"), "sets")


def links(one_each: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """(a, b): enough similar pairs that their components are those of all similar pairs.

    ``one_each`` has one row a class; the shingles are those of ``described``.
    """
    held = shared_lists(one_each, percent)

    short = held.where(F.col("docs") <= LIST_DOCS)
    star = held.where((F.col("docs") > LIST_DOCS) & (F.col("rep") != F.col("least"))).select(F.col("least").alias("a"), F.col("rep").alias("b"))
    sure = stage(chained_edges(short, percent).union(star).distinct(), "edges")
    # Only lists that hold documents of different components can join any more; they are all that such documents share.
    joined = short.join(components(sure).withColumnRenamed("id", "rep"), "rep", "left").withColumn("of", F.coalesce("component", "rep"))
    by_list = Window.partitionBy("list")
    joined = joined.withColumns({"low": F.min("of").over(by_list), "high": F.max("of").over(by_list)}).where("low != high")
    compared = routed_lists(pruned(joined.select(*held.columns), percent), percent)
    edges = sure.union(compared.groupBy("list").applyInArrow(_joined(percent), "a long, b long"))
    clusters = components(edges).withColumnsRenamed({"id": "rep", "component": "cluster"})
    sizes = clusters.join(one_each.select("rep", "n"), "rep").groupBy("cluster").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("docs"))
    small = (F.col("weight") <= BUCKET_SHINGLES) & (F.col("docs") <= BUCKET_DOCS)
    clusters = stage(clusters.join(sizes, "cluster").select("rep", "cluster", small.alias("small")), "clusters")
    sets = sets_of(one_each.select("rep", "n", "digest").join(clusters, "rep"), described)
    whole = sets.where("small").withColumn("label", F.col("rep"))
    found = _searched(whole.select("cluster", "rep", "label", "n", "shingles"), ["cluster"], percent)
    if clusters.where("NOT small").isEmpty():
        return found
    found = stage(found, "links")
    sets = sets.where("NOT small").select("rep", "n", "shingles")

    # Large clusters: each document goes with its first list, and a few anchors go with all.
    held = stage(held.join(clusters.where("NOT small").select("rep"), "rep", "left_semi"), "lists")
    home = held.groupBy("rep").agg(F.min("list").alias("list"), F.first("n").alias("n"))
    load = home.groupBy("list").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("docs"))
    blocks = F.ceil(F.greatest(2 * F.col("weight") / BUCKET_SHINGLES, 2 * F.col("docs") / BUCKET_DOCS)).cast("int")
    dealt = home.join(load.select("list", blocks.alias("blocks")), "list")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    order = Window.partitionBy("list").orderBy(F.xxhash64("rep", F.lit(1)), "rep")
    anchors = dealt.where("blocks > 1").withColumn("k", F.row_number().over(order)).where(F.col("k") <= ANCHORS)
    anchors = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    routed = dealt.select("list", "block", "rep").union(anchors.select("list", "block", "rep")).distinct()
    with_sets = routed.join(sets, "rep").withColumn("label", F.col("rep"))
    first = stage(_searched(with_sets, ["list", "block"], percent), "links")

    # Clusters that are not yet of one component: all pairs of blocks, but for those of one component.
    labels = components(first).withColumnsRenamed({"id": "rep", "component": "found"})
    placed = clusters.where("NOT small").select("rep", "cluster").join(labels, "rep", "left")
    placed = placed.withColumn("label", F.coalesce("found", "rep")).drop("found").join(sets.select("rep", "n"), "rep")
    heavy = placed.groupBy("cluster", "label").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("docs"))
    open_ = heavy.groupBy("cluster").agg(F.count(F.lit(1)).alias("labels")).where("labels > 1").select("cluster")
    heavy = heavy.join(open_, "cluster").withColumn("team", F.when(blocks > 1, F.col("label")))  # null: all light labels
    teams = heavy.groupBy("cluster", "team").agg(F.sum("weight").alias("weight"), F.sum("docs").alias("docs"))
    teams = teams.select("cluster", "team", blocks.alias("blocks"))
    dealt = placed.join(heavy.select("cluster", "label", "team"), ["cluster", "label"])
    dealt = dealt.join(teams, (dealt["cluster"] == teams["cluster"]) & dealt["team"].eqNullSafe(teams["team"])).select(
        dealt["cluster"], dealt["team"], "rep", "label", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")
    )
    block = teams.select("cluster", "team", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    block = block.select("cluster", F.struct("team", "block").alias("of"))
    pairs = block.withColumnRenamed("of", "low").join(block.withColumnRenamed("of", "high"), "cluster").where(
        (F.col("low") <= F.col("high")) & (F.col("low.team").isNull() | ~F.col("low.team").eqNullSafe(F.col("high.team")))
    )
    ends = pairs.select("cluster", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("of"))
    rows = dealt.select("cluster", F.struct("team", "block").alias("of"), "rep", "label").join(ends, ["cluster", "of"])
    last = _searched(rows.select("cluster", "low", "high", "rep", "label").join(sets, "rep"), ["cluster", "low", "high"], percent)
    return found.union(first).union(last)


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``id, n_shingles, component_id`` for every row: the smallest id that links of similarity ``percent`` reach."""
    spark = docs.sparkSession
    source = docs.select(col(id_column).cast("long").alias("id"), col(text_column).alias("text"))
    eighths = counted_share(percent)
    sent = spark.sparkContext.broadcast(repeated_filters(source.select("text"), words, eighths))
    with Scratch(spark) as scratch:
        described = scratch.stage(
            source.mapInArrow(_describe(words, eighths, percent, sent), "id long, n long, digest binary, tokens array<long>, shingles binary"),
            "shingles",
        )
        classes = described.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"))
        members = stage(described.select("id", "n", "digest").join(classes, "digest", "left"), "classes")
        rows = described.where("tokens IS NOT NULL").select(F.col("id").alias("rep"), "n", "digest", "tokens")
        one_each = scratch.stage(rows.join(classes, ["digest", "rep"]).dropDuplicates(["digest", "rep"]), "representatives")
        reached = components(links(one_each, described, percent))
    reached = reached.select(F.col("id").alias("rep"), "component")
    return members.join(reached, "rep", "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "rep", "id").alias("component_id"),
    )
