"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, compared by subtraction.

A paragraph is a line; a long line is cut at fixed distances from its start that grow fourfold, so an edit
leaves the pieces before it alone. A sketch has three tables of cells; a digest enters one cell of each, which
holds a count, and the exclusive or of digests and of their check hashes. The cells of two versions are
subtracted, which cancels what they share. Then peeling recovers the differing digests: a cell with one
digest left gives it away, and it is taken out of its other two cells.

The published fingerprint is such a sketch. Its tables grow with the text's digests in powers of two, up to
the first size at which peeling lists all of the text's digests. So two fingerprints are always enough to
compare their texts: those of one size are subtracted; of two sizes, the smaller one is listed and its digests
enter tables of the larger size. If cells are left over, both lists enter larger tables with other hashes. The
likeness columns do the same, placing the digests that the fingerprints list. A place is the low bits of
a hash, so a fingerprint can also be folded to any smaller power of two.

Everything is DataFrame work on rows that are already together by document: cells are grouped with
hash aggregation without another shuffle, and a round of peeling is one such grouping. A document's text is
shuffled once, with the first quarter of the next document joined to it.

Defined results: a null text is empty; an empty text has no paragraphs, and two such are alike (1.0); a null id
comes before all others; rows that repeat an id are documents of their own, in the order of two hashes of their
texts; rows alike in id and text are compared once and given once for each, and all of them but the last are followed by their like; a
single document is followed by itself; further columns are ignored. A document is told from others by its id and 128
bits of hashes of its text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import col
from tallyboard.operators.ranking import number_rows
from tallyboard.scratch import stage

#: Where a line is cut, counted in code points from its start.
CUTS = (0, 24, 96, 384, 1536)
TABLES = 3
#: Cells of one table for each digest of a pair of equally long texts, and at least so many, before rounding up.
ROOM, LEAST = 0.8, 16
#: Doublings of a table until it lists all digests; each leaves about an eighth of the failures.
RUNGS = 20
#: Rounds of peeling, each of one table.
ROUNDS = 12
#: Seeds of the hashes that check a digest and place it.
CHECK, PLACE = 1001, 2001
#: Rows alike are given out by so many at once.
BLOCK = 4096


def paragraphs(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    ends = [*CUTS[1:], 1 << 30]
    pieces = F.transform(
        F.split(text, "\n", -1),
        lambda line: F.array(*[F.substr(line, F.lit(a + 1), F.lit(b - a)) for a, b in zip(CUTS, ends, strict=True)]),
    )
    filled = F.filter(F.flatten(pieces), lambda p: p != "")
    return F.array_distinct(F.transform(filled, lambda p: F.xxhash64(p)))


def check_of(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(CHECK))


def place_of(digest: Column, table: int, size: Column, attempt: int) -> Column:
    """The digest's cell in a table."""
    return F.pmod(F.xxhash64(digest, F.lit(PLACE + 100 * attempt + table)), size).cast("int")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often a lambda reads it."""
    return F.transform(F.array(value), use)[0]


def _lists_all(digests: Column, size: Column) -> Column:
    """Whether peeling tables of this size gives every digest: in each round those alone in a cell of one table leave."""

    def crowded(left: Column, k: Column) -> Column:
        table = F.pmod(k, F.lit(TABLES)) + PLACE
        # Place and index in one number, which sorts faster than a struct.
        placed = F.transform(left, lambda d, i: F.shiftleft(F.pmod(F.xxhash64(d, table), size), 32) + i)
        place = lambda s, i: F.shiftright(F.get(s, i), 32)
        shared = lambda s: F.filter(s, lambda x, i: (
            place(s, i - 1).eqNullSafe(F.shiftright(x, 32)) | place(s, i + 1).eqNullSafe(F.shiftright(x, 32))
        ))
        kept = _bound(F.sort_array(placed), lambda s: F.transform(shared(s), lambda x: F.get(left, x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))))
        return F.when(F.size(left) == 0, left).otherwise(kept)

    return F.size(F.aggregate(F.sequence(F.lit(0), F.lit(4 * ROUNDS - 1)), digests, crowded)) == 0


def table_size(digests: Column) -> Column:
    """Cells of one table of a text's fingerprint."""

    def of(ds: Column) -> Column:
        wanted = F.greatest(F.lit(LEAST), F.ceil(F.size(ds) * F.lit(2 * ROOM)).cast("int"))
        first = F.pow(F.lit(2), F.length(F.bin(wanted - 1))).cast("long")
        tried = lambda size: F.when(_lists_all(ds, size), size)
        rung = lambda s, k: F.coalesce(s, _bound((first * F.pow(F.lit(2), k)).cast("long"), tried))
        found = F.aggregate(F.sequence(F.lit(0), F.lit(RUNGS)), F.lit(None).cast("long"), rung)
        return F.coalesce(found, F.raise_error(F.lit("no table lists all digests")).cast("long")).cast("int")

    return _bound(digests, of)


def fingerprint(digests: Column, size: Column) -> Column:
    """The sketch as text: ``size;``, then ``cell:count:digests:checks`` of each filled cell, comma-joined.

    Digests and checks are hexadecimal; a cell's number is its table times ``size`` plus its place.
    """

    def entry(t: int) -> Callable[[Column], Column]:
        return lambda d: F.struct((place_of(d, t, size, 0) + t * size).alias("cell"), d.alias("d"), check_of(d).alias("c"))

    def placed(ds: Column) -> Column:
        return F.concat(*[F.transform(ds, entry(t)) for t in range(TABLES)])

    def cell(held: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("c"))
        return F.aggregate(
            held, empty, lambda s, x: F.struct(s["d"].bitwiseXOR(x["d"]).alias("d"), s["c"].bitwiseXOR(x["c"]).alias("c")),
            lambda s: F.concat_ws(":", held[0]["cell"], F.size(held), F.hex(s["d"]), F.hex(s["c"])),
        )

    def cells(entries: Column) -> Column:
        places = F.transform(entries, lambda x, i: F.when(~F.get(entries, i - 1)["cell"].eqNullSafe(x["cell"]), i))
        return _bound(F.array_compact(places), lambda starts: F.transform(
            starts, lambda at, k: _bound(F.slice(entries, at + 1, F.coalesce(F.get(starts, k + 1), F.size(entries)) - at), cell)
        ))

    return F.concat(size.cast("string"), F.lit(";"), F.array_join(_bound(F.sort_array(_bound(digests, placed)), cells), ","))


# --- subtracting and peeling ---------------------------------------------------------------------


def _signed(digests: Column, sign: int) -> Column:
    return F.transform(digests, lambda d: F.struct(d.alias("d"), F.lit(sign).alias("n")))


def _grouped(cells: DataFrame, keys: list[str]) -> DataFrame:
    merged = cells.groupBy(*keys, "size", "cell", "found").agg(F.sum("n").alias("n"), F.bit_xor("d").alias("d"), F.bit_xor("c").alias("c"))
    return merged.where("n != 0 OR d != 0 OR c != 0")


def subtracted(pairs: DataFrame, keys: list[str], attempt: int) -> DataFrame:
    """Cells of the sketch of ``a`` minus that of ``b`` (arrays of digests), without those that cancel.

    The first attempt has the larger one of the two fingerprints' sizes, which may be given as ``sa`` and ``sb``.
    """
    sizes = [F.col(n) if n in pairs.columns else table_size(F.col(c)) for c, n in (("a", "sa"), ("b", "sb"))]
    size = F.greatest(*sizes) * 4**attempt
    entries = pairs.select(*keys, "a", "b", size.alias("size")).select(*keys, "size", F.explode(F.concat(_signed(F.col("a"), 1), _signed(F.col("b"), -1))).alias("e"))
    cells = F.array(*[(place_of(F.col("e.d"), t, F.col("size"), attempt) + t * F.col("size")).alias("cell") for t in range(TABLES)])
    spread = entries.select(
        *keys, "size", F.explode(cells).alias("cell"), F.lit(0).cast("long").alias("found"),
        F.col("e.n").alias("n"), F.col("e.d").alias("d"), check_of(F.col("e.d")).alias("c"),
    )
    return _grouped(spread, keys)


def peeled(cells: DataFrame, keys: list[str], table: int, attempt: int) -> DataFrame:
    """One round: digests that are alone in a cell of this table leave all their cells and become found rows (cell -1)."""
    alone = (
        (F.col("cell") >= 0) & (F.floor(F.col("cell") / F.col("size")) == table) & (F.abs("n") == 1) & (check_of(F.col("d")) == F.col("c"))
    )
    zero = F.lit(0).cast("long")

    def row(cell: Column, found: Column, n: Column, d: Column, c: Column) -> Column:
        return F.struct(cell.cast("int").alias("cell"), found.alias("found"), n.cast("long").alias("n"), d.alias("d"), c.alias("c"))

    own = row(F.col("cell"), F.col("found"), F.col("n"), F.col("d"), F.col("c"))
    others = [
        row(place_of(F.col("d"), t, F.col("size"), attempt) + t * F.col("size"), zero, -F.col("n"), F.col("d"), F.col("c"))
        for t in range(TABLES) if t != table
    ]
    gone = row(F.lit(-1), F.col("d"), F.col("n"), zero, zero)
    out = F.explode(F.when(alone, F.array(gone, *others)).otherwise(F.array(own))).alias("r")
    return _grouped(cells.select(*keys, "size", out).select(*keys, "size", "r.*"), keys)


def differences(pairs: DataFrame, keys: list[str], attempt: int = 0) -> DataFrame:
    """``keys, differ, whole`` for pairs that differ: how many digests were recovered, and whether that is all of them.

    Pairs whose cells all cancel give no row. Rows of ``pairs`` must be together by the first key.
    """
    cells = subtracted(pairs, keys, attempt)
    cells = reduce(lambda c, k: peeled(c, keys, k % TABLES, attempt), range(ROUNDS), cells)
    return cells.groupBy(*keys).agg(
        F.count(F.when(F.col("cell") < 0, 1)).alias("differ"), (F.count(F.when(F.col("cell") >= 0, 1)) == 0).alias("whole")
    )


def recovered(pairs: DataFrame, keys: list[str], attempt: int = 0) -> DataFrame:
    """``keys, digest, side``: each recovered digest, side 1 if it is in ``a`` alone and -1 if in ``b`` alone."""
    cells = reduce(lambda c, k: peeled(c, keys, k % TABLES, attempt), range(ROUNDS), subtracted(pairs, keys, attempt))
    return cells.where("cell < 0").select(*keys, F.col("found").alias("digest"), F.col("n").cast("int").alias("side"))


# --- documents and their edited versions -----------------------------------------------------------


def _neighbours(docs: DataFrame) -> DataFrame:
    """(k, previous, cut): the document before each one, and how many of its first code points that one takes."""
    ids = docs.groupBy("k").agg(F.max(F.floor(F.length("text") / 4)).alias("cut"))  # one text for each key
    numbered = stage(number_rows(ids, ["k"], "r", 0), "ids")
    n = numbered.count()
    following = F.pmod(F.col("r") + 1, F.lit(max(n, 1)))
    before = numbered.select(F.col("k").alias("previous"), "cut", following.alias("r"))
    return numbered.select("k", "r").join(before, "r").select("k", "previous", "cut")


def versions(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row for each different id and text: ``k, n_chars, copies, edited, repeated, own, changed, next, again``.

    The last four are paragraph digests. ``k`` is the id with hashes of the text. Where there are copies, ``repeated``
    is the text edited with its own start, and ``again`` has its digests; elsewhere both are null.
    """
    source = docs.select(col(id_column).cast("long").alias("id"), F.coalesce(col(text_column).cast("string"), F.lit("")).alias("text"))
    key = F.struct("id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(CHECK), "text").alias("g"))
    # Read back from a table every field may be null; a key of another type would be shuffled again for each join.
    source = source.select(key.cast("struct<id: bigint, h: bigint, g: bigint>").alias("k"), "text")
    single = source.repartition("k").groupBy("k").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    heads = single.join(_neighbours(source), "k").select(
        F.col("previous").alias("k"), F.substr("text", F.lit(1), F.col("cut").cast("int")).alias("head"), paragraphs(F.col("text")).alias("next")
    )
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")

    def edit(start: Column) -> Column:
        return F.concat(F.substr("text", F.lit(1), n - cut), F.substr(start, F.lit(1), cut))

    joined = single.join(heads, "k").select(
        "k", n.cast("long").alias("n_chars"), "copies", "text", edit(F.col("head")).alias("edited"),
        F.when(F.col("copies") > 1, edit(F.col("text"))).alias("repeated"), "next",
    )
    return joined.select(
        "k", "n_chars", "copies", "edited", "repeated", paragraphs(F.col("text")).alias("own"), paragraphs(F.col("edited")).alias("changed"),
        "next", F.when(F.col("copies") > 1, paragraphs(F.col("repeated"))).alias("again"),
    )


#: What a text is compared with; the last one only if it has copies.
OTHERS = ("changed", "next", "again")


def _pairs(rows: DataFrame) -> DataFrame:
    both = F.array(*[
        F.when(F.col(b).isNotNull(), F.struct(
            F.lit(pair).alias("pair"), F.col("own").alias("a"), F.col(b).alias("b"), F.col("own_size").alias("sa"), F.col(f"{b}_size").alias("sb")
        )) for pair, b in enumerate(OTHERS)
    ])
    return rows.select("k", F.explode(F.array_compact(both)).alias("p")).select("k", "p.*")


def _sized(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({f"{n}_size": F.when(F.col(n).isNotNull(), table_size(F.col(n))) for n in names})


def _likeness(differ: Column, a: Column, b: Column) -> Column:
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise((total - differ) / total)


def _each_copy(rows: DataFrame) -> DataFrame:
    """Every row as often as it has copies, which ``copy`` numbers from 0, without an array of them all."""
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BLOCK))
    blocked = rows.select("*", F.explode(blocks).alias("block"))
    held = F.least(F.col("copies") - F.col("block") * BLOCK, F.lit(BLOCK).cast("long"))
    return blocked.select("*", F.explode(F.sequence(F.lit(0).cast("long"), held - 1)).alias("at")).withColumn("copy", F.col("block") * BLOCK + F.col("at"))


def compare_with_edit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row.

    The edited text has its last quarter replaced by the start of the next document. Likeness is the share
    of both sides' paragraph digests that cancel; the two fingerprints of a pair are enough to compute it.
    """
    rows = versions(docs, id_column, text_column)
    pairs = range(len(OTHERS))
    # Sizes go along as keys, so that they are found only once; pairs that cancel have none.
    tried = differences(_pairs(_sized(rows, "own", *OTHERS)), ["k", "pair", "sa", "sb"])
    by_k = tried.groupBy("k").agg(
        *[F.max(F.when(F.col("pair") == p, F.struct("differ", "whole"))).alias(f"t{p}") for p in pairs],
        F.max("sa").alias("sa"), *[F.max(F.when(F.col("pair") == p, F.col("sb"))).alias(f"s{p}") for p in (0, 2)],
    )
    joined = rows.join(by_k, "k", "left")
    known = [F.when(F.col(f"t{p}").isNull(), 0).when(F.col(f"t{p}.whole"), F.col(f"t{p}.differ")).cast("long") for p in pairs]
    failed = reduce(lambda a, b: a | b, [k.isNull() for k in known])
    size_of = lambda p: F.coalesce(f"s{p}", "sa", table_size(F.col(OTHERS[p])))
    held = stage(joined.select(
        "k", "n_chars", "copies", F.sha2("edited", 256).alias("edited_sha256"), F.sha2("repeated", 256).alias("repeated_sha256"), "own", "changed", "again",
        F.when(failed, F.col("next")).alias("next"), F.size("next").alias("n_next"), *[k.alias(f"d{p}") for p, k in zip(pairs, known, strict=True)],
        F.coalesce("sa", table_size(F.col("own"))).alias("own_size"), size_of(0).alias("changed_size"),
        F.when(F.col("copies") > 1, size_of(2)).alias("again_size"),
    ), "fingerprints")

    more, attempt = [], 0
    left = _pairs(_sized(held.where("next IS NOT NULL"), "next"))
    while True:
        left = stage(left, "unpeeled")
        if left.isEmpty():
            break
        attempt += 1
        result = stage(left.select("k", "pair").join(differences(left.repartition("k"), ["k", "pair"], attempt), ["k", "pair"], "left").select(
            "k", "pair", F.when(F.col("whole").isNull(), 0).otherwise(F.col("differ")).alias("differ"), F.coalesce("whole", F.lit(True)).alias("whole")
        ), "peeled")
        more.append(result.where("whole"))
        left = left.join(result.where("NOT whole"), ["k", "pair"], "left_semi")
    if more:
        later = reduce(DataFrame.union, more).groupBy("k").agg(*[F.max(F.when(F.col("pair") == p, F.col("differ"))).alias(f"l{p}") for p in pairs])
        held = held.join(later, "k", "left").withColumns({f"d{p}": F.coalesce(f"d{p}", f"l{p}") for p in pairs})
    total = F.size("own") + F.col("n_next")
    published = lambda c: fingerprint(F.col(c), F.col(f"{c}_size"))

    def edited(sha: str, other: str, differ: str, near_next: Column) -> Column:
        return F.struct(
            F.col(sha).alias("edited_sha256"), published(other).alias("edited_fingerprint"),
            _likeness(F.col(differ), F.col("own"), F.col(other)).alias("near_edited"), near_next.alias("near_next"),
        )

    last = edited("edited_sha256", "changed", "d0", F.when(total == 0, 1.0).otherwise((total - F.col("d1")) / total))
    result = held.select(
        F.col("k.id").alias("id"), "n_chars", "copies", published("own").alias("fingerprint"), last.alias("last"),
        F.when(F.col("copies") > 1, edited("repeated_sha256", "again", "d2", F.lit(1.0))).alias("other"),
    )
    result = _each_copy(result).withColumn("e", F.when(F.col("copy") == 0, F.col("last")).otherwise(F.col("other")))
    return result.select("id", "n_chars", "e.edited_sha256", "fingerprint", "e.edited_fingerprint", "e.near_edited", "e.near_next")
