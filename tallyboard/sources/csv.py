"""CSV in and out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.operators.clean import strict_cast

# Cell texts that mean "missing" to the data-frame library the CSV files come from.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, missing: Sequence[str] = MISSING,
    multi_line: bool = False, position: str | None = None,
) -> DataFrame:
    """CSV with a header row, columns matched by name.

    Files of one folder may differ in their headers: each is read by its own, and a column that it lacks is null in its rows.
    Columns named in ``schema`` get its types, and a cell that does not fit fails the job; others
    stay text. Schema columns that no file has are left out (``clean.add_missing`` adds them).
    ``position`` names a column to hold the place of each row: file, block of the file, row.
    Without a schema, types are inferred at the cost of one more pass over the data; where files with different headers
    disagree, numbers are double and anything else is text. Headers of several files cost a pass over their lines. A missing
    path fails before any work starts.
    """
    groups = _by_header(spark, path)
    if len(groups) < 2:
        return _read_alike(spark, path, schema, missing, multi_line, position)
    parts = [_read_alike(spark, files, schema, missing, multi_line, position) for files in groups]
    kinds: dict[str, set] = {}
    for part in parts:
        for f in part.schema:
            kinds.setdefault(f.name, set()).add(f.dataType)
    common = {c: _common(found) for c, found in kinds.items() if len(found) > 1}
    parts = [p.withColumns({c: F.col(_quoted(c)).cast(t) for c, t in common.items() if c in p.columns}) for p in parts]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    places = [position] if position else []
    return whole.select(*[F.col(_quoted(c)) for c in [*(c for c in whole.columns if c not in places), *places]])


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _common(kinds: set[T.DataType]) -> T.DataType:
    return T.DoubleType() if all(isinstance(k, T.NumericType) for k in kinds) else T.StringType()


def _by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files below ``path`` with the same first line, in groups; nothing is read where there is only one file."""
    lines = spark.read.text(path)
    if len(lines.inputFiles()) < 2:
        return []
    # Only the first block of a file holds its first line.
    first = lines.where("_metadata.file_block_start = 0 AND trim(value) != ''").select("value", F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("at"))
    first = first.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files")).orderBy("files").collect()
    return [r.files for r in found]


def _read_alike(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None, missing: Sequence[str], multi_line: bool, position: str | None
) -> DataFrame:
    """Files with the same header; one that differs all the same fails the job."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("enforceSchema", False)
    # Blocks of a file are read in any order, rows of a block from top to bottom.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    placed = [place.alias(position)] if position else []
    if schema is None:
        inferred = reader.option("inferSchema", True).csv(path).schema
        return _checked(reader.schema(_with_raw(inferred)), path, inferred.names).select(*map(_quoted, inferred.names), *placed)
    names = reader.csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = _checked(reader.schema(_with_raw(text)), path, names)
    kinds = {f.name: f.dataType for f in schema}

    def cell(name: str):
        c = F.col(_quoted(name))
        text = F.when(~c.isin(*missing), c)
        return strict_cast(text, kinds[name]) if name in kinds else text

    return raw.select(*[cell(n).alias(n) for n in names], *placed)


#: Holds the line of a row that has not as many cells as the header.
RAW = "_raw_line"


def _with_raw(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])


def _checked(reader: DataFrameReader, path: str | list[str], names: Sequence[str]) -> DataFrame:
    """The rows; one with more cells than the header fails the job, in one with fewer the rest is null.

    Empty cells after the header's last hold nothing and are let pass if nothing follows them.
    """
    cells = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names) + 1)])
    options = {"escape": '"'}
    # Without empty cells at its end and with the others filled, a line has a cell there if any cell from there on is filled.
    plain = F.regexp_replace(F.col(RAW), r',""(?=[,\r\n]|\z)', ",")
    filled = F.regexp_replace(F.rtrim(plain, F.lit(",\r\n")), ",(?=,)", ",x")
    surplus = F.from_csv(filled, cells.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)[f"c{len(names)}"]
    # All cells are named, as rows are only checked while all of them are parsed.
    first = F.coalesce(*[F.col("`" + n.replace("`", "``") + "`").cast("string") for n in names], F.lit(""))
    message = F.concat(F.lit(f"more than {len(names)} cells after "), first, F.lit(": "), F.col(RAW))
    fits = F.when(F.col(RAW).isNotNull() & surplus.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
    return reader.option("columnNameOfCorruptRecord", RAW).csv(path).where(fits)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of CSV files with header rows, one per task."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
