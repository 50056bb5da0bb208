"""Dataset ids kept inside the JSON text of chart definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where the datasource stands, the mark after an id written as text, the kind if none is given.
SOURCE_PATH = "$.datasource"
TABLE_MARK = "__table"
MARK_SEPARATOR = "__"
DEFAULT_TYPE = "table"


#: What is read of a datasource that is an object.
OBJECT = "id STRING, type STRING"


def _whole(c: Column) -> Column:
    """Text to an id, blanks around it allowed; anything else is null, and so is what no bigint holds.

    The pattern comes first, as a failing cast costs more.
    """
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c).try_cast("bigint"))


def with_dataset_id(
    df: DataFrame, params: str, query_context: str, nested_params: bool = False,
    id_column: str = "dataset_id", type_column: str | None = None,
) -> DataFrame:
    """Add the dataset id: marked text in ``params``, else the object in the query context.

    Malformed or missing JSON moves on to the next place and ends in null. With ``nested_params``
    an object in ``params`` counts too, before the query context. ``type_column`` adds the kind
    written beside the id that was used. Each text is parsed once for its datasource, and that piece once for
    its fields, the query context's only where it is needed.
    """
    sources = df.withColumns({
        "_from_params": F.get_json_object(params, SOURCE_PATH),
        "_from_context": F.get_json_object(query_context, SOURCE_PATH),
    })
    p, q = F.col("_from_params"), F.col("_from_context")
    is_marked = p.contains(TABLE_MARK)
    found = sources.withColumn("_marked", F.when(is_marked, F.split_part(p, F.lit(MARK_SEPARATOR), F.lit(1))))
    in_params = _whole(F.col("_marked"))
    if nested_params:
        found = found.withColumn("_nested", F.when(~is_marked, F.from_json(p, OBJECT)))
        in_params = F.coalesce(in_params, _whole(F.col("_nested.id")))
    found = found.withColumn("_in_params", in_params)
    wanted = F.col("_in_params").isNull()
    found = found.withColumn("_context", F.when(wanted, F.from_json(q, OBJECT)))
    result = {id_column: F.coalesce("_in_params", _whole(F.col("_context.id")))}
    if type_column:
        used = F.when(wanted, F.col("_context.type"))
        if nested_params:
            used = used.when(~is_marked, F.col("_nested.type"))
        result[type_column] = F.coalesce(used, F.lit(DEFAULT_TYPE))
    return found.withColumns(result).select(*df.columns, *result)
