"""Corpus cleaning in stages, each one of the training-data operators over all that the one before kept.

Columns besides ``doc_id`` and ``text`` pass through all stages but the last, whatever they are called; only ``n_chars`` follows a
changed text. Rows that repeat an id or have none are documents like others. Null and empty texts are scored and
kept or not as the classifier says, have one empty line, are no copies, hold no personal data and make a piece that is only an end.
An empty table goes through and gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import jaccard, line_dedup, pii, quality
from tallyboard.llm.queries import GOOD, packed, quality_weights
from tallyboard.scratch import drop_folder, new_folder


_OWN = ("doc_id", "text")


def _guarded(docs: DataFrame, change: Callable[[DataFrame], DataFrame], new_text: bool = True) -> DataFrame:
    """``change`` applied with all further columns under names that no operator uses, and given back as they were.

    With ``new_text`` the number of characters becomes that of the changed text.
    """
    names = {c: f"_kept_{k}" for k, c in enumerate(docs.columns) if c not in _OWN}
    changed = change(docs.select(*_OWN, *[F.col(_quoted(c)).alias(n) for c, n in names.items()]))
    length = F.length(F.coalesce("text", F.lit(""))).cast("long")
    return changed.select(*[length.alias(c) if c == "n_chars" and new_text else F.col(names.get(c, c)).alias(c) for c in docs.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    weights = quality_weights(spark, docs, sf_dir)
    return _guarded(docs, lambda d: quality.score(d, weights).where(F.col("score") >= GOOD), new_text=False)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines stay in one document only."""
    return _guarded(docs, line_dedup.drop_repeated_lines)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (five words, similarity 0.8) the document with the smallest id.

    Rows that repeat an id go only if all of them are copies of others; rows without an id stay.
    """
    groups = jaccard.similar_groups(docs, words=5, percent=80)
    gone = groups.groupBy("id").agg(F.max(F.col("id") == F.col("component_id")).alias("first")).where("NOT first")
    return docs.join(gone.select(F.col("id").alias("doc_id")), "doc_id", "left_anti").select(*map(_quoted, docs.columns))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return _guarded(docs, pii.mask)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packed(docs)


STAGES = [
    ("quality classifier", keep_good), ("line dedup", drop_lines), ("n-gram Jaccard join", one_of_each),
    ("PII", mask_personal), ("packing", pack),
]

#: SQL can express neither the learnt stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's table is removed once the next one is written; the last one is read by the result."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES[:-1]:
        path = new_folder(spark, name.replace(" ", "-"))
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
