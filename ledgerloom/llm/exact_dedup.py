"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    SPACE_CLASS, small_or_shuffled, table, text_key, whole_text, without_rows,
)
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

PREFIX_CHARS = 256


def normalised() -> Column:
    """The text with each run of white space as one space; empty where null."""
    return F.regexp_replace(whole_text(), SPACE_CLASS, " ")


def exact_duplicates(
    docs: DataFrame, carry: dict[str, Column] | None = None, prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, and the ``carry`` columns.

    Two texts are equal if their normalised forms are. Rows fall into groups by length; groups of
    one go no further. The rest fall into groups by a hash of the first ``prefix_chars`` characters,
    and only what still has company has its full content hashed (SHA-256), which decides.
    ``carry`` are expressions over ``_norm`` (the normalised text) and the columns of ``docs``.

    Only keys are shuffled. The surviving (length, prefix) groups are broadcast up to a counted
    bound, beyond which the texts are shuffled to them; groups of copies are counted with map-side
    combine, so a group with a third of all rows is a few rows per task.

    Null and empty texts are equal to each other. Rows without a doc_id count in group_size, and
    never give the keep_id unless the whole group has none (then keep_id is null and kept is true
    for all its rows). Rows that repeat a doc_id and text are the same document: all of them count
    in group_size and all are kept or dropped together. No rows give no rows.
    """
    carry = carry or {}
    sized = docs.withColumns({"_norm": normalised()}).withColumns({
        "_length": F.length("_norm"),
        "_prefix": F.xxhash64(F.substring("_norm", 1, prefix_chars)),
    })
    keys = written(sized.select("_length", "_prefix"), "dedup-keys")
    shared = keys.groupBy("_length").count().where("count > 1").select("_length")
    alive = written(
        keys.join(shared, "_length", "left_semi").groupBy("_length", "_prefix").count()
        .where("count > 1").select("_length", "_prefix", F.lit(True).alias("_alive")),
        "dedup-alive",
    )
    hashed = written(
        sized.join(small_or_shuffled(alive), ["_length", "_prefix"], "left")
        .select(
            "doc_id", F.when(F.col("_alive"), F.sha2("_norm", 256)).alias("_full"),
            *(c.alias(n) for n, c in carry.items()),
        ),
        "dedup-hashed",
    )
    groups = hashed.where("_full is not null").groupBy("_full").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    ).where("group_size > 1")
    out = ["doc_id", "keep_id", "group_size", "kept", *carry]
    alone = hashed.where("_full is null").withColumns({
        "keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True),
    })
    met = hashed.where("_full is not null").join(groups, "_full", "left").withColumns({
        "keep_id": F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")),
        "group_size": F.coalesce("group_size", F.lit(1).cast("long")),
    }).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return alone.select(*out).unionByName(met.select(*out))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact_duplicates keeps, all columns as they were."""
    marked = exact_duplicates(docs, {"text_key": text_key()})
    gone = written(marked.where("not kept").select("doc_id", "text_key").distinct(), "dedup-gone")
    return without_rows(docs, gone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"text_sha256": F.sha2("_norm", 256)}
    return exact_duplicates(table(spark, sf_dir, "documents"), digest)


SQL = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
      FROM documents)
WINDOW same AS (PARTITION BY norm)
"""

register("op8_exact_dedup", query, SQL)
