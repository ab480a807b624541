"""Sector to market-indicator mapping and the per-account assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.aggregates import keep_one
from ledgerloom.functions.literals import literal_table
from ledgerloom.schemas import CALENDAR_KEYS, require_columns

ANY_SECTOR = "*"

# Reference mapping (sector, primary, secondary, calendar flags, priority).
SECTOR_MAPPING = (
    ("agriculture", "commodity_index_z", "", True, 1),
    ("transport", "oil_price_z", "", True, 2),
    ("investment", "masi_index_z", "", True, 3),
    ("construction", "realestate_index_z", "oil_price_z", True, 4),
    ("mixed", "masi_index_z", "oil_price_z", True, 5),
    ("retail", "", "", True, 6),
)
MAPPING_COLUMNS = ("sector", "macro_primary", "macro_secondary", "include_calendar", "priority")


def reference_mapping(spark) -> DataFrame:
    return literal_table(
        spark, SECTOR_MAPPING,
        "sector string, macro_primary string, macro_secondary string,"
        " include_calendar boolean, priority int",
    )


def load_mapping(raw: DataFrame) -> DataFrame:
    """Normalise a mapping table read as text: required columns, lower/trim, blank keys, casts.

    Other columns (a label, a source) stay as they are.
    """
    require_columns(raw, MAPPING_COLUMNS, "sector mapping")
    blank = F.lit("")
    others = [F.col(c) for c in raw.columns if c not in MAPPING_COLUMNS]
    return raw.select(
        F.lower(F.trim("sector")).alias("sector"),
        F.coalesce(C.clean_key(F.col("macro_primary")), blank).alias("macro_primary"),
        F.coalesce(C.clean_key(F.col("macro_secondary")), blank).alias("macro_secondary"),
        F.col("include_calendar").try_cast("boolean").alias("include_calendar"),
        F.col("priority").try_cast("int").alias("priority"),
        *others,
    )


def best_priority(mapping: DataFrame) -> DataFrame:
    """The lowest-priority-number row of each sector."""
    return keep_one(mapping, ["sector"], ["priority", "macro_primary", "macro_secondary"])


def resolve_sectors(accounts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Append macro_primary, macro_secondary, include_calendar and externals_for_model.

    Match on the normalised sector, else the ``*`` row, else calendar flags only. The mapping has
    one row per sector after ``best_priority``; Spark broadcasts it by its measured size.
    """
    rules = best_priority(mapping).select(
        F.col("sector").alias("_sector"),
        F.struct("macro_primary", "macro_secondary", "include_calendar").alias("_rule"),
    )
    default = F.struct(
        F.lit("").alias("macro_primary"), F.lit("").alias("macro_secondary"),
        F.lit(True).alias("include_calendar"),
    )
    anywhere = rules.where(F.col("_sector") == ANY_SECTOR).select(
        F.col("_sector").alias("_other"), F.col("_rule").alias("_any_rule")
    )
    joined = (
        accounts.withColumn("_sector", F.lower(F.trim("sector")))
        .join(rules, "_sector", "left")
        .withColumn("_other", F.when(F.col("_rule").isNull(), ANY_SECTOR))
        .join(F.broadcast(anywhere), "_other", "left")  # one row
        .withColumn("_pick", F.coalesce("_rule", "_any_rule", default))
    )
    blank = F.lit("")
    primary = F.coalesce(C.clean_key(F.col("_pick.macro_primary")), blank)
    secondary = F.coalesce(C.clean_key(F.col("_pick.macro_secondary")), blank)
    flags = F.when(
        F.coalesce(F.col("_pick.include_calendar"), F.lit(False)),
        F.array(*(F.lit(k) for k in CALENDAR_KEYS)),
    ).otherwise(F.array().cast("array<string>"))
    keys = F.filter(F.concat(F.array(primary, secondary), flags), lambda k: k != "")
    return joined.select(
        *accounts.columns,
        primary.alias("macro_primary"),
        secondary.alias("macro_secondary"),
        F.coalesce(F.col("_pick.include_calendar"), F.lit(False)).alias("include_calendar"),
        F.array_distinct(keys).alias("externals_for_model"),
    )


def account_dimension(weekly: DataFrame) -> DataFrame:
    """One (account_id, sector) row per account: the sector of its first week."""
    return weekly.groupBy("account_id").agg(
        F.min_by("sector", F.struct("week", "sector")).alias("sector")
    )


def macro_assignment(accounts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Assignment table; a duplicated account keeps its first sector in name order."""
    distinct = keep_one(accounts.select("account_id", "sector"), ["account_id"], ["sector"])
    return resolve_sectors(distinct, mapping)
