"""Calendar dimension: daily flags, holiday periods, weekly maximum, and its join to the panel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import calendar_parts, harmonics, monday
from ledgerloom.functions.literals import literal_table
from ledgerloom.schemas import CALENDAR, CALENDAR_FLAGS

# Published holiday dates. An entry is (flag, first day, last day); Eid spans the
# day and the seven after it.
HOLIDAY_PERIODS = (
    ("is_ramadan", "2022-04-02", "2022-05-01"),
    ("is_ramadan", "2023-03-22", "2023-04-20"),
    ("is_ramadan", "2024-03-10", "2024-04-08"),
    ("is_eid_alfitr", "2022-05-02", "2022-05-09"),
    ("is_eid_alfitr", "2023-04-21", "2023-04-28"),
    ("is_eid_alfitr", "2024-04-10", "2024-04-17"),
)


def holiday_days(spark: SparkSession, periods: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Periods unfolded to (day, flag): a range join becomes an equi join on the day."""
    frame = literal_table(spark, periods, "flag string, first string, last string")
    span = F.sequence(F.to_date("first"), F.to_date("last"))
    return frame.select(F.explode(span).alias("day"), "flag").distinct()


def day_spine(source: DataFrame, ts: str) -> DataFrame:
    """Every day from the first to the last of ``source``: one row of bounds, unfolded."""
    day = F.to_date(F.col(ts))
    bounds = source.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("day"))


def holiday_flags(days: DataFrame, periods: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Days with 0/1 ``is_ramadan`` and ``is_eid_alfitr``.

    The holiday side is a literal list unfolded to some hundred days, so it is broadcast.
    """
    marks = holiday_days(days.sparkSession, periods).groupBy("day").agg(
        F.max((F.col("flag") == "is_ramadan").cast("int")).alias("_ramadan"),
        F.max((F.col("flag") == "is_eid_alfitr").cast("int")).alias("_eid"),
    )
    return days.join(F.broadcast(marks), "day", "left").select(
        *days.columns,
        F.coalesce("_ramadan", F.lit(0)).alias("is_ramadan"),
        F.coalesce("_eid", F.lit(0)).alias("is_eid_alfitr"),
    )


def daily_flags(days: DataFrame, periods=HOLIDAY_PERIODS) -> DataFrame:
    return holiday_flags(days, periods).withColumns(calendar_parts(F.col("day")))


def calendar_weekly(days: DataFrame, periods=HOLIDAY_PERIODS) -> DataFrame:
    """One row per Monday week; a flag is 1 when it is 1 on any listed day of the week."""
    return (
        daily_flags(days, periods)
        .groupBy(monday(F.col("day")).alias("week"))
        .agg(*(F.max(f).alias(f) for f in CALENDAR_FLAGS))
        .select(*CALENDAR.fieldNames())
    )


def seasonal_features(panel: DataFrame) -> DataFrame:
    """Month, ISO week and two yearly harmonics of the row's week."""
    return (
        panel.withColumn("month", F.month("week"))
        .withColumn("week_num", F.weekofyear("week"))
        .withColumns(harmonics(F.col("week_num")))
    )


def calendar_join(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Flags of the row's own week.

    ``calendar_weekly`` groups by week, so the side has one row per week and is broadcast: all weeks
    of the years 1 to 9999 would be some 20 MB.
    """
    return panel.join(F.broadcast(calendar), "week", "left")
