"""Market indicators: source choice, daily to weekly, alignment, z-scores, leak-free join.

Every frame here is keyed by (indicator, day or week): its size is the calendar times a handful of
indicators, so windows per indicator and broadcasts to the panel are bounded by design.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import monday, ratio
from ledgerloom.schemas import MACRO_KEYS

# Default chart symbols per indicator (primary, fallbacks).
DEFAULT_SYMBOLS = (
    ("oil_price_z", "BZ=F", ()),
    ("commodity_index_z", "DBC", ()),
    ("masi_index_z", "MASI.CS", ("^GSPC",)),
    ("realestate_index_z", "IYR", ()),
)


def _default_symbols() -> Column:
    return F.array(*(
        F.struct(
            F.lit(ind).alias("indicator"), F.lit(rank).alias("rank"), F.lit(sym).alias("symbol"),
        )
        for ind, primary, fallbacks in DEFAULT_SYMBOLS
        for rank, sym in enumerate((primary, *fallbacks))
    ))


def parse_symbol_specs(specs: DataFrame, text: str = "spec") -> DataFrame:
    """``indicator:primary|fb1;fb2,...`` to rows (indicator, rank, symbol) next to the other columns.

    Parts without a colon are skipped; a later part replaces an earlier one of the same indicator;
    a text without any usable part yields the default symbols. The primary keeps rank 0.
    """
    part = F.split(F.coalesce(F.col(text), F.lit("")), ",")
    usable = F.filter(F.transform(part, lambda p: F.trim(p)), lambda p: F.contains(p, F.lit(":")))

    def indicator(p: Column) -> Column:
        return F.trim(F.substring_index(p, ":", 1))

    def symbols(p: Column) -> Column:
        body = F.substr(p, F.instr(p, ":") + 1)
        bar = F.instr(body, "|")
        primary = F.when(bar > 0, F.substr(body, F.lit(1), bar - 1)).otherwise(F.trim(body))
        tail = F.when(bar > 0, F.substr(body, bar + 1)).otherwise("")
        fallbacks = F.filter(F.transform(F.split(tail, ";"), lambda s: F.trim(s)), lambda s: s != "")
        return F.concat(F.array(primary), fallbacks)

    # map_concat with LAST_WIN would need a session setting; keep the last position by hand.
    last = F.filter(
        usable,
        lambda p, i: ~F.exists(
            F.slice(usable, i + 2, F.size(usable)), lambda q: indicator(q) == indicator(p)
        ),
    )
    parsed = F.flatten(F.transform(
        last,
        lambda p: F.transform(
            symbols(p),
            lambda s, r: F.struct(
                indicator(p).alias("indicator"), r.alias("rank"), s.alias("symbol")
            ),
        ),
    ))
    rows = F.when(F.size(usable) > 0, parsed).otherwise(_default_symbols())
    keep = [c for c in specs.columns if c != text]
    return specs.select(*keep, F.inline(rows))


def _best_rank(candidates: DataFrame) -> DataFrame:
    """Rows of the least rank of each indicator; a window holds one indicator's calendar."""
    least = F.min("rank").over(Window.partitionBy("indicator"))
    return candidates.withColumn("_least", least).where(F.col("rank") == F.col("_least"))


def pick_symbol(
    symbols: DataFrame, daily: DataFrame, stale: DataFrame | None = None
) -> DataFrame:
    """Daily values of the best-ranked symbol that has any, per indicator, with a source label.

    ``stale`` holds older copies (symbol, day, value): they serve an indicator none of whose symbols
    has fresh data, and only under its primary symbol.
    """
    listed = symbols.select("indicator", "rank", "symbol")
    label = F.when(F.col("rank") == 0, "yahoo").otherwise(
        F.concat(F.lit("yahoo_fallback:"), F.col("symbol"))
    )
    has_value = F.col("value").isNotNull()
    rows = daily.where(has_value).join(listed, "symbol").withColumn("source", label)
    if stale is not None:
        primary = symbols.where(F.col("rank") == 0).select("indicator", "symbol")
        last_resort = stale.where(has_value).join(primary, "symbol").withColumns({
            "rank": F.lit(2**31 - 1), "source": F.lit("cache_stale"),
        })
        rows = rows.unionByName(last_resort)
    return _best_rank(rows).select("indicator", "symbol", "source", "day", "value")


def weekly_last(daily: DataFrame, *labels: str) -> DataFrame:
    """Last non-null value of each Monday week per indicator (and constant label columns)."""
    return (
        daily.where(F.col("value").isNotNull())
        .groupBy("indicator", *labels, monday(F.col("day")).alias("week"))
        .agg(F.max_by("value", "day").alias("raw_value"))
    )


def week_spine(weekly: DataFrame, n_weeks: int | None = None, end_week=None) -> DataFrame:
    """Mondays from the first to the last week of any series, cut to the last ``n_weeks``."""
    end = F.max("week") if end_week is None else monday(F.lit(end_week).cast("date"))
    bounds = weekly.agg(F.min("week").alias("lo"), end.alias("hi"))
    if n_weeks is not None:
        bounds = bounds.withColumn("lo", F.greatest("lo", F.date_sub("hi", 7 * (n_weeks - 1))))
    step = F.expr("INTERVAL 7 DAYS")
    return bounds.where(F.col("lo") <= F.col("hi")).select(
        F.explode(F.sequence("lo", "hi", step)).alias("week")
    )


def on_spine(
    weekly: DataFrame, indicators=MACRO_KEYS, n_weeks: int | None = None, end_week=None
) -> DataFrame:
    """One row per spine week and indicator, NULL where the series has none.

    The spine is cut before the join, so values older than the cut are gone for the later fill.
    """
    names = F.array(*(F.lit(i) for i in indicators))
    spine = week_spine(weekly, n_weeks, end_week).select("week", F.explode(names).alias("indicator"))
    return spine.join(weekly.select("week", "indicator", "raw_value"), ["week", "indicator"], "left")


def fill_gaps(aligned: DataFrame) -> DataFrame:
    """Forward fill, then back fill of the head, per indicator."""
    w = Window.partitionBy("indicator").orderBy("week")
    forward = F.last("raw_value", ignorenulls=True).over(w)
    backward = F.first("raw_value", ignorenulls=True).over(
        w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    return aligned.select("week", "indicator", F.coalesce(forward, backward).alias("raw_value"))


def zscore(filled: DataFrame) -> DataFrame:
    """(x - mean) / population deviation per indicator; 0 when the deviation is undefined or tiny."""
    whole = Window.partitionBy("indicator")
    x = F.col("raw_value")
    sd = F.stddev_pop(x).over(whole)
    z = F.when(F.coalesce(sd, F.lit(0.0)) < 1e-12, 0.0).otherwise(
        ratio(x - F.avg(x).over(whole), sd)
    )
    return filled.select("week", "indicator", z.alias("z"))


def macro_table(weekly: DataFrame, indicators=MACRO_KEYS, n_weeks=None, end_week=None) -> DataFrame:
    """Weekly long series to the wide table (week, one z-score per indicator)."""
    z = zscore(fill_gaps(on_spine(weekly, indicators, n_weeks, end_week)))
    return z.groupBy("week").pivot("indicator", list(indicators)).agg(F.first("z"))


def pick_feed(
    picked: DataFrame, substitute: DataFrame, indicators=MACRO_KEYS, mode: str = "scraped"
) -> DataFrame:
    """Weekly series per indicator with its source: the scraped one, else the substitute feed.

    Modes ``synthetic`` and ``hybrid`` take the substitute feed throughout.
    """
    if mode not in ("scraped", "synthetic", "hybrid"):
        raise ValueError(f"unknown macro mode {mode!r}")
    wanted = substitute.where(F.col("indicator").isin(*indicators))
    if mode != "scraped":
        return wanted.select("indicator", "week", "raw_value", F.lit("synthetic_full").alias("source"))
    tagged = picked.withColumn("_source", F.concat_ws(":", "source", "symbol"))
    fresh = weekly_last(tagged, "_source").withColumnRenamed("_source", "source")
    both = fresh.withColumn("rank", F.lit(0)).unionByName(
        wanted.select("indicator", "week", "raw_value").withColumns({
            "source": F.lit("synthetic_fallback"), "rank": F.lit(1),
        })
    )
    return _best_rank(both).select("indicator", "week", "raw_value", "source")


def feed_report(feed: DataFrame) -> DataFrame:
    """Source, weeks and whether the substitute stepped in, per indicator."""
    return feed.groupBy("indicator").agg(
        F.min("source").alias("source"),
        F.count_distinct("week").alias("n_weeks"),
        F.bool_or(F.col("source").startswith("synthetic")).alias("used_fallback"),
    )


def macro_lag_join(panel: DataFrame, macro: DataFrame) -> DataFrame:
    """Row of week w gets the indicators of w-1: nothing of the current week leaks in.

    ``macro_table`` groups by week, so the side has one row per week and is broadcast: all weeks of
    the years 1 to 9999 would be some 20 MB.
    """
    shifted = macro.withColumn("week", F.date_add("week", 7))
    return panel.join(F.broadcast(shifted), "week", "left")
