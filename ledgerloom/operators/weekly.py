"""Weekly panel, per-account statistics and eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.aggregates import keep_one
from ledgerloom.functions.columns import monday, ratio

# Row order inside an account. An account with two sectors has two rows in one week; the sector
# settles their order, so every windowed result is deterministic.
PANEL_ORDER = ("week", "sector")


def account_window() -> Window:
    """Rows of one account in week order.

    A window partition holds one account's *weekly* rows, so its size is bounded by the calendar
    (about 52 per year and sector) however many transactions the account has.
    """
    return Window.partitionBy("account_id").orderBy(*PANEL_ORDER)


def weekly_cashflow(transactions: DataFrame, account_sector: DataFrame | None = None) -> DataFrame:
    """Sum and non-null count of amounts per account, Monday week and sector.

    With ``account_sector`` (account_id, sector; of several rows the one whose sector sorts first, and
    a NULL sector for accounts without one, so no amount is lost or doubled) the transactions are summed
    first and only the weekly rows meet the dimension: the join then moves weeks instead of
    transactions, and an account that holds a third of all transactions is no hot key any more.
    """
    sums = (
        F.sum("amount").alias("total_amount"),
        F.count("amount").alias("transaction_count"),
    )
    dated = transactions.withColumn("week", monday(F.col("op_ts")))
    if account_sector is None:
        out = dated.groupBy("account_id", "week", "sector").agg(*sums)
    else:
        out = dated.groupBy("account_id", "week").agg(*sums).join(
            keep_one(account_sector.select("account_id", "sector"), ["account_id"], ["sector"]), "account_id", "left"
        )
    return out.select("account_id", "week", "sector", "total_amount", "transaction_count")


def week_sort(panel: DataFrame) -> DataFrame:
    """Total order for an output; no operator needs it between steps."""
    return panel.orderBy("account_id", *PANEL_ORDER)


def trailing_mean(weekly: DataFrame, rows: int = 4) -> DataFrame:
    """Panel whose amount is the mean of the current and the preceding rows."""
    frame = account_window().rowsBetween(-(rows - 1), 0)
    return weekly.withColumn("total_amount", F.avg("total_amount").over(frame))


def stats_aggregates() -> list[Column]:
    """Aggregates of one account's weekly rows; the sector is that of the first week."""
    x = F.col("total_amount")
    return [
        F.count(x).alias("n_obs"),
        F.sum("transaction_count").alias("total_transactions"),
        F.sum(F.abs(x)).alias("total_cashflow"),
        F.avg(F.abs(x)).alias("mean_cashflow"),
        F.stddev_samp(x).alias("std_cashflow"),
        F.sum((x != 0).cast("double")).alias("non_zero_periods"),
        F.min_by("sector", F.struct(*PANEL_ORDER)).alias("sector"),
    ]


def with_ratios(stats: DataFrame) -> DataFrame:
    return stats.withColumns({
        "completeness_ratio": ratio(F.col("non_zero_periods"), F.col("n_obs")),
        "cv_cashflow": ratio(F.col("std_cashflow"), F.col("mean_cashflow")),
    })


def account_stats(weekly: DataFrame) -> DataFrame:
    """One row per account: length, turnover, dispersion, completeness, sector."""
    return with_ratios(weekly.groupBy("account_id").agg(*stats_aggregates()))


def eligible_accounts(stats: DataFrame, min_obs: int = 24, min_std: float = 1e-8) -> DataFrame:
    return stats.where((F.col("n_obs") >= min_obs) & (F.col("std_cashflow") >= min_std))


def restrict_to(panel: DataFrame, accounts: DataFrame) -> DataFrame:
    """Panel rows of the given accounts (semi join: no duplicates whatever ``accounts`` holds)."""
    return panel.join(accounts.select("account_id"), "account_id", "left_semi")


def with_min_history(panel: DataFrame, min_rows: int) -> DataFrame:
    """Rows of the accounts that have at least ``min_rows`` rows."""
    n = F.count(F.lit(1)).over(Window.partitionBy("account_id"))
    return panel.withColumn("n_rows", n).where(F.col("n_rows") >= min_rows)


def latest_week(panel: DataFrame) -> DataFrame:
    """Newest row per account; the aggregate combines before the shuffle."""
    row = F.struct(*panel.columns)
    return (
        panel.groupBy("account_id")
        .agg(F.max_by(row, F.struct(*PANEL_ORDER)).alias("_row"))
        .select("_row.*")
    )


def last_n_weeks(panel: DataFrame, n_weeks: int) -> DataFrame:
    """Rows of the last ``n_weeks`` distinct weeks of the whole panel.

    The distinct weeks are a calendar (bounded), so the kept ones are joined back by broadcast.
    """
    weeks = panel.select("week").distinct().orderBy(F.desc("week")).limit(n_weeks)
    return panel.join(F.broadcast(weeks), "week", "left_semi").select(*panel.columns)
