"""Lag and rolling features over observed rows, and the assembled feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.calendar import calendar_join, seasonal_features
from ledgerloom.operators.macro import macro_lag_join
from ledgerloom.operators.weekly import account_window, restrict_to
from ledgerloom.schemas import FEATURES

_HELPERS = ("_lag1", "_lag1_pos", "_lag1_neg", "_lag1_sign")


def lag1_signs(panel: DataFrame) -> DataFrame:
    """Previous amount with its sign indicators; no previous row counts as sign 0."""
    previous = F.lag("total_amount", 1).over(account_window())
    sign = F.coalesce(F.signum("_lag1"), F.lit(0.0)).cast("int")
    return (
        panel.withColumn("_lag1", previous)
        .withColumn("_lag1_sign", sign)
        .withColumns({
            "_lag1_pos": (F.col("_lag1_sign") == 1).cast("int"),
            "_lag1_neg": (F.col("_lag1_sign") == -1).cast("int"),
        })
    )


def rolling_features(panel: DataFrame) -> DataFrame:
    """Rolling counts, extremes and dispersion of the previous amount (frames in rows)."""
    w = account_window()

    def last(n: int):
        return w.rowsBetween(-(n - 1), 0)

    return lag1_signs(panel).withColumns({
        "negative_count_4w": F.sum("_lag1_neg").over(last(4)),
        "negative_count_8w": F.sum("_lag1_neg").over(last(8)),
        "prop_positive_24w": F.avg("_lag1_pos").over(last(24)),
        "sign_streak_8": F.sum("_lag1_sign").over(last(8)),
        "rolling_max_8w": F.max("_lag1").over(last(8)),
        "rolling_min_8w": F.min("_lag1").over(last(8)),
        "volatility_4w": F.stddev_samp("_lag1").over(last(4)),
    })


def feature_table(
    weekly: DataFrame, accounts: DataFrame | None, calendar: DataFrame, macro: DataFrame
) -> DataFrame:
    """Feature table of the accounts kept (None: all): one shuffle by account, two broadcast joins."""
    kept = seasonal_features(weekly if accounts is None else restrict_to(weekly, accounts))
    joined = macro_lag_join(calendar_join(rolling_features(kept).drop(*_HELPERS), calendar), macro)
    return joined.select(*FEATURES.fieldNames())
