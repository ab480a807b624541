"""Time-series metrics per account: autocorrelation, trend, seasonality, unit-root test.

All metrics share one shuffle by account. The moments are window and aggregate expressions; only the
lag-augmented Dickey-Fuller regression leaves the JVM, as an Arrow batch function over the series
array that the same aggregation already built.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import ratio, safe_corr_from_moments
from ledgerloom.schemas import QUALITY, TS_METRICS
from ledgerloom.operators.weekly import (
    account_window, eligible_accounts, restrict_to, stats_aggregates, with_ratios,
)

SEASON = 52
MIN_ACF_ROWS = 8

# MacKinnon response surface for the p-value, constant only, one series.
ADF_TAU_MIN, ADF_TAU_STAR, ADF_TAU_MAX = -18.83, -1.61, 2.74
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def indexed(weekly: DataFrame) -> DataFrame:
    """Panel plus ``idx`` (0-based position), ``n`` and ``n_missing`` of the account."""
    whole = Window.partitionBy("account_id")
    return weekly.withColumns({
        "idx": F.row_number().over(account_window()) - 1,
        "n": F.count(F.lit(1)).over(whole),
        "n_missing": F.count_if(F.col("total_amount").isNull()).over(whole),
    })


def _lagged_rows(weekly: DataFrame) -> DataFrame:
    """Each row with the values its metrics pair it with."""
    w = account_window()
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x, idx, n = F.col("total_amount"), F.col("idx"), F.col("n")
    base = indexed(weekly).withColumns({
        "_mean": F.avg(x).over(Window.partitionBy("account_id")),
        "_season": F.when(n > SEASON, SEASON).otherwise(F.floor(n / 2)).cast("int"),
        # lag() takes one offset for all accounts, while a short account's season is its half
        # length. Its at most 52 values are looked up instead; longer accounts collect nothing.
        "_head": F.collect_list(F.when(n <= SEASON, x)).over(whole),
        "_x1": F.lag(x, 1).over(w),
        "_x2": F.lag(x, 2).over(w),
        "_x52": F.lag(x, SEASON).over(w),
    })
    short = F.when(
        (idx >= F.col("_season")) & (F.col("_season") > 0),
        F.get(F.col("_head"), (idx - F.col("_season")).cast("int")),
    )
    return base.withColumn("_xs", F.when(n > SEASON, F.col("_x52")).otherwise(short))


def _moments(weekly: DataFrame) -> DataFrame:
    """One row per account: statistics, every moment-based metric, the ordered series.

    Columns that a caller does not use are pruned, with the windows behind them.
    """
    x, m = F.col("total_amount"), F.col("_mean")
    spread = F.sum((x - m) * (x - m))
    paired = F.when(F.col("_xs").isNotNull(), x)
    dx = x - F.col("_x1")
    return (
        _lagged_rows(weekly)
        .groupBy("account_id")
        .agg(
            *stats_aggregates(),
            F.max("n").alias("n"),
            F.max("n_missing").alias("n_missing"),
            ratio(F.sum((x - m) * (F.col("_x1") - m)), spread).alias("r1"),
            ratio(F.sum((x - m) * (F.col("_x2") - m)), spread).alias("r2"),
            F.when(F.var_pop(x) > 0, F.regr_r2(x, F.col("idx")))
            .when(F.count(x) > 1, 0.0).alias("r2_trend"),
            F.abs(safe_corr_from_moments(
                F.covar_pop(x, "_xs"), F.stddev_pop(paired), F.stddev_pop("_xs"),
            )).alias("seasonal_r"),
            F.regr_count(dx, F.col("_x1")).alias("df_m"),
            F.regr_slope(dx, F.col("_x1")).alias("df_b"),
            F.regr_sxx(dx, F.col("_x1")).alias("df_sxx"),
            F.regr_sxy(dx, F.col("_x1")).alias("df_sxy"),
            F.regr_syy(dx, F.col("_x1")).alias("df_syy"),
            F.transform(
                F.array_sort(F.collect_list(F.struct("idx", x.alias("x")))), lambda e: e["x"]
            ).alias("series"),
        )
    )


def _defined(value: Column, min_rows: int = 1) -> Column:
    """NULL for a short series or one with a missing week: the metric is undefined there."""
    return F.when((F.col("n") >= min_rows) & (F.col("n_missing") == 0), value)


def _metric_columns() -> dict[str, Column]:
    n = F.col("n")
    return {
        "acf_lag1": _defined(F.col("r1"), MIN_ACF_ROWS),
        "acf_lag2": _defined(F.col("r2"), MIN_ACF_ROWS),
        "pacf_lag1": _defined(F.col("r1") * n / (n - 1), MIN_ACF_ROWS),
        "trend_strength": _defined(F.col("r2_trend")),
        "seasonality_strength": _defined(F.col("seasonal_r")),
    }


def _select_metrics(weekly: DataFrame, *names: str) -> DataFrame:
    cols = _metric_columns()
    return _moments(weekly).select("account_id", *(cols[c].alias(c) for c in names))


def ts_acf(weekly: DataFrame) -> DataFrame:
    """Biased autocorrelation at lags 1 and 2."""
    return _select_metrics(weekly, "acf_lag1", "acf_lag2")


def ts_pacf(weekly: DataFrame) -> DataFrame:
    """Partial autocorrelation at lag 1 (adjusted Yule-Walker)."""
    return _select_metrics(weekly, "pacf_lag1")


def ts_trend(weekly: DataFrame) -> DataFrame:
    """R2 of the amount on its position."""
    return _select_metrics(weekly, "trend_strength")


def ts_seasonality(weekly: DataFrame) -> DataFrame:
    """|correlation| with the value one season earlier."""
    return _select_metrics(weekly, "seasonality_strength")


def ts_df0(weekly: DataFrame) -> DataFrame:
    """Dickey-Fuller statistic without lagged differences, in closed form."""
    residual = F.greatest(F.col("df_syy") - F.col("df_b") * F.col("df_sxy"), F.lit(0.0))
    error = F.sqrt(ratio(ratio(residual, F.col("df_m") - 2), F.col("df_sxx")))
    return _moments(weekly).select(
        "account_id",
        _defined(F.when(F.col("df_m") > 2, ratio(F.col("df_b"), error))).alias("df_statistic"),
    )


# --- augmented Dickey-Fuller ------------------------------------------------------------------

def adf_pvalue(tau: float) -> float:
    """MacKinnon approximate p-value of the constant-only statistic."""
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    coefficients = ADF_SMALL_P if tau <= ADF_TAU_STAR else ADF_LARGE_P
    z = sum(c * tau**k for k, c in enumerate(coefficients))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def _design(x: np.ndarray, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """Difference on [1, level, lagged differences] over the rows where all lags exist."""
    dx = np.diff(x)
    y = dx[lags:]
    columns = [np.ones(len(y)), x[lags:-1]]
    columns += [dx[lags - j : len(dx) - j] for j in range(1, lags + 1)]
    return np.column_stack(columns), y


def adf_statistic(x: np.ndarray) -> float | None:
    """Unit-root t statistic, lag order by AIC on the common sample, refit on all usable rows."""
    n = len(x)
    max_lag = min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2)
    if max_lag < 0 or not np.all(np.isfinite(x)) or np.ptp(x) == 0:
        return None
    design, y = _design(x, max_lag)
    m = len(y)
    # One QR serves every nested model: the residual of the first k columns is what the first k
    # rotated responses leave over.
    q, _ = np.linalg.qr(design)
    explained = np.cumsum((q.T @ y) ** 2)[1:]
    rss = np.maximum(y @ y - explained, np.finfo(float).tiny)
    aic = m * np.log(rss / m) + 2.0 * np.arange(2, design.shape[1] + 1)
    design, y = _design(x, int(np.argmin(aic)))
    dof = len(y) - design.shape[1]
    if dof <= 0:
        return None
    inverse = np.linalg.pinv(design)
    beta = inverse @ y
    residual = y - design @ beta
    scale = float(residual @ residual) / dof * float(inverse[1] @ inverse[1])
    return float(beta[1] / math.sqrt(scale)) if scale > 0 else None


# A type string would need a live session where the module is imported, which workers lack.
_ADF_TYPE = T.StructType([
    T.StructField("adf_statistic", T.DoubleType()), T.StructField("adf_pvalue", T.DoubleType()),
])


@F.pandas_udf(_ADF_TYPE)
def _adf_batch(series: pd.Series) -> pd.DataFrame:
    tau = [None if s is None else adf_statistic(np.asarray(s, dtype=float)) for s in series]
    return pd.DataFrame({
        "adf_statistic": pd.array(tau, dtype="Float64"),
        "adf_pvalue": pd.array([None if t is None else adf_pvalue(t) for t in tau], dtype="Float64"),
    })


def _with_adf(moments: DataFrame) -> DataFrame:
    series = F.when(F.col("n_missing") == 0, F.col("series"))
    # Marked so that a filter on the result is not pushed below it as a second test of all rows.
    return moments.withColumn("_adf", _adf_batch.asNondeterministic()(series)).select(
        "*", "_adf.adf_statistic", "_adf.adf_pvalue"
    )


def ts_metrics(weekly: DataFrame, eligible: DataFrame | None = None) -> DataFrame:
    """All metrics, one row per account; ``eligible`` restricts the panel first."""
    panel = weekly if eligible is None else restrict_to(weekly, eligible)
    return _with_adf(_moments(panel).withColumns(_metric_columns())).select(*TS_METRICS.fieldNames())


def account_metrics(weekly: DataFrame, min_obs: int = 24, adf: bool = True) -> DataFrame:
    """Statistics and metrics of the eligible accounts from one pass over the panel.

    Equals eligibility, the semi join of the panel, the metrics and the join of both, but the panel
    is read and shuffled by account once; the costly unit-root test sees eligible accounts only.
    """
    eligible = eligible_accounts(with_ratios(_moments(weekly).withColumns(_metric_columns())), min_obs)
    tested = _with_adf(eligible) if adf else eligible
    names = [n for n in QUALITY.fieldNames() if n in tested.columns]
    return tested.select(*names)


def ts_adf(weekly: DataFrame) -> DataFrame:
    return ts_metrics(weekly).select("account_id", "adf_statistic", "adf_pvalue")


def valid_metrics(metrics: DataFrame) -> DataFrame:
    """Rows whose unit-root test and first autocorrelation exist."""
    keep = None
    for name in ("adf_statistic", "adf_pvalue", "acf_lag1"):
        ok = F.col(name).isNotNull() & ~F.isnan(name)
        keep = ok if keep is None else keep & ok
    return metrics.where(keep)
