"""Transforms of the robustness experiments: irregular features, selection, degradations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import columns as C
from ledgerloom.functions.literals import literal_table
from ledgerloom.operators.matrix import external_lags, lag_columns, series_index
from ledgerloom.operators.models import fit_boosted
from ledgerloom.operators.tsmetrics import indexed
from ledgerloom.operators.weekly import account_window
from ledgerloom.schemas import CALENDAR_KEYS, MACRO_KEYS
from ledgerloom.sources.io import written

EWM_SPANS = (4, 12, 52)


def irregular_features(panel: DataFrame) -> DataFrame:
    """Activity, local completeness, largest step and range over the last observed rows."""
    w = account_window()
    x = F.col("total_amount")

    def last(n: int):
        return w.rowsBetween(-(n - 1), 0)

    active = F.coalesce((x != 0).cast("int"), F.lit(0))
    return (
        panel.withColumn("is_active_week", active)
        .withColumn("_step", F.abs(x - F.lag(x, 1).over(w)))
        .withColumns({
            "active_weeks_8w": F.sum("is_active_week").over(last(8)),
            "local_completeness_8w": F.avg("is_active_week").over(last(8)),
            "max_change_4w": F.max("_step").over(last(4)),
            "std_4w": F.stddev_samp(x).over(last(4)),
            "max_12w": F.max(x).over(last(12)),
            "min_12w": F.min(x).over(last(12)),
        })
        .drop("_step")
    )


def ewm_features(panel: DataFrame, spans=EWM_SPANS) -> DataFrame:
    """Recursive exponentially weighted means (alpha = 2 / (span + 1)), started at the first amount.

    A recursion has no window form: one aggregation orders an account's weeks (bounded by the
    calendar) and a fold over that array runs it. A missing amount repeats the mean and fades its
    weight, so that the next amount counts for more.
    """
    point = F.struct("week", "sector", F.col("total_amount").cast("double").alias("total_amount"))
    series = panel.groupBy("account_id").agg(F.array_sort(F.collect_list(point)).alias("_points"))

    def smoothed(span: int) -> Column:
        alpha = 2.0 / (span + 1)

        def step(acc: Column, at: Column) -> Column:
            x = F.nanvl(at["total_amount"], F.lit(None).cast("double"))
            old = acc["weight"] * (1 - alpha)
            mean = (
                F.when(x.isNull(), acc["mean"]).when(acc["mean"].isNull(), x)
                .otherwise((old * acc["mean"] + alpha * x) / (old + alpha))
            )
            return F.struct(
                mean.alias("mean"), F.when(x.isNull(), old).otherwise(1.0).alias("weight"),
                F.concat(acc["means"], F.array(mean)).alias("means"),
            )

        start = F.struct(
            F.lit(None).cast("double").alias("mean"), F.lit(1.0).alias("weight"),
            F.array().cast("array<double>").alias("means"),
        )
        return F.aggregate("_points", start, step, lambda acc: acc["means"])

    names = [f"ewm_{s}" for s in spans]
    folded = series.withColumns({n: smoothed(s) for s, n in zip(spans, names)})
    return folded.select(
        "account_id", F.explode(F.arrays_zip("_points", *names)).alias("_row")
    ).select(
        "account_id", *(f"_row._points.{c}" for c in ("week", "sector", "total_amount")),
        *(f"_row.{n}" for n in names),
    )


# --- selection of externals -----------------------------------------------------------------------

def external_correlations(panel: DataFrame, externals=MACRO_KEYS, max_lag: int = 4) -> DataFrame:
    """Pearson r and pair count of the amount with each external at lags 0..max_lag.

    All (external, lag) pairs are columns of one aggregation, unfolded after it: rows are not
    multiplied before the shuffle.
    """
    w = account_window()
    shifted = panel.withColumns({
        f"_{k}_{lag}": F.lag(k, lag).over(w) if lag else F.col(k)
        for k in externals for lag in range(max_lag + 1)
    })
    x = F.col("total_amount")
    cells = {}
    for k in externals:
        for lag in range(max_lag + 1):
            e = F.col(f"_{k}_{lag}")
            xx, ee = F.when(e.isNotNull(), x), F.when(x.isNotNull(), e)
            cells[k, lag] = F.struct(
                C.safe_corr_from_moments(
                    F.covar_pop(xx, ee), F.stddev_pop(xx), F.stddev_pop(ee)
                ).alias("r"),
                F.count(xx + ee).alias("n_pairs"),
            ).alias(f"{k}#{lag}")
    wide = shifted.groupBy("account_id").agg(*cells.values())
    rows = F.array(*(
        F.struct(
            F.lit(k).alias("external"), F.lit(lag).alias("lag"),
            F.col(f"`{k}#{lag}`.r").alias("r"), F.col(f"`{k}#{lag}`.n_pairs").alias("n_pairs"),
        )
        for k, lag in cells
    ))
    return wide.select("account_id", F.inline(rows))


def _log_gamma_half_ratio(a: np.ndarray) -> np.ndarray:
    """log( Gamma(a + 1/2) / Gamma(a) ), by the shifted asymptotic series."""
    shift = np.zeros_like(a)
    z = a.copy()
    while np.any(z < 20):
        low = z < 20
        shift = shift + np.where(low, np.log(np.where(low, z / (z + 0.5), 1.0)), 0.0)
        z = np.where(low, z + 1, z)
    series = -1 / (8 * z) + 1 / (192 * z**3) - 1 / (640 * z**5)
    return 0.5 * np.log(z) + series + shift


def student_two_sided(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two-sided p-value of a Pearson r over n pairs.

    Under no correlation r has density (1 - r^2)^(n/2 - 2) / B(1/2, n/2 - 1); the tail is integrated
    by Gauss-Legendre over the angle asin(|r|) .. pi/2, where the integrand is a power of cosine.
    """
    r, n = np.abs(np.asarray(r, dtype=float)), np.asarray(n, dtype=float)
    ok = np.isfinite(r) & (n > 2)
    half = np.where(ok, n, 4.0) / 2 - 1
    nodes, weights = np.polynomial.legendre.leggauss(64)
    lo = np.arcsin(np.clip(np.where(ok, r, 0.0), 0.0, 1.0))
    # The integrand dies within a few widths 1/sqrt(n), so the range ends there.
    hi = np.minimum(np.pi / 2, lo + 12.0 / np.sqrt(half + 0.5))
    angle = lo[:, None] + (hi - lo)[:, None] * (nodes + 1) / 2
    power = (2 * half - 1)[:, None] * np.log(np.maximum(np.cos(angle), 1e-300))
    tail = (hi - lo) / 2 * (np.exp(power) * weights).sum(axis=1)
    log_beta = 0.5 * np.log(np.pi) - _log_gamma_half_ratio(half)
    return np.where(ok, np.clip(2 * tail * np.exp(-log_beta), 0.0, 1.0), np.nan)


@F.pandas_udf(T.DoubleType())
def _p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    p = student_two_sided(r.to_numpy(dtype=float, na_value=np.nan), n.to_numpy())
    return pd.Series(pd.array(np.where(np.isnan(p), 1.0, p)))


def select_by_correlation(
    correlations: DataFrame, alpha: float = 0.05, min_abs_r: float = 0.05
) -> DataFrame:
    """Externals with at least one significant lag, per account (all externals listed)."""
    hit = (F.col("p_value") < alpha) & (F.abs("r") > min_abs_r)
    return (
        correlations.withColumn("p_value", _p_value("r", "n_pairs"))
        .groupBy("account_id", "external")
        .agg(
            F.coalesce(F.bool_or(hit), F.lit(False)).alias("keep"),
            F.min("p_value").alias("min_p"),
            F.max(F.abs("r")).alias("max_abs_r"),
        )
    )


def select_by_importance(
    panel: DataFrame, externals=MACRO_KEYS, share: float = 0.8, threshold: float = 0.01,
    rounds: int = 50,
) -> DataFrame:
    """Externals whose two columns carry at least ``threshold`` of the pooled model's importance.

    The model sees the first ``share`` of every account's rows. Its importances are one number per
    column, so the result is made from driver values.
    """
    base = external_lags(lag_columns(series_index(panel)), externals)
    n = F.count(F.lit(1)).over(Window.partitionBy("account_id"))
    lags = [f"back_{k}" for k in range(1, 5)]
    names = lags + [f"{k}_{lag}" for k in externals for lag in ("t", "t1")]
    rows = (
        base.withColumn("n", n)
        .where((F.col("t") >= 4) & (F.col("t") < F.col("n") * share))
        .select(F.col("total_amount").alias("y"), F.array(*names).alias("x"))
    )
    rows = written(rows, "importance-rows")  # the fit passes over its rows many times
    weights = fit_boosted(rows, "x", rounds).featureImportances.toArray()
    total = dict(zip(names, weights))
    out = [(k, float(total[f"{k}_t"] + total[f"{k}_t1"])) for k in externals]
    return literal_table(panel.sparkSession, out, "external string, importance double").withColumn(
        "keep", F.col("importance") >= threshold
    )


def combine_selection(
    frame: DataFrame, by_correlation: str = "by_correlation", by_importance: str = "by_importance"
) -> DataFrame:
    """Selected externals by model family; the calendar keys always stay."""
    model = F.col("model_name")
    corr, imp = F.col(by_correlation), F.col(by_importance)
    chosen = (
        F.when(model.isin("sarima", "holt_winters"), corr)
        .when(model == "ridge", F.array_union(corr, imp))
        .otherwise(imp)
    )
    calendar = F.array(*(F.lit(k) for k in CALENDAR_KEYS))
    return frame.withColumn("selected", F.array_union(chosen, calendar))


# --- degradations -----------------------------------------------------------------------------------

def _missing(share: float, *key: Column) -> Column:
    return C.hashed_uniform(*key) < share


def degrade_externals(
    panel: DataFrame, condition: str, externals=MACRO_KEYS, seed: int = 42
) -> DataFrame:
    """Externals made worse per account; calendar flags stay.

    Conditions: A_perfect, B_lag1w, C_lag3w, D_noisy30 (noise of 30 % of the account's deviation),
    E_missing20 (20 % dropped, then forward filled). Draws hash the row's key, so a lost executor
    recomputes the same values.
    """
    w = account_window()
    whole = Window.partitionBy("account_id")

    def worse(k: str) -> Column:
        key = (F.col("account_id"), F.col("week").cast("string"), F.lit(k), F.lit(str(seed)))
        x = F.col(k)
        if condition == "A_perfect":
            return x
        if condition in ("B_lag1w", "C_lag3w"):
            return F.lag(x, {"B_lag1w": 1, "C_lag3w": 3}[condition]).over(w)
        if condition == "D_noisy30":
            return x + C.hashed_normal(*key) * 0.3 * F.stddev_pop(x).over(whole)
        if condition == "E_missing20":
            return F.last(F.when(~_missing(0.2, *key), x), ignorenulls=True).over(w)
        raise ValueError(f"unknown condition {condition!r}")

    return panel.withColumns({k: worse(k) for k in externals})


def level_shift(panel: DataFrame, start: int = 70, share: float = 0.30) -> DataFrame:
    """From row ``start`` on, amounts rise by ``share`` of the account's mean."""
    mean = F.avg("total_amount").over(Window.partitionBy("account_id"))
    x = F.col("total_amount")
    shifted = F.when(F.col("idx") >= start, x + mean * share).otherwise(x)
    return indexed(panel).withColumn("total_amount", shifted).drop("n", "n_missing")


def rotate_sectors(assignment_source: DataFrame, sectors) -> DataFrame:
    """Give every account the next sector of the list; a sector outside the list stays.

    Resolving the rotated sector yields externals of a wrong sector, a causality control.
    """
    ring = list(sectors)
    rotated = F.col("sector")
    for own, other in zip(ring, ring[1:] + ring[:1]):
        rotated = F.when(F.col("sector") == own, other).otherwise(rotated)
    return assignment_source.select(
        "account_id", F.col("sector").alias("true_sector"), rotated.alias("sector")
    )
