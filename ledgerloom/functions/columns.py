"""Scalar column expressions. Everything here stays in the JVM and inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a, b) -> Column:
    """a / b, NULL when b is 0 (ANSI mode would raise)."""
    return F.try_divide(a, b)


def not_nan(c: Column) -> Column:
    """NaN becomes NULL, so that ordering and comparison behave as for missing values."""
    return F.when(~F.isnan(c), c)


def finite_or_zero(c: Column) -> Column:
    """NULL, NaN and both infinities become 0.0."""
    x = c.cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def monday(ts: Column) -> Column:
    """Monday of the week, as DATE. Date arithmetic only, so the session zone plays no part."""
    return F.trunc(F.to_date(ts), "week")


def safe_corr_from_moments(cov: Column, sx: Column, sy: Column) -> Column:
    """Pearson r, NULL on a constant side; the built-in ``corr`` raises there in ANSI mode."""
    return ratio(cov, sx * sy)


# --- calendar -------------------------------------------------------------------------------

def calendar_parts(day: Column) -> dict[str, Column]:
    """0/1 flags of one day that need no holiday table."""
    m, d = F.month(day), F.dayofmonth(day)
    quarter_month = (m % 3) == 0
    flags = {
        "is_new_year_week": (m == 1) & (F.weekofyear(day) == 1),
        "is_month_end_week": d >= 26,
        "is_quarter_end": quarter_month & (d >= 25),
        "is_tax_deadline_week": quarter_month & (d >= 24),
        "is_payroll_week": d.between(23, 27),
    }
    return {name: cond.cast("int") for name, cond in flags.items()}


def harmonics(week_num: Column, period: float = 52.0) -> dict[str, Column]:
    """First and second yearly sine/cosine pair; ISO week 53 is not wrapped."""
    out = {}
    for order, suffix in ((1, ""), (2, "_2h")):
        angle = week_num * F.lit(2.0 * math.pi * order / period)
        out[f"week_sin{suffix}"] = F.sin(angle)
        out[f"week_cos{suffix}"] = F.cos(angle)
    return out


# --- quality scores -------------------------------------------------------------------------

def _decibel(c: Column) -> Column:
    return F.when(c > 0, F.log10(c) * 10).otherwise(0.0)


def score_components() -> dict[str, Column]:
    """The eight components, from the per-account metric columns."""
    cv = F.col("cv_cashflow")
    unit_p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("adf_pvalue")))
    penalty = (
        F.when(cv.between(0.2, 2.0), 0.0)
        .when(cv < 0.2, (0.2 - cv) * 50)
        .otherwise((cv - 2.0) * 20)
    )
    return {
        "stationarity_component": (1.0 - unit_p) * 100,
        "autocorr_component": F.col("acf_lag1") * 100,
        "trend_component": F.col("trend_strength") * 50,
        "seasonality_component": F.col("seasonality_strength") * 50,
        "completeness_component": F.col("completeness_ratio") * 100,
        "cashflow_component": _decibel(F.col("total_cashflow")),
        "transaction_component": _decibel(F.col("total_transactions")),
        "cv_penalty": penalty,
    }


def _weighted(weights: dict[str, float]) -> Column:
    total = None
    for name, w in weights.items():
        term = F.col(name) * w
        total = term if total is None else total + term
    return total


# Weights of the two scores.
PREDICTABILITY_WEIGHTS = {
    "autocorr_component": 0.5, "trend_component": 0.25, "seasonality_component": 0.25,
}
COMPOSITE_WEIGHTS = {
    "predictability_score": 0.35, "stationarity_component": 0.20, "completeness_component": 0.20,
    "cashflow_component": 0.15, "transaction_component": 0.10, "cv_penalty": -1.0,
}


def predictability_score() -> Column:
    return _weighted(PREDICTABILITY_WEIGHTS)


def composite_score() -> Column:
    return _weighted(COMPOSITE_WEIGHTS)


# --- categories and buckets -----------------------------------------------------------------

def regularity_score(acf: Column, cv: Column) -> Column:
    steadiness = F.greatest(F.lit(0.0), 1.0 - F.least(cv, F.lit(2.0)) / 2.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), acf * 0.5 + steadiness * 0.5))


def first_match(rules, default: str) -> Column:
    """Ordered decision list: label of the first SQL predicate that holds."""
    chain = None
    for label, predicate in rules:
        cond = F.expr(predicate)
        chain = F.when(cond, label) if chain is None else chain.when(cond, label)
    return chain.otherwise(default)


# Ordered category rules over the account_quality_metrics columns.
_SEASONAL = (
    "seasonality_strength > 0.60 AND acf_lag1 >= 0.30 AND cv_cashflow < 1.0 AND trend_strength < 0.50"
)
CATEGORY_RULES_V7 = (
    ("E_short_history", "n_obs < 52"),
    ("D_sparse", "cv_cashflow > 1.0"),
    ("F_flat", "trend_strength < 0.02 AND cv_cashflow < 0.40"),
    ("B_seasonal", _SEASONAL),
    ("C_trending", "trend_strength >= 0.12"),
    ("A_regular_stable", "cv_cashflow < 0.45 AND regularity_score >= 0.55"),
    ("D_noisy", "cv_cashflow >= 0.50 AND trend_strength < 0.12"),
)
CATEGORY_RULES_V6 = (
    ("E_short_history", "n_obs < 52"),
    ("B_seasonal", _SEASONAL),
    ("C_trending", "trend_strength > 0.20 AND seasonality_strength < 0.60 AND cv_cashflow < 1.0"),
    (
        "D_volatile",
        "(acf_lag1 < 0.30 OR cv_cashflow > 1.0) AND seasonality_strength < 0.60"
        " AND trend_strength < 0.50",
    ),
    (
        "A_regular_stable",
        "acf_lag1 > 0.60 AND cv_cashflow < 0.50 AND seasonality_strength < 0.30"
        " AND trend_strength < 0.20",
    ),
)

# Half-open CV buckets (label, low, high).
CV_BUCKETS = (
    ("<0.30", 0.0, 0.30),
    ("[0.30,0.50)", 0.30, 0.50),
    ("[0.50,0.80)", 0.50, 0.80),
    (">=0.80", 0.80, 9.99),
)


def cv_bucket(cv: Column) -> Column:
    """Bucket label; a missing CV falls in the top bucket as no upper bound holds for it."""
    chain = F
    for label, _low, high in CV_BUCKETS[:-1]:
        chain = chain.when(cv < high, label)
    return chain.otherwise(CV_BUCKETS[-1][0])


def cv_bucket_bound(bucket: Column, which: str) -> Column:
    position = {"low": 1, "high": 2}[which]
    chain = F
    for row in CV_BUCKETS[:-1]:
        chain = chain.when(bucket == row[0], row[position])
    return chain.otherwise(CV_BUCKETS[-1][position])


# --- text -----------------------------------------------------------------------------------

def clean_key(c: Column) -> Column:
    """Trimmed text; NULL, blank and the words nan/none are no key at all."""
    t = F.trim(c.cast("string"))
    return F.when(~F.lower(t).isin("", "nan", "none"), t)


def split_keys(text: Column) -> Column:
    """Comma list to array: trimmed, blanks dropped, a missing list is empty."""
    parts = F.transform(F.split(F.coalesce(clean_key(text), F.lit("")), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def join_keys(keys: Column) -> Column:
    return F.concat_ws(",", keys)


def flag_from_text(c: Column) -> Column:
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1", "yes"), F.lit(False))


# Model families with a trainer, and the one alias.
MODEL_FAMILIES = ("ridge", "rf", "lgbm")
DEFAULT_REGRESSION_MODEL = "rf"
CLASSIFICATION_MODEL = "logistic"


def model_key(name: Column, default: str = DEFAULT_REGRESSION_MODEL) -> Column:
    """Normalised model name as recorded; blank takes the default, other names pass through."""
    key = F.lower(F.trim(name))
    return (
        F.when(name.isNull() | (name == ""), default)
        .when(key == "random_forest", "rf")
        .otherwise(key)
    )


def model_family(key: Column) -> Column:
    """The trainer that handles a model key: a name without one goes to rf."""
    return F.when(key.isin(*MODEL_FAMILIES), key).otherwise(DEFAULT_REGRESSION_MODEL)


def number_from_notes(notes: Column, pattern: str = r"reg=([0-9.]+)") -> Column:
    return F.regexp_extract(notes, pattern, 1).try_cast("double")


def lift_pct(baseline: Column, candidate: Column) -> Column:
    """Relative improvement in percent; NULL when the baseline error is 0."""
    return ratio(baseline - candidate, baseline) * 100


def hashed_uniform(*parts: Column) -> Column:
    """Uniform [0,1) drawn from md5 of the row's key: a recomputed task gives the same draw."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


def hashed_normal(*parts: Column) -> Column:
    """Standard normal by Box-Muller over two hashed uniforms."""
    u = 1.0 - hashed_uniform(*parts, F.lit("u"))
    v = hashed_uniform(*parts, F.lit("v"))
    return F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * math.pi * v)
