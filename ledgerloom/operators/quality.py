"""Quality scores, filter, profile tags and threshold ablation."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.operators.tsmetrics import account_metrics, valid_metrics
from ledgerloom.operators.weekly import trailing_mean, weekly_cashflow
from ledgerloom.sources.io import written


@dataclass(frozen=True)
class QualityCuts:
    """Thresholds of the quality filter; the defaults are the function defaults."""

    acf_min: float = 0.35
    adf_pvalue_max: float = 0.10
    completeness_min: float = 0.60
    transactions_min: int = 100
    cv_min: float = 0.30
    cv_max: float = 1.50
    predictability_min: float = 35.0
    composite_min: float = 40.0

    def conditions(self) -> dict[str, Column]:
        """All strict, but for the CV range, which includes its ends."""
        return {
            "acf": F.col("acf_lag1") > self.acf_min,
            "adf_pvalue": F.col("adf_pvalue") < self.adf_pvalue_max,
            "completeness": F.col("completeness_ratio") > self.completeness_min,
            "transactions": F.col("total_transactions") > self.transactions_min,
            "cv": F.col("cv_cashflow").between(self.cv_min, self.cv_max),
            "predictability": F.col("predictability_score") > self.predictability_min,
            "composite": F.col("composite_score") > self.composite_min,
        }

    def holds(self) -> Column:
        return reduce(Column.__and__, self.conditions().values())


# Thresholds of the scheduled job, and the three sets of the ablation.
JOB_CUTS = QualityCuts(acf_min=0.20, cv_min=0.20, cv_max=2.00)
ABLATION_CUTS = {
    "strict": QualityCuts(acf_min=0.35, cv_min=0.30, cv_max=1.50),
    "moderate": QualityCuts(acf_min=0.20, cv_min=0.20, cv_max=2.00),
    "loose": QualityCuts(acf_min=0.10, cv_min=0.10, cv_max=3.00),
}


def quality_scores(metrics: DataFrame) -> DataFrame:
    """Append the components and the two scores."""
    return (
        metrics.withColumns(C.score_components())
        .withColumn("predictability_score", C.predictability_score())
        .withColumn("composite_score", C.composite_score())
    )


def quality_filter(scored: DataFrame, cuts: QualityCuts = QualityCuts(), **changes) -> DataFrame:
    """Accounts above every threshold; single thresholds can be given by keyword."""
    return scored.where(replace(cuts, **changes).holds())


def merge_metrics(eligible: DataFrame, metrics: DataFrame) -> DataFrame:
    return eligible.join(metrics, "account_id")


def quality_accounts(
    weekly: DataFrame, cuts: QualityCuts = QualityCuts(), min_obs: int = 24
) -> DataFrame:
    """Weekly panel to the accounts fit for modelling, with metrics and scores."""
    return quality_filter(quality_scores(valid_metrics(account_metrics(weekly, min_obs))), cuts)


@dataclass(frozen=True)
class QualityRun:
    """The stored weekly panel, the stored quality accounts, and how many accounts each step saw.

    ``counts`` holds accounts_in, untested (no valid unit-root test or autocorrelation), kept, and
    for every cut ``fails_...``, the tested accounts that miss it (an account can miss several).
    """

    weekly: DataFrame
    accounts: DataFrame
    counts: dict[str, int]


def quality_pipeline(
    transactions: DataFrame, cuts: QualityCuts = QualityCuts(), min_obs: int = 24, smoothing: int = 1,
    account_sector: DataFrame | None = None,
) -> QualityRun:
    """Transactions to the weekly panel and the accounts fit for modelling.

    The panel is written once and both outputs read it, so the transactions are scanned once. What
    is kept and rejected is observed in the pass that writes the accounts, without a job of its own.
    ``smoothing`` judges the trailing mean of so many rows; the panel itself stays as it is.
    """
    weekly = written(weekly_cashflow(transactions, account_sector), "weekly")
    judged = trailing_mean(weekly, smoothing) if smoothing > 1 else weekly
    seen, tested = Observation("accounts"), Observation("cuts")
    metrics = account_metrics(judged, min_obs).observe(seen, F.count(F.lit(1)).alias("accounts_in"))
    scored = quality_scores(valid_metrics(metrics)).observe(
        tested, F.count(F.lit(1)).alias("tested"), F.count_if(cuts.holds()).alias("kept"),
        *(F.count_if(~F.coalesce(c, F.lit(False))).alias(f"fails_{n}") for n, c in cuts.conditions().items()),
    )
    accounts = written(quality_filter(scored, cuts), "quality-accounts")
    counts = {**seen.get, **tested.get}
    counts["untested"] = counts["accounts_in"] - counts.pop("tested")
    return QualityRun(weekly, accounts, counts)


def profile_tag(
    scored: DataFrame,
    cuts: QualityCuts = QualityCuts(),
    sparse_completeness: float = 0.40,
    volatile_cv: float = 2.00,
) -> DataFrame:
    """Tag instead of filter: regular, sparse, volatile, else irregular, tested in that order."""
    tag = (
        F.when(cuts.holds(), "regular")
        .when(F.col("completeness_ratio") <= sparse_completeness, "sparse")
        .when(F.col("cv_cashflow") > volatile_cv, "volatile")
        .otherwise("irregular")
    )
    return scored.withColumn("profile", tag)


def cuts_ablation(scored: DataFrame, cut_sets: dict[str, QualityCuts] = ABLATION_CUTS) -> DataFrame:
    """Accounts tested and passed per threshold set, in one pass (no row is multiplied)."""
    passed = scored.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(cuts.holds()).alias(name) for name, cuts in cut_sets.items()),
    )
    rows = F.array(*(
        F.struct(F.lit(name).alias("threshold_set"), F.col(name).alias("n_passed"))
        for name in cut_sets
    ))
    return (
        passed.select("n", F.inline(rows))
        .select(
            "threshold_set", F.col("n").alias("n_accounts"), "n_passed",
            C.ratio(F.col("n_passed"), F.col("n")).alias("pass_share"),
        )
    )


def regularity_label(metrics: DataFrame, threshold: float = 0.55) -> DataFrame:
    """Regularity score and the regular/irregular condition it implies."""
    score = C.regularity_score(F.col("acf_lag1"), F.col("cv_cashflow"))
    return metrics.withColumn("regularity_score", score).withColumn(
        "regularity", F.when(F.col("regularity_score") >= threshold, "regular").otherwise("irregular")
    )


def with_category(metrics: DataFrame, version: str = "v7") -> DataFrame:
    """Append ``account_category`` by the v7 tree, or by the pooled v6 one."""
    rules, default = {
        "v7": (C.CATEGORY_RULES_V7, "D_irregular"),
        "v6": (C.CATEGORY_RULES_V6, "F_mixed"),
    }[version]
    score = C.regularity_score(F.col("acf_lag1"), F.col("cv_cashflow"))
    return (
        metrics.withColumn("regularity_score", score)
        .withColumn("account_category", C.first_match(rules, default))
        .drop("regularity_score")
    )
