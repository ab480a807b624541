"""Experiment results to lift tables, lookups and a derived category policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.aggregates import exact_median
from ledgerloom.functions.literals import literal_table
from ledgerloom.operators.policy import builtin_policy, sector_rule
from ledgerloom.sources.io import written

PAIR_KEYS = ["name", "condition", "model_name"]

# Category, rule, source experiment, and the column and value that select its rows.
CATEGORY_SOURCES = (
    ("E_short_history", "E_short", "EXP1_C_short", "condition", "C_short"),
    ("D_noisy", "D_noisy", "EXP1_B_noisy", "condition", "B_noisy"),
    ("B_seasonal", "B_seasonal", "EXP3_seasonal", "account_type", "seasonal"),
    ("D_sparse", "D_sparse", "EXP6_sparse", "condition", "sparse"),
    ("F_flat", "F_flat", "EXP6_flat", "condition", "flat"),
    ("C_trending", "C_trending", "EXP2_C_level_shift", "condition", "C_level_shift_w70"),
    ("A_regular_stable", "A_regular", "EXP1_A_clean", "condition", "A_clean"),
    ("D_irregular", "D_irregular", "EXP3_irregular", "condition", "irregular"),
)
_SOURCE_SCHEMA = (
    "account_category string, policy_rule_id string, source_exp string,"
    " source_kind string, source_value string"
)


def calibration_rows(results: DataFrame) -> DataFrame:
    """Calibration role (if the column exists) and the three trainable model families."""
    if "experiment_role" in results.columns:
        results = results.where(F.col("experiment_role") == "calibration")
    return results.where(F.col("model_name").isin(*C.MODEL_FAMILIES))


def paired(results: DataFrame) -> DataFrame:
    """Baseline and with-externals errors of the same (name, condition, model), with the lift."""
    def side(kind: str, alias: str) -> DataFrame:
        return results.where(F.col("model_type") == kind).select(
            *PAIR_KEYS, F.col("rmse").alias(alias)
        )

    return (
        side("baseline", "rmse_baseline")
        .join(side("with_externals", "rmse_with_externals"), PAIR_KEYS)
        .withColumn(
            "rmse_lift_pct", C.lift_pct(F.col("rmse_baseline"), F.col("rmse_with_externals"))
        )
    )


def scope_semi(pairs: DataFrame, results: DataFrame, account_type: str) -> DataFrame:
    """Pairs whose (name, condition) was run for the given account type."""
    scope = results.where(F.col("account_type") == account_type)
    return pairs.join(scope.select("name", "condition"), ["name", "condition"], "left_semi")


def _categories(kind: str, holds) -> Column:
    """Categories whose source of the given kind satisfies ``holds`` (eight literal entries at most)."""
    entries = F.array(*(
        F.struct(F.lit(row[4]).alias("value"), F.lit(row[0]).alias("category"))
        for row in CATEGORY_SOURCES if row[3] == kind
    ))
    return F.transform(F.filter(entries, lambda e: holds(e["value"])), lambda e: e["category"])


def source_pairs(results: DataFrame) -> DataFrame:
    """Pairs labelled with the category whose source experiment they belong to.

    A pair can serve two categories (its condition's and its account type's): it is joined once and
    unfolded, not labelled in two branches. ``results`` is read three times, so pass a stored table.
    """
    listed = [row[4] for row in CATEGORY_SOURCES if row[3] == "account_type"]
    # A set of at most the listed types, not of the group's rows.
    types = results.where(F.col("account_type").isin(*listed)).groupBy("name", "condition").agg(
        F.collect_set("account_type").alias("_types")
    )
    by_condition = _categories("condition", lambda v: v == F.col("condition"))
    by_type = _categories(
        "account_type", lambda v: F.coalesce(F.array_contains("_types", v), F.lit(False))
    )
    return paired(results).join(types, ["name", "condition"], "left").select(
        F.explode(F.concat(by_condition, by_type)).alias("account_category"),
        *PAIR_KEYS, "rmse_baseline", "rmse_with_externals", "rmse_lift_pct",
    )


def lift_medians(labelled: DataFrame) -> DataFrame:
    """Median error with externals and median lift per category and model (reads its input twice)."""
    keys = ["account_category", "model_name"]
    long = labelled.select(
        *keys,
        F.inline(F.array(
            F.struct(F.lit("rmse").alias("measure"), F.col("rmse_with_externals").alias("v")),
            F.struct(F.lit("lift").alias("measure"), F.col("rmse_lift_pct").alias("v")),
        )),
    )
    medians = exact_median(long, keys + ["measure"], "v", "median")
    return medians.groupBy(*keys).agg(
        F.max(F.when(F.col("measure") == "rmse", F.col("median"))).alias("rmse_with_externals"),
        F.max(F.when(F.col("measure") == "lift", F.col("median"))).alias("lift_med"),
    )


def champion_models(medians: DataFrame) -> DataFrame:
    """Model of least median error per category; equal errors go to the first model name."""
    best = F.struct("rmse_with_externals", "model_name")
    return medians.where(F.col("rmse_with_externals").isNotNull()).groupBy("account_category").agg(
        F.min_by(F.lower("model_name"), best).alias("champion_model"),
        F.min_by("lift_med", best).alias("lift_med"),
    )


def source_accounts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("account_category").agg(
        F.count_distinct("name").alias("n_accounts")
    )


def derive_policy(results: DataFrame, min_lift_pct: float = 3.0) -> DataFrame:
    """One decision per category: champion model, externals on from ``min_lift_pct`` median lift.

    A category without pairs takes its built-in row. The labelled pairs are stored, as the medians
    read them twice and the account counts once; all joins after that are between tables of at most
    eight rows.
    """
    spark = results.sparkSession
    labelled = written(source_pairs(calibration_rows(results)), "labelled-pairs")
    decided = champion_models(lift_medians(labelled)).join(
        source_accounts(labelled), "account_category"
    )
    fallback = builtin_policy(spark).select(
        "account_category", F.col("activate_externals").alias("_on"),
        F.col("regression_model").alias("_model"), F.col("lift_med_champion_pct").alias("_lift"),
    )
    found = F.col("champion_model").isNotNull()
    return (
        literal_table(spark, CATEGORY_SOURCES, _SOURCE_SCHEMA)
        .join(decided, "account_category", "left")
        .join(fallback, "account_category", "left")
        .select(
            "account_category",
            F.when(found, F.coalesce(F.col("lift_med") >= min_lift_pct, F.lit(False)))
            .otherwise(F.col("_on")).alias("activate_externals"),
            F.coalesce("champion_model", "_model").alias("champion_model"),
            "policy_rule_id", "source_exp",
            F.when(found, F.round("lift_med", 2)).otherwise(F.col("_lift"))
            .alias("lift_med_champion_pct"),
            F.coalesce("n_accounts", F.lit(0)).alias("n_accounts"),
            F.lit("v7_encapsulated").alias("policy_source"),
        )
    )


# --- sector x CV lookup and oracles ---------------------------------------------------------------

def irregular_lifts(lifts: DataFrame, pattern: str = r"reg=([0-9.]+)") -> DataFrame:
    """Forest lifts of the irregular condition, with the regularity noted in the free text."""
    reg = C.number_from_notes(F.col("notes"), pattern)
    return (
        lifts.where((F.col("condition") == "irregular") & (F.col("model_name") == "rf"))
        .withColumn("reg", reg)
        .withColumn("cv_bucket", F.when(F.col("reg").isNotNull(), C.cv_bucket(F.col("reg"))))
    )


def _share_positive(lift: Column) -> Column:
    return F.avg(F.coalesce(lift > 0, F.lit(False)).cast("double"))


def sector_cv_lookup(
    lifts: DataFrame, min_mean_lift: float = 0.0, min_share_positive: float = 0.5
) -> DataFrame:
    """Externals per (sector, CV bucket): on when the mean lift and the share of winners suffice."""
    lift = F.col("rmse_lift_pct")
    cells = lifts.where(F.col("cv_bucket").isNotNull()).groupBy("sector", "cv_bucket").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.avg(lift).alias("_mean"),
        _share_positive(lift).alias("_share"),
    )
    on = (F.col("_mean") > min_mean_lift) & (F.col("_share") >= min_share_positive)
    bucket = F.col("cv_bucket")
    return cells.select(
        "sector", "cv_bucket",
        C.cv_bucket_bound(bucket, "low").alias("cv_low"),
        C.cv_bucket_bound(bucket, "high").alias("cv_high"),
        "n_accounts",
        F.round("_mean", 4).alias("mean_rmse_lift_pct"),
        F.round("_share", 4).alias("pct_positive"),
        F.coalesce(on, F.lit(False)).alias("use_externals_regression"),
        F.lit(False).alias("use_externals_classification"),
    )


def regression_oracle(lifts: DataFrame) -> DataFrame:
    """Hindsight flag per experiment account: externals helped."""
    return lifts.select(
        F.col("name").alias("experiment_account"), "sector", "reg", "cv_bucket", "rmse_lift_pct",
        F.coalesce(F.col("rmse_lift_pct") > 0, F.lit(False)).alias("use_externals_regression"),
        F.lit("oracle_lift_gt_0").alias("policy_source"),
    )


def accuracy_pairs(results: DataFrame) -> DataFrame:
    """Accounts with a logistic result of both kinds: the two accuracies side by side."""
    logistic = results.where(F.col("model_name") == "logistic")

    def side(kind: str, alias: str, *extra: str) -> DataFrame:
        return logistic.where(F.col("model_type") == kind).select(
            "name", *extra, F.col("accuracy").alias(alias)
        )

    return side("baseline", "accuracy_baseline", "sector").join(
        side("with_externals", "accuracy_with_externals"), "name"
    )


def classification_oracle(results: DataFrame) -> DataFrame:
    lift = F.col("accuracy_with_externals") - F.col("accuracy_baseline")
    return accuracy_pairs(results).select(
        F.col("name").alias("experiment_account"), "sector", "accuracy_baseline",
        "accuracy_with_externals", lift.alias("accuracy_lift"),
        F.coalesce(lift > 0, F.lit(False)).alias("use_externals_classification"),
        F.lit("oracle_accuracy_lift_gt_0").alias("policy_source"),
    )


def rule_evaluation(lifts: DataFrame, priority_sectors) -> DataFrame:
    """How the sector rule splits the accounts: size, mean lift and winners on either side."""
    lift = F.col("rmse_lift_pct")
    reg = F.coalesce(F.col("reg"), F.lit(0.0))
    on = sector_rule(F.col("sector"), reg, priority_sectors)
    won = F.coalesce(lift > 0, F.lit(False)).cast("double")
    return lifts.withColumn("_on", on).agg(
        F.count_if("_on").alias("on_n"),
        F.count_if(~F.col("_on")).alias("off_n"),
        F.avg(F.when(F.col("_on"), lift)).alias("on_mean_lift_pct"),
        F.avg(F.when(~F.col("_on"), lift)).alias("off_mean_lift_pct"),
        F.avg(F.when(F.col("_on"), won)).alias("on_pct_positive"),
        F.avg(F.when(~F.col("_on"), won)).alias("off_pct_positive"),
        F.avg(won).alias("oracle_pct_positive"),
    )


# --- summaries ------------------------------------------------------------------------------------

def lift_summary(results: DataFrame, keys=("name", "condition", "model_name", "experiment_role")):
    """Wide table of errors per run, baseline next to with_externals, with the lift."""
    metrics = [m for m in ("rmse", "mae", "r2") if m in results.columns]
    wide = results.groupBy(*keys).pivot("model_type", ["baseline", "with_externals"]).agg(
        *(F.avg(m).alias(m) for m in metrics)
    )
    if len(metrics) == 1:  # a single aggregate leaves the bare pivot value as the column name
        only = metrics[0]
        wide = wide.withColumnsRenamed({k: f"{k}_{only}" for k in ("baseline", "with_externals")})
    return wide.withColumn(
        "rmse_lift_pct", C.lift_pct(F.col("baseline_rmse"), F.col("with_externals_rmse"))
    )


def _bin(value: Column, edges) -> Column:
    """Label of the half-open bin that holds the value; a missing value has none."""
    chain = F
    for i, edge in enumerate(edges):
        label = f"<{edges[0]}" if i == 0 else f"[{edges[i - 1]},{edge})"
        chain = chain.when(value < edge, label)
    return chain.when(value >= edges[-1], f">={edges[-1]}")


def lift_with_bins(summary: DataFrame, metrics: DataFrame, edges: dict[str, tuple]) -> DataFrame:
    """Lift rows with a bin label per metric; ``edges`` maps a metric column to its bin edges."""
    binned = metrics.select(
        "name", *(_bin(F.col(c), e).alias(f"{c}_bin") for c, e in edges.items())
    )
    return summary.join(binned, "name", "left")


def lift_aggregate(summary: DataFrame) -> DataFrame:
    """Mean lift and share of winners by condition, model and role."""
    lift = F.col("rmse_lift_pct")
    return summary.groupBy("condition", "model_name", "experiment_role").agg(
        F.count(lift).alias("n_pairs"),
        F.avg(lift).alias("mean_lift_pct"),
        F.avg((lift > 0).cast("double")).alias("pct_positive"),
    )


def category_benchmark(
    summary: DataFrame, by: tuple[str, ...] = (), role: str | None = "calibration"
) -> DataFrame:
    """Model of least mean error with externals per category (and ``by``)."""
    if role is not None:
        summary = summary.where(F.col("experiment_role") == role)
    keys = ["account_category", *by]
    means = summary.groupBy(*keys, "model_name").agg(
        F.avg("with_externals_rmse").alias("mean_rmse"),
        F.avg("rmse_lift_pct").alias("mean_lift_pct"),
    )
    best = F.struct("mean_rmse", "model_name")
    return means.where(F.col("mean_rmse").isNotNull()).groupBy(*keys).agg(
        F.min_by("model_name", best).alias("champion_model"),
        F.min("mean_rmse").alias("mean_rmse"),
        F.min_by("mean_lift_pct", best).alias("mean_lift_pct"),
    )


def policy_draft(benchmark: DataFrame, min_lift_pct: float = 3.0) -> DataFrame:
    return benchmark.select(
        "account_category", "champion_model", "mean_lift_pct",
        F.coalesce(F.col("mean_lift_pct") >= min_lift_pct, F.lit(False)).alias("activate_externals"),
    )


def selection_audit(selections: DataFrame, externals) -> DataFrame:
    """Share of accounts whose selection holds each external, by sector and model (wide)."""
    return selections.groupBy("sector", "model_name").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        *(F.avg(F.array_contains("selected", e).cast("double")).alias(e) for e in externals),
    )
