"""Model matrix per account: lags, their moments, yearly phase and the externals a policy allows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.operators.weekly import account_window
from ledgerloom.schemas import EXTERNAL_KEYS

N_LAGS = 4


def series_index(panel: DataFrame, period: int = 52) -> DataFrame:
    """0-based position ``t`` of the row in its account, and its phase in the year of rows."""
    t = F.row_number().over(account_window()) - 1
    return panel.withColumn("t", t).withColumn("phase", F.pmod("t", F.lit(period)))


def lag_columns(panel: DataFrame, n_lags: int = N_LAGS) -> DataFrame:
    """``back_k`` = amount k rows earlier."""
    w = account_window()
    return panel.withColumns({
        f"back_{k}": F.lag("total_amount", k).over(w) for k in range(1, n_lags + 1)
    })


def lag_moments(panel: DataFrame, n_lags: int = N_LAGS) -> DataFrame:
    """Mean and population deviation of the previous ``n_lags`` amounts (row excluded)."""
    frame = account_window().rowsBetween(-n_lags, -1)
    return panel.withColumns({
        "roll_mean": F.avg("total_amount").over(frame),
        "roll_std": F.stddev_pop("total_amount").over(frame),
    })


def external_lags(panel: DataFrame, externals=EXTERNAL_KEYS) -> DataFrame:
    """Each external as a finite number, now and one row earlier (0 before the first row)."""
    w = account_window()
    now = panel.withColumns({f"{k}_t": C.finite_or_zero(F.col(k)) for k in externals})
    return now.withColumns({
        f"{k}_t1": F.coalesce(F.lag(f"{k}_t", 1).over(w), F.lit(0.0)) for k in externals
    })


def direction_labels(panel: DataFrame, threshold: float = 0.05) -> DataFrame:
    """-1 / 0 / 1 by relative change to the previous row; the first row is 0."""
    previous = F.lag("total_amount", 1).over(account_window())
    change = (F.col("total_amount") - previous) / (F.abs(previous) + 1e-8)
    label = F.when(change > threshold, 1).when(change < -threshold, -1).otherwise(0)
    return panel.withColumn("label", label)


def account_rules(policy: DataFrame) -> DataFrame:
    """Per-account flags, model key and external list of a policy (text lists are split)."""
    keys = F.lit(None).cast("array<string>")
    if "externals_for_model" in policy.columns:
        keys = F.col("externals_for_model")
        if dict(policy.dtypes)["externals_for_model"] == "string":
            keys = C.split_keys(keys)
    return policy.select(
        "account_id", "use_externals_regression", "use_externals_classification",
        "regression_model", keys.alias("external_keys"),
    )


def _defaults() -> dict[str, Column]:
    """What an account without a policy row gets: no externals, the default model."""
    return {
        "use_externals_regression": F.coalesce("use_externals_regression", F.lit(False)),
        "use_externals_classification": F.coalesce("use_externals_classification", F.lit(False)),
        "regression_model": C.model_key(F.col("regression_model")),
        "external_keys": F.coalesce("external_keys", F.array().cast("array<string>")),
    }


def policy_to_series(panel: DataFrame, policy: DataFrame) -> DataFrame:
    """Attach the policy to the panel rows."""
    return panel.join(account_rules(policy), "account_id", "left").withColumns(_defaults())


def model_route(policy: DataFrame) -> DataFrame:
    """Model key as recorded, and the trainer family that serves it."""
    key = C.model_key(F.col("regression_model"))
    return policy.withColumn("model_name", key).withColumn(
        "model_family", C.model_family(F.col("model_name"))
    )


def _positions(use: Column, externals) -> Column:
    """Where the account's externals stand in the array of all (now, row before) pairs.

    They come in list order; unknown keys are skipped, and an empty list means every external.
    """
    known = F.array(*(F.lit(k) for k in externals))
    every = F.array(*(F.lit(i) for i in range(2 * len(externals))))
    named = F.flatten(F.transform(
        F.filter("external_keys", lambda k: F.array_contains(known, k)),
        lambda k: F.transform(
            F.array(F.lit(2), F.lit(1)),
            lambda back: (F.array_position(known, k) * 2 - back).cast("int"),
        ),
    ))
    chosen = F.when(F.size("external_keys") == 0, every).otherwise(named)
    return F.when(use, chosen).otherwise(F.array().cast("array<int>"))


def external_rules(policy: DataFrame, externals) -> DataFrame:
    """One row per account: feature modes and positions, worked out before the panel join."""
    def mode(flag: Column) -> Column:
        return F.when(flag, "with_externals").otherwise("baseline")

    reg, clf = F.col("use_externals_regression"), F.col("use_externals_classification")
    return account_rules(policy).withColumns(_defaults()).select(
        "account_id", "regression_model", mode(reg).alias("mode_reg"), mode(clf).alias("mode_clf"),
        _positions(reg, externals).alias("_reg"), _positions(clf, externals).alias("_clf"),
    )


def base_vector(n_lags: int = N_LAGS, period: int = 52) -> Column:
    """Oldest lag first, then mean, deviation, sine and cosine of the phase."""
    angle = F.col("phase") * F.lit(2.0 * math.pi / period)
    lags = [F.col(f"back_{k}") for k in range(n_lags, 0, -1)]
    return F.array(*lags, F.col("roll_mean"), F.col("roll_std"), F.sin(angle), F.cos(angle))


def external_pairs(externals) -> Column:
    """(now, one row earlier) of every external, in fixed order."""
    pairs = [F.col(f"{k}_{lag}") for k in externals for lag in ("t", "t1")]
    return F.array(*pairs) if pairs else F.array().cast("array<double>")


def ml_matrix(
    features: DataFrame, policy: DataFrame, n_lags: int = N_LAGS, threshold: float = 0.05,
    newest: bool = False,
) -> DataFrame:
    """Rows (account_id, week, t, pos, n_rows, y, label, x_reg, x_clf, x_pooled) for t >= n_lags.

    ``x_reg`` and ``x_clf`` hold the base vector plus the externals the policy allows for the task;
    ``x_pooled`` is ``x_reg`` at equal width, 0 where the account may not use an external, for models
    over many accounts. One shuffle by account serves all windows, and the policy joins on the same
    partitioning after them, so that its arrays go through no sort. ``newest`` keeps each account's
    last row only: the rows that its lags reach are kept before the lags are taken.
    """
    externals = [k for k in EXTERNAL_KEYS if k in features.columns]
    panel = features.select("account_id", "week", "sector", "total_amount", *externals)
    n = F.count(F.lit(1)).over(Window.partitionBy("account_id"))
    indexed = series_index(panel).withColumn("n_rows", n - n_lags)
    if newest:
        indexed = indexed.where(F.col("t") >= F.col("n_rows") - 1)
    wide = direction_labels(
        external_lags(lag_moments(lag_columns(indexed, n_lags), n_lags), externals), threshold
    )
    first = F.col("n_rows") + n_lags - 1 if newest else F.lit(n_lags)
    rows = wide.where((F.col("t") >= n_lags) & (F.col("t") >= first)).select(
        "account_id", "week", "t", (F.col("t") - n_lags).alias("pos"), "n_rows",
        F.col("total_amount").alias("y"), "label",
        base_vector(n_lags).alias("_base"), external_pairs(externals).alias("_pairs"),
    )
    none = F.array().cast("array<int>")
    ruled = rows.join(external_rules(policy, externals), "account_id", "left").withColumns({
        "regression_model": F.coalesce("regression_model", F.lit(C.DEFAULT_REGRESSION_MODEL)),
        "mode_reg": F.coalesce("mode_reg", F.lit("baseline")),
        "mode_clf": F.coalesce("mode_clf", F.lit("baseline")),
        "_reg": F.coalesce("_reg", none),
        "_clf": F.coalesce("_clf", none),
    })

    def chosen(positions: str) -> Column:
        return F.transform(positions, lambda i: F.get("_pairs", i))

    masked = F.transform(
        "_pairs", lambda v, i: F.when(F.array_contains("_reg", i), v).otherwise(0.0)
    )
    return ruled.select(
        "account_id", "week", "t", "pos", "n_rows", "y", "label", "regression_model",
        "mode_reg", "mode_clf",
        F.concat("_base", chosen("_reg")).alias("x_reg"),
        F.concat("_base", chosen("_clf")).alias("x_clf"),
        F.concat("_base", masked).alias("x_pooled"),
    )


def walk_forward_folds(
    matrix: DataFrame, n_splits: int = 3, test_size: int = 4, min_train: int = 10, min_rows: int = 14
) -> DataFrame:
    """Rows tagged (fold, role): fold s tests the s-th last block, trains on all before it.

    Each row appears in at most ``n_splits`` folds; nothing is shuffled.
    """
    start = F.col("n_rows") - (F.col("fold") + 1) * test_size
    return (
        matrix.where(F.col("n_rows") >= min_rows)
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
        .where((start >= min_train) & (F.col("pos") < start + test_size))
        .withColumn("role", F.when(F.col("pos") < start, "train").otherwise("test"))
    )
