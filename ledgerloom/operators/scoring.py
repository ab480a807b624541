"""Evaluation, training report and batch scoring of stored runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import CLASSIFICATION_MODEL, model_family
from ledgerloom.operators.calendar import calendar_join
from ledgerloom.operators.macro import macro_lag_join
from ledgerloom.operators.matrix import ml_matrix, walk_forward_folds
from ledgerloom.operators.metrics import clf_metrics, fold_mean, reg_metrics
from ledgerloom.operators.models import (
    POOLED_FITS, fit_logistic, fit_ridge, fold_predictions, pooled_fold_predictions, routed,
)
from ledgerloom.operators.store import Run, score
from ledgerloom.operators.weekly import latest_week
from ledgerloom.schemas import CALENDAR_FLAGS, MACRO_KEYS
from ledgerloom.sources.io import written

ACCOUNT_FOLD = ["account_id", "fold"]


def ridge_predictions(folds: DataFrame, models: DataFrame) -> DataFrame:
    """Ridge forecasts of each fold's test rows, and of the newest block by each fold's model."""
    newest = folds.where(F.col("fold") == 0).drop("fold", "role")
    own = fold_predictions(folds, models, "regression").withColumn("block", F.lit("test"))
    last = fold_predictions(newest, models, "regression", last_block=True).withColumn(
        "block", F.lit("last")
    )
    return own.unionByName(last).drop("label").withColumn("model_name", F.lit("ridge"))


def evaluate_regression(predictions: DataFrame) -> DataFrame:
    """Fold means of RMSE, MAE, MAPE and R2 per account and model, plus ``mape_ref``.

    ``mape_ref`` scores the newest block with the model of the oldest training window, as the
    reference report does; that block lies outside the fold's own test rows.
    """
    per_fold = reg_metrics(predictions, ["account_id", "model_name", "fold", "block"])
    keys = ["account_id", "model_name"]
    means = fold_mean(
        per_fold.where(F.col("block") == "test"), keys, ["rmse", "mae", "mape", "r2"]
    )
    oldest = per_fold.where(F.col("block") == "last").groupBy(*keys).agg(
        F.max_by("mape", "fold").alias("mape_ref")
    )
    return means.join(oldest, keys, "left")


def evaluate_classification(predictions: DataFrame) -> DataFrame:
    """Fold means of accuracy and F1 per account; predictions hold account_id, fold, label, predicted."""
    per_fold = clf_metrics(predictions, ACCOUNT_FOLD)
    return fold_mean(per_fold, ["account_id"], ["accuracy", "f1_macro", "f1_weighted"])


def evaluate(regression: DataFrame, classification: DataFrame) -> DataFrame:
    """One row per account and task: fold means of the metrics of its own family, and its classifier's."""
    reg = evaluate_regression(regression).select(
        "account_id", F.lit("regression").alias("task"), "model_name", "rmse", "mae", "mape", "mape_ref", "r2", "n_folds"
    )
    clf = evaluate_classification(classification).select(
        "account_id", F.lit("classification").alias("task"), F.lit(CLASSIFICATION_MODEL).alias("model_name"),
        "accuracy", "f1_macro", "f1_weighted", "n_folds",
    )
    return reg.unionByName(clf, allowMissingColumns=True)


def family_predictions(
    matrix: DataFrame, n_splits: int = 3, test_size: int = 4, parameters: dict[str, dict] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fold predictions of all accounts by their own family's models, and by their classifiers.

    Pass a stored matrix: every family reads it.
    """
    linear = routed(matrix, "ridge")
    ridge = written(fit_ridge(linear, n_splits, test_size), "ridge")
    regression = ridge_predictions(walk_forward_folds(linear, n_splits, test_size), ridge)
    for family in POOLED_FITS:
        pooled = pooled_fold_predictions(
            matrix, family, n_splits, test_size, **(parameters or {}).get(family, {})
        )
        regression = regression.unionByName(pooled.drop("cut"))
    logistic = written(fit_logistic(matrix, n_splits, test_size), "logistic")
    folds = walk_forward_folds(matrix, n_splits, test_size)
    return regression, fold_predictions(folds, logistic, "classification")


def naive_predictions(matrix: DataFrame, n_splits: int = 3, test_size: int = 4) -> tuple[DataFrame, DataFrame]:
    """The last value and the last label in every slot of family_predictions(): a model-free baseline."""
    before = Window.partitionBy("account_id").orderBy("pos")
    rows = naive_forecast(matrix).withColumns({
        "predicted": F.lag("label").over(before), "model_name": model_family(F.col("regression_model")),
    })
    tested = walk_forward_folds(rows, n_splits, test_size).where("role = 'test'")
    newest = rows.where(F.col("pos") >= F.col("n_rows") - test_size).join(
        tested.select("account_id", "fold").distinct(), "account_id"
    )
    columns = ["account_id", "fold", "pos", "y", "yhat", "model_name"]
    regression = tested.select(*columns, F.lit("test").alias("block")).unionByName(
        newest.select(*columns, F.lit("last").alias("block"))
    )
    return regression, tested.select("account_id", "fold", "pos", "label", "predicted")


def training_report(
    matrix: DataFrame,
    regression: DataFrame,
    classification: DataFrame,
    run_stamp: str,
    store: str | None = None,
    test_size: int = 4,
) -> DataFrame:
    """One row per account and task with its metrics, model name, run stamp and model reference.

    ``regression`` and ``classification`` are the fold predictions of all families, each for the
    accounts routed to it. ``n_test_obs`` counts the rows of the newest test block, ``n_train`` those
    that the final model is trained on.
    """
    newest = F.col("pos") >= F.col("n_rows") - test_size
    modes = matrix.groupBy("account_id").agg(
        F.min("mode_reg").alias("mode_reg"), F.min("mode_clf").alias("mode_clf"),
        F.max("n_rows").alias("n_train"), F.count_if(newest).alias("n_test_obs"),
    )
    ref = F.lit(None if store is None else f"{store}/run_stamp={run_stamp}").cast("string")
    mode = F.when(F.col("task") == "regression", F.col("mode_reg")).otherwise(F.col("mode_clf"))
    return evaluate(regression, classification).join(modes, "account_id").select(
        "account_id", "task", mode.alias("feature_mode"), "model_name", "rmse", "mae", "mape", "mape_ref", "r2",
        "accuracy", "f1_macro", "f1_weighted", "n_folds", "n_train", "n_test_obs",
        F.lit(run_stamp).alias("run_stamp"), ref.alias("model_ref"),
    )


# --- runs -------------------------------------------------------------------------------------------

def latest_run(runs: DataFrame) -> DataFrame:
    """Rows of the greatest run stamp (stamps sort as text). The stamp side is one row."""
    newest = runs.agg(F.max("run_stamp").alias("run_stamp"))
    return runs.join(F.broadcast(newest), "run_stamp", "left_semi")


def save_rows(rows: DataFrame, path: str, run_stamp: str) -> None:
    """A run's report or predictions as partitions (run_stamp, task): saving again replaces them."""
    (
        rows.withColumn("run_stamp", F.lit(run_stamp))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_stamp", "task").parquet(path)
    )


def saved_rows(spark: SparkSession, path: str) -> DataFrame:
    """What save_rows() wrote, of all runs; stamps are text."""
    saved = spark.read.option("mergeSchema", True).parquet(path)
    return saved.withColumn("run_stamp", F.col("run_stamp").cast("string"))


# --- scoring ------------------------------------------------------------------------------------------

def next_week_rows(features: DataFrame, calendar: DataFrame, macro: DataFrame) -> DataFrame:
    """One future row per account: the week after its last, amount unknown, externals known ahead."""
    last = latest_week(features.select("account_id", "week", "sector"))
    future = last.withColumn("week", F.date_add("week", 7))
    return macro_lag_join(calendar_join(future, calendar), macro)


def with_next_week(features: DataFrame, calendar: DataFrame, macro: DataFrame) -> DataFrame:
    """Features plus the future row, for scoring one week ahead."""
    columns = ["account_id", "week", "sector", *CALENDAR_FLAGS, *MACRO_KEYS]
    return features.unionByName(
        next_week_rows(features, calendar, macro).select(*columns), allowMissingColumns=True
    )


def batch_score(
    features: DataFrame,
    policy: DataFrame,
    run: Run,
    mode: str = "replay",
    calendar: DataFrame | None = None,
    macro: DataFrame | None = None,
) -> DataFrame:
    """Newest row of each account through the models of a stored run, one PREDICTIONS row per task.

    ``replay`` scores the last observed week, whose amount is already known (reference behaviour).
    ``next`` adds the following week from ``calendar`` and ``macro`` and scores that one. Nothing is
    fitted. An account without a stored model gets no row, nor does one whose model was fitted under
    another feature mode than today's policy asks for.
    """
    if mode == "next":
        features = with_next_week(features, calendar, macro)
    elif mode != "replay":
        raise ValueError(f"unknown scoring mode {mode!r}")
    scored = score(ml_matrix(features, policy, newest=True), run)
    return scored.select(
        "account_id", F.col("week").alias("last_week"), "task", F.col("mode").alias("feature_mode"),
        "model_name", "prediction",
    )


def naive_forecast(panel: DataFrame) -> DataFrame:
    """Last-value forecast of each matrix row, for a model-free end-to-end check."""
    return panel.withColumn("yhat", F.element_at("x_reg", 4))
