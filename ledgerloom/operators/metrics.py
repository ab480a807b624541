"""Forecast and classification metrics as grouped aggregates over (truth, prediction) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import ratio


def reg_metrics(pred: DataFrame, keys: list[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """RMSE, MAE, MAPE (only where |y| > 1; NULL if nowhere) and R2 (0 for a constant truth)."""
    t, p = F.col(y), F.col(yhat)
    err = t - p
    total = F.var_pop(t) * F.count(t)
    return pred.groupBy(*keys).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.when(F.abs(t) > 1.0, F.abs(ratio(err, t)))) * 100).alias("mape"),
        F.when(total <= 0, 0.0).otherwise(1.0 - ratio(F.sum(err * err), total)).alias("r2"),
        F.count(t).alias("n_obs"),
    )


def clf_metrics(pred: DataFrame, keys: list[str], y: str = "label", yhat: str = "predicted"):
    """Accuracy, macro and weighted F1 from the confusion counts.

    Classes are those seen as truth or prediction; a class without either kind scores 0.
    """
    confusion = pred.groupBy(*keys, F.col(y).alias("_y"), F.col(yhat).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    hit = F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("_y").alias("cls"), F.col("_n").alias("truth"), F.lit(0).alias("said"),
                 hit.alias("hit")),
        F.struct(F.col("_p").alias("cls"), F.lit(0).alias("truth"), F.col("_n").alias("said"),
                 F.lit(0).alias("hit")),
    )
    per_class = (
        confusion.select(*keys, F.inline(sides))
        .groupBy(*keys, "cls")
        .agg(*(F.sum(c).alias(c) for c in ("truth", "said", "hit")))
        .withColumn("f1", ratio(2.0 * F.col("hit"), F.col("truth") + F.col("said")))
    )
    return per_class.groupBy(*keys).agg(
        ratio(F.sum("hit"), F.sum("truth")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        ratio(F.sum(F.col("truth") * F.col("f1")), F.sum("truth")).alias("f1_weighted"),
        F.sum("truth").alias("n_obs"),
    )


def fold_mean(metrics: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Mean of each metric over the folds."""
    return metrics.groupBy(*keys).agg(
        *(F.avg(m).alias(m) for m in names), F.count(F.lit(1)).alias("n_folds")
    )
