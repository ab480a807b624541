"""Versioned store of fitted models of every kind, committed by a manifest, and scoring from it.

A run is saved as one attempt in a folder of its own: a table of members (one row per account and
task, linear models' coefficients in it), a table of flattened trees, and the writers of the fitted
``pyspark.ml`` models. The manifest's rows are written last, in one file: they are the commit. Readers
start from the manifest, so an attempt that failed half-way is never seen, and saving a run stamp
again replaces the run as a whole.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import CLASSIFICATION_MODEL
from ledgerloom.operators.models import (
    FINAL_FOLD, POOLED_FITS, at_once, dot, fit_logistic, fit_ridge, routed,
)

REGRESSION, CLASSIFICATION = "regression", "classification"
MEMBERS = (
    "account_id string, task string, family string, mode string, n_train long, model_id string, "
    "classes array<int>, intercepts array<double>, coefs array<array<double>>"
)
TREES = (
    "model_id string, tree int, weight double, depth int, feature array<int>, threshold array<double>, "
    "left array<int>, right array<int>, value array<double>"
)
MANIFEST = (
    "run_stamp string, attempt int, task string, family string, kind string, models long, accounts long, path string"
)
_NO_COEFFICIENTS = (
    "cast(null as array<int>) as classes", "cast(null as array<double>) as intercepts",
    "cast(null as array<array<double>>) as coefs",
)


# --- fitting every family once ------------------------------------------------------------------------

def linear_members(models: DataFrame, task: str, family: str) -> DataFrame:
    """MEMBERS of the final fits among ridge or logistic rows; each account is its own model."""
    final = models.where(F.col("fold") == FINAL_FOLD)
    if task == REGRESSION:
        final = final.withColumns({
            "classes": F.lit(None).cast("array<int>"), "intercepts": F.array("intercept"),
            "coefs": F.array("coef"),
        })
    return final.select(
        "account_id", F.lit(task).alias("task"), F.lit(family).alias("family"), "mode",
        F.col("n_train").cast("long").alias("n_train"), F.col("account_id").alias("model_id"),
        "classes", "intercepts", "coefs",
    )


def pooled_members(rows: DataFrame, family: str) -> DataFrame:
    """MEMBERS of the accounts that share one model, by their matrix rows."""
    accounts = rows.groupBy("account_id").agg(
        F.min("mode_reg").alias("mode"), F.count(F.lit(1)).alias("n_train")
    )
    return accounts.select(
        "account_id", F.lit(REGRESSION).alias("task"), F.lit(family).alias("family"), "mode", "n_train",
        F.lit(family).alias("model_id"), *(F.expr(e) for e in _NO_COEFFICIENTS),
    )


def fit_final(
    matrix: DataFrame, min_rows: int = 14, parameters: dict[str, dict] | None = None
) -> tuple[DataFrame, dict]:
    """The final models of every account with an evaluable fold: (MEMBERS, fitted ensembles by family).

    One regression model of the family that the account's policy names, trained on all its rows (on
    all rows of all the family's accounts for forests and boosted trees), and a logistic classifier
    where the longest training set before a test block holds two classes. The matrix is read once
    per family: pass a stored one. ``parameters`` are those of the families' fits.
    """
    rows = matrix.where(F.col("n_rows") >= min_rows)
    members = [
        linear_members(fit_ridge(routed(rows, "ridge"), n_splits=0, min_rows=min_rows), REGRESSION, "ridge"),
        linear_members(fit_logistic(rows, n_splits=0, min_rows=min_rows), CLASSIFICATION, CLASSIFICATION_MODEL),
    ]
    def fitted(family: str):
        own = routed(rows, family)
        return None if own.isEmpty() else POOLED_FITS[family](own, **(parameters or {}).get(family, {}))

    models = at_once(matrix.sparkSession, fitted, list(POOLED_FITS))
    ensembles = {family: m for family, m in zip(POOLED_FITS, models, strict=True) if m is not None}
    members += [pooled_members(routed(rows, family), family) for family in ensembles]
    return reduce(DataFrame.unionByName, members), ensembles


# --- trees as tables --------------------------------------------------------------------------------------

def flattened(spark: SparkSession, path: str, model_id: str, model) -> DataFrame:
    """TREES of an ensemble saved at ``path``: one row per tree, its nodes as arrays by node number.

    Leaves have children -1. A forest's prediction is the mean of its trees, that of boosted trees
    their weighted sum. A tree's nodes are bounded by its depth, which is a parameter of the fit.
    """
    share = 1.0 / len(model.treeWeights) if isinstance(model, RandomForestRegressionModel) else 1.0
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    row = F.struct(
        "id", F.col("split.featureIndex").alias("feature"),
        F.coalesce(F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)), F.lit(0.0)).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("prediction").alias("value"),
    )
    arrays = ("feature", "threshold", "left", "right", "value")
    trees = nodes.groupBy(F.col("treeID").alias("tree")).agg(F.array_sort(F.collect_list(row)).alias("_nodes"))
    weights = spark.read.parquet(f"{path}/treesMetadata").select(
        F.col("_1").alias("tree"), F.col("_3").alias("weight")
    )
    return trees.join(weights, "tree").select(
        F.lit(model_id).alias("model_id"), "tree", (F.col("weight") * share).alias("weight"),
        F.lit(model.getMaxDepth()).alias("depth"), *(F.col(f"_nodes.{a}").alias(a) for a in arrays),
    )


def tree_value(tree: Column, x: Column) -> Column:
    """The leaf value of ``x``: from the root, left where the feature is at most the threshold."""
    def step(node: Column, _: Column) -> Column:
        leaf = F.get(tree["left"], node) < 0
        left = F.get(x, F.get(tree["feature"], node)) <= F.get(tree["threshold"], node)
        child = F.when(left, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
        return F.when(leaf, node).otherwise(child)

    levels = F.sequence(F.lit(0), tree["depth"])
    return F.get(tree["value"], F.aggregate(levels, F.lit(0), step))


def ensemble_prediction(trees: Column, x: Column) -> Column:
    """Weighted sum of the trees' values, without leaving the JVM."""
    return F.aggregate(
        trees, F.lit(0.0), lambda total, tree: total + tree["weight"] * tree_value(tree, x)
    )


# --- saving -----------------------------------------------------------------------------------------------

def manifest(spark: SparkSession, store: str) -> DataFrame:
    """MANIFEST rows of each run stamp's newest committed attempt; none where nothing was committed."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{store}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    newest = rows.groupBy("run_stamp").agg(F.max(F.struct("attempt", "path")).alias("_newest")).select(
        "run_stamp", "_newest.*"
    )
    return rows.join(newest, ["run_stamp", "attempt", "path"], "left_semi")


def _next_attempt(spark: SparkSession, store: str, run_stamp: str) -> int:
    held = manifest(spark, store).where(F.col("run_stamp") == run_stamp)
    return (held.agg(F.max("attempt").alias("n")).first()["n"] or 0) + 1


def save_run(
    members: DataFrame, ensembles: dict, store: str, run_stamp: str, commit: bool = True
) -> DataFrame:
    """Save one run and return its manifest rows.

    ``ensembles`` holds, by family, a fitted forest or boosted model, which is kept by its own writer
    and as flattened trees, or a TREES table. An account that occurs twice in a task is an error, and
    nothing is committed then. ``commit=False`` leaves the attempt uncommitted, as a failure would.
    """
    spark = members.sparkSession
    attempt = _next_attempt(spark, store, run_stamp)
    path = f"{store}/run_stamp={run_stamp}/attempt={attempt}-{uuid.uuid4().hex}"
    members.write.partitionBy("task").parquet(f"{path}/members")
    for family, model in ensembles.items():
        if not isinstance(model, DataFrame):
            own = f"{path}/ml/{family}"
            model.write().save(own)
            model = flattened(spark, own, family, model)
        model.write.mode("append").parquet(f"{path}/trees")
    counted = _members(spark, path).groupBy("task", "family").agg(
        F.count_distinct("model_id").alias("models"), F.count(F.lit(1)).alias("accounts"),
        F.count_distinct("account_id").alias("_distinct"),
    )
    once = F.when(F.col("accounts") == F.col("_distinct"), F.col("accounts")).otherwise(
        F.raise_error(F.lit(f"run {run_stamp}: an account occurs twice in a task")).cast("long")
    )
    rows = counted.select(
        F.lit(run_stamp).alias("run_stamp"), F.lit(attempt).alias("attempt"), "task", "family",
        F.when(F.col("family").isin(*ensembles), "trees").otherwise("linear").alias("kind"),
        "models", once.alias("accounts"), F.lit(path).alias("path"),
    )
    if commit:
        rows.coalesce(1).write.mode("append").parquet(f"{store}/manifest")
    return rows


def train(matrix: DataFrame, store: str, run_stamp: str, **how) -> DataFrame:
    """Fit every family's final models, save them as one run and return its manifest rows."""
    members, ensembles = fit_final(matrix, **how)
    return save_run(members, ensembles, store, run_stamp)


# --- loading ----------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Run:
    """A committed run: its stamp, folder, members and flattened trees."""

    run_stamp: str
    path: str
    members: DataFrame
    trees: DataFrame

    def ensemble(self, family: str):
        """The fitted ``pyspark.ml`` model of a pooled family, by its own reader."""
        reader = {"rf": RandomForestRegressionModel, "lgbm": GBTRegressionModel}[family]
        return reader.load(f"{self.path}/ml/{family}")


def _members(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MEMBERS).parquet(f"{path}/members")


def load_run(spark: SparkSession, store: str, run_stamp: str | None = None) -> Run:
    """The run of a stamp, by default of the greatest committed one (stamps sort as text)."""
    rows = manifest(spark, store)
    if run_stamp is not None:
        rows = rows.where(F.col("run_stamp") == run_stamp)
    newest = rows.groupBy("run_stamp", "path").agg(
        F.max((F.col("kind") == "trees").cast("int")).alias("trees")
    ).orderBy(F.desc("run_stamp")).first()
    if newest is None:
        raise FileNotFoundError(f"no committed run in {store}")
    path = newest["path"]
    trees = (
        spark.read.schema(TREES).parquet(f"{path}/trees") if newest["trees"]
        else spark.createDataFrame([], TREES)
    )
    return Run(newest["run_stamp"], path, _members(spark, path), trees)


# --- scoring ----------------------------------------------------------------------------------------------

def score(newest: DataFrame, run: Run) -> DataFrame:
    """Matrix rows through the stored models: (account_id, week, task, mode, model_name, prediction).

    One join by account finds an account's models of both tasks; the trees, a few models of bounded
    size, are broadcast. A model that was fitted under another feature mode than the row's policy
    asks for does not match, and an account without a model gives no row.
    """
    def task(name: str, mode: str, x: str, model: Column) -> Column:
        return F.struct(
            F.lit(name).alias("task"), F.col(mode).alias("mode"), F.col(x).alias("x"), model.alias("model_name")
        )

    wanted = newest.select("account_id", "week", "x_pooled", F.inline(F.array(
        task(REGRESSION, "mode_reg", "x_reg", F.col("regression_model")),
        task(CLASSIFICATION, "mode_clf", "x_clf", F.lit(CLASSIFICATION_MODEL)),
    )))
    grown = run.trees.groupBy("model_id").agg(F.collect_list(F.struct(
        "weight", "depth", "feature", "threshold", "left", "right", "value"
    )).alias("trees"))
    found = wanted.join(run.members.drop("family", "n_train"), ["account_id", "task", "mode"]).join(
        F.broadcast(grown), "model_id", "left"
    )
    values = F.zip_with(
        F.transform("coefs", lambda c: dot(c, F.col("x"))), F.col("intercepts"), lambda s, b: s + b
    )
    best = F.element_at("classes", F.array_position("_values", F.array_max("_values")).cast("int"))
    prediction = (
        F.when(F.col("coefs").isNull(), ensemble_prediction(F.col("trees"), F.col("x_pooled")))
        .when(F.col("classes").isNull(), F.get("_values", F.lit(0)))
        .otherwise(best.cast("double"))
    )
    return found.withColumn("_values", values).select(
        "account_id", "week", "task", "mode", "model_name", prediction.alias("prediction")
    )
