"""Boosted trees from histograms: the trees of pyspark.ml, however rows are dealt."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from ledgerloom.operators import boosting as bo
from ledgerloom.operators import models as mo


def _rows(spark, n: int):
    """Wide and narrow features, flags, zeros, a constant one; some are functions of others."""
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((n, 8)), 3)
    x[:, 2] = np.where(rng.random(n) < 0.4, 0.0, x[:, 2])
    x[:, 3:5] = rng.random((n, 2)) < 0.1
    x[:, 5] = rng.integers(0, 60, n)
    x[:, 6], x[:, 7] = np.sin(x[:, 5]), 2.0
    y = 3 * x[:, 0] + x[:, 1] * x[:, 3] + x[:, 2] + x[:, 6] + rng.standard_normal(n)
    data = [(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(data, "id int, x array<double>, y double").repartition(5, "id").cache()


def _predicted(model, rows) -> np.ndarray:
    return np.array([r["yhat"] for r in mo.pooled_predictions(model, rows, "x").orderBy("id").collect()])


@pytest.mark.parametrize("n, part, kept", [(900, 9_000, 9), (900, 400, 3), (14_000, 5_000, 9)])
def test_boosted_trees_are_those_of_pyspark(spark, n, part, kept, monkeypatch):
    """Also where rows are several parts, are written on the way, or thresholds come from drawn rows."""
    monkeypatch.setattr(bo, "ROWS_A_PART", part)
    monkeypatch.setattr(bo, "ROUNDS_KEPT", kept)
    rows = _rows(spark, n)
    own = GBTRegressor(featuresCol="_features", labelCol="y", predictionCol="yhat", maxIter=8, stepSize=0.3, maxDepth=4, seed=42)
    (boosted, other), wanted = bo.grow_boosted([rows, rows.where("id % 3 > 0")], "x", own), own.fit(mo._vectors(rows, "x"))
    alone = bo.grow_boosted([rows.where("id % 3 > 0")], "x", own)[0]
    assert np.isclose(_predicted(other, rows), _predicted(alone, rows)).mean() > 0.95  # small nodes have equal splits
    assert type(boosted).__name__ == "GBTRegressionModel"
    assert _predicted(boosted, rows) == pytest.approx(_predicted(wanted, rows))
    assert boosted.featureImportances.toArray() == pytest.approx(wanted.featureImportances.toArray(), abs=1e-3)  # equal splits of two features
    assert boosted.treeWeights == wanted.treeWeights and boosted.getMaxDepth() == 4
    assert [t.depth for t in boosted.trees] == [t.depth for t in wanted.trees]


def test_rounds_of_few_rows_are_one_job(spark):
    """Jobs of a model of one part don't grow with its rounds: they were several a round."""
    context, rows, counts = spark.sparkContext, _rows(spark, 900), []
    for rounds in (2, 12):
        context.setJobGroup(f"boosted-{rounds}", "a model")
        own = GBTRegressor(featuresCol="_features", labelCol="y", predictionCol="yhat", maxIter=rounds, maxDepth=4, seed=42)
        bo.grow_boosted([rows], "x", own)
        counts.append(len(context.statusTracker().getJobIdsForGroup(f"boosted-{rounds}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert abs(counts[0] - counts[1]) < 4 and max(counts) < 25


def test_shared_codes_keep_every_bin():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 32, (5, 3000)).astype(np.uint8)
    bins[3:] = bins[0] // 16, bins[1] % 2
    y, cuts = rng.standard_normal(3000), np.array([31, 31, 31, 1, 1])
    node, path = 2 * (bins[0] > 7), [(np.array([True]), np.array([0]), np.array([7]))]
    node = node + np.where(bins[0] > 7, bins[3] > 0, False)
    path.append((np.array([False, True]), np.array([1, 3]), np.array([3, 0])))
    for parts in ([0, 3000], [0, 1200, 3000]):
        blocks = [(b, bins[:, a:b].tobytes(), y[a:b].tobytes()) for a, b in zip(parts, parts[1:], strict=False)]
        rows = bo._Rows(blocks[::-1], cuts, 32)
        assert rows.n == 3000 and len(rows.sizes) < 5
        count, total, squares = rows.sums(path)
        for f in range(5):
            for k in range(4):
                assert (count[f, k] == np.bincount(bins[f, node == k], minlength=32)).all()
                assert total[f, k] == pytest.approx(np.bincount(bins[f, node == k], y[node == k], 32))
        assert squares[0, :, 0] == pytest.approx(np.bincount(node, y * y, 4))
        less = rows.after(path, np.array([1.0, 2.0, 3.0, 4.0]), 0.5, 2.0)
        assert less.left == pytest.approx(2 * y - node - 1) and rows.left == pytest.approx(y)
        assert less.squares[0] == pytest.approx(squares[0, :, 0])


def test_rows_that_cannot_be_trained_on_are_an_error(spark):
    rows = spark.createDataFrame([([0.5], 1.0), ([1.0], None)], "x array<double>, y double")
    with pytest.raises(ValueError, match="1 of 2 rows"):
        bo.grow_boosted([rows], "x", GBTRegressor(labelCol="y"))
    with pytest.raises(ValueError, match="no rows"):
        bo.grow_boosted([rows.limit(0)], "x", GBTRegressor(labelCol="y"))


def test_sets_of_few_and_many_rows_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(mo, "ROWS_PER_TASK", 30)
    rows = spark.range(40).select(F.array(F.lit(2.0)).alias("x"), (F.lit(7.0) + (F.col("id") > 39).cast("int")).alias("y"), "id")
    sets = [rows, rows.where("id < 20").withColumn("y", F.lit(3.0)), rows.withColumn("y", F.lit(4.0))]
    models = mo.fit_boosted_sets(sets, "x", rounds=3)
    assert [set(_predicted(model, rows)) for model in models] == [{7.0}, {3.0}, {4.0}]
    assert mo.fit_boosted_sets([]) == []
