"""Forests from histograms: models that fit like those of pyspark.ml."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from ledgerloom.operators import models as mo
from ledgerloom.operators import trees as tr


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((900, 5)), 2)
    x[:, 3] = rng.random(900) < 0.1
    y = 3 * x[:, 0] + x[:, 1] * x[:, 3] + rng.standard_normal(900)
    data = [(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(data, "id int, x array<double>, y double").repartition(6).cache()


def _predicted(model, rows) -> np.ndarray:
    return np.array([r["yhat"] for r in mo.pooled_predictions(model, rows, "x").orderBy("id").collect()])


def test_a_tree_of_all_features_is_that_of_pyspark(rows, monkeypatch):
    """With every row drawn once, the splits are the exact ones of its decision tree."""
    from pyspark.ml.regression import DecisionTreeRegressor

    whole = tr._grown
    monkeypatch.setattr(tr, "_grown", lambda *how: whole(*how[:-1], None))
    own = RandomForestRegressor(featuresCol="_features", labelCol="y", predictionCol="yhat", numTrees=1, maxDepth=5, seed=42)
    wanted = DecisionTreeRegressor(featuresCol="_features", labelCol="y", predictionCol="yhat", maxDepth=5, seed=42)
    wanted = wanted.fit(mo._vectors(rows, "x"))
    assert _predicted(tr.grow_forest(rows, "x", own), rows) == pytest.approx(_predicted(wanted, rows))


def test_a_forest_has_its_trees_and_fits_like_pyspark(rows):
    model = mo.fit_forest(rows, "x", trees=30)
    y = np.array([r["y"] for r in rows.orderBy("id").collect()])
    error = np.mean((_predicted(model, rows) - y) ** 2)
    wanted = RandomForestRegressor(featuresCol="_features", labelCol="y", predictionCol="yhat", numTrees=30, maxDepth=5, seed=42)
    assert error == pytest.approx(np.mean((_predicted(wanted.fit(mo._vectors(rows, "x")), rows) - y) ** 2), rel=0.15)
    assert model.getNumTrees == 30 and max(t.depth for t in model.trees) == 5
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) == 30
    again = mo.fit_forest(rows, "x", trees=30)
    assert _predicted(again, rows) == pytest.approx(_predicted(model, rows))


def test_sums_of_blocks_add_up():
    """Rows in two blocks give the sums of one, and weights are those of the draws."""
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, 8, (4, 500)).astype(np.uint8), rng.standard_normal(500)
    trees = tr.Trees(np.zeros((1, 7), int), np.full((1, 7), 3), np.array([[1, 2, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6]]),
                     np.zeros((1, 7)), np.zeros((1, 7, 3)))
    subsets = np.array([[[0, 2], [1, 3]]])
    how = (trees, 1, subsets, np.ones((1, 2), bool), 32, None, True)
    whole = dict(tr._sums(iter([(0, bins, y)]), *how))[0]
    parts = dict(tr._sums(iter([(0, bins[:, :200], y[:200]), (1, bins[:, 200:], y[200:])]), *how))[0]
    assert parts == pytest.approx(whole)
    left = bins[0] <= 3
    for j, (a, b) in enumerate(((0, 1), (2, 3))):
        assert whole[1, j, 0, :8] == pytest.approx(np.bincount(bins[a, left], y[left], 8))
        assert whole[2, j, 1, :8] == pytest.approx(np.bincount(bins[b, ~left], y[~left] ** 2, 8))


def test_draws_follow_poisson():
    assert len(tr._DRAWN) == 65536
    shares = np.bincount(tr._DRAWN, minlength=9) / 65536
    assert shares[:4] == pytest.approx([0.36788, 0.36788, 0.18394, 0.06131], abs=2e-5)
    assert tr._DRAWN.mean() == pytest.approx(1.0, abs=1e-4)


@pytest.mark.parametrize("y, x", [(None, [1.0]), (float("nan"), [1.0]), (1.0, [float("nan")]), (1.0, [None])])
def test_rows_that_cannot_be_trained_on_are_an_error(spark, y, x):
    rows = spark.createDataFrame([([0.5], 1.0), (x, y)], "x array<double>, y double")
    with pytest.raises(ValueError, match="1 of 2 rows"):
        mo.fit_forest(rows, "x")


def test_rows_without_difference_make_leaves(spark):
    rows = spark.range(40).select(F.array(F.lit(2.0)).alias("x"), F.lit(7.0).alias("y"), "id")
    assert set(_predicted(mo.fit_forest(rows, "x", trees=3), rows)) == {7.0}
