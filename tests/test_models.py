"""Fits against first-order conditions and closed forms."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import experiments as ex
from ledgerloom.operators import models as mo


def data(n=60, p=5, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * [1, 10, 100, 1, 0.1] + 5
    return x, x @ [1, 0.2, 0.01, 0, 3] + rng.normal(size=n), rng


def test_ridge_is_the_penalised_minimum():
    x, y, _ = data()
    alpha, intercept, coef = mo.ridge_fit(x, y)
    z = (x - x.mean(0)) / x.std(0)
    w = coef * x.std(0)
    residual = y - intercept - x @ coef
    assert alpha in mo.RIDGE_ALPHAS
    assert np.abs(residual.sum()) < 1e-8
    assert np.abs(z.T @ residual - alpha * w).max() < 1e-8


def test_ridge_penalty_is_chosen_on_contiguous_folds():
    x, y, _ = data(n=31, seed=3)
    z = (x - x.mean(0)) / x.std(0)
    bounds = [(0, 11), (11, 21), (21, 31)]
    scores = []
    for a in mo.RIDGE_ALPHAS:
        total = 0
        for lo, hi in bounds:
            train = np.r_[0:lo, hi:31]
            zt, yt = z[train] - z[train].mean(0), y[train] - y[train].mean()
            w = np.linalg.solve(zt.T @ zt + a * np.eye(5), zt.T @ yt)
            pred = (z[lo:hi] - z[train].mean(0)) @ w + y[train].mean()
            total += 1 - ((y[lo:hi] - pred) ** 2).sum() / ((y[lo:hi] - y[lo:hi].mean()) ** 2).sum()
        scores.append(total)
    assert mo.ridge_fit(x, y)[0] == mo.RIDGE_ALPHAS[int(np.argmax(scores))]


def test_ridge_keeps_constant_columns_out():
    x, y, _ = data()
    x[:, 3] = 7.0
    _, intercept, coef = mo.ridge_fit(x, y)
    assert np.isfinite(coef).all() and abs(coef[3]) < 1e-9 and math.isfinite(intercept)


@pytest.mark.parametrize("k", [2, 3])
def test_logistic_gradient_vanishes(k):
    x, _, rng = data(n=80)
    labels = rng.integers(0, k, size=80) - 1
    classes, intercepts, coefs = mo.logistic_fit(x, labels)
    assert list(classes) == list(range(-1, k - 1)) and coefs.shape == (k, 5)
    z = (x - x.mean(0)) / x.std(0)
    score = x @ coefs.T + intercepts
    prob = np.exp(score - score.max(1, keepdims=True))
    prob /= prob.sum(1, keepdims=True)
    truth = (labels[:, None] == classes).astype(float)
    w = coefs * x.std(0)
    rows = slice(1, 2) if k == 2 else slice(None)
    gradient = ((prob - truth).T @ z + w)[rows]
    assert np.abs(gradient).max() < 1e-5 and np.abs((prob - truth).sum(0)).max() < 1e-5


def test_logistic_separable_classes_stay_finite():
    x = np.linspace(-1, 1, 40)[:, None]
    classes, intercepts, coefs = mo.logistic_fit(x, (x[:, 0] > 0).astype(int))
    assert np.isfinite(coefs).all() and coefs[1, 0] > 0


def test_scores_in_the_jvm_equal_numpy(spark):
    x, y, rng = data()
    labels = rng.integers(-1, 2, size=60)
    alpha, intercept, coef = mo.ridge_fit(x, y)
    classes, intercepts, coefs = mo.logistic_fit(x, labels)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, x array<double>")
    model = rows.withColumns({
        "intercept": F.lit(intercept), "coef": F.array(*map(F.lit, coef.tolist())),
        "classes": F.array(*map(F.lit, [int(c) for c in classes])),
        "intercepts": F.array(*map(F.lit, intercepts.tolist())),
        "coefs": F.array(*(F.array(*map(F.lit, c.tolist())) for c in coefs)),
    })
    got = model.select("i", mo.linear_prediction(F.col("x")).alias("p"),
                       mo.class_prediction(F.col("x")).alias("c")).orderBy("i").collect()
    assert [r.p for r in got] == pytest.approx((x @ coef + intercept).tolist())
    assert [r.c for r in got] == [int(classes[j]) for j in np.argmax(x @ coefs.T + intercepts, axis=1)]


@pytest.mark.parametrize("r, n, p", [(0.5, 12, 0.0978), (0.3, 100, 0.002428), (0.0, 50, 1.0), (0.8783, 5, 0.05), (0.3, 4, 0.7)])
def test_correlation_p_value(r, n, p):
    assert ex.student_two_sided(np.array([r]), np.array([n]))[0] == pytest.approx(p, abs=2e-4)


def test_p_value_undefined_is_not_significant(spark):
    df = spark.createDataFrame([("a", "oil", 0, None, 5), ("b", "oil", 0, 0.9, 50)],
                               "account_id string, external string, lag int, r double, n_pairs bigint")
    got = {r.account_id: r.keep for r in ex.select_by_correlation(df).collect()}
    assert got == {"a": False, "b": True}


def test_pooled_models_beat_the_mean(spark):
    x, y, _ = data(n=300)
    rows = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "x array<double>, y double")
    for model in (mo.fit_forest(rows, "x", trees=20), mo.fit_boosted(rows, "x", rounds=10, rate=0.3)):
        error = mo.pooled_predictions(model, rows, "x").agg(F.avg((F.col("y") - F.col("yhat")) ** 2)).first()[0]
        assert error < np.var(y)


def test_classifier_needs_an_evaluable_fold(spark):
    """The second class of "late" first comes in the newest block, so no fold could be evaluated."""
    rows = [
        (k, i, "baseline", [float(i), float(i % 3)], label(i), 24)
        for k, label in (("late", lambda i: int(i >= 21)), ("fit", lambda i: i % 2)) for i in range(24)
    ]
    matrix = spark.createDataFrame(
        rows, "account_id string, pos int, mode_clf string, x_clf array<double>, label int, n_rows long")
    for n_splits in (0, 3):
        models = mo.fit_logistic(matrix, n_splits).collect()
        assert {m["account_id"] for m in models} == {"fit"}
        assert len(models) == n_splits + 1


def test_ridge_from_moments_equals_ridge_on_rows(spark):
    """Every fold and the final fit, rows shuffled over many batches, widths that differ by account."""
    rng = np.random.default_rng(5)
    rows, wanted = [], {}
    for name, n, p in (("a", 14, 4), ("b", 57, 9), ("c", 302, 26), ("d", 40, 4), ("short", 13, 4)):
        x = rng.normal(size=(n, p)) * rng.choice([1e4, 1.0, 0.01], p) + rng.choice([1e5, 0.0, 3.0], p)
        x[:, 1] = 0.1  # a constant
        x[:, 2] = (rng.random(n) < 0.2) * 1.0
        y = x @ rng.normal(size=p) + 1e3 * rng.normal(size=n)
        rows += [(name, i, n, "baseline", x[i].tolist(), float(y[i])) for i in range(n)]
        for fold, end in mo._train_ends(n, 3, 4, 10) if n >= 14 else []:
            wanted[name, fold] = (end, *mo.ridge_fit(x[:end], y[:end]))
    order = rng.permutation(len(rows))
    matrix = spark.createDataFrame(
        [rows[i] for i in order], "account_id string, pos int, n_rows long, mode_reg string, x_reg array<double>, y double")
    got = mo.fit_ridge(matrix.repartition(9)).collect()
    assert len(got) == len(wanted)
    for r in got:
        end, alpha, intercept, coef = wanted[r.account_id, r.fold]
        assert (r.n_train, r.alpha, r.mode) == (end, alpha, "baseline")
        size = np.abs(coef).max()
        assert np.abs(np.array(r.coef) - coef).max() < 1e-8 * size
        assert abs(r.intercept - intercept) < 1e-8 * max(abs(intercept), size * 1e5)
    assert {r.fold for r in mo.fit_ridge(matrix, n_splits=0).collect()} == {-1}
    assert mo.fit_ridge(matrix.where("false")).count() == 0


def test_logistic_from_another_start_is_the_same_minimum():
    x, _, rng = data(n=80)
    for labels in (rng.integers(0, 3, size=80), rng.integers(0, 2, size=80)):
        start = mo.logistic_fit(x[:60], labels[:60])
        cold, warm = mo.logistic_fit(x, labels), mo.logistic_fit(x, labels, start=start)
        assert np.abs(cold[2] - warm[2]).max() < 1e-6
        assert np.abs((cold[1] - cold[1].mean()) - (warm[1] - warm[1].mean())).max() < 1e-6


def test_first_order_check_tells_right_fits_from_wrong(spark, monkeypatch):
    """The sums come from one table an account, not from a row a feature."""
    from ledgerloom.plans import models as pm

    x, y, rng = data(n=60)
    x[:, 3] = 7.0
    rows = [(k, i, 60, "baseline", "baseline", x[i].tolist(), x[i].tolist(), float(y[i]), int(i * j % 7 > 2))
            for j, k in ((1, "a"), (3, "b")) for i in range(60)]
    matrix = spark.createDataFrame(
        rows, "account_id string, pos int, n_rows long, mode_reg string, mode_clf string, "
        "x_reg array<double>, x_clf array<double>, y double, label int")
    monkeypatch.setattr(pm, "stored_matrix", lambda s, d: matrix)
    for task in ("regression", "classification"):
        got = pm._first_order(spark, "", task)
        assert [r.stationary for r in got.collect()] == [True] * 8
    sums = pm._residual_sums(pa.table({
        "account_id": ["a"] * 2, "mode": ["m"] * 2, "fold": pa.array([0, 0], pa.int32()), "n_train": pa.array([2, 2], pa.int32()),
        "n_features": pa.array([2, 2], pa.int32()), "x": [[1.0, 2.0], [3.0, 2.0]], "residuals": [[1.0], [2.0]],
    })).to_pylist()
    assert [(r["side"], r["r"], r["rr"], r["rv"], r["m"], r["s"]) for r in sums] == [(0, 3.0, 5.0, [7.0, 6.0], [2.0, 2.0], [1.0, 0.0])]
    fit = mo.fit_ridge
    monkeypatch.setattr(mo, "fit_ridge", lambda m: fit(m).withColumn("coef", F.transform("coef", lambda c: c + 0.5)))
    assert not any(r.stationary for r in pm._first_order(spark, "", "regression").collect())
