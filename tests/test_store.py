"""The model store: commits, replaced and failed runs, models of every kind coming back, scoring."""

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from ledgerloom.operators import matrix as mx
from ledgerloom.operators import models as mo
from ledgerloom.operators import scoring as sc
from ledgerloom.operators import store as st

MONDAY = dt.date(2024, 1, 1)
SMALL = {"rf": {"trees": 6}, "lgbm": {"rounds": 5, "rate": 0.3}}


@pytest.fixture(scope="module")
def features(spark):
    """Nine accounts over three families, one of them too short for a model; weeks end at different times."""
    rng = np.random.default_rng(4)
    rows = []
    for a in range(9):
        n = 12 if a == 8 else 30 + 3 * a
        y = np.cumsum(rng.standard_normal(n)) * 50 + 100
        rows += [(f"a{a}", MONDAY + dt.timedelta(weeks=i), "retail", float(v), float(i % 5)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "account_id string, week date, sector string, total_amount double, oil_price_z double")


@pytest.fixture(scope="module")
def policy(spark):
    names = ["ridge", "rf", "lgbm"]
    rows = [(f"a{a}", a % 2 == 0, a % 4 == 0, names[a % 3], "") for a in range(8)]
    return spark.createDataFrame(
        rows, "account_id string, use_externals_regression boolean, use_externals_classification boolean,"
        " regression_model string, externals_for_model string")


@pytest.fixture(scope="module")
def matrix(features, policy):
    return mx.ml_matrix(features, policy).cache()


@pytest.fixture(scope="module")
def trained(spark, matrix, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    st.train(matrix, path, "20240102-000000", parameters=SMALL)
    return path


def test_every_account_has_one_model_of_its_family(spark, trained):
    members = st.load_run(spark, trained).members.collect()
    got = {(m["account_id"], m["task"]): m["family"] for m in members}
    assert len(got) == len(members)
    names = ["ridge", "rf", "lgbm"]
    assert {a: f for (a, task), f in got.items() if task == "regression"} == {f"a{a}": names[a % 3] for a in range(8)}
    assert {f for (_, task), f in got.items() if task == "classification"} == {"logistic"}


def test_models_of_all_kinds_come_back(spark, trained, matrix):
    """Stored trees score like pyspark.ml's own transform, stored coefficients like their fits."""
    run = st.load_run(spark, trained)
    trees = run.trees.groupBy("model_id").agg(F.collect_list(F.struct(
        "weight", "depth", "feature", "threshold", "left", "right", "value")).alias("trees"))
    for family in ("rf", "lgbm"):
        rows = mo.pooled_predictions(run.ensemble(family), matrix).join(trees.where(F.col("model_id") == family))
        pairs = rows.select("yhat", st.ensemble_prediction(F.col("trees"), F.col("x_pooled")).alias("p")).collect()
        assert len({r.yhat for r in pairs}) > 5
        assert [r.p for r in pairs] == pytest.approx([r.yhat for r in pairs])
    ridge = {r.account_id: r for r in mo.fit_ridge(mo.routed(matrix, "ridge"), n_splits=0).collect()}
    logistic = {r.account_id: r for r in mo.fit_logistic(matrix, n_splits=0).collect()}
    for m in run.members.where("coefs is not null").collect():
        if m.task == "regression":
            assert m.coefs == [pytest.approx(ridge[m.account_id].coef)] and m.intercepts[0] == pytest.approx(ridge[m.account_id].intercept)
        else:
            assert m.classes == logistic[m.account_id].classes and m.intercepts == pytest.approx(logistic[m.account_id].intercepts)


def test_scoring_fits_nothing_and_follows_the_models(spark, trained, matrix, features, policy):
    run = st.load_run(spark, trained)
    scored = sc.batch_score(features, policy, run)
    plan = scored._jdf.queryExecution().toString()
    assert "Python" not in plan and "FlatMapGroups" not in plan
    got = {(r.account_id, r.task): r for r in scored.collect()}
    newest = matrix.where("pos = n_rows - 1")
    assert {a for a, _ in got} == {f"a{a}" for a in range(8)}
    for family in ("rf", "lgbm"):
        for r in mo.pooled_predictions(run.ensemble(family), mo.routed(newest.where("n_rows >= 14"), family)).collect():
            assert got[r.account_id, "regression"].prediction == pytest.approx(r.yhat)
            assert got[r.account_id, "regression"].model_name == family
    ridge = mo.fit_ridge(mo.routed(matrix, "ridge"), n_splits=0).drop("mode")
    for r in newest.join(ridge, "account_id").withColumn("p", mo.linear_prediction(F.col("x_reg"))).collect():
        assert got[r.account_id, "regression"].prediction == pytest.approx(r.p)
    logistic = mo.fit_logistic(matrix, n_splits=0).drop("mode")
    for r in newest.join(logistic, "account_id").withColumn("p", mo.class_prediction(F.col("x_clf"))).collect():
        assert got[r.account_id, "classification"].prediction == r.p


def test_a_mode_the_policy_no_longer_asks_for_does_not_match(spark, trained, features, policy):
    changed = policy.withColumn("use_externals_regression", ~F.col("use_externals_regression"))
    scored = sc.batch_score(features, changed, st.load_run(spark, trained))
    assert {r.task for r in scored.select("task").distinct().collect()} == {"classification"}


def _members(spark, value, accounts=("a", "b"), task="regression"):
    rows = [(a, task, "ridge", "baseline", 20, a, None, [value], [[1.0]]) for a in accounts]
    return spark.createDataFrame(rows, st.MEMBERS)


def test_commits(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        st.load_run(spark, path)
    assert st.manifest(spark, path).count() == 0
    st.save_run(_members(spark, 1.0), {}, path, "20240103-000000", commit=False)
    with pytest.raises(FileNotFoundError):
        st.load_run(spark, path)
    for stamp, value in (("20240102-000000", 2.0), ("20240101-000000", 1.0), ("20240102-000000", 3.0)):
        st.save_run(_members(spark, value), {}, path, stamp)
    run = st.load_run(spark, path)
    assert run.run_stamp == "20240102-000000" and run.trees.count() == 0
    assert sorted((m.account_id, m.intercepts) for m in run.members.collect()) == [("a", [3.0]), ("b", [3.0])]
    assert {r.intercepts[0] for r in st.load_run(spark, path, "20240101-000000").members.collect()} == {1.0}
    assert sorted((r.run_stamp, r.attempt, r.accounts, r.models) for r in st.manifest(spark, path).collect()) == [
        ("20240101-000000", 1, 2, 2), ("20240102-000000", 2, 2, 2)]


def test_an_account_twice_is_not_committed(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(SparkRuntimeException, match="occurs twice"):
        st.save_run(_members(spark, 1.0, ("a", "a")), {}, path, "20240101-000000")
    assert st.manifest(spark, path).count() == 0


def test_pooled_models_see_no_later_week(spark, matrix, monkeypatch):
    """No training row of any account lies in or after the first week of a test block it scores."""
    seen = []

    def spied(train, **_):
        seen.append(train.agg(F.max("week")).first()[0])
        return mo.fit_forest(train, trees=2)

    monkeypatch.setitem(mo.POOLED_FITS, "rf", spied)
    folds = mo.calendar_folds(mo.routed(matrix, "rf")).where("block = 'test'")
    first = {(r.account_id, r.fold): (r.w, r.cut) for r in folds.groupBy("account_id", "fold").agg(
        F.min("week").alias("w"), F.first("cut").alias("cut")).collect()}
    predictions = mo.pooled_fold_predictions(matrix, "rf")
    assert seen and len(seen) == len({cut for _, cut in first.values()})
    assert all(cut <= w for w, cut in first.values())
    assert max(seen) < max(cut for _, cut in first.values())
    for cut in {cut for _, cut in first.values()}:
        assert any(week < cut and (cut - week).days <= 7 for week in seen)
    wanted = mx.walk_forward_folds(mo.routed(matrix, "rf")).where("role = 'test'")
    key = lambda r: (r.account_id, r.fold, r.pos)
    assert sorted(map(key, predictions.where("block = 'test'").collect())) == sorted(map(key, wanted.collect()))


def test_report_counts_and_replaced_partitions(spark, matrix, tmp_path):
    report = sc.training_report(matrix, *sc.family_predictions(matrix, parameters=SMALL), "20240101-000000", "models")
    path = str(tmp_path / "reports")
    for _ in range(2):
        sc.save_rows(report, path, "20240101-000000")
    sc.save_rows(report.where("task = 'regression'"), path, "20240102-000000")
    saved = sc.saved_rows(spark, path).collect()
    assert len({(r.account_id, r.task, r.run_stamp) for r in saved}) == len(saved)
    assert {(r.run_stamp, r.task) for r in saved} == {
        ("20240101-000000", "regression"), ("20240101-000000", "classification"), ("20240102-000000", "regression")}
    assert {r.n_test_obs for r in saved} == {4}
    names = ["ridge", "rf", "lgbm"]
    assert {r.account_id: r.model_name for r in saved if r.task == "regression"} == {f"a{a}": names[a % 3] for a in range(8)}
    assert all(r.n_folds == 3 and r.mape_ref is not None for r in saved if r.task == "regression")
