"""Hand-made edge rows: missing amounts, empty weeks, short series, ties, zero denominators."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions import columns as C
from ledgerloom.functions.aggregates import exact_median, keep_one
from ledgerloom.operators import calendar as cal
from ledgerloom.operators import lift as lf
from ledgerloom.operators import macro as mac
from ledgerloom.operators import matrix as mx
from ledgerloom.operators import policy as po
from ledgerloom.operators import quality as q
from ledgerloom.operators import scoring as sc
from ledgerloom.operators import sectors as sec
from ledgerloom.operators import tsmetrics as ts
from ledgerloom.operators import weekly as wk
from ledgerloom.sources import fixtures as fx

MONDAY = dt.date(2024, 1, 1)


def panel(spark, series: dict, sector="retail"):
    rows = [
        (a, MONDAY + dt.timedelta(weeks=i), sector, None if x is None else float(x), 1)
        for a, xs in series.items() for i, x in enumerate(xs)
    ]
    return spark.createDataFrame(rows, S.WEEKLY)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_weekly_counts_only_present_amounts(spark):
    tx = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 7, 23), None, "retail"), ("a", dt.datetime(2024, 1, 1), 2.0, "retail"),
         ("a", dt.datetime(2024, 1, 8), None, "retail"), ("a", dt.datetime(2024, 1, 3), 1.0, "mixed")],
        "account_id string, op_ts timestamp, amount double, sector string")
    got = {(r.week, r.sector): (r.total_amount, r.transaction_count) for r in wk.weekly_cashflow(tx).collect()}
    assert got == {
        (MONDAY, "retail"): (2.0, 1), (MONDAY, "mixed"): (1.0, 1),
        (dt.date(2024, 1, 8), "retail"): (None, 0),
    }
    stats = one(wk.account_stats(wk.weekly_cashflow(tx)))
    assert stats.n_obs == 2 and stats.sector == "mixed"


def test_zero_panel_has_no_ratio_and_is_not_eligible(spark):
    stats = wk.account_stats(panel(spark, {"z": [0] * 30}))
    row = one(stats)
    assert row.cv_cashflow is None and row.completeness_ratio == 0.0
    assert wk.eligible_accounts(stats).count() == 0


@pytest.mark.parametrize("n, eligible", [(23, 0), (24, 1)])
def test_eligibility_edge(spark, n, eligible):
    assert wk.eligible_accounts(wk.account_stats(panel(spark, {"a": range(n)}))).count() == eligible


def test_short_series_metrics(spark):
    rng = np.random.default_rng(0)
    got = {
        r.account_id: r
        for r in ts.ts_metrics(panel(spark, {
            "n7": rng.normal(size=7), "n8": rng.normal(size=8), "n53": rng.normal(size=53),
            "n54": rng.normal(size=54), "gap": [1, None, 3, 4, 5, 6, 7, 8, 9],
            "one": [5.0], "flat": [3.0] * 40,
        })).collect()
    }
    assert got["n7"].acf_lag1 is None and got["n8"].acf_lag1 is not None
    # 53 rows leave one pair a season apart: no correlation; 54 leave two, which always correlate.
    assert got["n53"].seasonality_strength is None
    assert got["n54"].seasonality_strength == pytest.approx(1.0)
    assert all(v is None for k, v in got["gap"].asDict().items() if k != "account_id")
    assert got["one"].adf_statistic is None and got["one"].trend_strength is None
    assert got["flat"].trend_strength == 0.0 and got["flat"].adf_pvalue is None


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(1)
    series = {f"s{n}": rng.normal(size=n).cumsum() for n in (8, 20, 52, 60, 120)}
    got = {r.account_id: r for r in ts.ts_metrics(panel(spark, series)).collect()}
    for name, x in series.items():
        r, d, n = got[name], x - x.mean(), len(x)
        assert r.acf_lag1 == pytest.approx((d[1:] @ d[:-1]) / (d @ d))
        assert r.acf_lag2 == pytest.approx((d[2:] @ d[:-2]) / (d @ d))
        assert r.pacf_lag1 == pytest.approx(r.acf_lag1 * n / (n - 1))
        assert r.trend_strength == pytest.approx(np.corrcoef(np.arange(n), x)[0, 1] ** 2)
        lag = 52 if n > 52 else n // 2
        assert r.seasonality_strength == pytest.approx(abs(np.corrcoef(x[lag:], x[:-lag])[0, 1]))


def test_adf_brute_force(spark):
    """Lag order by explicit regression of every candidate, then the refit statistic."""
    def ols(y, cols):
        design = np.column_stack(cols)
        beta, *_ = np.linalg.lstsq(design, y, rcond=None)
        e = y - design @ beta
        return beta, e @ e, design

    rng = np.random.default_rng(2)
    for n in (24, 40, 104, 300):
        x = rng.normal(size=n).cumsum()
        dx = np.diff(x)
        max_lag = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)

        def regression(lags, start):
            y = dx[start:]
            cols = [np.ones(len(y)), x[start:-1]] + [dx[start - j : len(dx) - j] for j in range(1, lags + 1)]
            return y, *ols(y, cols)

        aics = []
        for lags in range(max_lag + 1):
            y, beta, rss, design = regression(lags, max_lag)
            aics.append(len(y) * math.log(rss / len(y)) + 2 * design.shape[1])
        best = int(np.argmin(aics))
        y, beta, rss, design = regression(best, best)
        cov = rss / (len(y) - design.shape[1]) * np.linalg.inv(design.T @ design)
        assert ts.adf_statistic(x) == pytest.approx(beta[1] / math.sqrt(cov[1, 1]), rel=1e-6)


def test_adf_zero_lag_equals_closed_form(spark):
    x = np.random.default_rng(3).normal(size=50)
    closed = one(ts.ts_df0(panel(spark, {"a": x}))).df_statistic
    dx = np.diff(x)
    design = np.column_stack([np.ones(49), x[:-1]])
    beta, rss, *_ = np.linalg.lstsq(design, dx, rcond=None)
    se = math.sqrt(rss[0] / 47 * np.linalg.inv(design.T @ design)[1, 1])
    assert closed == pytest.approx(beta[1] / se)


@pytest.mark.parametrize("tau, p", [(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)])
def test_adf_p_at_critical_values(tau, p):
    assert ts.adf_pvalue(tau) == pytest.approx(p, abs=0.002)
    assert ts.adf_pvalue(3.0) == 1.0 and ts.adf_pvalue(-20.0) == 0.0


def test_account_metrics_equals_stepwise(spark):
    rng = np.random.default_rng(4)
    p = panel(spark, {"a": rng.normal(size=60), "b": rng.normal(size=10), "c": rng.normal(size=30)})
    eligible = wk.eligible_accounts(wk.account_stats(p))
    stepwise = q.merge_metrics(eligible, ts.ts_metrics(p, eligible))
    merged = ts.account_metrics(p)
    left = {r.account_id: r.asDict() for r in stepwise.collect()}
    right = {r.account_id: r.asDict() for r in merged.collect()}
    assert left.keys() == right.keys() == {"a", "c"}
    for a in left:
        for k, v in right[a].items():
            assert v == left[a][k] or v == pytest.approx(left[a][k]), k


def test_median_is_exact_beyond_the_bracket(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(size=50_001), 6).tolist() + [7.0] * 30_000
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("b", 2.0), ("c", 5.0)]
                               + [("d", None), ("d", float("nan")), ("d", 4.0)], "k string, v double")
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    assert got == {"a": pytest.approx(float(np.median(values))), "b": 1.5, "c": 5.0, "d": 4.0}


def test_keep_one_takes_whole_rows(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 1, "y")], "k string, o int, v string")
    assert {tuple(r) for r in keep_one(df, ["k"], ["o"], "last").collect()} == {("a", 2, None), ("b", 1, "y")}


def test_champion_tie_and_zero_baseline(spark):
    rows = [("n", "A_clean", "normal", m, t, "calibration", e) for m in ("rf", "ridge")
            for t, e in (("baseline", 0.0), ("with_externals", 5.0))]
    results = spark.createDataFrame(rows, S.EXPERIMENTS)
    assert {r.rmse_lift_pct for r in lf.paired(results).collect()} == {None}
    got = {r.account_category: r for r in lf.derive_policy(results).collect()}
    assert got["A_regular_stable"].champion_model == "rf"
    assert got["A_regular_stable"].activate_externals is False
    # No pairs: the built-in row.
    assert got["D_irregular"].activate_externals is True and got["D_irregular"].n_accounts == 0


def test_derive_without_any_pair_is_the_builtin_table(spark):
    empty = spark.createDataFrame([], S.EXPERIMENTS)
    got = {(r.account_category, r.activate_externals, r.champion_model) for r in lf.derive_policy(empty).collect()}
    assert got == {(r[0], r[1], r[2]) for r in po.BUILTIN_POLICY}


def test_calendar_week_and_holiday_bounds(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-03-04', DATE'2024-04-21')) AS day")
    got = {r.week: r for r in cal.calendar_weekly(days).collect()}
    assert got[dt.date(2024, 3, 4)].is_ramadan == 1  # 10 March is the Sunday of that week
    assert got[dt.date(2024, 4, 8)].is_eid_alfitr == 1 and got[dt.date(2024, 4, 15)].is_eid_alfitr == 1
    assert got[dt.date(2024, 3, 25)].is_quarter_end == 1 and got[dt.date(2024, 4, 15)].is_quarter_end == 0


def test_chart_payloads_that_do_not_parse(spark):
    from ledgerloom.sources.io import parse_chart

    df = spark.createDataFrame([
        ("ok", '{"chart":{"result":[{"timestamp":[86400,172800],"indicators":{"quote":[{"close":[null,2.5]}]}}]}}'),
        ("bad", "{oops"), ("empty", '{"chart":{"result":[]}}'), ("none", None)], "symbol string, payload string")
    assert [tuple(r) for r in parse_chart(df).collect()] == [("ok", dt.date(1970, 1, 3), 2.5)]


def test_values_before_the_spine_cut_do_not_fill(spark):
    w = [dt.date(2024, 1, 1) + dt.timedelta(weeks=i) for i in range(5)]
    feed = spark.createDataFrame([("oil_price_z", w[0], 1.0), ("oil_price_z", w[3], 4.0),
                                  ("masi_index_z", w[4], 9.0)], "indicator string, week date, raw_value double")
    filled = mac.fill_gaps(mac.on_spine(feed, ("oil_price_z", "masi_index_z"), n_weeks=3))
    got = {(r.indicator, r.week): r.raw_value for r in filled.collect()}
    assert got["oil_price_z", w[2]] == 4.0  # back filled, not carried over the cut
    assert got["oil_price_z", w[4]] == 4.0 and got["masi_index_z", w[2]] == 9.0
    z = mac.zscore(filled)
    assert {r.z for r in z.collect()} == {0.0}  # constant inside the cut


def test_resolve_without_match_or_catch_all(spark):
    accounts = spark.createDataFrame([("a", "energy"), ("b", None), ("c", " RETAIL ")],
                                     "account_id string, sector string")
    got = {r.account_id: r for r in sec.resolve_sectors(accounts, sec.reference_mapping(spark)).collect()}
    for a in "abc":
        assert got[a].macro_primary == "" and got[a].externals_for_model == list(S.CALENDAR_KEYS)


def test_null_macro_key_is_absent(spark):
    mapping = spark.createDataFrame([("x", None, "None", False, 1)],
                                    "sector string, macro_primary string, macro_secondary string,"
                                    " include_calendar boolean, priority int")
    row = one(sec.resolve_sectors(spark.createDataFrame([("a", "x")], "account_id string, sector string"), mapping))
    assert row.macro_primary == "" and row.externals_for_model == []


def test_missing_columns_fail_before_a_job(spark):
    with pytest.raises(ValueError, match="priority"):
        sec.load_mapping(spark.sql("SELECT '' AS sector, '' AS macro_primary, '' AS macro_secondary, '' AS include_calendar"))
    with pytest.raises(ValueError):
        po.build_policy(spark.sql("SELECT 1 AS x"), "rules")


def test_label_after_zero(spark):
    got = [r.label for r in wk.week_sort(mx.direction_labels(panel(spark, {"a": [0, 1, 1.05, 1.0, -3]}))).collect()]
    assert got[:3] == [0, 1, 0] and got[4] == -1


def test_finite_or_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (2.0,)], "x double")
    assert sorted(r[0] for r in df.select(C.finite_or_zero(F.col("x"))).collect()) == [0.0, 0.0, 0.0, 2.0]


def test_folds_need_fourteen_rows_and_ten_to_train(spark):
    def folds(n):
        rows = spark.range(n).select(F.lit("a").alias("account_id"), F.col("id").cast("int").alias("pos"),
                                     F.lit(n).alias("n_rows"))
        out = mx.walk_forward_folds(rows).collect()
        for s in {r.fold for r in out}:
            train = {r.pos for r in out if r.fold == s and r.role == "train"}
            test = {r.pos for r in out if r.fold == s and r.role == "test"}
            assert max(train) < min(test) and len(test) == 4
        return {r.fold for r in out}

    assert folds(13) == set() and folds(14) == {0} and folds(18) == {0, 1} and folds(40) == {0, 1, 2}


def test_no_feature_sees_its_own_or_later_weeks(spark):
    """Changing amounts from row 20 on leaves the matrix of all rows up to 20 as it was."""
    base = np.random.default_rng(6).normal(size=40)
    changed = base.copy()
    changed[20:] += 100
    policy = spark.createDataFrame([], "account_id string, use_externals_regression boolean,"
                                   " use_externals_classification boolean, regression_model string,"
                                   " externals_for_model string")

    def vectors(x):
        return {r.t: r.x_reg for r in mx.ml_matrix(panel(spark, {"a": x}), policy).collect()}

    a, b = vectors(base), vectors(changed)
    assert all(a[t] == b[t] for t in a if t <= 20) and a[21] != b[21]


def test_indicators_arrive_one_week_late(spark):
    p = panel(spark, {"a": range(4)})
    macro = spark.createDataFrame(
        [(MONDAY + dt.timedelta(weeks=i), float(i), 0.0, 0.0, 0.0) for i in range(4)], S.MACRO)
    got = {r.week: r.oil_price_z for r in mac.macro_lag_join(p, macro).collect()}
    assert [got[MONDAY + dt.timedelta(weeks=i)] for i in range(4)] == [None, 0.0, 1.0, 2.0]


def test_hot_account_sums_before_the_join(spark):
    """The eager plan has one row per week of the hot account by the time it meets the dimension."""
    tx = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("account_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("id") % 50) * 86400).alias("op_ts"),
        F.lit(1.0).alias("amount"))
    dim = tx.select("account_id").distinct().withColumn("sector", F.lit("retail"))
    eager = wk.weekly_cashflow(tx, dim)
    direct = wk.weekly_cashflow(tx.join(dim, "account_id"))
    assert sorted(map(tuple, eager.collect())) == sorted(map(tuple, direct.collect()))


def test_median_keeps_null_group_and_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [(None, 1.0), (None, 3.0), ("a", -inf), ("a", -inf), ("a", 2.0), ("b", inf), ("b", 1.0), ("b", inf)], "k string, v double"
    )
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    assert got == {None: 2.0, "a": -inf, "b": inf}


def test_weekly_keeps_accounts_without_dimension(spark):
    tx = spark.createDataFrame(
        [("a", "1995-01-03 10:00:00", 5.0), ("b", "1995-01-03 10:00:00", 7.0)], "account_id string, op_ts string, amount double"
    ).selectExpr("account_id", "cast(op_ts as timestamp) op_ts", "amount")
    dim = spark.createDataFrame([("a", "retail"), ("a", "mixed")], "account_id string, sector string")
    got = {(r.account_id, r.sector, r.total_amount) for r in wk.weekly_cashflow(tx, dim).collect()}
    assert got == {("a", "mixed", 5.0), ("b", None, 7.0)}


def test_ewm_repeats_the_mean_over_missing_amounts(spark):
    import pandas as pd

    from ledgerloom.operators.experiments import EWM_SPANS, ewm_features

    amounts = {"a": [None, 4.0, None, None, -2.0, 7.0], "b": [None, None], "c": [3.0]}
    rows = [
        (k, MONDAY + dt.timedelta(weeks=i), "retail", x)
        for k, xs in amounts.items() for i, x in enumerate(xs)
    ]
    panel = spark.createDataFrame(rows[::-1], "account_id string, week date, sector string, total_amount double")
    got = ewm_features(panel).toPandas().sort_values(["account_id", "week"])
    for span in EWM_SPANS:
        want = [v for xs in amounts.values() for v in pd.Series(xs, dtype=float).ewm(span=span, adjust=False).mean()]
        assert got[f"ewm_{span}"].tolist() == pytest.approx(want, nan_ok=True)
    assert ewm_features(panel.where("false")).count() == 0


def test_quality_pipeline_counts_what_it_rejects(spark):
    """A short account is no account in; of the others each is kept or misses a cut; the panel is the raw one."""
    rng = np.random.default_rng(1)
    rows = []
    for name, n in (("walk", 60), ("noise", 60), ("short", 10), ("flat", 40)):
        y = np.cumsum(rng.standard_normal(n)) + 20 if name == "walk" else 5 + 9 * rng.standard_normal(n)
        y = np.full(n, 3.0) if name == "flat" else y
        rows += [
            (name, dt.datetime.combine(MONDAY + dt.timedelta(weeks=i, days=d), dt.time(9)), float(v) / 3, "retail")
            for i, v in enumerate(y) for d in (0, 2, 4)
        ]
    tx = spark.createDataFrame(rows, "account_id string, op_ts timestamp, amount double, sector string")
    cuts = q.QualityCuts(acf_min=0.5, adf_pvalue_max=2.0, cv_min=0.0, cv_max=9.0, predictability_min=-1e9, composite_min=-1e9)
    run = q.quality_pipeline(tx, cuts)
    assert [r.account_id for r in run.accounts.collect()] == ["walk"]
    assert run.counts["accounts_in"] == 2 and run.counts["untested"] == 0 and run.counts["kept"] == 1
    assert run.counts["fails_acf"] == 1 and run.counts["fails_completeness"] == 0 and run.counts["fails_cv"] == 0
    assert sorted(map(tuple, run.weekly.collect())) == sorted(map(tuple, wk.weekly_cashflow(tx).collect()))
    smooth = q.quality_pipeline(tx, cuts, smoothing=4)
    assert smooth.weekly.count() == run.weekly.count() and smooth.counts["kept"] == 2


def test_median_of_a_crowded_bracket(spark, monkeypatch):
    """Brackets with thousands of distinct values: rounds of splitting, and no task ranks over the bound."""
    from ledgerloom.functions import aggregates as ag

    monkeypatch.setattr(ag, "SPLITS", 16)
    n = 400_000
    df = spark.range(n).select(
        F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(10**12)) / 7.0).alias("v"),
    ).unionByName(spark.createDataFrame([("c", 1.0), ("c", 4.0), ("d", 2.5)], "k string, v double"))
    seen = []
    narrowed = ag._narrowed
    monkeypatch.setattr(ag, "_narrowed", lambda inside, keys: seen.append(
        inside.groupBy(*keys).count().agg(F.max("count")).first()[0]) or narrowed(inside, keys))
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m", most_ranked=20).collect()}
    assert len(seen) >= 2 and seen[0] > 300 and seen == sorted(seen, reverse=True)
    pdf = df.toPandas()
    assert got == {None if k != k or k is None else k: g.median() for k, g in pdf.groupby("k", dropna=False)["v"]}


def test_scratch_can_be_dropped(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from ledgerloom.sources import io

    monkeypatch.setattr(io, "shared_dir", lambda _: str(tmp_path))
    kept = tmp_path / "other"
    kept.mkdir()
    assert io.written(spark.range(5), "numbers").count() == 5
    (folder,) = (p for p in Path(tmp_path).iterdir() if p != kept)
    assert io.drop_scratch(spark) and not folder.exists() and kept.exists()


def test_mapping_keeps_other_columns_and_policies_name_their_version(spark):
    raw = spark.createDataFrame(
        [(" Retail ", "Shops", "nan", "", "true", "3", "survey")],
        "sector string, sector_label string, macro_primary string, macro_secondary string, include_calendar string, priority string, source string")
    got = one(sec.load_mapping(raw))
    assert (got.sector, got.sector_label, got.source, got.macro_primary, got.priority) == ("retail", "Shops", "survey", "", 3)
    quality = spark.createDataFrame(
        [("a", "retail", 99, 0.5, 0.9, 0.6, 40.0, 50.0, 0.1, 0.2)],
        "account_id string, sector string, n_obs long, cv_cashflow double, completeness_ratio double, acf_lag1 double,"
        " predictability_score double, composite_score double, trend_strength double, seasonality_strength double")
    assert one(po.build_policy(quality)).policy_version == po.VERSION_V7
    assert one(po.build_policy(quality, version_text="v8")).policy_version == "v8"


def test_lookup_cells_come_from_all_profiles(spark, tmp_path):
    """Every order counts in its cell, in every sector: a table of nations has no such cells."""
    rows = [(k, k % 14, 100.0) for k in range(1, 400)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    cells = fx.profile_cells(spark, str(tmp_path)).collect()
    profiles = fx.metric_profiles(spark, str(tmp_path)).select("sector").distinct().collect()
    assert {r.sector for r in cells} == {r.sector for r in profiles} == set(fx.SECTORS)


def test_features_are_cut_by_moments_alone():
    """Neither few transactions nor a low score removes an account."""
    from ledgerloom.plans.models import FEATURE_CUTS

    assert FEATURE_CUTS.transactions_min < 0 and FEATURE_CUTS.predictability_min == float("-inf")
    assert (FEATURE_CUTS.acf_min, FEATURE_CUTS.completeness_min, FEATURE_CUTS.cv_min, FEATURE_CUTS.cv_max) == (0.7, 0.6, 0.2, 2.0)


def test_median_rows_are_not_dealt_by_group(spark):
    """A group that holds nearly all rows is not sorted in one task."""
    from ledgerloom.functions import aggregates as ag

    rows = spark.range(2000).selectExpr("if(id < 1990, 'a', null) AS k", "cast(id AS double) AS _v")
    joined = ag._joined(rows, rows.groupBy("k").agg(F.count("_v").alias("n")), ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
