"""Queries on experiment transforms, external selection and lift summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions.literals import literal_table
from ledgerloom.operators import experiments as ex
from ledgerloom.operators import lift as lf
from ledgerloom.operators import sectors as sec
from ledgerloom.plans.models import _X, ml_features
from ledgerloom.plans.panel import KEYS, scored
from ledgerloom.plans.policy import _DERIVE
from ledgerloom.plans.registry import register
from ledgerloom.plans.sql import ACCOUNT, with_ctes
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources import io


def _over(n: int) -> str:
    return f"OVER ({ACCOUNT} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


register(
    "irregular_features",
    lambda s, d: ex.irregular_features(fx.weekly(s, d)).drop("total_amount", "transaction_count"),
    with_ctes(f"""SELECT account_id, week, sector, is_active_week,
      CAST(sum(is_active_week) {_over(8)} AS BIGINT) AS active_weeks_8w,
      avg(is_active_week) {_over(8)} AS local_completeness_8w, max(step) {_over(4)} AS max_change_4w,
      stddev_samp(total_amount) {_over(4)} AS std_4w, max(total_amount) {_over(12)} AS max_12w,
      min(total_amount) {_over(12)} AS min_12w FROM (SELECT *, CASE WHEN total_amount <> 0 THEN 1 ELSE 0 END AS is_active_week,
        abs(total_amount - lag(total_amount) OVER ({ACCOUNT})) AS step FROM weekly)"""),
    local_completeness_8w=6, max_change_4w=4, std_4w=3, max_12w=4, min_12w=4,
)


def _ewm_sql() -> str:
    step = ", ".join(
        f"(2.0 / {n + 1}) * c.x + (1 - 2.0 / {n + 1}) * r.e{n} AS e{n}" for n in ex.EWM_SPANS)
    first = ", ".join(f"x AS e{n}" for n in ex.EWM_SPANS)
    out = ", ".join(f"e{n} AS ewm_{n}" for n in ex.EWM_SPANS)
    body = with_ctes(
        f"SELECT account_id, week, sector, total_amount, {out} FROM rec",
        num=f"SELECT account_id, week, sector, total_amount, CAST(total_amount AS DOUBLE) AS x, row_number() OVER ({ACCOUNT}) AS i FROM mixed",
        rec=f"""SELECT account_id, week, sector, total_amount, i, {first} FROM num WHERE i = 1
      UNION ALL SELECT c.account_id, c.week, c.sector, c.total_amount, c.i, {step}
      FROM rec AS r JOIN num AS c ON c.account_id = r.account_id AND c.i = r.i + 1""",
    )
    return body.replace("WITH ", "WITH RECURSIVE ", 1)


register("ewm_features", lambda s, d: ex.ewm_features(fx.weekly_mixed(s, d)), _ewm_sql(),
         total_amount=6, ewm_4=4, ewm_12=4, ewm_52=4)

# --- selection ---------------------------------------------------------------------------------------------

_CORR = {
    **_X,
    "numbered": f"SELECT *, row_number() OVER ({ACCOUNT}) AS i FROM ext",
    "series": " UNION ALL ".join(
        f"SELECT account_id, i, '{k}' AS external, {k} AS e FROM numbered" for k in S.MACRO_KEYS),
}
register(
    "ext_correlation",
    lambda s, d: ex.external_correlations(ml_features(s, d)),
    with_ctes("""SELECT a.account_id, external, lag, covar_pop(a.total_amount, b.e)
        / nullif(stddev_pop(CASE WHEN b.e IS NOT NULL THEN a.total_amount END) * stddev_pop(b.e), 0) AS r,
      CAST(count(b.e) AS BIGINT) AS n_pairs
      FROM numbered AS a CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS l(lag)
      JOIN series AS b ON b.account_id = a.account_id AND b.i = a.i - lag GROUP BY 1, 2, 3""", **_CORR),
    r=7,
)
#: The two-sided tail of Student's t in its finite series: sine |r|, cosine sqrt(1 - r^2) of the angle.
_TAIL = """CASE WHEN r IS NULL OR n_pairs <= 2 THEN 1.0
        WHEN n_pairs % 2 = 0 THEN 1 - abs(r) * list_sum(list_transform(range((n_pairs - 2) // 2),
          lambda k: exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1) + k * ln(1 - r * r))))
        ELSE 1 - 2 / pi() * (asin(abs(r)) + abs(r) * coalesce(list_sum(list_transform(range((n_pairs - 3) // 2),
          lambda k: exp(lgamma(k + 1) + lgamma(1.5) - lgamma(k + 1.5) + (k + 0.5) * ln(1 - r * r)))), 0)) END"""
_LAG_CORR = """SELECT a.account_id, external, lag, covar_pop(a.total_amount, b.e)
        / nullif(stddev_pop(CASE WHEN b.e IS NOT NULL THEN a.total_amount END) * stddev_pop(b.e), 0) AS r,
      CAST(count(b.e) AS BIGINT) AS n_pairs
      FROM numbered AS a CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS l(lag)
      JOIN series AS b ON b.account_id = a.account_id AND b.i = a.i - lag GROUP BY 1, 2, 3"""
register(
    "ext_corr_select",
    lambda s, d: ex.select_by_correlation(ex.external_correlations(ml_features(s, d))),
    with_ctes(f"""SELECT account_id, external, bool_or(p < 0.05 AND abs(r) > 0.05) AS keep, min(p) AS min_p,
      max(abs(r)) AS max_abs_r FROM (SELECT *, {_TAIL} AS p FROM lag_corr) GROUP BY account_id, external""",
              **_CORR, lag_corr=_LAG_CORR),
    min_p=7, max_abs_r=7,
)
register("ext_importance_select", lambda s, d: ex.select_by_importance(ml_features(s, d)))


def _selections(spark, sf):
    """Two candidate lists and a model per order, combined."""
    k = F.col("o_orderkey")
    models = ("ridge", "rf", "lgbm", "sarima", "holt_winters")
    none = F.array().cast("array<string>")
    frame = fx.table(spark, sf, "orders").select(
        F.format_string("P_%08d", k).alias("account_id"),
        fx.element(fx.SECTORS, F.col("o_custkey")).alias("sector"),
        fx.element(models, k).alias("model_name"),
        F.when(k % 3 == 0, F.array(F.lit("oil_price_z"), F.lit("masi_index_z"))).otherwise(none)
        .alias("by_correlation"),
        F.when(k % 4 == 0, F.array(F.lit("commodity_index_z"), F.lit("oil_price_z"))).otherwise(none)
        .alias("by_importance"),
    )
    return ex.combine_selection(frame)


_SELECTED = """SELECT printf('P_%08d', o_orderkey) AS account_id, sector, model_name,
        oil AND oil_any AS oil_price_z, com AND imp_on AS commodity_index_z, mas AND corr_on AS masi_index_z FROM (
          SELECT o_orderkey, list_extract(['agriculture', 'transport', 'investment', 'construction', 'mixed', 'retail',
              'energy'], o_custkey % 7 + 1) AS sector,
            list_extract(['ridge', 'rf', 'lgbm', 'sarima', 'holt_winters'], o_orderkey % 5 + 1) AS model_name,
            true AS oil, true AS com, true AS mas,
            o_orderkey % 5 IN (0, 3, 4) AND o_orderkey % 3 = 0 AS corr_on,
            o_orderkey % 5 IN (0, 1, 2) AND o_orderkey % 4 = 0 AS imp_on,
            (o_orderkey % 5 IN (0, 3, 4) AND o_orderkey % 3 = 0)
              OR (o_orderkey % 5 IN (0, 1, 2) AND o_orderkey % 4 = 0) AS oil_any FROM orders)"""
register(
    "ext_combine",
    lambda s, d: _selections(s, d).select(
        "account_id", "sector", "model_name", F.size("selected").alias("n_selected"),
        *(F.array_contains("selected", k).alias(k) for k in S.MACRO_KEYS[:3])),
    with_ctes("""SELECT *, CAST(5 + CASE WHEN oil_price_z THEN 1 ELSE 0 END + CASE WHEN commodity_index_z THEN 1 ELSE 0 END
      + CASE WHEN masi_index_z THEN 1 ELSE 0 END AS INTEGER) AS n_selected FROM chosen""", chosen=_SELECTED),
)
register(
    "selection_audit", lambda s, d: lf.selection_audit(_selections(s, d), S.EXTERNAL_KEYS),
    with_ctes("SELECT sector, model_name, CAST(count(*) AS BIGINT) AS n_accounts, "
              + ", ".join(f"avg(CASE WHEN {k} THEN 1.0 ELSE 0.0 END) AS {k}" for k in S.MACRO_KEYS[:3])
              + ", 0.0 AS realestate_index_z, " + ", ".join(f"1.0 AS {k}" for k in S.CALENDAR_KEYS)
              + " FROM chosen GROUP BY sector, model_name", chosen=_SELECTED),
    **{k: 6 for k in S.EXTERNAL_KEYS},
)

# --- lift summaries ------------------------------------------------------------------------------------------


def summary(spark, sf):
    return lf.lift_summary(fx.experiments(spark, sf))


_SUMMARY = """SELECT name, condition, model_name, experiment_role,
        avg(rmse) FILTER (model_type = 'baseline') AS baseline_rmse,
        avg(rmse) FILTER (model_type = 'with_externals') AS with_externals_rmse FROM experiments GROUP BY 1, 2, 3, 4"""
_LIFTED = """SELECT *, (baseline_rmse - with_externals_rmse) / nullif(baseline_rmse, 0) * 100 AS rmse_lift_pct FROM summary"""
_SUM = dict(summary=_SUMMARY, lifted=_LIFTED)
register("lift_summary", summary, with_ctes("SELECT * FROM lifted", **_SUM),
         baseline_rmse=3, with_externals_rmse=3, rmse_lift_pct=6)
_EDGES = {"cv_cashflow": (0.85, 0.9, 1.0), "acf_lag1": (0.65, 0.7)}


def _account_metrics(spark, sf):
    from ledgerloom.operators.tsmetrics import account_metrics

    metrics = account_metrics(fx.weekly_smooth(spark, sf), min_obs=0, adf=False)
    return metrics.withColumnRenamed("account_id", "name")


def _bins_sql() -> str:
    from ledgerloom.plans.panel import JUDGED
    from ledgerloom.plans.panel import stats_sql

    return with_ctes(f"""SELECT l.name, condition, model_name, experiment_role, rmse_lift_pct,
      CASE WHEN cv_cashflow < 0.85 THEN '<0.85' WHEN cv_cashflow < 0.9 THEN '[0.85,0.9)'
        WHEN cv_cashflow < 1.0 THEN '[0.9,1.0)' WHEN cv_cashflow >= 1.0 THEN '>=1.0' END AS cv_cashflow_bin,
      CASE WHEN r1 < 0.65 THEN '<0.65' WHEN r1 < 0.7 THEN '[0.65,0.7)' WHEN r1 >= 0.7 THEN '>=0.7' END AS acf_lag1_bin
      FROM lifted AS l LEFT JOIN ({stats_sql('smooth')}) AS s ON s.account_id = l.name
      LEFT JOIN acfs AS a ON a.account_id = l.name""", **_SUM, **JUDGED)


register(
    "lift_with_bins",
    lambda s, d: lf.lift_with_bins(summary(s, d), _account_metrics(s, d), _EDGES).drop(
        "baseline_rmse", "with_externals_rmse"),
    _bins_sql(), rmse_lift_pct=6,
)
register(
    "lift_aggregate", lambda s, d: lf.lift_aggregate(summary(s, d)),
    with_ctes("""SELECT condition, model_name, experiment_role, CAST(count(rmse_lift_pct) AS BIGINT) AS n_pairs,
      avg(rmse_lift_pct) AS mean_lift_pct, avg(CASE WHEN rmse_lift_pct > 0 THEN 1.0
        WHEN rmse_lift_pct <= 0 THEN 0.0 END) AS pct_positive FROM lifted GROUP BY 1, 2, 3""", **_SUM),
    mean_lift_pct=6, pct_positive=6,
)


def _with_categories(spark, sf):
    rows = summary(spark, sf)
    spec = literal_table(
        spark, [(r[4], r[0]) for r in lf.CATEGORY_SOURCES if r[3] == "condition"],
        "condition string, account_category string")
    return rows.join(F.broadcast(spec), "condition")


_CATEGORY = {
    **_SUM,
    "in_category": """SELECT *, CASE condition WHEN 'C_short' THEN 'E_short_history' WHEN 'B_noisy' THEN 'D_noisy'
        WHEN 'sparse' THEN 'D_sparse' WHEN 'flat' THEN 'F_flat' WHEN 'C_level_shift_w70' THEN 'C_trending'
        WHEN 'A_clean' THEN 'A_regular_stable' WHEN 'irregular' THEN 'D_irregular' END AS account_category FROM lifted""",
}


def _benchmark_sql(by: str, select: str) -> str:
    keys = f"account_category{by}"
    return with_ctes(
        f"SELECT {select} FROM best",
        means=f"""SELECT {keys}, model_name, avg(with_externals_rmse) AS mr, avg(rmse_lift_pct) AS ml
      FROM in_category WHERE experiment_role = 'calibration' GROUP BY ALL""",
        best=f"""SELECT {keys}, arg_min(model_name, (mr, model_name)) AS champion_model, min(mr) AS mean_rmse,
        arg_min(ml, (mr, model_name)) AS mean_lift_pct FROM means WHERE mr IS NOT NULL GROUP BY {keys}""",
        **_CATEGORY,
    )


register("category_benchmark", lambda s, d: lf.category_benchmark(_with_categories(s, d)),
         _benchmark_sql("", "*"), mean_rmse=3, mean_lift_pct=6)
register(
    "category_benchmark_by_condition",
    lambda s, d: lf.category_benchmark(_with_categories(s, d), ("condition",)),
    _benchmark_sql(", condition", "*"), mean_rmse=3, mean_lift_pct=6,
)
register(
    "policy_draft",
    lambda s, d: lf.policy_draft(lf.category_benchmark(_with_categories(s, d)), 1.0),
    _benchmark_sql("", "account_category, champion_model, mean_lift_pct, coalesce(mean_lift_pct >= 1.0, false) AS activate_externals"),
    mean_lift_pct=6,
)

# --- degradations ----------------------------------------------------------------------------------------------

_DRAW = "CAST(CAST('0x' || substr(md5(concat_ws('|', account_id, CAST(week AS VARCHAR), '{}', '42')), 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296.0"


_U, _V = (
    "CAST(CAST('0x' || substr(md5(concat_ws('|', account_id, CAST(week AS VARCHAR), '{k}', '42', '%s')), 1, 8)"
    " AS UBIGINT) AS DOUBLE) / 4294967296.0" % part for part in "uv"
)
_WORSE = {
    "A_perfect": "{k}",
    "B_lag1w": "lag({k}, 1) OVER ({w})",
    "C_lag3w": "lag({k}, 3) OVER ({w})",
    "D_noisy30": "{k} + 0.3 * stddev_pop({k}) OVER (PARTITION BY account_id) * sqrt(-2 * ln(1 - "
    + _U + ")) * cos(2 * pi() * " + _V + ")",
    "E_missing20": "last_value(CASE WHEN {draw} >= 0.2 THEN {k} END IGNORE NULLS)"
    " OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
}


def _worse_sql(condition: str) -> str:
    return ", ".join(
        f"{_WORSE[condition].format(k=k, w=ACCOUNT, draw=_DRAW.format(k))} AS {k}" for k in S.MACRO_KEYS)


def _degraded(condition: str):
    register(
        f"degrade_{condition.lower()}",
        lambda s, d: ex.degrade_externals(ml_features(s, d), condition).select(
            *KEYS, *S.MACRO_KEYS, "is_ramadan"),
        with_ctes(f"SELECT account_id, week, sector, {_worse_sql(condition)}, is_ramadan FROM ext", **_X),
        **{k: 8 for k in S.MACRO_KEYS},
    )


for _condition in list(_WORSE)[1:]:
    _degraded(_condition)


def _all_conditions(spark, sf):
    """Every condition on one stored table, a labelled copy of the panel each."""
    features = io.written(ml_features(spark, sf), "features")
    out = None
    for condition in _WORSE:
        part = ex.degrade_externals(features, condition).select(
            F.lit(condition).alias("condition"), *KEYS, *S.MACRO_KEYS, "is_ramadan")
        out = part if out is None else out.unionByName(part)
    return out


register(
    "degrade_externals", _all_conditions,
    with_ctes(" UNION ALL ".join(
        f"SELECT '{c}' AS condition, account_id, week, sector, {_worse_sql(c)}, is_ramadan FROM ext"
        for c in _WORSE), **_X),
    **{k: 8 for k in S.MACRO_KEYS},
)
register(
    "structural_break",
    lambda s, d: ex.level_shift(fx.weekly_smooth(s, d).withColumn("x", F.col("total_amount"))).select(
        *KEYS, "idx", "x", (F.col("total_amount") - F.col("x")).alias("added")),
    with_ctes(f"""SELECT account_id, week, sector, CAST(i AS INTEGER) AS idx, total_amount AS x,
      CASE WHEN i >= 70 THEN 0.3 * m ELSE 0.0 END AS added FROM (
        SELECT *, row_number() OVER ({ACCOUNT}) - 1 AS i, avg(total_amount) OVER (PARTITION BY account_id) AS m FROM smooth)"""),
    x=6, added=3,
)
_NEXT = {a: b for a, b in zip(fx.SECTORS[:6], fx.SECTORS[1:6] + fx.SECTORS[:1])}
register(
    "wrong_external",
    lambda s, d: sec.resolve_sectors(
        ex.rotate_sectors(sec.account_dimension(fx.weekly(s, d)), fx.SECTORS[:6]), sec.reference_mapping(s)
    ).select("account_id", "true_sector", "sector", "macro_primary", "macro_secondary"),
    with_ctes("""SELECT account_id, a.sector AS true_sector, coalesce(other, a.sector) AS sector,
      coalesce(macro_primary, '') AS macro_primary, coalesce(macro_secondary, '') AS macro_secondary
      FROM (SELECT DISTINCT account_id, sector FROM tx) AS a LEFT JOIN (VALUES """
              + ", ".join(f"('{a}', '{b}')" for a, b in _NEXT.items())
              + """) AS n(own, other) ON own = a.sector LEFT JOIN (SELECT * FROM mapping WHERE priority <= 6) AS m
        ON m.sector = coalesce(other, a.sector)"""),
)
