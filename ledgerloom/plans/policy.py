"""Queries on policies, lift tables and the derived decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.aggregates import exact_median
from ledgerloom.operators import lift as lf
from ledgerloom.operators import matrix as mx
from ledgerloom.operators import policy as po
from ledgerloom.operators import quality as q
from ledgerloom.operators import sectors as sec
from ledgerloom.plans.panel import CATEGORY_V6, scored
from ledgerloom.plans.registry import register
from ledgerloom.plans.sql import with_ctes
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources import io

# Own test thresholds: the rules have no published values.
CUTS = po.RuleCuts(
    completeness_sparse=0.25, cv_flat=0.15, noise_max=0.5, acf_regular=0.5, completeness_regular=0.55,
    predictability_regular=30.0, acf_irregular=0.35, completeness_irregular=0.45,
    composite_irregular=35.0, cv_volatile=1.2, composite_volatile=30.0,
)
PRIORITY = ("transport", "retail")

_METRICS = "account_id, sector, cv_cashflow, completeness_ratio, acf_lag1, predictability_score, composite_score"
_MDIGITS = dict(cv_cashflow=6, completeness_ratio=6, acf_lag1=6, predictability_score=7, composite_score=7)
_BUCKET = """CASE WHEN cv_cashflow < 0.3 THEN '<0.30' WHEN cv_cashflow < 0.5 THEN '[0.30,0.50)'
        WHEN cv_cashflow < 0.8 THEN '[0.50,0.80)' ELSE '>=0.80' END"""
_BUILTIN = """(VALUES ('E_short_history', false, 'lgbm', 'E_short', 0.0), ('C_trending', false, 'rf', 'C_trending', 2.13),
        ('B_seasonal', false, 'lgbm', 'B_seasonal', -0.54), ('A_regular_stable', true, 'rf', 'A_regular', 5.13),
        ('D_noisy', false, 'ridge', 'D_noisy', -0.37), ('D_irregular', true, 'ridge', 'D_irregular', 5.25),
        ('D_sparse', false, 'ridge', 'D_sparse', -2.11), ('F_flat', false, 'rf', 'F_flat', -1.53))
        AS b(account_category, act, model, rule_id, lift)"""
_DECIDED = f"""SELECT {_METRICS}, c.account_category, coalesce(act, false) AS use_externals_regression,
        coalesce(act, false) AS use_externals_classification, coalesce(rule_id, c.account_category) AS policy_rule_id,
        coalesce(model, 'rf') AS regression_model, 'logistic' AS classification_model
      FROM categorised AS c LEFT JOIN {_BUILTIN} ON b.account_category = c.account_category"""
_RULED = f"""SELECT {_METRICS}, CAST(NULL AS VARCHAR) AS account_category, policy_rule_id IN ('R1', 'R2', 'R3')
          AS use_externals_regression, policy_rule_id = 'R1' AS use_externals_classification, policy_rule_id,
        'rf' AS regression_model, 'logistic' AS classification_model, 'v3.0' AS policy_version
      FROM (SELECT *, CASE WHEN completeness_ratio <= 0.25 THEN 'R0-A' WHEN cv_cashflow < 0.15 THEN 'R0-B'
          WHEN acf_lag1 >= 0.5 AND completeness_ratio > 0.55 AND predictability_score >= 30 THEN 'R1'
          WHEN acf_lag1 < 0.35 AND completeness_ratio > 0.45 AND composite_score >= 35 THEN 'R2'
          WHEN cv_cashflow > 1.2 AND composite_score >= 30 THEN 'R3' ELSE 'baseline' END AS policy_rule_id
        FROM scored)"""
_OVERRIDES = "SELECT account_id AS ov_account, n_items % 2 = 0 AS ov_reg, n_parts % 3 = 0 AS ov_clf FROM items"


def overrides(spark, sf):
    """Flags of every order with line items; those without have no override."""
    return fx.item_accounts(spark, sf).select(
        "account_id", (F.col("n_items") % 2 == 0).alias("use_externals_regression"),
        (F.col("n_parts") % 3 == 0).alias("use_externals_classification"),
    )


# --- policy -------------------------------------------------------------------------------------------

register(
    "policy_category",
    lambda s, d: po.build_policy(scored(s, d)),
    with_ctes(f"SELECT *, 'v7-encapsulated-3pct' AS policy_version FROM ({_DECIDED})"), **_MDIGITS,
)
register(
    "policy_category_v6",
    lambda s, d: po.build_policy(scored(s, d), "category_v6"),
    with_ctes(f"SELECT * REPLACE (account_category AS policy_rule_id), 'v6' AS policy_version FROM ({_DECIDED})"),
    **_MDIGITS,
)
register(
    # The pooled categories are not all in the table of the separate ones: D_volatile and F_mixed have no row.
    "category_policy_join",
    lambda s, d: po.category_policy_join(
        q.with_category(scored(s, d), "v6").select("account_id", "account_category"), po.builtin_policy(s),
    ),
    with_ctes(f"""SELECT account_id, c.account_category, coalesce(act, false) AS use_externals_regression,
      coalesce(act, false) AS use_externals_classification, coalesce(rule_id, c.account_category) AS policy_rule_id,
      coalesce(model, 'rf') AS regression_model FROM (SELECT account_id, {CATEGORY_V6} AS account_category FROM scored) AS c
      LEFT JOIN {_BUILTIN} ON b.account_category = c.account_category"""),
)
register("policy_rules", lambda s, d: po.policy_rules(scored(s, d), CUTS), with_ctes(_RULED), **_MDIGITS)
register(
    "sector_cv_lookup_join",
    lambda s, d: po.sector_cv_lookup_join(po.policy_rules(scored(s, d), CUTS), fx.profile_cells(s, d))
    .select("account_id", "use_externals_regression", "use_externals_classification"),
    with_ctes(f"""SELECT account_id, coalesce(cell_reg, use_externals_regression) AS use_externals_regression,
      coalesce(cell_clf, use_externals_classification) AS use_externals_classification
      FROM (SELECT *, {_BUCKET} AS b FROM ruled) AS r LEFT JOIN profile_cells AS c ON c.sector = r.sector AND c.cv_bucket = r.b""",
              ruled=_RULED),
)
register(
    "account_override_join",
    lambda s, d: po.account_override_join(po.policy_rules(scored(s, d), CUTS), overrides(s, d))
    .select("account_id", "use_externals_regression", "use_externals_classification"),
    with_ctes("""SELECT account_id, coalesce(ov_reg, use_externals_regression) AS use_externals_regression,
      coalesce(ov_clf, use_externals_classification) AS use_externals_classification
      FROM ruled LEFT JOIN ov ON ov_account = account_id""", ruled=_RULED, ov=_OVERRIDES),
)


def _mode(key: str, mode: str, *first: str):
    """One policy mode; ``first`` names the tables whose flags replace the rules', strongest first."""
    reg, clf = (", ".join([*(f"{t}_{task}" for t in first), ""]) for task in ("reg", "clf"))
    register(
        key,
        lambda s, d: po.build_policy(
            scored(s, d), mode, cuts=CUTS, lookup=fx.sector_cells(s, d), overrides=overrides(s, d)
        ).select("account_id", "policy_rule_id", "use_externals_regression", "use_externals_classification"),
        with_ctes(f"""SELECT account_id, policy_rule_id,
      coalesce({reg}use_externals_regression) AS use_externals_regression,
      coalesce({clf}use_externals_classification) AS use_externals_classification
      FROM (SELECT *, {_BUCKET} AS b FROM ruled) AS r LEFT JOIN cells AS c ON c.sector = r.sector AND c.cv_bucket = r.b
      LEFT JOIN ov ON ov_account = account_id""", ruled=_RULED, ov=_OVERRIDES),
    )


_mode("policy_mode", "hybrid", "ov", "cell")
_mode("policy_mode_lookup", "lookup", "cell")
_mode("policy_mode_oracle", "oracle", "ov")
_mode("policy_mode_rules", "rules")
_mode("policy_mode_unknown", "no such mode")


def _assignment_join(spark, sf):
    """Indicators assigned to every order with line items; the policy also holds those without."""
    assigned = sec.macro_assignment(fx.item_accounts(spark, sf), sec.reference_mapping(spark))
    out = po.assignment_join(po.build_policy(scored(spark, sf)), assigned)
    return out.select(
        "account_id", "account_category", "macro_primary", "macro_secondary",
        F.size("externals_for_model").alias("n_externals"),
    )


register(
    "assignment_join", _assignment_join,
    with_ctes("""SELECT c.account_id, account_category,
      CASE WHEN i.account_id IS NOT NULL THEN coalesce(macro_primary, '') END AS macro_primary,
      CASE WHEN i.account_id IS NOT NULL THEN coalesce(macro_secondary, '') END AS macro_secondary,
      CAST(CASE WHEN i.account_id IS NOT NULL THEN 5 + CASE WHEN macro_primary <> '' THEN 1 ELSE 0 END
        + CASE WHEN macro_secondary <> '' THEN 1 ELSE 0 END END AS INTEGER) AS n_externals
      FROM categorised AS c LEFT JOIN items AS i ON i.account_id = c.account_id
      LEFT JOIN (SELECT * FROM mapping WHERE priority <= 6) AS m ON m.sector = i.sector"""),
)
register(
    "policy_sector_rule_v2",
    lambda s, d: scored(s, d).select("account_id", po.sector_rule(
        F.col("sector"), F.col("cv_cashflow"), PRIORITY).alias("use_externals_regression")),
    with_ctes("""SELECT account_id, sector IN ('transport', 'retail') OR (cv_cashflow >= 0.3 AND cv_cashflow < 0.5)
      AS use_externals_regression FROM scored"""),
)
register(
    "policy_from_quality",
    lambda s, d: po.policy_from_quality(scored(s, d), fx.profile_cells(s, d), PRIORITY),
    with_ctes(f"""SELECT account_id, r.sector, cv_cashflow, predictability_score, composite_score,
      coalesce(cell_reg, r.sector IN ('transport', 'retail') OR (cv_cashflow >= 0.3 AND cv_cashflow < 0.5))
        AS use_externals_regression, coalesce(cell_clf, false) AS use_externals_classification,
      'rf' AS regression_model, 'logistic' AS classification_model, 'v3.0' AS policy_version,
      CASE WHEN c.sector IS NOT NULL THEN 'lookup_sector_cv' ELSE 'rules_v2' END AS policy_source
      FROM (SELECT *, {_BUCKET} AS b FROM scored) AS r LEFT JOIN profile_cells AS c ON c.sector = r.sector AND c.cv_bucket = r.b"""),
    cv_cashflow=6, predictability_score=7, composite_score=7,
)


def _flag_norm(spark, sf):
    """A policy table with a category per experiment account and many rows each."""
    model = F.col("model_name")
    raw = fx.experiments(spark, sf).select(
        F.col("name").alias("account_category"),
        F.when(model == "ridge", " TRUE").when(model == "rf", "1").when(model == "lgbm", "yEs")
        .alias("activate_externals"),
        F.concat(F.lit(" "), F.upper(model), F.lit(" ")).alias("champion_model"),
        F.concat_ws("|", "condition", "model_name", "model_type").alias("line"),
    )
    return po.load_category_policy(raw, "line").drop("line")


register(
    "policy_flag_norm", _flag_norm,
    with_ctes("""SELECT account_category, activate_externals, regression_model, account_category AS policy_rule_id,
      'v7_encapsulated' AS policy_source FROM (SELECT name AS account_category, model_name <> 'ridge' AS activate_externals,
        model_name AS regression_model, row_number() OVER (PARTITION BY name
          ORDER BY condition || '|' || model_name || '|' || model_type DESC) AS rn FROM experiments) WHERE rn = 1"""),
)
def _routes(spark, sf):
    """Every account, with each spelling of a model name, none, a blank and an unknown one."""
    k = F.col("s_suppkey")
    names = F.array(*map(F.lit, ("Random_Forest ", "ridge", "lgbm", None, "", "xgboost")))
    named = fx.table(spark, sf, "supplier").select(
        fx.account_name(k).alias("account_id"),
        F.element_at(names, (k % 6 + 1).cast("int")).alias("regression_model"),
    )
    return mx.model_route(named).drop("regression_model")


register(
    "model_route", _routes,
    """SELECT printf('ACC_%05d', s_suppkey) AS account_id,
      CASE s_suppkey % 6 WHEN 1 THEN 'ridge' WHEN 2 THEN 'lgbm' WHEN 5 THEN 'xgboost' ELSE 'rf' END AS model_name,
      CASE s_suppkey % 6 WHEN 1 THEN 'ridge' WHEN 2 THEN 'lgbm' ELSE 'rf' END AS model_family FROM supplier""",
)

# --- lifts ----------------------------------------------------------------------------------------------

_PAIR = "name, condition, model_name, rmse_baseline, rmse_with_externals, rmse_lift_pct"
_PAIR_DIGITS = dict(rmse_baseline=3, rmse_with_externals=3, rmse_lift_pct=6)


def results(spark, sf):
    """Experiment results as the stored table they are: the pairings read it several times."""
    return io.written(fx.experiments(spark, sf), "experiments")


def calibrated(spark, sf):
    return lf.calibration_rows(results(spark, sf))


def labelled(spark, sf):
    return io.written(lf.source_pairs(calibrated(spark, sf)), "labelled-pairs")


def classified(spark, sf):
    return io.written(fx.classification_results(spark, sf), "classified")


register(
    "calib_filter",
    lambda s, d: calibrated(s, d).select("name", "condition", "model_name", "model_type", "rmse"),
    with_ctes("SELECT name, condition, model_name, model_type, rmse FROM calibration"), rmse=3,
)
register("baseline_ext_pair", lambda s, d: lf.paired(calibrated(s, d)),
         with_ctes(f"SELECT {_PAIR} FROM pairs"), **_PAIR_DIGITS)
register(
    "scope_semi", lambda s, d: lf.scope_semi(lf.paired(r := calibrated(s, d)), r, "seasonal"),
    with_ctes(f"""SELECT {_PAIR} FROM pairs WHERE (name, condition) IN
      (SELECT (name, condition) FROM calibration WHERE account_type = 'seasonal')"""),
    **_PAIR_DIGITS,
)
_LABELLED = """SELECT CASE condition WHEN 'C_short' THEN 'E_short_history' WHEN 'B_noisy' THEN 'D_noisy'
        WHEN 'sparse' THEN 'D_sparse' WHEN 'flat' THEN 'F_flat' WHEN 'C_level_shift_w70' THEN 'C_trending'
        WHEN 'A_clean' THEN 'A_regular_stable' WHEN 'irregular' THEN 'D_irregular' END AS account_category, * FROM pairs
      UNION ALL SELECT 'B_seasonal', * FROM pairs WHERE CAST(substr(name, 5) AS BIGINT) % 2 = 0"""
_MEDIANS = """SELECT account_category, model_name, median(rmse_with_externals) AS rmse_with_externals,
        median(rmse_lift_pct) AS lift_med FROM labelled GROUP BY 1, 2"""
_CHAMPS = """SELECT account_category, arg_min(model_name, (rmse_with_externals, model_name)) AS champion_model,
        arg_min(lift_med, (rmse_with_externals, model_name)) AS lift_med FROM medians GROUP BY 1"""
_DERIVE = dict(labelled=_LABELLED, medians=_MEDIANS, champs=_CHAMPS)
register(
    "lift_median_by_model", lambda s, d: lf.lift_medians(labelled(s, d)),
    with_ctes("SELECT account_category, model_name, rmse_with_externals, lift_med FROM medians", **_DERIVE),
    rmse_with_externals=3, lift_med=6,
)
register(
    "champion_model",
    lambda s, d: lf.champion_models(lf.lift_medians(labelled(s, d))),
    with_ctes("SELECT account_category, champion_model, lift_med FROM champs", **_DERIVE), lift_med=6,
)
register(
    "n_accounts_distinct", lambda s, d: lf.source_accounts(labelled(s, d)),
    with_ctes("""SELECT account_category, CAST(count(DISTINCT name) AS BIGINT) AS n_accounts FROM labelled
      GROUP BY account_category""", **_DERIVE),
)
register(
    "policy_derive", lambda s, d: lf.derive_policy(results(s, d), min_lift_pct=2.0),
    with_ctes(f"""SELECT b.account_category, lift_med >= 2.0 AS activate_externals, champion_model, rule_id AS policy_rule_id,
      source_exp, round(lift_med, 2) AS lift_med_champion_pct, n_accounts, 'v7_encapsulated' AS policy_source
      FROM {_BUILTIN} JOIN champs AS c ON c.account_category = b.account_category
      JOIN (SELECT account_category, CAST(count(DISTINCT name) AS BIGINT) AS n_accounts FROM labelled GROUP BY 1) AS n
        ON n.account_category = b.account_category
      JOIN (VALUES ('E_short_history', 'EXP1_C_short'), ('D_noisy', 'EXP1_B_noisy'), ('B_seasonal', 'EXP3_seasonal'),
        ('D_sparse', 'EXP6_sparse'), ('F_flat', 'EXP6_flat'), ('C_trending', 'EXP2_C_level_shift'),
        ('A_regular_stable', 'EXP1_A_clean'), ('D_irregular', 'EXP3_irregular')) AS e(category, source_exp)
        ON e.category = b.account_category""", **_DERIVE),
    lift_med_champion_pct=4,
)
register(
    "exact_median",
    lambda s, d: exact_median(
        fx.table(s, d, "lineitem").select("l_returnflag", "l_quantity"), ["l_returnflag"],
        "l_quantity", "median_quantity"),
    "SELECT l_returnflag, median(l_quantity) AS median_quantity FROM lineitem GROUP BY l_returnflag",
    median_quantity=4,
)


def irregular(spark, sf):
    return lf.irregular_lifts(fx.regression_lifts(spark, sf))


register(
    "parse_notes",
    lambda s, d: fx.regression_lifts(s, d).select(
        "name", "condition", "model_name", C.number_from_notes(F.col("notes")).alias("reg")),
    with_ctes("""SELECT name, condition, model_name,
      TRY_CAST(nullif(regexp_extract(notes, 'reg=([0-9.]+)', 1), '') AS DOUBLE) AS reg FROM lifts"""),
    reg=4,
)
register(
    "lift_filter",
    lambda s, d: irregular(s, d).where("cv_bucket IS NOT NULL").select(
        "name", "sector", "reg", "cv_bucket", "rmse_lift_pct"),
    with_ctes("SELECT name, sector, reg, cv_bucket, rmse_lift_pct FROM irregular WHERE cv_bucket IS NOT NULL"),
    reg=4, rmse_lift_pct=6,
)
register(
    "sector_cv_lookup", lambda s, d: lf.sector_cv_lookup(irregular(s, d)),
    with_ctes("""SELECT sector, cv_bucket,
      CASE cv_bucket WHEN '<0.30' THEN 0.0 WHEN '[0.30,0.50)' THEN 0.3 WHEN '[0.50,0.80)' THEN 0.5 ELSE 0.8 END AS cv_low,
      CASE cv_bucket WHEN '<0.30' THEN 0.3 WHEN '[0.30,0.50)' THEN 0.5 WHEN '[0.50,0.80)' THEN 0.8 ELSE 9.99 END AS cv_high,
      CAST(count(*) AS BIGINT) AS n_accounts, round(avg(rmse_lift_pct), 4) AS mean_rmse_lift_pct,
      round(avg(CASE WHEN rmse_lift_pct > 0 THEN 1.0 ELSE 0.0 END), 4) AS pct_positive,
      coalesce(avg(rmse_lift_pct) > 0, false) AND avg(CASE WHEN rmse_lift_pct > 0 THEN 1.0 ELSE 0.0 END) >= 0.5
        AS use_externals_regression, false AS use_externals_classification
      FROM irregular WHERE cv_bucket IS NOT NULL GROUP BY sector, cv_bucket"""),
    cv_low=3, cv_high=3, mean_rmse_lift_pct=4, pct_positive=4,
)
register(
    "oracle_regression", lambda s, d: lf.regression_oracle(irregular(s, d)),
    with_ctes("""SELECT name AS experiment_account, sector, reg, cv_bucket, rmse_lift_pct,
      coalesce(rmse_lift_pct > 0, false) AS use_externals_regression, 'oracle_lift_gt_0' AS policy_source FROM irregular"""),
    reg=4, rmse_lift_pct=6,
)
register(
    "rule_evaluation", lambda s, d: lf.rule_evaluation(irregular(s, d), PRIORITY),
    with_ctes("""SELECT CAST(count(*) FILTER (r) AS BIGINT) AS on_n, CAST(count(*) FILTER (NOT r) AS BIGINT) AS off_n,
      avg(rmse_lift_pct) FILTER (r) AS on_mean_lift_pct, avg(rmse_lift_pct) FILTER (NOT r) AS off_mean_lift_pct,
      avg(w) FILTER (r) AS on_pct_positive, avg(w) FILTER (NOT r) AS off_pct_positive, avg(w) AS oracle_pct_positive
      FROM (SELECT rmse_lift_pct, CASE WHEN rmse_lift_pct > 0 THEN 1.0 ELSE 0.0 END AS w,
        sector IN ('transport', 'retail') OR (coalesce(reg, 0) >= 0.3 AND coalesce(reg, 0) < 0.5) AS r FROM irregular)"""),
    on_mean_lift_pct=6, off_mean_lift_pct=6, on_pct_positive=6, off_pct_positive=6, oracle_pct_positive=6,
)
_ACC = """SELECT b.name, b.sector, b.accuracy AS accuracy_baseline, e.accuracy AS accuracy_with_externals
      FROM clf_results AS b JOIN clf_results AS e ON b.name = e.name
      WHERE b.model_type = 'baseline' AND e.model_type = 'with_externals'"""
register("acc_pair", lambda s, d: lf.accuracy_pairs(classified(s, d)), with_ctes(_ACC),
         accuracy_baseline=6, accuracy_with_externals=6)
register(
    "oracle_classification", lambda s, d: lf.classification_oracle(classified(s, d)),
    with_ctes("""SELECT name AS experiment_account, sector, accuracy_baseline, accuracy_with_externals,
      accuracy_with_externals - accuracy_baseline AS accuracy_lift,
      accuracy_with_externals > accuracy_baseline AS use_externals_classification,
      'oracle_accuracy_lift_gt_0' AS policy_source FROM accs""", accs=_ACC),
    accuracy_baseline=6, accuracy_with_externals=6, accuracy_lift=6,
)
register(
    "key_intersection",
    lambda s, d: (r := classified(s, d)).where("model_type = 'baseline'").select("name")
    .intersect(r.where("model_type = 'with_externals'").select("name")),
    with_ctes("""SELECT name FROM clf_results WHERE model_type = 'baseline' INTERSECT
      SELECT name FROM clf_results WHERE model_type = 'with_externals'"""),
)
