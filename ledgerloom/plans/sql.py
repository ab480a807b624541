"""SQL building blocks of the oracles: the inputs, restated independently of the Spark code."""

from __future__ import annotations

import re

from ledgerloom.sources.fixtures import CONDITIONS, PERIODS, SECTORS, SUBSTITUTE, SYMBOLS


def element(names, index: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"list_extract([{listed}], CAST(({index}) % {len(names)} + 1 AS BIGINT))"


def values(rows) -> str:
    def lit(v) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


ACCOUNT = "PARTITION BY account_id ORDER BY week, sector"
MONDAY = "CAST(date_trunc('week', {}) AS DATE)"

CTES = {
    "tx": f"""SELECT printf('ACC_%05d', l_suppkey) AS account_id, l_shipdate AS op_ts,
        (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) * l_extendedprice * (1 - l_discount) AS amount,
        l_returnflag AS op_type, {element(SECTORS, 's_nationkey')} AS sector,
        CASE WHEN l_suppkey % 2 = 0 THEN 'seasonal' ELSE 'normal' END AS account_type
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "weekly": f"""SELECT account_id, {MONDAY.format('op_ts')} AS week, sector,
        sum(amount) AS total_amount, CAST(count(amount) AS BIGINT) AS transaction_count
      FROM tx GROUP BY ALL""",
    "smooth": f"""SELECT account_id, week, sector,
        avg(total_amount) OVER ({ACCOUNT} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS total_amount,
        transaction_count FROM weekly""",
    "mixed": "SELECT * FROM smooth UNION ALL BY NAME SELECT * FROM customer_weekly",
    "profiles": f"""SELECT printf('P_%08d', o_orderkey) AS account_id,
        {element(SECTORS, 'o_custkey')} AS sector,
        o_orderkey % 90 + 30 AS n_obs, o_orderkey % 401 AS total_transactions,
        o_totalprice AS total_cashflow,
        CAST(o_custkey % 11 AS DOUBLE) / 10.0 AS completeness_ratio,
        CAST(o_orderkey % 263 AS DOUBLE) / 100.0 AS cv_cashflow,
        CASE WHEN o_orderkey % 17 <> 0 THEN -CAST(o_orderkey % 97 AS DOUBLE) / 20.0 END AS adf_statistic,
        CASE WHEN o_orderkey % 19 = 0 THEN CAST('NaN' AS DOUBLE)
             WHEN o_orderkey % 23 <> 0 THEN CAST(o_orderkey % 29 AS DOUBLE) / 100.0 END AS adf_pvalue,
        CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_custkey % 101 AS DOUBLE) / 100.0 END AS acf_lag1,
        CAST(o_custkey % 61 AS DOUBLE) / 100.0 AS trend_strength,
        CAST(o_orderkey % 83 AS DOUBLE) / 82.0 AS seasonality_strength
      FROM orders""",
    "valid_profiles": """SELECT * FROM profiles WHERE adf_statistic IS NOT NULL
        AND adf_pvalue IS NOT NULL AND NOT isnan(adf_pvalue) AND acf_lag1 IS NOT NULL""",
    "scored": """SELECT *, 0.35 * predictability_score + 0.20 * stationarity_component
          + 0.20 * completeness_component + 0.15 * cashflow_component
          + 0.10 * transaction_component - cv_penalty AS composite_score
      FROM (SELECT *, 0.5 * autocorr_component + 0.25 * trend_component
          + 0.25 * seasonality_component AS predictability_score
        FROM (SELECT *,
          (1.0 - greatest(0.0, least(1.0, adf_pvalue))) * 100 AS stationarity_component,
          acf_lag1 * 100 AS autocorr_component, trend_strength * 50 AS trend_component,
          seasonality_strength * 50 AS seasonality_component,
          completeness_ratio * 100 AS completeness_component,
          CASE WHEN total_cashflow > 0 THEN 10 * log10(total_cashflow) ELSE 0.0 END AS cashflow_component,
          CASE WHEN total_transactions > 0 THEN 10 * log10(total_transactions) ELSE 0.0 END
            AS transaction_component,
          CASE WHEN cv_cashflow < 0.2 THEN (0.2 - cv_cashflow) * 50
               WHEN cv_cashflow > 2.0 THEN (cv_cashflow - 2.0) * 20 ELSE 0.0 END AS cv_penalty
        FROM valid_profiles))""",
    "days": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem)""",
    "periods": f"SELECT flag, CAST(a AS DATE) AS a, CAST(z AS DATE) AS z FROM (VALUES {values(PERIODS)}) AS p(flag, a, z)",
    "flagged": """SELECT day,
        CAST(EXISTS (SELECT 1 FROM periods WHERE flag = 'is_ramadan' AND day BETWEEN a AND z) AS INTEGER) AS is_ramadan,
        CAST(EXISTS (SELECT 1 FROM periods WHERE flag = 'is_eid_alfitr' AND day BETWEEN a AND z) AS INTEGER) AS is_eid_alfitr,
        CAST(month(day) = 1 AND week(day) = 1 AS INTEGER) AS is_new_year_week,
        CAST(dayofmonth(day) >= 26 AS INTEGER) AS is_month_end_week,
        CAST(month(day) IN (3, 6, 9, 12) AND dayofmonth(day) >= 25 AS INTEGER) AS is_quarter_end,
        CAST(month(day) IN (3, 6, 9, 12) AND dayofmonth(day) >= 24 AS INTEGER) AS is_tax_deadline_week,
        CAST(dayofmonth(day) BETWEEN 23 AND 27 AS INTEGER) AS is_payroll_week
      FROM days""",
    "calendar": f"""SELECT {MONDAY.format('day')} AS week, max(is_ramadan) AS is_ramadan,
        max(is_eid_alfitr) AS is_eid_alfitr, max(is_new_year_week) AS is_new_year_week,
        max(is_month_end_week) AS is_month_end_week, max(is_quarter_end) AS is_quarter_end,
        max(is_tax_deadline_week) AS is_tax_deadline_week, max(is_payroll_week) AS is_payroll_week
      FROM flagged GROUP BY 1""",
    "feeds": """SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS day,
        avg(o_totalprice) AS value FROM orders GROUP BY 1, 2""",
    "symbols": f"SELECT * FROM (VALUES {values(SYMBOLS)}) AS s(indicator, rnk, symbol)",
    "picked": """SELECT c.indicator, c.symbol,
        CASE WHEN c.rnk = 0 THEN 'yahoo' ELSE 'yahoo_fallback:' || c.symbol END AS source, day, value
      FROM feeds JOIN (SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY rnk) AS rn
        FROM symbols WHERE symbol IN (SELECT symbol FROM feeds)) AS c USING (symbol) WHERE c.rn = 1""",
    "picked_weekly": f"""SELECT indicator, {MONDAY.format('day')} AS week,
        arg_max(value, day) AS raw_value, min(source || ':' || symbol) AS source
      FROM picked GROUP BY 1, 2""",
    "substitute": f"""SELECT i.indicator, {MONDAY.format('day')} AS week, arg_max(value, day) AS raw_value
      FROM feeds CROSS JOIN (SELECT DISTINCT indicator FROM symbols) AS i
      WHERE symbol = '{SUBSTITUTE}' GROUP BY 1, 2""",
    "feed": """SELECT indicator, week, raw_value, source FROM picked_weekly UNION ALL
      SELECT indicator, week, raw_value, 'synthetic_fallback' FROM substitute
      WHERE indicator NOT IN (SELECT indicator FROM picked_weekly)""",
    "spine": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week
      FROM (SELECT min(week) AS lo, max(week) AS hi FROM feed)""",
    "aligned": """SELECT s.week, i.indicator, raw_value FROM spine AS s
      CROSS JOIN (SELECT DISTINCT indicator FROM symbols) AS i
      LEFT JOIN feed AS f ON f.week = s.week AND f.indicator = i.indicator""",
    "filled": """SELECT week, indicator, coalesce(
        last_value(raw_value IGNORE NULLS) OVER (PARTITION BY indicator ORDER BY week
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(raw_value IGNORE NULLS) OVER (PARTITION BY indicator ORDER BY week
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS raw_value FROM aligned""",
    "zscored": """SELECT week, indicator, (raw_value - m) / s AS z FROM filled
      JOIN (SELECT indicator, avg(raw_value) AS m, stddev_pop(raw_value) AS s FROM filled
        GROUP BY indicator) USING (indicator)""",
    "macro": """SELECT week, max(CASE WHEN indicator = 'oil_price_z' THEN z END) AS oil_price_z,
        max(CASE WHEN indicator = 'commodity_index_z' THEN z END) AS commodity_index_z,
        max(CASE WHEN indicator = 'masi_index_z' THEN z END) AS masi_index_z,
        max(CASE WHEN indicator = 'realestate_index_z' THEN z END) AS realestate_index_z
      FROM zscored GROUP BY week""",
    "experiments": f"""SELECT printf('ACC_%05d', l_suppkey) AS name,
        {element(CONDITIONS, 'l_partkey')} AS condition,
        CASE WHEN l_suppkey % 2 = 0 THEN 'seasonal' ELSE 'normal' END AS account_type,
        CASE l_returnflag WHEN 'A' THEN 'ridge' WHEN 'N' THEN 'rf' ELSE 'lgbm' END AS model_name,
        CASE l_linestatus WHEN 'F' THEN 'baseline' ELSE 'with_externals' END AS model_type,
        CASE WHEN l_suppkey % 10 = 9 THEN 'holdout' ELSE 'calibration' END AS experiment_role,
        stddev_samp(l_extendedprice) AS rmse,
        avg(CASE WHEN l_discount < 0.05 THEN 1.0 ELSE 0.0 END) AS share
      FROM lineitem GROUP BY ALL""",
    "calibration": "SELECT * FROM experiments WHERE experiment_role = 'calibration'",
    "pairs": """SELECT b.name, b.condition, b.model_name, b.rmse AS rmse_baseline,
        e.rmse AS rmse_with_externals, (b.rmse - e.rmse) / nullif(b.rmse, 0) * 100 AS rmse_lift_pct
      FROM calibration AS b JOIN calibration AS e
        ON b.name = e.name AND b.condition = e.condition AND b.model_name = e.model_name
      WHERE b.model_type = 'baseline' AND e.model_type = 'with_externals'""",
    "all_pairs": """SELECT b.name, b.condition, b.model_name, b.experiment_role, b.share,
        b.rmse AS baseline_rmse, e.rmse AS with_externals_rmse,
        (b.rmse - e.rmse) / nullif(b.rmse, 0) * 100 AS rmse_lift_pct
      FROM experiments AS b JOIN experiments AS e
        ON b.name = e.name AND b.condition = e.condition AND b.model_name = e.model_name
      WHERE b.model_type = 'baseline' AND e.model_type = 'with_externals'""",
    "lifts": f"""SELECT p.name, p.condition, p.model_name, {element(SECTORS, 's_nationkey')} AS sector,
        p.rmse_lift_pct, CASE WHEN share > 0.2
          THEN 'n=1;reg=' || CAST(floor(share * 100) / 100.0 AS VARCHAR) ELSE 'n/a' END AS notes
      FROM all_pairs AS p JOIN supplier ON printf('ACC_%05d', s_suppkey) = p.name""",
    "irregular": """SELECT *, CASE WHEN reg < 0.30 THEN '<0.30' WHEN reg < 0.50 THEN '[0.30,0.50)'
          WHEN reg < 0.80 THEN '[0.50,0.80)' WHEN reg >= 0.80 THEN '>=0.80' END AS cv_bucket
      FROM (SELECT *, TRY_CAST(nullif(regexp_extract(notes, 'reg=([0-9.]+)', 1), '') AS DOUBLE) AS reg
        FROM lifts WHERE condition = 'irregular' AND model_name = 'rf')""",
    "clf_results": f"""SELECT CAST(user_id AS VARCHAR) AS name, {element(SECTORS, 'user_id')} AS sector,
        CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'with_externals' END AS model_type,
        avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END) AS accuracy
      FROM events GROUP BY user_id, event_id % 2""",
    "customer_weekly": f"""SELECT printf('C_%06d', o_custkey) AS account_id,
        {MONDAY.format('o_orderdate')} AS week, {element(SECTORS, 'o_custkey')} AS sector,
        sum(o_totalprice) AS total_amount, CAST(count(o_totalprice) AS BIGINT) AS transaction_count
      FROM orders GROUP BY ALL""",
    "policy_raw": """SELECT printf('ACC_%05d', s_suppkey) AS account_id, s_suppkey % 2 = 0 AS use_reg,
        s_suppkey % 4 = 0 AS use_clf,
        CASE s_suppkey % 4 WHEN 0 THEN 'rf' WHEN 1 THEN 'ridge' WHEN 2 THEN 'lgbm' ELSE 'rf' END AS model,
        (s_suppkey // 2) % 3 AS keyset FROM supplier WHERE s_acctbal > 3000""",
    "mapping": """SELECT * FROM (VALUES
        ('agriculture', 'commodity_index_z', '', true, 1), ('transport', 'oil_price_z', '', true, 2),
        ('investment', 'masi_index_z', '', true, 3),
        ('construction', 'realestate_index_z', 'oil_price_z', true, 4),
        ('mixed', 'masi_index_z', 'oil_price_z', true, 5), ('retail', '', '', true, 6),
        ('transport', 'masi_index_z', 'oil_price_z', false, 9),
        ('*', 'oil_price_z', 'oil_price_z', false, 50)
      ) AS m(sector, macro_primary, macro_secondary, include_calendar, priority)""",
    "messy": f"""SELECT printf('ACC_%05d', s_suppkey) AS account_id,
        CASE WHEN s_suppkey % 2 = 0 THEN ' ' || upper({element(SECTORS, 's_nationkey')}) || ' '
             ELSE {element(SECTORS, 's_nationkey')} END AS sector FROM supplier""",
    "cells": f"""SELECT sector, cv_bucket, max(n) % 2 = 0 AS cell_reg, min(n) % 3 = 0 AS cell_clf FROM (
        SELECT {element(SECTORS, 'n_regionkey')} AS sector, n_nationkey AS n,
          CASE WHEN n_nationkey % 10 < 3 THEN '<0.30' WHEN n_nationkey % 10 < 5 THEN '[0.30,0.50)'
            WHEN n_nationkey % 10 < 8 THEN '[0.50,0.80)' ELSE '>=0.80' END AS cv_bucket
        FROM nation) GROUP BY ALL""",
    "profile_cells": """SELECT sector, cv_bucket, t > 0.3 AS cell_reg, t <= 0.3 AS cell_clf FROM (
        SELECT sector, CASE WHEN cv_cashflow < 0.30 THEN '<0.30' WHEN cv_cashflow < 0.50 THEN '[0.30,0.50)'
            WHEN cv_cashflow < 0.80 THEN '[0.50,0.80)' ELSE '>=0.80' END AS cv_bucket,
          avg(trend_strength) AS t FROM profiles GROUP BY 1, 2)""",
    "items": f"""SELECT printf('P_%08d', l_orderkey) AS account_id, {element(SECTORS, 'max(l_suppkey)')} AS sector,
        count(*) AS n_items, sum(l_linenumber) AS n_parts FROM lineitem GROUP BY l_orderkey""",
    "categorised": """SELECT *, CASE
          WHEN n_obs < 52 THEN 'E_short_history' WHEN cv_cashflow > 1.0 THEN 'D_sparse'
          WHEN trend_strength < 0.02 AND cv_cashflow < 0.40 THEN 'F_flat'
          WHEN seasonality_strength > 0.60 AND acf_lag1 >= 0.30 AND cv_cashflow < 1.0
            AND trend_strength < 0.50 THEN 'B_seasonal'
          WHEN trend_strength >= 0.12 THEN 'C_trending'
          WHEN cv_cashflow < 0.45 AND greatest(0.0, least(1.0, acf_lag1 * 0.5
            + greatest(0.0, 1.0 - least(cv_cashflow, 2.0) / 2.0) * 0.5)) >= 0.55 THEN 'A_regular_stable'
          WHEN cv_cashflow >= 0.50 AND trend_strength < 0.12 THEN 'D_noisy'
          ELSE 'D_irregular' END AS account_category FROM scored""",
}


def with_ctes(body: str, **extra: str) -> str:
    """Prefix ``body`` with the CTEs it names, directly or through others."""
    known = {**CTES, **extra}
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                seen.add(name)  # before descending: a recursive CTE names itself
                visit(known[name])
                order.append(name)

    visit(body)
    listed = ",\n".join(f"{n} AS (\n      {known[n]})" for n in order)
    return f"WITH {listed}\n{body}" if order else body
