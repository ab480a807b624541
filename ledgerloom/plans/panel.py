"""Queries over the weekly panel: sources, sinks, aggregates, windows, metrics, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions import columns as C
from ledgerloom.functions.aggregates import keep_one
from ledgerloom.functions.literals import literal_table
from ledgerloom.operators import calendar as cal
from ledgerloom.operators import features as feat
from ledgerloom.operators import quality as q
from ledgerloom.operators import tsmetrics as ts
from ledgerloom.operators import weekly as wk
from ledgerloom.plans.registry import register
from ledgerloom.plans.sql import ACCOUNT, MONDAY, with_ctes
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources import io

PANEL = "account_id, week, sector, total_amount, transaction_count"
KEYS = ("account_id", "week", "sector")


# --- sources and sinks ------------------------------------------------------------------------------

def _through_table(panel: DataFrame, name: str) -> DataFrame:
    spark = panel.sparkSession
    path = io.scratch_path(spark, name)
    table = f"{name}_{path[-12:]}"
    io.write_table(panel, table, path)
    return io.read_table(spark, table)


def _src_table(spark, sf):
    return _through_table(fx.weekly(spark, sf), "weekly_cashflow_account")


def _snk_table(spark, sf):
    return _through_table(fx.weekly_smooth(spark, sf), "weekly_smooth")


def _snk_path(spark, sf):
    panel = fx.weekly(spark, sf)
    parts = []
    for fmt in ("orc", "parquet"):
        path = io.scratch_path(spark, f"panel-{fmt}")
        io.write_path(panel, path, fmt)
        back = spark.read.format(fmt).schema(S.WEEKLY).load(path)
        parts.append(back.withColumn("file_format", F.lit(fmt)))
    return parts[0].unionByName(parts[1])


def _src_csv(spark, sf):
    path = io.scratch_path(spark, "panel-csv")
    io.write_csv(fx.weekly(spark, sf), path)
    return io.read_csv(spark, path, S.WEEKLY)


def _src_csv_parts(spark, sf):
    path = io.scratch_path(spark, "panel-csv-parts")
    io.write_csv(fx.weekly_smooth(spark, sf), path)
    return io.read_csv(spark, path, S.WEEKLY)


def _snk_csv(spark, sf):
    path = io.scratch_path(spark, "stats-csv")
    stats = wk.account_stats(fx.weekly(spark, sf)).select("account_id", "sector", "n_obs")
    io.write_csv(stats, path)
    return spark.read.option("header", True).schema(stats.schema).csv(path)


def _snk_partitioned(spark, sf):
    """All years are written, then 1996 again with doubled amounts: the other years must stay."""
    path = io.scratch_path(spark, "panel-by-year")
    panel = fx.weekly(spark, sf).withColumn("dt", F.year("week"))
    io.write_path(panel, path, "parquet", "dt")
    redo = panel.where(F.col("dt") == 1996).withColumn("total_amount", F.col("total_amount") * 2)
    io.write_path(redo, path, "parquet", "dt")
    return spark.read.parquet(path).select(*S.WEEKLY.fieldNames(), F.col("dt").cast("int").alias("dt"))


_WEEKLY = with_ctes(f"SELECT {PANEL} FROM weekly")
_SMOOTH = with_ctes(f"SELECT {PANEL} FROM smooth")
register("src_table", _src_table, _WEEKLY, total_amount=4)
register("src_csv", _src_csv, _WEEKLY, total_amount=4)
register("src_csv_parts", _src_csv_parts, _SMOOTH, total_amount=6)
register("snk_table", _snk_table, _SMOOTH, total_amount=6)
register(
    "snk_path", _snk_path,
    with_ctes(f"SELECT {PANEL}, file_format FROM weekly CROSS JOIN (VALUES ('orc'), ('parquet')) AS f(file_format)"),
    total_amount=4,
)
register(
    "snk_csv", _snk_csv,
    with_ctes("""SELECT account_id, arg_min(sector, (week, sector)) AS sector,
      CAST(count(total_amount) AS BIGINT) AS n_obs FROM weekly GROUP BY account_id"""),
)
register(
    "snk_partitioned", _snk_partitioned,
    with_ctes("""SELECT account_id, week, sector, CASE WHEN year(week) = 1996 THEN 2 ELSE 1 END * total_amount
      AS total_amount, transaction_count, CAST(year(week) AS INTEGER) AS dt FROM weekly"""),
    total_amount=4,
)


def _schema_catalog(spark, sf):
    """Every column as text, some not numbers, conformed to the declared panel schema."""
    text = fx.weekly(spark, sf).select(
        "account_id", F.col("week").cast("string").alias("week"), "sector",
        F.when(F.col("transaction_count") == 3, "n/a")
        .otherwise(F.col("total_amount").cast("string")).alias("total_amount"),
        F.col("transaction_count").cast("string").alias("transaction_count"),
    )
    return S.conform(text, S.WEEKLY)


register(
    "schema_catalog", _schema_catalog,
    with_ctes("""SELECT account_id, week, sector,
      CASE WHEN transaction_count <> 3 THEN total_amount END AS total_amount, transaction_count FROM weekly"""),
    total_amount=4,
)


def _bronze_conform(spark, sf):
    raw = fx.transactions(spark, sf)
    bad = F.dayofmonth("op_ts") == 13
    text = raw.withColumns({
        "op_ts": F.when(bad, "not a date").otherwise(F.date_format("op_ts", "yyyy-MM-dd HH:mm:ss")),
        "amount": F.when(F.dayofmonth("op_ts") == 14, "").otherwise(F.col("amount").cast("string")),
    })
    out = S.conform(text, S.TRANSACTIONS)
    return out.select(
        "account_id", F.to_date("op_ts").alias("op_date"), "amount", "op_type", "sector",
        "account_type",
    )


register(
    "bronze_conform", _bronze_conform,
    with_ctes("""SELECT account_id, CASE WHEN dayofmonth(op_ts) <> 13 THEN CAST(op_ts AS DATE) END AS op_date,
      CASE WHEN dayofmonth(op_ts) <> 14 THEN amount END AS amount, op_type, sector, account_type FROM tx"""),
    amount=4,
)

# --- aggregates and filters --------------------------------------------------------------------------


def stats_sql(panel: str) -> str:
    return f"""SELECT account_id, CAST(count(total_amount) AS BIGINT) AS n_obs,
        CAST(sum(transaction_count) AS BIGINT) AS total_transactions,
        sum(abs(total_amount)) AS total_cashflow, avg(abs(total_amount)) AS mean_cashflow,
        stddev_samp(total_amount) AS std_cashflow,
        sum(CASE WHEN total_amount <> 0 THEN 1.0 WHEN total_amount = 0 THEN 0.0 END) AS non_zero_periods,
        arg_min(sector, (week, sector)) AS sector,
        sum(CASE WHEN total_amount <> 0 THEN 1.0 ELSE 0.0 END) / nullif(count(total_amount), 0) AS completeness_ratio,
        stddev_samp(total_amount) / nullif(avg(abs(total_amount)), 0) AS cv_cashflow
      FROM {panel} GROUP BY account_id"""


STATS_DIGITS = dict(
    total_cashflow=6, mean_cashflow=3, std_cashflow=3, non_zero_periods=1, completeness_ratio=6,
    cv_cashflow=6,
)
ELIGIBLE = f"SELECT * FROM ({stats_sql('mixed')}) WHERE n_obs >= 24 AND std_cashflow >= 1e-8"

register("weekly_cashflow", lambda s, d: wk.weekly_cashflow(fx.transactions(s, d)), _WEEKLY,
         total_amount=4)
register("weekly_cashflow_eager", fx.weekly, _WEEKLY, total_amount=4)
register("account_stats", lambda s, d: wk.account_stats(fx.weekly_mixed(s, d)),
         with_ctes(stats_sql("mixed")), **STATS_DIGITS)
register("eligibility", lambda s, d: wk.eligible_accounts(wk.account_stats(fx.weekly_mixed(s, d))),
         with_ctes(ELIGIBLE), **STATS_DIGITS)
register(
    "semi_eligible",
    lambda s, d: wk.restrict_to(
        p := io.written(fx.weekly_mixed(s, d), "mixed"), wk.eligible_accounts(wk.account_stats(p))
    ).select(*KEYS, "total_amount"),
    with_ctes("""SELECT account_id, week, sector, total_amount FROM mixed
      WHERE account_id IN (SELECT account_id FROM eligible)""", eligible=ELIGIBLE),
    total_amount=6,
)
for _key, _min in (("min_history_train", 18), ("min_history_score", 5)):
    register(
        _key,
        lambda s, d, n=_min: wk.with_min_history(fx.customer_weekly(s, d), n).select(
            *KEYS, "total_amount", "n_rows"
        ),
        with_ctes(f"""SELECT * FROM (SELECT account_id, week, sector, total_amount,
          CAST(count(*) OVER (PARTITION BY account_id) AS BIGINT) AS n_rows FROM customer_weekly)
          WHERE n_rows >= {_min}"""),
        total_amount=2,
    )
register("week_sort", lambda s, d: wk.week_sort(fx.weekly_smooth(s, d)), _SMOOTH, total_amount=6)
register(
    "latest_week", lambda s, d: wk.latest_week(fx.weekly(s, d)),
    with_ctes(f"""SELECT {PANEL} FROM (SELECT *, row_number() OVER (PARTITION BY account_id
      ORDER BY week DESC, sector DESC) AS rn FROM weekly) WHERE rn = 1"""),
    total_amount=4,
)
register(
    "last_n_weeks", lambda s, d: wk.last_n_weeks(io.written(fx.weekly(s, d), "weekly"), 20),
    with_ctes(f"""SELECT {PANEL} FROM weekly WHERE week IN
      (SELECT DISTINCT week FROM weekly ORDER BY week DESC LIMIT 20)"""),
    total_amount=4,
)
_ONE = ("account_id", "op_date", "op_type", "amount")


def _dedup(which: str):
    def run(spark, sf):
        tx = fx.transactions(spark, sf).select(
            "account_id", F.to_date("op_ts").alias("op_date"), "op_type", "amount"
        )
        return keep_one(tx, ["account_id"], ["op_date", "op_type", "amount"], which)

    return run


for _which, _dir in (("first", "ASC"), ("last", "DESC")):
    register(
        f"dedup_{_which}", _dedup(_which),
        with_ctes(f"""SELECT {', '.join(_ONE)} FROM (SELECT account_id, CAST(op_ts AS DATE) AS op_date, op_type,
          amount, row_number() OVER (PARTITION BY account_id ORDER BY CAST(op_ts AS DATE) {_dir},
          op_type {_dir}, amount {_dir}) AS rn FROM tx) WHERE rn = 1"""),
        amount=4,
    )
register(
    "latest_run",
    lambda s, d: _latest_run(io.written(fx.weekly(s, d), "weekly")),
    with_ctes(f"""SELECT {PANEL}, strftime(week, '%Y%m') AS run_stamp FROM weekly
      WHERE strftime(week, '%Y%m') = (SELECT max(strftime(week, '%Y%m')) FROM weekly)"""),
    total_amount=4,
)


def _latest_run(panel: DataFrame) -> DataFrame:
    from ledgerloom.operators.scoring import latest_run

    return latest_run(panel.withColumn("run_stamp", F.date_format("week", "yyyyMM")))


register(
    "concat",
    lambda s, d: (t := fx.transactions(s, d).select("account_id", "account_type", "amount"))
    .where("account_type = 'seasonal'")
    .unionByName(t.where("account_type = 'normal'").select("amount", "account_type", "account_id")),
    with_ctes("SELECT account_id, account_type, amount FROM tx"), amount=4,
)

# --- windows -------------------------------------------------------------------------------------------


def _rolling(*columns: str):
    def run(spark, sf):
        return feat.rolling_features(fx.weekly(spark, sf)).select(*KEYS, *columns)

    return run


_LAG = f"""SELECT account_id, week, sector, lag(total_amount) OVER ({ACCOUNT}) AS prev FROM weekly"""


def _over(n: int) -> str:
    return f"OVER ({ACCOUNT} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _window_sql(select: str) -> str:
    return with_ctes(f"SELECT account_id, week, sector, {select} FROM lagged", lagged=_LAG)


_NEG = "CASE WHEN prev < 0 THEN 1 ELSE 0 END"
_POS = "CASE WHEN prev > 0 THEN 1 ELSE 0 END"
_SIGN = "CASE WHEN prev > 0 THEN 1 WHEN prev < 0 THEN -1 ELSE 0 END"
ROLLING_SQL = {
    "negative_count_4w": f"CAST(sum({_NEG}) {_over(4)} AS BIGINT)",
    "negative_count_8w": f"CAST(sum({_NEG}) {_over(8)} AS BIGINT)",
    "prop_positive_24w": f"avg({_POS}) {_over(24)}",
    "sign_streak_8": f"CAST(sum({_SIGN}) {_over(8)} AS BIGINT)",
    "rolling_max_8w": f"max(prev) {_over(8)}",
    "rolling_min_8w": f"min(prev) {_over(8)}",
    "volatility_4w": f"stddev_samp(prev) {_over(4)}",
}


def _rolled(*names: str) -> str:
    return _window_sql(", ".join(f"{ROLLING_SQL[n]} AS {n}" for n in names))


register(
    "lag1_signs",
    lambda s, d: feat.lag1_signs(fx.weekly(s, d)).select(
        *KEYS, F.col("_lag1").alias("lag1"), F.col("_lag1_pos").alias("lag1_pos"),
        F.col("_lag1_neg").alias("lag1_neg"), F.col("_lag1_sign").alias("lag1_sign"),
    ),
    _window_sql(f"prev AS lag1, {_POS} AS lag1_pos, {_NEG} AS lag1_neg, {_SIGN} AS lag1_sign"),
    lag1=4,
)
register("roll_negative_count", _rolling("negative_count_4w", "negative_count_8w"),
         _rolled("negative_count_4w", "negative_count_8w"))
register("roll_prop_positive", _rolling("prop_positive_24w"), _rolled("prop_positive_24w"),
         prop_positive_24w=8)
register("sign_streak", _rolling("sign_streak_8"), _rolled("sign_streak_8"))
register("roll_max_min", _rolling("rolling_max_8w", "rolling_min_8w"),
         _rolled("rolling_max_8w", "rolling_min_8w"), rolling_max_8w=4, rolling_min_8w=4)
register("roll_volatility", _rolling("volatility_4w"), _rolled("volatility_4w"), volatility_4w=3)

# --- scalar features --------------------------------------------------------------------------------

register(
    "date_parts",
    lambda s, d: fx.table(s, d, "lineitem").select(
        F.to_date("l_shipdate").alias("day"), C.monday(F.col("l_shipdate")).alias("week"),
        F.month("l_shipdate").alias("month"), F.weekofyear("l_shipdate").alias("week_num"),
        F.date_add(C.monday(F.col("l_shipdate")), 7).alias("next_week"),
    ).distinct(),
    f"""SELECT DISTINCT CAST(l_shipdate AS DATE) AS day, {MONDAY.format('l_shipdate')} AS week,
      CAST(month(l_shipdate) AS INTEGER) AS month, CAST(week(l_shipdate) AS INTEGER) AS week_num,
      CAST({MONDAY.format('l_shipdate')} + INTERVAL 7 DAY AS DATE) AS next_week FROM lineitem""",
)
_FLAGS = ", ".join(S.CALENDAR_FLAGS)
register("calendar_flags", lambda s, d: cal.daily_flags(fx.days(s, d), fx.PERIODS),
         with_ctes("SELECT * FROM flagged"))
register("holiday_range_join", lambda s, d: cal.holiday_flags(fx.days(s, d), fx.PERIODS),
         with_ctes("SELECT day, is_ramadan, is_eid_alfitr FROM flagged"))
register("calendar_weekly", fx.calendar, with_ctes(f"SELECT week, {_FLAGS} FROM calendar"))
register(
    "calendar_join",
    lambda s, d: cal.calendar_join(fx.weekly(s, d), fx.calendar(s, d)).select(*KEYS, *S.CALENDAR_FLAGS),
    with_ctes(f"SELECT account_id, w.week, sector, {_FLAGS} FROM weekly AS w LEFT JOIN calendar AS c ON w.week = c.week"),
)
HARMONICS = """CAST(month(week) AS INTEGER) AS month, CAST(week(week) AS INTEGER) AS week_num,
      sin(2 * pi() * week(week) / 52) AS week_sin, cos(2 * pi() * week(week) / 52) AS week_cos,
      sin(4 * pi() * week(week) / 52) AS week_sin_2h, cos(4 * pi() * week(week) / 52) AS week_cos_2h"""
WAVE_DIGITS = dict(week_sin=9, week_cos=9, week_sin_2h=9, week_cos_2h=9)
register(
    "seasonal_harmonics",
    lambda s, d: cal.seasonal_features(fx.weekly(s, d)).drop("total_amount", "transaction_count"),
    with_ctes(f"SELECT account_id, week, sector, {HARMONICS} FROM weekly"), **WAVE_DIGITS,
)
register(
    "finite_guard",
    lambda s, d: fx.metric_profiles(s, d).select(
        "account_id", C.finite_or_zero(
            F.when(F.col("n_obs") == 47, float("-inf")).otherwise(F.col("adf_pvalue"))
        ).alias("guarded"),
    ),
    with_ctes("""SELECT account_id, CASE WHEN n_obs = 47 OR adf_pvalue IS NULL OR isnan(adf_pvalue)
      THEN 0.0 ELSE adf_pvalue END AS guarded FROM profiles"""),
    guarded=6,
)

# --- time-series metrics ------------------------------------------------------------------------------

METRICS_SQL = {
    "idx": f"""SELECT account_id, week, sector, total_amount AS x,
        row_number() OVER ({ACCOUNT}) - 1 AS i, count(*) OVER (PARTITION BY account_id) AS n,
        avg(total_amount) OVER (PARTITION BY account_id) AS m FROM mixed""",
    "acfs": """SELECT a.account_id, max(a.n) AS n,
        CASE WHEN max(a.n) >= 8 THEN sum((a.x - a.m) * (b.x - a.m)) / nullif(sum((a.x - a.m) * (a.x - a.m)), 0) END AS r1,
        CASE WHEN max(a.n) >= 8 THEN sum((a.x - a.m) * (c.x - a.m)) / nullif(sum((a.x - a.m) * (a.x - a.m)), 0) END AS r2
      FROM idx AS a LEFT JOIN idx AS b ON a.account_id = b.account_id AND a.i = b.i + 1
      LEFT JOIN idx AS c ON a.account_id = c.account_id AND a.i = c.i + 2 GROUP BY a.account_id""",
    "seasons": """SELECT a.account_id, CASE WHEN count(*) > 1 THEN abs(covar_pop(a.x, b.x)
        / nullif(stddev_pop(a.x) * stddev_pop(b.x), 0)) END AS s
      FROM idx AS a JOIN idx AS b ON a.account_id = b.account_id
        AND b.i = a.i - CASE WHEN a.n > 52 THEN 52 ELSE a.n // 2 END GROUP BY a.account_id""",
    "diffs": """SELECT account_id, x - prev AS dx, prev FROM (SELECT *, lag(x) OVER
        (PARTITION BY account_id ORDER BY i) AS prev FROM idx) WHERE prev IS NOT NULL""",
}


def _metrics(body: str) -> str:
    return with_ctes(body, **METRICS_SQL)


register("ts_acf", lambda s, d: ts.ts_acf(fx.weekly_mixed(s, d)),
         _metrics("SELECT account_id, r1 AS acf_lag1, r2 AS acf_lag2 FROM acfs"), acf_lag1=7, acf_lag2=7)
register("ts_pacf", lambda s, d: ts.ts_pacf(fx.weekly_mixed(s, d)),
         _metrics("SELECT account_id, r1 * n / (n - 1) AS pacf_lag1 FROM acfs"), pacf_lag1=7)
register("ts_trend", lambda s, d: ts.ts_trend(fx.weekly_mixed(s, d)),
         _metrics("SELECT account_id, CASE WHEN count(x) > 1 THEN CASE WHEN var_pop(x) = 0 THEN 0.0 ELSE regr_r2(x, i) END END AS trend_strength FROM idx GROUP BY account_id"),
         trend_strength=7)
register(
    "ts_seasonality", lambda s, d: ts.ts_seasonality(fx.weekly_mixed(s, d)),
    _metrics("""SELECT DISTINCT i.account_id, s AS seasonality_strength FROM idx AS i
      LEFT JOIN seasons AS z ON i.account_id = z.account_id"""),
    seasonality_strength=7,
)
register(
    "ts_df0", lambda s, d: ts.ts_df0(fx.weekly_mixed(s, d)),
    _metrics("""SELECT i.account_id, CASE WHEN m > 2 THEN b / sqrt((syy - b * sxy) / (m - 2) / sxx) END AS df_statistic
      FROM (SELECT DISTINCT account_id FROM idx) AS i LEFT JOIN (
        SELECT account_id, count(*) AS m, regr_slope(dx, prev) AS b, regr_sxx(dx, prev) AS sxx,
          regr_sxy(dx, prev) AS sxy, regr_syy(dx, prev) AS syy FROM diffs GROUP BY account_id) AS d
      ON d.account_id = i.account_id"""),
    df_statistic=4,
)


def _design_sql(lags: str, level_first: bool) -> str:
    """Regression cells (account_id, i, c, v): constant, level and lagged differences, then the response last.

    The constant is column 0. The level is column 1, or the last one before the response.
    """
    level, lag = ("1", "j + 1") if level_first else (f"{lags} + 1", "j")
    sample = f"d.i > {lags}"
    return f"""SELECT account_id, i, 0 AS c, 1.0 AS v FROM steps AS d WHERE {sample}
      UNION ALL SELECT account_id, i, {level}, prev FROM steps AS d WHERE {sample}
      UNION ALL SELECT account_id, i, {lags} + 2, dz FROM steps AS d WHERE {sample}
      UNION ALL SELECT d.account_id, d.i, {lag}, e.dz FROM steps AS d CROSS JOIN (SELECT unnest(range(1, 40)) AS j) AS k
        JOIN steps AS e ON e.account_id = d.account_id AND e.i = d.i - j WHERE {sample} AND j <= {lags}"""


def _moments_sql(cells: str) -> str:
    return f"""SELECT a.account_id, CAST(0 AS BIGINT) AS step, CAST(a.c AS BIGINT) AS p, CAST(b.c AS BIGINT) AS q, sum(a.v * b.v) AS v
      FROM {cells} AS a JOIN {cells} AS b ON a.account_id = b.account_id AND a.i = b.i GROUP BY a.account_id, a.c, b.c"""


def _eliminated_sql(moments: str, name: str) -> str:
    """Gaussian elimination, one column a step: the corner that is left holds the residual moments."""
    return f"""SELECT * FROM {moments} UNION ALL
      SELECT e.account_id, e.step + 1, e.p, e.q, e.v - l.v * u.v / d.v FROM {name} AS e
      JOIN {name} AS l ON l.account_id = e.account_id AND l.p = e.p AND l.q = e.step
      JOIN {name} AS u ON u.account_id = e.account_id AND u.p = e.step AND u.q = e.q
      JOIN {name} AS d ON d.account_id = e.account_id AND d.p = e.step AND d.q = e.step
      WHERE e.p > e.step AND e.q > e.step"""


def _surface(coefficients) -> str:
    return " + ".join(f"({c!r}) * power(tau, {k})" for k, c in enumerate(coefficients))


ADF_SQL = {
    "series_of": """SELECT account_id, n, CAST(least(ceil(12.0 * power(n / 100.0, 0.25)), n // 2 - 2) AS BIGINT) AS most,
        avg(x) AS mu, stddev_pop(x) AS sd FROM idx GROUP BY account_id, n HAVING max(x) > min(x) AND count(x) = n AND n >= 4""",
    "steps": """SELECT account_id, i, z - prev AS dz, prev, n, most, best FROM (
        SELECT i.account_id, i.i, (x - mu) / sd AS z, lag((x - mu) / sd) OVER (PARTITION BY i.account_id ORDER BY i.i) AS prev,
          s.n, most, 0 AS best FROM idx AS i JOIN series_of AS s ON s.account_id = i.account_id) WHERE prev IS NOT NULL""",
    "wide_cells": _design_sql("d.most", True),
    "wide_moments": _moments_sql("wide_cells"),
    "wide_left": _eliminated_sql("wide_moments", "wide_left"),
    "chosen": """SELECT s.account_id, s.n, arg_min(step - 2, (n - 1 - most) * ln(v / (n - 1 - most)) + 2 * step) AS lags
      FROM wide_left AS w JOIN series_of AS s ON s.account_id = w.account_id
      WHERE p = most + 2 AND q = most + 2 AND step >= 2 GROUP BY s.account_id, s.n""",
    "steps_chosen": "SELECT s.account_id, i, dz, prev, lags FROM steps AS s JOIN chosen AS c ON c.account_id = s.account_id",
    "cells": _design_sql("d.lags", False).replace("FROM steps AS d", "FROM steps_chosen AS d"),
    "cell_moments": _moments_sql("cells"),
    "cell_left": _eliminated_sql("cell_moments", "cell_left"),
    "taus": """SELECT account_id, xy / xx / sqrt((yy - xy * xy / xx) / (n - 3 - 2 * lags) / xx) AS tau FROM (
        SELECT c.account_id, any_value(n) AS n, any_value(lags) AS lags, max(v) FILTER (p = lags + 1 AND q = lags + 1) AS xx,
          max(v) FILTER (p = lags + 1 AND q = lags + 2) AS xy, max(v) FILTER (p = lags + 2 AND q = lags + 2) AS yy
        FROM cell_left AS e JOIN chosen AS c ON c.account_id = e.account_id AND e.step = c.lags + 1 GROUP BY c.account_id)""",
    # The normal distribution function by Simpson's rule.
    "tested": f"""SELECT account_id, tau, CASE WHEN tau > {ts.ADF_TAU_MAX} THEN 1.0 WHEN tau < {ts.ADF_TAU_MIN} THEN 0.0
        ELSE 0.5 + y / 400 / 3 / sqrt(2 * pi()) * list_sum(list_transform(range(0, 401),
          lambda k: CASE WHEN k IN (0, 400) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * exp(-0.5 * power(y * k / 400, 2)))) END AS p_value
      FROM (SELECT *, CASE WHEN tau <= {ts.ADF_TAU_STAR} THEN {_surface(ts.ADF_SMALL_P)} ELSE {_surface(ts.ADF_LARGE_P)} END AS y FROM taus)""",
}


def _adf(body: str) -> str:
    return with_ctes(body, **METRICS_SQL, **ADF_SQL).replace("WITH ", "WITH RECURSIVE ", 1)


def _held(metrics: DataFrame) -> DataFrame:
    """Short series that lags explain to the last bit have a statistic of rounding errors: all are -1000 here."""
    return metrics.withColumn("adf_statistic", F.greatest("adf_statistic", F.lit(-1000.0)))


_TAU = "greatest(tau, -1000.0) AS adf_statistic, p_value AS adf_pvalue"
register(
    "ts_adf", lambda s, d: _held(ts.ts_adf(fx.weekly_mixed(s, d))),
    _adf(f"""SELECT i.account_id, {_TAU} FROM (SELECT DISTINCT account_id FROM idx) AS i
      LEFT JOIN tested AS t ON t.account_id = i.account_id"""),
    adf_statistic=4, adf_pvalue=5,
)
register(
    "ts_metrics", lambda s, d: _held(ts.ts_metrics(fx.weekly_mixed(s, d))),
    _adf(f"""SELECT a.account_id, {_TAU}, r1 AS acf_lag1, r2 AS acf_lag2, r1 * n / (n - 1) AS pacf_lag1,
      trend_strength, z.s AS seasonality_strength FROM acfs AS a LEFT JOIN tested AS t ON t.account_id = a.account_id
      LEFT JOIN seasons AS z ON z.account_id = a.account_id JOIN (SELECT account_id, CASE WHEN count(x) > 1 THEN
        CASE WHEN var_pop(x) = 0 THEN 0.0 ELSE regr_r2(x, i) END END AS trend_strength FROM idx GROUP BY account_id) AS r
      ON r.account_id = a.account_id"""),
    adf_statistic=4, adf_pvalue=5, acf_lag1=7, acf_lag2=7, pacf_lag1=7, trend_strength=7, seasonality_strength=7,
)
register(
    "metrics_merge",
    lambda s, d: q.merge_metrics(
        wk.eligible_accounts(wk.account_stats(p := io.written(fx.weekly_mixed(s, d), "mixed"))), ts.ts_acf(p)
    ).select("account_id", "sector", "n_obs", "cv_cashflow", "acf_lag1"),
    _metrics(f"""SELECT e.account_id, sector, n_obs, cv_cashflow, r1 AS acf_lag1
      FROM ({ELIGIBLE}) AS e JOIN acfs AS a ON e.account_id = a.account_id"""),
    cv_cashflow=6, acf_lag1=7,
)

# --- quality --------------------------------------------------------------------------------------------

SCORES = (
    "stationarity_component", "autocorr_component", "trend_component", "seasonality_component",
    "completeness_component", "cashflow_component", "transaction_component", "cv_penalty",
    "predictability_score", "composite_score",
)


def scored(spark, sf) -> DataFrame:
    return q.quality_scores(ts.valid_metrics(fx.metric_profiles(spark, sf)))


JOB_SQL = """acf_lag1 > 0.20 AND adf_pvalue < 0.10 AND completeness_ratio > 0.60
      AND total_transactions > 100 AND cv_cashflow >= 0.20 AND cv_cashflow <= 2.00
      AND predictability_score > 35 AND composite_score > 40"""
register(
    "ts_validity",
    lambda s, d: ts.valid_metrics(fx.metric_profiles(s, d)).select(
        "account_id", "adf_statistic", "adf_pvalue", "acf_lag1"),
    with_ctes("SELECT account_id, adf_statistic, adf_pvalue, acf_lag1 FROM valid_profiles"),
    adf_statistic=6, adf_pvalue=6, acf_lag1=6,
)
register("quality_scores", lambda s, d: scored(s, d).select("account_id", *SCORES),
         with_ctes(f"SELECT account_id, {', '.join(SCORES)} FROM scored"), **{c: 7 for c in SCORES})
register(
    "quality_filter",
    lambda s, d: q.quality_filter(scored(s, d), q.JOB_CUTS).select(
        "account_id", "predictability_score", "composite_score"),
    with_ctes(f"SELECT account_id, predictability_score, composite_score FROM scored WHERE {JOB_SQL}"),
    predictability_score=7, composite_score=7,
)
register(
    "profile_tag",
    lambda s, d: q.profile_tag(scored(s, d)).select("account_id", "profile"),
    with_ctes("""SELECT account_id, CASE WHEN acf_lag1 > 0.35 AND adf_pvalue < 0.10 AND completeness_ratio > 0.60
      AND total_transactions > 100 AND cv_cashflow BETWEEN 0.30 AND 1.50 AND predictability_score > 35
      AND composite_score > 40 THEN 'regular' WHEN completeness_ratio <= 0.40 THEN 'sparse'
      WHEN cv_cashflow > 2.0 THEN 'volatile' ELSE 'irregular' END AS profile FROM scored"""),
)
_REST = """adf_pvalue < 0.10 AND completeness_ratio > 0.60 AND total_transactions > 100
      AND predictability_score > 35 AND composite_score > 40"""
register(
    "step7_ablation", lambda s, d: q.cuts_ablation(scored(s, d)),
    with_ctes(f"""SELECT threshold_set, CAST(count(*) AS BIGINT) AS n_accounts,
      CAST(count(*) FILTER (acf_lag1 > a AND cv_cashflow BETWEEN lo AND hi AND {_REST}) AS BIGINT) AS n_passed,
      count(*) FILTER (acf_lag1 > a AND cv_cashflow BETWEEN lo AND hi AND {_REST}) / count(*) AS pass_share
      FROM scored CROSS JOIN (VALUES ('strict', 0.35, 0.30, 1.50), ('moderate', 0.20, 0.20, 2.00),
        ('loose', 0.10, 0.10, 3.00)) AS t(threshold_set, a, lo, hi) GROUP BY threshold_set"""),
    pass_share=8,
)
REGULARITY = """greatest(0.0, least(1.0, acf_lag1 * 0.5 + greatest(0.0, 1.0 - least(cv_cashflow, 2.0) / 2.0) * 0.5))"""
register(
    "regularity_score",
    lambda s, d: scored(s, d).select("account_id", C.regularity_score(
        F.col("acf_lag1"), F.col("cv_cashflow")).alias("score")),
    with_ctes(f"SELECT account_id, {REGULARITY} AS score FROM scored"), score=8,
)
register(
    "regularity_label", lambda s, d: q.regularity_label(scored(s, d)).select("account_id", "regularity"),
    with_ctes(f"SELECT account_id, CASE WHEN {REGULARITY} >= 0.55 THEN 'regular' ELSE 'irregular' END AS regularity FROM scored"),
)
register(
    "cv_bucket",
    lambda s, d: fx.metric_profiles(s, d).select(
        "account_id", (b := C.cv_bucket(F.col("cv_cashflow"))).alias("cv_bucket"),
        C.cv_bucket_bound(b, "low").alias("cv_low"), C.cv_bucket_bound(b, "high").alias("cv_high")),
    with_ctes("""SELECT account_id,
      CASE WHEN cv_cashflow < 0.3 THEN '<0.30' WHEN cv_cashflow < 0.5 THEN '[0.30,0.50)'
        WHEN cv_cashflow < 0.8 THEN '[0.50,0.80)' ELSE '>=0.80' END AS cv_bucket,
      CASE WHEN cv_cashflow < 0.3 THEN 0.0 WHEN cv_cashflow < 0.5 THEN 0.3
        WHEN cv_cashflow < 0.8 THEN 0.5 ELSE 0.8 END AS cv_low,
      CASE WHEN cv_cashflow < 0.3 THEN 0.3 WHEN cv_cashflow < 0.5 THEN 0.5
        WHEN cv_cashflow < 0.8 THEN 0.8 ELSE 9.99 END AS cv_high FROM profiles"""),
    cv_low=3, cv_high=3,
)
register(
    "feature_projection",
    lambda s, d: scored(s, d).select(
        "account_id", "sector", "cv_cashflow", "completeness_ratio", "acf_lag1",
        "predictability_score", "composite_score"),
    with_ctes("""SELECT account_id, sector, cv_cashflow, completeness_ratio, acf_lag1,
      predictability_score, composite_score FROM scored"""),
    cv_cashflow=6, completeness_ratio=6, acf_lag1=6, predictability_score=7, composite_score=7,
)
#: The cuts by moments alone: the unit-root test is made, and its p-value may take any value.
OPEN_CUTS = q.QualityCuts(
    acf_min=0.70, adf_pvalue_max=float("inf"), completeness_min=0.60, transactions_min=100, cv_min=0.20, cv_max=2.00,
    predictability_min=38.0, composite_min=float("-inf"),
)
_PASSED = {
    "acf": "acf_lag1 > 0.70", "completeness": "completeness_ratio > 0.60", "transactions": "total_transactions > 100",
    "cv": "cv_cashflow >= 0.20 AND cv_cashflow <= 2.00", "predictability": "predictability_score > 38",
}
JUDGED = {
    **{k: v.replace("FROM mixed", "FROM smooth") for k, v in METRICS_SQL.items()},
    "trends": "SELECT account_id, CASE WHEN var_pop(x) = 0 THEN 0.0 ELSE regr_r2(x, i) END AS trend_strength FROM idx GROUP BY account_id",
    "judged": f"""SELECT s.account_id, s.sector, n_obs, total_transactions, total_cashflow, cv_cashflow, completeness_ratio,
        r1 AS acf_lag1, trend_strength, z.s AS seasonality_strength,
        0.5 * r1 * 100 + 0.25 * trend_strength * 50 + 0.25 * z.s * 50 AS predictability_score
      FROM ({stats_sql('smooth')}) AS s JOIN acfs AS a ON a.account_id = s.account_id
      JOIN trends AS t ON t.account_id = s.account_id LEFT JOIN seasons AS z ON z.account_id = s.account_id
      WHERE n_obs >= 24 AND std_cashflow >= 1e-8 AND r1 IS NOT NULL""",
    "kept": f"SELECT * FROM judged WHERE {' AND '.join(_PASSED.values())}",
}


def quality_run(spark, sf, cuts: q.QualityCuts = OPEN_CUTS) -> q.QualityRun:
    """Transactions to the panel and the accounts kept, judged on four-week means."""
    return q.quality_pipeline(fx.transactions(spark, sf), cuts, smoothing=4)


def _quality_counts(spark, sf) -> DataFrame:
    return literal_table(spark, sorted(quality_run(spark, sf).counts.items()), "step string, n_accounts bigint")


_JUDGED = (
    "account_id", "sector", "n_obs", "total_transactions", "total_cashflow", "cv_cashflow", "completeness_ratio",
    "acf_lag1", "trend_strength", "seasonality_strength", "predictability_score",
)
register(
    "quality_pipeline", lambda s, d: quality_run(s, d).accounts.select(*_JUDGED),
    with_ctes(f"SELECT {', '.join(_JUDGED)} FROM kept", **JUDGED),
    total_cashflow=3, cv_cashflow=6, completeness_ratio=6, acf_lag1=7, trend_strength=7, seasonality_strength=7,
    predictability_score=5,
)
_JOB = {
    **{k: v.replace("FROM mixed", "FROM smooth") for k, v in METRICS_SQL.items()}, **ADF_SQL, **JUDGED,
    "fully_judged": """SELECT j.*, p_value AS adf_pvalue, 0.35 * predictability_score + 0.20 * (1.0 - greatest(0.0, least(1.0, p_value))) * 100
          + 0.20 * completeness_ratio * 100 + 0.15 * CASE WHEN total_cashflow > 0 THEN 10 * log10(total_cashflow) ELSE 0.0 END
          + 0.10 * CASE WHEN total_transactions > 0 THEN 10 * log10(total_transactions) ELSE 0.0 END
          - CASE WHEN cv_cashflow < 0.2 THEN (0.2 - cv_cashflow) * 50 WHEN cv_cashflow > 2.0 THEN (cv_cashflow - 2.0) * 20 ELSE 0.0 END
          AS composite_score
        FROM judged AS j JOIN tested AS t ON t.account_id = j.account_id""",
}
register(
    "quality_accounts",
    lambda s, d: q.quality_accounts(fx.weekly_smooth(s, d), q.JOB_CUTS).select(*_JUDGED, "adf_pvalue", "composite_score"),
    with_ctes(f"SELECT {', '.join(_JUDGED)}, adf_pvalue, composite_score FROM fully_judged WHERE {JOB_SQL}", **_JOB)
    .replace("WITH ", "WITH RECURSIVE ", 1),
    total_cashflow=3, cv_cashflow=6, completeness_ratio=6, acf_lag1=7, trend_strength=7, seasonality_strength=7,
    predictability_score=5, adf_pvalue=5, composite_score=5,
)
register(
    "quality_pipeline_counts", _quality_counts,
    with_ctes(" UNION ALL ".join([
        "SELECT 'accounts_in' AS step, count(*) AS n_accounts FROM judged",
        "SELECT 'untested', 0", "SELECT 'fails_adf_pvalue', 0", "SELECT 'fails_composite', 0",
        "SELECT 'kept', count(*) FROM kept",
        *(f"SELECT 'fails_{n}', count(*) FROM judged WHERE NOT coalesce({c}, false)" for n, c in _PASSED.items()),
    ]), **JUDGED),
)
CATEGORY_V6 = """CASE WHEN n_obs < 52 THEN 'E_short_history'
      WHEN seasonality_strength > 0.60 AND acf_lag1 >= 0.30 AND cv_cashflow < 1.0 AND trend_strength < 0.50
        THEN 'B_seasonal'
      WHEN trend_strength > 0.20 AND seasonality_strength < 0.60 AND cv_cashflow < 1.0 THEN 'C_trending'
      WHEN (acf_lag1 < 0.30 OR cv_cashflow > 1.0) AND seasonality_strength < 0.60 AND trend_strength < 0.50
        THEN 'D_volatile'
      WHEN acf_lag1 > 0.60 AND cv_cashflow < 0.50 AND seasonality_strength < 0.30 AND trend_strength < 0.20
        THEN 'A_regular_stable' ELSE 'F_mixed' END"""
register("category_v7",
         lambda s, d: q.with_category(scored(s, d)).select("account_id", "account_category"),
         with_ctes("SELECT account_id, account_category FROM categorised"))
register("category_v6",
         lambda s, d: q.with_category(scored(s, d), "v6").select("account_id", "account_category"),
         with_ctes(f"SELECT account_id, {CATEGORY_V6} AS account_category FROM scored"))
