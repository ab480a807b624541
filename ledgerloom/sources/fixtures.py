"""The driver's star-schema tables read as the engine's inputs (deterministic, no random numbers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import cv_bucket
from ledgerloom.functions.literals import literal_table
from ledgerloom.operators import calendar as cal
from ledgerloom.operators import lift as lf
from ledgerloom.operators import macro as mac
from ledgerloom.operators import weekly as wk
from ledgerloom.sources.io import written

SECTORS = (
    "agriculture", "transport", "investment", "construction", "mixed", "retail", "energy",
)
CONDITIONS = (
    "A_clean", "B_noisy", "C_short", "C_level_shift_w70", "sparse", "flat", "irregular",
)
# The published holiday dates inside the years the tables cover.
PERIODS = (
    ("is_ramadan", "1995-02-01", "1995-03-02"),
    ("is_ramadan", "1996-01-22", "1996-02-20"),
    ("is_ramadan", "1997-01-10", "1997-02-08"),
    ("is_ramadan", "1997-12-31", "1998-01-29"),
    ("is_ramadan", "1998-12-20", "1999-01-18"),
    ("is_ramadan", "1999-12-09", "2000-01-07"),
    ("is_ramadan", "2000-11-27", "2000-12-26"),
    ("is_ramadan", "2001-11-16", "2001-12-15"),
    ("is_eid_alfitr", "1995-03-03", "1995-03-10"),
    ("is_eid_alfitr", "1996-02-21", "1996-02-28"),
    ("is_eid_alfitr", "1997-02-09", "1997-02-16"),
    ("is_eid_alfitr", "1998-01-30", "1998-02-06"),
    ("is_eid_alfitr", "1999-01-19", "1999-01-26"),
    ("is_eid_alfitr", "2000-01-08", "2000-01-15"),
    ("is_eid_alfitr", "2000-12-27", "2001-01-03"),
    ("is_eid_alfitr", "2001-12-16", "2001-12-23"),
)
# Order priority plays the chart symbol. 3-MEDIUM is no indicator's symbol: it is the substitute.
SYMBOLS = (
    ("oil_price_z", 0, "1-URGENT"),
    ("commodity_index_z", 0, "2-HIGH"),
    ("masi_index_z", 0, "MASI"),
    ("masi_index_z", 1, "5-LOW"),
    ("realestate_index_z", 0, "REIT"),
    ("realestate_index_z", 1, "REIT2"),
)
SUBSTITUTE = "3-MEDIUM"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def element(names: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in names)), (index % len(names) + 1).cast("int"))


def account_name(key: Column) -> Column:
    return F.format_string("ACC_%05d", key)


def _amount() -> Column:
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    return sign * F.col("l_extendedprice") * (1 - F.col("l_discount"))


def account_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(account_id as the numeric key, sector), one row per account."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("account_id"), element(SECTORS, F.col("s_nationkey")).alias("sector")
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed transactions. A hot account makes a hot join key here; the skew join splits it.

    ``weekly`` does not read this: it sums before it joins.
    """
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("account_id"), F.col("l_shipdate").alias("op_ts"),
        _amount().alias("amount"), F.col("l_returnflag").alias("op_type"),
    )
    joined = rows.join(account_sectors(spark, sf_dir), "account_id")
    kind = F.when(F.col("account_id") % 2 == 0, "seasonal").otherwise("normal")
    return joined.select(
        account_name(F.col("account_id")).alias("account_id"), "op_ts", "amount", "op_type",
        "sector", kind.alias("account_type"),
    )


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly panel of the transactions, summed on the numeric account key before the sector join."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("account_id"), F.col("l_shipdate").alias("op_ts"),
        _amount().alias("amount"),
    )
    panel = wk.weekly_cashflow(rows, account_sectors(spark, sf_dir))
    return panel.withColumn("account_id", account_name(F.col("account_id")))


def weekly_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-row trailing mean of the panel: raw amounts are white noise and fail the thresholds."""
    return wk.trailing_mean(weekly(spark, sf_dir), 4)


def weekly_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long and short panels together: smoothed accounts and customers' orders per week.

    Accounts have some 300 rows, customers from one to a few dozen, so the branches for short series
    are reached.
    """
    return weekly_smooth(spark, sf_dir).unionByName(customer_weekly(spark, sf_dir))


def metric_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account-metrics row per order, spread over both sides of every threshold by its keys."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.format_string("P_%08d", k).alias("account_id"),
        element(SECTORS, c).alias("sector"),
        (k % 90 + 30).alias("n_obs"),
        (k % 401).alias("total_transactions"),
        F.col("o_totalprice").alias("total_cashflow"),
        ((c % 11) / 10.0).alias("completeness_ratio"),
        ((k % 263) / 100.0).alias("cv_cashflow"),
        F.when(k % 17 != 0, -(k % 97) / 20.0).alias("adf_statistic"),
        F.when(k % 19 == 0, float("nan")).when(k % 23 != 0, (k % 29) / 100.0).alias("adf_pvalue"),
        F.when(k % 31 != 0, (c % 101) / 100.0).alias("acf_lag1"),
        ((c % 61) / 100.0).alias("trend_strength"),
        ((k % 83) / 82.0).alias("seasonality_strength"),
    )


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.day_spine(table(spark, sf_dir, "lineitem"), "l_shipdate")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar_weekly(days(spark, sf_dir), PERIODS)


def daily_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, day, value): mean order price per day and priority; missing days are real gaps."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(
        F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("day")
    ).agg(F.avg("o_totalprice").alias("value"))


def symbols(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SYMBOLS, "indicator string, rank int, symbol string")


def substitute_weekly(feeds: DataFrame) -> DataFrame:
    """Weekly substitute values for every indicator (one series, listed under each name)."""
    base = feeds.where(F.col("symbol") == SUBSTITUTE)
    one = mac.weekly_last(base.select(F.lit("_").alias("indicator"), "day", "value"))
    names = F.array(*(F.lit(i) for i in mac.MACRO_KEYS))
    return one.select(F.explode(names).alias("indicator"), "week", "raw_value")


def macro_feed(spark: SparkSession, sf_dir: str, mode: str = "scraped") -> DataFrame:
    """Weekly feed per indicator; the daily values are stored first, as both sources read them."""
    feeds = written(daily_feeds(spark, sf_dir), "daily-feeds")
    picked = mac.pick_symbol(symbols(spark), feeds)
    return mac.pick_feed(picked, substitute_weekly(feeds), mode=mode)


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mac.macro_table(macro_feed(spark, sf_dir))


def chart_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily feeds as chart text, one per symbol, every tenth day of the year without a close."""
    point = F.struct(
        (F.datediff("day", F.lit("1970-01-01").cast("date")).cast("bigint") * 86400).alias("ts"),
        F.when(F.dayofyear("day") % 10 != 0, F.col("value")).alias("close"),
    )
    series = daily_feeds(spark, sf_dir).groupBy("symbol").agg(
        F.array_sort(F.collect_list(point)).alias("p")
    )
    quote = F.array(F.struct(F.transform("p", lambda e: e["close"]).alias("close")))
    result = F.array(F.struct(
        F.transform("p", lambda e: e["ts"]).alias("timestamp"),
        F.struct(quote.alias("quote")).alias("indicators"),
    ))
    payload = F.to_json(
        F.struct(F.struct(result.alias("result")).alias("chart")), {"ignoreNullFields": "false"}
    )
    return series.select("symbol", payload.alias("payload"))


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment results: error per (account, condition, model, kind) from groups of line items."""
    key = F.col("l_suppkey")
    grouped = table(spark, sf_dir, "lineitem").groupBy(
        key, (F.col("l_partkey") % len(CONDITIONS)).alias("_c"), "l_returnflag", "l_linestatus"
    ).agg(
        F.stddev_samp("l_extendedprice").alias("rmse"),
        F.avg((F.col("l_discount") < 0.05).cast("double")).alias("share"),
    )
    model = (
        F.when(F.col("l_returnflag") == "A", "ridge")
        .when(F.col("l_returnflag") == "N", "rf").otherwise("lgbm")
    )
    return grouped.select(
        account_name(key).alias("name"),
        element(CONDITIONS, F.col("_c")).alias("condition"),
        F.when(key % 2 == 0, "seasonal").otherwise("normal").alias("account_type"),
        model.alias("model_name"),
        F.when(F.col("l_linestatus") == "F", "baseline").otherwise("with_externals")
        .alias("model_type"),
        F.when(key % 10 == 9, "holdout").otherwise("calibration").alias("experiment_role"),
        "rmse", "share",
    )


def regression_lifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifts per account, condition and model, with the sector and a free-text note."""
    results = written(experiments(spark, sf_dir), "experiments")
    pairs = lf.paired(results).join(
        results.where(F.col("model_type") == "baseline").select(*lf.PAIR_KEYS, "share"), lf.PAIR_KEYS
    )
    sectors = account_sectors(spark, sf_dir).select(
        account_name(F.col("account_id")).alias("name"), "sector"
    )
    note = F.concat(F.lit("n=1;reg="), (F.floor(F.col("share") * 100) / 100.0).cast("string"))
    return pairs.join(sectors, "name").select(
        *lf.PAIR_KEYS, "sector", "rmse_lift_pct",
        F.when(F.col("share") > 0.2, note).otherwise("n/a").alias("notes"),
    )


def classification_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    e = table(spark, sf_dir, "events").groupBy(user, (F.col("event_id") % 2).alias("_t")).agg(
        F.avg((F.col("value") > 100).cast("double")).alias("accuracy")
    )
    return e.select(
        user.cast("string").alias("name"), element(SECTORS, user).alias("sector"),
        F.lit("logistic").alias("model_name"),
        F.when(F.col("_t") == 0, "baseline").otherwise("with_externals").alias("model_type"),
        "accuracy",
    )


def scored_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerloom.operators.quality import quality_scores

    return quality_scores(metric_profiles(spark, sf_dir))


def sector_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup cells of the five sectors that regions stand for; the others have no cell at all."""
    n = table(spark, sf_dir, "nation")
    return n.groupBy(
        element(SECTORS, F.col("n_regionkey")).alias("sector"),
        cv_bucket((F.col("n_nationkey") % 10) / 10.0).alias("cv_bucket"),
    ).agg(
        (F.max("n_nationkey") % 2 == 0).alias("use_externals_regression"),
        (F.min("n_nationkey") % 3 == 0).alias("use_externals_classification"),
    )


def profile_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup cells of all profiles, in every sector: on where the cell's mean trend passes 0.3."""
    cells = metric_profiles(spark, sf_dir).groupBy(
        "sector", cv_bucket(F.col("cv_cashflow")).alias("cv_bucket")
    ).agg(F.avg("trend_strength").alias("_t"))
    return cells.select(
        "sector", "cv_bucket", (F.col("_t") > 0.3).alias("use_externals_regression"),
        (F.col("_t") <= 0.3).alias("use_externals_classification"),
    )


def item_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(account_id, sector, n_items, n_parts) of every order that has line items; some orders have none."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_suppkey").alias("_s"), F.count(F.lit(1)).alias("n_items"), F.sum("l_linenumber").alias("_p"),
    )
    return lines.select(
        F.format_string("P_%08d", "l_orderkey").alias("account_id"), element(SECTORS, F.col("_s")).alias("sector"),
        "n_items", F.col("_p").alias("n_parts"),
    )


def customer_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short panels: a customer's orders per week (at most a few dozen rows each)."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("account_id"), F.col("o_orderdate").alias("op_ts"),
        F.col("o_totalprice").alias("amount"),
        element(SECTORS, F.col("o_custkey")).alias("sector"),
    )
    panel = wk.weekly_cashflow(o)
    return panel.withColumn("account_id", F.format_string("C_%06d", F.col("account_id")))


def demo_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy of the accounts with a high balance, with every form of flag, model name and key list."""
    k = F.col("s_suppkey")
    models = F.array(F.lit("Random_Forest "), F.lit("ridge"), F.lit("lgbm"), F.lit(None))
    keys = F.array(
        F.lit("oil_price_z,is_ramadan"), F.lit(""), F.lit("masi_index_z, bogus ,is_payroll_week"),
    )
    return table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 3000).select(
        account_name(k).alias("account_id"),
        (k % 2 == 0).alias("use_externals_regression"),
        (k % 4 == 0).alias("use_externals_classification"),
        F.element_at(models, (k % 4 + 1).cast("int")).alias("regression_model"),
        F.element_at(keys, (F.floor(k / 2) % 3 + 1).cast("int")).alias("externals_for_model"),
    )


def mapping(spark: SparkSession) -> DataFrame:
    """Reference mapping with a losing duplicate and a catch-all row."""
    from ledgerloom.operators.sectors import reference_mapping

    extra = [
        ("transport", "masi_index_z", "oil_price_z", False, 9),
        ("*", "oil_price_z", "oil_price_z", False, 50),
    ]
    base = reference_mapping(spark)
    columns = ", ".join(f"{name} {kind}" for name, kind in base.dtypes)
    return base.unionByName(literal_table(spark, extra, columns))


def messy_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with sectors in mixed case and padding."""
    named = account_sectors(spark, sf_dir)
    text = F.when(F.col("account_id") % 2 == 0, F.concat(F.lit(" "), F.upper("sector"), F.lit(" ")))
    return named.select(
        account_name(F.col("account_id")).alias("account_id"),
        F.coalesce(text, F.col("sector")).alias("sector"),
    )
