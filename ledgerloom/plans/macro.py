"""Queries over the market-indicator feeds and the sector mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions import columns as C
from ledgerloom.operators import macro as mac
from ledgerloom.operators import sectors as sec
from ledgerloom.plans.registry import register
from ledgerloom.plans.sql import MONDAY, element, with_ctes
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources import io

_Z = ", ".join(S.MACRO_KEYS)

register(
    "src_chart_json", lambda s, d: io.parse_chart(fx.chart_payloads(s, d)),
    with_ctes("SELECT symbol, day, value FROM feeds WHERE dayofyear(day) % 10 <> 0"), value=6,
)


def _symbol_spec(spark, sf):
    """One spec text per order, of every well and badly formed kind."""
    k = F.col("o_orderkey")
    t = k.cast("string")
    text = (
        F.when(k % 5 == 0, "")
        .when(k % 5 == 1, F.concat(F.lit(" oil_price_z :S"), t, F.lit("|A"), t, F.lit("; B ;;")))
        .when(k % 5 == 2, F.concat(F.lit("broken, masi_index_z : M"), t, F.lit(" ")))
        .when(k % 5 == 3, F.concat(
            F.lit("masi_index_z:X|Y,oil_price_z:O,masi_index_z:Z"), t, F.lit("|")))
        .otherwise("nothing, useful")
    )
    specs = fx.table(spark, sf, "orders").select(k.alias("spec_id"), text.alias("spec"))
    return mac.parse_symbol_specs(specs)


_DEFAULTS = """('oil_price_z', 0, 'BZ=F'), ('commodity_index_z', 0, 'DBC'), ('masi_index_z', 0, 'MASI.CS'),
        ('masi_index_z', 1, '^GSPC'), ('realestate_index_z', 0, 'IYR')"""
register(
    "symbol_spec", _symbol_spec,
    f"""SELECT k AS spec_id, indicator, CAST(r AS INTEGER) AS rank, sym AS symbol FROM (
      SELECT o_orderkey AS k, indicator, r, sym FROM orders CROSS JOIN (VALUES {_DEFAULTS}) AS x(indicator, r, sym)
        WHERE o_orderkey % 5 IN (0, 4)
      UNION ALL SELECT o_orderkey, 'oil_price_z', 0, 'S' || o_orderkey FROM orders WHERE o_orderkey % 5 = 1
      UNION ALL SELECT o_orderkey, 'oil_price_z', 1, 'A' || o_orderkey FROM orders WHERE o_orderkey % 5 = 1
      UNION ALL SELECT o_orderkey, 'oil_price_z', 2, 'B' FROM orders WHERE o_orderkey % 5 = 1
      UNION ALL SELECT o_orderkey, 'masi_index_z', 0, 'M' || o_orderkey FROM orders WHERE o_orderkey % 5 = 2
      UNION ALL SELECT o_orderkey, 'oil_price_z', 0, 'O' FROM orders WHERE o_orderkey % 5 = 3
      UNION ALL SELECT o_orderkey, 'masi_index_z', 0, 'Z' || o_orderkey FROM orders WHERE o_orderkey % 5 = 3)""",
)
register(
    "symbol_fallback",
    lambda s, d: mac.pick_symbol(fx.symbols(s), fx.daily_feeds(s, d)),
    with_ctes("SELECT indicator, symbol, source, day, value FROM picked"), value=6,
)


def _stale(spark, sf):
    """Fresh copies exist of two symbols only; the others must fall back to stale primaries."""
    feeds = fx.daily_feeds(spark, sf)
    fresh = feeds.where(F.col("symbol").isin("1-URGENT", "5-LOW"))
    return mac.pick_symbol(fx.symbols(spark), fresh, feeds)


register(
    "symbol_stale_cache", _stale,
    with_ctes("""SELECT 'oil_price_z' AS indicator, symbol, 'yahoo' AS source, day, value
        FROM feeds WHERE symbol = '1-URGENT'
      UNION ALL SELECT 'masi_index_z', symbol, 'yahoo_fallback:5-LOW', day, value FROM feeds WHERE symbol = '5-LOW'
      UNION ALL SELECT 'commodity_index_z', symbol, 'cache_stale', day, value FROM feeds
        WHERE symbol = '2-HIGH'"""),
    value=6,
)
register("macro_source_pick", fx.macro_feed,
         with_ctes("SELECT indicator, week, raw_value, source FROM feed"), raw_value=6)
register(
    "macro_feed_report", lambda s, d: mac.feed_report(fx.macro_feed(s, d)),
    with_ctes("""SELECT indicator, min(source) AS source, CAST(count(DISTINCT week) AS BIGINT) AS n_weeks,
      bool_or(source LIKE 'synthetic%') AS used_fallback FROM feed GROUP BY indicator"""),
)
register(
    "macro_mode", lambda s, d: fx.macro_feed(s, d, mode="synthetic"),
    with_ctes("SELECT indicator, week, raw_value, 'synthetic_full' AS source FROM substitute"), raw_value=6,
)
register(
    "weekly_last",
    lambda s, d: mac.weekly_last(fx.daily_feeds(s, d).withColumnRenamed("symbol", "indicator")),
    with_ctes(f"""SELECT symbol AS indicator, {MONDAY.format('day')} AS week, arg_max(value, day) AS raw_value
      FROM feeds GROUP BY 1, 2"""),
    raw_value=6,
)
_CUT = {
    "cut_spine": "SELECT week FROM spine ORDER BY week DESC LIMIT 200",
    "aligned": """SELECT s.week, i.indicator, raw_value FROM cut_spine AS s
      CROSS JOIN (SELECT DISTINCT indicator FROM symbols) AS i
      LEFT JOIN feed AS f ON f.week = s.week AND f.indicator = i.indicator""",
}
register(
    "spine_join", lambda s, d: mac.on_spine(fx.macro_feed(s, d), n_weeks=200),
    with_ctes("SELECT week, indicator, raw_value FROM aligned", **_CUT), raw_value=6,
)
register(
    "ffill_bfill", lambda s, d: mac.fill_gaps(mac.on_spine(fx.macro_feed(s, d), n_weeks=200)),
    with_ctes("SELECT week, indicator, raw_value FROM filled", **_CUT), raw_value=6,
)
register("zscore", lambda s, d: mac.zscore(mac.fill_gaps(mac.on_spine(fx.macro_feed(s, d)))),
         with_ctes("SELECT week, indicator, z FROM zscored"), z=8)
register("macro_table", fx.macro, with_ctes(f"SELECT week, {_Z} FROM macro"),
         **{k: 8 for k in S.MACRO_KEYS})
register(
    "macro_lag_join",
    lambda s, d: mac.macro_lag_join(fx.weekly(s, d), fx.macro(s, d)).select(
        "account_id", "week", "sector", *S.MACRO_KEYS),
    with_ctes(f"""SELECT account_id, w.week, sector, {_Z} FROM weekly AS w
      LEFT JOIN macro AS m ON m.week = w.week - INTERVAL 7 DAY"""),
    **{k: 8 for k in S.MACRO_KEYS},
)

# --- sector mapping -----------------------------------------------------------------------------------


def _ref_load(spark, sf):
    """A mapping file with one sector per supplier: written as CSV text, read and normalised."""
    k = F.col("s_suppkey")
    key = F.when(k % 4 == 0, " oil_price_z ").when(k % 4 == 1, "nan").when(k % 4 == 2, "")
    raw = fx.table(spark, sf, "supplier").select(
        F.concat(F.lit("  "), F.upper("s_name"), F.lit(" ")).alias("sector"),
        F.coalesce(key, F.lit("masi_index_z")).alias("macro_primary"),
        F.lit(None).cast("string").alias("macro_secondary"),
        F.when(k % 2 == 0, "true").otherwise("False").alias("include_calendar"),
        k.cast("string").alias("priority"), F.col("s_name").alias("sector_label"), F.lit("suppliers").alias("source"),
    )
    path = io.scratch_path(spark, "mapping-csv")
    io.write_csv(raw, path)
    return sec.load_mapping(spark.read.option("header", True).schema(raw.schema).csv(path))


register(
    "ref_load", _ref_load,
    """SELECT lower(s_name) AS sector,
      CASE s_suppkey % 4 WHEN 0 THEN 'oil_price_z' WHEN 3 THEN 'masi_index_z' ELSE '' END AS macro_primary,
      '' AS macro_secondary, s_suppkey % 2 = 0 AS include_calendar, CAST(s_suppkey AS INTEGER) AS priority,
      s_name AS sector_label, 'suppliers' AS source FROM supplier""",
)
_CAL = "is_ramadan,is_eid_alfitr,is_month_end_week,is_payroll_week,is_quarter_end"
RESOLVED = f"""SELECT account_id, sector, coalesce(m1, a1) AS macro_primary, coalesce(m2, a2) AS macro_secondary,
        coalesce(mc, ac) AS include_calendar,
        concat_ws(',', nullif(coalesce(m1, a1), ''),
          CASE WHEN coalesce(m2, a2) <> coalesce(m1, a1) THEN nullif(coalesce(m2, a2), '') END,
          CASE WHEN coalesce(mc, ac) THEN '{_CAL}' END) AS externals_for_model
      FROM (SELECT a.account_id, a.sector, m.macro_primary AS m1, m.macro_secondary AS m2,
          m.include_calendar AS mc, w.macro_primary AS a1, w.macro_secondary AS a2, w.include_calendar AS ac
        FROM messy AS a LEFT JOIN (SELECT * FROM mapping QUALIFY row_number() OVER
            (PARTITION BY sector ORDER BY priority) = 1) AS m ON m.sector = lower(trim(a.sector))
        CROSS JOIN (SELECT * FROM mapping WHERE sector = '*') AS w)"""


def _text_keys(df):
    return df.withColumn("externals_for_model", C.join_keys(F.col("externals_for_model")))


register(
    "sector_macro_resolve",
    lambda s, d: _text_keys(sec.resolve_sectors(fx.messy_accounts(s, d), fx.mapping(s))),
    with_ctes(RESOLVED),
)
register(
    "macro_assignment",
    lambda s, d: _text_keys(sec.macro_assignment(
        fx.transactions(s, d).select("account_id", "sector"), sec.reference_mapping(s))),
    with_ctes(f"""SELECT DISTINCT account_id, t.sector, coalesce(macro_primary, '') AS macro_primary,
      coalesce(macro_secondary, '') AS macro_secondary, true AS include_calendar,
      concat_ws(',', nullif(macro_primary, ''), nullif(macro_secondary, ''), '{_CAL}') AS externals_for_model
      FROM tx AS t LEFT JOIN (SELECT * FROM mapping WHERE priority <= 6) AS m ON m.sector = t.sector"""),
)


def _priorities(spark, sf):
    """A mapping row per order: sector by customer, priority by order; the smallest priority wins."""
    k = F.col("o_orderkey")
    rows = fx.table(spark, sf, "orders").select(
        fx.element(fx.SECTORS, F.col("o_custkey")).alias("sector"),
        F.col("o_orderpriority").alias("macro_primary"), F.lit("").alias("macro_secondary"),
        (k % 2 == 0).alias("include_calendar"), ((k * 7919) % 100003).cast("int").alias("priority"),
    )
    return sec.best_priority(rows)


register(
    "best_priority", _priorities,
    f"""SELECT sector, macro_primary, macro_secondary, include_calendar, priority FROM (
      SELECT {element(fx.SECTORS, 'o_custkey')} AS sector, o_orderpriority AS macro_primary,
        '' AS macro_secondary, o_orderkey % 2 = 0 AS include_calendar,
        CAST((o_orderkey * 7919) % 100003 AS INTEGER) AS priority FROM orders)
      QUALIFY row_number() OVER (PARTITION BY sector ORDER BY priority, macro_primary) = 1""",
)
register(
    "externals_text",
    lambda s, d: fx.table(s, d, "orders").select(
        "o_orderkey",
        C.join_keys(F.array_distinct(C.split_keys(F.concat_ws(
            ",", F.concat(F.lit(" "), F.col("o_orderpriority")), F.lit(""), F.col("o_orderstatus"),
            F.concat(F.col("o_orderpriority"), F.lit("  ")),
        )))).alias("keys"),
        F.size(C.split_keys(F.when(F.col("o_orderkey") % 2 == 0, "NaN"))).alias("n_missing_keys"),
    ),
    """SELECT o_orderkey, o_orderpriority || ',' || o_orderstatus AS keys, CAST(0 AS INTEGER) AS n_missing_keys
      FROM orders""",
)
