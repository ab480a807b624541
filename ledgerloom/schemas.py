"""Declared table schemas, and the projection that brings a frame to one of them.

Types are never inferred from files, and ``week`` is a DATE everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
    "doubles": T.ArrayType(T.DoubleType()),
}


def _struct(**groups: str) -> T.StructType:
    """``_struct(a="string", b_c="double")`` with space-free names in declaration order."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in groups.items()])


def _same(kind: str, names: str) -> dict[str, str]:
    return {n: kind for n in names.split()}


CALENDAR_FLAGS = (
    "is_ramadan",
    "is_eid_alfitr",
    "is_new_year_week",
    "is_month_end_week",
    "is_quarter_end",
    "is_tax_deadline_week",
    "is_payroll_week",
)
MACRO_KEYS = ("oil_price_z", "commodity_index_z", "masi_index_z", "realestate_index_z")
# Calendar flags a model may use as external regressors (the others stay features only).
CALENDAR_KEYS = (
    "is_ramadan",
    "is_eid_alfitr",
    "is_month_end_week",
    "is_payroll_week",
    "is_quarter_end",
)
EXTERNAL_KEYS = MACRO_KEYS + CALENDAR_KEYS

TRANSACTIONS = _struct(
    account_id="string", op_ts="timestamp", amount="double",
    op_type="string", sector="string", account_type="string",
)
CALENDAR = _struct(week="date", **_same("int", " ".join(CALENDAR_FLAGS)))
MACRO = _struct(week="date", **_same("double", " ".join(MACRO_KEYS)))
SECTOR_MACRO = _struct(
    sector="string", sector_label="string", macro_primary="string", macro_secondary="string",
    include_calendar="boolean", priority="int", source="string",
)
WEEKLY = _struct(
    account_id="string", week="date", sector="string",
    total_amount="double", transaction_count="bigint",
)
TS_METRICS = _struct(
    account_id="string",
    **_same(
        "double",
        "adf_statistic adf_pvalue acf_lag1 acf_lag2 pacf_lag1 trend_strength seasonality_strength",
    ),
)
QUALITY = _struct(
    account_id="string", sector="string", n_obs="bigint", total_transactions="bigint",
    **_same(
        "double",
        "total_cashflow mean_cashflow std_cashflow non_zero_periods completeness_ratio cv_cashflow "
        "adf_statistic adf_pvalue acf_lag1 acf_lag2 pacf_lag1 trend_strength seasonality_strength "
        "stationarity_component autocorr_component trend_component seasonality_component "
        "completeness_component cashflow_component transaction_component cv_penalty "
        "predictability_score composite_score",
    ),
)
ASSIGNMENT = _struct(
    account_id="string", sector="string", macro_primary="string", macro_secondary="string",
    include_calendar="boolean", externals_for_model="strings",
)
POLICY = _struct(
    account_id="string", sector="string",
    **_same("double", "cv_cashflow completeness_ratio acf_lag1 predictability_score composite_score"),
    account_category="string", use_externals_regression="boolean",
    use_externals_classification="boolean", policy_rule_id="string", macro_primary="string",
    macro_secondary="string", externals_for_model="strings", regression_model="string",
    classification_model="string", policy_version="string",
)
FEATURES = _struct(
    account_id="string", week="date", sector="string",
    total_amount="double", transaction_count="bigint",
    **_same("int", "month week_num"),
    **_same("double", "week_sin week_cos week_sin_2h week_cos_2h"),
    **_same("bigint", "negative_count_4w negative_count_8w"),
    prop_positive_24w="double", sign_streak_8="bigint",
    **_same("double", "rolling_max_8w rolling_min_8w volatility_4w"),
    **_same("int", " ".join(CALENDAR_FLAGS)),
    **_same("double", " ".join(MACRO_KEYS)),
)
PREDICTIONS = _struct(
    account_id="string", last_week="date", task="string", feature_mode="string",
    model_name="string", prediction="double",
)
EXPERIMENTS = _struct(
    name="string", condition="string", account_type="string", model_name="string",
    model_type="string", experiment_role="string", rmse="double",
)
CATEGORY_POLICY = _struct(
    account_category="string", activate_externals="boolean", regression_model="string",
    policy_rule_id="string", source_exp="string", lift_med_champion_pct="double",
)
CHART_PAYLOAD = (
    "chart struct<result:array<struct<timestamp:array<bigint>,"
    "indicators:struct<quote:array<struct<close:array<double>>>>>>>"
)


def require_columns(df: DataFrame, names, what: str) -> DataFrame:
    """Raise on the driver, before any job runs, when a needed column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to ``schema``; a value that does not parse becomes NULL, not an error."""
    require_columns(df, schema.fieldNames(), "conform")
    kinds = dict(df.dtypes)

    def typed(field: T.StructField):
        source = F.col(field.name)
        if kinds[field.name] == field.dataType.simpleString():
            return source
        if kinds[field.name] == "string" and isinstance(field.dataType, T.TimestampType):
            return F.try_to_timestamp(source)
        if kinds[field.name] == "string" and isinstance(field.dataType, T.DateType):
            return F.to_date(F.try_to_timestamp(source))
        return source.try_cast(field.dataType)

    return df.select(*(typed(f).alias(f.name) for f in schema.fields))
