"""Per-account modelling policy: category table, threshold rules, lookups and overrides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions.aggregates import keep_one
from ledgerloom.functions.literals import literal_table
from ledgerloom.operators.quality import with_category
from ledgerloom.schemas import CATEGORY_POLICY, require_columns

#: Version texts that the builders write where the caller names none.
VERSION_V7 = "v7-encapsulated-3pct"
VERSION_V6 = "v6"
VERSION_RULES = "v3.0"

# Built-in category policy (category, externals on, model, rule, source, lift %).
BUILTIN_POLICY = (
    ("E_short_history", False, "lgbm", "E_short", "EXP1_C_short", 0.0),
    ("C_trending", False, "rf", "C_trending", "EXP2_C_level_shift", 2.13),
    ("B_seasonal", False, "lgbm", "B_seasonal", "EXP3_seasonal", -0.54),
    ("A_regular_stable", True, "rf", "A_regular", "EXP1_A_clean", 5.13),
    ("D_noisy", False, "ridge", "D_noisy", "EXP1_B_noisy", -0.37),
    ("D_irregular", True, "ridge", "D_irregular", "EXP3_irregular", 5.25),
    ("D_sparse", False, "ridge", "D_sparse", "EXP6_sparse", -2.11),
    ("F_flat", False, "rf", "F_flat", "EXP6_flat", -1.53),
)

METRIC_COLUMNS = (
    "account_id", "sector", "cv_cashflow", "completeness_ratio", "acf_lag1",
    "predictability_score", "composite_score",
)
POLICY_COLUMNS = METRIC_COLUMNS + (
    "account_category", "use_externals_regression", "use_externals_classification",
    "policy_rule_id", "regression_model", "classification_model", "policy_version",
)


def builtin_policy(spark) -> DataFrame:
    return literal_table(
        spark, BUILTIN_POLICY, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CATEGORY_POLICY)
    )


def load_category_policy(table: DataFrame, order: str | None = None) -> DataFrame:
    """Normalise a category policy: old column name, flags from text, model names, one row each.

    Of several rows of a category the last by ``order`` stays (rows of a table have no order of
    their own); without ``order`` the largest rule id does.
    """
    if "regression_model" not in table.columns and "champion_model" in table.columns:
        table = table.withColumnRenamed("champion_model", "regression_model")
    require_columns(
        table, ("account_category", "activate_externals", "regression_model"), "category policy"
    )
    if "policy_rule_id" not in table.columns:
        table = table.withColumn("policy_rule_id", F.col("account_category"))
    if "policy_source" not in table.columns:
        table = table.withColumn("policy_source", F.lit("v7_encapsulated"))
    clean = table.withColumns({
        "activate_externals": C.flag_from_text(F.col("activate_externals")),
        "regression_model": F.lower(F.trim("regression_model")),
    })
    rank = [order] if order else ["policy_rule_id", "regression_model", "activate_externals"]
    return keep_one(clean, ["account_category"], rank, "last")


def category_policy_join(categorised: DataFrame, table: DataFrame) -> DataFrame:
    """Policy row of the account's category; an unlisted category gets no externals and defaults.

    ``table`` has one row per category (``load_category_policy``). Spark broadcasts it by its measured
    size, and beyond that splits the hot categories of the shuffled join (AQE).
    """
    rules = table.select(
        "account_category", F.col("activate_externals").alias("_on"),
        F.col("regression_model").alias("_model"), F.col("policy_rule_id").alias("_rule"),
    )
    use = F.coalesce("_on", F.lit(False))
    return categorised.join(rules, "account_category", "left").select(
        *(c for c in categorised.columns),
        use.alias("use_externals_regression"),
        use.alias("use_externals_classification"),
        F.coalesce("_rule", "account_category").alias("policy_rule_id"),
        F.coalesce("_model", F.lit(C.DEFAULT_REGRESSION_MODEL)).alias("regression_model"),
    )


def policy_category(
    quality: DataFrame, table: DataFrame, version: str = "v7", version_text: str | None = None
) -> DataFrame:
    """Category-driven policy. Both versions use the v7 tree; v6 names the category as the rule.

    ``version_text`` is what ``policy_version`` says, by default the version's own text.
    """
    out = category_policy_join(with_category(quality), table)
    if version == "v6":
        out = out.withColumn("policy_rule_id", F.col("account_category"))
    return out.withColumns({
        "classification_model": F.lit(C.CLASSIFICATION_MODEL),
        "policy_version": F.lit(version_text or {"v7": VERSION_V7, "v6": VERSION_V6}[version]),
    }).select(*POLICY_COLUMNS)


@dataclass(frozen=True)
class RuleCuts:
    """Thresholds of the R0-R4 rules. None has a published value, so each must be given."""

    completeness_sparse: float
    cv_flat: float
    noise_max: float
    acf_regular: float
    completeness_regular: float
    predictability_regular: float
    acf_irregular: float
    completeness_irregular: float
    composite_irregular: float
    cv_volatile: float
    composite_volatile: float

    def rule_id(self, noise: float) -> Column:
        """First rule that holds, else ``baseline``."""
        rules = (
            ("R0-A", f"completeness_ratio <= {self.completeness_sparse}"),
            ("R0-B", f"cv_cashflow < {self.cv_flat}"),
            ("R4", f"{noise} > {self.noise_max}"),
            (
                "R1",
                f"acf_lag1 >= {self.acf_regular} AND completeness_ratio > "
                f"{self.completeness_regular} AND predictability_score >= "
                f"{self.predictability_regular}",
            ),
            (
                "R2",
                f"acf_lag1 < {self.acf_irregular} AND completeness_ratio > "
                f"{self.completeness_irregular} AND composite_score >= {self.composite_irregular}",
            ),
            (
                "R3",
                f"cv_cashflow > {self.cv_volatile} AND composite_score >= {self.composite_volatile}",
            ),
        )
        return C.first_match(rules, "baseline")


def policy_rules(
    quality: DataFrame, cuts: RuleCuts, noise: float = 0.0, version_text: str = VERSION_RULES
) -> DataFrame:
    """Externals by threshold rule: regression under R1-R3, classification under R1 only."""
    rule = F.col("policy_rule_id")
    return (
        quality.withColumn("policy_rule_id", cuts.rule_id(noise))
        .withColumns({
            "account_category": F.lit(None).cast("string"),
            "use_externals_regression": rule.isin("R1", "R2", "R3"),
            "use_externals_classification": rule == "R1",
            "regression_model": F.lit(C.DEFAULT_REGRESSION_MODEL),
            "classification_model": F.lit(C.CLASSIFICATION_MODEL),
            "policy_version": F.lit(version_text),
        })
        .select(*POLICY_COLUMNS)
    )


def _override(policy: DataFrame, joined: DataFrame) -> DataFrame:
    return joined.withColumns({
        "use_externals_regression": F.coalesce("_reg", "use_externals_regression"),
        "use_externals_classification": F.coalesce("_clf", "use_externals_classification"),
    }).select(*policy.columns)


def _flags(table: DataFrame, *keys: Column) -> DataFrame:
    return table.select(
        *keys,
        F.col("use_externals_regression").cast("string").try_cast("boolean").alias("_reg"),
        F.col("use_externals_classification").cast("string").try_cast("boolean").alias("_clf"),
    )


def sector_cv_lookup_join(policy: DataFrame, lookup: DataFrame) -> DataFrame:
    """Flags of the matching (sector, CV bucket) cell replace the account's own.

    ``lookup`` has one row per cell; the bucket goes into the key, and Spark broadcasts the cells by
    their measured size.
    """
    cells = _flags(lookup, F.lower("sector").alias("_sector"), F.col("cv_bucket").alias("_bucket"))
    keyed = policy.withColumns({
        "_sector": F.lower("sector"), "_bucket": C.cv_bucket(F.col("cv_cashflow")),
    })
    return _override(policy, keyed.join(cells, ["_sector", "_bucket"], "left"))


def account_override_join(policy: DataFrame, overrides: DataFrame) -> DataFrame:
    """Per-account flags replace the policy's; one override row per account."""
    return _override(policy, policy.join(_flags(overrides, F.col("account_id")), "account_id", "left"))


def build_policy(
    quality: DataFrame,
    mode: str = "category_v7",
    *,
    category_table: DataFrame | None = None,
    cuts: RuleCuts | None = None,
    noise: float = 0.0,
    lookup: DataFrame | None = None,
    overrides: DataFrame | None = None,
    version_text: str | None = None,
) -> DataFrame:
    """Policy by mode: category_v7, category_v6, or rules with the enrichments of lookup, oracle or
    hybrid. Any other mode means plain rules."""
    mode = mode.strip().lower()
    if mode in ("category_v7", "category_v6"):
        table = builtin_policy(quality.sparkSession) if category_table is None else category_table
        return policy_category(quality, load_category_policy(table), mode[-2:], version_text)
    if cuts is None:
        raise ValueError(f"policy mode {mode!r} needs rule thresholds")
    policy = policy_rules(quality, cuts, noise, version_text or VERSION_RULES)
    if lookup is not None and mode in ("lookup", "hybrid"):
        policy = sector_cv_lookup_join(policy, lookup)
    if overrides is not None and mode in ("oracle", "hybrid"):
        policy = account_override_join(policy, overrides)
    return policy


def assignment_join(policy: DataFrame, assignment: DataFrame | None) -> DataFrame:
    """Attach the indicator assignment; without one the policy stays as it is."""
    if assignment is None:
        return policy
    extra = assignment.select(
        "account_id", "macro_primary", "macro_secondary", "externals_for_model"
    )
    return policy.join(extra, "account_id", "left")


# --- policy from quality metrics and a derived lookup -------------------------------------------

def sector_rule(sector: Column, cv: Column, priority_sectors, low=0.30, high=0.50) -> Column:
    """Externals on for a priority sector, or for a CV inside [low, high)."""
    in_band = (cv >= low) & (cv < high)
    return F.coalesce(sector.isin(*priority_sectors) | in_band, F.lit(False))


def policy_from_quality(
    quality: DataFrame, lookup: DataFrame, priority_sectors, mode: str = "hybrid",
    version_text: str = VERSION_RULES,
) -> DataFrame:
    """Sector rule, replaced by the lookup cell where one matches (modes lookup and hybrid)."""
    ruled = quality.select(
        "account_id", "sector", "cv_cashflow", "predictability_score", "composite_score",
        sector_rule(F.col("sector"), F.col("cv_cashflow"), priority_sectors).alias("_rule"),
        C.cv_bucket(F.col("cv_cashflow")).alias("cv_bucket"),
    )
    if mode in ("lookup", "hybrid"):
        cells = _flags(lookup, F.col("sector"), F.col("cv_bucket")).withColumn("_hit", F.lit(True))
        ruled = ruled.join(cells, ["sector", "cv_bucket"], "left")
    else:
        ruled = ruled.withColumns({
            "_reg": F.lit(None).cast("boolean"), "_clf": F.lit(None).cast("boolean"),
            "_hit": F.lit(None).cast("boolean"),
        })
    return ruled.select(
        "account_id", "sector", "cv_cashflow", "predictability_score", "composite_score",
        F.coalesce("_reg", "_rule").alias("use_externals_regression"),
        F.coalesce("_clf", F.lit(False)).alias("use_externals_classification"),
        F.lit(C.DEFAULT_REGRESSION_MODEL).alias("regression_model"),
        F.lit(C.CLASSIFICATION_MODEL).alias("classification_model"),
        F.lit(version_text).alias("policy_version"),
        F.when(F.col("_hit"), "lookup_sector_cv").otherwise("rules_v2").alias("policy_source"),
    )
