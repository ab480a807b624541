"""Quality rules by robust multivariate outliers, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE_CLASS, small_or_shuffled, table, whole_text
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

SYMBOLS = "#*$%&|<>"  # Fixed value.
SPACES = " \t\n\x0b\x0c\r"
REPEAT_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Rows a (language, source) group needs for estimates of its own; smaller ones are pooled.
MIN_ROWS = 60
#: Concentration steps end when no group's determinant changes by more than this share, or after so many.
SETTLED = 0.01
C_STEPS = 10
#: Share of a group that the determinant is minimised over.
CORE = 0.75
#: Squared distance beyond which a text is rejected. The 0.9999 quantile of chi-squared with five
#: degrees of freedom is 25.7; text statistics have heavier tails than the normal.
CUTOFF = 45.0
CHI2_5_MEDIAN = 4.351
#: Transformed statistics, each with the least standard deviation that it is taken to have: small
#: enough that repeated lines (from half of the lines) or words (from a fifth) alone go beyond
#: CUTOFF where other texts have none.
FEATURES = {"f_length": 0.08, "f_symbols": 0.5, "f_lines": 0.095, "f_repeats": 0.063, "f_upper": 0.04}
KEYS = list(FEATURES)


def _repeated_words(docs: DataFrame, n: int = REPEAT_WORDS) -> DataFrame:
    """Add n_repeat_words from ``_words``: words inside windows of eight that occur twice or more.

    Window hashes come from doubling: pairs, pairs of pairs, and pairs of those. Only texts with a
    repeated window sort theirs to find which.
    """
    def doubled(name: str, step: int) -> Column:
        left = F.size(name) - step
        return F.when(left > 0, F.zip_with(
            F.slice(name, F.lit(1), left), F.slice(name, F.lit(step + 1), left), lambda a, b: F.xxhash64(a, b)
        )).otherwise(F.array().cast("array<bigint>"))

    hashed = docs.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        hashed = hashed.withColumn("_h", doubled("_h", step))
    again = F.size(F.array_distinct("_h")) < F.size("_h")
    pairs = F.arrays_zip(F.col("_h").alias("h"), F.sequence(F.lit(0), F.size("_h") - 1).alias("p"))
    hashed = hashed.withColumn("_s", F.when(again, F.array_sort(pairs))).drop("_h")
    left = F.size("_s") - 1
    same = F.zip_with(
        F.slice("_s", F.lit(1), left), F.slice("_s", F.lit(2), left),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])),
    )
    at = F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))
    covered = F.aggregate(
        at, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(
            (p + n).alias("end"), (acc["n"] + p + n - F.greatest(p, acc["end"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    found = F.when(F.col("_s").isNotNull(), covered).otherwise(F.lit(0))
    return hashed.withColumn("n_repeat_words", found.cast("long")).drop("_s")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base statistics, base_failed and the transformed statistics."""
    text = docs.select("doc_id", "lang", "source", whole_text().alias("_text"))
    bare = F.translate("_text", SPACES, "")
    with_words = F.filter(
        F.split("_text", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0
    )
    counted = text.withColumns({
        "_words": F.array_remove(F.split("_text", SPACE_CLASS, -1), ""), "_lines": with_words,
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        "_upper": F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")),
    }).withColumns({
        "n_words": F.size("_words").cast("long"), "_n_lines": F.size("_lines"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }).drop("_text", "_lines")
    stats = _repeated_words(counted).drop("_words")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    return stats.withColumns({
        "base_failed": failed,
        "f_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        "f_symbols": F.log1p(100.0 * share("n_symbols", "word_chars")),
        "f_lines": F.sqrt(share("n_dup_lines", "_n_lines")), "f_repeats": F.sqrt(share("n_repeat_words", "n_words")),
        "f_upper": F.sqrt(share("_upper", "word_chars")),
    }).drop("_upper", "_n_lines")


def _grouped(stats: DataFrame, min_rows: int) -> DataFrame:
    """Add _group: the row's language and source, or a pool of small groups; null where too few."""
    own = ["_lang", "_source"]
    named = stats.withColumns({
        "_lang": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")),
        "_source": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
    })
    sizes = named.where("not base_failed").groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(
        *own, "_n", F.expr("sum(if(_n < %d, _n, 0)) over (partition by _lang)" % min_rows).alias("_pool")
    )
    label = (
        F.when(F.col("_n") >= min_rows, F.to_json(F.struct(*own)))
        .when(F.col("_pool") >= min_rows, F.to_json(F.struct("_lang")))
        .otherwise(F.lit("{}"))
    )
    groups = sizes.withColumn("_group", label).select(
        *own, "_group", F.expr("sum(_n) over (partition by _group)").alias("_rows")
    ).where(F.col("_rows") >= min_rows)
    return named.join(groups.drop("_rows"), own, "left").drop(*own)


def _names(prefix: str) -> list[str]:
    return [f"{prefix}_{i}_{j}" for i in range(len(KEYS)) for j in range(i + 1)]


def _factored(groups: DataFrame) -> DataFrame:
    """Replace covariances c_i_j (floors added to the variances) by their Cholesky factor l_i_j."""
    floors = list(FEATURES.values())
    for i in range(len(KEYS)):
        for j in range(i + 1):
            value = F.coalesce(F.col(f"c_{i}_{j}"), F.lit(0.0))
            if i == j:
                value = value + floors[i] ** 2
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            value = F.sqrt(F.greatest(value, F.lit(floors[i] ** 2))) if i == j else value / F.col(f"l_{j}_{j}")
            groups = groups.withColumn(f"l_{i}_{j}", value)
    return groups.drop(*_names("c"))


def _distances(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Add _d2, the squared Mahalanobis distance; null for rows without a group."""
    away = rows.join(small_or_shuffled(groups), "_group", "left")
    for i, key in enumerate(KEYS):
        value = F.col(key) - F.col(f"m_{i}")
        for k in range(i):
            value = value - F.col(f"l_{i}_{k}") * F.col(f"_y{k}")
        away = away.withColumn(f"_y{i}", value / F.col(f"l_{i}_{i}"))
    total = sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(len(KEYS))), F.lit(0.0))
    return away.withColumn("_d2", total).select(*rows.columns, "_d2")


def _estimates(rows: DataFrame) -> DataFrame:
    pairs = [(i, j) for i in range(len(KEYS)) for j in range(i + 1)]
    moments = rows.groupBy("_group").agg(
        *(F.avg(k).alias(f"m_{i}") for i, k in enumerate(KEYS)),
        *(F.covar_pop(KEYS[i], KEYS[j]).alias(f"c_{i}_{j}") for i, j in pairs),
    )
    return written(_factored(moments), "outliers-groups")


def _moved(before: DataFrame, after: DataFrame) -> float:
    """The largest relative change of a group's determinant, one number for all groups."""
    det = lambda side: sum((2 * F.log(F.col(f"{side}.l_{i}_{i}")) for i in range(len(KEYS))), F.lit(0.0))
    change = F.abs(F.exp(det("b") - det("a")) - 1)
    return before.alias("a").join(after.alias("b"), "_group").agg(F.max(change).alias("x")).first()["x"] or 0.0


def quality(docs: DataFrame, min_rows: int = MIN_ROWS, c_steps: int = C_STEPS, cutoff: float = CUTOFF) -> DataFrame:
    """One row per row of ``docs``: doc_id, base statistics, base_failed, distance, kept.

    Statistics of the whole text become five transformed values (mean word length, shares of
    symbols, repeated lines, repeated words and capitals). Minimum-covariance-determinant estimates
    for each language and source start from medians and absolute deviations; each concentration
    step keeps the CORE share of rows with the least distances and estimates mean and covariance
    from them, until the determinants settle. A row is rejected if its squared Mahalanobis distance is beyond ``cutoff``.

    Groups with fewer than ``min_rows`` rows are pooled by language, and pools still smaller over
    all languages; a row in a pool smaller than that has a null distance and only the base rules.
    Rows that fail the base rules shape no estimate. The text is read once; all else joins and
    aggregates narrow rows, with map-side partial sums, so a source with a third of all rows is a
    few rows per task.

    Null texts have no words and fail the base rules. A null language or source is a value of its
    own. Repeated rows count as often as they occur; no rows give no rows.
    """
    rows = written(_grouped(written(statistics(docs), "outliers-stats"), min_rows), "outliers-rows")
    fit = rows.where("not base_failed and _group is not null").select("_group", *KEYS)
    near = lambda c, q: F.percentile_approx(c, F.lit(q), F.lit(2000))
    medians = written(
        fit.groupBy("_group").agg(*(near(F.col(k), 0.5).alias(f"m_{i}") for i, k in enumerate(KEYS))),
        "outliers-medians",
    )
    spread = fit.join(small_or_shuffled(medians), "_group").groupBy("_group").agg(*(
        F.pow(1.4826 * near(F.abs(F.col(k) - F.col(f"m_{i}")), 0.5), F.lit(2)).alias(f"c_{i}_{i}")
        for i, k in enumerate(KEYS)
    ))
    off = {f"c_{i}_{j}": F.lit(0.0) for i in range(len(KEYS)) for j in range(i)}
    groups = written(_factored(medians.join(spread, "_group").withColumns(off)), "outliers-groups")
    for _ in range(c_steps):
        away = _distances(fit, groups)
        edges = written(away.groupBy("_group").agg(near("_d2", CORE).alias("_edge")), "outliers-edges")
        before, groups = groups, _estimates(away.join(small_or_shuffled(edges), "_group").where("_d2 <= _edge"))
        if _moved(before, groups) <= SETTLED:
            break
    away = _distances(fit, groups)
    scale = written(
        away.groupBy("_group").agg(
            F.greatest(near("_d2", 0.5) / CHI2_5_MEDIAN, F.lit(1.0)).alias("_scale")
        ), "outliers-scale",
    )
    final = _distances(rows, groups).join(small_or_shuffled(scale), "_group", "left")
    distance = F.col("_d2") / F.col("_scale")
    return final.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"),
        distance.alias("distance"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


register("op2_robust_outliers", query)
