"""Exact aggregates that hold no group in memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.io import written

#: Distinct values of one group that a task may order, and slots of a further split.
MOST_RANKED = 100_000
SPLITS = 256
#: Groups up to which a table of one row a group is sent to all tasks.
BROADCAST_GROUPS = 1 << 20


def keep_one(df: DataFrame, keys: list[str], order: list[str], which: str = "first") -> DataFrame:
    """One row per key, the smallest or largest by ``order``.

    ``min_by``/``max_by`` over a struct combine on the map side, so a key that holds a third of all
    rows sends one row per task through the shuffle; a ``row_number`` window would gather them all.
    """
    pick = {"first": F.min_by, "last": F.max_by}[which]
    row = F.struct(*df.columns)
    rank = F.struct(*order)
    return (
        df.groupBy(*keys).agg(pick(row, rank).alias("_row")).select("_row.*").select(*df.columns)
    )


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows with one row a group, on keys of which a NULL is one like others.

    The rows stay where they are: dealt by key and sorted, a large group would be one task's. Only
    tables of many groups are shuffled.
    """
    right = written(right, "median-groups")
    if right.count() <= BROADCAST_GROUPS:
        right = F.broadcast(right)
    own = right.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return left.join(own, same).drop(*(f"_key{i}" for i in range(len(keys))))


def _running(keys: list[str], order: str) -> Column:
    """Rows up to and with this one, in the group's order, besides those known to lie below."""
    return F.col("_base") + F.sum("_n").over(Window.partitionBy(*keys).orderBy(order))


def _narrowed(inside: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct values between those split points that enclose both middle ranks, with ``_base``.

    Points are drawn from a sketch and what lies between them is counted exactly, so the middle is
    never lost; SPLITS slots a group are all that is ordered.
    """
    shares = [i / SPLITS for i in range(SPLITS + 1)]
    points = inside.groupBy(*keys).agg(F.percentile_approx("_v", shares, 20 * SPLITS).alias("_points"))
    slot = F.size(F.filter("_points", lambda p: p <= F.col("_v")))
    placed = written(_joined(inside, points, keys).withColumn("_slot", slot).drop("_points"), "median-slots")
    counted = placed.groupBy(*keys, "_base", "_lower", "_upper", "_slot").agg(F.sum("_n").alias("_n"))
    found = counted.withColumn("_cum", _running(keys, "_slot")).groupBy(*keys).agg(
        F.min(F.when(F.col("_cum") >= F.col("_lower"), F.col("_slot"))).alias("_first"),
        F.min(F.when(F.col("_cum") >= F.col("_upper"), F.col("_slot"))).alias("_last"),
        F.max(F.when(F.col("_cum") < F.col("_lower"), F.col("_cum"))).alias("_passed"),
    )
    return _joined(placed, found, keys).where(F.col("_slot").between(F.col("_first"), F.col("_last"))).select(
        *keys, "_v", "_n", F.coalesce("_passed", "_base").alias("_base"), "_lower", "_upper"
    )


def exact_median(
    df: DataFrame, keys: list[str], value: str, alias: str, most_ranked: int = MOST_RANKED
) -> DataFrame:
    """Exact interpolated median per group, for groups of any size.

    The built-in ``median`` keeps every distinct value of a group in one buffer. Here a sketch first
    brackets the middle (rank 0.5 +/- 0.002, sketch error 0.0001), values below the bracket are only
    counted, values above it are dropped, and the few inside are counted per distinct value and
    stored. While a group still has more than ``most_ranked`` of them they are split further about
    the middle; only then are they ranked, so no task orders more than that bound of a group. A round
    leaves some two in SPLITS values. Should the first bracket ever miss the middle the job fails: it
    never returns a guess.

    NULL and NaN are ignored, a NULL key is a group of its own, infinities are values like others.
    """
    v = F.col(value)
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v"))
    bracket = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", [0.498, 0.502], 10000).alias("_b"), F.count("_v").alias("_total"),
    ).select(*keys, "_total", F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi"))
    counted = written(
        _joined(rows, bracket, keys)
        .where(F.col("_v") <= F.col("_hi"))
        .withColumn("_v", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")))
        .groupBy(*keys, "_total", "_v")
        .agg(F.count(F.lit(1)).alias("_n")),
        "median-inside",
    )
    below = F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0))
    ranks = counted.groupBy(*keys).agg(
        below.alias("_base"), F.floor((F.max("_total") + 1) / 2).alias("_lower"),
        (F.floor(F.max("_total") / 2) + 1).alias("_upper"),
    )
    inside = _joined(counted.where("_v is not null").drop("_total"), ranks, keys)
    while (inside.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > most_ranked:
        inside = written(_narrowed(inside, keys), "median-narrowed")
    ends = inside.withColumn("_cum", _running(keys, "_v")).groupBy(*keys).agg(
        F.min(F.when(F.col("_cum") >= F.col("_lower"), F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_cum") >= F.col("_upper"), F.col("_v"))).alias("_z"),
        F.max(F.col("_base") >= F.col("_lower")).alias("_short"),
    )
    missed = F.col("_a").isNull() | F.col("_z").isNull() | F.col("_short")
    return ends.select(
        *keys,
        F.when(missed, F.raise_error(F.lit("median bracket missed the middle")).cast("double"))
        .otherwise((F.col("_a") + F.col("_z")) / 2)
        .alias(alias),
    )
