"""Balanced label propagation of linked documents over a fixed number of shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import ranked, table, whole_text
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

SHARDS = 16
ROUNDS = 4
#: Room above an even share that a shard has while labels move; the last step takes it away.
SLACK = 0.1
LINK = ["_hash", "size", "text_crc32"]
BITS = 1 << 20


def _draw(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(BITS)) / F.lit(float(BITS))


def _sizes(state: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _let_in(flows: dict[tuple[int, int], int], sizes: list[int], quota: int) -> list[float]:
    """The share of those that want each shard that its quota lets in, given what leaves it then."""
    shards = range(len(sizes))
    wanted = [sum(n for (_, t), n in flows.items() if t == s) for s in shards]
    share = [1.0 if wanted[s] else 0.0 for s in shards]
    for _ in range(100):
        leaving = [sum(n * share[t] for (f, t), n in flows.items() if f == s) for s in shards]
        room = [quota - sizes[s] + leaving[s] for s in shards]
        share = [min(share[s], max(0.0, room[s]) / wanted[s]) if wanted[s] else 0.0 for s in shards]
    return share


def _pick(values: list, index: str) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.col(index).cast("int") + 1)


def propagate(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: counts at most one apart, equal texts together.

    Documents are linked if their texts are equal. Each starts in a shard drawn from its doc_id. In
    each round all documents of a linked group want the shard most of the group is in; a shard lets
    in as many as its quota (an even share and ``slack``) has room for as others leave, drawn by hash. Groups move as
    one; a group larger than half a quota is first split into parts below that size by a hash of
    doc_id, so that one with a third of all rows is spread over as few shards as it fills. At the
    end the rows above an even share leave their shard, those that cut no link first, for the
    shards below it. Slots number a shard's rows from 0.

    The text is read once; rounds join and count narrow keys. Only counts by shard (or two shards)
    reach the driver. The state is written in each round.

    Null and empty texts are equal (size 1). Repeated rows are rows of their own, a null doc_id is
    ordinary, other columns are ignored. No rows give no rows.
    """
    text = whole_text()
    base = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_hash"),
    )
    base = written(base, "sharding-rows")
    total = base.count()
    quota = max(1, int(total / shards * (1 + slack)))
    groups = base.groupBy(*LINK).agg(F.count(F.lit(1)).alias("_members")).where("_members > 1")
    parts = F.ceil(F.col("_members") / max(1, quota // 2))
    state = written(
        base.join(groups, LINK, "left").select(
            "doc_id", *LINK, F.col("_members").isNotNull().alias("_linked"),
            F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit("part")), parts), F.lit(0)).alias("_part"),
            F.pmod(F.xxhash64("doc_id", F.lit("start")), F.lit(shards)).cast("int").alias("shard"),
        ),
        "sharding-state",
    )
    unit = [*LINK, "_part"]
    for turn in range(rounds):
        sizes = _sizes(state, shards)
        counts = state.where("_linked").groupBy(*unit, "shard").agg(F.count(F.lit(1)).alias("_n"))
        # Among equally full shards a draw decides, else all ties would want the same shard.
        liked = F.max(F.struct("_n", _draw(*unit, F.col("shard"), F.lit(turn)).alias("_d"), "shard"))
        wants = counts.groupBy(*unit).agg(liked["shard"].alias("_want"))
        asking = state.join(wants, unit, "left").withColumn("_want", F.coalesce("_want", "shard"))
        flows = {
            (r["shard"], r["_want"]): r["n"]
            for r in asking.where("_want <> shard").groupBy("shard", "_want").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        if not flows:
            break
        share = _let_in(flows, sizes, quota)
        enters = _draw(*(F.col(c) for c in unit), F.lit(turn), F.lit("in")) < _pick(share, "_want")
        state = written(
            asking.withColumn("shard", F.when(enters, F.col("_want")).otherwise(F.col("shard")))
            .select(state.columns),
            "sharding-state",
        )
    sizes = _sizes(state, shards)
    even = [total // shards + (s < total % shards) for s in range(shards)]
    order = [F.xxhash64("doc_id", *LINK), F.col("doc_id")]
    numbered = ranked(state, ["shard"], order, "_rank", F.col("_linked").cast("int"))
    numbered = written(numbered, "sharding-ranked")
    leaves = F.col("_rank") < _pick([max(0, n - e) for n, e in zip(sizes, even, strict=True)], "shard")
    start, target = 0, F.lit(None).cast("int")
    leaving = written(numbered.where(leaves), "sharding-leaving")
    bounds: list[tuple[int, int]] = []
    for s in range(shards):
        start += max(0, even[s] - sizes[s])
        bounds.append((start, s))
    for bound, s in reversed(bounds):
        target = F.when(F.col("_place") < bound, F.lit(s)).otherwise(target)
    moved = ranked(leaving.drop("_rank"), [], order, "_place").withColumn("shard", target)
    columns = ["doc_id", "size", "text_crc32", "_hash", "shard"]
    settled = written(
        numbered.where(~leaves).select(*columns).unionByName(moved.select(*columns)), "sharding-settled"
    )
    return ranked(settled, ["shard"], [F.xxhash64("_hash", "doc_id"), F.col("doc_id"), F.col("size")], "slot").select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return propagate(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


register("op3_balanced_label_propagation", query)
