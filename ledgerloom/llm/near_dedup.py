"""Near duplicates: a multi-index Hamming join over b-bit minwise signatures, links confirmed on full sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    chunks, encoded, gram_hashes, mixed, small_or_shuffled, table, text_key, whole_text, without_rows, word_hashes,
)
from ledgerloom.llm.components import components
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

#: Similarity in percent from which texts are linked, and words in a shingle.
PERCENT = 80
SHINGLE = 5
#: The signature: CHUNKS chunks of CHUNK_SLOTS slots of 16 bits. A pair is found if at least one
#: chunk differs in at most one slot, so every pair whose signatures differ in at most
#: 2 * CHUNKS - 1 = 23 of 96 slots is found for certain; at a similarity of 0.8, where about 19
#: differ, one pair in 4,000 is missed, at 0.85 one in 200,000.
CHUNKS = 12
CHUNK_SLOTS = 8
SLOTS = CHUNKS * CHUNK_SLOTS
#: Rounds in which a bucket's members are tried against one of them before all remaining pairs are.
STAR_ROUNDS = 2
#: Members, and shingles of all members, of one block of a bucket; pairs of blocks meet in separate rows.
BLOCK = 256
BLOCK_SHINGLES = 1 << 18
#: Shingles in one product of incidence matrices.
WIDTH = 4096

_A = mixed(np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_B = mixed(np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Each text's distinct n-word shingles as sorted 64-bit hashes, A-Z lower-cased."""
    words, first = word_hashes(texts, lower=True)
    grams = gram_hashes(words, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(gram_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, SLOTS minima over affine permutations, 16 bits of each; empty sets give zeros."""
    out = np.zeros((len(sets), SLOTS), np.uint16)
    full = np.flatnonzero([len(s) > 0 for s in sets])
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
        for k in range(SLOTS):
            low = np.minimum.reduceat(flat * _A[k] + _B[k], starts)
            out[full, k] = (mixed(low) >> np.uint64(48)).astype(np.uint16)
    return out


def _hash_pair(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of shingles."""
    if not len(shingles):
        return 0, 0
    one = np.bitwise_xor.reduce(mixed(shingles + np.uint64(1)))
    two = np.add.reduce(mixed(shingles ^ np.uint64(0xC2B2AE3D27D4EB4F)))
    return int(np.int64(one.view(np.int64))), int(np.int64(two.view(np.int64)))


def signed_documents(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_a, set_b (names of the set), signature of every row."""
    def run(batches):
        for batch in batches:
            texts = encoded(batch.column(2))
            sizes, ones, twos, signs = [], [], [], []
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], n)
                sizes += map(len, sets)
                for one, two in map(_hash_pair, sets):
                    ones.append(one)
                    twos.append(two)
                signs += [row.tobytes() for row in signatures(sets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()),
                 pa.array(twos, pa.int64()), pa.array(signs, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "signature"],
            )

    schema = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, signature binary"
    return docs.select("doc_id", text_key().alias("text_key"), whole_text()).mapInArrow(run, schema)


def _chunk_keys(classes: DataFrame) -> DataFrame:
    """(key, cls): for each chunk and each of its slots, the chunk without that slot.

    Two chunks that differ in at most one slot share the key that leaves it out.
    """
    def run(batches):
        for batch in batches:
            cls = batch.column(0).to_numpy()
            if not len(cls):
                continue
            signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(cls), SLOTS)
            spread = mixed(signs.astype(np.uint64) + np.arange(SLOTS, dtype=np.uint64) * np.uint64(1 << 16))
            whole = spread.reshape(len(cls), CHUNKS, CHUNK_SLOTS)
            total = whole.sum(axis=2, keepdims=True)
            tags = np.arange(CHUNKS * CHUNK_SLOTS, dtype=np.uint64).reshape(1, CHUNKS, CHUNK_SLOTS)
            keys = mixed((total - whole) ^ mixed(tags + np.uint64(1))).reshape(len(cls), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(cls, SLOTS))], ["key", "cls"]
            )

    return classes.select("cls", "signature").mapInArrow(run, "key long, cls long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets of shingles reach ``percent``; each b's set is sent once a pair."""
    right = pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("_right")), "b")
    both = right.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("_left")), "a")
    met = F.size(F.array_intersect("_left", "_right"))
    return both.select("a", "b", met.alias("_met"), (F.size("_left") + F.size("_right")).alias("_sum")).where(
        100 * F.col("_met") >= percent * (F.col("_sum") - F.col("_met"))
    ).select("a", "b")


def _sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(cls, shingles) of the wanted classes, from the text of the row that stands for each."""
    rows = written(classes.join(wanted, "cls", "left_semi").select("doc_id", "text_key", "cls"), "near-rows")
    keyed = docs.select("doc_id", text_key().alias("text_key"), whole_text().alias("_text"))
    picked = small_or_shuffled(rows.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key"))
    found = keyed.join(picked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))

    def run(batches):
        for batch in batches:
            texts, cls = encoded(batch.column(1)), batch.column(0)
            done = 0
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], n)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                offsets = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [cls.slice(done, b - a), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64)))],
                    ["cls", "shingles"],
                )
                done = b

    sets = written(found.select("cls", "_text").mapInArrow(run, "cls long, shingles array<long>"), "near-sets")
    # Only repeated rows (one doc_id, one text) give a class twice.
    return sets.dropDuplicates(["cls"]) if sets.count() > rows.count() else sets


def _able(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The members that may have a link to another component, with what their overlaps need.

    ``size`` counts a member's shingles; ``held`` are those that other members have too, sorted.

    Two sets that reach ``percent`` share a shingle among the first ``size - percent of size + 1`` of
    each in any common order. Ordered by how many of the members have them, a text's own edits come
    first, so one with too many of them shares none and has no link outside its component.
    """
    nodes = written(members.select("cls", "root").distinct(), "near-nodes")
    each = nodes.join(sets, "cls").select("cls", "root", F.explode("shingles").alias("s"))
    common = each.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    ordered = each.join(common, "s").groupBy("cls", "root").agg(
        F.array_sort(F.collect_list(F.struct("n", "s"))).alias("all")
    )
    ordered = written(ordered, "near-ordered")
    size = F.size("all")
    rare = F.slice("all", F.lit(1), size - F.ceil(size * percent / 100).cast("int") + 1)
    first = written(ordered.select("cls", "root", F.explode(rare).alias("r")).where("r.n > 1").select("cls", "root", "r.s"), "near-rare")
    shared = first.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    able = first.join(shared.select("s"), "s", "left_semi").select("cls").distinct()
    held = F.transform(F.filter("all", lambda x: x["n"] > 1), lambda x: x["s"])
    sized = ordered.select(
        "cls", F.size("all").cast("long").alias("size"), F.array_sort(held).alias("held")
    ).join(able, "cls")
    return members.join(sized, "cls")


def _across(members: DataFrame) -> DataFrame:
    """Members of buckets that hold several components; of buckets with the same members, one."""
    kinds = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.bit_xor(F.xxhash64("cls")).alias("one"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("two"),
    ).where("low < high")
    return members.join(kinds.groupBy("n", "one", "two").agg(F.min("key").alias("key")).select("key"), "key")


class _Side:
    """One block of a bucket: roots, sizes and held shingles of its members."""

    def __init__(self, members: pa.StructArray):
        self.root, self.size = (members.field(n).to_numpy(zero_copy_only=False) for n in ("root", "size"))
        held = members.field("held")
        self.flat = held.flatten().to_numpy(zero_copy_only=False)
        self.counts = held.value_lengths().to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(len(self.root)), self.counts)

    def incidence(self, names: np.ndarray) -> np.ndarray:
        """1 where a member (row) has the shingle (column) of the sorted ``names``."""
        at = np.minimum(np.searchsorted(names, self.flat), len(names) - 1)
        there = names[at] == self.flat
        out = np.zeros((len(self.root), len(names)), np.float32)
        out[self.row[there], at[there]] = 1
        return out


def _linked_roots(left: _Side, right: _Side, percent: int) -> list[tuple[int, int]]:
    """Pairs of roots that links between the two blocks connect, without those that others imply."""
    sizes = left.size[:, None] + right.size[None, :]
    most = np.minimum(left.counts[:, None], right.counts[None, :])
    may = (left.root[:, None] != right.root[None, :]) & (100 * most >= percent * (sizes - most))
    if not may.any():
        return []
    names, met = np.intersect1d(left.flat, right.flat), np.zeros(may.shape, np.float32)
    for at in range(0, len(names), WIDTH):
        some = names[at : at + WIDTH]
        met += left.incidence(some) @ right.incidence(some).T
    met = met.astype(np.int64)
    i, j = np.nonzero(may & (100 * met >= percent * (sizes - met)))
    ends = np.sort(np.stack([left.root[i], right.root[j]], axis=1), axis=1)
    top: dict[int, int] = {}
    out = []
    for a, b in np.unique(ends, axis=0).tolist():
        x, y = a, b
        while x in top:
            x = top[x]
        while y in top:
            y = top[y]
        if x != y:
            top[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _remaining(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): roots that links between members of one bucket connect.

    A bucket is cut into blocks of about BLOCK members or BLOCK_SHINGLES shingles; every two blocks meet
    in a row of their own, which counts the overlaps of all their pairs exactly and lets out no more
    pairs of roots than it has members.
    """
    size = F.size("held")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("all")).select(
        "key", F.greatest(F.lit(1), F.least("n", F.greatest(
            F.ceil(F.col("n") / BLOCK), F.ceil(F.col("all") / BLOCK_SHINGLES)
        ))).alias("blocks"),
    )
    dealt = members.join(sizes, "key").withColumn("mine", F.pmod(F.xxhash64("cls", "key"), F.col("blocks")))
    packed = dealt.groupBy("key", "blocks", "mine").agg(
        F.collect_list(F.struct("root", "size", "held")).alias("members")
    )
    # Each block once for every block it meets: (lower, upper) of the two.
    met = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
        "low": F.least("mine", "other"), "high": F.greatest("mine", "other"),
    }).groupBy("key", "low", "high").agg(
        F.collect_list("members").alias("sides")
    )

    def run(batches):
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                sides = batch.column(0)[row].values
                left = _Side(sides[0].values)
                right = left if len(sides) == 1 else _Side(sides[1].values)
                found += _linked_roots(left, right, percent)
            ends = np.array(sorted(set(found)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return met.select("sides").mapInArrow(run, "a long, b long").distinct()


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after the links: one link between two roots stands for all between their nodes."""
    end = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
    return _merged(roots, links.join(end("a"), "a").join(end("b"), "b").select(
        F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")
    ).where("a < b").distinct())


def _merged(roots: DataFrame, between: DataFrame) -> DataFrame:
    """(node, root) after links (a, b) between roots."""
    merged = components(between).select(F.col("node").alias("root"), F.col("root").alias("_top"))
    return written(
        roots.join(merged, "root", "left").select("node", F.coalesce("_top", "root").alias("root")), "near-roots"
    )


def near_duplicates(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of every row.

    Rows are linked if their sets of ``n``-word shingles overlap by ``percent`` of their union; the
    component_id is the smallest doc_id that links reach. Rows of one set are one class, counted with
    map-side combine; classes are nodes. Signatures give candidates, full sets decide:

    1. In each bucket of equal chunk keys one member, the one that meets most others and then one
       by draw, is tried against every other that is in another component; each class tries the
       best of those its buckets offer, so it is one pair a class and round.
    2. All pairs in a bucket that are still in different components have their overlap counted, block
       against block, but for texts whose rarest shingles, and pairs whose shingles without company,
       show that they have no link. So no candidate link is left out; what is skipped are pairs that
       are known to be connected or known not to be linked.

    Rows with fewer words than ``n`` have their words as one shingle; rows without words are linked
    with nothing. Null texts are empty. A null doc_id is never a component_id unless all of its
    component are null. Repeated rows are in one class. No rows give no rows.
    """
    signed = written(signed_documents(docs, n), "near-signed")
    name = ["set_a", "set_b", "n_shingles"]
    classes = signed.where("n_shingles > 0").groupBy(*name).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("r"),
        F.first("signature").alias("signature"),
    )
    classes = written(
        classes.select(
            F.xxhash64(*name).alias("cls"), *name, "r.doc_id", "r.text_key", "signature"
        ), "near-classes",
    )
    keys = _chunk_keys(classes)
    crowded = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(keys.join(crowded, "key"), "near-buckets")
    degrees = written(buckets.groupBy("cls").agg(F.sum("n").alias("met")), "near-degrees")
    buckets = buckets.drop("n")
    sets = _sets_of(docs, classes, buckets.select("cls").distinct(), n)
    roots = written(
        buckets.select("cls").distinct().select(F.col("cls").alias("node"), F.col("cls").alias("root")), "near-roots"
    )
    for turn in range(STAR_ROUNDS):
        members = buckets.join(degrees, "cls").join(roots.withColumnRenamed("node", "cls"), "cls")
        # First the member that meets most others, which is the one that the others were made from; then by draw.
        draw = -F.col("met") if turn == 0 else F.xxhash64("cls", F.lit(turn))
        stars = members.groupBy("key").agg(
            F.min(F.struct(draw.alias("d"), "cls", "root")).alias("star"),
            F.min("root").alias("lowest"), F.max("root").alias("highest"),
        ).where("lowest < highest").select("key", "star")
        tried = members.join(stars, "key").where("root <> star.root").groupBy("cls").agg(
            F.min("star").alias("star")
        ).select(F.least("cls", "star.cls").alias("a"), F.greatest("cls", "star.cls").alias("b")).distinct()
        roots = _joined(roots, _confirmed(tried, sets, percent))
    members = buckets.join(roots.withColumnRenamed("node", "cls"), "cls").select("key", "cls", "root")
    able = _able(written(_across(members), "near-members"), sets, percent)
    able = written(_across(able), "near-able")
    roots = _merged(roots, written(_remaining(able, percent), "near-rest"))
    placed = classes.select("cls", *name, "doc_id").join(roots, F.col("cls") == F.col("node"), "left")
    placed = written(placed.select(*name, "cls", "doc_id", F.coalesce("root", "cls").alias("root")), "near-placed")
    lowest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(lowest, "root").select(*name, "component_id")
    worded = signed.where("n_shingles > 0").select("doc_id", "text_key", *name).join(named, name).drop("set_a", "set_b")
    bare = signed.where("n_shingles = 0").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"))
    return worded.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their component, all columns as they were."""
    marked = near_duplicates(docs, n, percent)
    gone = written(marked.where("not kept").select("doc_id", "text_key").distinct(), "near-gone")
    return without_rows(docs, gone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's shingles of four words."""
    return near_duplicates(table(spark, sf_dir, "documents"), n=4).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


register("op9_multi_index_hamming", query)
