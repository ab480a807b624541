"""Hard-negative mining by exact integer inner products, several candidates a multiplication."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import table
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score lies between this share of the positive's score and that score.
LOW = (4, 5)
#: Components of the anchors that are scored at once; they are held by the driver and each worker.
GROUP_COMPONENTS = 1 << 22
#: Scores, or components of candidates, that a worker holds at once.
CHUNK = 1 << 21
#: Candidates in one integer where a machine word is too narrow.
WIDE_FIELDS = 16
#: Components of rows are small below the first bound and fit a machine word below the second.
CLASSES = (1 << 12, 1 << 26)
NONE = np.iinfo(np.int64).min


# ---- exact products --------------------------------------------------------------------------

def packed_products(candidates: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: candidates x anchors, as 64-bit integers.

    The candidates' components are raised by a bias so that none is negative, and those of several
    candidates are set side by side in fields of one wide integer. Multiplying it by an anchor's
    component multiplies every field; the sum over components holds one candidate's sum a field,
    wide enough by the bounds of both sides never to run into the next. Where two fields don't fit
    64 bits, Python's integers of any width hold them. Scores beyond 64 bits stop at the ends.
    """
    n, d = candidates.shape
    if not n or not d or not len(anchors):
        return np.zeros((n, len(anchors)), np.int64)
    candidates, anchors = (_safe(rows) for rows in (candidates, anchors))
    bias = -min(int(candidates.min()), 0)
    highest = int(candidates.max()) + bias
    longest = max(int(a) for a in np.abs(anchors).sum(axis=1))
    reach = highest * longest
    width = (2 * reach).bit_length() + 1
    kind, fields = (np.uint64, 64 // width) if width <= 64 else (object, WIDE_FIELDS)
    raised = np.zeros((-(-n // fields), fields, d), kind)
    raised.reshape(-1, d)[:n] = (candidates + bias).astype(kind)
    shifts = [_as(kind, width * j) for j in range(fields)]
    wide = raised[:, 0]
    for j in range(1, fields):
        wide = wide | (raised[:, j] << shifts[j])
    sums = _multiplied(wide, anchors.astype(np.int64).astype(np.uint64) if kind is np.uint64 else anchors.astype(object))
    # Signed fields: raised by their reach, they are not negative either.
    sums = sums + _as(kind, sum(reach << (width * j) for j in range(fields)))
    mask = _as(kind, (1 << width) - 1)
    less = reach + bias * anchors.sum(axis=1, dtype=object)
    out = np.empty((len(wide), fields, len(anchors)), np.int64)
    for j in range(fields):
        field = (sums >> shifts[j]) & mask
        if kind is object:
            out[:, j] = np.clip(field - less, NONE + 1, -(NONE + 1)).astype(np.int64)
        else:
            out[:, j] = field.astype(np.int64) - less.astype(np.int64)
    return out.reshape(-1, len(anchors))[:n]


def _safe(rows: np.ndarray) -> np.ndarray:
    """64-bit integers where sums over components stay far inside them, else Python's integers."""
    wide = max(-int(rows.min()), int(rows.max())) > CLASSES[-1]
    return rows.astype(object if wide else np.int64)


def _as(kind, value: int):
    return np.uint64(value & ((1 << 64) - 1)) if kind is np.uint64 else value


def _multiplied(wide: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Sum over components of wide integer times anchor component; 64-bit words wrap around."""
    if wide.dtype == object:
        return wide.dot(anchors.T)
    return np.matmul(wide, np.ascontiguousarray(anchors.T))


def _classes(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of rows, rows) by size of the largest component, so that few large ones widen no others."""
    size = np.abs(rows).max(axis=1, initial=0)
    edges = [-1, *CLASSES]
    for low, high in zip(edges, [*CLASSES, math.inf], strict=True):
        if len(met := np.flatnonzero((size > low) & (size <= high))):
            yield met, rows[met]


def scores(candidates: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """packed_products() by classes of size; a shorter row's missing components count as 0."""
    d = min(candidates.shape[1], anchors.shape[1])
    out = np.zeros((len(candidates), len(anchors)), np.int64)
    of_anchors = list(_classes(anchors[:, :d]))
    for rows, c in _classes(candidates[:, :d]):
        for columns, a in of_anchors:
            if len(rows) == len(candidates) and len(columns) == len(anchors):
                return packed_products(c, a)
            out[np.ix_(rows, columns)] = packed_products(c, a)
    return out


def quantised(lengths: np.ndarray, values: np.ndarray, scale: int) -> np.ndarray:
    """Rows of floor(scale * x), padded with 0; Python integers where 64 bits don't hold them."""
    whole = np.floor(values * float(scale))
    if np.abs(whole).max(initial=0) < 2**62:
        whole, kind = whole.astype(np.int64), np.int64
    else:
        whole, kind = np.array([int(x) for x in whole], object), object
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), kind)
    out[np.arange(out.shape[1]) < lengths[:, None]] = whole
    return out


# ---- best of a task --------------------------------------------------------------------------

class Best:
    """The first ``most`` (score, id) of each column: higher scores first, then smaller ids."""

    def __init__(self, columns: int, most: int):
        self.most = most
        self.score = np.full((columns, most), NONE)
        self.id = np.full((columns, most), np.iinfo(np.int64).max)

    def meet(self, ids: np.ndarray, values: np.ndarray) -> None:
        """``ids`` ascend; ``values`` (rows x columns) hold NONE where a row does not count."""
        highest = values.max(axis=0, initial=NONE)
        for j in np.flatnonzero((highest > NONE) & (highest >= self.score[:, -1])):
            column = values[:, j]
            rows = np.flatnonzero((column >= self.score[j, -1]) & (column > NONE))
            if len(rows) > self.most:
                # All above the last place's score, and of that score's rows as many as there is room for.
                least = np.partition(column[rows], len(rows) - self.most)[len(rows) - self.most]
                above = rows[column[rows] > least]
                rows = np.concatenate((above, rows[column[rows] == least][: self.most - len(above)]))
            score = np.concatenate((self.score[j], column[rows]))
            met = np.concatenate((self.id[j], ids[rows]))
            order = np.lexsort((met, ~score))[: self.most]
            self.score[j], self.id[j] = score[order], met[order]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(column, id, score) of all that is held."""
        column, place = np.nonzero(self.score > NONE)
        return column, self.id[column, place], self.score[column, place]


def _integer_rows(batch: pa.RecordBatch, scale: int, columns: int) -> Iterator[tuple]:
    """(ids ascending, labels, rows of integers), so many at once that scores of ``columns`` fit."""
    ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    vectors = batch.column(2)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    most = max(1, CHUNK // max(columns, int(lengths.max(initial=1)), 1))
    for a in range(0, len(ids), most):
        b = min(a + most, len(ids))
        order = np.argsort(ids[a:b], kind="stable")
        rows = quantised(lengths[a:b], values[starts[a] : starts[b]], scale)
        yield ids[a:b][order], labels[a:b][order], rows[order]


# ---- the join in blocks ----------------------------------------------------------------------

def taking_part(rows: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """vec_id, label, vector of the rows that have an id, a label and a vector of finite components."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.select(
        vec_id.cast("long").alias("vec_id"), label.cast("long").alias("label"),
        vector.cast("array<double>").alias("vector"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)


def _first(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first rows of each key by score and id, with their rank; tasks let out few rows a key each."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _positives(rows: DataFrame, group: tuple, most: int, scale: int) -> DataFrame:
    """The first rows of each anchor's label; anchors by their number in the group."""
    shared = rows.sparkSession.sparkContext.broadcast(group)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, anchors = shared.value
        best = Best(len(ids), most)
        for batch in batches:
            for met, of, vectors in _integer_rows(batch, scale, len(ids)):
                values = scores(vectors, anchors)
                values[(of[:, None] != labels) | (met[:, None] == ids)] = NONE
                best.meet(met, values)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.rows()], ["anchor", "vec_id", "score"])

    return _first(rows.mapInArrow(work, "anchor long, vec_id long, score long"), ["anchor"], most)


def _negatives(rows: DataFrame, group: tuple, tops: np.ndarray, met: np.ndarray, most: int, scale: int) -> DataFrame:
    """The first rows of other labels in the band below each score of ``tops``, the positives' scores.

    ``tops`` and ``met`` (the positives' ids) are anchors x places; a score is NONE where there is none.
    """
    shared = rows.sparkSession.sparkContext.broadcast((*group, tops, met))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, anchors, tops, met = shared.value
        share, of_all = LOW
        lows = tops // of_all * share - (-(tops % of_all * share)) // of_all
        best = [Best(len(ids), most) for _ in tops.T]
        for batch in batches:
            for found, of, vectors in _integer_rows(batch, scale, len(ids)):
                values = scores(vectors, anchors)
                values[of[:, None] == labels] = NONE
                for held, top, low in zip(best, tops.T, lows.T, strict=True):
                    held.meet(found, np.where((values <= top) & (values >= low) & (top >= 0), values, NONE))
        for place, held in enumerate(best):
            column, found, score = held.rows()
            out = [ids[column], met[column, place], tops[column, place], np.full(len(column), place), found, score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)

    names = ["anchor_id", "positive_id", "positive_score", "place", "vec_id", "score"]
    found = rows.mapInArrow(work, ", ".join(f"{n} long" for n in names))
    return _first(found, ["anchor_id", "place"], most)


def mine(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    scale: int = SCALE,
) -> DataFrame:
    """Hard negatives of the rows for which ``anchors`` holds, against all rows of taking_part().

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Scores are
    exact inner products of the components floor(scale * x). An anchor's positives are its first
    other rows of the same label, its negatives for a positive the first rows of other labels that
    score at least 4/5 of the positive's score and not above it; higher scores come first, ties by
    smaller id. A positive with a negative score has no negatives.

    Anchors go in groups of about GROUP_COMPONENTS components. A group is held by the driver and
    shared with the tasks, which score it against all rows in two passes, in blocks, and keep the
    first few of each anchor; no row is shuffled but those, and no pair outlives its block. Labels
    don't matter for how rows are dealt, so a label or a vector with a third of all rows is spread
    like any other.

    Rows of the anchor's own id are never its positives. Rows that repeat an id are candidates each
    on their own; of anchors with one id, that of the smallest (label, vector) counts. Rows of
    different lengths are padded with 0, so an empty vector scores 0. Scores beyond 64 bits stop at
    the ends. No rows, or no anchors, give no rows.
    """
    spark = rows.sparkSession
    chosen = written(
        rows.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("_row"))
        .select("vec_id", "_row.label", "_row.vector"),
        "anchors",
    )
    size = chosen.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d")).first()
    groups = -(-size["n"] * max(size["d"] or 0, 64) // GROUP_COMPONENTS)
    out = spark.createDataFrame([], SCHEMA)
    for number in range(groups):
        held = chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == number).toArrow()
        if held.num_rows:
            out = out.unionByName(written(_of_group(rows, held, positives, negatives, scale), "hard-negatives"))
    return out


def _of_group(rows: DataFrame, held: pa.Table, positives: int, negatives: int, scale: int) -> DataFrame:
    ids, labels = (held.column(i).to_numpy() for i in (0, 1))
    vectors = held.column(2).combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    group = ids, labels, quantised(lengths, vectors.flatten().to_numpy(zero_copy_only=False), scale)
    tops, met = np.full((len(ids), positives), NONE), np.zeros((len(ids), positives), np.int64)
    for row in _positives(rows, group, positives, scale).collect():
        tops[row["anchor"], row["rank"] - 1] = row["score"]
        met[row["anchor"], row["rank"] - 1] = row["vec_id"]
    return _negatives(rows, group, tops, met, negatives, scale).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


SCHEMA = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = taking_part(table(spark, sf_dir, "embeddings"), F.col("vec_id"), moved, F.col("embedding"))
    return mine(rows, F.col("vec_id") % 100 == 0)


SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

register("op13_kronecker_hard_negatives", query, SQL)
