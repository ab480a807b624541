"""Resampling towards a target distribution: hashed word features, bucket gains, a seeded draw."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_or_shuffled, table, text_key, whole_text
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

#: Letters and digits of ASCII, and all other characters beyond it; upper case is gone before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_WORDS = 2
BUCKETS = 10_000
#: A histogram of so many counts is what the driver and each Python worker hold at most.
MOST_BUCKETS = 1 << 20
LEAST_WORDS = 20
PERCENT = 25
SEED = "7"
#: Feature buckets added up at once.
CHUNK = 1 << 21


def splitter() -> Callable[[str], list[tuple[str, tuple[int, int]]]]:
    """Words of a lower-cased text with their offsets, by an untrained pre-tokeniser."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(WORD), behavior="removed", invert=True).pre_tokenize_str


def lowered(text: str) -> str:
    """A-Z in lower case; the bytes of other characters are not touched, so offsets stay."""
    return text.encode().lower().decode()


def feature_windows(text: str, split, max_words: int = MAX_WORDS) -> Iterator[tuple[int, int, int]]:
    """(start, end, CRC) of each run of 1 to ``max_words`` words; offsets are those of the text.

    The windows are pairs of offsets: the start of a run's first word and the end of its last. What
    stands between two words counts as one space.
    """
    found = split(lowered(text))
    for n, crcs in enumerate(_crcs([w.encode() for w, _ in found], max_words)):
        for (_, (start, _)), (_, (_, end)), crc in zip(found, found[n:], crcs, strict=False):
            yield start, end, crc


def _crcs(words: list[bytes], max_words: int) -> list[list[int]]:
    """CRC of each run by its number of words: a run's CRC goes on from that of the run without its last word."""
    runs = [list(map(crc32, words))]
    spaced = [b" " + w for w in words]
    for n in range(1, max_words):
        runs.append(list(map(crc32, spaced[n:], runs[-1])))
    return runs


def feature_buckets(
    docs: DataFrame, keep: dict[str, Column], buckets: int = BUCKETS, max_words: int = MAX_WORDS
) -> DataFrame:
    """The ``keep`` columns, n_words, and ``features``: little-endian bucket numbers, repeats and all.

    A bucket number takes two bytes up to 65,536 buckets, else four. A null text has no words.
    """
    kind = _kind(buckets)
    given = docs.select(*(c.alias(n) for n, c in keep.items()), whole_text().alias("_text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for batch in batches:
            counts, packed = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                words = [w.encode() for w, _ in split(lowered(text))]
                runs = np.array([c for crcs in _crcs(words, max_words) for c in crcs], np.uint32)
                counts.append(len(words))
                packed.append((runs % np.uint32(buckets)).astype(kind).tobytes())
            out = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[:-1], "n_words", "features"])

    kept = given.drop("_text").schema
    return given.mapInArrow(work, kept.add("n_words", "long").add("features", "binary"))


def _kind(buckets: int) -> np.dtype:
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"1 to {MOST_BUCKETS} buckets, not {buckets}")
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket: a partial histogram a task, added up by Spark."""
    kind = _kind(buckets)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column(0):
                total += np.bincount(np.frombuffer(row.as_buffer(), kind), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    counts = features.select("features").mapInArrow(partial, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``features`` with n_features and weight (floored mean of gains, 0 without features) for the buckets."""
    kind = _kind(len(gain))
    shared = features.sparkSession.sparkContext.broadcast(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            counts, weights = [], []
            for row in batch.column(batch.num_columns - 1):
                met = np.frombuffer(row.as_buffer(), kind)
                total = sum(int(gain[met[i : i + CHUNK]].sum()) for i in range(0, len(met), CHUNK))
                counts.append(len(met))
                weights.append(total // len(met) if len(met) else 0)
            out = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[:-1], "n_features", "weight"])

    kept = features.drop("features").schema
    return features.mapInArrow(work, kept.add("n_features", "long").add("weight", "long"))


def noise(seed: str = SEED) -> Column:
    """floor(1000 x) of a Gumbel variate x that the seed and the doc_id decide; a null id is empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_features, weight, score, rank (null: not drawn).

    Features are runs of 1 to ``max_words`` consecutive words of the lower-cased text, hashed into
    buckets. A bucket's gain tells how much more of the target's features than of the documents'
    fall into it; a document's weight is the mean gain. Adding Gumbel noise and taking the highest
    scores draws without replacement in proportion to e^(weight / 1000). Drawn are ``percent`` of
    the rows with at least ``least_words`` words; ties go to the smaller doc_id (null ids last).

    Texts are split once; their bucket numbers (about four bytes a word) are written to the shared
    folder, counted there and weighed there. The driver holds two histograms and the number of rows
    of each score: scores are integers between fixed ends, some 10^5 at most however many rows there
    are. A row's rank is the number of rows with a higher score plus its place among equal scores.
    Rows of one document are counted before they are ranked, so repeats don't gather.

    A null or empty text has no features, weight 0, and is not drawn. Repeated rows each count, are
    drawn each on their own and take ranks in a row. An empty target gives weights from the
    smoothing alone; no rows give no rows. Other columns are ignored.
    """
    keep = {"doc_id": F.col("doc_id"), "text_key": text_key()}
    features = written(feature_buckets(docs, keep, buckets, max_words), "resampling-features")
    wanted = histogram(feature_buckets(target, {}, buckets, max_words), buckets)
    gain = gains(histogram(features, buckets), wanted)
    scored = written(
        weighed(features, gain).withColumn("score", F.col("weight") + noise(seed)), "resampling-scores"
    )
    able = F.col("n_words") >= least_words
    levels = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    most = percent * sum(r["n"] for r in levels) // 100
    above, starts = 0, []
    for score, n in sorted(((r["score"], r["n"]) for r in levels), reverse=True):
        if above >= most:
            break
        starts.append((score, above))
        above += n
    drawable = able & (F.col("score") >= starts[-1][0]) if starts else F.lit(False)
    names = ["doc_id", "text_key", "n_features", "weight", "score"]
    rest = scored.where(~drawable).select(*names, F.lit(None).cast("long").alias("rank"))
    if not starts:
        return rest
    first = docs.sparkSession.createDataFrame(starts, "score long, _start long")
    before = "rows between unbounded preceding and 1 preceding"
    order = "doc_id nulls last, n_features, text_key"
    drawn = (
        scored.where(drawable).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.expr(f"coalesce(sum(_n) over (partition by score order by {order} {before}), 0)"))
        .join(F.broadcast(first), "score")
        .withColumn("rank", F.explode(F.expr("sequence(_start + _before + 1, _start + _before + _n)")))
        .withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    )
    return rest.unionByName(drawn.select(*names, "rank"))


def draw(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that resample() draws, all columns as they were.

    Rows that repeat a doc_id and text are the same document: one drawn row keeps all of them.
    The drawn keys are broadcast up to a counted bound; beyond, both sides are shuffled.
    """
    drawn = resample(docs, target, **how).where("rank is not null")
    keys = written(drawn.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "resampling-drawn")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key"))
    return docs.join(small_or_shuffled(keys), same, "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


#: CRC over the hexadecimal digits of a feature's bytes, the low one of each byte first.
SQL = r"""
WITH sixteen AS (
  SELECT list_transform(range(16), lambda i: list_reduce(list_prepend(i, range(4)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
), texts AS (
  SELECT 0 AS side, doc_id AS id, row_number() OVER () AS pos, text FROM documents
  UNION ALL SELECT 1, item_id, -row_number() OVER (), text FROM benchmark
), words AS (
  SELECT side, id, pos, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), found AS (
  SELECT side, id, pos, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature
  FROM words
), counted AS (SELECT side, id, pos, feature, count(*) AS n FROM found GROUP BY ALL
), digits AS (
  SELECT feature, list_transform(string_split(hex(encode(feature)), ''), lambda c: instr('0123456789ABCDEF', c) - 1) AS d
  FROM (SELECT DISTINCT feature FROM counted)
), hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(d)), lambda i: d[i + 2 - 2 * (i % 2)])),
    lambda c, x: xor(c >> 4, step[(xor(c, x) & 15) + 1])), 4294967295) % 10000 AS bucket
  FROM digits, sixteen
), placed AS (SELECT side, id, pos, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL
), totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
  FROM placed GROUP BY bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * ((SELECT sum(s) FROM totals) + 10000)
    / (CAST(s + 1 AS DOUBLE) * ((SELECT sum(t) FROM totals) + 10000)))) AS BIGINT) AS g FROM totals
), summed AS (
  SELECT pos, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS total
  FROM placed JOIN gain USING (bucket) WHERE side = 0 GROUP BY pos
), scored AS (
  SELECT id AS doc_id, pos, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
         coalesce((total - (total % n_features + n_features) % n_features) // n_features, 0) AS weight,
         ('0x' || sha256('7:' || id)[:8])::BIGINT AS h
  FROM words LEFT JOIN summed USING (pos) WHERE side = 0
), final AS (
  SELECT *, weight + CAST(floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_words >= 20) OVER () AS n_able FROM final
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= 25 * n_able // 100 THEN place END AS rank
FROM ordered
"""

register("op11_importance_resampling", query, SQL)
