"""What several operators share: reading, row keys, exact distributed ranks, word hashes in numpy."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = bytes((0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))

#: Rows that a broadcast may hold; beyond, the join shuffles. 2^20 keys of 16 bytes are 16 MB.
BROADCAST_ROWS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def small_or_shuffled(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is.

    The rows are counted over a written table, so the count reads only its footers.
    """
    return F.broadcast(df) if df.count() <= rows else df


def ranked(
    df: DataFrame, group: list[str], order: list[Column], name: str, first: Column | None = None,
    rows_per_bucket: int = 200_000,
) -> DataFrame:
    """Add ``name``: the row's rank from 0 in its group, gapless, with no group in one task.

    Rows are dealt into hash buckets of ``order``; ranks inside a bucket come from a window, the
    bucket's own start from sums over (group, bucket) counts. ``first`` (a small integer) ranks
    before everything else. ``df`` must be a written table; ``group`` columns must not be null.
    """
    buckets = max(4, -(-df.count() // rows_per_bucket))
    lead = F.lit(0) if first is None else first
    dealt = df.withColumn("_bucket", lead * buckets + F.pmod(F.xxhash64(*order), F.lit(buckets)))
    keys = [*group, "_bucket"]
    before = "rows between unbounded preceding and 1 preceding"
    part = f"partition by {', '.join(group)}" if group else "partition by 1"
    starts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, F.expr(f"coalesce(sum(_n) over ({part} order by _bucket {before}), 0)").alias("_start")
    )
    from pyspark.sql import Window

    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        dealt.join(starts, keys)
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_start")
    )


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, whose texts go to Python 1,000 rows at a time where the session leaves Spark's default.

    A worker and its JVM hold a few megabytes of texts at once then, not tens. The setting is the
    session's and stays.
    """
    conf = docs.sparkSession.conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, "1000")
    return docs


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text) occurs in ``gone`` (doc_id, text_key).

    The keys are broadcast up to BROADCAST_ROWS of them; beyond, both sides are shuffled.
    """
    gone = small_or_shuffled(gone.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key"))
    return docs.join(gone, same, "left_anti")


def text_key() -> Column:
    """64 bits of the text; with the doc_id they name a row."""
    return F.xxhash64(whole_text())


class Memory(dict):
    """What was worked out before; shrink() forgets everything once it holds ``most`` entries."""

    def __init__(self, make, most: int):
        self._make, self._most = make, most

    def __missing__(self, key):
        found = self[key] = self._make(key)
        return found

    def shrink(self) -> None:
        if len(self) > self._most:
            self.clear()


# ---- numpy -----------------------------------------------------------------------------------

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
CHUNK_BYTES = 1 << 19


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _MULTIPLIER), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(CHUNK_BYTES + 65_536, 1 << (n - 1).bit_length()))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def encoded(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column without nulls."""
    return column.cast(pa.large_binary()).to_pylist()


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, in order; number of the first word of each text, and the end).

    Words are runs of bytes other than white space. ``lower`` lower-cases A-Z first.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    inside = _IS_WORD[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        change = np.concatenate(([0], change))
    starts, ends = change[0::2], change[1::2]
    if lower:
        data = _LOWER[data]
    up, down = _powers_for(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    first = np.zeros(len(texts) + 1, np.int64)
    first[1:] = np.searchsorted(starts, ends_of_texts)
    return mixed(h + (ends - starts).astype(np.uint64) * _MIX), first


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on (fewer positions than words by n - 1)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = _powers_for(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mixed((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])
