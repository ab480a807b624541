"""Language identification: text likelihoods fused with declared language and smoothed host priors."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks, encoded, small_or_shuffled, table, text_key, whole_text, without_rows
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

#: Hashed byte trigrams: the text model has at most BUCKETS numbers a language.
BUCKETS = 1 << 14
#: Languages whose dense model is held at once (64 KB each), and counted at once in a task.
LANGUAGES_AT_ONCE = 64
#: Strength, in trigrams, of the background model in a language's.
BACKGROUND_STRENGTH = 2000.0
#: Languages whose text score is further below the best are not carried on: no prior makes up for e^100.
SCORE_SPAN = 100.0
#: Share of its rows, and HOST_STRENGTH more, that a host's main language needs to be named by it.
HOST_NAMES = 0.9
#: Trigrams that count in full; a longer text weighs no more, since its trigrams depend on each other.
FULL_TRIGRAMS = 150
#: Strength, in rows, of a suffix's prior in a host's, and of the global prior in a suffix's.
HOST_STRENGTH, SUFFIX_STRENGTH = 20.0, 20.0
#: Rows of an even guess added to the counts of declared languages.
DECLARED_STRENGTH = 1.0
MIN_CONFIDENCE = 0.5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def trigrams(text: bytes) -> np.ndarray:
    """Buckets of the text's byte trigrams, A-Z lower-cased; runs of other bytes count as they are."""
    data = _LOWER[np.frombuffer(text, np.uint8)].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    codes = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    return ((codes * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def declared_code(column: Column) -> Column:
    """The primary part of a language tag in lower case: en-GB and EN_us are en; null if empty."""
    code = F.lower(F.regexp_extract(F.coalesce(column, F.lit("")), r"^\s*([A-Za-z]{2,8})", 1))
    return F.when(code != "", code)


def page_evidence(pages: DataFrame) -> DataFrame:
    """(doc_id, text, declared, host, suffix) of pages: the html tag's language and the address."""
    host = F.lower(F.expr("try_parse_url(url, 'HOST')"))
    return pages.select(
        F.col("page_id").alias("doc_id"), F.col("html").alias("text"),
        F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z_-]+)", 1).alias("declared"),
        host.alias("host"), F.regexp_extract(F.coalesce(host, F.lit("")), r"([^.]+)$", 1).alias("suffix"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """The same of documents: their lang is what was declared, their source the host; no address."""
    return docs.select(
        "doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"),
        F.lit(None).cast("string").alias("suffix"),
    )


def _trained(rows: DataFrame) -> DataFrame:
    """(declared, bucket, n): trigram counts of all rows by the language they declare, null if none."""
    def counted(counts):
        for name, held in counts.items():
            bucket = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(bucket), pa.string()), pa.array(bucket.astype(np.int32)), pa.array(held[bucket])],
                ["declared", "bucket", "n"],
            )

    def run(batches):
        counts = {}
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), encoded(batch.column(1)), strict=True):
                if name not in counts:
                    if len(counts) >= LANGUAGES_AT_ONCE:
                        yield from counted(counts)
                        counts = {}
                    counts[name] = np.zeros(BUCKETS, np.int64)
                counts[name] += np.bincount(trigrams(text), minlength=BUCKETS)
        yield from counted(counts)

    return rows.select("declared", "text").mapInArrow(run, "declared string, bucket int, n long").groupBy(
        "declared", "bucket"
    ).agg(F.sum("n").alias("n"))


def _model(counts: DataFrame, languages: list[str]) -> tuple[np.ndarray, list[tuple]]:
    """(background's share of each bucket; languages' counts, sparse, LANGUAGES_AT_ONCE in a part)."""
    background = np.full(BUCKETS, 0.5)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        background[r["bucket"]] += r["n"]
    parts = []
    for at in range(0, len(languages), LANGUAGES_AT_ONCE):
        number = {name: i for i, name in enumerate(languages[at : at + LANGUAGES_AT_ONCE])}
        got = counts.where(F.col("declared").isin(list(number))).toPandas()
        parts.append((
            len(number), got["declared"].map(number).to_numpy(np.int32), got["bucket"].to_numpy(np.int32),
            got["n"].to_numpy(np.int64),
        ))
    return background / background.sum(), parts


def _dense(background: np.ndarray, part: tuple) -> np.ndarray:
    """Log likelihoods (bucket, language) of one part, smoothed towards the background."""
    size, language, bucket, n = part
    model = np.tile(BACKGROUND_STRENGTH * background[:, None], (1, size))
    model[bucket, language] += n
    return np.log(model / model.sum(axis=0)).astype(np.float32)


def _likelihoods(rows: DataFrame, background: np.ndarray, parts: list[tuple]) -> DataFrame:
    """Add classes and scores (tempered log likelihoods near the best), and excess.

    Excess is the mean gain a trigram over an even draw of buckets, by the background model or the
    best language's, whichever is more.
    """
    chance = math.log(BUCKETS)
    shared = rows.sparkSession.sparkContext.broadcast((background, parts))

    def run(batches):
        background, parts = shared.value
        even = np.log(background)
        only = _dense(background, parts[0]) if len(parts) == 1 else None
        for batch in batches:
            texts = encoded(batch.column(batch.num_columns - 1))
            classes, scores, excess = [], [], []
            for a, b in chunks(texts):
                found = [trigrams(text) for text in texts[a:b]]
                means = [[] for _ in found]
                for part in parts:
                    model = only if only is not None else _dense(background, part)
                    for mean, buckets in zip(means, found, strict=True):
                        total = np.bincount(buckets, minlength=BUCKETS).astype(np.float32) @ model
                        mean.append(total / max(len(buckets), 1))
                for mean, buckets in zip(means, found, strict=True):
                    mean = np.concatenate(mean).astype(np.float64) if mean else np.zeros(0)
                    score = mean * min(len(buckets), FULL_TRIGRAMS)
                    near = np.flatnonzero(score >= score.max() - SCORE_SPAN) if len(score) else np.zeros(0, np.int64)
                    classes.append(near.astype(np.int32))
                    scores.append(score[near])
                    likely = max([float(even[buckets].mean()), *mean[near]]) if len(buckets) else None
                    excess.append(None if likely is None else likely + chance)
            offsets = pa.array(np.cumsum([0, *map(len, classes)]).astype(np.int32))
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (classes, scores)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)),
                 pa.ListArray.from_arrays(offsets, pa.array(flat[0].astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(flat[1])), pa.array(excess, pa.float64())],
                ["doc_id", "text_key", "declared", "host", "suffix", "classes", "scores", "excess"],
            )

    schema = (
        "doc_id long, text_key long, declared string, host string, suffix string, "
        "classes array<int>, scores array<double>, excess double"
    )
    return rows.select("doc_id", "text_key", "declared", "host", "suffix", "text").mapInArrow(run, schema)


def _tallied(guessed: DataFrame, keys: list[str], name: str) -> DataFrame:
    """How often rows of a group are guessed as what: ``name`` is an array of (guess, n)."""
    return guessed.where(F.col(keys[0]).isNotNull()).groupBy(*keys, "guess").agg(
        F.count(F.lit(1)).cast("double").alias("n")
    ).groupBy(*keys).agg(F.collect_list(F.struct("guess", "n")).alias(name))


def _fused(rows: DataFrame, overall: np.ndarray, languages: list[str]) -> DataFrame:
    """doc_id, text_key, declared, excess, language, confidence, host_names of rows with their tallies."""
    share = (overall + 1.0) / (overall.sum() + len(overall))
    codes = len(languages) + 1

    def smoothed(tally, classes, parent, strength):
        """Prior of a group from its counts and the parent's prior."""
        if not tally:
            return parent
        held = {x["guess"]: x["n"] for x in tally}
        own = np.array([held.get(c, 0.0) for c in classes.tolist()])
        return (own + strength * parent) / (sum(held.values()) + strength)

    def run(batches):
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("classes", "scores", "suffixes", "hosts", "declarations")}
            language, confidence, named = [], [], []
            for classes, scores, suffixes, hosts, declarations in zip(*columns.values(), strict=True):
                size = sum(x["n"] for x in hosts) if hosts else 0.0
                named.append(bool(hosts) and max(x["n"] for x in hosts) >= HOST_NAMES * (size + HOST_STRENGTH))
                if not classes:
                    language.append(None)
                    confidence.append(None)
                    continue
                classes = np.array(classes)
                prior = smoothed(suffixes, classes, share[classes], SUFFIX_STRENGTH)
                prior = smoothed(hosts, classes, prior, HOST_STRENGTH)
                logs = np.array(scores) + np.log(prior)
                if declarations:
                    # How often texts of each language declare this: counts and an even guess over the codes in use.
                    held = {x["guess"]: x["n"] for x in declarations}
                    own = np.array([held.get(c, 0.0) for c in classes.tolist()])
                    logs += np.log((own + DECLARED_STRENGTH) / (overall[classes] + DECLARED_STRENGTH * codes))
                best = int(logs.argmax())
                language.append(languages[classes[best]])
                confidence.append(1.0 / float(np.exp(logs - logs[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("doc_id", "text_key", "declared", "excess")),
                 pa.array(language, pa.string()), pa.array(confidence, pa.float64()), pa.array(named, pa.bool_())],
                ["doc_id", "text_key", "declared", "excess", "language", "confidence", "host_names"],
            )

    return rows.mapInArrow(
        run, "doc_id long, text_key long, declared string, excess double, language string, confidence double, "
        "host_names boolean"
    )


def identify(evidence: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """doc_id, text_key, declared, language, confidence, kept of every row of ``evidence``.

    ``evidence`` has doc_id, text, declared, host, suffix; all but doc_id may be null, which is no
    evidence. Every declared language is a class, however few rows declare it. Its trigram counts
    come from all rows that declare it and are smoothed towards the background, the counts of all
    rows. With the text's best language as a first guess, grouped counts give how often each
    language is declared as what, and each host's prior, smoothed towards its suffix's, that towards
    the global one. The posterior is their product with the tempered text likelihood; equal
    posteriors fall to the language that sorts first.

    A row with a trigram is kept if it declares a language, if its host names one (HOST_NAMES), or if
    its text is more likely by the background or a language than by chance and the posterior of its
    language reaches ``min_confidence``. Where no row declares a language, the language is null and
    the text alone decides.

    The driver and each task hold the languages' non-zero counts, at most BUCKETS a language, and one
    part of LANGUAGES_AT_ONCE as a matrix; hosts stay in a join.

    Null, empty and two-byte texts are rejected. Repeated rows count as often as they occur; no rows
    give no rows.
    """
    rows = evidence.select(
        "doc_id", text_key().alias("text_key"), declared_code(F.col("declared")).alias("declared"), "host", "suffix",
        whole_text().alias("text"),
    )
    languages = sorted(r["declared"] for r in rows.where("declared is not null").select("declared").distinct().collect())
    background, parts = _model(written(_trained(rows), "language-counts"), languages)
    scored = written(_likelihoods(rows, background, parts), "language-scores")

    guess = F.get("classes", F.array_position("scores", F.array_max("scores")).cast("int") - 1)
    guessed = scored.where("excess > 0 and size(classes) > 0").withColumn("guess", guess)
    overall = np.zeros(len(languages))
    for r in guessed.groupBy("guess").count().collect():
        overall[r["guess"]] = r["count"]
    suffixes = _tallied(guessed, ["suffix"], "suffixes")
    hosts = _tallied(guessed, ["host", "suffix"], "hosts").withColumnsRenamed({"host": "_host", "suffix": "_suffix"})
    declared = _tallied(guessed, ["declared"], "declarations")
    joined = (
        scored.join(suffixes, "suffix", "left").join(declared, "declared", "left")
        .join(hosts, (scored["host"] == hosts["_host"]) & scored["suffix"].eqNullSafe(hosts["_suffix"]), "left")
        .select("doc_id", "text_key", "declared", "excess", "classes", "scores", "suffixes", "hosts", "declarations")
    )
    likely = F.col("excess") > 0
    if languages:
        likely = likely & (F.col("confidence") >= min_confidence)
    kept = F.col("excess").isNotNull() & (F.col("declared").isNotNull() | F.col("host_names") | likely)
    return _fused(joined, overall, languages).select(
        "doc_id", "text_key", "declared", "language", "confidence", F.coalesce(kept, F.lit(False)).alias("kept"),
    )


def keep_identified(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The rows of ``docs`` whose language is identified, with that language as their ``lang``.

    A ``lang`` that already says it (en-GB says en), or that none better than ``min_confidence`` takes the
    place of, stays as it is, and so do all other columns. Rows of one doc_id, text and declaration get one
    language: where their sources name several, the first by name.
    """
    better = (F.col("confidence") >= min_confidence) & ~F.col("language").eqNullSafe(F.col("declared"))
    verdicts = written(
        identify(document_evidence(docs), min_confidence).withColumn("better", F.coalesce(better, F.lit(False)))
        .where("not kept or better"), "language-verdicts",
    )
    gone = verdicts.where("not kept").select("doc_id", "text_key").distinct()
    named = verdicts.where("kept and better").groupBy(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("declared").alias("_declared")
    ).agg(F.min("language").alias("_language"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key"))
        & declared_code(F.col("lang")).eqNullSafe(F.col("_declared"))
    )
    left = without_rows(docs, written(gone, "language-gone"))
    return left.join(small_or_shuffled(written(named, "language-named")), same, "left").select(
        *(F.coalesce("_language", "lang").alias("lang") if c == "lang" else F.col(c) for c in docs.columns)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(document_evidence(table(spark, sf_dir, "documents"))).drop("text_key")


def page_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(page_evidence(table(spark, sf_dir, "pages"))).drop("text_key").withColumnRenamed("doc_id", "page_id")


register("op6_language_evidence", query)
register("op6_page_language", page_query)
