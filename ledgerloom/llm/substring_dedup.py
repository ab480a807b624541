"""Repeated passages: suffix automata of reference shards, matching statistics, maximal spans removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    SPACE_CLASS, _powers_for, chunks, encoded, gram_hashes, mixed, small_or_shuffled, table, text_key, whole_text,
    word_hashes,
)
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

#: Words in a window; words in the grams of which a window's least hash names its shard.
WINDOW = 50
GRAM = 16
#: Distinct stretches up to which a shard has an automaton; larger ones count their windows in a shuffle.
MOST_STRETCHES = 500
_AT_BITS = np.uint64((1 << 28) - 1)
#: Bits of a packed span that say which of its (at most WINDOW - GRAM + 1) windows are meant.
_MASK_BITS = WINDOW - GRAM + 1


def stretches(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(shard, name, lead, windows, start) of each run of windows with their least gram in common.

    ``words`` are the hashes of several texts, ``first`` where each begins. The least gram and so
    the shard follow from a window's words alone: equal windows of any texts meet in one shard, with
    the gram at the same place. ``lead`` is the number of words before the gram.
    """
    none = np.zeros(0, np.uint64)
    runs = [np.arange(a, b - WINDOW + 1) for a, b in zip(first[:-1], first[1:], strict=True) if b - a >= WINDOW]
    if not runs:
        return none, none, *(np.zeros(0, np.int64),) * 3
    starts = np.concatenate(runs)
    grams = gram_hashes(words, GRAM)
    least = (grams & ~_AT_BITS) | np.arange(len(grams), dtype=np.uint64)
    span, needed = 1, WINDOW - GRAM + 1
    while 2 * span <= needed:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(least) - (needed - span)], least[needed - span :])
    at = (least[starts] & _AT_BITS).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))))
    begin = starts[new]
    count = np.concatenate((starts[new[1:] - 1], starts[-1:])) - begin + 1
    up, down = _powers_for(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    lead = at[new] - begin
    name = mixed((sums[begin + count + WINDOW - 1] - sums[begin]) * down[begin] + mixed((lead * 64 + count).astype(np.uint64)))
    return grams[at[new]], name, lead, count, begin


def _occurrences(docs: DataFrame) -> DataFrame:
    """One row per stretch of every row: doc_id (largest long if null), text_key, shard, name, windows, start."""
    def run(batches):
        for batch in batches:
            texts = encoded(batch.column(2))
            for a, b in chunks(texts):
                words, first = word_hashes(texts[a:b], lower=False)
                shard, name, _, count, begin = stretches(words, first)
                text = np.searchsorted(first, begin, "right") - 1
                # Texts without words begin where the next one does.
                rows = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(shard.view(np.int64)),
                     pa.array(name.view(np.int64)), pa.array(count.astype(np.int32)),
                     pa.array((begin - first[text]).astype(np.int32))],
                    ["doc_id", "text_key", "shard", "name", "windows", "start"],
                )

    schema = "doc_id long, text_key long, shard long, name long, windows int, start int"
    return docs.select(_known_id(), text_key().alias("text_key"), whole_text()).mapInArrow(run, schema)


def _known_id() -> Column:
    return F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id")


class SuffixAutomaton:
    """Of several word sequences, given in the order of their documents.

    Each state knows the least document that its strings occur in: the one that made it, since
    later sequences have later documents, or for a clone the one of the state it was split from.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.low = [-1], [0], [0]

    def _state(self, length: int, link: int, low: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.low.append(low)
        return len(self.next) - 1

    def _split(self, p: int, q: int, symbol: int) -> int:
        """The state for the strings of q up to one longer than p's; p's arcs to q go to it."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], self.low[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, symbols: list[int], document: int) -> None:
        last = 0
        for symbol in symbols:
            if symbol in self.next[last]:
                last = self._split(last, self.next[last][symbol], symbol)
                continue
            new = self._state(self.length[last] + 1, 0, document, {})
            p = last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, self.next[p][symbol], symbol)
            last = new

    def earlier(self, symbols: list[int], document: int, window: int) -> int:
        """Bit i is set if the window from symbol i on occurs in a document before ``document``."""
        state = matched = found = 0
        for end, symbol in enumerate(symbols, 1):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            while self.length[self.link[state]] >= window if state else False:
                state = self.link[state]
                matched = self.length[state]
            if matched >= window and self.low[state] < document:
                found |= 1 << (end - window)
        return found


def _contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (shard, name, first, place) with the words of each stretch, as hashes."""
    listed = wanted.groupBy("place.doc_id", "place.text_key").agg(
        F.collect_list(F.struct("shard", "name", "first", "place.start", "place.windows")).alias("stretches")
    )
    listed = written(listed, "substring-wanted").withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key")
    rows = docs.select(_known_id(), text_key().alias("text_key"), whole_text().alias("text"))
    mine = (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key"))
    rows = rows.join(small_or_shuffled(listed.select("_id", "_key")), mine, "left_semi")
    # Repeated rows have the same stretches; they would be listed twice and change nothing.
    joined = rows.join(listed, mine).select("text", "stretches")

    def run(batches):
        for batch in batches:
            texts = encoded(batch.column(0))
            for i, text in enumerate(texts):
                words, _ = word_hashes([text], lower=False)
                entries = batch.column(1)[i].as_py()
                if not entries:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e[k] for e in entries], pa.int64()) for k in ("shard", "name", "first")]
                    + [pa.array(
                        [words[e["start"] : e["start"] + e["windows"] + WINDOW - 1].view(np.int64) for e in entries],
                        pa.list_(pa.int64()),
                    )],
                    ["shard", "name", "first", "words"],
                )

    return joined.mapInArrow(run, "shard long, name long, first long, words array<long>")


def _by_automaton(contents: DataFrame) -> DataFrame:
    """(name, shard, earlier): an automaton for each shard, its stretches streamed in document order."""
    def run(batches: Iterator[pa.RecordBatch]):
        current, automaton = None, SuffixAutomaton()
        for batch in batches:
            shards, firsts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            masks = []
            for i, (shard, first) in enumerate(zip(shards, firsts, strict=True)):
                if shard != current:
                    current, automaton = shard, SuffixAutomaton()
                words = batch.column(3)[i].as_py()
                masks.append(automaton.earlier(words, first, WINDOW))
                automaton.add(words, first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(masks, pa.int64())], ["shard", "name", "earlier"]
            )

    ordered = contents.repartition("shard").sortWithinPartitions("shard", "first", "name")
    return ordered.mapInArrow(run, "shard long, name long, earlier long")


def _by_windows(contents: DataFrame) -> DataFrame:
    """The same for shards with very many stretches: each window's least document from a grouped minimum."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = np.array(batch.column(3)[i].as_py(), np.int64).view(np.uint64)
                hashes = gram_hashes(words, WINDOW).view(np.int64)
                n = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).take(pa.array(np.full(n, i))) for k in range(3)]
                    + [pa.array(np.arange(n, dtype=np.int32)), pa.array(hashes)],
                    ["shard", "name", "first", "bit", "window"],
                )

    windows = written(
        contents.mapInArrow(run, "shard long, name long, first long, bit int, window long"), "substring-windows"
    )
    low = windows.groupBy("shard", "window").agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low < high")
    return windows.join(low.drop("high"), ["shard", "window"]).where("low < first").groupBy("shard", "name").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("earlier")
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans) of the rows with windows that start in an earlier document too.

    A span packs a start (in words) and the bits of the windows from there on. A row without doc_id
    counts as later than all others.

    Broadcasting automata of all texts would send every text everywhere. Instead windows are dealt to
    shards by the least hash among their grams, as stretches of windows that share it; equal
    stretches are one row after a grouped minimum. Only shards with stretches of several documents
    live on, and only those with different stretches need an automaton: built from the stretches in
    document order, each streamed through what is there before it is added. A shard with more than
    MOST_STRETCHES of them is not gathered; its windows are counted in a shuffle.
    """
    met = written(_occurrences(docs), "substring-stretches")
    names = written(
        met.groupBy("shard", "name").agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
            F.min(F.struct("doc_id", "text_key", "start", "windows")).alias("place"),
        ), "substring-names",
    )
    shards = names.groupBy("shard").agg(
        F.min("first").alias("low"), F.max("last").alias("high"), F.count(F.lit(1)).alias("n")
    ).where("low < high").select("shard", "n")
    live = written(names.join(shards, "shard"), "substring-live")
    contents = written(
        _contents(docs, live.where("n > 1")).join(shards, "shard"), "substring-contents"
    )
    columns = ["shard", "name", "first", "words"]
    masks = _by_automaton(contents.where(F.col("n") <= MOST_STRETCHES).select(*columns)).unionByName(
        _by_windows(contents.where(F.col("n") > MOST_STRETCHES).select(*columns))
    )
    masks = written(masks.where("earlier <> 0").distinct(), "substring-masks")
    known = live.join(masks, ["shard", "name"], "left").select(
        "shard", "name", "first", F.coalesce("earlier", F.lit(0)).alias("earlier"), "last"
    ).where("earlier <> 0 or first < last").drop("last")
    cover = F.when(
        F.col("doc_id") > F.col("first"), F.expr("shiftleft(1L, windows) - 1")
    ).otherwise(F.col("earlier"))
    packed = F.shiftleft(F.col("start").cast("long"), _MASK_BITS).bitwiseOR(F.col("cover"))
    return met.join(known, ["shard", "name"]).withColumn("cover", cover).where("cover <> 0").groupBy(
        "doc_id", "text_key"
    ).agg(F.collect_list(packed).alias("spans"))


def _covered(n_words: int, spans: np.ndarray) -> np.ndarray:
    """Which words the packed spans cover."""
    change = np.zeros(n_words + 1, np.int32)
    starts = spans >> _MASK_BITS
    for bit in range(_MASK_BITS):
        at = starts[(spans >> bit & 1) > 0] + bit
        np.add.at(change, at, 1)
        np.add.at(change, at + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def _kept_words(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for t, s in zip(text, spans, strict=True):
        words = t.encode().split()
        gone = _covered(len(words), np.asarray(s, np.int64))
        kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
        out.append((kept.decode(), len(words), int(gone.sum())))
    return pd.DataFrame(out, columns=["text", "n_words", "n_removed"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with columns kept_text, n_words and n_removed added.

    Each word in a window of WINDOW words that also starts in a document with a smaller doc_id is
    removed; windows are judged on the input. kept_text is the words that stay, joined by a space.

    Texts below WINDOW words lose nothing; null texts are empty. Rows without doc_id lose what
    occurs in any row with one, and take nothing from others. Windows that repeat in one document,
    or in rows with one doc_id, stay. No rows give no rows.
    """
    spans = written(repeated_spans(docs), "substring-spans")
    keys = spans.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    named = docs.withColumns({"_known": _known_id(), "_text_key": text_key()})
    mine = (F.col("_known") == F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    words = F.array_remove(F.split(whole_text(), SPACE_CLASS, -1), "")
    added = {"kept_text": F.array_join("_words", " "), "n_words": F.size("_words").cast("long"), "n_removed": F.lit(0).cast("long")}
    few = small_or_shuffled(keys)
    plain = named.join(few, mine, "left_anti").withColumn("_words", words).withColumns(added)
    held = spans.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("spans").alias("_spans"))
    changed = named.join(few, mine, "left_semi").join(held, mine).withColumn(
        "_cut", F.pandas_udf(_kept_words, "text string, n_words long, n_removed long")(whole_text(), "_spans")
    ).withColumns({"kept_text": F.col("_cut.text"), "n_words": F.col("_cut.n_words"), "n_removed": F.col("_cut.n_removed")})
    names = [*docs.columns, *added]
    return plain.select(*names).unionByName(changed.select(*names))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut out of their text.

    Texts that lose nothing stay as they are; rows that lose all their words go; n_chars, if there,
    follows the text.
    """
    out = without_repeats(docs).where("n_removed < n_words or n_words = 0")
    out = out.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, chars).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


register("op5_suffix_automata", query)
