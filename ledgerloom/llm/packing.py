"""Packing token windows by minimum bin slack, planned on the histogram of remaining lengths."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import Memory, ranked, table, whole_text
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

WINDOW = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker remembers; it forgets all of them when it has that many.
MEMORY_WORDS = 800_000
# Code points with the Unicode property White_Space.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: the pattern by which the tokenizer splits lower-cased text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class WordTokenizer:
    """Ids of a text, word by word: the tokenizer drops white space and never joins across it.

    New words go through the whole tokenizer, but for those of plain Latin letters, digits and signs:
    these need no normalising beyond lower case, so they are split by the tokenizer's own pattern and
    only pieces not met before are merged by its model. Both memories are of bounded size.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._word = re.compile(f"[^{WHITE}]+").findall
        self._plain = re.compile("[!-~\u00c0-\u012f\u0131-\u024f]+").fullmatch
        self._split = regex.compile(SPLIT).findall
        # Byte-level models write bytes without a visible Latin-1 character as those from U+0100 on.
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in visible]
        self._letters = {b: b for b in visible} | {b: 0x100 + i for i, b in enumerate(hidden)}
        size = self._tokenizer.get_vocab_size()
        self._bytes = [i.to_bytes(4, "little") for i in range(size)]
        self._pieces = Memory(self._of_piece, MEMORY_WORDS // 2)
        self._words = Memory(self._of_word, MEMORY_WORDS)

    def _of_piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._letters)
        ids = self._bytes
        return b"".join([ids[t.id] for t in self._tokenizer.model.tokenize(letters)])

    def _of_word(self, word: str) -> bytes:
        if self._plain(word) and "<|" not in word:
            low, pieces = word.lower(), self._pieces
            if low.isalpha():
                return pieces[low]
            if low[:-1].isalpha() and low[-1] in ".,;:!?":
                return pieces[low[:-1]] + pieces[low[-1]]
            return b"".join([pieces[p] for p in self._split(low)])
        ids = self._tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, np.uint32).tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        self._words.shrink()
        self._pieces.shrink()
        return b"".join(map(self._words.__getitem__, self._word(text)))


def cut(
    docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = END_ID, by: Column | None = None
) -> DataFrame:
    """Each text's ids and ``end_id``, cut into windows and a rest: PIECES, without the ids.

    With ``by``, a string, its value follows as ``part``: empty where it is null.
    """
    part = [] if by is None else [F.coalesce(by, F.lit("")).alias("part")]
    path, end = tokenizer or default_tokenizer(), end_id.to_bytes(4, "little")

    def pieces(batches):
        encode = WordTokenizer(path)
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            owners: list[int] = []
            for i, (doc_id, text) in enumerate(zip(ids_of, texts, strict=True)):
                ids = encode(text) + end
                total = len(ids) // 4
                for s in range(0, total, window):
                    piece = ids[4 * s : 4 * (s + window)]
                    rows.append((doc_id, s, len(piece) // 4, zlib.crc32(piece), total))
                    owners.append(i)
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part"]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            if batch.num_columns > 2:
                arrays.append(batch.column(2).take(pa.array(owners, pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return docs.select("doc_id", whole_text(), *part).mapInArrow(pieces, f"{PIECES}, part string" if part else PIECES)


def _closest(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The multiset of available lengths with the largest sum up to ``room``: [(length, times)].

    Bit s of a row is set if s is a sum of the lengths so far; counts are bounded by splitting them
    into powers of two. Going back through the rows gives how often each length is used.
    """
    reach, mask, rows = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        if length > room:
            continue
        rows.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:
            step = min(step, left)
            reach |= (reach << (length * step)) & mask
            left -= step
            step *= 2
        if reach >> room & 1:
            rows_sum = room
            break
    else:
        rows_sum = reach.bit_length() - 1
    used = []
    for length, before in reversed(rows):
        times = 0
        while not before >> (rows_sum - times * length) & 1:
            times += 1
        if times:
            used.append((length, times))
            rows_sum -= times * length
    return used


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """[(number of sequences, {length: pieces of it in each})], covering the histogram.

    Minimum bin slack: the largest length left opens a window, the subset of the rest that leaves
    the least slack fills it, and the pattern repeats as long as its pieces last. The plan's size
    depends on the window alone (each pattern leaves fewer than one use of some length), not on
    the number of pieces.
    """
    counts = {k: n for k, n in histogram.items() if n}
    out = []
    while counts:
        lengths = sorted(counts, reverse=True)
        seed = lengths[0]
        rest = counts | {seed: counts[seed] - 1}
        pattern = {seed: 1}
        for length, times in _closest([k for k in lengths if rest[k]], rest, window - seed):
            pattern[length] = pattern.get(length, 0) + times
        repeat = min(counts[k] // n for k, n in pattern.items())
        out.append((repeat, pattern))
        for k, n in pattern.items():
            counts[k] -= repeat * n
            if not counts[k]:
                del counts[k]
    return out


def _places(planned: list[tuple[int, dict[int, int]]], sequence: int = 0) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence, pieces in a sequence and offset, by pattern.

    ``sequence`` is the plan's first.
    """
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    for repeat, pattern in planned:
        offset = 0
        for length, times in sorted(pattern.items(), reverse=True):
            rows.setdefault(length, []).append((taken.get(length, 0), sequence, times, offset))
            taken[length] = taken.get(length, 0) + repeat * times
            offset += length * times
        sequence += repeat
    return {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in rows.items()}


def pack(
    docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = END_ID, by: Column | None = None
) -> DataFrame:
    """Pack all texts into sequences of at most ``window`` tokens: one row per piece.

    PIECES, then sequence_id (from 0, gapless) and offset (gapless from 0 in each sequence). A text
    longer than the window is cut into whole windows and a rest; the rests are packed by plan().
    Only the histogram of piece lengths (at most ``window`` rows) reaches the driver; a piece's
    place follows from its rank among those of its length, which is worked out in buckets.

    With ``by``, a string column of ``docs`` with few values, a sequence holds pieces of one value only, there is
    a histogram a value, and the value follows as ``part`` (empty where it is null).

    A null or empty text is the end id alone. A repeated row is packed as often as it occurs, a null
    doc_id stays null; other columns are ignored. No rows give no rows.
    """
    parts = [] if by is None else ["part"]
    pieces = written(cut(docs, window, tokenizer, end_id, by), "packing-pieces")
    histograms: dict[str, dict[int, int]] = {}
    for r in pieces.groupBy(*parts, "length").agg(F.count(F.lit(1)).alias("n")).collect():
        histograms.setdefault(r["part"] if parts else "", {})[r["length"]] = r["n"]
    places, sequences = {}, 0
    for name in sorted(histograms):
        planned = plan(histograms[name], window)
        places |= {(name, k): place for k, place in _places(planned, sequences).items()}
        sequences += sum(repeat for repeat, _ in planned)

    @F.pandas_udf("sequence_id long, offset long")
    def place(*columns: pd.Series) -> pd.DataFrame:
        lengths, ranks = columns[0].to_numpy(), columns[1].to_numpy()
        codes, found = pd.factorize(columns[2]) if parts else (np.zeros(len(lengths), np.int64), [""])
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        kinds = codes * (window + 1) + lengths
        for kind in np.unique(kinds):
            rows = np.flatnonzero(kinds == kind)
            code, k = divmod(int(kind), window + 1)
            first, sequences, times, offsets = places[found[code], k]
            at = np.searchsorted(first, ranks[rows], "right") - 1
            inside = ranks[rows] - first[at]
            sequence[rows] = sequences[at] + inside // times[at]
            offset[rows] = offsets[at] + inside % times[at] * k
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    order = [F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return (
        ranked(pieces, [*parts, "length"], order, "_rank")
        .withColumn("_place", place("length", "_rank", *parts))
        .select(*names, "_place.sequence_id", "_place.offset", *parts)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


register("op1_minimum_bin_slack", query)
