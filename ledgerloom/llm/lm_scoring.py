"""Language-model scores by a weighted backoff automaton over words, learned from the corpus."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks, encoded, mixed, table, whole_text, word_hashes
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written

#: Words of the longest n-gram; a state is a context of at most one word fewer.
ORDER = 2
#: Bytes of text that one task counts or scores together.
BLOCK_BYTES = 8 << 20
#: The symbol that ends a text and, as a context, starts one; no word hashes like it but by chance.
END_HASH = np.uint64(0x5851F42D4C957F2D)
#: Classes of contexts by the bit length of their count.
CLASSES = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Level:
    """The distinct n-grams of one length in a block, and which of them ends at each token."""

    keys: np.ndarray  # hashes, ascending
    ids: np.ndarray  # by token, the number of its n-gram; -1 where the text's start is nearer
    first: np.ndarray  # by n-gram, the token where it occurs first


class Block:
    """The tokens of some texts: each text is the start, its words and the end."""

    def __init__(self, texts: list[bytes], order: int):
        parts, sizes = [], []
        for a, b in chunks(texts):
            words, first = word_hashes(texts[a:b], lower=True)
            sizes.append(np.diff(first) + 2)
            parts.append(np.insert(words, np.stack([first[:-1], first[1:]], 1).ravel(), END_HASH))
        tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.sizes)))
        inside = np.arange(len(tokens)) - np.repeat(self.start[:-1], self.sizes)
        #: The start is a context only: nothing counts or scores it.
        self.scored = inside > 0
        self.levels: list[Level] = []
        key = tokens
        for n in range(1, order + 1):
            if n > 1:  # The n - 1 tokens that end one before, and this one.
                key = np.concatenate((key[:1], mixed(key[:-1] * _STEP + tokens[1:] + np.uint64(n))))
            usable = np.flatnonzero(inside >= n - 1)
            keys, first, ids = np.unique(key[usable], return_index=True, return_inverse=True)
            by_token = np.full(len(tokens), -1)
            by_token[usable] = ids
            self.levels.append(Level(keys, by_token, usable[first]))

    def trained(self, held_out: np.ndarray) -> np.ndarray:
        return self.scored & ~np.repeat(held_out, self.sizes)


def _cells(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the keys by bucket, the buckets met, where each begins, and the end)."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    met, at = np.unique(bucket[order], return_index=True)
    return order, met, np.append(at, len(keys))


def _packed(counts: np.ndarray) -> bytes:
    """A byte a count; counts from 255 on follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _unpacked(data: bytes, size: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, size).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", offset=size)
    return counts


def _tallied(order: int, buckets: int):
    """Function of a block's rows: its n-grams' keys and counts in training, a row for each bucket."""
    def run(rows: pa.Table) -> pa.Table:
        block = Block(encoded(rows.column("text")), order)
        trained = block.trained(rows.column("held_out").to_numpy())
        out = []
        for n, level in enumerate(block.levels, 1):
            counts = np.bincount(level.ids[trained & (level.ids >= 0)], minlength=len(level.keys))
            by_bucket, met, at = _cells(level.keys, buckets)
            for i, b in enumerate(met):
                some = by_bucket[at[i] : at[i + 1]]
                out.append((n, int(b), level.keys[some].tobytes(), _packed(counts[some])))
        number = rows.column("block")[0].as_py()
        n, b, keys, counts = zip(*out, strict=True)
        return pa.table({
            "block": pa.array([number] * len(out), pa.int32()), "n": pa.array(n, pa.int32()),
            "bucket": pa.array(b, pa.int32()), "keys": pa.array(keys, pa.binary()),
            "counts": pa.array(counts, pa.binary()),
        })
    return run


def _summed(rows: pa.Table) -> pa.Table:
    """The corpus's counts of a bucket's n-grams, for each block in the order in which it sent them.

    The row without a block says how many n-grams occur in training, how often, and how many once.
    """
    keys = [np.frombuffer(k, np.uint64) for k in rows.column("keys").to_pylist()]
    sizes = [len(k) for k in keys]
    counts = np.concatenate([_unpacked(*c) for c in zip(rows.column("counts").to_pylist(), sizes, strict=True)])
    distinct, ids = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(ids, weights=counts, minlength=len(distinct)).astype(np.int64)
    sent = np.split(total[ids], np.cumsum(sizes)[:-1])
    size = len(keys) + 1
    zeros = [0] * len(keys)
    return pa.table({
        "block": pa.array([*rows.column("block").to_pylist(), None], pa.int32()),
        "n": pa.array([rows.column("n")[0].as_py()] * size, pa.int32()),
        "bucket": pa.array([rows.column("bucket")[0].as_py()] * size, pa.int32()),
        "counts": pa.array([*map(_packed, sent), b""], pa.binary()),
        "distinct": pa.array([*zeros, int((total > 0).sum())], pa.int64()),
        "total": pa.array([*zeros, int(total.sum())], pa.int64()),
        "once": pa.array([*zeros, int((total == 1).sum())], pa.int64()),
    })


def _corpus_counts(block: Block, sums: pa.Table, buckets: int) -> list[np.ndarray]:
    """For each length, the corpus's count of every n-gram of the block."""
    found = [np.zeros(len(level.keys), np.int64) for level in block.levels]
    cells = [_cells(level.keys, buckets) for level in block.levels]
    for n, b, counts in zip(*(sums.column(c).to_pylist() for c in ("n", "bucket", "counts")), strict=True):
        by_bucket, met, at = cells[n - 1]
        i = np.searchsorted(met, b)
        found[n - 1][by_bucket[at[i] : at[i + 1]]] = _unpacked(counts, at[i + 1] - at[i])
    return found


def _class(counts: np.ndarray) -> np.ndarray:
    """Bit length of counts."""
    return np.frexp(counts.astype(np.float64))[1]


class Automaton:
    """States are the contexts met in a block, arcs the n-grams that go on from them.

    An arc's weight is log10 of the smoothed probability of its last token; a state without an arc
    for a token has a failure arc to the context without its first word, whose weight is log10 of
    what the state leaves to the shorter one. The empty context has an arc for every known token
    and one for all unknown ones. An arc leads to the context of its last words; an unknown token
    to the empty one. States and arcs carry their n-gram's number in the block.
    """

    def __init__(self, block: Block, counts: list[np.ndarray], total: int, left: np.ndarray):
        self.depth = len(counts) - 1
        known = counts[0] > 0
        below = np.where(known, (1 - left[0, 0]) * counts[0] / max(total, 1), left[0, 0])
        self.known = known.tolist()
        self.arcs, self.failures = [np.log10(below).tolist()], []
        for n in range(1, len(counts)):
            level, shorter = block.levels[n], block.levels[n - 1]
            context = counts[n - 1][shorter.ids[level.first - 1]]
            back = left[n, _class(context)]
            share = counts[n] / np.maximum(context, 1)
            below = np.where(
                counts[n] > 0, (1 - back) * share + back * below[shorter.ids[level.first]], np.nan
            )
            self.arcs.append(np.log10(below).tolist())
            self.failures.append(np.log10(left[n, _class(counts[n - 1])]).tolist())

    def read(self, path: list[list[int]]) -> float:
        """log10 of a text's probability; path[d][i] is the number of the d + 1 tokens that end at i."""
        score = 0.0
        depth = min(self.depth, 1) if self.known[path[0][0]] else 0
        for i in range(1, len(path[0])):
            while (weight := self.arcs[depth][path[depth][i]]) != weight:  # No such arc.
                depth -= 1
                score += self.failures[depth][path[depth][i - 1]]
            score += weight
            depth = min(depth + 1, self.depth) if self.known[path[0][i]] else 0
        return score


def _blocks(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Rows dealt by a hash into blocks of about ``block_bytes`` of text, and the number of blocks."""
    size = docs.agg(F.sum(F.octet_length(whole_text()))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    return docs.select(
        F.pmod(F.xxhash64("doc_id", whole_text()), F.lit(n)).cast("int").alias("block"),
        "doc_id", held.alias("held_out"), whole_text().alias("text"),
    ), n


def scores(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    The model is an n-gram model over words, learned from the rows that are not held out. Its
    symbols are those of the base score: every training token and one for all unknown ones. A
    context leaves to the shorter one the share of tokens that, after contexts counted about as
    often (same bit length), form an n-gram seen once; the empty context leaves its share to the
    unknown symbol. Probabilities after each context so add up to 1.

    Rows are dealt into blocks. A block sends the keys of its n-grams, by hash, to buckets that
    grow in number with the blocks; a bucket returns the corpus's counts in the same order. So
    every block has the whole model's counts of what occurs in it, of the model nothing is
    broadcast, and an n-gram costs a bucket one entry a block however frequent it is. The driver
    gets totals and ``order`` x 64 shares.

    Null and empty texts are the end alone; a null doc_id is not held out. Repeated rows count as
    often as they occur; other columns are ignored; no rows give no rows. Where every row is held
    out, every token is unknown and has probability 1.
    """
    assert order >= 1
    dealt, buckets = _blocks(docs, block_bytes)
    sums = written(
        dealt.groupBy("block")
        .applyInArrow(_tallied(order, buckets), "block int, n int, bucket int, keys binary, counts binary")
        .groupBy("n", "bucket")
        .applyInArrow(
            _summed, "block int, n int, bucket int, counts binary, distinct long, total long, once long"
        ),
        "lm-counts",
    )
    totals = sums.where("n = 1 and block is null").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("distinct", "total", "once"))
    ).first()
    n, v = int(totals["total"]), int(totals["distinct"])
    by_block = sums.where("block is not null").select("block", "n", "bucket", "counts").groupBy("block")

    def classes(rows: pa.Table, slice_: pa.Table) -> pa.Table:
        block = Block(encoded(rows.column("text")), order)
        counts = _corpus_counts(block, slice_, buckets)
        trained = block.trained(rows.column("held_out").to_numpy())
        out = []
        for k in range(1, order):
            at = np.flatnonzero(trained & (block.levels[k].ids >= 0))
            kind = _class(counts[k - 1][block.levels[k - 1].ids[at - 1]])
            once = counts[k][block.levels[k].ids[at]] == 1
            tokens = np.bincount(kind, minlength=CLASSES)
            single = np.bincount(kind[once], minlength=CLASSES)
            out += [(k, int(c), int(tokens[c]), int(single[c])) for c in np.flatnonzero(tokens)]
        names = ("n", "class", "tokens", "once")
        return pa.table({name: pa.array([r[i] for r in out], pa.int64()) for i, name in enumerate(names)})

    # What a context leaves to the shorter one, by its length and class.
    left = np.full((order, CLASSES), 0.5)
    left[0, 0] = (totals["once"] + 1) / (n + 2) if n else 1.0
    if order > 1:
        shares = dealt.groupBy("block").cogroup(by_block).applyInArrow(
            classes, "n long, class long, tokens long, once long"
        )
        for r in shares.groupBy("n", "class").agg(F.sum("tokens").alias("tokens"), F.sum("once").alias("once")).collect():
            left[r["n"], r["class"]] = (r["once"] + 1) / (r["tokens"] + 2)

    def score_block(rows: pa.Table, slice_: pa.Table) -> pa.Table:
        block = Block(encoded(rows.column("text")), order)
        counts = _corpus_counts(block, slice_, buckets)
        automaton = Automaton(block, counts, n, left)
        c = np.where(block.scored, counts[0][block.levels[0].ids], 0)
        base = np.where(block.scored, np.log10((c + 1) / (n + v + 1)), 0.0)
        at = block.start[:-1]
        lm = [
            automaton.read([level.ids[a:b].tolist() for level in block.levels])
            for a, b in zip(block.start[:-1].tolist(), block.start[1:].tolist(), strict=True)
        ]
        return pa.table({
            "doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"),
            "n_tokens": pa.array(block.sizes - 1, pa.int64()),
            "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), at), pa.int64()),
            "train_tokens": pa.array([n] * len(at), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, at), pa.float64()),
            "score": pa.array(lm, pa.float64()),
        })

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    return dealt.groupBy("block").cogroup(by_block).applyInArrow(score_block, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


register("op7_backoff_automaton", query)
