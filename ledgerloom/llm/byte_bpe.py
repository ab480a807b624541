"""Byte-level BPE as a lazily determinised transducer, and decoding with an incremental state machine."""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.common import Memory, table, whole_text
from ledgerloom.plans.registry import register

RANKS = "byte_bpe_50k.tiktoken"
#: Determinised states, and pieces, that a worker remembers; it forgets all when it has that many.
MEMORY_STATES = 600_000
MEMORY_PIECES = 600_000


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    """Reads a piece byte by byte; emits a token as soon as no later byte can change it.

    A sequence of tokens is what the merges make of its bytes exactly if every token is what they
    make of its own bytes and every two neighbours are what they make of theirs. So for each
    prefix of a piece one last token is determined by the token before it. A token that ends later
    starts at a live boundary: the bytes from there begin some token. Going back from the live
    boundaries token by token, the ways meet; the tokens up to that boundary are settled and emitted.

    A state is what still matters of the input: the bytes since the settled boundary, the last token
    at each boundary in them, and the token before them, unless no token can start there any more.
    Pieces share states, and an arc is made when it is first met, so that a new piece is mostly a
    walk along known arcs. The lookahead is bounded by the longest token.
    """

    #: In place of the token before the undecided bytes: none (a piece begins), and any.
    NONE, ANY = -1, -2

    def __init__(self, ranks: dict[bytes, int], memory: int = MEMORY_STATES):
        self.ranks = ranks
        self.memory = memory
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.sizes = {v: len(k) for k, v in ranks.items()}
        self.begins = {k[:n] for k in ranks for n in range(1, len(k))}
        self.ends = {k[-n:] for k in ranks for n in range(1, len(k) + 1)}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self._reset()

    def _reset(self) -> None:
        # (token before, undecided bytes, last tokens) -> number, and back.
        self.numbers: dict[tuple[int, bytes, tuple[int, ...]], int] = {}
        self.states: list[tuple[int, bytes, tuple[int, ...]]] = []
        self.arcs: dict[int, tuple[tuple[int, ...], int]] = {}
        self.start = self._number(self.NONE, b"", ())

    def _number(self, before: int, rest: bytes, lasts: tuple[int, ...]) -> int:
        key = (before, rest, lasts)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
        return number

    def _merged(self, piece: bytes, parts_left: int = 1) -> list[bytes]:
        """The merges carried out in order of rank on the bytes of a token, until so many parts are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > parts_left:
            best = min(
                range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60)
            )
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _stands(self, token: int) -> bool:
        if token not in self.whole:
            self.whole[token] = len(self._merged(self.bytes_of[token])) == 1
        return self.whole[token]

    def _half(self, token: int, side: int) -> int:
        """The left (0) or right (1) part that the last merge of a standing token joined."""
        if token not in self.halves:
            left, right = self._merged(self.bytes_of[token], 2)
            self.halves[token] = self.ranks[left], self.ranks[right]
        return self.halves[token][side]

    def _apart(self, a: int, b: int) -> bool:
        """Whether the merges keep the boundary between two standing tokens.

        Undone latest first, their merges show each pair of parts that meets at the boundary. It goes
        if a pair makes a token whose merge comes before the merge undone last: one of lower rank, or
        of the same rank and further left.
        """
        names, undone = self.bytes_of, 1 << 60
        while self.ranks.get(names[a] + names[b], undone) >= undone:
            if self.sizes[a] == self.sizes[b] == 1:
                return True
            if self.sizes[b] == 1 or (a > b and self.sizes[a] > 1):
                undone, a = a, self._half(a, 1)
            else:
                undone, b = b + 1, self._half(b, 0)
        return False

    def _follows(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        key = left << 24 | right
        held = self.pairs.get(key)
        if held is None:
            if len(self.pairs) > 2 * self.memory:
                self.pairs.clear()
            held = self.pairs[key] = self._apart(left, right)
        return held

    def _last(self, before: int, rest: bytes, lasts: tuple[int, ...]) -> int:
        """Last token of the whole of ``rest``, given the last tokens of its shorter prefixes."""
        ranks, ends = self.ranks, self.ends
        found = []
        for at in range(len(rest) - 1, -1, -1):
            tail = rest[at:]
            if tail not in ends:
                break
            token = ranks.get(tail)
            if token is not None:
                found.append((at, token))
        for at, token in reversed(found):
            if self._stands(token) and self._follows(lasts[at - 1] if at else before, token):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def _tokens(self, lasts: tuple[int, ...], at: int) -> list[int]:
        """The tokens up to boundary ``at``, by going back from it."""
        out = []
        while at:
            out.append(lasts[at - 1])
            at -= self.sizes[lasts[at - 1]]
        return out[::-1]

    def _arc(self, number: int, byte: int) -> tuple[tuple[int, ...], int]:
        before, rest, lasts = self.states[number]
        rest += bytes((byte,))
        lasts += (self._last(before, rest, lasts),)
        sizes, begins = self.sizes, self.begins
        settled = len(rest)
        for live in range(len(rest)):
            if rest[live:] in begins:
                while settled != live:
                    if settled > live:
                        settled -= sizes[lasts[settled - 1]]
                    else:
                        live -= sizes[lasts[live - 1]]
                if not settled:
                    break
        emitted = self._tokens(lasts, settled)
        before = emitted[-1] if emitted else before
        rest, lasts = rest[settled:], lasts[settled:]
        if rest and rest not in begins:
            before = self.ANY
        return tuple(emitted), self._number(before, rest, lasts)

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.memory or len(self.arcs) > 4 * self.memory:
            self._reset()
        out: list[int] = []
        number, arcs = self.start, self.arcs
        for byte in piece:
            key = number << 8 | byte
            arc = arcs.get(key)
            if arc is None:
                arc = arcs[key] = self._arc(number, byte)
            if arc[0]:
                out += arc[0]
            number = arc[1]
        _, rest, lasts = self.states[number]
        return out + self._tokens(lasts, len(rest))


# Fixed value: the public pattern; and its letters, numbers and white space among the plain characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTERS, NUMBERS, WHITE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \xa0"
NOT_PLAIN = "[^\t-\r -~\xa0-\u024f]"


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of the pattern in a text.

    Texts of plain characters only (white space, ASCII and Latin letters and signs) are split by the
    public pattern written out for those, which the standard library matches three times as fast.
    """
    import regex

    general = regex.compile(pattern).findall
    if pattern != PATTERN:
        return general
    plain = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{WHITE}{LETTERS}{NUMBERS}]+"
        f"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
    ).findall
    other = re.compile(NOT_PLAIN).search
    return lambda text: general(text) if other(text) else plain(text)


class Encoder:
    """Ids of whole texts: each match of the pattern is a piece for the transducer."""

    def __init__(self, path: str, pattern: str):
        self.split = splitter(pattern)
        self.transducer = Transducer(load_ranks(path))
        self.names = [i.to_bytes(4, "little") for i in range(max(self.transducer.bytes_of) + 1)]
        self.known = Memory(self._of_piece, MEMORY_PIECES)

    def _of_piece(self, piece: str) -> bytes:
        names = self.names
        return b"".join([names[i] for i in self.transducer.encode(piece.encode("utf-8", "surrogatepass"))])

    def __call__(self, text: str) -> np.ndarray:
        self.known.shrink()
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.split(text))), np.uint32)


@lru_cache(maxsize=1)
def _encoder(path: str, changed: int, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def shared_encoder(path: str, pattern: str) -> Encoder:
    """The process's encoder: what one task's texts taught it, the worker's next tasks need not learn again.

    Another ranks file, or one that has changed, takes its place.
    """
    return _encoder(path, os.stat(path).st_mtime_ns, pattern)


class Decoder:
    """Ids to text in any slices: a state machine holds back an unfinished UTF-8 sequence.

    The state is the bytes of the sequence so far, at most three; feed() gives the text up to it. A
    byte that cannot go on is replaced, as in UTF-8 decoding with replacement.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.table[number] = token
        self.rest = b""

    def feed(self, ids, last: bool = False) -> str:
        data = self.rest + b"".join([self.table[i] for i in ids])
        keep = 0 if last else self._unfinished(data)
        self.rest = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that begin a sequence and do not complete it."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                needs = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2
                return back if needs > back else 0
            if byte < 0x80:
                return 0
        return 0


def encode_texts(
    docs: DataFrame, schema: T.StructType, make, ranks: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Run ``make(doc_id, text, ids, table of token bytes)`` -> row on every row of (doc_id, text)."""
    path, pattern = ranks or default_ranks(), pattern or default_pattern()
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path, pattern)
        names = encoder.transducer.bytes_of
        for batch in batches:
            rows = [
                make(doc_id, text, encoder(text), names)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
            )

    return docs.select("doc_id", whole_text()).mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every row's whole text, as the public encoder gives them.

    A null or empty text has no ids. Repeated rows and null doc_ids stay as they are; other columns
    are ignored; no rows give no rows. A worker holds one batch, and from task to task the vocabulary
    and two memories of bounded size; nothing is shuffled.
    """
    return encode_texts(
        docs, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]),
        lambda doc_id, text, ids, names: (doc_id, ids.astype(np.int32)), ranks, pattern,
    )


def decoded_documents(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); a null row of ids is an empty text."""
    path = ranks or default_ranks()

    def run(batches):
        table_of = load_ranks(path)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                decoder = Decoder(table_of) if not texts else decoder
                decoder.rest = b""
                slices = range(0, len(ids or []), 65_536)
                parts = [decoder.feed(ids[s : s + 65_536]) for s in slices]
                texts.append("".join(parts) + decoder.feed([], last=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the bytes decoded from them.

    The decoded bytes are the tokens' own, in order; Decoder makes text of them. A null or empty text
    has no ids; repeated rows and null doc_ids stay; no rows give no rows.
    """
    def row(doc_id, text, ids, names):
        sha = hashlib.sha256()
        for s in range(0, len(ids), 65_536):
            sha.update(b"".join(map(names.__getitem__, ids[s : s + 65_536].tolist())))
        return doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), sha.hexdigest()

    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])
    return encode_texts(docs, schema, row, ranks, pattern)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


register("op10_byte_bpe", query)
