"""Each operator against brute force on small tables that hold the odd cases."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

import brute
from ledgerloom.llm import byte_bpe, common, exact_dedup, language_id, lm_scoring, near_dedup, outliers, packing
from ledgerloom.llm import sharding, substring_dedup, tag_paths
from ledgerloom.llm.components import components

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves.
    *(T.StructField(n, T.StringType()) for n in ("shard", "count", "key", "cls", "n", "block", "_norm", "spans")),
])
VOCABULARY = [f"{a}{b}" for a in ("An", "the", "über", "thé", "Zu", "x") for b in ("ing", "er", "ön", "", "tion", "s")]


def _text(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def _rows():
    """Copies, near copies, shared passages, empty, null, very long, repeated and odd texts."""
    rng = random.Random(5)
    base = [_text(rng, n) for n in (3, 30, 60, 120, 200, 400, 400, 90)]
    texts = [None, "", "   ", "\n\t", "one", "a b c", "漢字 かな 😀 é", "x" * 5000, _text(rng, 9000), "\x00 nul", "<|endoftext|> y"]
    texts += base + base[:4] + [b.replace(" ", " \n ") for b in base[:3]]
    for b in base[4:7]:
        for edits in (1, 3, 9, 30):
            words = b.split(" ")
            for at in rng.sample(range(len(words)), edits):
                words[at] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    passage = _text(rng, 70)
    texts += [f"{_text(rng, 20)} {passage} {_text(rng, 20)}" for _ in range(4)]
    texts += [" ".join(passage.split(" ")[:49]) + " end", " ".join(passage.split(" ")[:50])]
    texts += ["same line\nsame line\n" * 15, "### $$$ " * 40, "ABC DEF!! " * 30]
    rng.shuffle(texts)
    rows = [(i * 3 % 211, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None])) for i, t in enumerate(texts)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), *["?"] * 8) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return _frame(spark, rows)


@pytest.fixture(scope="module")
def odd(spark, rows):
    """Null ids and rows that occur twice."""
    return _frame(spark, [*rows[:20], *rows[:5], (None, "lone words here", None, None), (None, rows[3][1], "en", "s1")])


@pytest.fixture(scope="module")
def empty(spark):
    return _frame(spark, [])


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def _sha(ids):
    return hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


OPERATORS = {
    "packing": lambda d: packing.pack(d, window=64), "outliers": outliers.quality, "sharding": sharding.propagate,
    "substring": substring_dedup.without_repeats, "lm": lm_scoring.scores, "exact": exact_dedup.exact_duplicates,
    "near": near_dedup.near_duplicates, "bpe": byte_bpe.digests,
    "language": lambda d: language_id.identify(language_id.document_evidence(d)),
    "filter_exact": exact_dedup.drop_exact_duplicates, "filter_near": near_dedup.drop_near_duplicates,
    "filter_spans": substring_dedup.remove_repeats, "filter_language": language_id.keep_identified,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_odd(empty, odd, name):
    assert OPERATORS[name](empty).count() == 0
    rows = OPERATORS[name](odd).count()
    if not name.startswith(("filter", "packing")):
        assert rows == odd.count()


def test_packing(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [*encoder.encode(t or "", add_special_tokens=False).ids, 1] for d, t, *_ in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, window=64).collect():
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans, end in [*((v, len(ids[d])) for d, v in pieces.items()), *((v, None) for v in sequences.values())]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == end if end else at <= 64
    assert sorted(sequences) == list(range(len(sequences))) and set(pieces) == set(ids)
    assert len(sequences) <= -(-sum(map(len, ids.values())) // 64) + 2


def test_packing_plan_finds_exact_fits():
    import itertools

    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randrange(1, 20): rng.randrange(1, 4) for _ in range(6)}
        room = rng.randrange(1, 40)
        best = max(
            s for times in itertools.product(*(range(n + 1) for n in counts.values()))
            if (s := sum(k * t for k, t in zip(counts, times, strict=True))) <= room
        )
        used = packing._closest(sorted(counts, reverse=True), counts, room)
        assert sum(k * t for k, t in used) == best and all(t <= counts[k] for k, t in used)
        planned = packing.plan(dict(counts), 40)
        total = Counter()
        for repeat, pattern in planned:
            assert sum(k * t for k, t in pattern.items()) <= 40
            for k, t in pattern.items():
                total[k] += repeat * t
        assert total == counts


def test_outliers_base(docs, rows):
    found = _by_id(outliers.quality(docs))
    for d, t, *_ in rows:
        r = found[d]
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == brute.base_statistics(t), t
        assert not (r["base_failed"] and r["kept"])


def test_outliers_against_numpy(spark):
    """Planted symbol, capital and repeat junk goes, plain texts stay, in every large enough group."""
    rng = random.Random(2)
    rows, junk = [], set()
    for i in range(400):
        text = ".\n".join(_text(rng, rng.randrange(8, 20)) for _ in range(rng.randrange(4, 9)))
        if i % 20 == 3:
            text, _ = re.sub(" ", "### ", text), junk.add(i)
        if i % 20 == 7:
            text, _ = text.upper(), junk.add(i)
        rows.append((i, text, "en" if i % 2 else "de", "s1" if i % 3 else None))
    found = _by_id(outliers.quality(_frame(spark, rows)))
    assert {d for d, r in found.items() if not r["kept"]} == junk


def test_outliers_in_each_statistic_alone(spark):
    """One statistic of a planted text is extreme, the others are as in the plain ones, which stay."""
    rng = random.Random(12)
    letters = "abcdefghijklmnop"

    def word(n=6):
        return "".join(rng.choice(letters) for _ in range(n))

    def plain():
        return [" ".join(word(rng.randrange(5, 8)) for _ in range(rng.randrange(6, 10))) for _ in range(8)]

    rows, junk = [], {}
    for i in range(600):
        lines, kind = plain(), None
        if i % 50 == 7:
            kind, lines = "length", [" ".join(word(60) for _ in line.split(" ")) for line in lines]
        elif i % 50 == 14:
            kind, lines = "symbols", [line.replace(" ", " ## ") for line in lines]
        elif i % 50 == 21:
            kind, lines = "lines", [x for line in lines for x in (line, "aaa bbb")]
        elif i % 50 == 28:
            kind, words = "repeats", " ".join(lines).split(" ")
            lines = [" ".join([*words, *words[:9]])]
        elif i % 50 == 35:
            kind, lines = "upper", [line.upper() for line in lines]
        if kind:
            junk[i] = kind
        rows.append((i, "\n".join(lines), "en", "s1"))
    found = _by_id(outliers.quality(_frame(spark, rows)))
    assert not any(r["base_failed"] for r in found.values())
    kept = {d: (junk.get(d), round(r["distance"])) for d, r in found.items() if r["kept"] == (d in junk)}
    assert kept == {}


def test_sharding(docs, rows):
    found = sharding.propagate(docs, shards=4).collect()
    texts = {d: t or "" for d, t, *_ in rows}
    by, homes = defaultdict(list), defaultdict(set)
    for r in found:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        by[r["shard"]].append(r["slot"])
        homes[texts[r["doc_id"]]].add(r["shard"])
    sizes = [len(v) for v in by.values()]
    assert len(by) == 4 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sum(len(v) > 1 for v in homes.values()) <= 2


def test_sharding_hot_group(spark):
    """A third of the rows are one text: it fills whole shards, and sizes stay even."""
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 2}", None, None) for i in range(1200)]
    found = sharding.propagate(_frame(spark, rows), shards=8).collect()
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes.values()) == {150}
    homes = Counter(r["shard"] for r in found if r["doc_id"] % 3 == 0)
    assert sum(homes.values()) == 400 and sum(n for _, n in homes.most_common(5)) >= 360


def test_substring(docs, rows):
    expected = brute.repeats([(d, t) for d, t, *_ in rows])
    got = {
        r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest())
        for r in substring_dedup.without_repeats(docs).collect()
    }
    assert got == expected and sum(v[1] > 0 for v in expected.values()) > 10


def test_substring_without_automata(docs, rows, monkeypatch):
    """Shards too large for an automaton give the same."""
    monkeypatch.setattr(substring_dedup, "MOST_STRETCHES", 1)
    expected = {d: v[1] for d, v in brute.repeats([(d, t) for d, t, *_ in rows]).items()}
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.without_repeats(docs).collect()} == expected


def test_suffix_automaton():
    rng = random.Random(3)
    for _ in range(300):
        automaton, known = substring_dedup.SuffixAutomaton(), {}
        document = 0
        for _ in range(rng.randrange(1, 6)):
            document += rng.randrange(2)
            word = [rng.randrange(3) for _ in range(rng.randrange(1, 14))]
            mask = sum(
                1 << i for i in range(len(word) - 2) if known.get(tuple(word[i : i + 3]), document) < document
            )
            assert automaton.earlier(word, document, 3) == mask
            automaton.add(word, document)
            for i in range(len(word) - 2):
                known.setdefault(tuple(word[i : i + 3]), document)


def test_language(spark):
    rng = random.Random(4)
    words = {"en": ["the", "thing", "with", "ation", "ought"], "de": ["der", "über", "schlich", "keit", "ung"]}
    rows, truth = [], {}
    for i in range(400):
        truth[i] = "en" if i % 2 else "de"
        text = " ".join(rng.choice(words[truth[i]]) + rng.choice("aeiou") for _ in range(30))
        declared = truth[i] if i % 10 else ("de" if truth[i] == "en" else "EN-us")
        rows.append((i, text, declared if i % 7 else None, f"host{truth[i]}"))
    rows += [(1000, "", "en", "hosten"), (1001, None, None, None)]
    found = _by_id(language_id.identify(language_id.document_evidence(_frame(spark, rows))))
    assert all(found[i]["language"] == t and found[i]["kept"] for i, t in truth.items())
    assert not found[1000]["kept"] and not found[1001]["kept"]


def test_language_evidence_decides_short_texts(spark):
    """A text that says little goes with what is declared and with its host."""
    rows = [(i, "thing with ought " * 5 if i % 2 else "schlich keit über " * 5, "en" if i % 2 else "de",
             "a.org" if i % 2 else "b.org") for i in range(100)]
    rows += [(200, "zzz", "de", None), (201, "zzz", None, "a.org"), (202, "zzz", None, "b.org")]
    found = _by_id(language_id.identify(language_id.document_evidence(_frame(spark, rows))))
    assert [found[i]["language"] for i in (200, 201, 202)] == ["de", "en", "de"]


RARE = {"en": ["the", "thing", "with", "ation", "ought"], "es": ["los", "ñar", "ción", "ado", "que"]}


def _rare(rng, i, language):
    return " ".join(rng.choice(RARE[language]) + rng.choice("aeiou") for _ in range(40))


def test_language_keeps_rare_languages(spark):
    """Three rows of a language are a class of their own, and so are more languages than one part holds."""
    rng = random.Random(9)
    rows = [(i, _rare(rng, i, "en"), "en", f"s{i % 3}") for i in range(300)]
    rows += [(1000 + i, _rare(rng, i, "es"), "es", f"s{i}") for i in range(3)]
    letters = "bcdfghjklmnpqrstvwxz"
    for n in range(70):
        own = [letters[n % 20] + v + letters[n // 4] + w for v in "aeiou" for w in "aeiou"]
        code = f"x{chr(97 + n // 26)}{chr(97 + n % 26)}"
        rows += [(2000 + 2 * n + k, " ".join(rng.choice(own) for _ in range(40)), code, None) for k in range(2)]
    found = _by_id(language_id.identify(language_id.document_evidence(_frame(spark, rows))))
    assert all(found[d]["kept"] and found[d]["language"] == lang for d, _, lang, _ in rows)


def test_language_without_declarations(spark):
    """Clean rows stay where nothing is declared; noise goes."""
    rng = random.Random(10)
    rows = [(i, _rare(rng, i, "en" if i % 9 else "es"), None, None) for i in range(180)]
    rows += [(1000, "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(60)), None, None), (1001, "", None, None)]
    frame = _frame(spark, rows)
    found = _by_id(language_id.identify(language_id.document_evidence(frame)))
    assert {d for d, r in found.items() if r["kept"]} == set(range(180))
    assert all(r["language"] is None for r in found.values())
    assert {r["doc_id"] for r in language_id.keep_identified(frame).collect()} == set(range(180))


def test_page_evidence(spark):
    pages = spark.createDataFrame([
        (1, "https://Blog.example.de/a?x=1", '<!doctype html><html class="x" lang="de-AT"><p>x'),
        (2, "not a url", None), (3, None, "<html><p>y"),
    ], "page_id long, url string, html string")
    got = {r["doc_id"]: (r["declared"], r["host"], r["suffix"]) for r in language_id.page_evidence(pages).collect()}
    assert got[1] == ("de-AT", "blog.example.de", "de")
    assert got[2][1] is None and got[3][1] is None


def test_page_language(spark, tmp_path):
    """The query over pages fuses markup language, host and suffix as by brute force."""
    rng = random.Random(11)
    pages, evidence = [], []
    for i in range(240):
        language, suffix = ("en", "org") if i % 2 else ("es", rng.choice(["es", "org"]))
        host = f"h{rng.randrange(4)}.{suffix}" if i % 11 else None
        declared = (language if i % 10 else "fr") if i % 3 else None
        words = " ".join(rng.choice(RARE[language]) for _ in range(3 if i % 4 else 1)) if i % 17 else "zq"
        tag = f' lang="{declared}-XX"' if declared else ""
        text = f"<html{tag}><p>{words}"
        pages.append((i, f"https://{host}/a" if host else None, text))
        # An address without a host has an empty suffix.
        evidence.append((i, text, declared, host, suffix if host else ""))
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in language_id.page_query(spark, str(tmp_path)).collect()}
    expected = brute.languages(evidence)
    assert len(got) == 240
    for i, (language, confidence) in expected.items():
        assert got[i]["confidence"] == pytest.approx(confidence, rel=1e-3)
        assert got[i]["language"] == language or confidence < 0.501
    no_suffix = brute.languages([(*r[:4], None) for r in evidence])
    assert any(abs(no_suffix[i][1] - c) > 0.01 for i, (_, c) in expected.items())


def test_lm_beats_base(spark):
    """Of held-out texts that the model never read, nearly all score above the base."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in lm_scoring.scores(docs).collect() if r["held_out"]]
    assert len(held) > 100
    assert sum(r["score"] > r["base_score"] for r in held) >= 0.95 * len(held)


def test_lm_without_training(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    docs = spark.createDataFrame([(i, "Some words", 7) for i in ids], "doc_id long, text string, block int")
    for r in lm_scoring.scores(docs).collect():
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


def test_lm_long_text(spark):
    """A text longer than a chunk of numpy work and than a block."""
    rows = [(0, "Alpha beta gamma " * 60_000), (1, "beta alpha"), (2, None), (4, "")]
    model = brute.word_model([(d, t or "") for d, t in rows], 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in lm_scoring.scores(docs, block_bytes=100_000).collect():
        assert r["score"] == pytest.approx(model[r["doc_id"]], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm(docs, rows, order):
    plain = [(d, t) for d, t, *_ in rows]
    base, model = brute.base_scores(plain), brute.word_model(plain, order)
    for r in lm_scoring.scores(docs, order=order, block_bytes=20_000).collect():
        d = r["doc_id"]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == base[d][:4]
        assert r["base_score"] == pytest.approx(base[d][4], rel=1e-9)
        assert r["score"] == pytest.approx(model[d], rel=1e-9)


def test_exact(docs, rows):
    groups = defaultdict(list)
    forms = {d: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for d, t, *_ in rows}
    for d, form in forms.items():
        groups[form].append(d)
    for r in exact_dedup.exact_duplicates(docs).collect():
        same = groups[forms[r["doc_id"]]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(same), len(same), min(same) == r["doc_id"])
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {min(v) for v in groups.values()}


@pytest.mark.parametrize("n", [4, 5])
def test_near(docs, rows, n):
    expected = brute.near([(d, t) for d, t, *_ in rows], n)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs, n).collect()}
    assert got == expected


def test_near_large_group(spark):
    """Edited copies of a few texts, some too far from each other: all components as by brute force."""
    rng = random.Random(6)
    rows = []
    for base in [_text(rng, 150).split(" ") for _ in range(3)]:
        for _ in range(120):
            words = list(base)
            for at in rng.sample(range(150), rng.randrange(0, 9)):
                words[at] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words), None, None))
    rng.shuffle(rows)
    expected = {d: v[1] for d, v in brute.near([(d, t) for d, t, *_ in rows], 4).items()}
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(_frame(spark, rows), 4).collect()}
    assert got == expected


def test_chunk_keys_guarantee():
    """Any two signatures that differ in at most 23 slots share a key."""
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        a = rng.integers(0, 1 << 16, near_dedup.SLOTS, dtype=np.uint16)
        b = a.copy()
        at = rng.choice(near_dedup.SLOTS, 2 * near_dedup.CHUNKS - 1, replace=False)
        b[at] ^= np.uint16(1)
        differ = (a != b).reshape(near_dedup.CHUNKS, -1).sum(axis=1)
        assert differ.min() <= 1


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    expected = brute.roots({x for pair in links for x in pair}, links)
    got = components(spark.createDataFrame([*links, (None, 5)], "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {n: r for n, r in expected.items() if sum(a == n != b or b == n != a for a, b in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bpe_splits_plain_texts_alike():
    import public_tokenizers
    import regex

    assert byte_bpe.PATTERN == public_tokenizers.PATTERN
    general, fast = regex.compile(byte_bpe.PATTERN).findall, byte_bpe.splitter(byte_bpe.PATTERN)
    plain = [chr(i) for i in [*range(9, 14), *range(32, 127), *range(0xA0, 0x250)]]
    rng = random.Random(6)
    for _ in range(20_000):
        text = "".join(rng.choice(plain if rng.random() < 0.5 else " '\t\nstdrevlm1 ") for _ in range(rng.randrange(9)))
        assert fast(text) == general(text)
    for text in ("a\x85b", "x\x1cy", "漢字 1", "é́a", ""):
        assert fast(text) == general(text)


def test_bpe(docs, rows):
    import public_tokenizers

    path, texts = public_tokenizers.path("byte_bpe_50k.tiktoken"), [t or "" for _, t, *_ in rows]
    expected = dict(zip((r[0] for r in rows), brute.tokens_of(texts, path, public_tokenizers.PATTERN), strict=True))
    for r in byte_bpe.digests(docs).collect():
        ids = expected[r["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), _sha(ids))
    encoded = byte_bpe.encoded_documents(docs)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == expected
    decoded = byte_bpe.decoded_documents(encoded)
    assert {r["doc_id"]: r["text"] for r in decoded.collect()} == {r[0]: t for r, t in zip(rows, texts, strict=True)}


def test_transducer_and_decoder_on_noise():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = byte_bpe.Encoder(path, public_tokenizers.PATTERN), byte_bpe.Decoder(ranks)
    rng = random.Random(8)
    alphabet = "aeinorst  \n\t'\"-=_*#éüñ漢😀0123 　"
    for _ in range(400):
        text = "".join(rng.choice(alphabet) * rng.choice((1, 1, 1, 2, 9)) for _ in range(rng.randrange(60)))
        ids = encoder(text).tolist()
        assert ids == library.encode_ordinary(text)
        decoder.rest = b""
        assert "".join(decoder.feed([i]) for i in ids) + decoder.feed([], last=True) == text
    for piece in ("a" * 4000, " " * 3000, "=-" * 2000, "étion" * 500):
        assert encoder(piece).tolist() == library.encode_ordinary(piece)


PAGE = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a><li><a>B</a></ul></nav>
<div class="ad">Buy, now.</div><article><h2>Head &amp; line</h2><p>First <b>bold</b>&nbsp;text,
with   space.<p>Second: 1 &lt; 2.<ul><li>point<li>more</ul><aside>Side, note.</aside><form>Name <input> </form>
<div id="comments"><p>Great post, thanks!</p></div></article><div class=sidebar>Links, here.</div>
<footer>&copy; 2020.</footer></body>"""


def test_tag_paths(spark):
    expected = "Head & line First bold text, with space. Second: 1 < 2. point more"
    assert tag_paths.main_text(PAGE) == expected
    bare = PAGE.replace("<article>", "<div class=story>").replace("</article>", "</div>")
    assert tag_paths.main_text(bare) == expected
    pages = spark.createDataFrame(
        [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "plain text, only"), (4, "x", "<p>a<p title='>'>b<"),
         (5, "y", "<article><p>" + "word, " * 30_000)],
        "page_id long, url string, html string",
    )
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in tag_paths.extract(pages).collect()]
    assert got[:5] == [(1, expected, len(expected))] * 2 + [(2, "", 0), (3, "", 0), (None, "plain text, only", 16)]
    assert got[5][1] == "a b<" and got[6][1] == ("word, " * 30_000).strip()
    assert tag_paths.extract(pages.limit(0)).count() == 0


LONG = "<p>" + "A sentence of the article, with some words and marks. " * 6


def test_tag_paths_judges_inside_article():
    """Link lists, teasers and repeated notices inside article or main go; headings and short lines stay."""
    links = "".join(f"<li><a href=/{i}>Other story {i}</a></li>" for i in range(6))
    cards = "".join(f"<div class=card><h3><a href=/{i}>Read this {i}</a></h3><p>A teaser.</p></div>" for i in range(4))
    notice = "<div class=box>Only for members</div>"
    for name in ("article", "main"):
        page = (
            f"<html><body><{name}><h1><a href=/t>Title here</a></h1>{LONG}{notice}{LONG}{notice}{LONG}{notice}{LONG}"
            f"<ul class=x><li>point</li><li>more</li></ul>{LONG}<table><tr><td>0<td>0<td>0</table>{LONG}<ul class=y>{links}</ul><div class=z>{cards}</div></{name}></body></html>"
        )
        text = tag_paths.main_text(page)
        assert text.startswith("Title here A sentence") and "point more" in text and "0 0 0" in text
        assert text.count("A sentence") == 36
        assert not any(w in text for w in ("Other story", "teaser", "Read this", "members"))


def test_tag_paths_keeps_the_articles_own_header():
    """An article's header and captions are its text; the page's header is not."""
    page = (
        f"<body><header><h1>Site</h1></header><article><header><h1>Headline</h1></header>{LONG}"
        f"<figure><img src=a><figcaption>A caption.</figcaption></figure>{LONG}<footer>Tags</footer></article></body>"
    )
    text = tag_paths.main_text(page)
    assert text.startswith("Headline A sentence") and "A caption." in text
    assert "Site" not in text and "Tags" not in text


def _nameless(seed):
    """A page of plain div and p elements, and its article's text."""
    rng = random.Random(seed)
    words = [f"w{seed}x{i}" for i in range(200)]

    def some(a, b):
        return " ".join(rng.choice(words) for _ in range(rng.randint(a, b)))

    paragraphs = [some(20, 60) + ", " + some(10, 40) + "." for _ in range(rng.randint(4, 9))]
    title = some(3, 6)
    menu = "".join(f"<div><div>{some(1, 2)}</div></div>" for _ in range(rng.randint(3, 7)))
    side = "".join(f"<div><div><p>{some(2, 4)}</p></div></div>" for _ in range(rng.randint(2, 6)))
    foot = f"<div><div><div>{some(2, 5)}</div></div></div>"
    article = f"<div><h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"
    parts = [f"<div>{menu}</div>", f"<section>{article}</section>", f"<div>{side}</div>", foot]
    if seed % 3 == 0:
        parts[1:3] = parts[2:0:-1]
    return f"<html><body>{''.join(parts)}</body></html>", " ".join([title, *paragraphs])


def test_tag_paths_without_names(monkeypatch):
    """Where no name tells the article, the ratios alone choose it: constant ratios fail."""
    pages = [_nameless(seed) for seed in range(40)]
    assert [tag_paths.main_text(html) for html, _ in pages] == [text for _, text in pages]
    monkeypatch.setattr(tag_paths, "_fused_ratios", lambda nodes: ([1.0] * len(nodes),) * 2)
    assert not any(tag_paths.main_text(html) == text for html, text in pages)


def test_tag_reader_loses_no_text():
    """Long attributes, self-closed and unclosed raw elements, and forms around a page."""
    long = "x" * 4001
    for quote in "\"'":
        style = f"style={quote}{long}>{quote}"
        assert tag_paths.main_text(f"<div><article><div {style}>a</div><p>b</article></div>") == "a b"
        assert tag_paths.main_text(f"<nav {style}><p>menu</nav><article><p>text, here</article>") == "text, here"
    assert tag_paths.main_text('<article><p title="no end>a</p><p>b') == "a b"
    for name in ("svg", "math"):
        assert tag_paths.main_text(f"<article><p>one <{name} class=i/> two<p>three</article>") == "one two three"
    for name in ("iframe", "object", "noscript", "svg"):
        assert tag_paths.main_text(f"<article><p>one <{name} class=i> two<p>three</article>") == "one three"
        assert tag_paths.main_text(f"<article><p>one <{name}><p>x</p></{name}> two</article>") == "one two"
    assert tag_paths.main_text("<article><p>one<script>two<p>three</article>") == "one"
    assert tag_paths.main_text(PAGE.replace("<header>", "<form action=/><header>", 1)) == tag_paths.main_text(PAGE)
    wrapped = f"<body><form><div class=sidebar>Side</div><div>{LONG}{LONG}</div></form></body>"
    assert tag_paths.main_text(wrapped).count("A sentence") == 12 and "Side" not in tag_paths.main_text(wrapped)


def test_ranked(spark):
    rows = [(i % 3, i * 7 % 101) for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, v int")
    for group in (["g"], []):
        got = common.ranked(df, group, [df["v"]], "rank", (df["v"] % 2).cast("int"), rows_per_bucket=20).collect()
        by = defaultdict(list)
        for r in got:
            by[r["g"] if group else 0].append((r["rank"], r["v"] % 2))
        for v in by.values():
            v.sort()
            assert [x for x, _ in v] == list(range(len(v))) and [y for _, y in v] == sorted(y for _, y in v)


def test_tasks_of_a_worker_share_an_encoder(spark, tmp_path):
    """A worker's second task starts with what the first one's texts taught it; a changed ranks file starts anew."""
    import os

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("worker", "encoder")])
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(40)
    seen = byte_bpe.encode_texts(docs, schema, lambda doc_id, text, ids, names: (os.getpid(), id(names))).distinct().collect()
    assert len(seen) == len({r["worker"] for r in seen}) < 40
    own = tmp_path / "ranks"
    own.write_bytes(open(path, "rb").read())
    first = byte_bpe.shared_encoder(str(own), public_tokenizers.PATTERN)
    assert byte_bpe.shared_encoder(str(own), public_tokenizers.PATTERN) is first
    os.utime(own, ns=(1, 1))
    assert byte_bpe.shared_encoder(str(own), public_tokenizers.PATTERN) is not first
