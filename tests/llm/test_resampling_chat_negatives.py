"""Resampling, chat formatting and hard negatives against brute force, on tables that hold the odd cases."""

import dataclasses
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import chat, hard_negatives, resampling

BITS = ["<s>", "</s>", "[INST]", "[/INST]", " [/INST]", "\\", "<", "[", "/", "|", "]", "[|]", "s>", " ", "x", "é", "\n", "[TURN] "]
ROLES = ["system", "user", "assistant", "tool", "", "a[|]\\"]


# ---- resampling ------------------------------------------------------------------------------

def _features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _resampled(rows, target, percent, least):
    """[(doc_id, n_features, weight, score, rank)] by the definition."""
    def hist(texts):
        return Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in _features(t)[1])

    s, t = hist(r[1] for r in rows), hist(target)
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))

    out = []
    for doc_id, text in rows:
        words, features = _features(text)
        weight = sum(gain(zlib.crc32(f.encode()) % 10_000) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(features), weight, weight + noise, None, len(words) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def _texts():
    rng = random.Random(3)
    vocabulary = ["An", "the", "über", "Zu9", "x-y", "ÀB", "漢字", "a.b", "9", "don't", "İ"]
    texts = [None, "", "  ", "one", "A" * 9000, "\x00 nul", "word " * 3000]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))) for _ in range(60)]
    return [(i * 7 % 101, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("percent", [25, 0, 100])
def test_resampling(spark, percent):
    rows = _texts()
    rows += [(None, "the über " * 15), (None, "the über " * 15), *[(500, "Zu9 an " * 12)] * 9, (501, None)]
    target = [t for _, t in rows[10:20]] + [None, ""]
    docs = spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, text string, score string")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, wanted, percent=percent)
    found = [tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(found, key=repr) == _resampled(rows, target, percent, 20)
    kept = {r["doc_id"] for r in resampling.draw(docs, wanted, percent=percent).collect()}
    assert kept == {r[0] for r in found if r[4] is not None}


def test_resampling_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 30)], "doc_id long, text string")
    assert resampling.resample(none, some).count() == 0
    (row,) = resampling.resample(some, none, percent=100).collect()
    assert row["n_features"] == 119 and row["rank"] == 1
    assert resampling.draw(some, none).count() == 0


def test_feature_windows():
    text = "The über,the 9-x"
    low = text.lower()
    found = list(resampling.feature_windows(text, resampling.splitter(), 3))
    words = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
    runs = [words[i : i + n] for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert found == [(r[0][0], r[-1][1], zlib.crc32(" ".join(low[a:b] for a, b in r).encode())) for r in runs]


# ---- chat formatting -------------------------------------------------------------------------

def _messages(rng, n):
    return [(rng.choice(ROLES), "".join(rng.choice(BITS) for _ in range(rng.randrange(9)))) for _ in range(n)]


def test_located_reads_back():
    rng = random.Random(1)
    full = dataclasses.replace(chat.INST, horizon=None)
    for n in [1, 2, 3, 5] * 60 + [40, 150]:
        messages = _messages(rng, n)
        found = list(chat.located(chat.INST, messages))
        text = "".join(f[0] for f in found)
        assert text == chat.render_inst([(r, chat.INST.escape(t)) for r, t in messages])
        assert list(chat.read_inst(text)) == messages
        assert [chat.Template.unescape(text[a:b]) for _, _, a, b, _ in found] == [t for _, t in messages]
        assert found == list(chat.located(full, messages))


def test_escape_leaves_no_control_string():
    template = chat.Template(lambda m: "", ("aa", "aba", "<|x|>"))
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("ab<|x>\\") for _ in range(12))
        escaped = template.escape(text)
        assert template.unescape(escaped) == text
        assert not any(c in escaped for c in template.controls)


def test_rewriting_templates_are_found():
    def last_only(messages):
        """Hides earlier assistant texts once a later one is there."""
        last = max((i for i, (r, _) in enumerate(messages) if r == "assistant"), default=-1)
        return "".join(
            f"({r}:{t if r != 'assistant' or i == last else ''})" for i, (r, t) in enumerate(messages)
        )

    template = chat.Template(last_only, ("((", "))"))
    talk = [("user", "q"), ("assistant", "one"), ("user", "r"), ("assistant", "two"), ("user", "s")]
    found = list(chat.located(template, talk))
    assert [f[4] for f in found] == [False, False, False, True, True]
    assert all(f[1:4] == (None, None, None) for f in found if f[4])
    assert not any(f[4] for f in chat.located(template, talk[:3]))


def test_every_prefix_is_rendered_whole():
    """A template may say what horizon it likes: each turn is found in the whole prefix that ends with it."""
    lengths = []

    def numbered(messages):
        lengths.append(len(messages))
        return "".join(f"<{len(messages) // 50}.{i}>" * (i == 0) + f"({r}:{t})" for i, (r, t) in enumerate(messages))

    template = chat.Template(numbered, ("((", "))"), horizon=2)
    found = list(chat.located(template, [("user", f"t{i}") for i in range(60)]))
    assert sorted(lengths) == sorted([*range(1, 61), *range(1, 50), *range(1, 50)])
    assert [f[4] for f in found] == [False] * 49 + [True] * 11
    assert found[48][1:4] == (found[48][1], found[48][1] + 6, found[48][1] + 9)


def test_template_that_drops_a_text():
    template = chat.Template(lambda m: "".join(f"<{r}>{t}" * (r != "hidden") for r, t in m), ("<user>", "<hidden>"))
    found = list(chat.located(template, [("user", "a"), ("hidden", "b"), ("user", "")]))
    assert found == [("<user>a", 0, 6, 7, False), ("", 7, None, None, False), ("<user>", 7, 13, 13, False)]


def test_format_chats(spark):
    rng = random.Random(4)
    rows = []
    for conv_id in [*range(30), None]:
        for turn, (role, text) in enumerate(_messages(rng, rng.randrange(1, 7))):
            rows.append((conv_id, turn, role, text))
    rows += [(50, i, ROLES[i % 3], f"turn {i} " * 20) for i in range(300)]
    rows += [(51, None, None, None), (51, 1, "user", None), (51, 1, "user", None), (51, 1, "assistant", "b"), (52, 0, "assistant", "é" * 50_000)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "?") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    turns = chat.format_chats(frame, chat.INST)
    assert turns.count() == len(rows)
    talks = defaultdict(list)
    low = lambda v: (v is not None, v if v is not None else 0)
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (low(r[1]), low(r[2]) if r[2] is None else (True, r[2]), (r[3] is not None, r[3] or ""))):
        talks[conv_id].append((role or "", text or ""))
    got = {r["conv_id"]: r for r in chat.read_back(turns).collect()}
    assert got.keys() == talks.keys()
    for conv_id, talk in talks.items():
        formatted = chat.render_inst([(r, chat.INST.escape(t)) for r, t in talk])
        learnt = "".join(t for r, t in talk if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in talk).encode()).hexdigest()
        assert tuple(got[conv_id])[1:] == (
            len(talk), digest, len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(formatted)
        )
    assert chat.format_chats(frame.limit(0), chat.INST).count() == 0
    assert chat.read_back(chat.format_chats(frame.limit(0), chat.INST)).count() == 0


# ---- hard negatives --------------------------------------------------------------------------

@pytest.mark.parametrize("reach", [300, 1 << 12, 1 << 20, 1 << 29, 1 << 45, 1 << 61])
def test_packed_products_are_exact(reach):
    rng = np.random.default_rng(reach % 97)
    c, a = (rng.integers(-reach, reach, (n, 9)) for n in (50, 6))
    c[3], c[4], a[1] = 0, reach - 1, -reach
    wanted = np.clip(c.astype(object) @ a.astype(object).T, -(2**63 - 1), 2**63 - 1)
    assert (hard_negatives.packed_products(c, a) == wanted).all()
    assert (hard_negatives.scores(c, a[:, :7]) == np.clip(
        c[:, :7].astype(object) @ a[:, :7].astype(object).T, -(2**63 - 1), 2**63 - 1
    )).all()


def _mined(rows):
    """{(anchor, positive, rank, negative, positive score, negative score)} by all pairs in Python integers."""
    clean = [
        (i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for i, y, v in clean:
        if i % 100:
            continue
        scored = [(max(min(sum(map(int.__mul__, v, w)), 2**63 - 1), 1 - 2**63), j, z) for j, z, w in clean]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for p, j, z in [s for s in scored if s[2] == y and s[1] != i][:5]:
            band = [s for s in scored if s[2] != y and 80 * p <= 100 * s[0] <= 100 * p]
            out |= {(i, j, rank, k, p, n) for rank, (n, k, _) in enumerate(band[:5], 1)}
    return out


def _vectors(rng, n, spread=1.0):
    centres = rng.standard_normal((4, 8))
    return [
        (i, int(rng.integers(0, 4)), [float(x) for x in spread * (centres[i % 4] + 0.4 * rng.standard_normal(8))])
        for i in range(n)
    ]


def test_mine(spark):
    rng = np.random.default_rng(8)
    rows = _vectors(rng, 450)
    rows += [(1000 + i, 2, rows[0][2]) for i in range(90)] + [(1100 + i, 3, rows[100][2]) for i in range(90)]
    rows += [
        (2000, None, rows[0][2]), (None, 1, rows[0][2]), (2100, 1, None), (2200, 1, [1.0, None]), (2300, 1, [float("nan")] * 8),
        (2400, 1, [float("inf")] * 8), (2500, 1, []), (2600, 0, [0.5]), (2601, 1, [0.5, 0.25]), (2700, 3, [1e30] * 8), (2701, 3, [1e12] * 12),
    ]
    frame = spark.createDataFrame([(*r, "?") for r in rows], "vec_id long, label long, vector array<double>, anchor string")
    from pyspark.sql import functions as F

    part = hard_negatives.taking_part(frame, F.col("vec_id"), F.col("label"), F.col("vector"))
    anchors = F.col("vec_id") % 100 == 0
    wanted = _mined(rows)
    assert len(wanted) > 20
    assert {tuple(r) for r in hard_negatives.mine(part, anchors).collect()} == wanted
    # Groups and chunks of a few rows change nothing.
    small = pytest.MonkeyPatch()
    small.setattr(hard_negatives, "GROUP_COMPONENTS", 400)
    assert {tuple(r) for r in hard_negatives.mine(part.repartition(7), anchors).collect()} == wanted
    small.undo()
    assert hard_negatives.mine(part.where("false"), anchors).count() == 0
    assert hard_negatives.mine(part, F.lit(False)).count() == 0


def test_mine_repeated_rows(spark):
    from pyspark.sql import functions as F

    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 0.0]), (2, 2, [0.9, 0.0])]
    part = spark.createDataFrame(rows, "vec_id long, label long, vector array<double>")
    found = sorted(tuple(r) for r in hard_negatives.mine(part, F.col("vec_id") % 100 == 0).collect())
    assert found == sorted([(0, 1, rank, 2, 65536, 256 * 230) for _ in range(2) for rank in (1, 2)])


def test_best_keeps_smaller_ids():
    best = hard_negatives.Best(1, 3)
    for ids in ([10, 11, 12, 13, 14], [1, 2, 3, 20]):
        best.meet(np.array(ids), np.full((len(ids), 1), 7))
    best.meet(np.array([30]), np.array([[8]]))
    assert [x.tolist() for x in best.rows()] == [[0, 0, 0], [30, 1, 2], [8, 7, 7]]
