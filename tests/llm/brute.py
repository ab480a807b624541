"""Brute-force forms of the operators, on lists of rows in plain Python."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(rows, n, percent=80):
    """{doc_id: (set size, component)} by all pairs that share a shingle."""
    sets = {}
    for doc_id, text in rows:
        ws = words(lowered(text))
        sets[doc_id] = {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()
    by = defaultdict(list)
    for doc_id, s in sets.items():
        for x in s:
            by[x].append(doc_id)
    shared = Counter()
    for ids in by.values():
        ids.sort()
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[a, b] += 1
    links = [
        (a, b) for (a, b), m in shared.items() if 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m)
    ]
    found = roots(sets, links)
    return {d: (len(sets[d]), found[d]) for d in sets}


def repeats(rows, window=50):
    """{doc_id: (words, removed, sha of the kept words)}; a window goes if an earlier row has it."""
    first = {}
    texts = {d: words(t) for d, t in rows}
    for d in sorted(texts):
        ws = texts[d]
        for i in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[i : i + window]), d)
    out = {}
    for d, ws in texts.items():
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out[d] = (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def base_statistics(text):
    """(words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    ws = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    counts = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    covered = set()
    for i in range(len(ws) - 7):
        if counts[tuple(ws[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    n = len(ws)
    return (
        n, sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(covered), n < 20 or 100 * len(covered) > 30 * n,
    )


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base_scores(rows):
    """{doc_id: (held out, tokens, known, training tokens, base score)}."""
    tokens = {d: [*words(lowered(t)), None] for d, t in rows}
    counts = Counter(x for d, ts in tokens.items() if not held_out(d) for x in ts)
    n, v = sum(counts.values()), len(counts)
    return {
        d: (held_out(d), len(ts), sum(counts[x] > 0 for x in ts), n,
            sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in ts))
        for d, ts in tokens.items()
    }


def word_model(rows, order):
    """{doc_id: log10 probability} by the interpolated word model written out, token by token."""
    # None ends a text; as the first of a context it starts one.
    lines = {d: [None, *words(lowered(t)), None] for d, t in rows}
    after = defaultdict(Counter)
    for d, line in lines.items():
        if not held_out(d):
            for i in range(1, len(line)):
                for k in range(min(order, i + 1)):
                    after[tuple(line[i - k : i])][line[i]] += 1
    known = after[()]
    total = known.total()
    # How often a context occurs as an n-gram: the start as often as the end.
    times = {c: after[c[:-1]][c[-1]] if c != (None,) else known[None] for c in list(after) if c}
    tokens, once = Counter(), Counter()
    for context, following in after.items():
        if context:
            kind = len(context), times[context].bit_length()
            tokens[kind] += following.total()
            once[kind] += sum(c == 1 for c in following.values())
    unknown = (sum(c == 1 for c in known.values()) + 1) / (total + 2) if total else 1.0

    def p(context, token):
        if not context:
            return (1 - unknown) * known[token] / total if known[token] else unknown
        below = p(context[1:], token)
        if not times.get(context):
            return below
        kind = len(context), times[context].bit_length()
        left = (once[kind] + 1) / (tokens[kind] + 2)
        return (1 - left) * after[context][token] / times[context] + left * below

    return {
        d: sum(math.log10(p(tuple(line[max(0, i - order + 1) : i]), line[i])) for i in range(1, len(line)))
        for d, line in lines.items()
    }


def tokens_of(texts, path, pattern):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary_batch(texts)


def jaccard(a, b):
    return Fraction(len(a & b), len(a | b)) if a | b else Fraction(0)


def languages(rows, buckets=1 << 14, background_strength=2000, full=150, strength=20):
    """{id: (language, confidence)} of (id, text, declared, host, suffix), the fusion written out."""
    def grams(text):
        data = lowered(text).encode()
        return [
            ((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 2654435761 % 2**32) >> 18 for i in range(len(data) - 2)
        ]

    found = {r[0]: grams(r[1]) for r in rows}
    names = sorted({r[2] for r in rows if r[2]})
    everything, counts = Counter(), {name: Counter() for name in names}
    for i, _, declared, *_ in rows:
        everything.update(found[i])
        if declared:
            counts[declared].update(found[i])
    n = sum(everything.values())

    def share(b):
        return (everything[b] + 0.5) / (n + 0.5 * buckets)

    def mean(name, gs):
        c = counts[name]
        size = c.total() + background_strength
        return sum(math.log((c[g] + background_strength * share(g)) / size) for g in gs) / len(gs)

    means = {i: {name: mean(name, gs) for name in names} for i, gs in found.items() if gs}
    guesses = {}
    for i, m in means.items():
        chance = max(max(m.values()), sum(math.log(share(g)) for g in found[i]) / len(found[i]))
        if chance + math.log(buckets) > 0:
            guesses[i] = max(names, key=lambda x: m[x])
    overall, by_suffix, by_host, by_declared = Counter(), defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for i, _, declared, host, suffix in rows:
        if i in guesses:
            overall[guesses[i]] += 1
            by_suffix[suffix][guesses[i]] += 1
            by_host[host, suffix][guesses[i]] += 1
            by_declared[declared][guesses[i]] += 1
    out = {}
    for i, _, declared, host, suffix in rows:
        logs = {}
        for x in names:
            prior = (overall[x] + 1) / (overall.total() + len(names))
            if suffix is not None and suffix in by_suffix:
                prior = (by_suffix[suffix][x] + strength * prior) / (by_suffix[suffix].total() + strength)
            if host is not None and (host, suffix) in by_host:
                prior = (by_host[host, suffix][x] + strength * prior) / (by_host[host, suffix].total() + strength)
            said = (by_declared[declared][x] + 1) / (overall[x] + len(names) + 1) if declared and declared in by_declared else 1
            logs[x] = (means[i][x] * min(len(found[i]), full) if found[i] else 0) + math.log(prior) + math.log(said)
        best = max(names, key=lambda x: logs[x])
        out[i] = (best, 1 / sum(math.exp(v - logs[best]) for v in logs.values()))
    return out
