"""Source divergence against dense columns."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus
from purchlake.llm import divergence_audit as da


def expected(rows):
    docs = [(r[2] or "", r[3] or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(corpus.LOWER)))
            for r in rows]
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in docs:
        groups[lang].add(source)
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in seen[lang].items() if n >= 10)
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        f = lambda x, y: (x - y) * (x - y) // (x + y)
        for s in sources:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, 10)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items[:most])}
    return out


def audit_rows(seed, n=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéλ字") for _ in range(rng.randrange(1, 5))) for _ in range(90)]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 else rng.choice(["s1", "s2", "S3", "ünï", "", None])
        lang = rng.choice(["en", "en", "de", None])
        text = " ".join(rng.choice(vocabulary[:rng.choice([5, 30, 90])]) for _ in range(rng.randrange(0, 40)))
        rows.append((i, text.upper() if i % 7 == 0 else text, lang, source, 1))
    rows += [(9000, None, "en", "no text", None), (9001, "", "xx", "alone", 0), (9002, "rare words", "yy", "a", 1),
             (9003, "rare words", "yy", "b", 1), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("block", [da.BLOCK, 40])
def test_against_dense_columns(spark, monkeypatch, block):
    monkeypatch.setattr(da, "BLOCK", block)
    monkeypatch.setattr(da, "LONG_TEXT", 100)
    rows = audit_rows(2)
    got = da.audit(corpus.frame(spark, rows, clashing=True).repartition(5))
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint",
                                "rank": "int"}
    assert Counter(map(tuple, got.collect())) == Counter(expected(rows))


def test_hostile_corpus(spark):
    rows = corpus.corpus() * 4
    assert set(map(tuple, da.audit(corpus.frame(spark, rows)).collect())) == expected(rows)


def test_empty(spark):
    assert da.audit(corpus.frame(spark, [])).count() == 0


def test_runs_meet_dense_columns():
    rng = np.random.default_rng(1)
    for _ in range(200):
        size = int(rng.integers(1, 60))
        dense = [np.sort(rng.integers(0, 4, size)) if rng.random() < 0.5 else rng.integers(0, 3, size) for _ in range(2)]
        columns = []
        for d in dense:
            runs, at = [], 0
            while at < size:
                end = at
                while end < size and d[end] == d[at]:
                    end += 1
                if d[at]:
                    runs.append((at, end - at, int(d[at])))
                at = end
            columns.append(da.column(*map(list, zip(*runs)) if runs else ([], [], []), size, int(d.sum()), size))
        p, q = (np.array([da.share(int(n), int(d.sum()), size) for n in d]) for d in dense)
        assert da.divergence(*columns) == sum((int(a) - int(b)) ** 2 // (int(a) + int(b)) for a, b in zip(p, q))


def test_counts_beyond_64_bits():
    ends, p = da.column([0], [1], [10**12], 2, 10**12, 2)
    assert p.tolist() == [1 + 10**9 * (10**12 + 2) // (10**12 + 4), 1 + 2 * 10**9 // (10**12 + 4)]
