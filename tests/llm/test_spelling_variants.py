"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

import corpus
from purchlake.llm import spelling_variants as sv


def words_of(rows):
    n = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(corpus.LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 31 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            n[low] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def expected(rows):
    n = words_of(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def text_rows(seed):
    """Families of near words of very different frequency, runs of one letter, accents, long words."""
    rng = random.Random(seed)
    bases = ["elephant", "committee", "aaaaaaaa", "bananas", "çédillé", "abababab", "zzzzzzzzzzzz", "Straßenbahn"]
    pool = []
    for b in bases:
        pool += [b] * 300
        for _ in range(40):
            k = rng.randrange(len(b))
            c = rng.choice("aeébzq")
            v = rng.choice([b[:k] + c + b[k + 1:], b[:k] + b[k + 1:], b[:k] + c + b[k:]])
            pool += [v] * rng.choice([1, 2, 3, 30])
    pool += ["q" * 90 + x for x in ("", "q", "qq", "r", "rq")] * 2 + ["mnop" * 40 + x for x in ("", "a", "b")] * 3
    rng.shuffle(pool)
    rows = [(i, " ".join(pool[i * 20:(i + 1) * 20]), "en", "s", 1) for i in range(-(-len(pool) // 20))]
    return rows + [(None, "elephant elephants", "en", "s", 1), (3, None, None, None, None), (4, "", "en", "s", 0), rows[0], rows[0]]


@pytest.mark.parametrize("many", [sv.MANY, 1])
def test_against_all_pairs(spark, monkeypatch, many):
    """Also with every part dealt further."""
    monkeypatch.setattr(sv, "MANY", many)
    rows = text_rows(3)
    got = sv.group_variants(corpus.frame(spark, rows, clashing=True).repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(map(tuple, got.collect())) == Counter(expected(rows))


def test_hostile_corpus_and_small_tallies(spark, monkeypatch):
    monkeypatch.setattr(sv, "LONG_TEXT", 50)
    rows = corpus.corpus() * 2
    assert set(map(tuple, sv.group_variants(corpus.frame(spark, rows)).collect())) == expected(rows)


def test_chain_of_forms(spark):
    """Each ten times rarer than the next, which differs in one place more."""
    chain = ["bcdfghjk", "bcdfghjx", "bcdfghyx", "bcdfgzyx"]
    rows = [(i, w, "en", "s", 1) for i, w in enumerate(w for k, w in enumerate(chain) for _ in range(3 * 11 ** k))]
    got = {r.word: r.root for r in sv.group_variants(corpus.frame(spark, rows)).collect() if r.word in chain}
    assert got == dict.fromkeys(chain, chain[-1])


def test_prefix_and_pivots():
    rng = random.Random(5)
    for _ in range(2000):
        word = "".join(rng.choice("abcde") for _ in range(rng.randrange(7, 15)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)})
        weight = {g: rng.randrange(1, 9) for g in grams}
        order = {g: i for i, g in enumerate(sorted(grams, key=lambda g: (weight[g], g)))}
        last, prefix = sv.gram_prefix(word, order)
        assert len(prefix) >= 3 and all((order[word[i:i + 2]] <= last) == (i in prefix) for i in range(len(word) - 1))
        p, q = sv.pivots(word, prefix, weight)
        assert p in prefix and q in prefix and q - p >= 2
        assert weight[word[p:p + 2]] + weight[word[q:q + 2]] == min(
            weight[word[i:i + 2]] + weight[word[j:j + 2]] for i in prefix for j in prefix if j - i >= 2)


def test_empty(spark):
    assert sv.group_variants(corpus.frame(spark, [])).count() == 0
    assert sv.group_variants(corpus.frame(spark, [(1, None, "en", "s", None), (2, "short words only", "en", "s", 1)])).count() == 0
