"""Language filters against sets of grams; many languages, rare ones, repeated rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from purchlake.llm import language_bits as lb
from purchlake.llm.common import utf8


def grams_of(text):
    return lb.trigrams(*utf8(pa.array([text.lower()])))[0].tolist()


def languages(rng, n):
    """Word makers: each language has letters of its own and shares some words with all."""
    common = ["the", "data", "an", "in"]
    out = {}
    for i in range(n):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 9)
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(60)] + common
        out[f"l{i:03d}"] = words
    return out


def rows_of(rng, words, n, size=40):
    return [(" ".join(rng.choice(w) for _ in range(size)), lang) for lang, w in words.items() for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)


@pytest.mark.parametrize("n", [3, 40])
def test_filter_returns_every_language_that_contains_a_gram(spark, n):
    """40 languages need several words for a slot."""
    rng = random.Random(n)
    rows = rows_of(rng, languages(rng, n), 4)
    model = lb.learn(frame(spark, rows))
    counts = defaultdict(Counter)
    for text, lang in rows:
        counts[lang].update(grams_of(text))
    assert model.languages == sorted(counts) and model.slots.shape[1] == -(-n * lb.LEVELS // 64)
    grams = np.array(sorted(set().union(*counts.values())), np.uint32)
    bits = np.unpackbits(model.containing(grams).view(np.uint8), axis=1, count=n * lb.LEVELS, bitorder="little")
    wrong = 0
    for i, lang in enumerate(model.languages):
        total = sum(counts[lang].values())
        for level, least in enumerate((0.0, *lb.SHARES)):
            want = np.array([g in counts[lang] and counts[lang][g] / total >= least for g in grams.tolist()])
            got = bits[:, i * lb.LEVELS + level].astype(bool)
            assert (got | ~want).all()  # a filter misses nothing
            wrong += int((got & ~want).sum())
    assert wrong <= 0.01 * bits.size


def test_decision_against_sets(spark):
    """Per language: its grams of the text, by the steps their shares reach."""
    rng = random.Random(5)
    words = languages(rng, 6)
    rows = rows_of(rng, words, 5)
    model = lb.learn(frame(spark, rows))
    counts = defaultdict(Counter)
    for text, lang in rows:
        counts[lang].update(grams_of(text))
    asked = [t for t, _ in rows_of(rng, words, 6, 15)] + ["data", "the data in", "zz qq"]
    names, _ = model.decide(pa.array(asked))
    for text, name in zip(asked, names):
        sums = {}
        for lang, c in counts.items():
            total = sum(c.values())
            sums[lang] = sum(1 + sum(c[g] / total >= s for s in lb.SHARES) for g in grams_of(text) if g in c)
        best = max(sums.values())
        if best == 0:
            assert name == model.fallback
        else:
            assert sums[name] >= 0.99 * best


def test_a_language_of_two_short_texts(spark):
    rng = random.Random(2)
    words = languages(rng, 3)
    rare = {"rare": words.pop("l002")}
    rows = rows_of(rng, words, 60) + rows_of(rng, rare, 2, 12)
    model = lb.learn(frame(spark, rows))
    asked = rows_of(rng, rare, 20, 25) + rows_of(rng, words, 20, 25)
    names, _ = model.decide(pa.array([t for t, _ in asked]))
    assert sum(a == b for a, (_, b) in zip(names, asked)) >= 0.95 * len(asked)


def test_repeated_rows_change_nothing(spark):
    rng = random.Random(3)
    rows = rows_of(rng, languages(rng, 3), 3)
    one, three = lb.learn(frame(spark, rows)), lb.learn(frame(spark, rows * 3))
    assert one.languages == three.languages and np.array_equal(one.slots, three.slots) and one.fallback == three.fallback


def test_names_with_dots_and_no_labels(spark):
    df = spark.createDataFrame([(1, "some text", "en"), (2, None, None), (3, "12", "en")], "`doc.id` long, `te.xt` string, `la.ng` string")
    got = {r[0]: r.lang_pred for r in lb.identify(df, "te.xt", "la.ng", "doc.id").collect()}
    assert got[2] == got[3] == "und" and got[1] in ("en", "und")
    nothing = df.withColumn("la.ng", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lb.identify(nothing, "te.xt", "la.ng", "doc.id").collect()} == {"und"}
