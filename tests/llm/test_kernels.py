"""The operators' inner parts against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus
from purchlake.llm import (components, genetic_packing, language_bits, license_rules, ngram_join, pii_anchors, reshard,
                           small_world, suffix_dedup, temperature_mixing)
from purchlake.llm.common import BASE, Polynomial, by_bytes, utf8


@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=20), st.integers(1, 60))
def test_by_bytes_covers_every_row_once(texts, limit):
    data, ends = utf8(pa.array(texts, pa.string()))
    got = list(by_bytes(ends, limit))
    assert [i for a, b in got for i in range(a, b)] == list(range(len(texts)))
    assert [data[ends[i]:ends[i + 1]].tobytes() for i in range(len(texts))] == [(t or "").encode() for t in texts]


@given(st.binary(min_size=1, max_size=200), st.data())
def test_polynomial_is_free_of_place(body, data):
    p = Polynomial(np.frombuffer(body * 2, np.uint8))
    a = data.draw(st.integers(0, len(body)))
    b = data.draw(st.integers(a, len(body)))
    n = len(body)
    assert p.of(np.array([a]), np.array([b])) == p.of(np.array([a + n]), np.array([b + n]))
    want = sum((x + 1) * pow(BASE, i, 1 << 64) for i, x in enumerate(body[a:b])) % (1 << 64)
    assert int(p.of(np.array([a]), np.array([b]))[0]) == want


TEXTS = st.lists(st.text(alphabet="abAB \t\né.", max_size=60), max_size=12)


@given(TEXTS)
def test_shingle_sets_match_python(texts):
    data, ends = utf8(pa.array(texts, pa.string()))
    if len(texts) == 0:
        return
    h, cut = ngram_join.shingle_sets(data, ends)
    sets = [corpus.shingles(t) for t in texts]
    assert np.diff(cut).tolist() == [len(s) for s in sets]
    hashed = [frozenset(h[a:b].tolist()) for a, b in zip(cut[:-1], cut[1:])]
    for i in range(len(texts)):
        for j in range(i):
            assert len(hashed[i] & hashed[j]) == len(sets[i] & sets[j])


@given(TEXTS)
def test_word_counts_match_python(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["a", "b"])
    got = [r for b in license_rules._scan(iter([batch])) for r in b.column(1).to_pylist()]
    assert got == [len(license_rules.WORDS.findall(t.encode().lower())) for t in texts]


@given(st.lists(st.text(alphabet="abé. 1", max_size=12), min_size=1, max_size=8))
def test_trigrams_stay_within_rows(texts):
    data, ends = utf8(pa.array(texts, pa.string()))
    grams, cut = language_bits.trigrams(data, ends)
    for i, t in enumerate(texts):
        b = bytes(x if language_bits.LETTER[x] else 32 for x in t.encode())
        b = b" " + b" ".join(b.split()) + b" "
        want = [b[k] | b[k + 1] << 8 | b[k + 2] << 16 for k in range(len(b) - 2)] if b.strip() else []
        assert grams[cut[i]:cut[i + 1]].tolist() == want


def test_filter_corrects_false_positives():
    """A filter filled by chance (all of one language's bits in nine tenths of the slots) against one that holds the text."""
    text = "some words of a language that only the second filter holds, in a longer text than that " * 3
    levels = language_bits.LEVELS
    both = np.uint64((1 << levels) - 1)
    slots = np.where(np.random.default_rng(1).random(1 << language_bits.SLOT_BITS) < 0.9, both, np.uint64(0))[:, None]
    data, ends = utf8(pa.array([text]))
    for p in language_bits.probes(language_bits.trigrams(data, ends)[0]):
        slots[p] |= both << np.uint64(levels)
    fill = np.array([np.mean((slots >> np.uint64(i)) & np.uint64(1)) for i in range(2 * levels)])
    raw = language_bits.Filter(["chance", "real"], slots, np.zeros(2 * levels), "real").decide(pa.array([text]))
    names, scores = language_bits.Filter(["chance", "real"], slots, fill, "real").decide(pa.array([text]))
    assert names == ["real"] and scores[0] > 0.8 > raw[1][0]


@settings(deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.integers(0, 5))
def test_islands_pack_validly(lengths, seed):
    size = np.array(lengths, np.int32)
    found = genetic_packing.evolve(size, [], 100, 3, np.random.default_rng(seed))
    for bins in found:
        assert np.bincount(bins, size).max() <= 100
        assert set(bins.tolist()) == set(range(bins.max() + 1))
    first = genetic_packing.best_fit(size, np.argsort(-size, kind="stable"), 100)
    assert found[0].max() <= first.max()


def test_evolution_improves_best_fit():
    """Best fit takes 42,40 | 40,37 | ... here; evolution finds whole bins."""
    size = np.array([44, 24, 24, 22, 21, 17, 8, 8, 6, 6] * 6, np.int32)
    bfd = genetic_packing.best_fit(size, np.argsort(-size, kind="stable"), 61).max() + 1
    rng = np.random.default_rng(1)
    pop = []
    for _ in range(12):
        pop = genetic_packing.evolve(size, pop, 61, 6, rng)
    assert pop[0].max() + 1 <= bfd
    assert pop[0].max() + 1 >= -(-int(size.sum()) // 61)


def test_crossover_keeps_each_piece_once():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 100, 300).astype(np.int32)
    a, b = (genetic_packing.best_fit(size, rng.permutation(300), 100) for _ in range(2))
    child = genetic_packing.crossover(a, b, size, 100, rng)
    assert len(child) == 300 and np.bincount(child, size).max() <= 100


def test_ids_of_parts_are_ids_of_the_text(monkeypatch):
    rng = random.Random(8)
    texts = [r[1] or "" for r in corpus.corpus()] + ["a  b\n\n c \u00a0x<|endoftext|> y", "  <|endoftext|>\t\tz ", "\x1c a\x85b"]
    texts += ["".join(rng.choice("ab é\u00a0\n\t.,'s1 日ǆ\u2003\u200b") for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += ["x" * 3000, "".join(rng.choice("ABCDabcd0123+/") for _ in range(5000)), " don't we'll I'd  've ''s !!'re"]
    for block in (genetic_packing.BLOCK_CHARS, 50):
        monkeypatch.setattr(genetic_packing, "BLOCK_CHARS", block)
        monkeypatch.setattr(genetic_packing, "REMEMBERED", 10 * block)
        ids = genetic_packing.Ids(genetic_packing.tokenizer_path())
        got = list(genetic_packing.coded_texts(ids, iter(texts)))
        assert len(got) == len(texts)
        for t, coded in zip(texts, got):
            assert coded == np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert list(genetic_packing.coded_texts(ids, iter([]))) == []


def test_latin_texts_are_encoded_whole():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab's \t\n\r\x1c\x85\u00a0\u00e9\u00b2\u00bd\u00aa_1.<|>A") for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += ["a" * 20000, " " * 20000, " " * 20000 + "x", "\n" * 5000 + "x ", "\x1c" * 5000, "1" * 5000, "", " "]
    ids = genetic_packing.Ids(genetic_packing.tokenizer_path())
    got = ids.of(texts)
    assert not ids.known  # no text was cut into parts
    mixed = ids.of(["a b", "\u65e5 a", "<|endoftext|> a", "c"])
    for t, coded in zip([*texts, "a b", "\u65e5 a", "<|endoftext|> a", "c"], [*got, *mixed]):
        assert coded == ids.alone(t)
    assert ids.known


def test_every_token_is_made_by_its_listed_merge():
    """What by_rank rests on: the listed merges, run over a token's own bytes, give that token."""
    import json
    with open(genetic_packing.tokenizer_path(), encoding="utf-8") as f:
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in json.load(f)["model"]["merges"]]
    order = {m: i for i, m in enumerate(merges)}
    for a, b in merges:
        parts = list(a + b)
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: order.get((parts[i], parts[i + 1]), 1 << 40))
            assert (parts[at], parts[at + 1]) in order
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                assert tuple(parts) == (a, b)


def _moved_bytes(sizes, moves, n_new):
    total = 0
    for old, rows in sizes.items():
        out = sum(k for (i, j), k in moves.items() if i == old and j != old)
        total += sum(sorted(rows)[:out])
    return total


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.integers(0, 5), st.lists(st.integers(1, 40), min_size=1, max_size=9), min_size=1, max_size=5),
       st.integers(1, 5))
def test_flow_fills_shards_and_moves_least(sizes, n_new):
    blocks = [(i, k, 1, s) for i, rows in sizes.items() for k, s in enumerate(rows)]  # a block for each row: exact costs
    moves = reshard.plan_rows(blocks, n_new)
    total = sum(map(len, sizes.values()))
    got = [sum(k for (i, j), k in moves.items() if j == new) for new in range(n_new)]
    assert sum(got) == total and max(got) - min(got) <= 1
    for i, rows in sizes.items():
        assert sum(k for (a, _), k in moves.items() if a == i) == len(rows)
    # brute force over who gets the spare rows
    import itertools
    base, spare = divmod(total, n_new)
    best = min(sum(sum(sorted(rows)[:max(0, len(rows) - (base + (i in extra)) if i < n_new else len(rows))])
                   for i, rows in sizes.items())
               for extra in itertools.combinations(range(n_new), spare))
    assert _moved_bytes(sizes, moves, n_new) == best


@given(st.dictionaries(st.text(min_size=1, max_size=3), st.integers(1, 10**6), min_size=1, max_size=8), st.floats(1.01, 50))
def test_exponent_meets_the_repetition_limit(tokens, limit):
    x = temperature_mixing.find_exponent(tokens, limit)
    worst = max(temperature_mixing.repeats(tokens, temperature_mixing.weights(tokens, x)).values())
    ratio = max(tokens.values()) / min(tokens.values())
    assert worst <= limit * (1 + 1e-6)
    if ratio > limit:  # closed form
        assert x == pytest.approx(1 - np.log(limit) / np.log(ratio), abs=1e-6)
    else:
        assert x == 0


def test_exponent_meets_the_entropy():
    tokens = {"a": 1000, "b": 100, "c": 10}
    x = temperature_mixing.find_exponent(tokens, None, target_entropy=0.9)
    assert temperature_mixing.entropy(temperature_mixing.weights(tokens, x)) == pytest.approx(0.9)


@settings(deadline=None)
@given(st.lists(st.binary(min_size=4, max_size=4), min_size=1, max_size=40), st.integers(1, 4))
def test_suffix_merge_sort(pieces, groups):
    text = np.frombuffer(b"".join(pieces) + b"\0" * 4, np.uint8).astype(np.uint16)
    suffixes = suffix_dedup.Suffixes(text, 4)
    at = np.arange(len(pieces)) * 4
    cuts = np.linspace(0, len(pieces), groups + 1).astype(int)
    size = np.diff(cuts)
    first = np.repeat(cuts[:-1], size)
    got = suffixes.sort(at, first, np.repeat(size, size))
    for a, b in zip(cuts[:-1], cuts[1:]):
        assert [pieces[i // 4] for i in got[a:b]] == sorted(pieces[a:b])
        assert sorted(got[a:b].tolist()) == at[a:b].tolist()
    x, y = at[:-1], at[1:]
    want = [next((k for k in range(4) if p[k] != q[k]), 4) for p, q in zip(pieces, pieces[1:])]
    assert suffixes.common(x, y).tolist() == want


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 10**6))
def test_equal_windows_share_core_and_offset(seed):
    rng = random.Random(seed)
    passage = bytes(rng.randrange(97, 100) for _ in range(260))
    body = bytes(rng.randrange(97, 123) for _ in range(150)) + passage + bytes(rng.randrange(97, 123) for _ in range(150))
    other = passage + bytes(rng.randrange(97, 123) for _ in range(40))
    data = np.frombuffer(body + other, np.uint8)
    c = suffix_dedup.cells(data, np.array([0, len(body), len(data)]))
    core = {}
    for f, l, o, s, h in zip(c["first"], c["last"], c["offset"], c["seg"], c["core"]):
        for w in range(f, l + 1):
            core[int(w)] = (int(h), int(o) - (w - f))
    for k in range(61):
        assert core[150 + k] == core[len(body) + k]
    windows = {w for s, e in ((0, len(body)), (len(body), len(data))) for w in range(s, e - 199)}
    assert set(core) == windows


@given(st.text(alphabet="ab@.+- 0123456789()x:/%", max_size=80))
def test_base_spans_match_the_patterns(text):
    import re
    rules = ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and _luhn(re.sub("[^0-9]", "", m))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15))
    want = sorted((m.start(), m.end(), k) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m[0]))
    got = [s for s in pii_anchors.spans(text, pii_anchors.automaton()) if s[2] < 4]
    assert sorted(got) == want


def _luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_method_spans():
    text = "IBAN: DE89 3704 0044 0532 0130 00, iban GB00 0000 0000, ftp://bob:pw1@host.example/x account no. 1234567890 ssn 123-45-6789"
    got = {(pii_anchors.KINDS[k], text[a:b]) for a, b, k in pii_anchors.spans(text, pii_anchors.automaton())}
    assert {("iban", "DE89 3704 0044 0532 0130 00"), ("login", "bob:pw1"), ("account", "1234567890"), ("account", "123-45-6789")} <= got
    assert not any(k == "iban" and s.startswith("GB") for k, s in got)


@pytest.mark.parametrize("text, labels", [
    ("under the Apache License, Version 2.0", "apache,apache-2.0"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
    ("GNU GPL", "gpl"),
    ("cc-by-sa 4.0", "cc-by,cc-by-sa-4.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("mit license mit license", "mit"),
    ("accident by chance", ""),
])
def test_labels(text, labels):
    got = license_rules.scan(text.encode().lower(), license_rules.rules())
    assert got[4] == labels


def test_cues_pass_every_rule():
    """The prefilter lets through whatever a rule or base phrase can match."""
    assert len(license_rules.rules()) >= 200
    for words in [*license_rules.BASE, *(s for _, s in license_rules.SENTENCES),
                  *(n for names, _, _ in license_rules.FAMILIES.values() for n in names)]:
        for text in (words, f"x {words} y", words.replace(" ", "-"), f"({words})"):
            assert license_rules.CUES.search(text.encode()), words


def test_contained_detections_are_suppressed():
    ordered = license_rules.rules()
    got = license_rules.scan(b"the gnu affero general public license version 3 applies", ordered)
    assert got[4] == "agpl-3"  # neither agpl nor the gpl inside it


def test_union_find():
    parent = {}
    for a, b in ((5, 3), (3, 9), (1, 9), (7, 8)):
        components.join(parent, a, b)
    assert {x: components.find(parent, x) for x in (1, 3, 5, 7, 8, 9)} == {1: 1, 3: 1, 5: 1, 9: 1, 7: 7, 8: 7}


def test_small_world_finds_links():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    raw = np.concatenate([rng.normal(size=(600, 16)), np.repeat(centres, 12, 0) + 0.02 * rng.normal(size=(480, 16)),
                          np.ones((90, 16)) + 0.01 * rng.normal(size=(90, 16))])
    x = small_world.unit(raw)
    world = small_world.SmallWorld.build(x.astype(np.float32), 1)
    beam, recall = small_world.audited_beam(world, x, 1)
    assert recall >= small_world.AUDIT_RECALL
    again = small_world.SmallWorld.load(x.astype(np.float32), world.dump())
    true = x @ x.T >= small_world.COSINE
    found = np.zeros_like(true)
    for q, k in again.near(x.astype(np.float32), beam, small_world.COSINE - small_world.SLACK):
        found[q, k] = True
    assert (found & true).sum() >= 0.99 * true.sum()


def test_crc_is_of_little_endian_ids():
    ids = genetic_packing.Ids(genetic_packing.tokenizer_path())
    coded, = ids.of(["a b"])
    assert zlib.crc32(coded) == zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids.tokenizer.encode("a b").ids))


@settings(deadline=None, max_examples=300)
@given(st.integers(4, 60), st.integers(0, 10**6))
def test_prefix_bound_keeps_linked_sets(n, seed):
    """Shared prefix shingles plus what lies behind the prefixes is never less than the overlap needed."""
    rng = random.Random(seed)
    base = [rng.random() for _ in range(n)]
    sets = [set(base), set(base)]
    for s in sets:
        s -= set(rng.sample(base, rng.randrange(n // 5 + 1)))
        s |= {rng.random() for _ in range(rng.randrange(n // 6 + 1))}
    a, b = sets
    if a and b and 100 * len(a & b) >= 75 * len(a | b):
        shared = set.intersection(*(set(sorted(s)[:len(s) - ngram_join.least(len(s)) + 1]) for s in sets))
        assert len(shared) + ngram_join.least(max(len(a), len(b))) - 1 >= 75 * (len(a) + len(b)) / 175


def test_windows_of_a_hot_passage_meet_nowhere_as_a_whole():
    """A passage in many surroundings: its borders share cores, but no bucket gets more than its part."""
    import random
    rng = random.Random(17)
    passage = corpus.sentence(rng, 60)
    texts = [corpus.sentence(rng, 30) + passage + corpus.sentence(rng, 30) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["key", "text"])
    cells = [b for b in suffix_dedup._deal(64)([batch])]
    least = Counter()
    for row in (row for b in cells for row in b.to_pylist() if row["key"] is None):
        least.update((row["bucket"], int(low)) for low in suffix_dedup.unpacked(row["blob"])["low"])
    assert max(least.values()) < suffix_dedup.HOT
    blobs = [[] for _ in texts]
    for b in suffix_dedup._settle(pa.Table.from_batches(cells).sort_by("bucket").to_batches()):
        for row in b.to_pylist():
            blobs[row["key"]] += [row["open"]] if row["open"] else []
    batch = batch.append_column("open", pa.array(blobs, pa.list_(pa.binary())))
    dealt, cores, found = Counter(), Counter(), []
    for out in suffix_dedup._open(64)([batch]):
        for row in (row for row in out.to_pylist() if row["key"] is None):
            got = np.frombuffer(row["blob"], suffix_dedup.PIECE)
            dealt[row["bucket"]] += len(got)
            cores.update(got["meet"].tolist())
            found += [(w["meet"], w["check"], w["lead"], w["count"], w["left"].tobytes(), w["right"].tobytes()) for w in got]
    assert len(set(found)) == len(found)  # equal ones of a task go on once
    assert max(cores.values()) > len(texts)  # one core, many surroundings
    assert max(dealt.values()) < 1.5 * sum(dealt.values()) / 64


@pytest.mark.parametrize("hot", [1, 2, 8])
def test_hot_cores_lose_no_repeat(hot, monkeypatch):
    """Two tasks, of which one knows that cores are shared; documents of the other that begin or end as they do."""
    import random
    rng = random.Random(18)
    passage = corpus.sentence(rng, 60)
    texts = [corpus.sentence(rng, 30) + passage + corpus.sentence(rng, 30) for _ in range(12)]
    texts += [texts[3][100:] + "x", "y" + texts[4][:-90], passage + "z", corpus.sentence(rng, 70), texts[5]]
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    found, unsure = {}, {}

    def take(batches):
        for out in batches:
            for row in out.to_pylist():
                for into, blob in ((found, row["runs"]), (unsure, row["open"])):
                    if blob is not None:
                        into.setdefault(row["key"], []).append(blob)

    def by_bucket(tasks):
        rows = [pa.Table.from_batches([b]) for task in tasks for b in task]
        return pa.concat_tables(rows).sort_by("bucket").to_batches() if rows else []

    def batch(i, j):
        return pa.RecordBatch.from_arrays([pa.array(range(i, j), pa.int64()), pa.array(texts[i:j])], names=["key", "text"])

    take(suffix_dedup._settle(by_bucket(suffix_dedup._deal(4)([batch(i, j)]) for i, j in ((0, 12), (12, len(texts))))))
    docs = [pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([texts[k]]), pa.array([b], pa.list_(pa.binary()))],
                                       names=["key", "text", "open"]) for k, b in unsure.items()]
    take(suffix_dedup._sort(by_bucket(suffix_dedup._open(4)([d]) for d in docs)))
    for k, (body, gone) in enumerate(corpus.repeated_bytes(texts)):
        got = bytearray(len(body))
        for blob in found.get(k, []):
            for run in np.frombuffer(blob, suffix_dedup.RUN):
                a, n = int(run["start"]), int(run["count"])
                got[a:a + n + 199] = b"\1" * (n + 199)
        assert got == gone


def test_addresses_with_long_runs_of_zeros():
    anchors = pii_anchors.automaton()
    for zeros in (1, 5000):
        text = "x " + "0" * zeros + ".1.2.3 y"
        assert (2, len(text) - 2, pii_anchors.KINDS.index("ip")) in pii_anchors.spans(text, anchors)
        text = "x 1.2.3." + "0" * zeros + "256 y"
        assert not [s for s in pii_anchors.spans(text, anchors) if pii_anchors.KINDS[s[2]] == "ip"]


@pytest.mark.parametrize("sep", ["_", "__", " _", "-", ".", "\u2003_"])
def test_cues_pass_every_rule_with_any_separator(sep):
    """A word ends at everything but letters and digits, the underscore included."""
    ordered = license_rules.rules()
    texts = [name for names, _, _ in license_rules.FAMILIES.values() for name in names]
    texts += [f"{name} {v}" for names, versions, _ in license_rules.FAMILIES.values() for name in names for v in versions]
    texts += [words for _, words in license_rules.SENTENCES] + list(license_rules.BASE)
    texts += [f"spdx license identifier {spdx}" for _, _, spdx in license_rules.FAMILIES.values()]
    for words in texts:
        for a in ("", sep):
            for b in ("", sep):
                text = (a + words.replace(" ", sep).replace(".", sep) + b).encode()
                assert license_rules.CUES.search(text) or not license_rules.scan(text, ordered)[4], text
