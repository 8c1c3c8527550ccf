"""A small hostile corpus, and brute-force versions of the operators."""

import random
import re
import string
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORDS = [a + b for a in ("ba", "ke", "lo", "mi", "nu", "ra", "se", "to") for b in ("n", "rt", "ss", "ve", "mp", "dal")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


def corpus(seed=7):
    """(doc_id, text, lang, source, n_chars) rows: copies, near copies, shared passages, periodic text,
    null and empty and long texts, null ids and sources, repeated rows."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    original = sentence(rng, 120)
    texts = [sentence(rng, rng.randrange(1, 90)) for _ in range(40)]
    texts += [original] * 6 + [original.replace(" ", " \t\n")] + [original + " "]
    texts += [edited(rng, original, rng.randrange(1, 4)) for _ in range(40)]
    texts += [sentence(rng, 15) + " " + passage + " " + sentence(rng, 15) for _ in range(8)]
    texts += ["ab" * 400, "a" * 650, "xyz" * 300 + "q" + "xyz" * 300, "é" * 300, passage + passage]
    texts += ["", " ", "\t\r\n", "a", "A b C", "a B c", "one two three four", "one two three four five",
              "12 34 !!", "日本語 テキスト", None, None, sentence(rng, 9000), "GNU General-Public  License; MIT license",
              "mail bob@example.org or 10.0.0.1", None, ""]
    rows = [(i * 3, t, ("en", "fr", None)[i % 3], ("hot" if i % 3 else f"s{i % 4}") if i % 11 else None,
             None if t is None else len(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [rows[5], rows[5], (None, "no id here at all, and nothing else", "en", "hot", 1), (None, None, None, None, None)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHES = ("id", "key", "row", "norm", "head", "len", "hash", "pid", "edge", "block", "epoch", "turn", "tokens",
           "label", "cls", "grp", "n", "shard", "rank", "size", "old", "part", "at", "got", "runs", "open", "v")


def frame(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(c).alias(c) for c in CLASHES])
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def blanks(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def jaccard_components(rows):
    """Row index -> index of a root, over all pairs."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))], sets


def repeated_bytes(texts, span=200):
    """Per text: which bytes lie in a string of ``span`` bytes that starts elsewhere too."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[k:k + span] for b in bodies for k in range(len(b) - span + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if seen[b[k:k + span]] > 1:
                gone[k:k + span] = b"\1" * span
        out.append((b, gone))
    return out


def check_packing(got, texts):
    """Pieces against the tokenizer, gapless places; (sequences used, the least their tokens need)."""
    import numpy as np
    from purchlake.llm import genetic_packing
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(genetic_packing.tokenizer_path())
    want = Counter()
    for doc, text in texts:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for seq in places.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places), -(-sum(r.length for r in got) // 2048)
