"""Spelling variants of words, found by pivotal grams.

Words are letter runs counted over all texts.  Two words are *near* if one
inserted, deleted or replaced code point turns one into the other.  A word's
form is its most frequent near word, if that is far more frequent; forms are
followed to the last one, the root.

Near words by pivotal grams: bigrams are ordered by rarity over the vocabulary.
A word's gram prefix holds its three rarest bigram occurrences (and all that
tie with the third); of these, dynamic programming picks the two disjoint ones
with the least total frequency, its pivots.  One edit spoils at most one of two
disjoint grams, so of two near words the one whose prefix ends earlier in the
order has a pivot that the other holds, within its prefix.  Only pivots are
looked up among prefixes.

Position limits: an edit before a kept gram leaves all from the gram to the
word's end as it was, an edit behind it all from the word's start.  With
pivots p < q, every edit leaves the word's part up to p or its part from q
intact, so lookups are equalities of whole parts (hashed), which hold gram and
position.  Candidates are verified by their edit distance.

A part shared by very many words gives no pair list: where pivots x prefixes of
one part exceed ``MANY``, the part's members are dealt further by the other
part with one code point left out, or whole; near words share such a key, and a
key holds no more words than alphabet x length.

Nulls: a null text has no words; a null doc_id is written as an empty string in
the hash that decides the deletion.  Words of any length are handled: long ones
are left out of the lookup rows and joined again for the check.  Ties follow
the code-point order.  Repeated rows count as often as they occur; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Polynomial, frugal, ship, small_batches, stored, table

ship(__name__)

#: Fixed values of the definition: shortest word, least count, one run in so many loses a code point,
#: how many times more frequent a form is.
SHORTEST, LEAST, LOSSY, RATIO = 7, 2, 31, 10
RUNS = re.compile(f"[A-Za-zÀ-ÿ]{{{SHORTEST},}}")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Entries of a task's tally before they are handed on.
TALLY = 200_000
#: Texts longer than this are read match by match.
LONG_TEXT = 1 << 22
#: Words up to this length travel with their lookup rows.
CARRIED = 64
#: Candidate pairs of one part beyond which its members are dealt further.
MANY = 1 << 14


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())],
                                          names=["word", "n"])

    for batch in batches:
        for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = body.as_py() or ""
            found = Counter(RUNS.findall(text) if len(text) < LONG_TEXT else (m[0] for m in RUNS.finditer(text)))
            start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for run, n in found.items():
                low = run.lower() if run.isascii() else run.translate(LOWER)
                h = zlib.crc32(low.encode(), start)
                if h % LOSSY == 0:
                    at = h % len(low)
                    low = low[:at] + low[at + 1:]
                    if len(low) < SHORTEST:
                        continue
                tally[low] += n
            if len(tally) > TALLY:
                yield out()
                tally.clear()
    yield out()


def count_words(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(word string, n long): the words of all texts, with their occurrences."""
    small_batches(df.sparkSession)
    found = df.select(df[f"`{id_col}`"].cast("long").alias("doc_id"), df[f"`{text}`"].cast("string").alias("text")).mapInArrow(
        frugal(_words), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally: Counter = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            tally.update(map("".join, zip(word, word[1:])))
    yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())],
                                     names=["gram", "n"])


def gram_prefix(word: str, order: dict[str, int]) -> tuple[int, list[int]]:
    """(order of the third rarest bigram occurrence, start of every occurrence up to it)."""
    ranks = [order[word[i:i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[2]
    return last, [i for i, r in enumerate(ranks) if r <= last]


def pivots(word: str, prefix: list[int], weight: dict[str, int]) -> tuple[int, int]:
    """Starts of the two disjoint bigrams of the prefix with the least total weight."""
    best_one: tuple[float, int] = (float("inf"), -1)   # cheapest that ends before the current one
    best_two: tuple[float, int, int] = (float("inf"), -1, -1)
    waiting: list[tuple[float, int]] = []              # may still overlap the current one
    for at in prefix:
        while waiting and waiting[0][1] + 2 <= at:
            best_one = min(best_one, waiting.pop(0))
        w = weight[word[at:at + 2]]
        if best_one[1] >= 0:
            best_two = min(best_two, (best_one[0] + w, best_one[1], at))
        waiting.append((w, at))
    return best_two[1:]


def _part_hashes(word: str, starts: list[int], head: bool) -> list[int]:
    """Hash of the word's part up to the end of the gram at each start (``head``), or from each start."""
    h = hashlib.blake2b(b"h" if head else b"t", digest_size=8)
    out, done = [], 0
    for at in starts if head else reversed(starts):
        upto = at + 2 if head else len(word) - at
        piece = word[done:upto] if head else word[at:len(word) - done][::-1]
        h.update(piece.encode())
        done = upto
        out.append(int.from_bytes(h.copy().digest(), "little", signed=True))
    return out if head else out[::-1]


LOOKUPS = "id long, pivot boolean, head boolean, part long, at int, ord int, len int, word string"


def _lookups(order: dict[str, int], weight: dict[str, int]):
    types = (pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    names = [f.split()[0] for f in LOOKUPS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for word, ident in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                last, prefix = gram_prefix(word, order)
                p, q = pivots(word, prefix, weight)
                carried = word if len(word) <= CARRIED else None
                for head in (True, False):
                    for at, part in zip(prefix, _part_hashes(word, prefix, head)):
                        rows.append((ident, False, head, part, at, last, len(word), carried))
                        if at == (p if head else q):
                            rows.append((ident, True, head, part, at, last, len(word), carried))
                        if len(rows) > 50_000:
                            yield _batch(rows, types, names)
                            rows = []
        yield _batch(rows, types, names)

    return run


def _batch(rows: list[tuple], types, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def shortened(text: str) -> np.ndarray:
    """Hashes of the text with each code point left out, and of the whole text (last)."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(codes)
    whole = Polynomial(codes)
    behind = whole.sums[n] - whole.sums[1:]              # what follows place i, at its own powers
    one_down = whole.down[1] if n else np.uint64(0)
    out = np.empty(n + 1, np.uint64)
    out[:n] = whole.sums[:n] + behind * one_down
    out[n] = whole.sums[n]
    return out.view(np.int64)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(.., head, at, whole) -> (.., rest): one row for each key of the word's other part."""
    for batch in batches:
        columns = batch.schema.names
        head, at, whole = (batch.column(columns.index(c)).to_pylist() for c in ("head", "at", "whole"))
        rest = [np.unique(shortened(w[a + 2:] if h else w[:a])) for h, a, w in zip(head, at, whole)]
        counts = np.fromiter(map(len, rest), np.int64, len(rest))
        slim = batch.drop_columns(["whole"])
        taken = slim.take(pa.array(np.repeat(np.arange(len(rest)), counts)))
        values = np.concatenate(rest) if rest else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(values, pa.int64())], names=[*slim.schema.names, "rest"])


def _meet(lookups: DataFrame, on: list[str]) -> DataFrame:
    """Candidates (a, b, sure): pivots among the prefixes; short words are verified at once."""
    columns = ["id", "ord", "len", "word"]
    mine = lookups.where("pivot").select(*on, *[F.col(c).alias(f"a_{c}") for c in columns])
    theirs = lookups.where("not pivot").select(*on, *[F.col(c).alias(f"b_{c}") for c in columns])
    near = F.levenshtein("a_word", "b_word", 1)
    return (mine.join(theirs, on)
            .where((F.abs(F.col("a_len") - F.col("b_len")) <= 1)
                   & ((F.col("a_ord") < F.col("b_ord")) | ((F.col("a_ord") == F.col("b_ord")) & (F.col("a_id") < F.col("b_id"))))
                   & (near.isNull() | (near == 1)))
            .select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"), near.isNotNull().alias("sure")))


def near_words(words: DataFrame) -> DataFrame:
    """(a long, b long): pairs a < b of ids of near words; ``words``: stored (word, id, ..), words distinct."""
    small_batches(words.sparkSession)
    # letters of the words: a-z and the 64 from U+00C0 on, so there are at most 90 * 90 bigrams
    counts = {r.gram: r.n for r in words.select("word").mapInArrow(frugal(_grams), "gram string, n long")
              .groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    order = {g: i for i, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0])))}
    lookups = stored(words.select("word", "id").mapInArrow(frugal(_lookups(order, counts)), LOOKUPS), "gram-lookups")
    sizes = lookups.groupBy("part").agg(F.count_if("pivot").alias("p"), F.count_if(~F.col("pivot")).alias("q"))
    hot = stored(sizes.where(F.col("p") * F.col("q") > MANY).select("part"), "hot-parts")
    plain = _meet(lookups.join(hot, "part", "left_anti"), ["part"])
    members = (lookups.join(hot, "part", "left_semi")
               .join(words.select("id", F.col("word").alias("whole")), "id")
               .select(*[f.split()[0] for f in LOOKUPS.split(", ")], "whole"))
    dealt = _meet(members.mapInArrow(frugal(_deal), LOOKUPS + ", rest long"), ["part", "rest"])
    found = stored(plain.unionAll(dealt).groupBy("a", "b").agg(F.max("sure").alias("sure")), "near-words")
    text = words.select("id", "word")
    open_ = (found.where("not sure").join(text.toDF("a", "a_word"), "a").join(text.toDF("b", "b_word"), "b")
             .where(F.levenshtein("a_word", "b_word", 1) == 1))
    return found.where("sure").select("a", "b").unionAll(open_.select("a", "b"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root): where following ``forms`` (id, form) ends.  Each round doubles the steps taken; a form
    is ten times as frequent as its word, so a chain of counts below 2^63 has at most 18 steps."""
    reached = stored(forms.toDF("id", "root"), "roots")
    while True:
        ahead = reached.select(F.col("id").alias("root"), F.col("root").alias("next"))
        further = stored(reached.join(ahead, "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if further.where("moved").isEmpty():
            return further.select("id", "root")
        reached = further.select("id", "root")


def group_variants(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(word, form, root string; n, n_near, form_n long) for every word of the texts."""
    words = stored(count_words(df, text, id_col).withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = stored(near_words(words), "near-pairs")
    both = pairs.unionAll(pairs.select("b", "a"))
    near = (both.join(words.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n")), "b")
            .groupBy("a").agg(F.count("*").alias("n_near"),
                              F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"),
                                             F.col("b").alias("id"))).alias("best")))
    judged = stored(words.join(near, words.id == near.a, "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.n") >= RATIO * F.col("n"), F.col("best")).alias("best")), "judged-words")
    ends = roots(judged.where("best is not null").select("id", F.col("best.id").alias("form")))
    named = ends.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return judged.join(named, "id", "left").select(
        "word", F.col("best.word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near",
        (-F.col("best.n")).alias("form_n"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"))


_UP, _LOW = string.ascii_uppercase, string.ascii_lowercase
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
found AS (
  SELECT doc_id, translate(run, '{_UP}', '{_LOW}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
tallied AS (
  SELECT run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM found
  WHERE length(run) >= {SHORTEST} GROUP BY doc_id, run),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(s, ''), lambda c:
    CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END)) AS b FROM tallied),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x:
    xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM bytes, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % {LOSSY} = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {LEAST}),
short AS (
  SELECT word, i, word[:i] || word[i + 2:] AS v FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word AS a, y.word AS b FROM short x JOIN short y ON x.v = y.v AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word FROM short x JOIN words y ON x.v = y.word
  UNION SELECT y.word, x.word FROM short x JOIN words y ON x.v = y.word),
best AS (
  SELECT a, count(*) AS n_near, min((-n, b)) AS top FROM near JOIN words ON word = b GROUP BY a),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top[1] >= {RATIO} * w.n THEN top[2] END AS form, CASE WHEN -top[1] >= {RATIO} * w.n THEN -top[1] END AS form_n
  FROM words w LEFT JOIN best ON a = word),
walk AS (
  SELECT word, word AS at FROM forms
  UNION SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)
"""
