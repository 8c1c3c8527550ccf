"""Language identification with bit-sliced Bloom filters of n-grams.

A table of slots holds a group of bits for each language (bit-sliced: one probe
answers for all languages).  The first bit of a group is a filter of every gram
that the language contains, however rare; the others are filters of the grams
whose share of the language reaches the steps of ``SHARES``.  The AND of a gram's
slots thus gives all languages that contain it, and how usual it is there.  A
document's grams are looked up, the bits are counted per language, each count is
corrected for its filter's false positives, and the largest sum decides: a
gram that all languages contain speaks for the one where it is usual.

Training counts the byte trigrams of every labelled row given, summed inside
each task before anything is shuffled (the result has at most one row per
language and trigram), and the slots are filled by the tasks and united by OR.
Shares are relative, so a language of two short texts is learnt like any other,
and the same rows three times over give the same filter.  A slot takes as many
words as the languages need; its size does not depend on the corpus.

Grams run over the lower-cased bytes, where each run of non-letters is one
blank.  ``lang``, ``source`` and the id are never inputs of a prediction.

Nulls: rows with a null label or null text teach nothing; a null text, or one
without a letter, gets ``und``.  Ties go to the language whose name comes first.
A text of which no gram is known gets the language with most grams.  Without any
labelled row every prediction is ``und``.  Empty tables give no rows.  Very long
texts are read whole.  Extra columns are ignored by ``identify`` and passed
through by ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, frugal, mix64, ship, shuffle_partitions, small_batches, stored, table, utf8

ship(__name__)

UND = "und"
SLOT_BITS, HASHES = 20, 3
#: Least shares of a language's grams for the filters after the first, which takes every gram.
SHARES = tuple(2.0 ** -k for k in (17, 15, 13, 11, 9, 7))
LEVELS = 1 + len(SHARES)

LETTER = np.zeros(256, np.bool_)
LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def trigrams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all rows, and offsets of the rows in them; blanks are squeezed and surround each row."""
    n = len(ends) - 1
    # one blank before and after each row
    size = ends[-1] - ends[0] + 2 * n
    text = np.full(size, 0x20, np.uint8)
    row = np.repeat(np.arange(n), np.diff(ends))
    at = np.arange(ends[-1] - ends[0]) + 2 * row + 1
    part = data[ends[0]:ends[-1]]
    text[at] = np.where(LETTER[part], part, 0x20)
    blank = text == 0x20
    edge = np.zeros(size + 1, np.bool_)
    edge[ends[:-1] - ends[0] + 2 * np.arange(n)] = True  # a row's first blank stays
    keep = ~blank | edge[:-1]
    keep[1:] |= blank[1:] & ~blank[:-1]
    upto = np.concatenate(([0], np.cumsum(keep)))
    cut = upto[ends - ends[0] + 2 * np.arange(n + 1)]
    t = text[keep].astype(np.uint32)
    if len(t) < 3:
        return np.empty(0, np.uint32), np.zeros(n + 1, np.int64)
    grams = t[:-2] | (t[1:-1] << 8) | (t[2:] << 16)
    # a row of k bytes has max(k - 2, 0) grams; those that reach into the next row go
    inside = np.ones(len(t), np.bool_)
    inside[np.maximum(cut[1:] - 1, 0)] = False
    inside[np.maximum(cut[1:] - 2, 0)] = False
    upto = np.concatenate(([0], np.cumsum(inside)))
    return grams[inside[:-2]], upto[cut]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) summed over the task."""
    sums: dict[str, pd.Series] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        data, ends = utf8(batch.column(1))
        for a, b in by_bytes(ends):
            grams, cut = trigrams(data, ends[a:b + 1])
            owner = np.repeat(langs[a:b], np.diff(cut))
            for lang in set(langs[a:b]):
                g, n = np.unique(grams[owner == lang], return_counts=True)
                s = pd.Series(n, index=g)
                sums[lang] = s if lang not in sums else sums[lang].add(s, fill_value=0)
    for lang, s in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(s), pa.string()), pa.array(s.index.to_numpy(), pa.int64()),
                                          pa.array(s.to_numpy().astype(np.int64))], names=["lang", "gram", "n"])


@dataclass
class Filter:
    """languages[i] owns bits i * LEVELS .. (i + 1) * LEVELS - 1 of a slot (a row of 64-bit words);
    ``fill``: share of slots that hold each bit; ``fallback``: the language with most grams."""

    languages: list[str]
    slots: np.ndarray
    fill: np.ndarray
    fallback: str

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """Per gram: the bits of the filters that contain it."""
        out = None
        for p in probes(grams):
            out = self.slots[p] if out is None else out & self.slots[p]
        return out

    def counts(self, grams: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Per text and bit: the grams that have it, corrected for false positives."""
        n_bits = len(self.languages) * LEVELS
        n = np.diff(cut)
        out = np.zeros((len(n), n_bits))
        some = np.flatnonzero(n)
        if len(some):
            found = np.unpackbits(self.containing(grams).view(np.uint8), axis=1, count=n_bits, bitorder="little")
            out[some] = np.add.reduceat(found, cut[some], axis=0, dtype=np.int64)
        wrong = np.minimum(self.fill ** HASHES, 1 - 1e-9)
        return np.maximum(out - n[:, None] * wrong, 0) / (1 - wrong)

    def decide(self, column: pa.Array) -> tuple[list[str], list[float]]:
        data, ends = utf8(column)
        names, scores = [], []
        for a, b in by_bytes(ends, 1 << 17):
            grams, cut = trigrams(data, ends[a:b + 1])
            sums = self.counts(grams, cut).reshape(b - a, len(self.languages), LEVELS).sum(axis=2)
            best, top = sums.argmax(axis=1), sums.max(axis=1)
            share = np.divide(top, sums.sum(axis=1), out=np.zeros(b - a), where=top > 0)
            names += [self.languages[i] if t > 0 else self.fallback for i, t in zip(best, top)]
            scores += np.clip(share, 0, 1).tolist()
        return names, scores


def probes(grams: np.ndarray) -> Iterator[np.ndarray]:
    h = mix64(grams.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for _ in range(HASHES):
        yield (h & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)
        h >>= np.uint64(SLOT_BITS)


def _fill(place: dict[str, int], totals: dict[str, int]):
    """Rows (lang, gram, n) -> the slots they set, united within the task."""
    words = -(-len(place) * LEVELS // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros((1 << SLOT_BITS, words), np.uint64)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            first = np.array([place[x] * LEVELS for x in langs], np.int64)
            share = batch.column(2).to_numpy() / np.array([totals[x] for x in langs], np.float64)
            hit = list(probes(batch.column(1).to_numpy().astype(np.uint64)))
            for level, least in enumerate((0.0, *SHARES)):
                has = share >= least
                bit = first[has] + level
                value = np.uint64(1) << (bit % 64).astype(np.uint64)
                for p in hit:
                    np.bitwise_or.at(slots, (p[has], bit // 64), value)
        slot, word = np.nonzero(slots)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(word.astype(np.int32)),
                                          pa.array(slots[slot, word].view(np.int64))], names=["slot", "word", "bits"])

    return run


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Filter:
    """Fit on every row with a text and a label."""
    small_batches(labelled.sparkSession)
    text_of, lang_of = F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string")
    rows = labelled.where(lang_of.isNotNull() & text_of.isNotNull())
    counts = stored(rows.select(lang_of.alias("lang"), F.lower(text_of).alias("text")).mapInArrow(frugal(_count), "lang string, gram long, n long")
                    .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # a row per language
    names = sorted(totals)
    if not names:
        return Filter([], np.zeros((0, 0), np.uint64), np.zeros(0), UND)
    slots = np.zeros((1 << SLOT_BITS, -(-len(names) * LEVELS // 64)), np.uint64)
    filled = (counts.coalesce(shuffle_partitions(counts.sparkSession))
              .mapInArrow(frugal(_fill({x: i for i, x in enumerate(names)}, totals)), "slot int, word int, bits long")
              .groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")))
    got = filled.toArrow()  # no more rows than the table has words
    slots[got["slot"].to_numpy(), got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    fill = np.array([np.mean((slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(names) * LEVELS)])
    return Filter(names, slots, fill, max(names, key=totals.get))


def predict(spark: SparkSession, model: Filter, text: Column) -> Column:
    """struct(lang, score) of a text."""
    sent = spark.sparkContext.broadcast((model.languages, model.slots, model.fill, model.fallback))

    small_batches(spark)

    @F.arrow_udf("struct<lang: string, score: double>")
    def decide(texts: pa.Array) -> pa.Array:
        names, scores = Filter(*sent.value).decide(texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    no_letter = F.coalesce(~text.rlike(r"\p{L}"), F.lit(True))
    none = F.struct(F.lit(UND).alias("lang"), F.lit(0.0).alias("score"))
    if not model.languages:
        return none
    return F.when(no_letter, none).otherwise(decide(F.lower(text)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id_col, held_out, lang_pred, score; held-out rows teach nothing."""
    model = learn(df.where(~held_out(id_col)), text, lang)
    got = df.select(F.col(f"`{id_col}`"), held_out(id_col).alias("held_out"),
                    predict(df.sparkSession, model, F.col(f"`{text}`").cast("string")).alias("got"))
    return got.select(f"`{id_col}`", "held_out", F.col("got.lang").alias("lang_pred"), F.col("got.score").alias("score"))


def keep_identified(df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` with an identified language; its columns."""
    model = learn(df.where(~held_out(id_col)), text, lang)
    got = predict(df.sparkSession, model, F.col(f"`{text}`").cast("string"))
    return df.where(got["lang"] != UND)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
