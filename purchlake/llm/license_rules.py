"""License scan by ordered signature rules.

A text becomes a sequence of lower-case words.  A keyword prefilter (one
regular expression over the bytes) passes over texts without any cue; of the
rest, each rule is tried only if all its keywords are among the words.  Rules
carry a priority; of overlapping detections, one whose interval lies within
an accepted detection of higher priority is suppressed.

The rules are regular expressions over the words joined by single blanks.
They are made from a table of licence families (names, versions, identifiers)
and a few hand-written sentence frames, which gives some four hundred.

Base phrases are counted at every place, and their labels always stay.

Nulls: a null text counts as empty and has no words.  Empty and very long
texts, repeated rows and empty tables need no special care: rows are
independent.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import by_bytes, ship, small_batches, table, utf8

ship(__name__)

#: Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Licence families as label: (names, versions, identifier words).
FAMILIES = {
    "agpl": (("gnu affero general public license", "affero general public license", "agpl"), ("1", "3"), "agpl"),
    "lgpl": (("gnu lesser general public license", "lesser general public license", "gnu library general public license",
              "library general public license", "lgpl"), ("2", "2.1", "3"), "lgpl"),
    "gpl": (("gnu general public license", "general public license", "gnu gpl", "gpl"), ("1", "2", "3"), "gpl"),
    "gfdl": (("gnu free documentation license", "free documentation license", "gfdl"), ("1.1", "1.2", "1.3"), "gfdl"),
    "apache": (("apache license", "apache software license", "asl"), ("1.0", "1.1", "2.0"), "apache"),
    "mpl": (("mozilla public license", "mpl"), ("1.0", "1.1", "2.0"), "mpl"),
    "epl": (("eclipse public license", "epl"), ("1.0", "2.0"), "epl"),
    "cddl": (("common development and distribution license", "cddl"), ("1.0", "1.1"), "cddl"),
    "cpl": (("common public license",), ("1.0",), "cpl"),
    "eupl": (("european union public licence", "european union public license", "eupl"), ("1.0", "1.1", "1.2"), "eupl"),
    "osl": (("open software license", "osl"), ("1.0", "2.0", "3.0"), "osl"),
    "afl": (("academic free license",), ("1.2", "2.0", "3.0"), "afl"),
    "artistic": (("artistic license", "perl artistic license"), ("1.0", "2.0"), "artistic"),
    "bsl": (("boost software license",), ("1.0",), "bsl"),
    "ofl": (("sil open font license", "open font license"), ("1.0", "1.1"), "ofl"),
    "odbl": (("open database license", "odbl"), ("1.0",), "odbl"),
    "cc-by-nc-nd": (("creative commons attribution noncommercial noderivatives", "cc by nc nd"), ("2.0", "3.0", "4.0"), "cc by nc nd"),
    "cc-by-nc-sa": (("creative commons attribution noncommercial sharealike", "cc by nc sa"), ("2.0", "3.0", "4.0"), "cc by nc sa"),
    "cc-by-nc": (("creative commons attribution noncommercial", "cc by nc"), ("2.0", "3.0", "4.0"), "cc by nc"),
    "cc-by-nd": (("creative commons attribution noderivatives", "cc by nd"), ("2.0", "3.0", "4.0"), "cc by nd"),
    "cc-by-sa": (("creative commons attribution sharealike", "creative commons attribution share alike", "cc by sa"), ("2.0", "3.0", "4.0"), "cc by sa"),
    "cc-by": (("creative commons attribution", "cc by"), ("2.0", "3.0", "4.0"), "cc by"),
    "cc0": (("cc0", "cc zero", "creative commons zero"), ("1.0",), "cc0"),
    "mit": (("mit license", "mit licence", "expat license"), (), "mit"),
    "isc": (("isc license", "isc licence"), (), "isc"),
    "bsd-2": (("bsd 2 clause license", "simplified bsd license", "freebsd license", "2 clause bsd license"), (), "bsd 2 clause"),
    "bsd-3": (("bsd 3 clause license", "new bsd license", "modified bsd license", "3 clause bsd license"), (), "bsd 3 clause"),
    "bsd-4": (("bsd 4 clause license", "original bsd license", "4 clause bsd license"), (), "bsd 4 clause"),
    "bsd": (("bsd license", "bsd licence", "bsd style license"), (), "bsd"),
    "zlib": (("zlib license", "zlib libpng license"), (), "zlib"),
    "unlicense": (("the unlicense",), (), "unlicense"),
    "wtfpl": (("do what the fuck you want to public license", "wtfpl"), (), "wtfpl"),
    "python": (("python software foundation license", "psf license"), ("2",), "psf"),
    "postgresql": (("postgresql license",), (), "postgresql"),
    "openssl": (("openssl license",), (), "openssl"),
    "php": (("php license",), ("3.0", "3.01"), "php"),
    "ms-pl": (("microsoft public license",), (), "ms pl"),
    "vim": (("vim license",), (), "vim"),
}

#: Sentences that identify a text without naming it.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("public-domain", "released into the public domain"),
    ("public-domain", "dedicated to the public domain"),
    ("proprietary", "all rights reserved"),
)

#: Priority of each frame (0 is the highest) and the confidence it gives.
FRAMES = {"identifier": (0, 1.0), "sentence": (1, 0.95), "versioned": (2, 0.9), "licensed": (3, 0.8),
          "name": (4, 0.7), "weak": (5, 0.4)}

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Every rule holds one of these; texts without them are passed over.
CUES = re.compile(rb"licen[sc]e|[^0-9a-z]cc[^0-9a-z]+by[^0-9a-z]|^cc[^0-9a-z]+by|spdx|gpl|gfdl|"
                  rb"(?<![0-9a-z])(?:asl|mpl|epl|osl)(?![0-9a-z])|cddl|eupl|odbl|cc0|cc[^0-9a-z]+zero|creative|wtfpl|"
                  rb"permission|redistribut|warranty|domain|rights|by\Z")
IS_WORD = np.zeros(256, np.bool_)
IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keywords: frozenset
    pattern: re.Pattern


def _rule(label: str, frame: str, words: str, pattern: str | None = None) -> Rule:
    return Rule(label, *FRAMES[frame], frozenset(words.split()), re.compile(f"(?<= ){pattern or words}(?= )"))


def rules() -> list[Rule]:
    """All rules, by priority."""
    out = [_rule(label, "weak" if label in ("proprietary", "zlib") else "sentence", s) for label, s in SENTENCES]
    for label, (names, versions, spdx) in FAMILIES.items():
        out.append(_rule(label, "identifier", f"spdx license identifier {spdx}", f"spdx license identifier {spdx}(?: [0-9]+)*"))
        for name in names:
            weak = len(name.split()) == 1 and len(name) <= 4 and name not in ("cc0", "agpl", "lgpl", "gfdl", "cddl", "eupl", "odbl")
            out.append(_rule(label, "weak" if weak else "name", name))
            out.append(_rule(label, "licensed", f"under {name}", f"under (?:the )?(?:terms of )?(?:the )?{name}"))
            for v in versions:
                number = " ".join(v.removesuffix(".0").split("."))
                tail = "" if "." in v.removesuffix(".0") else "(?: 0)?"
                out.append(_rule(f"{label}-{v}", "versioned", name, f"{name} (?:version )?v?{number}{tail}"))
    return sorted(out, key=lambda r: r.priority)


class Accepted:
    """Intervals of the detections accepted so far; tells in logarithmic time whether one holds another."""

    def __init__(self):
        self.starts: list[int] = []
        self.reach: list[int] = []  # furthest end of the intervals up to here, by start
        self.spans: list[tuple[int, int]] = []

    def hold(self, a: int, b: int) -> bool:
        i = bisect_right(self.starts, a)
        return i > 0 and self.reach[i - 1] >= b

    def add(self, spans: list[tuple[int, int]]) -> None:
        self.spans = sorted({*self.spans, *spans})
        self.starts = [a for a, _ in self.spans]
        self.reach = list(accumulate((b for _, b in self.spans), max))


def accepted_rules(line: str, ordered: list[Rule]) -> set[Rule]:
    """The rules with a detection that none suppresses: one of higher priority whose interval holds it, or
    a longer one of equal priority."""
    present = set(line.split(" "))
    accepted, out = Accepted(), set()
    for _, rules_here in groupby(ordered, key=lambda r: r.priority):
        found = [(*m.span(), rule) for rule in rules_here if rule.keywords <= present for m in rule.pattern.finditer(line)]
        found = [x for x in found if not accepted.hold(x[0], x[1])]
        found.sort(key=lambda x: (x[0], -x[1]))
        kept: list[tuple[int, int]] = []
        reach = -1
        for (a, b), same in groupby(found, key=lambda x: x[:2]):
            if reach < b:  # else one that starts no later and is longer holds it
                kept.append((a, b))
                out.update(rule for *_, rule in same)
            reach = max(reach, b)
        if kept:
            accepted.add(kept)
    return out


def scan(text: bytes, ordered: list[Rule]) -> tuple:
    """(n_base, first_word, last_word, base_labels, labels, score) of a lower-cased text."""
    words = WORDS.findall(text)
    line = " " + " ".join(w.decode("utf-8", "replace") for w in words) + " "
    n, first, last, base = 0, len(line), -1, set()
    for phrase, label in BASE.items():
        at = line.find(f" {phrase} ")
        while at >= 0:
            n, first, last = n + 1, min(first, at), max(last, at)
            base.add(label)
            at = line.find(f" {phrase} ", at + 1)
    rules_found = accepted_rules(line, ordered)
    labels = base | {r.label for r in rules_found}
    score = max((r.confidence for r in rules_found), default=0.0)
    return (n, line.count(" ", 0, first) if n else None, line.count(" ", 0, last) if n else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
       "labels string, score double")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ordered = rules()
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
    for batch in batches:
        data, ends = utf8(batch.column(1))
        n_words: list[int] = []
        found = []
        for a, b in by_bytes(ends):
            part, cut = data[ends[a]:ends[b]], ends[a:b + 1] - ends[a]
            word = IS_WORD[part]
            start = word.copy()
            start[1:] &= ~word[:-1]
            opens = cut[:-1][cut[:-1] < cut[1:]]
            start[opens] = word[opens]
            upto = np.concatenate(([0], np.cumsum(start, dtype=np.int64)))
            n_words += (upto[cut[1:]] - upto[cut[:-1]]).tolist()
            low = part.tobytes().lower()  # A-Z only
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
                text = low[x:y]
                found.append(scan(text, ordered) if CUES.search(text) else (0, None, None, "", "", 0.0))
        cols = [batch.column(0), n_words, *(zip(*found) if found else [()] * 6)]
        yield pa.RecordBatch.from_arrays([c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t)
                                          for c, t in zip(cols, types)], names=[f.split()[0] for f in OUT.split(", ")])


def scan_licenses(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row; see OUT.  Word positions count from 0."""
    small_batches(df.sparkSession)
    return df.select(df[f"`{id_col}`"].cast("long").alias("doc_id"), df[f"`{text}`"].cast("string").alias("text")).mapInArrow(_scan, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
