"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, a
plus before a digit, digits joined by a dot, digit pairs, URL schemes and
identifier cues.  A deterministic local parser expands each anchor to the
left and right and validates what it found; text without anchors is never
parsed.

Kinds: ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are the base kinds,
leftmost and non-overlapping per kind, failing matches dropped without a
retry.  The method adds ``login`` (credentials in a URL), ``iban`` (mod-97
checksum after a cue) and ``account`` (number after a bank-account or
social-security cue).

Nulls: a null text counts as empty and has no spans.  Empty and very long
texts, repeated rows and empty tables need no special care: rows are
independent.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ship, small_batches, table

ship(__name__)

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account")

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOGIN = re.compile(r"://([^\s/@:]+:[^\s/@]+)@[A-Za-z0-9.-]+")
IBAN = re.compile(r"[\s:#]{1,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{1,4}){3,8})(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?:[\s:#.-]{0,3}(?:number|no|nr|num))?[\s:#.-]{1,3}([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])")

SCHEMES = ("http://", "https://", "ftp://", "ssh://")
IBAN_CUES = ("iban",)
ACCOUNT_CUES = ("account", "acct", "konto", "cuenta", "compte", "ssn", "social security")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return 15 <= len(iban) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def automaton():
    """Anchor -> (what it announces, how far before its last character it starts)."""
    import ahocorasick
    a = ahocorasick.Automaton()
    ds = "0123456789"

    def add(word: str, what: str) -> None:
        a.add_word(word, (what, len(word) - 1))

    add("@", "email")
    for x in ds:
        add("+" + x, "phone")
        for y in ds:
            add(f"{x}.{y}", "ip")
            for sep in ("", " ", "-"):
                add(x + sep + y, "card")
    for words, what in ((SCHEMES, "login"), (IBAN_CUES, "iban"), (ACCOUNT_CUES, "account")):
        for w in words:
            for form in {w, w.capitalize(), w.upper()}:
                add(form, what)
    a.make_automaton()
    return a


def spans(text: str, anchors) -> list[tuple[int, int, int]]:
    """(start, end, index into KINDS), by start, then kind."""
    found: list[tuple[int, int, int]] = []
    done = dict.fromkeys(KINDS, 0)  # per kind: where its last match, kept or dropped, ended
    for last, (what, back) in anchors.iter(text):
        at, free = last - back, done[what]
        if at < free:
            continue
        kind = KINDS.index(what)
        if what == "email":
            left = at
            while left > free and text[left - 1] in LOCAL:
                left -= 1
            if left < at and (m := DOMAIN.match(text, at)):
                found.append((left, m.end(), kind))
                done[what] = m.end()
        elif what == "ip":
            left = at
            while left > free and text[left - 1] in DIGITS:
                left -= 1
            if m := IP.match(text, left):
                done[what] = m.end()
                if all(len(d := p.lstrip("0")) <= 3 and int(d or "0") <= 255 for p in m.groups()):
                    found.append((left, m.end(), kind))
        elif what == "card":
            m = CARD.match(text, at)
            done[what] = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((at, m.end(), kind))
        elif what == "phone":
            if m := PHONE.match(text, at):
                done[what] = m.end()
                if 10 <= sum(c in DIGITS for c in m[0]) <= 15:
                    found.append((at, m.end(), kind))
        elif what == "login":
            if m := LOGIN.match(text, last - 2):
                found.append((m.start(1), m.end(1), kind))
                done[what] = m.end()
        elif what == "iban":
            m = IBAN.match(text, last + 1)
            if m and mod97(m[1].replace(" ", "")):
                found.append((m.start(1), m.end(1), kind))
                done[what] = m.end()
        elif m := ACCOUNT.match(text, last + 1):
            found.append((m.start(1), m.end(1), kind))
            done[what] = m.end()
    found.sort(key=lambda s: (s[0], s[2]))
    return found


def _written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in found)


OUT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        cols: list[list] = [[] for _ in range(7)]
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = spans(text or "", anchors)
            base = [s for s in found if s[2] < len(BASE)]
            kinds = [s[2] for s in base]
            row = (doc, *(kinds.count(k) for k in range(len(BASE))),
                   hashlib.sha256(_written(base).encode()).hexdigest(), _written(found))
            for c, v in zip(cols, row):
                c.append(v)
        types = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         names=[f.split()[0] for f in OUT.split(", ")])


def find_personal_data(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, a count per base kind, a digest of the base spans, all spans
    as kind:start:end (code points, end exclusive)."""
    small_batches(df.sparkSession)
    return df.select(df[id_col].cast("long"), df[text].cast("string")).mapInArrow(_scan, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
