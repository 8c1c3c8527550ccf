"""Suppression among detections against the plain rule, and its cost on texts made of licence phrases."""

import random
import time

import pytest

from purchlake.llm import license_rules as lr

ORDERED = lr.rules()


def plain(line):
    """Every detection against every accepted one."""
    present = set(line.split(" "))
    accepted = []
    for rule in ORDERED:
        if rule.keywords <= present:
            for m in rule.pattern.finditer(line):
                a, b = m.span()
                inside = [x for x in accepted if x[0] <= a and b <= x[1]]
                if not any(x[2].priority < rule.priority or x[1] - x[0] > b - a for x in inside):
                    accepted = [x for x in accepted if not (x[2].priority == rule.priority and a <= x[0]
                                                            and x[1] <= b and x[1] - x[0] < b - a)]
                    accepted.append((a, b, rule))
    return {r for _, _, r in accepted}


@pytest.mark.parametrize("seed", range(4))
def test_same_rules_as_the_plain_version(seed):
    rng = random.Random(seed)
    phrases = [n for names, *_ in lr.FAMILIES.values() for n in names] + [t for _, t in lr.SENTENCES]
    phrases += ["under the terms of the", "version", "v2", "2", "3 0", "1 1", "spdx license identifier", "gpl", "mit", "the", "public license"]
    for _ in range(150):
        line = " " + " ".join(rng.choice(phrases) for _ in range(rng.randrange(1, 25))) + " "
        assert lr.accepted_rules(line, ORDERED) == plain(line)


def test_first_and_last_word():
    text = b"zero mit license three four mit license cc by gnu general public license x"
    assert lr.scan(text, ORDERED)[:4] == (4, 1, 9, "cc-by,gpl,mit")
    assert lr.scan(b"", ORDERED) == (0, None, None, "", "", 0.0)


def test_a_long_text_of_licence_phrases():
    text = b"under the mit license, gnu general public license version 3 and apache license 2.0; " * 60_000
    t0 = time.process_time()
    n, first, last, base, labels, _ = lr.scan(text, ORDERED)
    assert time.process_time() - t0 < 60
    assert n == 180_000 and first == 2 and base == "apache,gpl,mit" and {"apache-2.0", "gpl-3"} <= set(labels.split(","))
