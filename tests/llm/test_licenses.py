"""The licence scan against a plain version of its rules, and edge cases."""

import math
import random
import re

from pyspark.sql import functions as F

from tessera.llm import licenses

SCHEMA = "doc_id long, text string, families string"
TEXTS = [
    "some prose\nReleased under the MIT License.\nmore prose",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.",
    "He had a licence to fish under the bridge and the permission of the town",
    "the free work of any person is under the general terms",
    "Released under the MIT License.\nReleased under the MIT License.",
    None,
    "",
    "word " * 30000 + "\n" + "license " * 5000,
]


def plain(text, weights, least):
    """(families, lines, score) of one text."""
    found = []
    for line in (text or "").split("\n"):
        if not re.search(licenses.MARKS, line.lower()):
            continue
        known = [g for g in licenses.grams([w for w in re.split("[^a-z]+", line.lower()) if w]) if g in set(licenses.FEATURES)]
        best = []
        for k in licenses.FAMILIES:
            s = weights[k][""] + sum(weights[k].get(g, 0.0) for g in known) / math.sqrt(max(1, len(known)))
            close = any(f == k and len(set(known) & set(t)) >= licenses.CONFIRM * len(t) for f, t in licenses.TEMPLATE_GRAMS)
            if close and s > least[k]:
                best.append((s, k))
        if best:
            found.append(max(best))
    score = 1 / (1 + math.exp(-max(found)[0])) if found else None
    return sorted({k for _, k in found}), len(found), score


def test_scan_equals_the_plain_rules(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], None), (None, TEXTS[1], None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    weights, least = licenses.train(docs)
    got = sorted(((r[0] if r[0] is not None else -1, r[1], r[2], r[3]) for r in licenses.scan(docs).collect()), key=lambda r: r[0])
    assert len(got) == len(rows)
    for key, families, lines, score in got:
        expected = plain(TEXTS[key if key >= 0 else 1], weights, least)
        assert (families, lines) == expected[:2]
        assert (score is None) == (expected[2] is None) and (score is None or math.isclose(score, expected[2], rel_tol=1e-9))
    named = {r[0]: r[1] for r in got}
    assert named[0] == ["mit"] and named[1] == ["gpl"] and named[2] == ["apache", "cc"]
    assert named[3] == named[4] == named[6] == named[7] == named[8] == []


def test_scan_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert licenses.scan(docs).select(F.count("*")).first()[0] == 0


def test_lines_without_a_marked_word_are_judged(spark, monkeypatch):
    """Every line of every length is judged as the plain rules do without their mark."""
    rng = random.Random(4)
    templates = [t.split() for _, t in licenses.TEMPLATES]
    lines = ["released under the bsd", "This program is FREE software: you can use it under the terms of the GNU General Public text"]
    for t in templates * 12:
        held = [w for w in t if rng.random() > 0.15]
        lines.append(rng.choice(["", "x ", "un"]) + rng.choice([" ", ", ", "1 "]).join(held) + rng.choice(["", "s", ".", " all"]))
    docs = spark.createDataFrame([(i, line + "\nprose of no account", None) for i, line in enumerate(lines)], SCHEMA)
    weights, least = licenses.train(docs)
    monkeypatch.setattr(licenses, "MARKS", "")
    wanted = {i: plain(line, weights, least)[0] for i, line in enumerate(lines)}
    monkeypatch.undo()
    got = {r["doc_id"]: r["families"] for r in licenses.scan(docs).collect()}
    assert got == wanted
    assert any(f and not re.search(licenses.MARKS, line.lower()) for f, line in zip(wanted.values(), lines))
