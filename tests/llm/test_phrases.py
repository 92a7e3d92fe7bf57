"""Phrase collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np

from tessera.llm import phrases

SCHEMA = "lang string, text string, `a.b` int, id string, block string, cur string"


def brute(rows, least, first):
    counts, totals, out = {}, Counter(), []
    for lang, text in rows:
        lang, text = lang or "und", text or ""
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    for lang, seen in counts.items():
        held = {g: f for g, f in seen.items() if f >= least and len(g) > 1}
        rows = []
        for g, a in held.items():
            if any(100 * f >= 80 * a and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h))) for h, f in held.items()):
                continue
            score, k = min((2000000 * a // (seen[g[:k]] + seen[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), seen[g[:k]], seen[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows(n=80, seed=1):
    rnd = random.Random(seed)
    words = ["The", "of", "é", "日本", "x-y", "a", "A", "b c", "\x00", "Zz"]
    out = [(None, None), ("en", None), ("en", ""), ("fr", " \t\n"), (None, "a a a a a, a a"), ("en", "one")]
    for _ in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " "]) for _ in range(rnd.randrange(40)))
        out.append((rnd.choice(["en", "fr", None, "und"]), text))
    return out + out[10:30] + [("en", "of the " * 3000)]


def frame(spark, listed):
    return spark.createDataFrame([(lang, text, 1, "x", "y", "z") for lang, text in listed], SCHEMA)


def test_equals_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_CHARS", 700)  # several blocks in a task
    listed = rows()
    for least, first in ((3, 2000), (4, 3)):
        got = sorted(map(tuple, phrases.collocations(frame(spark, listed), least=least, first=first).collect()))
        assert got == brute(listed, least, first)
        assert len(got) >= 3


def test_large_tables_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BROADCAST_ROWS", 0)
    listed = rows(40, 2)
    assert sorted(map(tuple, phrases.collocations(frame(spark, listed), least=3).collect())) == brute(listed, 3, 2000)


def test_empty_tables(spark):
    assert phrases.collocations(frame(spark, rows()).where("false")).collect() == []
    assert phrases.collocations(frame(spark, [(None, None), ("en", "")])).collect() == []


def test_squeeze_keeps_all_neighbours():
    rnd = np.random.default_rng(0)
    for _ in range(50):
        cur = (rnd.integers(0, 4, 30) * rnd.integers(0, 2, 30)).astype(np.int32)
        pairs = lambda a: [(x, y) for x, y in zip(a[:-1], a[1:]) if x and y]
        assert pairs(phrases.squeeze(cur).tolist()) == pairs(cur.tolist())
        assert phrases.unpack(phrases.pack(cur)).tolist() == cur.tolist()
    assert len(phrases.squeeze(np.zeros(0, np.int32))) == 0
    assert len(phrases.unpack(phrases.pack(np.zeros(0, np.int32)))) == 0


def test_totals_beyond_64_bits_do_not_overflow(spark):
    rows = spark.sql("select cast(4e18 as long) f, array(cast(4e18 as long)) firsts")
    got = rows.selectExpr("cast(cast(2000000 as decimal(7,0)) * cast(f as decimal(20,0)) div (cast(firsts[0] as decimal(20,0)) + cast(f as decimal(20,0))) as long) s").first()["s"]
    assert got == 1000000
