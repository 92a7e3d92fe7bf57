"""The n-gram join against brute force: crowded groups, chains, short texts, odd rows."""

import random
import re

import numpy as np

from tessera.llm import ngram_join


def brute(rows, size=3, threshold=90):
    def grams(text):
        w = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())

    sets = [grams(t) for _, t in rows]
    group = list(range(len(rows)))
    for b in range(len(rows)):
        for a in range(b):
            if group[a] != group[b] and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= threshold * len(sets[a] | sets[b]):
                    high, low = group[b], group[a]
                    group = [low if g == high else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted((str(i), len(s), str(least.get(g))) for (i, _), s, g in zip(rows, sets, group))


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, digest string, `a.b` int, node string")
    return sorted((str(a), b, str(c)) for a, b, c in ngram_join.ngram_join(df, **options).collect())


def crowd(seed, copies, length, changes, base):
    """Copies of one text with ``changes`` changed words, with or without the text itself, and copies of copies."""
    rnd = random.Random(seed)
    word = lambda: f"v{rnd.randrange(10**6)}"
    first = [word() for _ in range(length)]
    made = [first] if base else []
    for _ in range(copies):
        changed = list(first)
        for at in rnd.sample(range(length), changes):
            changed[at] = word()
        made.append(changed)
    for _ in range(copies // 4):
        changed = list(rnd.choice(made))
        changed[rnd.randrange(length)] = word()
        made.append(changed)
    return [" ".join(t) for t in made]


def test_crowded_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)  # texts are fetched by a shuffle
    texts = crowd(1, 60, 58, 1, False) + crowd(2, 50, 60, 1, True) + crowd(3, 40, 200, 2, False) + crowd(4, 40, 120, 2, True) + crowd(5, 30, 400, 9, False)
    texts += texts[5:25]
    random.Random(9).shuffle(texts)
    rows = list(enumerate(texts))
    got = run(spark, rows)
    assert got == brute(rows)
    assert 20 < len({c for _, _, c in got}) < len(rows) - 60


def test_family_and_rest_find_links_on_their_own(spark, monkeypatch):
    """Without rounds of leaders all links come from the join of blocks."""
    monkeypatch.setattr(ngram_join, "OPEN", 10**9)
    rows = list(enumerate(crowd(6, 40, 70, 1, False) + crowd(7, 20, 300, 5, True)))
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "One"), (3, "one"), (9, "one two"), (10, "one  TWO"), (11, "a b c"), (None, "a b c"), (None, None), (None, "only here"),
            (12, "x y z " * 4000), (4, "x y z " * 5000), (13, "dup id text one two three four"), (13, "another text of this id"), (2, "another text of this id"), (13, "another text of this id"), (1, "É x y"), (0, "é x y")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.ngram_join(df).collect() == []
    assert run(spark, [(1, None), (2, "")]) == [("1", 0, "1"), ("2", 0, "2")]


def test_lower_threshold_and_longer_shingles(spark):
    rows = list(enumerate(crowd(8, 40, 90, 1, False)))
    assert run(spark, rows, size=5, threshold=80) == brute(rows, 5, 80)


def test_signature_never_exceeds_the_difference():
    rnd = np.random.default_rng(0)
    for _ in range(200):
        x, y = (np.unique(rnd.integers(0, 400, rnd.integers(1, 300)).astype(np.uint64) * np.uint64(7919)) for _ in range(2))
        apart = sum(int(v).bit_count() for v in (ngram_join.signature(x) ^ ngram_join.signature(y)).view(np.uint64))
        assert apart <= len(np.setxor1d(x, y))
