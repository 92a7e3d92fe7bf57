"""Near-duplicate groups against brute force where one document fits only a few of a crowded group."""

import random

import corpus_pipeline
from tessera import session
from tessera.llm import near_dedup
from tests.llm.test_llm import table


def brute(texts, threshold):
    sets = [set(near_dedup.shingles(t).tolist()) for t in texts]
    group = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= threshold * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    return dict(enumerate(group))


def drifted(seed, copies=400, length=120):
    """A crowded group of copies with changed words, and documents that fit only one or two of them."""
    rnd = random.Random(seed)
    word = lambda: f"v{rnd.randrange(10**6)}"
    base = [word() for _ in range(length)]
    texts = []
    for _ in range(copies):
        changed = list(base)
        at = rnd.randrange(length - 8)
        changed[at : at + 8] = [word() for _ in range(8)]
        texts.append(changed)
    for _ in range(40):  # far from the base, near one copy
        changed = list(rnd.choice(texts[:copies]))
        at = rnd.randrange(length - 6)
        changed[at : at + 5] = [word() for _ in range(5)]
        texts.append(changed)
    return [" ".join(t) for t in texts]


def test_crowded_group_equals_brute_force(spark):
    texts = drifted(3)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(table(spark, texts), threshold=85).collect()}
    assert got == brute(texts, 85)


def test_exact_join_finds_all_pairs_without_the_forest(spark):
    texts = drifted(4, 60)
    sets = [near_dedup.shingles(t) for t in texts]
    rows = spark.createDataFrame([(i, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)], "id long, size long, hashes binary")
    none = spark.createDataFrame([], "id long, component long")
    pairs = near_dedup._missed(near_dedup._prefixes(rows, 85), none, 85)
    got = {(r["a"], r["b"]) for r in near_dedup._confirm(pairs, rows, 85).collect()}
    full = [set(s.tolist()) for s in sets]
    assert got == {(a, b) for b in range(len(full)) for a in range(b) if 100 * len(full[a] & full[b]) >= 85 * len(full[a] | full[b])}


def test_pairs_no_tree_brings_together_are_found(spark):
    """At a low threshold many pairs share too few MinHash values to meet in a tree."""
    rnd = random.Random(5)
    texts = []
    for p in range(60):
        listed = [f"p{p}w{i}" for i in range(100)]
        texts.append(" ".join(listed))
        at = rnd.randrange(70)
        texts.append(" ".join(listed[:at] + [f"q{p}x{i}" for i in range(26)] + listed[at + 26 :]))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(table(spark, texts), threshold=50).collect()}
    expected = brute(texts, 50)
    assert sum(i != c for i, c in expected.items()) == 60
    assert got == expected


def test_pipeline_stage_drops_copies_from_four_fifths_on(spark):
    """Copies with 2 to 6 scattered changed words of 200, similarities on both sides of 0.8."""
    texts = []
    for p, changes in enumerate((2, 3, 4, 4, 5, 6)):
        listed = [f"p{p}w{i}" for i in range(200)]
        texts.append(" ".join(listed))
        for c in range(changes):
            listed[20 + 30 * c] = f"q{p}x{c}"
        texts.append(" ".join(listed))
    kept = corpus_pipeline.remove_near_duplicates(spark, table(spark, texts), "")
    expected = {i for i, c in brute(texts, 80).items() if i == c}
    assert 5 in expected ^ {i for i, c in brute(texts, 85).items() if i == c}
    assert {r["doc_id"] for r in kept.collect()} == expected


def test_read_tables_are_deleted(spark, tmp_path, monkeypatch):
    """Beside the result's own tables nothing stays, above all not the sets."""
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    texts = [*drifted(6, 40), *["one two three four five six"] * 3]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(table(spark, texts), threshold=85).collect()}
    left = {p.name.rpartition("-")[0] for p in tmp_path.glob("tessera-*/*")}
    assert got == brute(texts, 85)
    assert left and left <= {"members", "components", "small-star"}


def test_sketches_never_rule_out_a_link():
    rnd = random.Random(7)
    ruled_out = 0
    for n in (1, 2, 15, 16, 17, 130, 1000):
        for _ in range(60):
            a = {rnd.getrandbits(64) for _ in range(n)}
            b = set(rnd.sample(sorted(a), rnd.randrange(n + 1))) | {rnd.getrandbits(64) for _ in range(rnd.randrange(n // 2 + 2))}
            x, y = (near_dedup.np.array(sorted(s), near_dedup.np.uint64) for s in (a, b))
            most = near_dedup.most_shared(near_dedup.sketch(x), near_dedup.sketch(y), len(a), len(b))
            assert most >= len(a & b)
            ruled_out += 100 * most < 85 * (len(a) + len(b) - most)
    assert ruled_out > 200
