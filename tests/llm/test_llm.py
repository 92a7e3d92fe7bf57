"""Operators against the library, brute force and edge cases."""

from collections import Counter

import pytest

from tessera.llm import bpe, decontaminate, language_id, near_dedup, pii, quality, token_counts, url_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def test_bpe_equals_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.Bpe(path)
    for text in ("", "Hello  world's", "a<|endoftext|>B", "ΟΔΟΣ İstanbul ß ՘a   x", "x" * 3000, "日本 😀 é"):
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert own.both(None) == (0, "", "")


def test_window_hits():
    item = " ".join(f"w{i}" for i in range(12))
    found = decontaminate.Searcher([(1, item), (2, "Short one"), (3, None)]).scan([f"a {item} b", "x short ONE short one", None, "w0 w1", "w1 " * 50])
    assert found[0] == (14, [[1, 13]], [1])
    assert found[1] == (5, [[1, 5]], [2])
    assert [f[1] for f in found[2:]] == [[], [], []]


def test_surrogates_keep_distinctness_and_coreference():
    one = pii.Surrogates("k")
    text, n, kinds = one.replace("mail a.b@c.com and a.b@c.com, 10.1.2.3, 4417744280351547, +1 (826) 555-4081")
    assert n == 5 and Counter(kinds)["email"] == 2
    assert text.split()[1] == text.split()[3].rstrip(",")
    assert "555-4081" not in text and "4417744280351547" not in text
    assert len({one.digits(f"{i:03d}", "x") for i in range(1000)}) == 1000
    assert one.replace(None) == (None, 0, []) and one.replace("clean") == ("clean", 0, [])


def test_repeated_words():
    assert quality.base_counts("a b c d e x a b c d e")[4] == 10
    assert quality.base_counts(None) == (0, 0, 0, 0, 0)
    assert quality.base_counts("a\na\n\n\nb")[3] == 1


def test_model_sums_to_one():
    import numpy as np

    keys = np.array([1, 2, 3, 0x010203, 0x010204, 0x020301], np.int64)
    model = quality.KneserNey(keys, np.array([3, 1, 2, 4, 1, 1]))
    for context in (0, 0x0102, 0x0505):
        held = dict(zip(model.keys.tolist(), model.log))
        total = sum(
            float(np.exp(held[k])) if (k := (context << 8) | b) in held else float(model.gamma3[context] * model.p2[k & 0xFFFF]) for b in range(256)
        )
        assert total == pytest.approx(1)


def test_features_of_texts_without_letters():
    assert len(language_id.features("12 --")[0]) == 0 == len(language_id.features(None)[0])


def test_near_duplicates(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join(words[:-2] + ["x", "y"]), " ".join(words), None, "", "one two", "One two", " ".join(words[100:] + words[:100][::-1])]
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(table(spark, texts)).collect()}
    assert got == {0: (0, True), 1: (0, False), 2: (0, False), 3: (3, True), 4: (4, True), 5: (5, True), 6: (5, False), 7: (7, True)}


def test_url_rules(spark):
    urls = ["http://a.net/x", "http://NET/", "https://example.net/en/1?q", "http://notnet/", "net/", None, "http://x.org/fr/a", "http://example.com"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge(pages, url_rules.default_rules(spark)).collect()}
    expected = [("net/", "block"), ("net/", "block"), ("example.net/en/", "allow"), None, None, None, ("org/fr/", "allow"), None]
    assert got == {i: e or (None, "allow") for i, e in enumerate(expected)}


def test_histogram(spark):
    lengths = [0, 3, 3, 5000, 2000]
    rows = token_counts.length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long")).collect()
    for r in rows:
        assert r["docs_ge"] == sum(n >= r["n_tokens"] for n in lengths)
        assert r["truncated_tokens"] == sum(min(n, r["n_tokens"]) for n in lengths)
