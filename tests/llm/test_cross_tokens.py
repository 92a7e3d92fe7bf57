"""Cross-tokenizer alignment against the libraries over whole texts and a plain count of links."""

import hashlib
import random
from collections import Counter

import public_tokenizers as vocabularies
import pytest

from tessera.llm import cross_tokens

PATHS = vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model"), vocabularies.PATTERN


def plain(texts):
    """The contract word by word: whole texts, byte offsets as sets."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    own = cross_tokens.load(*PATHS)

    def one(text):
        if not text:
            return None
        wanted = (" " + text).encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a, bytes_b = [own.bytes_a[i] for i in ids_a], [own.bytes_b[i] for i in ids_b]
        if b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
            return None
        spans = lambda listed: [(sum(map(len, listed[:k])), sum(map(len, listed[: k + 1]))) for k in range(len(listed))]
        at_a, at_b = spans(bytes_a), spans(bytes_b)
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups, low = [], 0
        for cut in cuts:
            inside = lambda at, ids: ",".join(str(i) for i, (s, e) in zip(ids, at) if s >= low and e <= cut)
            groups.append(f"{inside(at_a, ids_a)}|{inside(at_b, ids_b)}")
            low = cut
        links = [(i, j) for i, (s, e) in zip(ids_a, at_a) for j, (t, f) in zip(ids_b, at_b) if s < f and t < e]
        return len(ids_a), len(ids_b), groups, links

    made = [one(t) for t in texts]
    count = Counter(link for m in made if m for link in m[3])
    top = Counter()
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    out = []
    for m in made:
        if m is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = m
            out.append((n_a, n_b, len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def texts(seed=0, n=120):
    rnd = random.Random(seed)
    parts = ["the", "Theation", " ", "  ", "\n", "\t", "\r\n", "é", "ß", "日本語", "😀", "Ωmega", "12345", "don't", "I'LL", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>",
             "\u2581", "\u200b", "\u00a0", "\u3000", "\x00", "\x1c", "\u180e", "...", "—", "a_b", "ǅ", "\u0301", "\u1c89", "\ufeff", "क्षि", "ﬁ", "½", "\u2028"]
    out = [None, "", " ", "a", "\n", " lead", "trail ", "two  spaces", "<|endoftext|>", "\u2581x", "x" * 900, "word " * 400]
    for _ in range(n):
        out.append("".join(rnd.choice(parts) + rnd.choice(["", " ", " "]) for _ in range(rnd.randrange(1, 25))))
    return out + out[5:30] + ["the the end"] * 15


def frame(spark, listed):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(listed)], "doc_id long, text string, block string, `n.a` int, digest string")


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_equals_the_libraries_over_whole_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(cross_tokens, "BROADCAST_PAIRS", limit)  # few pairs are broadcast, many joined by a shuffle
    listed = texts()
    got = {r[0]: tuple(r)[1:] for r in cross_tokens.align(frame(spark, listed), *PATHS).collect()}
    wanted = plain(listed)
    assert [i for i in got if got[i] != wanted[i]] == []
    assert sum(w[0] > 0 for w in wanted) > 100 and sum(w[0] == 0 for w in wanted) > 3


def test_empty_tables_and_repeated_rows(spark):
    assert cross_tokens.align(frame(spark, texts()).where("false"), *PATHS).collect() == []
    assert [tuple(r) for r in cross_tokens.align(frame(spark, [None]), *PATHS).collect()] == [(0, 0, 0, 0, 0, 0, 0, "")]
    rows = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text"), (1, "other")], "doc_id long, text string")
    got = sorted(map(str, cross_tokens.align(rows, *PATHS).collect()))
    assert len(got) == 4 and got[1] == got[2]


def test_weights_beyond_double_precision():
    import numpy as np

    got = cross_tokens._weighted(np.array([0, 1, 1]), np.array([2, 1]), np.array([2**60 + 1, 1]), 2)
    assert got.tolist() == [2**60 + 1, 2**60 + 2]
