"""Encoding of whole tables: nulls, spaces of every kind, repeated rows, clashing columns, no rows."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \t\n", "a\x1cb\x1f c", "Á é x y　z", "don't<|endoftext|>Stop", "ab" * 20000, "same", "same"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_tables(spark):
    docs = spark.createDataFrame([(i // 2, t, "old") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens string")
    library = Tokenizer.from_file(PATH)
    expected = []
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i // 2, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    made = bpe.encode_decode(docs, PATH, digest=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, made.collect())) == sorted(expected)
    assert bpe.encode_decode(docs.where("false"), PATH).count() == 0
