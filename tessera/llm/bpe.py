"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree hold, for each symbol, the rank of the merge with its right
neighbour; a node holds the smaller ``rank * n + position`` of its children.  The root
is therefore the leftmost of the lowest-ranked merges.  A merge changes three leaves,
each in logarithmic time, so a piece of n symbols costs O(n log n).

Null and empty texts have no ids.  A text is never cut; the cache of pieces is bounded.
All other columns are carried unchanged.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import add_columns, documents, held_by_worker

CACHE_PIECES = 400_000
LONGEST_KEPT = 64
#: Below this code point the word pattern gives the same pieces under every Unicode version in use.
STABLE = "԰"
_SEPARATOR = re.compile("[\x1c-\x1f]")  # spaces for str.split, but not for the vocabulary's pattern
_SPACE = re.compile("[^\\S\x1c-\x1f]+")
_NONE = 1 << 62


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply the merges of ``ranks`` to one piece, lowest rank first, leftmost on ties."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = list(symbols)
    size = 1 << (n - 2).bit_length()
    get = ranks.get
    tree = [_NONE] * (2 * size)
    for i, pair in enumerate(zip(symbols, symbols[1:])):
        rank = get(pair)
        if rank is not None:
            tree[size + i] = rank * n + i
    for i in range(size - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def update(i: int, value: int) -> None:
        i += size
        if tree[i] == value:
            return
        tree[i] = value
        while i > 1:
            other = tree[i ^ 1]
            if other < value:
                value = other
            i >>= 1
            if tree[i] == value:
                return
            tree[i] = value

    while (root := tree[1]) != _NONE:
        i = root % n
        j = after[i]
        merged = symbols[i] = symbols[i] + symbols[j]
        symbols[j] = ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            update(j, _NONE)
            rank = get((merged, symbols[k]))
            update(i, _NONE if rank is None else rank * n + i)
        else:
            if j < size:
                update(j, _NONE)
            update(i, _NONE)
        h = before[i]
        if h >= 0:
            rank = get((symbols[h], merged))
            update(h, _NONE if rank is None else rank * n + h)
    return [s for s in symbols if s]


class _Chunks(dict):
    """Results by chunk, computed when first asked for; long chunks are not kept."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, chunk: str):
        made = self.make(chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[chunk] = made
        return made


class Bpe:
    """Encoder and decoder for one vocabulary file with word ends."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        self.pre_tokenize = library.pre_tokenizer.pre_tokenize_str
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = regex.compile(split["pattern"]["Regex"])
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        rest = [b for b in range(256) if b not in set(shown)]
        self.byte_char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}

        self.piece = lru_cache(CACHE_PIECES)(self._piece)
        self.chunks = _Chunks(self._chunk)

    def _piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece in its byte form."""
        symbols = list(piece)
        symbols[-1] += self.suffix
        vocab = self.vocab
        return tuple(vocab[s] for s in merge([s for s in symbols if s in vocab], self.ranks))

    def _chunk(self, chunk: str) -> tuple[int, str, str] | None:
        """Ids of a text without a space; None where it has none."""
        if chunk.isascii():
            chunk = chunk.lower()
            pieces = [chunk] if chunk.isalpha() else self.pattern.findall(chunk)
            if not chunk.isprintable():
                pieces = ["".join(map(self.byte_char.__getitem__, p.encode())) for p in pieces]
        elif max(chunk := self.normalise(chunk)) < STABLE:
            pieces = ["".join(map(self.byte_char.__getitem__, p.encode())) for p in self.pattern.findall(chunk)]
        else:
            pieces = [p for p, _ in self.pre_tokenize(chunk)]
        return self._shown([i for p in pieces for i in self.piece(p)])

    def _shown(self, ids: list[int]) -> tuple[int, str, str] | None:
        return (len(ids), " ".join(map(str, ids)), " ".join(map(self.tokens.__getitem__, ids))) if ids else None

    def _parts(self, text: str) -> Iterator[tuple[int, str, str]]:
        """What the chunks between spaces give; neither normal form nor piece reaches over a space."""
        segments = self.special_pattern.split(text) if self.special_pattern else [text]
        for segment in segments:
            if segment in self.special:
                yield self._shown([self.special[segment]])
            elif segment:
                chunks = _SPACE.split(segment) if _SEPARATOR.search(segment) else segment.split()
                yield from filter(None, map(self.chunks.__getitem__, chunks))

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for _, shown, _ in self._parts(text or ""):
            ids.extend(map(int, shown.split(" ")))
        return ids

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space; unknown ids are left out."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])

    def both(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, the ids as text, and the decoded text."""
        parts = list(self._parts(text or ""))
        counts, ids, tokens = zip(*parts) if parts else ((), (), ())
        return sum(counts), " ".join(ids), " ".join(tokens)


def load(path: str) -> Bpe:
    """The vocabulary and its caches, once per Python worker."""
    return held_by_worker(("bpe", path), lambda: Bpe(path))


def encode_decode(docs: DataFrame, path: str, text: str = "text", digest: bool = False, keep_text: bool = True) -> DataFrame:
    """Add ``n_tokens``, ``ids`` (space-separated) and ``decoded``, or their sha256 with ``digest``.

    Columns of ``docs`` with those names are replaced; without ``keep_text`` the text is left out.
    """

    def make():
        bpe = load(path)

        def sha(value: str) -> str:
            return hashlib.sha256(value.encode()).hexdigest()

        def rows(texts: list) -> list[tuple]:
            made = map(bpe.both, texts)
            return [(n, sha(i), sha(d)) for n, i, d in made] if digest else list(made)

        return rows

    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "n_tokens long, ids string, decoded string"
    return add_columns(docs, added, make, text, keep_inputs=keep_text)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), digest=True, keep_text=False)
