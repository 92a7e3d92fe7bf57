"""Alignment of two tokenizers over distinct texts, and corpus-wide counts of linked id pairs.

Equal texts are brought together by a shuffle on the full text, so each distinct text is
tokenised and aligned once; its links count as often as the text occurs.  The measures go
back to the documents by a join on the text's SHA-256.

Both tokenizers always end a token before a single space between two other characters: the
byte-level pattern starts a piece there, and no piece of the second vocabulary has a space
mark behind another character (checked when it is loaded).  Texts are therefore aligned in
chunks between such spaces; chunks seen before come from a cache of bounded size.  Chunks are
encoded by the libraries and aligned in one go by binary search over byte offsets.

Blocks of texts keep their links as numbers into a list of the block's distinct id pairs.  The
counts of all pairs are sent to every task if they are few, by a count of the rows; more of
them are joined to the pairs of each block by a shuffle.

Null and empty texts, and texts that either tokenizer does not give back byte for byte, have
zeros and an empty string.  Texts are never cut, whatever their length.  Each row of the input
is one row of the result: repeated ids, repeated rows and null ids stay as they are.  An empty
table gives no rows.  Other columns are not read.  Pairs tied for the highest count of their
second id are all best.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import STABLE
from tessera.llm.common import documents
from tessera.llm.phrases import pack, unpack
from tessera.session import stage

#: Characters of text in a block, chunks that a worker remembers, and pairs that are sent to every task.
BLOCK_CHARS, CACHE_CHUNKS, BROADCAST_PAIRS = 2_000_000, 120_000, 1_000_000
#: White space under any Unicode version in use.
_SPACES = "\\s\x1c-\x1f\x85\u180e\u200b\u2060\ufeff"
_CUT = re.compile(f"(?<=[^{_SPACES}]) (?=[^{_SPACES}])")
_ODD = re.compile(f"^ | $| [{_SPACES}]|[{_SPACES}] ")


def chunks(text: str) -> list[str]:
    """The text cut at its single spaces between other characters."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


class Aligner:
    """Ids and byte ranges of both tokenizers for chunks of text, each with a space before it."""

    def __init__(self, path_a: str, path_b: str, pattern: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        rest = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.bytes_a = [b""] * (max(spec["model"]["vocab"].values(), default=0) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token)
        self.fast_a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={self.bytes_a[i]: i for i in vocab.values()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b, marks = [], "\u2581"
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_control(i) or self.b.is_unknown(i):
                self.bytes_b.append(b"")  # never equal to any text
            elif self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            else:
                if marks in piece.lstrip(marks):
                    raise ValueError(f"piece {piece!r} goes on behind a space: texts cannot be aligned in chunks")
                self.bytes_b.append(piece.replace(marks, " ").encode())
        self.size_b = len(self.bytes_b)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.text_a = np.array([str(i) for i in range(len(self.bytes_a))], object)
        self.text_b = np.array([str(i) for i in range(self.size_b)], object)
        self.known: dict[str, tuple | None] = {}

    def _ids(self, listed: list[str]) -> tuple[list, list]:
        one, encode = self.fast_a.encode_ordinary, self.a.encode
        ids_a = [one(" " + c) if max(c) < STABLE else encode(" " + c, add_special_tokens=False).ids for c in listed]
        return ids_a, self.b.encode(listed, num_threads=1)

    def _exact(self, ids: list, table: list[bytes], listed: list[str]) -> list[bool]:
        wanted = [(" " + c).encode() for c in listed]
        made = [b"".join([table[i] for i in x]) for x in ids]
        return [x == y for x, y in zip(made, wanted)]

    def learn(self, listed: list[str]) -> None:
        """Remember (n_a, n_b, n_groups, pairs, groups) of each chunk; None where a tokenizer changes its bytes."""
        ids_a, ids_b = self._ids(listed)
        fine = [x and y for x, y in zip(self._exact(ids_a, self.bytes_a, listed), self._exact(ids_b, self.bytes_b, listed))]
        self.known.update((c, None) for c, f in zip(listed, fine) if not f)
        listed = [c for c, f in zip(listed, fine) if f]
        if not listed:
            return
        ids_a, ids_b = [x for x, f in zip(ids_a, fine) if f], [x for x, f in zip(ids_b, fine) if f]
        n_a, n_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
        a, b = np.fromiter(chain.from_iterable(ids_a), np.int64, n_a.sum()), np.fromiter(chain.from_iterable(ids_b), np.int64, n_b.sum())
        end_a, end_b = self.length_a[a].cumsum(), self.length_b[b].cumsum()
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = cuts.searchsorted(end_a), cuts.searchsorted(end_b)  # group of each token
        n_groups = np.diff(of_a[n_a.cumsum() - 1] + 1, prepend=0)
        # links: tokens of b that begin before a token of a ends and end after it begins
        low, high = end_b.searchsorted(end_a - self.length_a[a], "right"), (end_b - self.length_b[b]).searchsorted(end_a, "left")
        n = high - low
        right = np.arange(n.sum()) - np.repeat(n.cumsum() - n - low, n)
        pairs = (np.repeat(a, n) * self.size_b + b[right]).astype(np.int64)
        at = np.concatenate([[0], n.cumsum()[n_a.cumsum() - 1]]).tolist()
        # groups as text: ids of a, a bar, ids of b, a semicolon; a line for each chunk
        last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
        mark_a, mark_b = last_a.astype(np.int64), last_b * 2
        mark_b[n_b.cumsum() - 1] = 3
        order = np.argsort(np.concatenate([of_a * 2, of_b * 2 + 1]), kind="stable")
        parts = np.empty(2 * len(order), object)
        parts[::2] = np.concatenate([self.text_a[a], self.text_b[b]])[order]
        parts[1::2] = np.array([",", "|", ";", "\n"], object)[np.concatenate([mark_a, mark_b])[order]]
        groups = "".join(parts.tolist()).split("\n")
        for k, values in enumerate(zip(listed, n_a.tolist(), n_b.tolist(), n_groups.tolist(), groups)):
            self.known[values[0]] = (*values[1:4], pairs[at[k] : at[k + 1]].tobytes(), values[4])

    def align(self, texts: list[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, pairs, groups) of each text."""
        cut = [chunks(t) for t in texts]
        if len(self.known) > CACHE_CHUNKS:
            self.known.clear()
        new = list(set(chain.from_iterable(cut)).difference(self.known))
        for at in range(0, len(new), 20_000):
            self.learn(new[at : at + 20_000])
        out = []
        for listed in cut:
            held = list(map(self.known.__getitem__, listed))
            if None in held:
                out.append(None)
            else:
                a, b, g, pairs, groups = zip(*held)
                out.append((sum(a), sum(b), sum(g), b"".join(pairs), ";".join(groups)))
        return out


@lru_cache(1)
def load(path_a: str, path_b: str, pattern: str) -> Aligner:
    """Both vocabularies, once per Python worker."""
    return Aligner(path_a, path_b, pattern)


_BLOCK = "block long, codes binary, links binary, n binary, times binary, digest array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, groups array<string>"
_MEASURES = "digest string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _schema(ddl: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds |= {f"array<{name}>": pa.list_(kind) for name, kind in kinds.items()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(", "))])


def align_texts(texts: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """Blocks of aligned distinct texts (text, times, digest), one row each."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        aligner = load(path_a, path_b, pattern)
        schema = _schema(_BLOCK)
        number = TaskContext.get().partitionId() << 32

        def row(number, held):
            found = aligner.align([t for t, _, _ in held])
            rows = [(f, times, digest) for f, (_, times, digest) in zip(found, held) if f]
            pairs = [np.frombuffer(f[3], np.int64) for f, _, _ in rows]
            codes, local = np.unique(np.concatenate(pairs or [np.zeros(0, np.int64)]), return_inverse=True)
            n, times = np.array([len(p) for p in pairs], np.int64), np.array([t for _, t, _ in rows], np.int64)
            shas = [hashlib.sha256(f[4].encode()).hexdigest() for f, _, _ in rows]
            own = [number, codes.tobytes(), pack(local.astype(np.int32)), n.tobytes(), times.tobytes(), [d for _, _, d in rows], *[[f[k] for f, _, _ in rows] for k in range(3)], shas]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(own, schema)], schema=schema)

        held, chars = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for one in zip(*[part.column(c).to_pylist() for c in ("text", "times", "digest")]):
                    held.append(one)
                    chars += len(one[0])
                    if chars >= BLOCK_CHARS:
                        yield row(number, held)
                        number, held, chars = number + 1, [], 0
        if held:
            yield row(number, held)

    return texts.select("text", "times", "digest").mapInArrow(run, _BLOCK)


def _weighted(local: np.ndarray, n: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
    """How many links hold each pair of a block, every text counted as often as it occurs."""
    weights = np.repeat(times, n)
    if float(len(local)) * float(times.max(initial=0)) < 2.0**53:
        return np.bincount(local, weights, size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, local, weights)
    return out


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """(code, links, best) of all pairs; code is the first id times ``size_b`` plus the second."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for codes, links, n, times in zip(*[batch.column(c).to_pylist() for c in ("codes", "links", "n", "times")]):
                codes = np.frombuffer(codes, np.int64)
                counted = _weighted(unpack(links), np.frombuffer(n, np.int64), np.frombuffer(times, np.int64), len(codes))
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counted)], names=["code", "links"])

    counted = blocks.select("codes", "links", "n", "times").mapInArrow(run, "code long, links long").groupBy("code").agg(F.sum("links").alias("links"))
    counted = stage(counted, "pair-counts")
    highest = counted.groupBy(F.expr(f"code % {size_b}").alias("_b")).agg(F.max("links").alias("_top"))
    joined = counted.withColumn("_b", F.expr(f"code % {size_b}")).join(highest, "_b")
    return joined.select("code", "links", (F.col("links") == F.col("_top")).alias("best"))


def _measure(row: dict, codes: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """The rows of a block's texts; ``codes`` is sorted and holds all pairs of the block."""
    import pyarrow as pa

    place = codes.searchsorted(np.frombuffer(row["codes"], np.int64))
    local, n = unpack(row["links"]), np.frombuffer(row["n"], np.int64)
    ends = np.concatenate([[0], n.cumsum()])
    summed = np.concatenate([[0], counts[place][local].cumsum()]) if len(local) else np.zeros(1, np.int64)
    chosen = np.concatenate([[0], best[place][local].astype(np.int64).cumsum()]) if len(local) else np.zeros(1, np.int64)
    columns = [row["digest"], row["n_a"], row["n_b"], row["n_groups"], n, chosen[ends[1:]] - chosen[ends[:-1]], summed[ends[1:]] - summed[ends[:-1]], row["groups"]]
    schema = _schema(_MEASURES)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def measures(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row of measures per distinct text."""
    pairs = stage(pairs, "pairs")
    if pairs.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        table = pairs.orderBy("code").toArrow()  # at most BROADCAST_PAIRS rows
        sent = pairs.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("code", "links", "best")))

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    yield from _measure(row, *sent.value).to_batches()

        return blocks.mapInArrow(run, _MEASURES)

    def codes(batches):
        import pyarrow as pa

        for batch in batches:
            for number, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                listed = np.frombuffer(held, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(listed), number)), pa.array(listed)], names=["to", "code"])

    def both(rows, held):
        import pyarrow as pa

        held = held.sort_by("code")
        columns = [held.column(c).to_numpy() for c in ("code", "links", "best")]
        made = [_measure(row, *columns) for row in rows.to_pylist()]
        return pa.concat_tables(made)

    needed = blocks.select("block", "codes").mapInArrow(codes, "to long, code long").join(pairs, "code")
    return blocks.groupBy("block").cogroup(needed.groupBy("to")).applyInArrow(both, _MEASURES)


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    distinct = rows.where("text is not null and text <> ''").groupBy("text").agg(F.count("*").alias("times"))
    blocks = stage(align_texts(distinct.withColumn("digest", F.sha2("text", 256)), path_a, path_b, pattern), "aligned")
    found = measures(blocks, pair_counts(blocks, size_b))
    joined = rows.select("id", F.sha2("text", 256).alias("digest")).join(found, "digest", "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return joined.select(F.col("id").alias(key), *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op11_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return align(docs, vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model"), vocabularies.PATTERN)
