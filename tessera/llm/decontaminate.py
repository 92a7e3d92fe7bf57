"""Benchmark decontamination with suffix arrays over shards of the training text.

Each Arrow batch of documents is a shard.  Its suffixes and the benchmark's are ranked by prefixes that grow by one word up to a window; the suffixes of the shard sorted
by rank are its suffix array, searched by bisection for every benchmark suffix.  At each
depth only training suffixes whose rank some benchmark suffix shares stay, as the others
cannot reach a whole window.  Longest matches are the unions of overlapping windows.

A window is ``window`` consecutive words of an item; a shorter item is one window.  Null
and empty texts have no words and no hits; items without words match nothing; an empty
benchmark marks nothing.  Repeated items are each reported.

The benchmark is the query set: it is sent in blocks of at most ``block_words`` words
(one item at least), each held against all documents.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import add_columns, ascii_lower, documents

WINDOW = 10
BLOCK_WORDS = 2_000_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text: str | None) -> list[str]:
    return _WORD.findall(ascii_lower(text)) if text else []


class Searcher:
    """One block of benchmark items, ready to be held against shards."""

    def __init__(self, items: list[tuple], window: int = WINDOW) -> None:
        self.window = window
        listed = [(i, w) for i, t in items if (w := item_words(t))]
        self.ids = [i for i, _ in listed]
        self.vocab: dict[str, int] = {}
        put = self.vocab.setdefault
        codes = [[put(w, len(self.vocab) + 1) for w in ws] for _, ws in listed]
        self.codes = np.concatenate([np.array([*c, 0], np.int64) for c in codes]) if codes else np.zeros(0, np.int64)
        starts, items_of, lengths = [], [], []
        at = 0
        for k, c in enumerate(codes):
            length = min(window, len(c))
            n = len(c) - length + 1
            starts.append(np.arange(at, at + n))
            items_of.append(np.full(n, k))
            lengths.append(np.full(n, length))
            at += len(c) + 1
        empty = np.zeros(0, np.int64)
        self.starts = np.concatenate(starts) if starts else empty
        self.items = np.concatenate(items_of) if starts else empty
        self.lengths = np.concatenate(lengths) if starts else empty

    def matches(self, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (position in the shard, window number) of every occurrence of a window."""
        found_at, found_window = [], []
        for length in np.unique(self.lengths):
            which = np.flatnonzero(self.lengths == length)
            queries = self.starts[which]
            at = np.flatnonzero(shard > 0)
            at = at[at + length <= len(shard)]
            rank_at, rank_query = shard[at], self.codes[queries]
            depth = 1
            while depth < length and len(at):  # extend the compared prefix, one rank for each distinct prefix
                tail_at, tail_query = shard[at + depth], self.codes[queries + depth]
                keep = tail_at > 0
                at, rank_at, tail_at = at[keep], rank_at[keep], tail_at[keep]
                base = len(self.vocab) + 1
                key_query, key_at = rank_query * base + tail_query, rank_at * base + tail_at
                distinct, rank_query = np.unique(key_query, return_inverse=True)
                place = np.minimum(np.searchsorted(distinct, key_at), len(distinct) - 1)
                keep = distinct[place] == key_at
                at, rank_at = at[keep], place[keep]
                depth += 1
            if not len(at):
                continue
            order = np.argsort(rank_at, kind="stable")  # the suffix array of the shard, by rank
            array, ranks = at[order], rank_at[order]
            low, high = np.searchsorted(ranks, rank_query, "left"), np.searchsorted(ranks, rank_query, "right")
            count = high - low
            first = np.repeat(low, count)
            within = np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
            found_at.append(array[first + within])
            found_window.append(np.repeat(which, count))
        empty = np.zeros(0, np.int64)
        return (np.concatenate(found_at), np.concatenate(found_window)) if found_at else (empty, empty)

    def scan(self, texts: list) -> list[tuple[int, list, list]]:
        """Per text: number of words, covered spans [from, to) in word positions, and items."""
        known = self.vocab.get
        parts, sizes = [], []
        for text in texts:
            codes = [known(w, 0) for w in item_words(text)]
            sizes.append(len(codes))
            parts.append(np.array([*codes, 0], np.int64))
        shard = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        bounds = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)]).astype(np.int64)
        at, window = self.matches(shard)
        out: list[tuple[int, list, list]] = [(n, [], []) for n in sizes]
        order = np.argsort(at, kind="stable")
        at, window = at[order], window[order]
        doc = np.searchsorted(bounds, at, "right") - 1
        for d, lo, hi in zip(*_groups(doc)):
            begin = at[lo:hi] - bounds[d]
            end = begin + self.lengths[window[lo:hi]]
            items = [self.ids[i] for i in np.unique(self.items[window[lo:hi]])]
            out[d] = (sizes[d], _spans(begin, end), items)
        return out


def _groups(doc: np.ndarray) -> tuple[list, list, list]:
    ids, first = np.unique(doc, return_index=True)
    return ids.tolist(), first.tolist(), [*first[1:].tolist(), len(doc)]


def _spans(begin: np.ndarray, end: np.ndarray) -> list[list[int]]:
    """Union of half-open spans given in order of their begin."""
    spans: list[list[int]] = []
    for b, e in zip(begin.tolist(), end.tolist()):
        if spans and b <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([b, e])
    return spans


def _blocks(benchmark: DataFrame, item: str, text: str, block_words: int):
    """Items in blocks of bounded size, fetched one partition at a time."""
    block, size = [], 0
    for row in benchmark.select(item, text).toLocalIterator():
        n = len(item_words(row[1]))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        if n:
            block.append((row[0], row[1]))
            size += n
    yield block


def scan(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (word positions covered by windows) and ``hit_items``."""
    item_type = benchmark.schema[item].dataType.simpleString()
    added = f"n_words long, hit_spans array<array<long>>, hit_items array<{item_type}>"
    result = docs
    for number, block in enumerate(_blocks(benchmark, item, text, block_words)):
        sent = docs.sparkSession.sparkContext.broadcast((block, window))

        def make(sent=sent):
            return Searcher(*sent.value).scan

        if not number:
            result = add_columns(docs, added, make, text)
        else:
            names = ("_n", "_spans", "_items")
            further = f"_n long, _spans array<array<long>>, _items array<{item_type}>"
            result = (
                add_columns(result, further, make, text)
                .withColumn("hit_spans", F.concat("hit_spans", "_spans"))
                .withColumn("hit_items", F.concat("hit_items", "_items"))
                .drop(*names)
            )
    return result


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents in which no window of the benchmark occurs, with their own columns."""
    kept = docs.select("*", F.struct("*").alias("_own"))
    found = scan(kept, benchmark, **options).where(F.size("hit_spans") == 0)
    return found.select("_own.*")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = scan(documents(spark, sf_dir).select("doc_id", "text"), benchmark)

    def make():
        def digest(spans: list, items: list) -> list[tuple]:
            rows = []
            for s, i in zip(spans, items):
                hit = sum(e - b for b, e in _spans(*map(np.array, zip(*sorted(s))))) if s else 0
                ids = ",".join(sorted(str(x) for x in i))
                rows.append((hit, len(i), hashlib.sha256(ids.encode()).hexdigest(), hit > 0))
            return rows

        return digest

    added = "n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return add_columns(found.select("doc_id", "n_words", "hit_spans", "hit_items"), added, make, "hit_spans", "hit_items").drop(
        "hit_spans", "hit_items"
    )
