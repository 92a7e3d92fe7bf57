"""Phrase collocations from count streams kept in prefix and in suffix order.

The corpus is cut into blocks of bounded size, each a stream of numbers: the id of the
frequent n-gram that starts at each place, 0 for none.  A frequent (n+1)-gram is a pair of
frequent n-grams that start at neighbouring places, so the same three steps serve every
order: count the pairs of all blocks, number the pairs that are frequent, and give the
numbers back to the blocks.  Ids stand for exact phrases; nothing is decided by a hash.

The counts of order n are a table (id, left, right, f): ``left`` is the id of its first
n-1 words, ``right`` of its last n-1 words.  Sorted by ``left`` it is in prefix order,
sorted by ``right`` in suffix order; two sort-merge joins with the table below carry the
counts of all first and last parts upwards, and the largest counts of both orders are the
extension counts.

Only pairs of words that are frequent themselves are shuffled, summed over runs of blocks
before; a key that holds a third of all rows is one row per block at most.  The first rows of a
language come from its best rows of each of ``PARTS`` parts.

Null and empty texts have no words; a null language counts as ``und``.  Texts are never cut,
whatever their length.  Repeated rows count as often as they occur.  An empty table gives no
rows.  Other columns are not read.  Equal scores are ordered by count, then by phrase.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, documents
from tessera.session import remove_stage, stage, stage_path, write_stage

#: Least count of a phrase, its longest form in words, rows of a language, and the share in percent at which a longer phrase covers one.
MIN_COUNT, LONGEST, FIRST, COVERED = 30, 4, 2000, 80
#: Characters of text in a block, rows of a table that is broadcast, and parts of a language that are ranked on their own.
BLOCK_CHARS, BROADCAST_ROWS, PARTS = 4_000_000, 1_000_000, 64
#: Rows of an Arrow batch, and pairs that a task sums before it sends them on.
BATCH, RUN_PAIRS = 50_000, 1_500_000
_BREAKS = ".,;:!?\n\x0b\x0c\r"
_TOKEN = re.compile(r"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+")
_BLOCK = "block long, cur binary, ids binary"


def pack(cur: np.ndarray) -> bytes:
    """A stream of 32-bit numbers with like bytes side by side, compressed: its length, then the bytes."""
    import pyarrow as pa

    planes = np.ascontiguousarray(cur.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(cur).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    import pyarrow as pa

    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).reshape(-1).view("<i4")


class _Ids(dict):
    """Numbers of the words of one language in a block, given when first asked for."""

    def __init__(self, found: list) -> None:
        super().__init__((c, 0) for c in _BREAKS)
        self.found = found

    def __missing__(self, word: str) -> int:
        self.found.append(word)
        self[word] = number = len(self.found)
        return number


class _Block:
    """Words of consecutive texts as numbers, 0 between the pieces."""

    def __init__(self) -> None:
        self.found: list[str] = []
        self.langs: dict[str, _Ids] = {}
        self.first: dict[str, list[tuple[int, int]]] = {}
        self.parts: list[np.ndarray] = []
        self.chars = 0
        self.of: list[str] = []

    def add(self, lang: str, text: str) -> None:
        ids = self.langs.get(lang)
        if ids is None:
            ids = self.langs[lang] = _Ids(self.found)
        listed = _TOKEN.findall(ascii_lower(text))
        self.parts.append(np.fromiter(map(ids.__getitem__, listed), np.int32, len(listed)))
        self.parts.append(np.zeros(1, np.int32))
        self.of.extend([lang] * (len(self.found) - len(self.of)))
        self.chars += len(text)

    def rows(self, number: int):
        """The block itself and one row for each of its words."""
        import pyarrow as pa

        cur = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        n = len(self.found)
        counts = np.bincount(cur, minlength=n + 1)[1:]
        names = ["block", "cur", "lang", "word", "local", "n"]
        kinds = [pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int32(), pa.int64()]
        own = [[number], [pack(cur)], [None], [None], [None], [None]]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(own, kinds)], names=names)
        step = BATCH
        for at in range(0, n, step):
            to = min(n, at + step)
            listed = [
                pa.array(np.full(to - at, number)), pa.nulls(to - at, pa.binary()), pa.array(self.of[at:to], pa.string()),
                pa.array(self.found[at:to], pa.string()), pa.array(np.arange(at + 1, to + 1, dtype=np.int32)), pa.array(counts[at:to].astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(listed, names=names)


def _numbered(docs: DataFrame) -> DataFrame:
    """Blocks of local word numbers, and their words: (block, cur, lang, word, local, n) of (lang, text)."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    block.add(lang, text)
                    if block.chars >= BLOCK_CHARS:
                        yield from block.rows(number)
                        number, block = number + 1, _Block()
        if block.parts:
            yield from block.rows(number)

    return docs.mapInArrow(run, "block long, cur binary, lang string, word string, local int, n long")


def squeeze(cur: np.ndarray) -> np.ndarray:
    """The stream without places that no longer phrase can use: repeated zeros and numbers between two zeros."""
    wide = np.concatenate([np.zeros(1, cur.dtype), cur, np.zeros(1, cur.dtype)])
    alone = (wide[:-2] == 0) & (wide[2:] == 0)
    cur = np.where(alone, 0, cur)
    return cur[np.concatenate([cur[:1] > 0, (cur[1:] > 0) | (cur[:-1] > 0)])] if len(cur) else cur


def neighbours(cur: np.ndarray, ids: np.ndarray):
    """Distinct pairs of neighbouring n-grams: ids of both, how often they occur, where, and which of them at each place."""
    a = cur.astype(np.int64)
    at = np.flatnonzero((a[:-1] > 0) & (a[1:] > 0)) if len(a) > 1 else np.zeros(0, np.int64)
    width = len(ids) + 1
    key, which, n = np.unique(a[at] * width + a[at + 1], return_inverse=True, return_counts=True)
    return ids[key // width - 1], ids[key % width - 1], n, at, which


def merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of several blocks with their counts added up, sorted."""
    left, right, n = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((right, left))
    left, right, n = left[order], right[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
    return left[first], right[first], np.add.reduceat(n, first)


def _streams(batches):
    for batch in batches:
        for number, cur, ids in zip(*[batch.column(c) for c in ("block", "cur", "ids")]):
            yield number.as_py(), *neighbours(unpack(cur.as_py()), np.frombuffer(ids.as_py(), np.int64))


def _pair_counts(blocks: DataFrame) -> DataFrame:
    """(left, right, n), summed over runs of blocks before they are shuffled."""

    def run(batches):
        import pyarrow as pa

        def out(parts):
            listed = merged(parts)
            for at in range(0, len(listed[0]), BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + BATCH]) for c in listed], names=["left", "right", "n"])

        held, size = [], 0
        for _, left, right, n, _, _ in _streams(batches):
            if len(n):
                held.append((left, right, n.astype(np.int64)))
                size += len(n)
            if size >= RUN_PAIRS:
                yield from out(held)
                held, size = [], 0
        if held:
            yield from out(held)

    return blocks.mapInArrow(run, "left long, right long, n long")


def _pair_places(blocks: DataFrame) -> DataFrame:
    """(block, local, left, right): the distinct pairs of each block, numbered."""

    def run(batches):
        import pyarrow as pa

        for number, left, right, *_ in _streams(batches):
            for at in range(0, len(left), BATCH):
                l, r = left[at : at + BATCH], right[at : at + BATCH]
                local = pa.array(np.arange(at, at + len(l), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(l), number)), local, pa.array(l), pa.array(r)], names=["block", "local", "left", "right"])

    return blocks.mapInArrow(run, "block long, local int, left long, right long")


def _hint(df: DataFrame) -> DataFrame:
    """Broadcast a counted table of few rows; a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _renumber(blocks: DataFrame, given: DataFrame, place) -> DataFrame:
    """Blocks with the numbers of ``given`` (block, local, id) in place of their own; ``place`` finds the local number at each place."""

    def run(block, rows):
        import pyarrow as pa

        out = [[], [], []]
        local, ids = rows.column("local").to_numpy(), rows.column("id").to_numpy()
        for number, cur, own in zip(*[block.column(c).to_pylist() for c in ("block", "cur", "ids")]):
            now = squeeze(place(unpack(cur), np.frombuffer(own or b"", np.int64), local))
            out[0].append(number)
            out[1].append(pack(now))
            out[2].append(ids.tobytes())
        return pa.table({"block": pa.array(out[0], pa.int64()), "cur": pa.array(out[1], pa.binary()), "ids": pa.array(out[2], pa.binary())})

    return blocks.groupBy("block").cogroup(given.withColumnRenamed("block", "to").groupBy("to")).applyInArrow(run, _BLOCK)


def _place_words(cur: np.ndarray, own: np.ndarray, local: np.ndarray) -> np.ndarray:
    new = np.zeros(int(max(cur.max(initial=0), local.max(initial=0))) + 1, np.int32)
    new[local] = np.arange(1, len(local) + 1)
    return new[cur]


def _place_pairs(cur: np.ndarray, own: np.ndarray, local: np.ndarray) -> np.ndarray:
    *_, n, at, which = neighbours(cur, own)
    new = np.zeros(len(n), np.int32)
    new[local] = np.arange(1, len(local) + 1)
    out = np.zeros(len(cur), np.int32)
    out[at] = new[which]
    return out


def count_streams(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = MIN_COUNT, longest: int = LONGEST):
    """Tables of the frequent n-grams of each order, and the word count of each language.

    The first table is (id, lang, word, f), the further ones (id, left, right, f).
    """
    spark = docs.sparkSession
    gone: list[str] = []

    def keep(df: DataFrame, name: str, passing: bool = False) -> DataFrame:
        path = stage_path(spark, name)
        if passing:
            gone.append(path)
        return write_stage(df, path)

    def forget() -> None:
        remove_stage(spark, gone.pop(0))

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = keep(_numbered(rows), "phrase-words", True)
    words = found.where("word is not null")
    totals = keep(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    counted = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    table = keep(counted.select(F.monotonically_increasing_id().alias("id"), "lang", "word", "f"), "phrase-1")
    given = words.join(_hint(table.select("lang", "word", "id")), ["lang", "word"]).select("block", "local", "id")
    first = found.where("cur is not null").select("block", "cur", F.lit(None).cast("binary").alias("ids"))
    blocks = keep(_renumber(first, given, _place_words), "phrase-blocks", True)
    forget()
    tables = [table]
    for order in range(2, longest + 1):
        counted = _pair_counts(blocks).groupBy("left", "right").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        table = keep(counted.select(F.monotonically_increasing_id().alias("id"), "left", "right", "f"), f"phrase-{order}")
        tables.append(table)
        if order < longest:
            given = _pair_places(blocks).join(_hint(table.select("left", "right", "id")), ["left", "right"]).select("block", "local", "id")
            blocks = keep(_renumber(blocks, given, _place_pairs), "phrase-blocks", True)
            forget()
    forget()
    return tables, totals


def _above(below: DataFrame, table: DataFrame) -> DataFrame:
    """The phrases of the next order with the counts of their first and last parts, by one merge join in each order."""
    prefix = below.select(F.col("id").alias("left"), "lang", "words", F.concat("firsts", F.array("f")).alias("firsts"))
    suffix = below.select(F.col("id").alias("right"), F.element_at("words", -1).alias("_last"), F.concat("lasts", F.array("f")).alias("lasts"))
    joined = table.join(prefix.hint("merge"), "left").join(suffix.hint("merge"), "right")
    return joined.select("id", "lang", F.concat("words", F.array("_last")).alias("words"), "f", "firsts", "lasts")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = MIN_COUNT, first: int = FIRST, covered: int = COVERED
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first phrases of each language."""
    tables, totals = count_streams(docs, lang, text, least)
    none = F.array().cast("array<long>")
    below = tables[0].select("id", "lang", F.array("word").alias("words"), "f", none.alias("firsts"), none.alias("lasts"))
    listed = None
    for order, table in enumerate(tables[1:], 2):
        below = stage(_above(below, table), "phrase-parts")  # read by its own rows and both joins of the next order
        rows = below.withColumn("order", F.lit(order))
        if order < len(tables):
            longer = tables[order]
            both = longer.select(F.col("left").alias("id"), "f").union(longer.select(F.col("right").alias("id"), "f"))
            extension = both.groupBy("id").agg(F.max("f").alias("_most"))
            rows = rows.join(extension.hint("merge"), "id", "left").where(F.coalesce(F.col("_most"), F.lit(0)).cast("decimal(25,0)") * 100 < F.col("f").cast("decimal(25,0)") * covered).drop("_most")
        listed = rows if listed is None else listed.unionByName(rows)

    def cut(k):
        l, r = F.element_at("firsts", k), F.element_at("lasts", F.col("order") - k)
        return F.struct(l.alias("l"), r.alias("r"), k.alias("k"))

    cuts = listed.withColumn("cuts", F.transform(F.sequence(F.lit(1), F.col("order") - 1), cut))
    score = "transform(cuts, c -> named_struct('score', cast(cast(2000000 as decimal(7,0)) * cast(f as decimal(20,0)) div (cast(c.l as decimal(20,0)) + cast(c.r as decimal(20,0))) as long), 'k', c.k, 'l', c.l, 'r', c.r))"
    scored = cuts.withColumn("_c", F.array_min(F.expr(score))).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.col("_c.l").alias("l"), F.col("_c.r").alias("r"), F.col("_c.score").alias("score")
    )
    order_by = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = scored.withColumn("_part", part).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order_by)))
    best = best.where(F.col("_r") <= first).drop("_r", "_part")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by)).cast("long"))
    out = ranked.where(F.col("rank") <= first).join(F.broadcast(totals) if totals.limit(10_001).count() <= 10_000 else totals, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir).select("lang", "text"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS listed
  FROM documents
), lists AS (SELECT lang, regexp_extract_all(unnest(listed), '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (VALUES (1), (2), (3), (4)) AS o(k))
), counted AS (SELECT lang, g, len(g) AS k, count(*) AS f FROM grams GROUP BY lang, g),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE f >= 30),
longer AS (
  SELECT lang, g, max(f) AS m FROM (
    SELECT lang, list_slice(g, 1, k - 1) AS g, f FROM frequent WHERE k > 2
    UNION ALL SELECT lang, list_slice(g, 2, k) AS g, f FROM frequent WHERE k > 2
  ) GROUP BY lang, g
), open AS (
  SELECT c.* FROM frequent c LEFT JOIN longer x ON c.lang = x.lang AND c.g = x.g
  WHERE c.k > 1 AND (x.m IS NULL OR 100 * x.m < 80 * c.f)
), cuts AS (
  SELECT lang, g, k, f, c, list_slice(g, 1, c) AS gl, list_slice(g, c + 1, k) AS gr
  FROM (SELECT *, unnest(range(1, k)) AS c FROM open)
), scored AS (
  SELECT c.lang, c.g, c.c, c.f AS a, x.f AS l, y.f AS r, CAST((2000000 * c.f::HUGEINT) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.g = c.gl JOIN frequent y ON y.lang = c.lang AND y.g = c.gr
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM lowest
)
SELECT s.lang, rank, phrase, a, l, r, n, score FROM ranked s JOIN totals t ON s.lang = t.lang WHERE rank <= 2000
"""
