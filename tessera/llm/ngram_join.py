"""Exact Jaccard join of word n-gram sets that skips by the relations between sets.

1.  Equal sets are one node.  In one order of all shingles, the seldom ones first, two sets
    that reach the threshold share a shingle of their prefixes, the first
    n - ceil(threshold * n) + 1 shingles.  The order comes from a sketch of counters of fixed
    size over all documents; it decides the cost, never the result.
2.  Skipping in the index: the list of a prefix shingle is cut into blocks of equal set size
    and place of the shingle.  Size and place bound the overlap a block can have with another,
    so whole blocks are joined or skipped before any member is looked at.  A parity signature
    of each set bounds the difference of the distinct pairs that are left.
3.  Skipping of answers: in a few rounds each list elects a leader among the sets that no
    leader answered yet, the smallest node of its fullest block.  The other sets are compared
    with the leader on their full shingles; one that is near it keeps the difference.  Within
    such a family two sets are compared by their differences alone, and only if the prefixes
    of the differences, ordered by their counts inside the family, meet.  A copy group of any
    size costs its members and their differences, not its pairs.
4.  Sets of a list that have no leader in common are joined, pairs in different components
    only.  If both ends have a difference to one leader the pair is decided from
    these, else on the full sets.

Family pairs lose nothing: if the differences of y and z from x are disjoint and y and z link,
then both link with x.

Null and empty texts and texts without words have no shingles, link with nothing and are
their own component; a text of fewer words than a shingle is one shingle, the whole
sequence.  Texts are never cut.  Each row is one row of the result; repeated rows have equal
sets, so one component, also where a repeated id has different texts: every text is linked on
its own.  A null id takes the smallest id of its component, null if there is none.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import add_columns, documents
from tessera.llm.components import components
from tessera.session import stage

SHINGLE, THRESHOLD = 3, 90
#: Counters of the sketch, shingles a task sorts at once for it, and longs of a signature.
COUNTERS, RUN, LONGS = 1 << 20, 2_000_000, 16
#: How much less similar than a link an answer may be, in percent; rounds of leaders; lists with fewer open sets elect none.
NEAR, ROUNDS, OPEN = 10, 3, 8
#: Words whose hashes a task remembers.
WORDS = 400_000
#: Sets whose texts are fetched by sending their ids to every task; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = hashed = xxhash.xxh3_64_intdigest(word)
        return hashed


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of one text after another."""

    def __init__(self, size: int) -> None:
        self.size, self.known = size, _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        listed = text.encode().lower().split() if text else []  # of bytes: A-Z and the white space of the contract only
        if len(listed) < self.size:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(listed))] if listed else [], np.uint64)
        if len(self.known) > WORDS:
            self.known.clear()
        codes = np.fromiter(map(self.known.__getitem__, listed), np.uint64, len(listed))
        mixed = np.zeros(len(listed) - self.size + 1, np.uint64)
        for k in range(self.size):
            mixed = (mixed + codes[k : k + len(mixed)]) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        mixed.sort()
        return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def _sketch(rows: DataFrame, size: int) -> np.ndarray:
    """Counters of the shingles that occur in several texts of a run, over all texts."""

    def run(batches):
        import pyarrow as pa

        def out(parts):
            key, n = np.unique(np.concatenate(parts), return_counts=True)
            key, n = key[n > 1] >> np.uint64(44), n[n > 1]
            at, first = np.unique(key, return_index=True)
            return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(np.add.reduceat(n, first).astype(np.int64) if len(n) else n)], names=["at", "n"])

        parts, held, shingles = [], 0, Shingler(size)
        for batch in batches:
            for text in batch.column(0):
                parts.append(shingles(text.as_py()))
                held += len(parts[-1])
                if held >= RUN:
                    yield out(parts)
                    parts, held = [], 0
        if parts:
            yield out(parts)

    counted = rows.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # COUNTERS rows at most
    sketch = np.zeros(COUNTERS, np.int64)
    sketch[counted.column("at").to_numpy()] = counted.column("n").to_numpy()
    return np.minimum(sketch, 2**31 - 1).astype(np.int32)


def prefix(hashed: np.ndarray, sketch: np.ndarray, threshold: int) -> np.ndarray:
    """The first shingles of a set in the common order, of which any set that reaches the threshold shares one."""
    n = len(hashed)
    order = np.argsort(sketch[hashed >> np.uint64(44)], kind="stable")
    return hashed[order[: n - -(-threshold * n // 100) + 1]]


def signature(hashed: np.ndarray) -> np.ndarray:
    """Parity of the set's shingles in 64 * LONGS places: two sets differ in no more places than shingles."""
    bits = np.bincount((hashed % np.uint64(64 * LONGS)).astype(np.int64), minlength=64 * LONGS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _prefixes(rows: DataFrame, sketch: np.ndarray, size: int, threshold: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(sketch)  # COUNTERS numbers of 4 bytes

    def make():
        shingles = Shingler(size)

        def each(texts):
            out = []
            for text in texts:
                hashed = shingles(text)
                n = len(hashed)
                out.append((n, xxhash.xxh3_128_digest(hashed.tobytes()) if n else None, prefix(hashed, sent.value, threshold).tobytes() if n else None, signature(hashed).tolist()))
            return out

        return each

    added = add_columns(rows, "size long, digest binary, prefix binary, sig array<long>", make, "text")
    return added.select("id", "size", "digest", "prefix", "sig")


def _index(nodes: DataFrame) -> DataFrame:
    """(node, token, place) of the prefixes."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for node, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = np.frombuffer(held, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), node)), pa.array(tokens), pa.array(np.arange(len(tokens), dtype=np.int32))], names=["node", "token", "place"])

    return nodes.select("node", "prefix").mapInArrow(run, "node long, token long, place int")


def _few(a: str, b: str, n: str, m: str, threshold: int):
    """True where the signatures leave room for sets of sizes n and m to reach the threshold."""
    apart = sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(LONGS)), F.lit(0))
    return apart * (100 + threshold) <= (F.col(n) + F.col(m)) * (100 - threshold)


class _Sets:
    """Full sets of nodes, fetched from the documents when they are compared."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, size: int) -> None:
        self.rows, self.nodes, self.size = rows, nodes, size

    def close(self, pairs: DataFrame, near: int) -> DataFrame:
        """The pairs whose signatures leave room for the similarity ``near``."""
        first = self.nodes.select(F.col("node").alias("a"), F.col("size").alias("_n"), F.col("sig").alias("_s"))
        second = self.nodes.select(F.col("node").alias("b"), F.col("size").alias("_m"), F.col("sig").alias("_t"))
        return pairs.join(first, "a").join(second, "b").where(_few("_s", "_t", "_n", "_m", near)).select(pairs.columns)

    def compare(self, pairs: DataFrame, near: int) -> DataFrame:
        """(a, b, n, m, d): pairs (a, b) of at least the similarity ``near``, and the shingles that only one of them has."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = stage(ends.join(self.nodes.select("node", "digest", "row_id"), "node"), "wanted")
        ids = wanted.select(F.col("row_id").alias("id")).distinct()
        if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            ids = F.broadcast(ids)
        held = self.rows.join(ids, F.coalesce(self.rows["id"].cast("string"), F.lit("")) == F.coalesce(ids["id"].cast("string"), F.lit("")), "left_semi").select("text")
        size = self.size

        def make():
            shingles = Shingler(size)
            return lambda texts: [((h := shingles(t).tobytes()), xxhash.xxh3_128_digest(h)) for t in texts]

        sets = add_columns(held, "set binary, digest binary", make, "text").select("set", "digest")
        sets = stage(sets.join(wanted.select("node", "digest"), "digest").groupBy("node").agg(F.first("set").alias("set")), "sets")
        left = sets.select(F.col("node").alias("a"), F.col("set").alias("_x"))
        right = sets.select(F.col("node").alias("b"), F.col("set").alias("_y"))

        def differ():
            def each(xs, ys):
                out = []
                for x, y in zip(xs, ys):
                    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    apart = np.setxor1d(p, q, assume_unique=True)
                    close = (100 + near) * len(apart) <= (100 - near) * (len(p) + len(q))
                    out.append((len(p), len(q), apart.view(np.int64).tolist() if close else None))
                return out

            return each

        both = add_columns(pairs.select("a", "b").join(left, "a").join(right, "b"), "n long, m long, d array<long>", differ, "_x", "_y")
        return both.where("d is not null").select("a", "b", "n", "m", "d")


def _linked(answers: DataFrame, threshold: int) -> DataFrame:
    return answers.where(F.size("d") * (100 + threshold) <= (F.col("n") + F.col("m")) * (100 - threshold)).select("a", "b")


def _with_component(df: DataFrame, column: str, found: DataFrame, name: str) -> DataFrame:
    return df.join(found.select(F.col("id").alias(column), F.col("component").alias(name)), column, "left").withColumn(name, F.coalesce(name, column))


def _family_links(answers: DataFrame, found: DataFrame, threshold: int) -> DataFrame:
    """Links between members of one family that lie in different components, from their differences to the leader."""
    members = _with_component(answers.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("m").alias("n"), F.col("d")), "y", found, "c")
    mixed = members.groupBy("x").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("x")
    members = stage(members.join(mixed, "x"), "families")
    parts = members.select("x", "y", "n", "c", F.size("d").alias("e"), F.explode("d").alias("token"))
    counts = parts.groupBy("x", "token").agg(F.count("*").alias("times"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    placed = parts.join(counts, ["x", "token"]).withColumn("place", F.row_number().over(Window.partitionBy("x", "y").orderBy("times", "token")) - 1)
    # a partner has at most n * 100 / threshold shingles, so a link leaves at most `room` different ones
    room = F.floor((F.col("n") + F.col("n") * 100 / threshold) * (100 - threshold) / (100 + threshold) + 1e-6)
    placed = stage(placed.where((F.col("lo") != F.col("hi")) & (F.col("place") <= room)).drop("times", "lo", "hi"), "differences")
    left, right = placed.alias("l"), placed.alias("r")
    overlap = F.least(F.col("l.e") - F.col("l.place"), F.col("r.e") - F.col("r.place"))
    enough = 2 * overlap * (100 + threshold) >= (F.col("l.e") + F.col("r.e")) * (100 + threshold) - (F.col("l.n") + F.col("r.n")) * (100 - threshold)
    met = left.join(right, (F.col("l.x") == F.col("r.x")) & (F.col("l.token") == F.col("r.token")) & (F.col("l.c") < F.col("r.c")) & enough)
    pairs = met.select(F.col("l.x").alias("x"), F.col("l.y").alias("a"), F.col("r.y").alias("b")).distinct()
    return _derived(pairs, answers, threshold).where("linked").select("a", "b")


def _derived(pairs: DataFrame, answers: DataFrame, threshold: int) -> DataFrame:
    """Pairs (x, a, b) with ``linked`` where both differences to the leader x are known, else null."""
    first = answers.select(F.col("a").alias("x"), F.col("b").alias("a"), F.col("m").alias("_n"), F.col("d").alias("_d"))
    second = answers.select(F.col("a").alias("x"), F.col("b").alias("b"), F.col("m").alias("_m"), F.col("d").alias("_e"))
    joined = pairs.join(first, ["x", "a"], "left").join(second, ["x", "b"], "left")
    apart = F.size("_d") + F.size("_e") - 2 * F.size(F.array_intersect("_d", "_e"))
    linked = apart * (100 + threshold) <= (F.col("_n") + F.col("_m")) * (100 - threshold)
    return joined.select("x", "a", "b", F.when(F.col("_d").isNotNull() & F.col("_e").isNotNull(), linked).alias("linked"))


def _rest(index: DataFrame, answered: DataFrame, found: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b, x) in different components that may link and have no leader of a list in common; x answered b.

    The family of a list's first leader only takes part as b, so it is met by what lies outside it alone.
    """
    rows = _with_component(index, "node", found, "c")
    mixed = rows.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("token")
    rows = stage(rows.join(mixed, "token").join(answered, ["token", "node"], "left").withColumn("open", F.col("x").isNull() | (F.col("turn") > 0)), "rest")
    blocks = stage(rows.groupBy("token", "size", "place").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.max("open").alias("open")), "rest-blocks")
    p, q = blocks.where("open").alias("p"), blocks.alias("q")
    overlap = F.least(F.col("p.size") - F.col("p.place"), F.col("q.size") - F.col("q.place"))
    sizes = F.col("p.size") + F.col("q.size")
    differ = (F.col("p.lo") != F.col("p.hi")) | (F.col("q.lo") != F.col("q.hi")) | (F.col("p.lo") != F.col("q.lo"))
    room = (overlap * (100 + threshold) >= threshold * sizes) & (100 * F.least("p.size", "q.size") >= threshold * F.greatest("p.size", "q.size"))
    met = p.join(q, (F.col("p.token") == F.col("q.token")) & room & differ).select(
        F.col("p.token").alias("token"), F.col("p.size").alias("size"), F.col("p.place").alias("place"), F.col("q.size").alias("size_b"), F.col("q.place").alias("place_b")
    )
    left = rows.where("open").select("token", "size", "place", F.col("node").alias("a"), F.col("c").alias("ca"), F.col("x").alias("xa"))
    right = rows.select("token", F.col("size").alias("size_b"), F.col("place").alias("place_b"), F.col("node").alias("b"), F.col("c").alias("cb"), "x", F.col("open").alias("ob"))
    family = F.coalesce(F.col("xa") == F.col("x"), F.lit(False))
    once = (F.col("ca") != F.col("cb")) & ~family & (~F.col("ob") | (F.col("a") < F.col("b")))
    pairs = met.join(left, ["token", "size", "place"]).join(right, ["token", "size_b", "place_b"]).where(once)
    return pairs.select("a", "b", "x").distinct()


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(key, n_shingles, component_id) of every row."""
    if not 50 < threshold < 100:
        raise ValueError("the threshold must lie between 50 and 100 percent")
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    near = max(threshold - NEAR, 50)
    marked = stage(_prefixes(rows, _sketch(rows, size), size, threshold), "marked")
    nodes = marked.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("first_id"), F.first("id").alias("row_id"), F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.first("sig").alias("sig")
    )
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sets = _Sets(rows, nodes, size)

    entries = stage(_index(nodes), "entries")
    shared = entries.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    index = entries.join(shared, "token").join(nodes.select("node", "size"), "node")
    index = stage(index, "index")

    open_ = index
    answers = answered = None
    links = None
    for turn in range(ROUNDS):
        blocks = open_.groupBy("token", "size", "place").agg(F.count("*").alias("k"), F.min("node").alias("node"))
        leaders = blocks.groupBy("token").agg(F.sum("k").alias("open"), F.max(F.struct("k", (-F.col("node")).alias("o"), "size")).alias("l")).where(F.col("open") >= OPEN)
        leaders = leaders.select("token", (-F.col("l.o")).alias("x"), F.col("l.size").alias("n"))
        alike = 100 * F.least("n", "size") >= near * F.greatest("n", "size")
        tried = stage(open_.join(leaders, "token").where(alike).select("token", "x", "node"), "tried")
        pairs = tried.where("x <> node").select(F.col("x").alias("a"), F.col("node").alias("b")).distinct()
        if answers is not None:
            pairs = pairs.join(answers.select("a", "b"), ["a", "b"], "left_anti")
        pairs = stage(sets.close(pairs, near), "trials")
        if turn and pairs.isEmpty():
            break
        new = sets.compare(pairs, near)
        answers = stage(new if answers is None else answers.union(new), "answers")
        known = answers.select(F.col("a").alias("x"), F.col("b").alias("node")).union(tried.where("x = node").select("x", "node")).distinct()
        now = tried.join(known, ["x", "node"]).select("token", "node", "x", F.lit(turn).alias("turn"))
        answered = stage(now if answered is None else answered.union(now), "answered")
        open_ = index.join(answered, ["token", "node"], "left_anti")
    links = stage(_linked(answers, threshold), "links")
    found = stage(components(links), "components")
    links = stage(links.union(_family_links(answers, found, threshold)), "links")
    found = stage(components(links), "components")

    rest = stage(sets.close(_rest(index, answered, found, threshold), threshold), "rest-pairs")
    derived = stage(_derived(rest.select("x", "a", "b"), answers, threshold), "derived")
    full = derived.where("linked is null").select("a", "b").distinct().join(derived.where("linked is not null").select("a", "b"), ["a", "b"], "left_anti")
    more = _linked(sets.compare(stage(full, "full"), threshold), threshold)
    links = stage(links.union(derived.where("linked").select("a", "b")).union(more), "links")
    found = components(links)

    labelled = stage(_with_component(nodes.select("node", "digest", "first_id"), "node", found, "c"), "labelled")
    smallest = labelled.groupBy("c").agg(F.min("first_id").alias("component_id"))
    by_digest = labelled.join(smallest, "c").select("digest", "component_id")
    result = marked.select("id", "size", "digest").join(by_digest, "digest", "left")
    return result.select(F.col("id").alias(key), F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir).select("doc_id", "text"))


OP13_SQL = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM listed)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM listed WHERE len(w) IN (1, 2)
), sizes AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS id, a AS other FROM edges UNION SELECT r.id, b.b FROM reach r JOIN edges b ON b.a = r.other),
least_id AS (SELECT id, min(other) AS c FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_id l ON l.id = d.doc_id
"""
