"""Near-duplicate detection with an LSH forest over MinHash signatures.

1.  Documents with equal shingle sets (equal 128-bit digest and size) are one class, shown
    by its smallest id; only classes go on.
2.  Each class has ``TREES`` keys of ``DEPTH`` MinHash values.  Every tree is one sorted
    order of all classes.  In a sorted sweep each row is paired with the ``NEIGHBOURS``
    rows before it that share the longest common prefix, at least ``MIN_DEPTH`` values:
    sparse regions are searched to the least depth, crowded ones only as deep as their
    nearest neighbours.
3.  Pairs are confirmed on the full sets, the longest common prefixes first; pairs whose
    ends are already in one component need no confirmation, nor do pairs whose bitmaps
    show too many shingles that only one of them has.
4.  What the forest missed is found exactly.  In one order of all shingles, the seldom ones
    first, two sets that reach the threshold share a shingle of their prefixes, the first
    n - ceil(threshold * n) + 1 shingles.  The rows of a prefix shingle that lie in different
    components meet in a join, rows with many partners split over tasks, and are confirmed if
    their sizes and the places of the shingle leave room for the threshold.  The forest only
    keeps this join small: pairs inside a component need no comparison.

Null texts and texts without words have an empty set, link with nothing and are their own
component.  A text of fewer words than a shingle is one shingle, the whole sequence.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import add_columns, ascii_lower, documents, words
from tessera.llm.components import components
from tessera.operators.grouping import broadcast_if_small
from tessera.session import Scratch

SHINGLE = 5
#: Least similarity in percent: of the operator in general, and what op8 is to keep to.
THRESHOLD, OP8_THRESHOLD = 80, 85
TREES, DEPTH, MIN_DEPTH, NEIGHBOURS = 24, 8, 4, 4
_A = np.random.default_rng(8).integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_B = np.random.default_rng(9).integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64)
_SLICE = 512
#: One set in SAMPLE, and at most FREQUENT shingles, set the order of the exact join; BLOCK rows of one shingle look for partners in a task.
SAMPLE, FREQUENT, BLOCK = 16, 200_000, 1000
FEW = 1 << 21  # ids that are broadcast to leave out the sets of others


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    listed = words(ascii_lower(text)) if text else []
    if not listed:
        return np.zeros(0, np.uint64)
    if len(listed) < size:
        return np.array([xxhash.xxh3_64_intdigest(" ".join(listed))], np.uint64)
    cache: dict[str, int] = {}
    codes = np.fromiter((cache.get(w) or cache.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in listed), np.uint64, len(listed))
    hashed = np.zeros(len(listed) - size + 1, np.uint64)
    for k in range(size):
        hashed = (hashed ^ codes[k : k + len(hashed)]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    return np.unique(hashed)


def keys(hashed: np.ndarray) -> list[bytes]:
    """One key per tree: DEPTH big-endian 32-bit MinHash values."""
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashed), _SLICE):  # a long text takes no more memory than a slice
        part = hashed[start : start + _SLICE]
        low = np.minimum(low, (part * _A[:, None] + _B[:, None]).min(1))
    top = (low >> np.uint64(32)).astype(">u4")
    return [top[t * DEPTH : (t + 1) * DEPTH].tobytes() for t in range(TREES)]


def _common(a: bytes, b: bytes) -> int:
    """Number of leading MinHash values two keys share."""
    for depth in range(DEPTH):
        if a[depth * 4 : depth * 4 + 4] != b[depth * 4 : depth * 4 + 4]:
            return depth
    return DEPTH


def _sweep(forest: DataFrame, id_type: str, threshold: int) -> DataFrame:
    """Candidate pairs (a, b, depth) of a forest sorted by (tree, key) in each partition."""
    kind = to_arrow_type(forest.schema["id"].dataType)

    def run(batches):
        import pyarrow as pa

        tree, recent, run_key = None, [], b""
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("tree", "key", "id", "size")])
            a, b, d = [], [], []
            for t, key, i, n in rows:
                if t != tree or key[: MIN_DEPTH * 4] != run_key:
                    tree, run_key = t, key[: MIN_DEPTH * 4]
                    recent.clear()
                for key2, i2, n2 in recent:
                    if 100 * min(n, n2) >= threshold * max(n, n2):
                        a.append(min(i, i2))
                        b.append(max(i, i2))
                        d.append(_common(key, key2))
                recent.append((key, i, n))
                del recent[:-NEIGHBOURS]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind), pa.array(d, pa.int32())], names=["a", "b", "depth"])

    pairs = forest.mapInArrow(run, f"a {id_type}, b {id_type}, depth int")
    return pairs.groupBy("a", "b").agg(F.max("depth").alias("depth"))


def _candidates(forest: DataFrame, id_type: str, threshold: int) -> DataFrame:
    """Sweep all trees, each range-partitioned by its whole keys, so that a crowded region is split.

    Two neighbours on both sides of a cut meet in the other trees or in the exact join.
    """
    placed = forest.repartitionByRange("tree", "key", "id").sortWithinPartitions("tree", "key", "id")
    return _sweep(placed, id_type, threshold)


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and how often each occurs in a sample: they only set the order of the join."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            parts = [np.frombuffer(h, np.uint64) for h in batch.column(0).to_pylist()]
            key, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    sample = sets.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0).select("hashes")
    counted = sample.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.where("n > 1").orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()  # at most FREQUENT rows
    key, n = top["shingle"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(key)
    return key[order], n[order]


def prefix(hashed: np.ndarray, frequent: np.ndarray, times: np.ndarray, threshold: int) -> np.ndarray:
    """The seldom shingles of a set of which any set that reaches the threshold shares one, in the common order."""
    n = len(hashed)
    weight = np.zeros(n, np.int64)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, hashed), len(frequent) - 1)
        weight = np.where(frequent[place] == hashed, times[place], 0)
    return hashed[np.argsort(weight, kind="stable")[: n - -(-threshold * n // 100) + 1]]


def _prefixes(sets: DataFrame, threshold: int, hashed: DataFrame | None = None) -> DataFrame:
    """(id, size, prefix) of each set; ``hashed`` may hold rows of other ids beside them, whose sets are not moved to leave them out."""
    sent = sets.sparkSession.sparkContext.broadcast(_frequent(sets))

    def make():
        frequent, times = sent.value
        return lambda listed: [(prefix(np.frombuffer(h, np.uint64), frequent, times, threshold).view(np.int64).tolist(),) for h in listed]

    source = (sets if hashed is None else hashed).select("id", "size", "hashes")
    return add_columns(source, "prefix array<long>", make, "hashes", keep_inputs=False)


def _missed(prefixes: DataFrame, found: DataFrame, threshold: int, scratch: Scratch | None = None) -> DataFrame:
    """All pairs (a, b) in different components that may reach the threshold by their prefixes.

    Of two components one is not the least of the shingle, so only rows outside the least one
    look for partners; they are dealt into blocks, and their partners are copied to each block.
    """
    scratch = scratch or Scratch(prefixes.sparkSession)
    labelled = prefixes.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = scratch.put(labelled, "prefixes")  # one row per set
    rows = labelled.select("id", "size", "component", F.posexplode("prefix").alias("place", "shingle"))
    mixed = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    mixed = scratch.put(mixed.select("shingle", "lo", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "mixed")
    rows = scratch.put(rows.join(mixed, "shingle"), "meeting")
    scratch.drop("prefixes", "mixed")
    left = rows.where("component <> lo").select(
        "shingle", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.col("id").alias("a"), F.col("size").alias("n"),
        F.col("place").alias("i"), F.col("component").alias("ca"),
    )
    right = rows.select(
        "shingle", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("id").alias("b"), F.col("size").alias("m"),
        F.col("place").alias("j"), F.col("component").alias("cb"), "lo",
    )
    room = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) * (100 + threshold) >= threshold * (F.col("n") + F.col("m"))
    once = (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("lo")) | (F.col("a") < F.col("b")))
    met = left.alias("l").join(right.alias("r"), (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.block") == F.col("r.block")) & once & room)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def sketch(hashed: np.ndarray) -> bytes:
    """Bitmap of a set's leading hash bits, with four to eight bits for each shingle."""
    k = max(6, (4 * len(hashed) - 1).bit_length())
    bits = np.zeros(1 << k, bool)
    bits[(hashed >> np.uint64(64 - k)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def most_shared(x: bytes, y: bytes, n: int, m: int) -> int:
    """Upper bound of the shingles two sets of sizes n and m share: a bit that only one has is a shingle the other has not."""
    a, b = (np.unpackbits(np.frombuffer(s, np.uint8)).view(bool) for s in (x, y))
    width = min(len(a), len(b))  # both are powers of two, and leading bits make a longer one fold
    a, b = a.reshape(width, -1).any(1), b.reshape(width, -1).any(1)
    return min(n - np.count_nonzero(a & ~b), m - np.count_nonzero(b & ~a))


def _held(sets: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """The sets of the pairs' ends; up to FEW ids are sent to the sets, so that the others are not moved."""
    ends = scratch.put(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
    return sets.join(broadcast_if_small(ends, FEW), "id", "left_semi")


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: int, scratch: Scratch | None = None) -> DataFrame:
    """Links (a, b): pairs whose full sets reach the threshold.

    A pair first meets by its sketches, an eighth to a sixteenth of the sets, and leaves if their bound rules the threshold out.
    """
    scratch = scratch or Scratch(pairs.sparkSession)
    pairs = scratch.put(pairs.select("a", "b"), "trial")

    def draw():
        return lambda listed: [(sketch(np.frombuffer(h, np.uint64)),) for h in listed]

    def judge():
        def possible(xs, ys, ns, ms):
            most = [most_shared(x, y, n, m) for x, y, n, m in zip(xs, ys, ns, ms)]
            return [(100 * c >= threshold * (n + m - c),) for c, n, m in zip(most, ns, ms)]

        return possible

    def linking():
        def linked(xs, ys):
            out = []
            for x, y in zip(xs, ys):  # sorted arrays
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                out.append((100 * shared >= threshold * (len(p) + len(q) - shared),))
            return out

        return linked

    def ends(rows: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
        return tuple(rows.select(F.col("id").alias(i), F.col(value).alias(v), F.col("size").alias(n)) for i, v, n in (("a", "_x", "_n"), ("b", "_y", "_m")))

    drawn = add_columns(_held(sets, pairs, scratch).select("id", "size", "hashes"), "sketch binary", draw, "hashes", keep_inputs=False)
    left, right = ends(scratch.put(drawn, "sketches"), "sketch")
    judged = add_columns(pairs.join(left, "a").join(right, "b"), "possible boolean", judge, "_x", "_y", "_n", "_m", keep_inputs=False)
    pairs = scratch.put(judged.where("possible").select("a", "b").distinct(), "possible")
    scratch.drop("trial", "sketches")
    left, right = ends(_held(sets, pairs, scratch), "hashes")
    both = pairs.join(left.drop("_n"), "a").join(right.drop("_m"), "b")
    return add_columns(both, "linked boolean", linking, "_x", "_y", keep_inputs=False).where("linked").select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(key, n_shingles, component_id, kept); rows with a null key are left to their own component."""

    def make():
        def rows(texts):
            out = []
            for t in texts:
                hashed = shingles(t)
                raw = hashed.tobytes()
                digest = xxhash.xxh3_128_digest(raw) if len(hashed) else None
                out.append((len(hashed), raw, digest))
            return out

        return rows

    id_type = docs.schema[key].dataType.simpleString()
    scratch = Scratch(docs.sparkSession)
    base = docs.select(F.col(key).alias("id"), F.col(text).alias("t"))
    hashed = scratch.put(add_columns(base, "size long, hashes binary, digest binary", make, "t", keep_inputs=False), "shingles")
    full = hashed.where("digest is not null and id is not null")
    classes = scratch.put(full.groupBy("digest", "size").agg(F.min("id").alias("class")), "classes")
    shown = classes.select(F.col("class").alias("id")).distinct()
    sets = full.join(shown, "id", "left_semi").select("id", "size", "hashes")

    def sign():
        return lambda sets_: [([{"tree": t, "key": k} for t, k in enumerate(keys(np.frombuffer(s, np.uint64)))],) for s in sets_]

    # signatures and prefixes are made of all rows where they lie, as leaving out copies first would move all sets
    signed = add_columns(full.select("id", "size", "hashes"), "trees array<struct<tree:int,key:binary>>", sign, "hashes", keep_inputs=False)
    trees = signed.join(shown, "id", "left_semi").select("id", "size", F.explode("trees").alias("x"))
    forest = scratch.put(trees.select("id", "size", F.col("x.tree").alias("tree"), F.col("x.key").alias("key")), "forest")
    pairs = scratch.put(_candidates(forest, id_type, threshold), "pairs")
    scratch.drop("forest")
    best = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("n"), "depth", "a", "b"), F.struct(F.col("b").alias("n"), "depth", "a", "b")
    )).alias("p")).groupBy("p.n").agg(F.max(F.struct("p.depth", "p.a", "p.b")).alias("m")).select("m.a", "m.b").distinct()
    links = scratch.put(_confirm(best, full, threshold, scratch), "links")
    found = scratch.put(components(links), "components")
    links = scratch.put(links.union(_confirm(_across(pairs.select("a", "b"), found), full, threshold, scratch)), "links")
    scratch.drop("pairs")
    found = scratch.put(components(links), "components")
    prefixes = _prefixes(sets, threshold, full).join(shown, "id", "left_semi")
    missed = scratch.put(_missed(prefixes, found, threshold, scratch), "missed")
    scratch.drop("meeting")
    links = scratch.put(links.union(_confirm(missed, full, threshold, scratch)), "links")
    found = scratch.put(components(links), "components")
    scratch.drop("missed", "ends", "possible", "links")
    members = hashed.select("id", "size", "digest").join(classes.drop("size"), "digest", "left")
    members = scratch.put(members.select("id", "size", "class"), "members")
    scratch.drop("shingles", "classes")
    labels = found.withColumnRenamed("id", "class")
    result = members.join(labels, "class", "left").select(
        F.col("id").alias(key), F.col("size").alias("n_shingles"), F.coalesce("component", "class", "id").alias("component_id")
    )
    return result.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components so far."""
    left = found.select(F.col("id").alias("a"), F.col("component").alias("_ca"))
    right = found.select(F.col("id").alias("b"), F.col("component").alias("_cb"))
    labelled = pairs.join(left, "a", "left").join(right, "b", "left")
    return labelled.where(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), threshold=OP8_THRESHOLD)
