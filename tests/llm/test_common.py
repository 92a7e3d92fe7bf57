"""Columns appended in Arrow batches beside columns with odd names."""

from tessera.llm import common
from tessera.llm.common import SLICE_BYTES, add_columns


def test_odd_and_clashing_names_are_carried(spark):
    df = spark.createDataFrame([(1, "x", "keep", 5), (2, None, "too", 6)], "doc_id long, text string, `a.b` string, __in0 int")
    out = add_columns(df, "n long", lambda: lambda texts: [(len(t or ""),) for t in texts], "text")
    assert out.columns == ["doc_id", "text", "a.b", "__in0", "n"]
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "x", "keep", 5, 1), (2, None, "too", 6, 0)]
    replaced = add_columns(df, "text string", lambda: lambda texts: [(str(t) + "!",) for t in texts], "text")
    assert [r["text"] for r in replaced.orderBy("doc_id").collect()] == ["x!", "None!"]


def test_parts_of_a_batch_are_bounded(spark):
    """A batch of 200 texts of 100,000 characters reaches Python in parts of about 2 MB, in order and whole."""
    df = spark.range(0, 200, 1, 1).selectExpr("id", "repeat(cast(id % 10 as string), 100000) AS text")
    make = lambda: lambda texts: [(len(texts), t[:1], sum(map(len, texts))) for t in texts]
    rows = add_columns(df, "together long, first string, chars long", make, "text", keep_inputs=False).collect()
    assert [(r["id"], r["first"]) for r in rows] == [(i, str(i % 10)) for i in range(200)]
    assert max(r["chars"] for r in rows) <= SLICE_BYTES


def test_a_worker_holds_one_table(monkeypatch):
    monkeypatch.setattr(common, "_held", {})
    made = []
    load = lambda name: lambda: made.append(name) or name
    assert [common.held_by_worker((n,), load(n)) for n in "aabba"] == list("aabba")
    assert made == ["a", "b", "a"] and list(common._held) == [("a",)]
