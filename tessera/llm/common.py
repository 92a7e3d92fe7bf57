"""Words and table helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    """Lower-case A-Z only."""
    return text.lower() if text.isascii() else text.encode().lower().decode()  # bytes know no other letters


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def fold(column: str, remainder: int, modulus: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Bytes of a batch that a task turns into Python objects at a time.
SLICE_BYTES = 1 << 21
_held: dict = {}


def held_by_worker(key: tuple, load):
    """``load()``, kept until this Python worker asks for another key: workers outlive their tasks, and one large table each is enough."""
    if key not in _held:
        _held.clear()
        _held[key] = load()
    return _held[key]


def slices(batch, size: int):
    """The batch in consecutive parts of about ``size`` bytes, of one row at least."""
    step = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def add_columns(df: DataFrame, added: str, make, *inputs: str, keep_inputs: bool = True) -> DataFrame:
    """Append columns computed part by part of Arrow batches; columns of ``df`` with their names are replaced.

    ``added`` is a DDL string; ``make()`` runs once per task and gives a function from
    the input columns, as Python lists, to a list of rows.  Without ``keep_inputs`` the
    inputs are left out of the result.
    """
    fields = StructType.fromDDL(added)
    left_out = fields.names if keep_inputs else [*fields.names, *inputs]
    carried = [c for c in df.columns if c not in left_out]
    sent = list(dict.fromkeys([*carried, *inputs]))
    kept = df.select(*[F.col(f"`{c}`") for c in sent]).toDF(*[f"_{i}" for i in range(len(sent))])
    schema = StructType([*[df.schema[c] for c in carried], *fields.fields])
    n, at = len(carried), [sent.index(c) for c in inputs]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields.fields]
        function = make()
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                rows = function(*[part.column(i).to_pylist() for i in at])
                columns = [part.column(i) for i in range(n)]
                columns += [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema)
