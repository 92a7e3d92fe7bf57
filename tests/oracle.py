"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "float": {"FLOAT"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
}


def spark_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tessera")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, f"{v:.4f}")
    return (1, str(v))


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a DuckDB result; empty when they agree exactly."""
    names = sorted(df.columns)
    cur = con.execute(sql)
    duck_names = [d[0] for d in cur.description]
    if sorted(duck_names) != names:
        return [f"columns {names} against {sorted(duck_names)}"]
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    problems = [
        f"type of {n}: {t} against {duck_types[n]}"
        for n, t in df.dtypes
        if duck_types[n] not in SPARK_TO_DUCK.get(t, set())
    ]
    order = [duck_names.index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=lambda r: [_key(v) for v in r])
    arrow = df.select(*names).toArrow()
    ours = sorted(zip(*[c.to_pylist() for c in arrow.columns]), key=lambda r: [_key(v) for v in r])
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    elif not ours:
        problems.append("no rows")
    exact = near = 0
    example = None
    for a, b in zip(ours, theirs):
        if a == b:
            exact += 1
            continue
        close = all(
            x == y
            or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1.1e-6))
            for x, y in zip(a, b)
        )
        near += close
        if example is None or not close:
            example = (a, b)
    if example is not None:
        problems.append(f"{len(ours) - exact} rows differ ({near} only by rounding): {names} {example[0]} against {example[1]}")
    return problems


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        del argv[i : i + 2]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = spark_session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = argv or list(queries)
    bad = 0
    for name in wanted:
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(problems)
        mark = "ok  " if not problems else "BAD "
        print(f"{mark} {name} {time.time() - t0:.1f}s {'' if name in oracles else '(no SQL)'}", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
