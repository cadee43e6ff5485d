"""Run queries and their SQL twins side by side and compare all values."""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, float):
        return f"{v:.6f}"
    return repr(v)


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark_df, con, sql):
    """None if equal, else a short description of the difference."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    types = dict(zip(names, [str(t) for t in con.sql(sql).types]))
    for f, t in spark_df.dtypes:
        if KINDS.get(t) != types[f]:
            return f"type of {f}: {t} != {types[f]}"
    order = sorted(names)
    at = [names.index(c) for c in order]
    expected = sorted([tuple(cell(row[i]) for i in at) for row in want.fetchall()])
    got = sorted([tuple(cell(v) for v in row) for row in spark_df.select(*[f"`{c}`" for c in order]).collect()])
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(bad)} rows differ, first: spark={bad[0][0]} sql={bad[0][1]}" if bad else None


def main(folder, only):
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                problem = compare(df, con, sql[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:400]}"
        failed += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
