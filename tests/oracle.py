"""Compares registered queries with their SQL on the driver's tables: ``python -m tests.oracle [SF] [NAME...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: int = 4):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]").config("spark.driver.memory", "6g").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return int(x) if isinstance(x, bool) else x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name: str, sf_dir: str) -> str:
    """'' if both sides agree in columns and rows, else what differs."""
    import duckdb

    import __spark_entry__ as entry

    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    text = entry.oracle_sql().get(name)
    if text is None:
        return ""
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir, f"{t}.parquet")
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    con.execute("SET TimeZone = 'UTC'")
    result = con.execute(text)
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if got == want:
        return ""
    a, b = [x for x in got if x not in set(want)][:2], [x for x in want if x not in set(got)][:2]
    return f"{len(got)} and {len(want)} rows; only here {str(a)[:500]}; only in SQL {str(b)[:500]}"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    spark = session(int(os.environ.get("CORES", "4")))
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names or entry.queries():
        began = time.time()
        try:
            said = compare(spark, name, f"/root/testdata/sf{sf}")
        except Exception:  # noqa: BLE001
            said = traceback.format_exc()[-900:]
        bad += bool(said)
        print(f"{'FAIL' if said else 'ok  '} {name} {time.time() - began:.1f}s {said}", flush=True)
    print("bad", bad)
    sys.exit(bool(bad))
