"""Compare queries with their expected results: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def expected(sf_dir, text):
    base = duckdb.connect()
    for t in TABLES:
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = base.execute(text)
    return [d[0] for d in cursor.description], cursor.fetchall()


def difference(spark, sf_dir, name, build, text):
    """None if the query gives the expected rows, else what differs."""
    df = build(spark, sf_dir)
    got = in_order(df.columns, [tuple(r) for r in df.collect()])
    columns, rows = expected(sf_dir, text)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = in_order(columns, rows)
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows != {len(want)} rows; {sorted(columns)}; only got {only_got}; only expected {only_want}"


def main():
    from __spark_entry__ import oracle_sql, queries
    from wardgrid.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session("oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, sf_dir, name, queries()[name], oracle_sql()[name])
        except Exception as error:  # report every query, not just the first failure
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    sys.exit(1 if main() else 0)
