"""Run the registered queries next to their SQL in DuckDB and compare the results.

usage: python tools/check_sql.py [folder] [query ...]
"""

import math
import pathlib
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lavra.plans.queries import QUERIES, Tables  # noqa: E402
from lavra.session import build_session  # noqa: E402


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def main(folder, names):
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lavra-")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for path in pathlib.Path(folder).glob("*.parquet"):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    bad = 0
    for name, q in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = q.run(Tables(spark, folder))
            columns, rows = table(df.columns, [tuple(r) for r in df.collect()])
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: {str(e)[:1500]}")
            bad += 1
            continue
        took = time.time() - start
        if not q.sql:
            print(f"rows {name}: {len(rows)} rows, {took:.2f}s {rows[:3]}")
            continue
        try:
            result = db.execute(q.sql)
            expected, wanted = table([d[0] for d in result.description], result.fetchall())
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: SQL {str(e)[:1500]}")
            bad += 1
            continue
        if columns == expected and rows == wanted:
            print(f"ok   {name}: {len(rows)} rows, {took:.2f}s")
        else:
            bad += 1
            print(f"DIFF {name}: {columns} {expected} rows {len(rows)} {len(wanted)}")
            print("   spark", [r for r in rows if r not in set(wanted)][:4])
            print("   sql  ", [r for r in wanted if r not in set(rows)][:4])
    print("not agreeing:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(1 if main(args[0] if args else "/root/testdata/sf0.01", args[1:]) else 0)
