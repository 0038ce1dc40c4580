"""Run every catalogue query next to its SQL and compare row by row.

    python tools/check_oracles.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import pathlib
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))
from codetide.plans.catalog import ORACLES, QUERIES  # noqa: E402
from codetide.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    got = QUERIES[name](spark, sf_dir).toArrow()
    if name not in ORACLES:
        return True, f"{got.num_rows} rows, no SQL"
    want = con.execute(ORACLES[name]).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return False, f"columns {got.column_names} != {want.column_names}"
    columns = sorted(got.column_names)
    types = [(c, str(got[c].type), str(want[c].type)) for c in columns]
    odd = [t for t in types if t[1].replace("large_", "") != t[2].replace("large_", "")]
    rows = lambda t: Counter(zip(*[t[c].to_pylist() for c in columns]))
    a, b = rows(got), rows(want)
    if a != b:
        extra, missing = list((a - b).items())[:3], list((b - a).items())[:3]
        return False, f"{got.num_rows} vs {want.num_rows} rows; only Spark {extra}; only SQL {missing}"
    return not odd, f"{got.num_rows} rows" + (f"; types differ {odd}" if odd else "")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--partitions", default="8")
    parser.add_argument("--plain", action="store_true", help="a session without any of our settings")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    if args.plain:
        spark = SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    else:
        spark = local_session(8, **{"spark.sql.shuffle.partitions": args.partitions})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        started = time.time()
        try:
            ok, note = compare(spark, con, name, args.sf)
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:24} {time.time() - started:6.2f}s  {note[:900]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
