"""Run queries and their SQL twins on the same tables and compare all rows.

    python scripts/check_oracle.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from gridmill.registry import ORACLES, QUERIES
from gridmill.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{opts.sf}/{t}.parquet'")
    spark = local_session(8)
    failed = []
    for name, run in QUERIES.items():
        if opts.names and name not in opts.names:
            continue
        start = time.time()
        try:
            df = run(spark, opts.sf)
            got = df.collect()
        except Exception as e:  # noqa: BLE001
            failed.append(name)
            print(f"ERROR {name}: {str(e)[:1500]}")
            continue
        seconds = time.time() - start
        if name not in ORACLES:
            print(f"rows  {name}: {len(got)} rows {seconds:.1f}s")
            continue
        try:
            cur = con.execute(ORACLES[name])
            want = cur.fetchall()
            columns = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
        except Exception as e:  # noqa: BLE001
            failed.append(name)
            print(f"SQL   {name}: {str(e)[:1500]}")
            continue
        gc, gr = rows_of(df.columns, got)
        wc, wr = rows_of(columns, want)
        if gc != wc:
            failed.append(name)
            print(f"COLS  {name}: {gc} != {wc}")
        elif gr != wr:
            failed.append(name)
            print(f"DIFF  {name}: {len(got)} vs {len(want)} rows; extra {list((gr - wr).items())[:3]}; "
                  f"missing {list((wr - gr).items())[:3]}")
        else:
            note = " ".join(f"{f.name}:{f.dataType.simpleString()}/{types[f.name]}" for f in df.schema.fields)
            print(f"ok    {name}: {len(got)} rows {seconds:.1f}s  {note}")
    print(f"{len(failed)} failed: {' '.join(failed)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
