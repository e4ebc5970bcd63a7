"""Run registered queries beside their SQL on DuckDB and compare the results.

    python tools/check_sql.py [--sf 0.01] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.catalogue import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canonical(df: pd.DataFrame) -> list[tuple]:
    columns = sorted(df.columns)
    out = []
    for row in df[columns].astype(object).itertuples(index=False):
        cells = []
        for v in row:
            if v is None or (not isinstance(v, (list, tuple, dict)) and pd.isna(v)):
                cells.append("NULL")
            elif isinstance(v, bool) or type(v).__name__ == "bool_":
                cells.append(f"b{bool(v)}")
            elif isinstance(v, (int, float)) or type(v).__module__ == "numpy" and hasattr(v, "item"):
                cells.append(repr(float(v) + 0.0))
            else:
                s = str(v)
                cells.append(s.removesuffix(" 00:00:00"))
        out.append(tuple(cells))
    return sorted(out)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    bad = 0
    for name, q in QUERIES.items():
        if args.names and not any(name == n or name.startswith(n) or n in q.covers for n in args.names):
            continue
        t0 = time.time()
        try:
            got_df = q.run(spark, folder)
            types = dict(got_df.dtypes)
            got = got_df.toPandas()
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: spark: {str(e)[:600]}")
            continue
        t1 = time.time()
        if q.sql is None:
            print(f"rows {name}: {len(got)} rows {t1 - t0:.1f}s")
            if len(got) == 0:
                print("   EMPTY")
            continue
        try:
            cur = con.execute(q.sql)
            kinds = {d[0]: str(d[1]) for d in cur.description}
            want = cur.df()
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: sql: {str(e)[:600]}")
            continue
        t2 = time.time()
        a, b = canonical(got), canonical(want)
        if sorted(got.columns) != sorted(want.columns):
            bad += 1
            print(f"FAIL {name}: columns {sorted(got.columns)} / {sorted(want.columns)}")
        elif a != b:
            bad += 1
            sa, sb = set(a), set(b)
            print(f"FAIL {name}: rows {len(a)} / {len(b)}; differing {len(sa - sb)} / {len(sb - sa)}")
            print("   columns", sorted(got.columns))
            print("   spark", sorted(sa - sb)[:3])
            print("   sql  ", sorted(sb - sa)[:3])
        else:
            note = "" if len(a) else "  EMPTY"
            mixed = [
                f"{c}:{types[c]}/{kinds[c]}" for c in types
                if (types[c] == "bigint") != (kinds[c] == "BIGINT") or (types[c] == "double") != (kinds[c] == "DOUBLE")
                or (types[c] == "date") != (kinds[c] == "DATE")
            ]
            print(f"ok   {name}: {len(a)} rows, {t1 - t0:.1f}s / {t2 - t1:.1f}s{note}{' TYPES ' + str(mixed) if mixed else ''}")
    print("failures", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
