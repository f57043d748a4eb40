"""Side-by-side check of a Spark query and its SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(con, df, sql: str) -> tuple[bool, str]:
    cols = df.columns
    mine = rows_of(cols, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    theirs = rows_of(list(rel.columns), rel.fetchall())
    if sorted(cols) != sorted(rel.columns):
        return False, f"columns {sorted(cols)} vs {sorted(rel.columns)}"
    if mine == theirs:
        return True, f"{len(mine)} rows"
    a, b = set(mine) - set(theirs), set(theirs) - set(mine)
    msg = f"rows {len(mine)} vs {len(theirs)}; only spark {len(a)}, only sql {len(b)}\n   columns {sorted(cols)}"
    for x in sorted(a)[:2]:
        msg += "\n   spark: " + str([str(v)[:90] for v in x])
    for x in sorted(b)[:2]:
        msg += "\n   sql:   " + str([str(v)[:90] for v in x])
    return False, msg


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from citeloom.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = f"/root/testdata/sf{a[5:]}"
    spark = local_session("check", 8)
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(queries):
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                ok, msg = compare(con, df, sqls[name])
            else:
                ok, msg = True, f"{len(df.collect())} rows (no SQL)"
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:900]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t0:.1f}s {msg}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
