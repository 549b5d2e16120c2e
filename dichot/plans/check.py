"""Local twin of the driver's correctness gate: run a registered query in
Spark and its SQL in DuckDB on the same parquet files, then compare row
count, column names/types and an order-insensitive multiset of rows."""

from __future__ import annotations

import math
import sys
import time

from dichot.session import TABLES


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str, fn, sql: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols), "spark_sec": round(t1 - t0, 2)}
    out["values_match"] = out["cols_match"] and canon(srows, scols) == canon(drows, dcols)
    if not out["values_match"]:
        out["spark_cols"], out["duck_cols"] = scols, dcols
        a, b = canon(srows, scols), canon(drows, dcols)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
    return out


def main(argv):
    from dichot.plans.queries import ORACLE, QUERIES
    from dichot.session import local_session
    sf_dir = "/root/testdata/sf0.01"
    names = argv or sorted(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        if n not in ORACLE:
            t0 = time.time()
            try:
                rows = QUERIES[n](spark, sf_dir).count()
                print(f"ROWS-ONLY {n}: {rows} rows {time.time() - t0:.1f}s", flush=True)
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"ERROR {n}: {type(e).__name__}: {str(e)[:300]}", flush=True)
            continue
        try:
            r = compare(spark, con, n, sf_dir, QUERIES[n], ORACLE[n])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {n}: {type(e).__name__}: {str(e)[:300]}", flush=True)
            continue
        ok = r["values_match"] and r["spark_rows"] == r["duck_rows"]
        bad += 0 if ok else 1
        print(("OK  " if ok else "FAIL") + f" {n}: {r}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
