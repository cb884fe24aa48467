"""Run queries in Spark and their SQL in DuckDB and compare the values.

``python -m tests.compare [--sf DIR] [name ...]``
"""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    values = [tuple(_norm(r[i]) for i in order) for r in rows]
    return names, sorted(values, key=repr)


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    return got, want


def main(argv):
    import __spark_entry__ as entry
    from docintake.session import local_session

    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles = entry.oracle_sql()
    bad = []
    for name, query in entry.queries().items():
        if argv and name not in argv:
            continue
        start = time.time()
        try:
            if name not in oracles:
                n = query(spark, sf).count()
                print(f"{name:32s} rows only {n} {time.time() - start:.1f}s", flush=True)
                continue
            got, want = compare(spark, con, query, oracles[name], sf)
        except Exception as e:
            print(f"{name:32s} ERROR {str(e)[:700]}", flush=True)
            bad.append(name)
            continue
        ok = got == want
        print(f"{name:32s} {'ok' if ok else 'DIFF'} {len(got[1])} {time.time() - start:.1f}s", flush=True)
        if not ok:
            bad.append(name)
            print("   ", got[0], want[0], len(got[1]), len(want[1]))
            extra = [r for r in got[1] if r not in set(want[1])][:3]
            missing = [r for r in want[1] if r not in set(got[1])][:3]
            print("    spark only", str(extra)[:900])
            print("    sql only  ", str(missing)[:900])
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
