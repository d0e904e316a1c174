"""Runs registered queries beside their SQL and compares the results as bags of rows."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from registry.fixtures import TABLES  # noqa: E402

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    return v


def bag(rows):
    return sorted((tuple(value(v) for v in r) for r in rows), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def compare(spark, con, folder, run, sql):
    """A list of differences, empty if the results agree."""
    df = run(spark, folder)
    names = sorted(df.columns)
    got_types = {n: t for n, t in df.dtypes}
    got = bag(df.select(*[f"`{n}`" for n in names]).collect())
    if sql is None:
        return [], len(got)
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    if sorted(described) != names:
        return [f"columns {names} != {sorted(described)}"], len(got)
    problems = [
        f"type of {n}: {got_types[n]} != {described[n]}"
        for n in names
        if SAME_TYPE.get(got_types[n], got_types[n]) != described[n]
    ]
    order = [list(described).index(n) for n in names]
    want = bag([tuple(r[i] for i in order) for r in rows])
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    different = [(a, b) for a, b in zip(got, want) if a != b]
    if different:
        problems.append(f"{len(different)} differ, first {different[0]}")
    return problems, len(got)


def main(folder, patterns):
    import __spark_entry__ as entry
    from starloom.session import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in sorted(entry.queries().items()):
        if patterns and not any(p in name for p in patterns):
            continue
        start = time.time()
        try:
            problems, n = compare(spark, con, folder, run, oracle.get(name))
        except Exception as e:
            problems, n = [f"{type(e).__name__}: {str(e)[:600]}"], -1
        bad += bool(problems)
        mark = "BAD" if problems else "ok " if name in oracle else "run"
        print(f"{mark} {name} rows={n} {time.time() - start:.1f}s {problems or ''}", flush=True)
    print(f"{bad} with differences")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
