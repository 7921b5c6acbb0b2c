"""Runs every query beside its SQL: python tests/oracle.py SF_DIR [NAME...]."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402


def rows_of(sql: str, sf_dir: str):
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    r = c.execute(sql)
    return [d[0] for d in r.description], r.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda x: round(x, 9) if isinstance(x, float) else x
    return [names[i] for i in order], sorted((tuple(fix(r[i]) for i in order) for r in rows), key=str)


def compare(spark, name, query, sql, sf_dir) -> str:
    df = query(spark, sf_dir)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    theirs = normal(*rows_of(sql, sf_dir))
    if mine == theirs:
        return ""
    return f"{name}: {mine[0]} {theirs[0]} rows {len(mine[1])} {len(theirs[1])}; first difference {next(((a, b) for a, b in zip(mine[1], theirs[1], strict=False) if a != b), None)}"


if __name__ == "__main__":
    import time

    import __spark_entry__ as entry
    from wayframe.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    sql, queries = entry.oracle_sql(), entry.queries()
    for n in sys.argv[2:] or queries:
        t = time.time()
        try:
            said = compare(spark, n, queries[n], sql[n], sys.argv[1]) if n in sql else f"{n}: {queries[n](spark, sys.argv[1]).count()} rows, no SQL"
        except Exception as e:
            said = f"{n}: {type(e).__name__} {str(e)[:300]}"
        print(f"{time.time() - t:6.1f} s {n} {said or 'ok'}", flush=True)
