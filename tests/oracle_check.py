"""Run registered queries in Spark and their SQL in DuckDB and compare them:
row count, column names, and the multiset of rows (exact values)."""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark, con, name, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems and _rows(s_cols, s_rows) != _rows(d_cols, d_rows):
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)


def main(sf_dir: str, only: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from gamestats.session import local_session

    spark = local_session(8)
    con = duck_connection(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:40s} no oracle")
            continue
        problems, n = compare(spark, con, name, q, sqls[name], sf_dir)
        bad += bool(problems)
        print(f"{name:40s} {'OK ' if not problems else 'BAD'} rows={n} {'; '.join(problems)}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
