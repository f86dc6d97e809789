"""Run registered queries next to their SQL and compare columns, types and all rows."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
_KIND = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "boolean": "bool",
}


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(v))
    return tuple(_cell(x) for x in v) if isinstance(v, (list, tuple)) else v


def compare(df, con, sql: str) -> str | None:
    """None if the query and the SQL agree, otherwise what differs."""
    cur = con.execute(sql)
    theirs_cols = [(c[0], str(c[1]).lower()) for c in cur.description]
    theirs = cur.fetchall()
    names = sorted(df.columns)
    if names != sorted(c for c, _ in theirs_cols):
        return f"columns {names} != {sorted(c for c, _ in theirs_cols)}"
    kinds = {c: t for c, t in theirs_cols}
    for f in df.schema.fields:
        a, b = f.dataType.simpleString(), kinds[f.name]
        if a.replace("string", "varchar") != b.replace("integer", "int"):
            return f"type of {f.name}: {a} != {b}"
    at = [[c for c, _ in theirs_cols].index(n) for n in names]
    left = Counter(tuple(_cell(r[n]) for n in names) for r in df.collect())
    right = Counter(tuple(_cell(r[i]) for i in at) for r in theirs)
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"rows {sum(left.values())} vs {sum(right.values())}; only spark {sum(only_left.values())}: "
        f"{str(list(only_left.items())[:2])[:600]}; only sql {sum(only_right.values())}: {str(list(only_right.items())[:2])[:600]}"
    )


def main(names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.session import session

    root = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con, bad = session(), connect(root), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, root)
            problem = compare(df, con, oracles[name]) if name in oracles else f"no sql, {df.count()} rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None and not problem.startswith("no sql")
        print(f"{'ok  ' if problem is None else 'note' if problem.startswith('no sql') else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
