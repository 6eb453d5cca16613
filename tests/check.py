"""Run registered queries beside their SQL checks and compare whole results.

    python tests/check.py [sf_dir] [name ...]
"""

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(df, con, sql):
    """None when the Spark result and the SQL result hold the same rows, else why not."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    expected = normal(result.fetchall(), columns)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    if len(got) != len(expected):
        return f"rows {len(got)} / {len(expected)}"
    kinds = {type(v) for r in got for v in r} ^ {type(v) for r in expected for v in r}
    if kinds:
        return f"types {kinds}"
    wrong = [(a, b) for a, b in zip(got, expected, strict=True) if a != b]
    return f"{len(wrong)} rows, first {wrong[0]}" if wrong else None


def main(sf_dir, names):
    from conftest import build_session

    import __spark_entry__ as entry

    spark, con = build_session(), connect(sf_dir)
    sql, failed = entry.oracle_sql(), []
    unknown = set(sql) - set(entry.queries())
    assert not unknown, unknown
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        df = query(spark, sf_dir)
        if name in sql:
            found = difference(df, con, sql[name])
        else:
            found = None if df.count() else "no rows"
        kind = "exact" if name in sql else "rows"
        print(f"{name:32} {kind:6} {time.time() - start:6.2f}s  {found or 'ok'}", flush=True)
        if found:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.path.insert(0, str(ROOT / "tests"))
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]))
