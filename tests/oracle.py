"""Runs registered queries beside their DuckDB SQL and compares the results.

    python -m tests.oracle [sf_dir] [query ...]
"""

import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def kind(value):
    """Type family of a value, so that an int on one side and a float on the
    other count as different."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, decimal.Decimal):
        return "decimal"
    return type(value).__name__


def comparable(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return f"{kind(value)}:{value!r}"


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return (
        [names[i] for i in order],
        sorted(tuple(comparable(row[i]) for i in order) for row in rows),
    )


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return canonical(names, cursor.fetchall())


def difference(got, want):
    """Empty if equal, else a short account of the difference."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1], strict=True) if a != b]
    if not wrong:
        return ""
    a, b = wrong[0]
    cells = [(n, x, y) for n, x, y in zip(got[0], a, b, strict=True) if x != y]
    return f"{len(wrong)} rows differ, first: {cells}"


def main():
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from cartlake.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("oracle", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or queries:
        start = time.time()
        try:
            got = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - start
            note = "rows only" if name not in sql else difference(got, duck_rows(con, sql[name]))
        except Exception as e:  # noqa: BLE001 - the report goes on with the next query
            took, got, note = time.time() - start, ([], []), f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(note) and note != "rows only"
        print(f"{name:28s} {took:6.2f}s {len(got[1]):7d} rows  {note or 'ok'}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
