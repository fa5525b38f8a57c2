"""Run a catalog query on Spark and its SQL text on DuckDB and compare whole results."""

import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(root):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def kinds(rows):
    return [sorted({type(value).__name__ for value in column}) for column in zip(*rows)]


def differences(spark, con, root, query):
    """(text describing the first difference or None, row count, seconds)."""
    started = time.time()
    frame = query.run(spark, root)
    ours = [tuple(row) for row in frame.collect()]
    seconds = time.time() - started
    if query.sql is None:
        return (None if ours or frame.columns else "no result"), len(ours), seconds
    relation = con.sql(query.sql)
    theirs = relation.fetchall()
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} != {sorted(relation.columns)}", len(ours), seconds
    left, right = rows_of(frame.columns, ours), rows_of(relation.columns, theirs)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}", len(ours), seconds
    if kinds(left) != kinds(right):
        return f"types {kinds(left)} != {kinds(right)}", len(ours), seconds
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}", len(ours), seconds
    return None, len(ours), seconds


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from lakeweave.catalog import CATALOG
    from lakeweave.session import build_session

    root, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("check", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    bad = 0
    for name, query in CATALOG.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            problem, count, seconds = differences(spark, con, root, query)
        except Exception as error:  # report and go on with the next query
            problem, count, seconds = f"{type(error).__name__}: {str(error)[:600]}", -1, 0.0
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:32s} rows={count:<7d} {seconds:6.2f}s "
              f"{'' if query.sql else '(rows only) '}{problem or ''}", flush=True)
    print("bad:", bad)
