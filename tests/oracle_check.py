"""Compare every query with its SQL on one scale folder: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(str(row[i].replace(tzinfo=None)) if hasattr(row[i], "tzinfo") else
               (repr(float(row[i])) if isinstance(row[i], float) else str(row[i])) for i in order) for row in rows)
    )


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """Empty when the results agree, otherwise what differs."""
    df = spark_entry.queries()[name](spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return f"no SQL; {len(got)} rows"
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    expected = canonical(result.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != expected:
        only_got = [r for r in got if r not in set(expected)][:2]
        only_expected = [r for r in expected if r not in set(got)][:2]
        return f"{len(got)} rows, expected {len(expected)}; {sorted(columns)}\n  got {only_got}\n  exp {only_expected}"
    types = {d[0]: str(d[1]) for d in result.description}
    print(f"   {len(got)} rows", {f.name: f"{f.dataType.simpleString()}/{types[f.name]}" for f in df.schema.fields}
          if os.environ.get("SHOW_TYPES") else "")
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(spark_entry.queries())
    from marlstone.session import build_session
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                               "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem}", flush=True)
        failed += bool(problem)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
