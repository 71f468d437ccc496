"""Compare registered queries with their SQL on the same tables.

    python tests/oracle.py [folder] [query ...]
"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(folder):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{name}'")
    return con


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def _types(kinds):
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN",
    }
    return {c: names.get(k, k) for c, k in kinds}


def differences(con, frame, sql):
    """None when the two results agree, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {c: str(d[1]) for c, d in zip(columns, result.description)}
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    ours = _types(frame.dtypes)
    if ours != {c: k for c, k in kinds.items()}:
        return f"types {ours} against {kinds}"
    expected = _normal(result.fetchall(), columns)
    actual = _normal([tuple(r) for r in frame.collect()], frame.columns)
    if expected == actual:
        return None
    for a, b in zip(actual, expected):
        if a != b:
            return f"{len(actual)} rows against {len(expected)}; first {a} against {b}"
    return f"{len(actual)} rows against {len(expected)}"


def main(folder, names):
    from wavelode.plans.queries import QUERIES, SQL
    from wavelode.session import build_session

    spark = build_session(
        "oracle", master="local[8]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
              "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in SQL:
                problem = differences(con, frame, SQL[name])
            else:
                problem = None if frame.collect() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        kind = "sql" if name in SQL else "rows"
        print(f"{mark} {name} [{kind}] {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments[0] if arguments else f"{TESTDATA}/sf0.01"
    sys.exit(1 if main(where, arguments[1:]) else 0)
