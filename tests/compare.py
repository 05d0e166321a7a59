"""Run registered queries against their SQL on the same tables."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


SPARK_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN"}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if value != value else repr(round(value, 9) + 0.0)
        return repr(value)

    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def compare(spark, db, name, sf_dir):
    """Returns None when equal, else a short description of the difference."""
    df = contract.queries()[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = db.execute(sql)
    want_cols, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    kinds = {f.name: SPARK_KINDS.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    other = {d[0]: str(d[1]).split("(")[0] for d in cursor.description}
    mixed = {c: (kinds[c], other.get(c)) for c in kinds if kinds[c] != other.get(c)}
    if mixed:
        return f"types differ: {mixed}"
    if got_cols != want_cols:
        return f"columns {got_cols} against {want_cols}"
    if got != want:
        differ = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return f"{len(got)} against {len(want)} rows; first differences {differ}"
    return None if got else "no rows"


if __name__ == "__main__":
    from reviewloom.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    session = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__driver__memory="12g")
    session.sparkContext.setLogLevel("ERROR")
    database = connect(sf)
    bad = 0
    for key in only or contract.queries():
        began = time.time()
        try:
            problem = compare(session, database, key, sf)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {key} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print("failures", bad)
