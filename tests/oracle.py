"""Run a registered query and its oracle SQL and compare the results as multisets."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _kind(spark_type: str) -> str:
    return {"int": "integer", "string": "varchar", "timestamp_ntz": "timestamp"}.get(
        spark_type, spark_type
    )


def spark_result(df):
    names = sorted(df.columns)
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    return names, [kinds[n] for n in names], [tuple(_plain(r[n]) for n in names) for r in df.collect()]


def duck_result(db, sql):
    relation = db.sql(sql)
    kinds = dict(zip(relation.columns, (str(t).lower() for t in relation.types)))
    names = sorted(relation.columns)
    at = [relation.columns.index(n) for n in names]
    return names, [kinds[n] for n in names], [tuple(_plain(r[i]) for i in at) for r in relation.fetchall()]


def differences(df, db, sql, order=()) -> str:
    """Empty when both agree on column names, types, rows and, if asked, on the sequence."""
    return compare(df, db, sql, order)[0]


def compare(df, db, sql, order=()) -> tuple[str, int]:
    """What differs, and the number of rows Spark returned.

    ``order`` names columns whose values must come in the same sequence: rows that tie in
    them may change places.
    """
    ours, theirs = spark_result(df), duck_result(db, sql)
    problem = _compare((*ours[:2], Counter(ours[2])), (*theirs[:2], Counter(theirs[2])))
    if not problem and order:
        at = [ours[0].index(c) for c in order]
        for place, (a, b) in enumerate(zip(ours[2], theirs[2])):
            if [a[i] for i in at] != [b[i] for i in at]:
                problem = f"sequence: row {place} is {a}, not {b}"
                break
    return problem, len(ours[2])


def _compare(ours, theirs) -> str:
    s_names, s_kinds, s_rows = ours
    d_names, d_kinds, d_rows = theirs
    if s_names != d_names:
        return f"columns {s_names} != {d_names}"
    if s_kinds != [k.replace(" ", "") for k in d_kinds]:
        return f"types {list(zip(s_names, s_kinds, d_kinds))}"
    if s_rows != d_rows:
        extra, lacking = s_rows - d_rows, d_rows - s_rows
        return (
            f"rows {sum(s_rows.values())} vs {sum(d_rows.values())}; only spark "
            f"{list(extra.items())[:3]}; only oracle {list(lacking.items())[:3]}"
        )
    return ""
