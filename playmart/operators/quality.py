"""Contract checks: what a declarative key, NOT NULL or length would have enforced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.operators.grouping import attach
from playmart.schemas import DEFAULT_TEXT, Table

DUPLICATE = "duplicate key"


def check_contract(rows: DataFrame, table: Table) -> DataFrame:
    """Violations per column and rule, from one pass over ``rows``.

    Lengths count bytes, as a declared text length does.
    Columns: ``column_name``, ``rule`` ('not null' or 'max length n'), ``violations``.
    """
    rules = [(c, "not null", F.col(c).isNull()) for c in table.required if c in rows.columns]
    rules += [
        (c, f"max length {n}", F.octet_length(c) > n)
        for c, n in table.lengths.items()
        if c in rows.columns
    ]
    counted = rows.agg(*[F.count_if(bad).alias(f"rule{i}") for i, (_, _, bad) in enumerate(rules)])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(column).alias("column_name"),
                        F.lit(rule).alias("rule"),
                        F.col(f"rule{i}").alias("violations"),
                    )
                    for i, (column, rule, _) in enumerate(rules)
                ]
            )
        )
    )


def first_violation(table: Table, columns: list[str]) -> Column:
    """The first rule a row breaks, as ``rule: column``, or NULL; NOT NULL rules come first."""
    broken = [F.when(F.col(c).isNull(), F.lit(f"not null: {c}")) for c in table.required if c in columns]
    broken += [
        F.when(F.octet_length(c) > n, F.lit(f"max length {n}: {c}"))
        for c, n in table.lengths.items()
        if c in columns
    ]
    return F.coalesce(*broken, F.lit(None).cast("string"))


def enforce_contract(
    stored: DataFrame, table: Table, unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the contract, the others with the ``rule`` each breaks).

    ``stored`` must be a stored table: a row is named by its file and its place in it. Of
    rows that share a key the smallest by the other columns in their order (NULLs first)
    stays, of equal ones the first in the files; the others break ``duplicate key``. The winner is a
    partial aggregate per key, and only keys with several rows are joined back, so no group
    meets in one task. With ``unique`` the key is known to be unique and is not checked.
    """
    columns = stored.columns
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    rows = stored.select(*columns, place.alias("__place"), first_violation(table, columns).alias("rule"))
    key = [c for c in table.key if c in columns]
    if key and len(key) == len(table.key) and not unique:
        order = F.struct(*[c for c in columns if c not in key], "__place")
        groups = rows.where("rule is null").groupBy(*key)
        groups = groups.agg(F.min(order)["__place"].alias("__winner"), F.count(F.lit(1)).alias("__n"))
        rows = attach(rows, groups.where("__n > 1").drop("__n"), key, "left", nulls_match=True)
        loses = F.col("rule").isNull() & (F.col("__place") != F.col("__winner"))
        rows = rows.withColumn("rule", F.when(loses, F.lit(DUPLICATE)).otherwise(F.col("rule")))
    return rows.where("rule is null").select(*columns), rows.where("rule is not null").select(*columns, "rule")


def check_primary_key(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def longest_text(rows: DataFrame, limit: int = DEFAULT_TEXT) -> DataFrame:
    """Bytes of the longest value of every text column and whether it passes the default length."""
    columns = [f.name for f in rows.schema.fields if f.dataType.typeName() == "string"]
    widest = rows.agg(*[F.max(F.octet_length(c)).alias(c) for c in columns])
    return widest.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(c).alias("max_length"),
                        F.coalesce(F.col(c) > limit, F.lit(False)).alias("overflows"),
                    )
                    for c in columns
                ]
            )
        )
    )
