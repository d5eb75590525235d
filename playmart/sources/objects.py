"""Questions about source objects: how many, how they compare with what was staged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.sources.landing import non_blank, read_lines


def json_lines_count(lines: DataFrame) -> DataFrame:
    """Number of records in newline-delimited files (blank lines do not count)."""
    return non_blank(lines).agg(F.count(F.lit(1)).alias("record_count"))


def objects_under(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Objects below a prefix with their non-blank line counts."""
    lines = non_blank(read_lines(spark, path, pattern))
    return lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("line_count"))


def reconcile_counts(counted: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Compare source and staged row counts, one row per collection.

    ``counted`` maps a collection name to (source rows, staged rows).
    """
    result = None
    for collection, (source, target) in counted.items():
        tagged = source.select(F.lit(1).alias("in_source"), F.lit(0).alias("in_target")).unionAll(
            target.select(F.lit(0), F.lit(1))
        )
        row = tagged.agg(
            F.coalesce(F.sum("in_source"), F.lit(0)).cast("bigint").alias("source_n"),
            F.coalesce(F.sum("in_target"), F.lit(0)).cast("bigint").alias("target_n"),
        ).select(
            F.lit(collection).alias("collection"),
            "source_n",
            "target_n",
            (F.col("source_n") == F.col("target_n")).alias("ok"),
        )
        result = row if result is None else result.unionByName(row)
    return result


def peek_rows(rows: DataFrame, where: Column, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows that satisfy ``where``, in a stated order."""
    return rows.where(where).orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
