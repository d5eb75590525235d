"""Tables as Parquet folders: create, replace, append, clear, cluster, co-locate, number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playmart.operators.grouping import attach, n_rows
from playmart.operators.workspace import cut
from playmart.schemas import Table

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_FILES = 100_000


def table_path(root: str, table: Table) -> str:
    return f"{root.rstrip('/')}/{table.name}"


def read_table(spark: SparkSession, root: str, table: Table) -> DataFrame:
    return spark.read.schema(table.schema).parquet(table_path(root, table))


def create_tables(spark: SparkSession, root: str, tables: list[Table]) -> None:
    """Create each table empty where its folder does not exist yet."""
    for table in tables:
        _empty(spark, table).write.mode("ignore").parquet(table_path(root, table))


def replace_table(rows: DataFrame, root: str, table: Table) -> None:
    """Write the table anew; what it held before is gone."""
    conform(rows, table).write.mode("overwrite").parquet(table_path(root, table))


def insert_select(rows: DataFrame, root: str, table: Table) -> None:
    """Append query results; columns are matched by name, absent ones become NULL."""
    conform(rows, table).write.mode("append").parquet(table_path(root, table))


def clear_table(spark: SparkSession, root: str, table: Table) -> None:
    """Delete all rows and keep the table."""
    _empty(spark, table).write.mode("overwrite").parquet(table_path(root, table))


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """Project onto the table's columns by name and cast to its types."""
    unknown = set(rows.columns) - set(table.columns)
    if unknown:
        raise ValueError(f"{table.name} has no columns {sorted(unknown)}")
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in table.schema.fields
        ]
    )


def measured_bytes(rows: DataFrame) -> int:
    """Upper estimate of the rows' size in memory, from one aggregate over them."""
    fixed, texts = 0, []
    for field in rows.schema.fields:
        if isinstance(field.dataType, T.StringType):
            texts.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
        fixed += 16
    per_row = sum(texts, F.lit(fixed)).cast("bigint")
    return rows.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("n")).first()["n"]


def replicate_dim(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored dimension for replication to all executors, if it is small enough.

    The size is measured, not guessed. A dimension beyond ``max_bytes`` is returned
    unmarked, and the join shuffles as any other.
    """
    return F.broadcast(dim) if measured_bytes(dim) <= max_bytes else dim


def cluster_by_sortkey(
    rows: DataFrame, path: str, sort_by: tuple[str, ...], tie_break: tuple[str, ...] = ()
) -> None:
    """Write range-partitioned, sorted files, so that filters on the key skip files.

    ``tie_break`` columns let the ranges cut through a value that many rows share.
    """
    columns = [*sort_by, *tie_break]
    rows.repartitionByRange(*columns).sortWithinPartitions(*columns).write.mode(
        "overwrite"
    ).parquet(path)


def hot_keys(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Key values that hold more rows than an even bucket (fewer than ``buckets`` of them),
    with ``salts``: how many even buckets their rows would fill."""
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(n_rows().alias("n"))
    total = rows.agg(n_rows().alias("total")).scalar()
    share = F.ceil(F.col("n") * buckets / total)
    hot = counted.where(F.col("n") * buckets > total)
    return hot.select(key, F.least(share, F.lit(buckets)).cast("int").alias("salts"))


def write_colocated(
    fact: DataFrame,
    fact_key: str,
    fact_id: str,
    dim: DataFrame,
    dim_key: str,
    names: tuple[str, str],
    paths: tuple[str, str],
    buckets: int,
    salts: int | None = None,
) -> None:
    """Save fact and dimension as bucketed tables that join without a shuffle.

    Both are bucketed on (key, salt). The salt is 0 except for hot fact keys, whose
    rows are spread by their id over as many salts as they would fill even buckets (or
    over ``salts``, if given); the dimension repeats the rows of those keys once per salt. Rows without a key join
    nothing and are spread over all buckets. At most ``buckets`` keys can be hot, so that
    list, counted once, is safe to broadcast. Join the tables on key and ``salt``.
    """
    hot = cut(hot_keys(fact, fact_key, buckets), "hot").withColumnRenamed(fact_key, "__hot")
    if salts:
        hot = hot.withColumn("salts", F.lit(salts))
    width = F.when(F.col(fact_key).isNull(), buckets).otherwise(F.coalesce("salts", F.lit(1)))
    salted_fact = fact.join(F.broadcast(hot), F.col(fact_key) == F.col("__hot"), "left").withColumn(
        "salt", F.pmod(F.xxhash64(fact_id), width).cast("int")
    )
    copies = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    salted_dim = dim.join(F.broadcast(hot), F.col(dim_key) == F.col("__hot"), "left").withColumn(
        "salt", F.explode(copies)
    )
    for rows, key, name, path in (
        (salted_fact, fact_key, names[0], paths[0]),
        (salted_dim, dim_key, names[1], paths[1]),
    ):
        rows.drop("__hot", "salts").repartition(buckets, key, "salt").write.mode("overwrite").option(
            "path", path
        ).bucketBy(buckets, key, "salt").sortBy(key, "salt").saveAsTable(name)


def sparse_key(rows: DataFrame, name: str) -> DataFrame:
    """A unique, increasing, gappy number per row; needs no shuffle and no second pass."""
    return rows.select(F.monotonically_increasing_id().alias(name), *rows.columns)


def dense_key(rows: DataFrame, name: str) -> DataFrame:
    """Numbers 0, 1, 2, ... without gaps.

    The rows are written once. A row's number is its index within its file plus the
    row count of the files before it; only those per-file counts meet in one window.
    """
    stored = cut(rows, "numbered")
    placed = stored.select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__index"),
        *rows.columns,
    )
    counts = placed.groupBy("__file").agg(n_rows().alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    if len(stored.inputFiles()) <= BROADCAST_FILES:
        numbered = placed.join(F.broadcast(offsets), "__file")
    else:
        numbered = attach(placed, offsets, ["__file"], how="inner")
    return numbered.select((F.col("__before") + F.col("__index")).alias(name), *rows.columns)


def _empty(spark: SparkSession, table: Table) -> DataFrame:
    return spark.createDataFrame([], table.schema)
