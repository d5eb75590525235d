"""Positions and ranks from a distributed sort, for any number of rows and any group size.

Rows are range-partitioned and sorted, written, and numbered by their place in the files (see
``layout.dense_key``). A rank within a group is then a difference of two positions, so neither a
group nor all rows ever meet in one task, whatever ``n`` is asked for. A window with a limit
is cheaper while ``n`` is small, see ``first_row_per``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.operators.grouping import attach, keep_first_groups, several
from playmart.operators.layout import dense_key


def number_in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with their place 1, 2, 3, ... in a stated order; ties take places in any order."""
    placed = dense_key(rows.repartitionByRange(*order).sortWithinPartitions(*order), "__place")
    return placed.select((F.col("__place") + 1).alias(name), *rows.columns)


def rank_in_groups(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Rows with their place 1, 2, 3, ... within their group; NULL keys form groups."""
    numbered = number_in_order(rows, [*[F.col(k).asc_nulls_first() for k in keys], *order], "__at")
    first = numbered.groupBy(*keys).agg(F.min("__at").alias("__first"))
    ranked = attach(numbered, first, keys, "inner", nulls_match=True)
    return ranked.select(*rows.columns, (F.col("__at") - F.col("__first") + 1).alias(name))


#: Up to so many rows per key Spark limits a ranking window inside every task.
WINDOW_LIMIT = 1000


def first_row_per(
    rows: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank_as: str | None = None
) -> DataFrame:
    """The first ``n`` rows per key.

    Up to ``WINDOW_LIMIT`` rows, Spark limits each group inside every task before the shuffle, so
    at most ``n`` rows per key and task travel, however large a group is. For more rows the
    ranks come from a distributed sort (``rank_in_groups``).
    """
    rank = rank_as or "__rank"
    if n > WINDOW_LIMIT:
        ranked = rank_in_groups(rows, keys, order, rank)
    else:
        ranked = rows.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(rank) <= n)
    return kept if rank_as else kept.drop(rank)


def first_pairs(members: DataFrame, group: str, member: str, n: int, ordered: bool) -> DataFrame:
    """The first ``n`` pairs of different members of one group, by (group, left, right).

    ``ordered`` asks for left > right, otherwise both directions count. Only the first ``n`` groups
    with two members and their first ``n + 1`` members can appear among the first ``n`` pairs. How
    many pairs come before those of a member follows from ranks alone, so just the ``n`` pairs
    asked for are made and never those of a whole group. Columns: group, ``left_member``,
    ``right_member``.
    """
    members = members.select(group, member).where(F.col(group).isNotNull() & F.col(member).isNotNull())
    some = keep_first_groups(members, [group], several(member), n).distinct()
    ranked = first_row_per(some, [group], [F.col(member).asc()], n + 1, rank_as="__i")
    i, m = F.col("__i").cast("bigint"), F.col("__m")
    sizes = ranked.groupBy(group).agg(F.max("__i").cast("bigint").alias("__m"))
    total = F.expr("__m * (__m - 1) div 2") if ordered else m * (m - 1)
    # one row per group, ``n`` at most
    earlier = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum(total).over(earlier), F.lit(0)))
    sizes = sizes.where(F.col("__before") < n)
    left = attach(ranked, sizes, [group], "inner")
    own = i - 1 if ordered else m - 1
    before = F.col("__before") + (F.expr("(__i - 1L) * (__i - 2L) div 2") if ordered else (i - 1) * (m - 1))
    left = left.select(group, F.col(member).alias("left_member"), i.alias("__i"), F.least(own, F.lit(n) - before).alias("__n"))
    left = left.where("__n > 0").withColumn("__j", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")))
    if not ordered:  # no member is paired with itself
        left = left.withColumn("__j", F.col("__j") + F.when(F.col("__j") >= F.col("__i"), 1).otherwise(0))
    right = ranked.select(group, F.col("__i").cast("bigint").alias("__j"), F.col(member).alias("right_member"))
    pairs = attach(left, right, [group, "__j"], "inner").select(group, "left_member", "right_member")
    return pairs.orderBy(group, "left_member", "right_member")
