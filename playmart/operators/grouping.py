"""Group operators that stay safe when one key holds a large share of the rows.

All of them reduce with map-side partial aggregation first, and none gathers a
group into one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


REPORT_ROWS = 100_000


def n_rows() -> Column:
    return F.count(F.lit(1))


def attach(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    how: str = "left",
    nulls_match: bool = False,
) -> DataFrame:
    """Join per-key ``facts`` (one row per key) back onto ``rows``.

    The join key includes a hash of the key. It changes no result, but it makes
    Spark shuffle the aggregated side again instead of reusing the aggregate's own
    partitioning, and with a shuffle directly under both sides adaptive execution
    can split a hot key's rows over many tasks (or broadcast, once it has measured
    the facts to be small). Reusing the partitioning would rule both out.
    """
    prefix = "__fact_"
    extra = [c for c in facts.columns if c not in keys]
    facts = facts.select(*[F.col(k).alias(prefix + k) for k in keys], *extra)
    ours, theirs = [F.col(k) for k in keys], [F.col(prefix + k) for k in keys]
    same = [a.eqNullSafe(b) if nulls_match else a == b for a, b in zip(ours, theirs)]
    same.append(F.xxhash64(*ours) == F.xxhash64(*theirs))
    joined = rows.join(facts, reduce(and_, same), how)
    return joined.drop(*[prefix + k for k in keys]) if how in ("left", "inner") else joined


def keep_groups(rows: DataFrame, keys: list[str], having: Column) -> DataFrame:
    """All rows whose group satisfies ``having``, an aggregate condition."""
    groups = rows.groupBy(*keys).agg(having.alias("__keep")).where("__keep").drop("__keep")
    return attach(rows, groups, keys, how="left_semi")


def keep_first_groups(rows: DataFrame, keys: list[str], having: Column, n: int) -> DataFrame:
    """Rows of the ``n`` smallest keys whose group satisfies ``having``.

    Enough for any report that sorts by the keys and stops within ``n`` rows, because
    every kept group has at least one row. The key list has at most ``n`` rows; up to
    ``REPORT_ROWS`` it is broadcast and the rows need no shuffle, beyond that it is
    joined like any other facts.
    """
    groups = (
        rows.groupBy(*keys)
        .agg(having.alias("__keep"))
        .where("__keep")
        .select(*keys)
        .orderBy(*[F.col(k).asc_nulls_last() for k in keys])
        .limit(n)
    )
    if n > REPORT_ROWS:
        return attach(rows, groups, keys, "left_semi")
    return rows.join(F.broadcast(groups), keys, "left_semi")


def several(c: str | Column) -> Column:
    """Aggregate condition: the group has more than one distinct non-NULL value.

    Same truth as ``count(distinct c) > 1`` with one shuffle less.
    """
    return F.coalesce(F.min(c) < F.max(c), F.lit(False))


def pick_best(score: Column, *values: str) -> Column:
    """Aggregate: the value tuple with the highest score.

    Ties go to the smallest values with NULLs last, one value after the other, so the
    pick depends on the data only. Read it back with ``best_field``.
    """
    order = [(-score).alias("rank")]
    for i, value in enumerate(values):
        order += [F.col(value).isNull().alias(f"absent{i}"), F.col(value).alias(value)]
    return F.min(F.struct(*order))


def best_field(picked: str, value: str) -> Column:
    return F.col(picked)[value]


def duplicate_groups(rows: DataFrame, copies_as: str = "copies") -> DataFrame:
    """Distinct rows that occur more than once, with the number of copies."""
    counted = rows.groupBy(*rows.columns).agg(n_rows().alias(copies_as))
    return counted.where(F.col(copies_as) > 1)
