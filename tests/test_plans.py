"""The physical plans: what they must contain and what must never appear."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from playmart.operators.grouping import (
    attach,
    keep_first_groups,
    keep_groups,
    n_rows,
    several,
)
from playmart.operators.ranking import first_pairs, first_row_per, number_in_order
from playmart.operators.workspace import cut
from playmart.plans import dims, facts
from playmart.schemas import STAGING_EVENTS
from tests.conftest import plan_of, rows_of

SF_DIR = "/root/testdata/sf0.001"
RUNS = entry.queries()


@pytest.mark.parametrize("key", ["dim_users", "top_artist_by_state", "row_number_latest"])
def test_groups_are_limited_before_the_shuffle(spark, key):
    plan = plan_of(RUNS[key](spark, SF_DIR))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", plan)]
    assert len(limits) == 2
    assert limits[0] < plan.index("Exchange hashpartitioning", limits[0]) < limits[1]


def test_scans_are_pruned_and_filters_pushed(spark):
    stored = cut(spark.createDataFrame([tuple("x" for _ in STAGING_EVENTS.columns)], STAGING_EVENTS.schema))
    plan = plan_of(dims.dim_time(stored))
    assert "EqualTo(page,NextSong)" in plan
    assert "ReadSchema: struct<page:string,ts:string>" in plan
    assert "Exchange" not in plan_of(facts.fact_songplays(stored))


def test_a_hot_key_is_split_when_facts_are_joined_back(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    facts_per_key = rows.groupBy("k").agg(n_rows().alias("n"))
    for joined, total in (
        (attach(rows, facts_per_key, ["k"]), 300_000),
        (attach(rows, facts_per_key, ["k"], nulls_match=True), 300_000),
        (keep_groups(rows, ["k"], n_rows() > 1), 100_000),
    ):
        used = [F.sum("n")] if "n" in joined.columns else []
        out = joined.agg(F.count_if(F.length("text") > 0), *used)
        execution = out._jdf.queryExecution()
        assert out.collect()[0][0] == total
        assert "skew=true" in execution.executedPlan().toString()


def random_members(rng):
    groups = [f"g{k}" for k in range(rng.randint(1, 8))] + [None]
    members = [f"m{k}" for k in range(rng.randint(1, 12))] + [None]
    return [(rng.choice(groups), rng.choice(members)) for _ in range(rng.randint(1, 60))]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("ordered", [True, False])
def test_first_pairs_equal_brute_force(spark, seed, ordered):
    rows = random_members(random.Random(seed))
    n = 4
    known = {(g, m) for g, m in rows if g is not None and m is not None}
    pairs = sorted(
        (g, a, b)
        for g, a in known
        for h, b in known
        if g == h and (a > b if ordered else a != b)
    )
    frame = spark.createDataFrame(rows, "g string, m string")
    found = [tuple(r) for r in first_pairs(frame, "g", "m", n, ordered).collect()]
    assert found == pairs[:n]


@pytest.mark.parametrize("n", [1, 7, 40, 2000])
@pytest.mark.parametrize("ordered", [True, False])
def test_first_pairs_of_any_number(spark, n, ordered):
    rows = [(f"g{k % 3}", f"m{k % 11:02}") for k in range(33)] + [("h", f"m{k}") for k in range(3)]
    known = set(rows)
    pairs = sorted((g, a, b) for g, a in known for h, b in known if g == h and (a > b if ordered else a != b))
    found = first_pairs(spark.createDataFrame(rows, "g string, m string"), "g", "m", n, ordered)
    assert [tuple(r) for r in found.collect()] == pairs[:n]


@pytest.mark.parametrize("ordered", [True, False])
def test_first_pairs_of_a_large_group(spark, ordered):
    """2,000 pairs of one group of 100,000 members, without ever making more."""
    rows = spark.range(100_000).select(F.lit("g").alias("g"), "id")
    found = first_pairs(rows, "g", "id", 2000, ordered)
    got = [tuple(r)[1:] for r in found.collect()]
    if ordered:
        assert got == [(a, b) for a in range(1, 70) for b in range(a)][:2000]
    else:
        assert got == [(0, b) for b in range(1, 2001)]


def test_many_rows_of_a_hot_group(spark, settings):
    """The first 5,000 rows of each group, a third of all rows in one; no task holds a group."""
    settings(spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false")
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    rows = spark.range(300_000).select(key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"), "id")
    top = first_row_per(rows, ["k"], [F.desc("v"), F.asc("id")], 5000, rank_as="place")
    assert "row_number" not in plan_of(top)
    expected = {}
    for k, v, i in rows.collect():
        expected.setdefault(k, []).append((-v, i))
    expected = {k: [i for _, i in sorted(own)[:5000]] for k, own in expected.items()}
    got = {}
    for r in top.orderBy("k", "place").collect():
        got.setdefault(r["k"], []).append(r["id"])
    assert got == expected


def test_numbers_follow_the_order(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 90).alias("v"), "id")
    got = number_in_order(rows, [F.col("v").desc_nulls_last(), F.asc("id")], "place").collect()
    expected = sorted(got, key=lambda r: (r["v"] is None, -(r["v"] or 0), r["id"]))
    assert [r["place"] for r in expected] == list(range(1, 5001))


@pytest.mark.parametrize("seed", range(3))
def test_group_operators_equal_brute_force(spark, seed):
    rows = random_members(random.Random(50 + seed))
    frame = spark.createDataFrame(rows, "g string, m string").repartition(4)
    distinct = {}
    for g, m in rows:
        distinct.setdefault(g, set()).add(m)
    crowded = sorted(g for g in distinct if g is not None and len(distinct[g] - {None}) > 1)
    expected = sorted((r for r in rows if r[0] in crowded), key=repr)
    assert rows_of(keep_groups(frame, ["g"], several("m"))) == expected
    first = sorted((r for r in rows if r[0] in crowded[:2]), key=repr)
    assert rows_of(keep_first_groups(frame, ["g"], several("m"), 2)) == first
    top = first_row_per(frame, ["g"], [F.col("m").asc_nulls_last()], 1)
    assert rows_of(top) == sorted(
        ((g, min(ms - {None}) if ms - {None} else None) for g, ms in distinct.items()), key=repr
    )
    sizes = frame.groupBy("g").agg(n_rows().alias("n"))
    matched = {r[0]: r[2] for r in rows_of(attach(frame, sizes, ["g"], nulls_match=True))}
    assert matched == {g: sum(r[0] == g for r in rows) for g in distinct}
    equal = {r[0]: r[2] for r in rows_of(attach(frame, sizes, ["g"]))}
    assert equal == {g: (None if g is None else n) for g, n in matched.items()}
