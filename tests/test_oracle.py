"""Every registered query against its independent SQL, on whole tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import plan_of
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
RUNS = {key: query.run for key, query in entry.warehouse().items()}
SQLS = {key: query.sql for key, query in entry.warehouse().items()}
ORDERS = {key: query.order for key, query in entry.warehouse().items()}


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


# Their one window without a partition runs over one row per file or, for pairs, per group among the
# first n, not over the rows.
FILE_OFFSETS = {"surrogate_key", "order_by_position", "null_order_position", "top_n_per_group"}
FILE_OFFSETS |= {"self_join_names_per_id", "self_join_ids_per_name", "names_sharing_id", "ids_sharing_name"}
FILE_OFFSETS |= {"first_pairs_many"}


@pytest.mark.parametrize("key", sorted(RUNS))
def test_query_matches_oracle(spark, settings, db, key):
    """Without automatic broadcasts, so that the plans are those of large inputs."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    result = RUNS[key](spark, SF_DIR)
    plan = plan_of(result)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Python|ArrowEval|MapInPandas|MapInArrow", plan)
    lone_window = re.search(r"Window \[.*\n.*Sort \[.*\n.*Exchange SinglePartition", plan)
    assert bool(lone_window) == (key in FILE_OFFSETS)
    assert differences(result, db, SQLS[key], ORDERS[key]) == ""


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_comparison_notices_names_types_and_rows(spark, db):
    one = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert differences(one, db, "SELECT CAST(1 AS INTEGER) AS a, 'x' AS b") == ""
    assert differences(one, db, "SELECT CAST(1 AS INTEGER) AS a, 'x' AS c").startswith("columns")
    assert differences(one, db, "SELECT CAST(1 AS BIGINT) AS a, 'x' AS b").startswith("types")
    assert differences(one, db, "SELECT CAST(2 AS INTEGER) AS a, 'x' AS b").startswith("rows")
    down = spark.sql("SELECT id AS a, id % 2 AS b FROM range(5) ORDER BY b, a DESC")
    up = "SELECT range AS a, range % 2 AS b FROM range(5) ORDER BY b, a"
    assert differences(down, db, up, ("b",)) == ""
    assert differences(down, db, up, ("b", "a")).startswith("sequence")
    nulls = spark.sql("SELECT * FROM VALUES (1), (NULL) AS t(a) ORDER BY a NULLS FIRST")
    last = "SELECT * FROM (VALUES (CAST(1 AS INTEGER)), (NULL)) t(a) ORDER BY a NULLS LAST"
    assert differences(nulls, db, last) == ""
    assert differences(nulls, db, last, ("a",)).startswith("sequence")
    twice = "SELECT CAST(1 AS INTEGER) AS a, 'x' AS b FROM range(2)"
    assert differences(one, db, twice).startswith("rows")
