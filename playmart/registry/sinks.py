"""Sinks, table management, layout and contract checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from playmart import schemas as S
from playmart.bindings import staging_events, staging_songs, table
from playmart.operators import layout, quality, versions, workspace
from playmart.plans import dims, facts, identity
from playmart.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query


def songplays(spark, sf_dir):
    return facts.fact_songplays(staging_events(spark, sf_dir))


def row_count(rows, name):
    return rows.agg(F.count(F.lit(1)).alias(name))


@query("create_schema", "SELECT * FROM users")
def create_schema(spark, sf_dir):
    """Create the ten tables (twice: the second time must change nothing), fill one."""
    root = workspace.fresh_dir(spark, "tables")
    layout.create_tables(spark, root, list(S.ALL_TABLES.values()))
    users = dims.dim_users(staging_events(spark, sf_dir))
    layout.insert_select(users, root, S.USERS)
    layout.create_tables(spark, root, list(S.ALL_TABLES.values()))
    return layout.read_table(spark, root, S.USERS)


@query("replace_table", "SELECT * FROM time_dim")
def replace_table(spark, sf_dir):
    """Writing a table again replaces its rows."""
    root = workspace.fresh_dir(spark, "tables")
    time = dims.dim_time(staging_events(spark, sf_dir, "page", "ts"))
    for _ in range(2):
        layout.replace_table(time, root, S.TIME)
    return layout.read_table(spark, root, S.TIME)


@query("insert_select", "SELECT * FROM time_dim UNION ALL SELECT * FROM time_dim")
def insert_select(spark, sf_dir):
    """Appending matches columns by name, here given in another order."""
    root = workspace.fresh_dir(spark, "tables")
    time = dims.dim_time(staging_events(spark, sf_dir, "page", "ts"))
    for columns in (time.columns, time.columns[::-1]):
        layout.insert_select(time.select(*columns), root, S.TIME)
    return layout.read_table(spark, root, S.TIME)


@query("step_append", "SELECT * FROM working")
def step_append(spark, sf_dir):
    return identity.working_rows(staging_songs(spark, sf_dir))


@query(
    "clear_table",
    """
SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_cleared,
  count(*) AS rows_reloaded FROM songplays""",
)
def clear_table(spark, sf_dir):
    """Rows of the fact before clearing, after clearing and after loading it again."""
    root = workspace.fresh_dir(spark, "tables")
    plays = songplays(spark, sf_dir)
    counts = []
    layout.insert_select(plays, root, S.SONGPLAYS)
    counts.append(layout.read_table(spark, root, S.SONGPLAYS).count())
    layout.clear_table(spark, root, S.SONGPLAYS)
    counts.append(layout.read_table(spark, root, S.SONGPLAYS).count())
    layout.insert_select(plays, root, S.SONGPLAYS)
    reloaded = row_count(layout.read_table(spark, root, S.SONGPLAYS), "rows_reloaded")
    return reloaded.select(
        F.lit(counts[0]).cast("bigint").alias("rows_before"),
        F.lit(counts[1]).cast("bigint").alias("rows_cleared"),
        "rows_reloaded",
    )


@query(
    "replicate_dim",
    """
SELECT gender, count(*) AS stream_count FROM songplays
LEFT JOIN users USING (user_id) GROUP BY gender""",
)
def replicate_dim(spark, sf_dir):
    events = staging_events(spark, sf_dir)
    users = layout.replicate_dim(workspace.cut(dims.dim_users(events), "users"))
    return (
        facts.fact_songplays(events)
        .join(users.select("user_id", "gender"), "user_id", "left")
        .groupBy("gender")
        .agg(F.count(F.lit(1)).alias("stream_count"))
    )


@query(
    "colocate_by_key",
    """
SELECT s.title, count(*) AS pair_count
FROM songplays p JOIN song_titles s ON s.title = p.song_title GROUP BY s.title""",
)
def colocate_by_key(spark, sf_dir):
    """Plays and song titles in matching buckets, counted per title after the join.

    Titles are counted on either side of the join first, so no pairs are spelled out.
    """
    tag = workspace.fresh_dir(spark, "colocated")
    suffix = tag.rsplit("-", 1)[1]
    names = (f"plays_{suffix}", f"titles_{suffix}")
    paths = (f"{tag}/plays", f"{tag}/titles")
    plays = layout.sparse_key(
        songplays(spark, sf_dir).select("song_title"), "songplay_id"
    )
    titles = dims.dim_song_titles(staging_songs(spark, sf_dir)).where("title is not null")
    layout.write_colocated(
        plays, "song_title", "songplay_id", titles, "title", names, paths, buckets=8
    )
    played = (
        spark.table(names[0])
        .groupBy("song_title", "salt")
        .agg(F.count(F.lit(1)).alias("plays"))
        .withColumnRenamed("song_title", "title")
    )
    listed = spark.table(names[1]).groupBy("title", "salt").agg(F.count(F.lit(1)).alias("listed"))
    return (
        played.join(listed, ["title", "salt"])
        .groupBy("title")
        .agg(F.sum(F.col("plays") * F.col("listed")).alias("pair_count"))
    )


@query("cluster_by_sortkey", "SELECT * FROM songplays")
def cluster_by_sortkey(spark, sf_dir):
    path = workspace.fresh_dir(spark, "clustered")
    plays = songplays(spark, sf_dir)
    layout.cluster_by_sortkey(plays, path, S.SONGPLAYS.sort_by, ("user_id", "session_id"))
    return spark.read.schema(plays.schema).parquet(path)


@query(
    "check_contract",
    """
SELECT column_name, rule, violations FROM (
  SELECT 'name' AS column_name, 'not null' AS rule, count(*) FILTER (name IS NULL) AS violations,
    1 AS o FROM artist_names
  UNION ALL SELECT 'artist_id', 'not null', count(*) FILTER (artist_id IS NULL), 2
    FROM artist_names
  UNION ALL SELECT 'name', 'max length 1000', count(*) FILTER (strlen(name) > 1000), 3
    FROM artist_names
  UNION ALL SELECT 'artist_id', 'max length 256', count(*) FILTER (strlen(artist_id) > 256), 4
    FROM artist_names
  UNION ALL SELECT 'location', 'max length 1000', count(*) FILTER (strlen(location) > 1000), 5
    FROM artist_names)""",
)
def check_contract(spark, sf_dir):
    names = identity.dim_artist_names(staging_songs(spark, sf_dir))
    return quality.check_contract(names, S.ARTIST_NAMES)


@query(
    "check_primary_key",
    """
SELECT artist_id AS artist_id, artist_name AS artist_name, count(*) AS row_count
FROM artist_row GROUP BY artist_id, artist_name HAVING count(*) > 1""",
)
def check_primary_key(spark, sf_dir):
    """(id, name) is not a key of the artist rows; list the values that repeat."""
    return quality.check_primary_key(
        identity.artist_rows(staging_songs(spark, sf_dir)), ("artist_id", "artist_name")
    )


@query(
    "surrogate_key",
    """
SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS first_key, count(*) - 1 AS last_key,
  count(*) AS dense_keys, count(*) AS sparse_keys FROM songplays""",
)
def surrogate_key(spark, sf_dir):
    """Dense and sparse fact keys: range and number of distinct values."""
    plays = layout.dense_key(songplays(spark, sf_dir), "songplay_id")
    numbered = layout.sparse_key(plays, "sparse_id")
    return numbered.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("songplay_id").alias("first_key"),
        F.max("songplay_id").alias("last_key"),
        F.count_distinct("songplay_id").alias("dense_keys"),
        F.count_distinct("sparse_id").alias("sparse_keys"),
    )


def _longest(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(max(strlen({c})) AS INTEGER) AS max_length, "
        f"coalesce(max(strlen({c})) > 256, false) AS overflows FROM {table}"
        for c in columns
    )


@query("varchar_default_overflow", _longest("staging_songs", S.STAGING_SONGS.columns))
def varchar_default_overflow(spark, sf_dir):
    return quality.longest_text(staging_songs(spark, sf_dir))


@query(
    "enforce_contract",
    """
WITH plain AS (
  SELECT CAST(o_orderkey % 1000 AS INTEGER) AS user_id,
    CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE 'U' || CAST(o_custkey AS VARCHAR) END AS first_name,
    CASE WHEN o_orderkey % 50 = 11 THEN repeat('x', 257) ELSE o_orderpriority END AS last_name,
    o_orderstatus AS gender, CASE WHEN o_totalprice > 100000 THEN 'paid' ELSE 'free' END AS level
  FROM orders),
ruled AS (
  SELECT *, CASE WHEN first_name IS NULL THEN 'not null: first_name'
    WHEN length(last_name) > 256 THEN 'max length 256: last_name' END AS broken FROM plain),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, broken IS NULL
    ORDER BY first_name, last_name, gender, level) AS place FROM ruled)
SELECT user_id, first_name, last_name, gender, level,
  CASE WHEN broken IS NULL AND place > 1 THEN 'duplicate key' ELSE broken END AS rule FROM numbered""",
)
def enforce_contract(spark, sf_dir):
    """User rows with missing, over-long and repeated values: those kept, the others with their rule."""
    rows = table(spark, sf_dir, "orders").select(
        F.expr("CAST(o_orderkey % 1000 AS INT)").alias("user_id"),
        F.expr("CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE concat('U', o_custkey) END").alias("first_name"),
        F.expr("CASE WHEN o_orderkey % 50 = 11 THEN repeat('x', 257) ELSE o_orderpriority END").alias("last_name"),
        F.col("o_orderstatus").alias("gender"),
        F.expr("CASE WHEN o_totalprice > 100000 THEN 'paid' ELSE 'free' END").alias("level"),
    )
    kept, rejects = quality.enforce_contract(workspace.cut(rows, "users"), S.USERS)
    return kept.withColumn("rule", F.lit(None).cast("string")).unionByName(rejects)


@query("switch_version", "SELECT 'users' AS table_name, * FROM users")
def switch_version(spark, sf_dir):
    """A finished version stays what readers see while a later build stops midway."""
    root = workspace.fresh_dir(spark, "versions")
    users = dims.dim_users(staging_events(spark, sf_dir))
    with versions.new_version(spark, root) as folder:
        layout.replace_table(users, folder, S.USERS)
    try:
        with versions.new_version(spark, root) as folder:
            layout.replace_table(users.limit(1), folder, S.USERS)
            raise InterruptedError("stopped midway")
    except InterruptedError:
        pass
    rows = layout.read_table(spark, versions.current(spark, root), S.USERS)
    return rows.select(F.lit("users").alias("table_name"), "*")
