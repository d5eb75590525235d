"""Composite jobs: artist identity, dimensions, fact and the whole build."""

from __future__ import annotations

from pyspark.sql import functions as F

from playmart import schemas as S
from playmart.bindings import staging_events, staging_songs
from playmart.operators import layout, versions, workspace
from playmart.plans import dims, facts, identity, warehouse
from playmart.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query


@query("artist_rows", "SELECT * FROM artist_row")
def artist_rows(spark, sf_dir):
    return identity.artist_rows(staging_songs(spark, sf_dir))


@query("artist_id_name_flags", "SELECT * FROM id_name")
def artist_id_name_flags(spark, sf_dir):
    return identity.artist_id_name_flags(staging_songs(spark, sf_dir))


def _one_step(step):
    def run(spark, sf_dir):
        return identity.one_step(staging_songs(spark, sf_dir), step)

    return run


for _step in (1, 2, 3, 4):
    query(f"artist_names_step{_step}", f"SELECT * FROM step{_step}")(_one_step(_step))


def first_four(spark, sf_dir):
    return workspace.cut(identity.steps_1_to_4(staging_songs(spark, sf_dir)), "artist-steps")


@query("artist_names_step5", "SELECT * FROM step5")
def artist_names_step5(spark, sf_dir):
    return identity.step_5(first_four(spark, sf_dir))


@query("artist_names_step6", "SELECT * FROM step6")
def artist_names_step6(spark, sf_dir):
    fifth = identity.step_5(first_four(spark, sf_dir))
    return identity.step_6(workspace.cut(fifth, "artist-step-5"))


@query(
    "resolve_artist_ids",
    "SELECT DISTINCT artist_name, recalculated_artist_id FROM step5 WHERE artist_name IS NOT NULL",
)
def resolve_artist_ids(spark, sf_dir):
    return identity.resolve_artist_ids(staging_songs(spark, sf_dir))


@query(
    "best_attributes",
    """
SELECT artist_name, geo.lat AS artist_latitude, geo.lon AS artist_longitude,
  loc.place AS artist_location FROM (
  SELECT artist_name,
    first(struct_pack(lat := artist_latitude, lon := artist_longitude)
      ORDER BY artist_lat_long_score DESC, artist_latitude NULLS LAST, artist_longitude NULLS LAST)
      AS geo,
    first(struct_pack(place := artist_location)
      ORDER BY artist_location_score DESC, artist_location NULLS LAST) AS loc
  FROM artist_row WHERE artist_name IS NOT NULL GROUP BY artist_name)""",
)
def best_attributes(spark, sf_dir):
    rows = identity.artist_rows_once(staging_songs(spark, sf_dir)).dropna(subset=["artist_name"])
    return identity.best_attributes(rows, ["artist_name"])


@query("dim_artist_names", "SELECT * FROM artist_names")
def dim_artist_names(spark, sf_dir):
    return identity.dim_artist_names(staging_songs(spark, sf_dir))


@query("dim_song_titles", "SELECT * FROM song_titles")
def dim_song_titles(spark, sf_dir):
    return dims.dim_song_titles(staging_songs(spark, sf_dir))


@query(
    "dim_song_titles_lexical",
    """
SELECT artist_name, title, TRY_CAST(max(year) AS INTEGER) AS year,
  TRY_CAST(max(duration) AS DECIMAL(19,4)) AS duration
FROM staging_songs GROUP BY artist_name, title""",
)
def dim_song_titles_lexical(spark, sf_dir):
    return dims.dim_song_titles_lexical(staging_songs(spark, sf_dir))


@query("dim_users", "SELECT * FROM users")
def dim_users(spark, sf_dir):
    return dims.dim_users(staging_events(spark, sf_dir))


@query("dim_time", "SELECT * FROM time_dim")
def dim_time(spark, sf_dir):
    return dims.dim_time(staging_events(spark, sf_dir, "page", "ts"))


@query("fact_songplays", "SELECT * FROM songplays")
def fact_songplays(spark, sf_dir):
    return facts.fact_songplays(staging_events(spark, sf_dir))


@query(
    "build_warehouse",
    """
SELECT 'artist_names' AS table_name, count(*) AS row_count FROM artist_names
  WHERE artist_id IS NOT NULL
UNION ALL SELECT 'song_titles', count(*) FROM song_titles
  WHERE artist_name IS NOT NULL AND title IS NOT NULL AND year IS NOT NULL
    AND duration IS NOT NULL
UNION ALL SELECT 'users', count(*) FROM users
UNION ALL SELECT 'time', count(*) FROM time_dim
UNION ALL SELECT 'songplays', count(*) FROM songplays
UNION ALL SELECT 'staging_artist_row', count(*) FROM artist_row
UNION ALL SELECT 'staging_artist_id_name', count(*) FROM id_name
UNION ALL SELECT 'staging_artist_names', count(*) FROM working""",
)
def build_warehouse(spark, sf_dir):
    """JSON objects on disk to all tables; returns the row count of each stored table."""
    root = workspace.fresh_dir(spark, "warehouse")
    staging_events(spark, sf_dir).write.json(f"{root}/source/log")
    staging_songs(spark, sf_dir).write.json(f"{root}/source/songs")
    sources = warehouse.Sources(f"{root}/source/log", f"{root}/source/songs")
    warehouse.build(spark, sources, f"{root}/tables", working=True)
    folder, counted = versions.current(spark, f"{root}/tables"), None
    for table in (*S.MART_TABLES, *S.WORKING_TABLES):
        one = layout.read_table(spark, folder, table).agg(
            F.lit(table.name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted
