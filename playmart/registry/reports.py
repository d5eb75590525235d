"""BI queries and data-profiling questions."""

from __future__ import annotations

from playmart.bindings import staging_events, staging_songs
from playmart.operators import workspace
from playmart.plans import dims, facts, identity, marts, profiling
from playmart.registry import Registry, relational

REGISTRY = Registry()
query = REGISTRY.query

NAMES = relational.SOME_NAMES
IDS = relational.SOME_IDS
NAME_LIST, ID_LIST = relational.quoted(NAMES), relational.quoted(IDS)
TITLES = ["Song 0", "Song 4"]
TITLE_LIST = relational.quoted(TITLES)


def songs(spark, sf_dir):
    return staging_songs(spark, sf_dir)


def events(spark, sf_dir):
    return staging_events(spark, sf_dir)


def rows(spark, sf_dir):
    return identity.artist_rows(songs(spark, sf_dir))


def flags(spark, sf_dir):
    return identity.artist_id_name_flags(songs(spark, sf_dir))


def working(spark, sf_dir):
    return workspace.cut(identity.working_rows(songs(spark, sf_dir)), "working")


# --- BI ----------------------------------------------------------------------------


@query(
    "artist_before",
    f"""
SELECT DISTINCT artist_id, artist_name AS name, artist_latitude AS latitude,
  artist_longitude AS longitude, artist_location AS location
FROM staging_songs WHERE artist_name IN ({NAME_LIST})""",
)
def artist_before(spark, sf_dir):
    return marts.artist_before(songs(spark, sf_dir), NAMES)


@query("artist_after", f"SELECT * FROM artist_names WHERE name IN ({NAME_LIST})")
def artist_after(spark, sf_dir):
    return marts.artist_after(identity.dim_artist_names(songs(spark, sf_dir)), NAMES)


@query(
    "top_users",
    """
SELECT u.first_name || ' ' || u.last_name AS full_name, count(sp.start_time) AS stream_count
FROM songplays sp LEFT JOIN users u ON sp.user_id = u.user_id
GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 5""",
    order=("stream_count", "full_name"),
)
def top_users(spark, sf_dir):
    log = events(spark, sf_dir)
    return marts.top_users(facts.fact_songplays(log), dims.dim_users(log))


@query(
    "busiest_hours",
    """
SELECT t.hour, count(sp.start_time) AS stream_count
FROM songplays sp LEFT JOIN time_dim t ON sp.start_time_key = t.time_key
GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 5""",
    order=("stream_count", "hour"),
)
def busiest_hours(spark, sf_dir):
    log = events(spark, sf_dir)
    times = staging_events(spark, sf_dir, "page", "ts")
    return marts.busiest_hours(facts.fact_songplays(log), dims.dim_time(times))


@query(
    "busiest_states",
    """
SELECT state, CAST(sum(stream_count) AS BIGINT) AS stream_count,
  CAST(sum(stream_duration) AS DECIMAL(29,4)) AS stream_duration
FROM state_plays GROUP BY 1 ORDER BY 2 DESC, 3 DESC NULLS LAST, 1 NULLS LAST LIMIT 5""",
    order=("stream_count", "stream_duration", "state"),
)
def busiest_states(spark, sf_dir):
    return marts.busiest_states(facts.fact_songplays(events(spark, sf_dir)))


@query(
    "top_artist_by_state",
    """
SELECT state, artist_name, stream_count, stream_duration FROM (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY stream_count DESC,
    stream_duration DESC NULLS LAST, artist_name ASC NULLS LAST) AS place FROM state_plays)
WHERE place = 1""",
)
def top_artist_by_state(spark, sf_dir):
    return marts.top_artist_by_state(facts.fact_songplays(events(spark, sf_dir)))


# --- artists -----------------------------------------------------------------------

REGISTRY["artist_counts"] = relational.REGISTRY["multi_count_distinct"]
REGISTRY["names_sharing_id"] = relational.REGISTRY["self_join_names_per_id"]
REGISTRY["ids_sharing_name"] = relational.REGISTRY["self_join_ids_per_name"]
REGISTRY["song_title_count"] = relational.REGISTRY["count_of_groups"]
REGISTRY["num_songs_values"] = relational.REGISTRY["frequency_table"]


@query(
    "multi_name_ids_summary",
    "SELECT count(*) AS artist_id_count, CAST(sum(n) AS BIGINT) AS artist_name_count "
    "FROM names_per_id WHERE n > 1",
)
def multi_name_ids_summary(spark, sf_dir):
    return profiling.multi_name_ids_summary(songs(spark, sf_dir))


@query(
    "names_with_most_ids",
    "SELECT artist_name, n AS artist_id_count FROM ids_per_name WHERE n > 1 "
    "ORDER BY n DESC, artist_name NULLS LAST LIMIT 15",
)
def names_with_most_ids(spark, sf_dir):
    return profiling.names_with_most_ids(songs(spark, sf_dir))


@query("single_name_id_count", "SELECT count(*) AS artist_id_count FROM names_per_id WHERE n = 1")
def single_name_id_count(spark, sf_dir):
    return profiling.single_name_id_count(songs(spark, sf_dir))


@query("single_id_name_count", "SELECT count(*) AS artist_name_count FROM ids_per_name WHERE n = 1")
def single_id_name_count(spark, sf_dir):
    return profiling.single_id_name_count(songs(spark, sf_dir))


@query(
    "clean_pair_count",
    "SELECT count(*) AS pair_count FROM id_name "
    "WHERE multiple_name_indicator = 0 AND multiple_id_indicator = 0",
)
def clean_pair_count(spark, sf_dir):
    return profiling.clean_pair_count(songs(spark, sf_dir))


@query(
    "pair_flags_sample",
    "SELECT * FROM id_name ORDER BY artist_id NULLS LAST, artist_name NULLS LAST LIMIT 10",
)
def pair_flags_sample(spark, sf_dir):
    return profiling.pair_flags_sample(flags(spark, sf_dir))


@query(
    "geo_variants",
    f"""
SELECT DISTINCT artist_id, artist_name, artist_latitude, artist_longitude, artist_location
FROM staging_songs WHERE artist_name IN ({NAME_LIST})
ORDER BY artist_name NULLS LAST, artist_id NULLS LAST, artist_latitude NULLS LAST,
  artist_longitude NULLS LAST, artist_location NULLS LAST LIMIT 50""",
)
def geo_variants(spark, sf_dir):
    return profiling.geo_variants(songs(spark, sf_dir), NAMES)


@query(
    "names_with_located_ids",
    "SELECT artist_name FROM staging_songs WHERE trim(artist_location) <> '' "
    "GROUP BY artist_name HAVING count(DISTINCT artist_id) > 1",
)
def names_with_located_ids(spark, sf_dir):
    return profiling.names_with_located_ids(songs(spark, sf_dir))


@query(
    "pair_lookup",
    f"""
SELECT * FROM id_name WHERE artist_id IN ({ID_LIST}) OR artist_name IN ({NAME_LIST})
ORDER BY artist_name NULLS LAST, artist_id NULLS LAST LIMIT 100""",
)
def pair_lookup(spark, sf_dir):
    return profiling.pair_lookup(flags(spark, sf_dir), IDS, NAMES)


@query(
    "artist_row_lookup",
    f"SELECT * FROM artist_row WHERE artist_id IN ({ID_LIST}) OR artist_name IN ({NAME_LIST})",
)
def artist_row_lookup(spark, sf_dir):
    return profiling.artist_row_lookup(rows(spark, sf_dir), IDS, NAMES)


@query(
    "located_rows_page",
    """
SELECT * FROM artist_row WHERE artist_latitude IS NOT NULL
  AND EXISTS (SELECT 1 FROM id_name WHERE multiple_id_indicator = 1)
ORDER BY artist_name NULLS LAST, artist_id NULLS LAST, artist_latitude NULLS LAST,
  artist_latitude_score, artist_longitude NULLS LAST, artist_longitude_score,
  artist_lat_long_score, artist_location NULLS LAST, artist_location_score
LIMIT 10 OFFSET 900""",
)
def located_rows_page(spark, sf_dir):
    return profiling.located_rows_page(rows(spark, sf_dir), flags(spark, sf_dir))


@query(
    "step_progress",
    "SELECT (SELECT count(*) FROM id_name) AS pair_count, "
    "(SELECT count(*) FROM working) AS working_row_count",
)
def step_progress(spark, sf_dir):
    return profiling.step_progress(spark, flags(spark, sf_dir), working(spark, sf_dir))


@query(
    "resolution_trace",
    f"""
SELECT r.artist_id, r.artist_name, s.recalculated_artist_id,
  r.artist_latitude AS original_latitude, s.artist_latitude AS best_latitude,
  r.artist_longitude AS original_longitude, s.artist_longitude AS best_longitude,
  r.artist_location AS original_location, s.artist_location AS best_location,
  s.multiple_id_indicator, s.multiple_name_indicator
FROM artist_row r LEFT JOIN steps14 s
  ON s.original_artist_id = r.artist_id AND s.artist_name = r.artist_name
WHERE r.artist_id IN ({ID_LIST}) OR r.artist_name IN ({NAME_LIST})
ORDER BY r.artist_id NULLS LAST, r.artist_name NULLS LAST, original_latitude NULLS LAST,
  original_longitude NULLS LAST, original_location NULLS LAST LIMIT 40""",
)
def resolution_trace(spark, sf_dir):
    return profiling.resolution_trace(
        rows(spark, sf_dir), identity.steps_1_to_4(songs(spark, sf_dir)), IDS, NAMES, 40
    )


@query(
    "unresolved_count",
    "SELECT count(*) AS unresolved_count FROM working WHERE recalculated_artist_id IS NULL",
)
def unresolved_count(spark, sf_dir):
    return profiling.unresolved_count(working(spark, sf_dir))


@query(
    "changed_id_groups",
    """
SELECT w.* FROM working w JOIN (
  SELECT recalculated_artist_id AS id FROM working GROUP BY 1 HAVING count(*) > 1
    AND count(*) FILTER (recalculated_artist_id <> original_artist_id) > 0) g
  ON g.id = w.recalculated_artist_id
ORDER BY artist_name NULLS LAST, step, original_artist_id NULLS LAST,
  recalculated_artist_id NULLS LAST LIMIT 200""",
)
def changed_id_groups(spark, sf_dir):
    return profiling.changed_id_groups_report(working(spark, sf_dir))


@query(
    "names_with_many_final_ids",
    """
SELECT count(*) AS name_count FROM (SELECT artist_name FROM step6 GROUP BY 1
  HAVING count(DISTINCT recalculated_artist_id) > 1)""",
)
def names_with_many_final_ids(spark, sf_dir):
    return profiling.names_with_many_final_ids(working(spark, sf_dir))


@query(
    "resolved_lookup",
    f"""
SELECT * FROM working WHERE original_artist_id IN ({ID_LIST})
ORDER BY artist_name NULLS LAST, original_artist_id NULLS LAST, step LIMIT 100""",
)
def resolved_lookup(spark, sf_dir):
    return profiling.resolved_lookup(working(spark, sf_dir), IDS)


# --- songs -------------------------------------------------------------------------


def _text_and_number(table, column, where=""):
    return f"""
SELECT min({column}) AS min_text, max({column}) AS max_text,
  min(TRY_CAST({column} AS DECIMAL(38,19))) AS min_number,
  max(TRY_CAST({column} AS DECIMAL(38,19))) AS max_number FROM {table} {where}"""


@query("duration_precision", _text_and_number("staging_songs", "duration"))
def duration_precision(spark, sf_dir):
    return profiling.text_and_number_range(songs(spark, sf_dir), "duration")


@query("length_precision", _text_and_number("plays", "length"))
def length_precision(spark, sf_dir):
    log = staging_events(spark, sf_dir, "page", "length")
    return profiling.text_and_number_range(dims.plays(log), "length")


def _crowded(key, having, offset=0):
    rest = [c for c in profiling.SONG_COLUMNS if c not in key]
    order = ", ".join(f"s.{c} NULLS LAST" for c in [*key, *rest])
    return f"""
SELECT s.song_id, s.num_songs, s.title, s.artist_name, s.year, s.duration
FROM staging_songs s JOIN (
  SELECT {', '.join(key)} FROM staging_songs GROUP BY ALL HAVING {having}) g
  ON {' AND '.join(f's.{c} = g.{c}' for c in key)}
ORDER BY {order} LIMIT 10 OFFSET {offset}"""


@query("song_id_many_titles", _crowded(["song_id"], "count(DISTINCT title) > 1"))
def song_id_many_titles(spark, sf_dir):
    return profiling.song_id_many_titles(songs(spark, sf_dir))


@query("song_id_many_artists", _crowded(["song_id"], "count(DISTINCT artist_name) > 1"))
def song_id_many_artists(spark, sf_dir):
    return profiling.song_id_many_artists(songs(spark, sf_dir))


@query("title_many_artists", _crowded(["title"], "count(DISTINCT artist_name) > 1", 210))
def title_many_artists(spark, sf_dir):
    return profiling.title_many_artists(songs(spark, sf_dir))


@query("duplicate_artist_title", _crowded(["title", "artist_name"], "count(*) > 1", 2100))
def duplicate_artist_title(spark, sf_dir):
    return profiling.duplicate_artist_title(songs(spark, sf_dir))


@query(
    "title_or_artist_lookup",
    f"""
SELECT * FROM staging_songs WHERE title IN ({TITLE_LIST}) OR artist_name = 'Artist 6'
ORDER BY title NULLS LAST, song_id NULLS LAST, num_songs NULLS LAST, artist_name NULLS LAST,
  artist_latitude NULLS LAST, year NULLS LAST, duration NULLS LAST, artist_id NULLS LAST,
  artist_longitude NULLS LAST, artist_location NULLS LAST LIMIT 20""",
)
def title_or_artist_lookup(spark, sf_dir):
    return profiling.title_or_artist_lookup(songs(spark, sf_dir), TITLES, "Artist 6")


# --- users and plays ---------------------------------------------------------------


@query(
    "null_user_count",
    "SELECT count(*) FILTER (userId IS NULL) AS null_user_count FROM staging_events",
)
def null_user_count(spark, sf_dir):
    return profiling.null_user_count(staging_events(spark, sf_dir, "userId"))


@query(
    "users_many_levels",
    """
SELECT DISTINCT userId, firstName, lastName, level FROM plays WHERE userId IN (
  SELECT userId FROM plays GROUP BY userId HAVING count(DISTINCT level) > 1)
ORDER BY userId NULLS LAST, level NULLS LAST, firstName NULLS LAST, lastName NULLS LAST LIMIT 10""",
)
def users_many_levels(spark, sf_dir):
    return profiling.users_many_levels(events(spark, sf_dir))


@query(
    "duplicate_plays",
    "SELECT *, count(*) AS copies FROM songplays GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_plays(spark, sf_dir):
    return profiling.duplicate_plays(events(spark, sf_dir))


@query(
    "unmatched_plays",
    """
SELECT count(*) AS unmatched_plays, count(DISTINCT (artist_name, song_title)) AS unmatched_titles
FROM songplays p WHERE NOT EXISTS (SELECT 1 FROM song_titles t
  WHERE t.artist_name = p.artist_name AND t.title = p.song_title)""",
)
def unmatched_plays(spark, sf_dir):
    return profiling.unmatched_plays(
        facts.fact_songplays(events(spark, sf_dir)), dims.dim_song_titles(songs(spark, sf_dir))
    )


@query(
    "epoch_exploration",
    """
SELECT ts, CAST(CAST(ts AS DECIMAL(18,0)) * 0.001 AS DECIMAL(18,3)) AS seconds,
  TIMESTAMP '1970-01-01' AS epoch_start, make_timestamp(CAST(ts AS BIGINT) * 1000) AS start_time,
  userId FROM staging_events ORDER BY ts NULLS LAST, userId NULLS LAST LIMIT 2""",
)
def epoch_exploration(spark, sf_dir):
    return profiling.epoch_exploration(staging_events(spark, sf_dir, "ts", "userId"))


REGISTRY["time_dim_preview"] = relational.REGISTRY["limit_n"]
