"""Projection, filter, join, aggregate, window, sort and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from playmart.bindings import staging_events, staging_songs, table
from playmart.functions.casts import to_decimal, to_int
from playmart.operators import grouping, layout, ranking, workspace
from playmart.operators.grouping import n_rows
from playmart.plans import dims, facts, identity, marts, profiling
from playmart.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

# Values looked up by the filter queries; they exist in the bound tables at every scale.
SOME_NAMES = ["Various Artists", "Group 0", "Artist 6", "Collective 0/1"]
SOME_IDS = ["AR000000000002", "AR000000000003", "AR000000000004"]


def events(spark, sf_dir, *columns):
    return staging_events(spark, sf_dir, *columns)


def songs(spark, sf_dir):
    return staging_songs(spark, sf_dir)


def songplays(spark, sf_dir):
    return facts.fact_songplays(staging_events(spark, sf_dir))


def quoted(values):
    return ", ".join(f"'{v}'" for v in values)


# --- projections -------------------------------------------------------------------


@query(
    "project_rename",
    "SELECT song AS song_title, artist AS artist_name, userAgent AS user_agent "
    "FROM staging_events",
)
def project_rename(spark, sf_dir):
    return events(spark, sf_dir).select(
        F.col("song").alias("song_title"),
        F.col("artist").alias("artist_name"),
        F.col("userAgent").alias("user_agent"),
    )


@query(
    "lateral_alias",
    """
SELECT artist_id, artist_latitude_score AS lat_score, artist_longitude_score AS lon_score,
  artist_lat_long_score AS both_score, count(*) AS row_count
FROM artist_row GROUP BY 1, 2, 3, 4""",
)
def lateral_alias(spark, sf_dir):
    """A select item that uses the aliases made before it in the same select."""
    rows = identity.artist_rows(songs(spark, sf_dir))
    return spark.sql(
        """
        SELECT artist_id, artist_latitude_score AS lat_score, artist_longitude_score AS lon_score,
          lat_score + lon_score AS both_score, count(1) AS row_count
        FROM {rows} GROUP BY artist_id, artist_latitude_score, artist_longitude_score
        """,
        rows=rows,
    )


@query(
    "where_on_alias",
    "SELECT artist_id, artist_name AS name FROM staging_songs "
    f"WHERE artist_name IN ({quoted(SOME_NAMES)})",
)
def where_on_alias(spark, sf_dir):
    named = songs(spark, sf_dir).select("artist_id", F.col("artist_name").alias("name"))
    return named.where(F.col("name").isin(SOME_NAMES))


@query(
    "select_star",
    "SELECT a.* FROM artist_row a JOIN names_per_id n ON n.artist_id = a.artist_id WHERE n.n > 1",
)
def select_star(spark, sf_dir):
    """Every column of one side of a join."""
    rows = identity.artist_rows(songs(spark, sf_dir))
    return grouping.keep_groups(rows, ["artist_id"], _several_or_null("artist_name"))


def _several_or_null(column):
    """More than one distinct value when NULL counts as a value too."""
    mixed = F.max(F.col(column).isNull()) & F.max(F.col(column).isNotNull())
    return grouping.several(column) | mixed


@query(
    "constant_columns",
    "SELECT artist_id, artist_name, CAST(1 AS INTEGER) AS step, CAST(NULL AS INTEGER) AS flag "
    "FROM pairs",
)
def constant_columns(spark, sf_dir):
    return identity.artist_pairs(songs(spark, sf_dir)).select(
        "*", F.lit(1).alias("step"), F.lit(None).cast("int").alias("flag")
    )


# --- filters -----------------------------------------------------------------------


@query("filter_next_song", "SELECT ts, userId, song FROM staging_events WHERE page = 'NextSong'")
def filter_next_song(spark, sf_dir):
    return dims.plays(events(spark, sf_dir, "page", "ts", "userId", "song")).drop("page")


@query(
    "filter_in_list",
    f"SELECT * FROM staging_songs WHERE artist_name IN ({quoted(SOME_NAMES)}) "
    "AND TRY_CAST(year AS INTEGER) IN (1995, 1996, 1997)",
)
def filter_in_list(spark, sf_dir):
    return songs(spark, sf_dir).where(
        F.col("artist_name").isin(SOME_NAMES) & to_int("year").isin(1995, 1996, 1997)
    )


@query(
    "filter_and_or",
    f"SELECT * FROM id_name WHERE 1 = 1 AND (artist_id IN ({quoted(SOME_IDS)}) "
    "OR artist_name = 'Various Artists') "
    "AND (multiple_name_indicator = 0 OR multiple_id_indicator = 0)",
)
def filter_and_or(spark, sf_dir):
    flags = identity.artist_id_name_flags(songs(spark, sf_dir))
    return flags.where(
        (F.lit(1) == 1)
        & profiling.either(SOME_IDS, ["Various Artists"])
        & ((F.col("multiple_name_indicator") == 0) | (F.col("multiple_id_indicator") == 0))
    )


@query(
    "filter_inequality",
    "SELECT original_artist_id, artist_name, recalculated_artist_id FROM steps14 "
    "WHERE recalculated_artist_id <> original_artist_id AND step > 2",
)
def filter_inequality(spark, sf_dir):
    rows = identity.steps_1_to_4(songs(spark, sf_dir))
    changed = F.col("recalculated_artist_id") != F.col("original_artist_id")
    return rows.where(changed & (F.col("step") > 2)).select(
        "original_artist_id", "artist_name", "recalculated_artist_id"
    )


@query(
    "filter_null_tests",
    "SELECT * FROM artist_row WHERE artist_latitude IS NOT NULL AND artist_location IS NULL",
)
def filter_null_tests(spark, sf_dir):
    rows = identity.artist_rows(songs(spark, sf_dir))
    return rows.where(F.col("artist_latitude").isNotNull() & F.col("artist_location").isNull())


@query(
    "filter_not_blank",
    "SELECT artist_id, artist_name, artist_location FROM staging_songs "
    "WHERE trim(artist_location) <> ''",
)
def filter_not_blank(spark, sf_dir):
    return songs(spark, sf_dir).where(F.trim("artist_location") != "").select(
        "artist_id", "artist_name", "artist_location"
    )


# --- joins and subqueries ----------------------------------------------------------


@query(
    "self_join_names_per_id",
    """
SELECT a.artist_id, a.artist_name, b.artist_name AS other_artist_name
FROM pairs a JOIN pairs b ON a.artist_id = b.artist_id AND a.artist_name <> b.artist_name
ORDER BY 1, 2, 3 LIMIT 10""",
)
def self_join_names_per_id(spark, sf_dir):
    return profiling.names_sharing_id(songs(spark, sf_dir))


@query(
    "self_join_ids_per_name",
    """
SELECT a.artist_name, a.artist_id, b.artist_id AS other_artist_id
FROM pairs a JOIN pairs b ON a.artist_name = b.artist_name AND a.artist_id > b.artist_id
ORDER BY 1, 2, 3 LIMIT 10""",
)
def self_join_ids_per_name(spark, sf_dir):
    return profiling.ids_sharing_name(songs(spark, sf_dir))


@query(
    "left_join_composite",
    """
SELECT p.artist_id, p.artist_name, b.geo.lat AS artist_latitude, b.geo.lon AS artist_longitude,
  b.loc.place AS artist_location
FROM id_name p LEFT JOIN pair_best b
  ON b.artist_id = p.artist_id AND b.artist_name = p.artist_name""",
)
def left_join_composite(spark, sf_dir):
    rows = identity.artist_rows(songs(spark, sf_dir))
    best = identity.best_attributes(rows, identity.PAIR)
    return identity.artist_pairs(rows).join(best, identity.PAIR, "left")


@query(
    "left_join_lookup",
    """
SELECT p.artist_id, p.artist_name, s.found AS inherited_artist_id
FROM id_name p LEFT JOIN (
  SELECT artist_name, max(recalculated_artist_id) AS found FROM step3 GROUP BY artist_name) s
  ON s.artist_name = p.artist_name
WHERE p.multiple_name_indicator = 1 AND p.multiple_id_indicator = 1""",
)
def left_join_lookup(spark, sf_dir):
    """Pairs of the fourth class beside the id that the third class offers their name."""
    flags = identity.artist_id_name_flags(songs(spark, sf_dir))
    both = (F.col("multiple_name_indicator") == 1) & (F.col("multiple_id_indicator") == 1)
    offered = (
        flags.where("multiple_name_indicator = 0 and multiple_id_indicator = 1")
        .groupBy("artist_name")
        .agg(F.max("artist_id").alias("inherited_artist_id"))
    )
    return grouping.attach(flags.where(both), offered, ["artist_name"]).select(
        *identity.PAIR, "inherited_artist_id"
    )


@query(
    "left_join_dim_users",
    """
SELECT p.start_time, p.user_id, u.first_name, u.last_name, u.level AS latest_level
FROM songplays p LEFT JOIN users u ON u.user_id = p.user_id""",
)
def left_join_dim_users(spark, sf_dir):
    rows = events(spark, sf_dir)
    users = layout.replicate_dim(workspace.cut(dims.dim_users(rows), "users")).select(
        "user_id", "first_name", "last_name", F.col("level").alias("latest_level")
    )
    return facts.fact_songplays(rows).select("start_time", "user_id").join(users, "user_id", "left")


@query(
    "left_join_dim_time",
    """
SELECT p.start_time, p.start_time_key, t.day_of_week_name, t.is_weekend
FROM songplays p LEFT JOIN time_dim t ON t.time_key = p.start_time_key""",
)
def left_join_dim_time(spark, sf_dir):
    rows = events(spark, sf_dir)
    time = layout.replicate_dim(workspace.cut(dims.dim_time(rows), "time")).select(
        F.col("time_key").alias("start_time_key"), "day_of_week_name", "is_weekend"
    )
    plays = facts.fact_songplays(rows).select("start_time", "start_time_key")
    return plays.join(time, "start_time_key", "left")


@query(
    "semi_join_exists",
    """
SELECT song_id, title, artist_name, year, duration FROM staging_songs s
WHERE EXISTS (SELECT 1 FROM (
  SELECT title, artist_name FROM staging_songs GROUP BY 1, 2 HAVING count(*) > 2) a
  WHERE a.title = s.title AND a.artist_name = s.artist_name)""",
)
def semi_join_exists(spark, sf_dir):
    return grouping.keep_groups(
        songs(spark, sf_dir).select("song_id", "title", "artist_name", "year", "duration"),
        ["title", "artist_name"],
        n_rows() > 2,
    )


@query(
    "anti_join_not_exists",
    """
SELECT p.artist_id, p.artist_name FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM names_per_id b WHERE b.n > 1 AND b.artist_id = p.artist_id)
  AND NOT EXISTS (SELECT 1 FROM ids_per_name c WHERE c.n > 1 AND c.artist_name = p.artist_name)""",
)
def anti_join_not_exists(spark, sf_dir):
    return profiling.clean_pairs(songs(spark, sf_dir))


@query("exists_as_value", "SELECT * FROM id_name")
def exists_as_value(spark, sf_dir):
    return identity.artist_id_name_flags(songs(spark, sf_dir))


@query(
    "in_subquery",
    """
SELECT song_id, num_songs, title, artist_name, year, duration FROM staging_songs
WHERE song_id IN (
  SELECT song_id FROM staging_songs GROUP BY song_id HAVING count(DISTINCT title) > 1)""",
)
def in_subquery(spark, sf_dir):
    return grouping.keep_groups(
        songs(spark, sf_dir).select(*profiling.SONG_COLUMNS),
        ["song_id"],
        grouping.several("title"),
    )


@query(
    "nested_in_subquery",
    """
SELECT * FROM working WHERE recalculated_artist_id IN (
  SELECT recalculated_artist_id FROM working WHERE recalculated_artist_id IN (
    SELECT recalculated_artist_id FROM working GROUP BY 1 HAVING count(*) > 1)
  AND recalculated_artist_id <> original_artist_id)""",
)
def nested_in_subquery(spark, sf_dir):
    working = workspace.cut(identity.working_rows(songs(spark, sf_dir)), "working")
    return profiling.changed_id_groups(working)


@query(
    "uncorrelated_exists",
    """
SELECT artist_id, artist_name, artist_latitude FROM artist_row
WHERE EXISTS (SELECT 1 FROM id_name WHERE multiple_id_indicator = 1)
  AND artist_latitude IS NOT NULL""",
)
def uncorrelated_exists(spark, sf_dir):
    rows = identity.artist_rows(songs(spark, sf_dir))
    flags = identity.artist_id_name_flags(songs(spark, sf_dir))
    shared = flags.where("multiple_id_indicator = 1").exists()
    return rows.where(shared & F.col("artist_latitude").isNotNull()).select(
        "artist_id", "artist_name", "artist_latitude"
    )


@query(
    "scalar_subqueries",
    "SELECT (SELECT count(*) FROM pairs) AS pair_count, "
    "(SELECT count(*) FROM artist_row) AS row_count",
)
def scalar_subqueries(spark, sf_dir):
    rows = identity.artist_rows(songs(spark, sf_dir))
    return spark.range(1).select(
        identity.artist_pairs(rows).agg(n_rows()).scalar().alias("pair_count"),
        rows.agg(n_rows()).scalar().alias("row_count"),
    )


@query(
    "derived_table",
    "SELECT step, count(*) AS name_count FROM ("
    "SELECT artist_name, max(step) AS step FROM steps14 GROUP BY 1) GROUP BY step",
)
def derived_table(spark, sf_dir):
    inner = identity.steps_1_to_4(songs(spark, sf_dir)).groupBy("artist_name").agg(
        F.max("step").alias("step")
    )
    return inner.groupBy("step").agg(n_rows().alias("name_count"))


@query(
    "nested_cte",
    """
SELECT count(*) AS artist_id_count, CAST(sum(n) AS BIGINT) AS artist_name_count
FROM names_per_id WHERE n > 1""",
)
def nested_cte(spark, sf_dir):
    return spark.sql(
        """
        WITH crowded AS (
          WITH known AS (SELECT DISTINCT artist_id, artist_name FROM {songs})
          SELECT artist_id, count(1) AS n FROM known GROUP BY artist_id HAVING n > 1)
        SELECT count(1) AS artist_id_count, sum(n) AS artist_name_count FROM crowded
        """,
        songs=songs(spark, sf_dir),
    )


@query(
    "chained_cte",
    """
SELECT m.artist_name, m.n AS artist_id_count, CAST(max(i.n) AS BIGINT) AS most_names_of_an_id
FROM ids_per_name m JOIN pairs p ON p.artist_name = m.artist_name
JOIN names_per_id i ON i.artist_id = p.artist_id
WHERE m.n > 1 GROUP BY 1, 2""",
)
def chained_cte(spark, sf_dir):
    """Later items build on earlier ones: per name, its ids and how crowded they are."""
    known = identity.artist_pairs(songs(spark, sf_dir))
    sizes = known.groupBy("artist_id").agg(n_rows().alias("names"))
    sized = grouping.attach(known, sizes, ["artist_id"])
    return spark.sql(
        """
        WITH known AS (
          SELECT * FROM {sized} WHERE artist_name IS NOT NULL),
        by_name AS (
          SELECT artist_name, count(1) AS artist_id_count, max(names) AS most_names_of_an_id
          FROM known GROUP BY artist_name)
        SELECT * FROM by_name WHERE artist_id_count > 1 AND most_names_of_an_id IS NOT NULL
        """,
        sized=sized,
    )


# --- aggregates --------------------------------------------------------------------


@query("count_rows", "SELECT count(1) AS row_count FROM staging_events")
def count_rows(spark, sf_dir):
    return events(spark, sf_dir, "page").agg(n_rows().alias("row_count"))


@query(
    "count_non_null",
    """
SELECT artist_name, count(artist_location) AS located, count(artist_id) AS identified
FROM staging_songs GROUP BY artist_name""",
)
def count_non_null(spark, sf_dir):
    return songs(spark, sf_dir).groupBy("artist_name").agg(
        F.count("artist_location").alias("located"), F.count("artist_id").alias("identified")
    )


@query(
    "count_distinct",
    "SELECT title, count(DISTINCT artist_name) AS artist_count FROM staging_songs "
    "GROUP BY title HAVING count(DISTINCT artist_name) > 1",
)
def count_distinct(spark, sf_dir):
    counted = songs(spark, sf_dir).groupBy("title").agg(
        F.count_distinct("artist_name").alias("artist_count")
    )
    return counted.where("artist_count > 1")


@query(
    "multi_count_distinct",
    "SELECT count(*) AS artists_count, count(DISTINCT artist_name) AS artist_name_count, "
    "count(DISTINCT artist_id) AS artist_id_count FROM pairs",
)
def multi_count_distinct(spark, sf_dir):
    return profiling.artist_counts(songs(spark, sf_dir))


@query(
    "sum_group",
    "SELECT artist_name, CAST(sum(stream_duration) AS DECIMAL(29,4)) AS stream_duration "
    "FROM songplays GROUP BY artist_name",
)
def sum_group(spark, sf_dir):
    return songplays(spark, sf_dir).groupBy("artist_name").agg(marts.play_seconds())


@query(
    "min_max",
    """
SELECT artist_name, min(title) AS first_title, max(title) AS last_title,
  min(TRY_CAST(duration AS DECIMAL(19,4))) AS shortest,
  max(TRY_CAST(duration AS DECIMAL(19,4))) AS longest
FROM staging_songs GROUP BY artist_name""",
)
def min_max(spark, sf_dir):
    seconds = to_decimal("duration", 19, 4)
    return songs(spark, sf_dir).groupBy("artist_name").agg(
        F.min("title").alias("first_title"),
        F.max("title").alias("last_title"),
        F.min(seconds).alias("shortest"),
        F.max(seconds).alias("longest"),
    )


@query(
    "max_as_string_then_cast",
    "SELECT title, TRY_CAST(max(year) AS INTEGER) AS year, "
    "TRY_CAST(max(duration) AS DECIMAL(19,4)) AS duration FROM staging_songs GROUP BY title",
)
def max_as_string_then_cast(spark, sf_dir):
    return songs(spark, sf_dir).groupBy("title").agg(
        to_int(F.max("year")).alias("year"),
        to_decimal(F.max("duration"), 19, 4).alias("duration"),
    )


@query(
    "group_by_having",
    "SELECT artist_id, n AS artist_name_count, n > 1 AS crowded FROM names_per_id "
    "WHERE n > 1 OR n = 1",
)
def group_by_having(spark, sf_dir):
    sized = profiling.names_per_id(songs(spark, sf_dir))
    several, one = sized.where("artist_name_count > 1"), sized.where("artist_name_count = 1")
    return several.select("*", F.lit(True).alias("crowded")).unionByName(
        one.select("*", F.lit(False).alias("crowded"))
    )


@query(
    "group_by_expression",
    """
SELECT split_part(location, ',', 2) AS state, count(start_time) AS stream_count,
  CAST(sum(stream_duration) AS DECIMAL(29,4)) AS stream_duration FROM songplays GROUP BY 1""",
)
def group_by_expression(spark, sf_dir):
    return marts.plays_per_state(songplays(spark, sf_dir))


@query(
    "group_by_multi",
    "SELECT artist_name, title, count(*) AS n FROM staging_songs GROUP BY 1, 2",
)
def group_by_multi(spark, sf_dir):
    return songs(spark, sf_dir).groupBy("artist_name", "title").agg(n_rows().alias("n"))


@query("select_distinct", "SELECT DISTINCT userId, firstName, lastName, level FROM staging_events")
def select_distinct(spark, sf_dir):
    return events(spark, sf_dir, "userId", "firstName", "lastName", "level").distinct()


@query(
    "duplicate_groups",
    """
SELECT song_id, title, artist_name, year, duration, artist_id, count(*) AS copies
FROM staging_songs GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_groups(spark, sf_dir):
    """Song records that occur more than once when their geo columns are left out."""
    rows = songs(spark, sf_dir)
    return grouping.duplicate_groups(
        rows.select("song_id", "title", "artist_name", "year", "duration", "artist_id")
    )


@query(
    "count_of_groups",
    "SELECT count(*) AS song_title_count FROM ("
    "SELECT title, artist_name FROM staging_songs GROUP BY 1, 2)",
)
def count_of_groups(spark, sf_dir):
    return profiling.song_title_count(songs(spark, sf_dir))


@query(
    "frequency_table",
    "SELECT num_songs, count(*) AS row_count FROM staging_songs GROUP BY num_songs",
)
def frequency_table(spark, sf_dir):
    return profiling.frequency_table(songs(spark, sf_dir), "num_songs")


# --- windows -----------------------------------------------------------------------


@query(
    "row_number_latest",
    """
SELECT userId, ts, itemInSession, level FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY TRY_CAST(ts AS BIGINT) DESC NULLS LAST,
    TRY_CAST(itemInSession AS BIGINT) DESC NULLS LAST) AS newest FROM staging_events)
WHERE newest = 1""",
)
def row_number_latest(spark, sf_dir):
    rows = events(spark, sf_dir, "userId", "ts", "itemInSession", "sessionId", "level")
    return ranking.first_row_per(rows, ["userId"], dims.latest_first()).drop("sessionId")


@query(
    "row_number_over_aggregate",
    """
SELECT state, artist_name, stream_count, stream_duration, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY stream_count DESC,
    stream_duration DESC NULLS LAST, artist_name ASC NULLS LAST) AS place FROM state_plays)
WHERE place <= 3""",
)
def row_number_over_aggregate(spark, sf_dir):
    return marts.ranked_artists_by_state(songplays(spark, sf_dir), 3)


@query(
    "first_value_frame",
    """
SELECT DISTINCT artist_id, artist_name,
  first_value(artist_latitude) OVER geo AS artist_latitude,
  first_value(artist_longitude) OVER geo AS artist_longitude
FROM artist_row WHERE artist_id IS NOT NULL AND artist_name IS NOT NULL
WINDOW geo AS (PARTITION BY artist_id, artist_name ORDER BY artist_lat_long_score DESC,
  artist_latitude ASC NULLS LAST, artist_longitude ASC NULLS LAST ROWS UNBOUNDED PRECEDING)""",
)
def first_value_frame(spark, sf_dir):
    """First value of each group in score order; a reduction, so no group is gathered."""
    rows = identity.artist_rows_once(songs(spark, sf_dir)).dropna(subset=identity.PAIR)
    return identity.best_attributes(rows, identity.PAIR).drop("artist_location")


@query(
    "first_value_nulls_last",
    """
SELECT p.artist_id, p.artist_name, coalesce(
  (SELECT max(s.recalculated_artist_id) FROM step3 s WHERE s.artist_name = p.artist_name),
  p.artist_id) AS recalculated_artist_id
FROM pairs p""",
)
def first_value_nulls_last(spark, sf_dir):
    """Largest looked-up id per name, NULLs ignored, else the row's own id."""
    flags = identity.artist_id_name_flags(songs(spark, sf_dir))
    offered = (
        flags.where("multiple_name_indicator = 0 and multiple_id_indicator = 1")
        .groupBy("artist_name")
        .agg(F.max("artist_id").alias("largest"))
    )
    return grouping.attach(flags, offered, ["artist_name"]).select(
        *identity.PAIR, F.coalesce("largest", "artist_id").alias("recalculated_artist_id")
    )


@query(
    "two_partitionings",
    """
SELECT DISTINCT artist_id, artist_name,
  first_value(artist_latitude) OVER (PARTITION BY artist_id, artist_name
    ORDER BY artist_lat_long_score DESC, artist_latitude ASC NULLS LAST,
      artist_longitude ASC NULLS LAST ROWS UNBOUNDED PRECEDING) AS artist_latitude,
  first_value(artist_location) OVER (PARTITION BY artist_id, artist_name
    ORDER BY artist_location_score DESC, artist_location ASC NULLS LAST
    ROWS UNBOUNDED PRECEDING) AS artist_location
FROM artist_row WHERE artist_id IS NOT NULL AND artist_name IS NOT NULL""",
)
def two_partitionings(spark, sf_dir):
    """Two orders over one grouping: coordinates by their score, place by its own."""
    rows = identity.artist_rows_once(songs(spark, sf_dir)).dropna(subset=identity.PAIR)
    return identity.best_attributes(rows, identity.PAIR).drop("artist_longitude")


# --- sort, limit, top-k ------------------------------------------------------------


@query(
    "order_by",
    "SELECT name, artist_id FROM artist_names ORDER BY name, artist_id DESC NULLS LAST",
    order=("name", "artist_id"),
)
def order_by(spark, sf_dir):
    resolved = identity.resolve_artist_ids(songs(spark, sf_dir))
    return resolved.select(
        F.col("artist_name").alias("name"), F.col("recalculated_artist_id").alias("artist_id")
    ).orderBy("name", F.col("artist_id").desc_nulls_last())


@query(
    "order_by_ordinal",
    "SELECT state, artist_name, stream_count FROM state_plays ORDER BY 3 DESC, 2, 1 LIMIT 25",
    order=("stream_count", "artist_name", "state"),
)
def order_by_ordinal(spark, sf_dir):
    counted = songplays(spark, sf_dir).groupBy(marts.state_of().alias("state"), "artist_name").agg(
        marts.play_count()
    )
    return counted.orderBy(F.desc("stream_count"), "artist_name", "state").limit(25)


@query(
    "order_by_multi",
    "SELECT title, artist_name, count(*) AS n FROM staging_songs GROUP BY 1, 2 "
    "ORDER BY 1 NULLS LAST, 2 NULLS LAST LIMIT 50",
    order=("title", "artist_name"),
)
def order_by_multi(spark, sf_dir):
    counted = songs(spark, sf_dir).groupBy("title", "artist_name").agg(n_rows().alias("n"))
    return counted.orderBy(
        F.col("title").asc_nulls_last(), F.col("artist_name").asc_nulls_last()
    ).limit(50)


@query("limit_n", "SELECT * FROM time_dim ORDER BY time_key LIMIT 14", order=("time_key",))
def limit_n(spark, sf_dir):
    return profiling.time_dim_preview(events(spark, sf_dir, "page", "ts"))


@query(
    "limit_offset",
    "SELECT * FROM id_name ORDER BY artist_name NULLS LAST, artist_id NULLS LAST "
    "LIMIT 10 OFFSET 20",
    order=("artist_name", "artist_id"),
)
def limit_offset(spark, sf_dir):
    flags = identity.artist_id_name_flags(songs(spark, sf_dir))
    return flags.orderBy(
        F.col("artist_name").asc_nulls_last(), F.col("artist_id").asc_nulls_last()
    ).offset(20).limit(10)


@query(
    "top_k",
    "SELECT artist_name, count(*) AS stream_count FROM songplays GROUP BY 1 "
    "ORDER BY 2 DESC, 1 NULLS LAST LIMIT 20",
    order=("stream_count", "artist_name"),
)
def top_k(spark, sf_dir):
    counted = songplays(spark, sf_dir).groupBy("artist_name").agg(marts.play_count())
    return counted.orderBy(F.desc("stream_count"), F.col("artist_name").asc_nulls_last()).limit(20)


@query(
    "top_1_per_group",
    """
SELECT user_id, song_title, n FROM (
  SELECT user_id, song_title, count(*) AS n, row_number() OVER (PARTITION BY user_id
    ORDER BY count(*) DESC, song_title NULLS LAST) AS place
  FROM songplays GROUP BY 1, 2) WHERE place = 1""",
)
def top_1_per_group(spark, sf_dir):
    counted = songplays(spark, sf_dir).groupBy("user_id", "song_title").agg(n_rows().alias("n"))
    order = [F.desc("n"), F.col("song_title").asc_nulls_last()]
    return ranking.first_row_per(counted, ["user_id"], order)


@query(
    "null_order",
    "SELECT artist_name, artist_id, artist_latitude FROM artist_row "
    "ORDER BY artist_latitude DESC NULLS LAST, artist_name ASC NULLS FIRST, "
    "artist_id ASC NULLS LAST, artist_longitude ASC NULLS LAST, "
    "artist_location ASC NULLS LAST",
    order=("artist_latitude", "artist_name", "artist_id"),
)
def null_order(spark, sf_dir):
    rows = identity.artist_rows(songs(spark, sf_dir))
    return rows.orderBy(
        F.col("artist_latitude").desc_nulls_last(),
        F.col("artist_name").asc_nulls_first(),
        F.col("artist_id").asc_nulls_last(),
        F.col("artist_longitude").asc_nulls_last(),
        F.col("artist_location").asc_nulls_last(),
    ).select("artist_name", "artist_id", "artist_latitude")


@query(
    "order_by_position",
    "SELECT row_number() OVER (ORDER BY name, artist_id DESC NULLS LAST) AS place, name, artist_id "
    "FROM artist_names",
)
def order_by_position(spark, sf_dir):
    """``order_by`` with every row's place, numbered without bringing the rows together."""
    resolved = identity.resolve_artist_ids(songs(spark, sf_dir))
    rows = resolved.select(
        F.col("artist_name").alias("name"), F.col("recalculated_artist_id").alias("artist_id")
    )
    return ranking.number_in_order(rows, [F.asc("name"), F.col("artist_id").desc_nulls_last()], "place")


@query(
    "null_order_position",
    "SELECT row_number() OVER (ORDER BY artist_latitude DESC NULLS LAST, artist_name ASC NULLS FIRST, "
    "artist_id ASC NULLS LAST, artist_longitude ASC NULLS LAST, artist_location ASC NULLS LAST) AS place, "
    "artist_name, artist_id, artist_latitude FROM artist_row",
)
def null_order_position(spark, sf_dir):
    """``null_order`` with every row's place."""
    rows = identity.artist_rows(songs(spark, sf_dir))
    order = [
        F.col("artist_latitude").desc_nulls_last(),
        F.col("artist_name").asc_nulls_first(),
        F.col("artist_id").asc_nulls_last(),
        F.col("artist_longitude").asc_nulls_last(),
        F.col("artist_location").asc_nulls_last(),
    ]
    placed = ranking.number_in_order(rows, order, "place")
    return placed.select("place", "artist_name", "artist_id", "artist_latitude")


@query(
    "top_n_per_group",
    """
SELECT event_type, place, event_id, value FROM (
  SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type
    ORDER BY value DESC NULLS LAST, event_id NULLS LAST) AS place FROM events) WHERE place <= 2000""",
)
def top_n_per_group(spark, sf_dir):
    """More rows of each of a few large groups than a limited window would hold in a task."""
    order = [F.col("value").desc_nulls_last(), F.col("event_id").asc_nulls_last()]
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return ranking.first_row_per(rows, ["event_type"], order, 2000, rank_as="place")


@query(
    "first_pairs_many",
    """
SELECT DISTINCT a.artist_name, a.artist_id AS left_id, b.artist_id AS right_id
FROM id_name a JOIN id_name b ON a.artist_name = b.artist_name AND a.artist_id > b.artist_id
ORDER BY 1, 2, 3 LIMIT 3000""",
)
def first_pairs_many(spark, sf_dir):
    """The first 3,000 pairs of ids that share a name."""
    pairs = ranking.first_pairs(songs(spark, sf_dir), "artist_name", "artist_id", 3000, ordered=True)
    return pairs.toDF("artist_name", "left_id", "right_id")


@query("union_steps", "SELECT * FROM steps14")
def union_steps(spark, sf_dir):
    """The rows of steps 1 to 4 put together by column name."""
    first_four = workspace.cut(identity.steps_1_to_4(songs(spark, sf_dir)), "artist-steps")
    parts = [first_four.where(F.col("step") == step) for step in (1, 2, 3, 4)]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united
