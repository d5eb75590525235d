"""DuckDB views the oracle queries share, in dependency order.

They state each table independently of the Spark jobs: the artist steps run one after
the other with lookups into the rows made so far, and picks are ordered aggregates.
"""

from __future__ import annotations

from playmart.bindings import STAGING_EVENTS_SQL, STAGING_SONGS_SQL
from playmart.functions.casts import NUMERIC_PATTERN


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def _best_geo(score: str, lat: str = "artist_latitude", lon: str = "artist_longitude") -> str:
    return (
        f"first(struct_pack(lat := {lat}, lon := {lon}) ORDER BY {score} DESC, "
        f"{lat} ASC NULLS LAST, {lon} ASC NULLS LAST)"
    )


def _best_place(score: str) -> str:
    return (
        f"first(struct_pack(place := artist_location) ORDER BY {score} DESC, "
        "artist_location ASC NULLS LAST)"
    )


def _step(step: int, names: int, ids: int, earlier: list[int]) -> str:
    """Rows of one of the first four steps; later ones look their name up in earlier ones."""
    lookup = ""
    resolved = "p.artist_id"
    if earlier:
        past = " UNION ALL ".join(
            f"SELECT artist_name, recalculated_artist_id FROM step{i}" for i in earlier
        )
        lookup = (
            f"LEFT JOIN (SELECT artist_name, max(recalculated_artist_id) AS found FROM ({past}) "
            "GROUP BY artist_name) l ON l.artist_name = p.artist_name"
        )
        resolved = "coalesce(l.found, p.artist_id)"
    return f"""
  SELECT p.artist_id AS original_artist_id, p.artist_name,
    {resolved} AS recalculated_artist_id,
    b.geo.lat AS artist_latitude, b.geo.lon AS artist_longitude, b.loc.place AS artist_location,
    p.multiple_name_indicator, p.multiple_id_indicator, CAST({step} AS INTEGER) AS step
  FROM id_name p
  LEFT JOIN pair_best b ON b.artist_id = p.artist_id AND b.artist_name = p.artist_name
  {lookup}
  WHERE p.multiple_name_indicator = {names} AND p.multiple_id_indicator = {ids}"""


_WORKING_COLUMNS = (
    "original_artist_id, artist_name, recalculated_artist_id, artist_latitude, "
    "artist_longitude, artist_location, multiple_name_indicator, multiple_id_indicator, step"
)
_PRESENT = f"({_flag('artist_latitude IS NOT NULL')} + {_flag('artist_longitude IS NOT NULL')})"
_NOT_BLANK = _flag("trim(artist_location) <> ''")

VIEWS = {
    "staging_events": STAGING_EVENTS_SQL,
    "staging_songs": STAGING_SONGS_SQL,
    "artist_row": f"""
  SELECT DISTINCT artist_id, artist_name,
    TRY_CAST(artist_latitude AS DECIMAL(10,8)) AS artist_latitude,
    {_flag(f"regexp_matches(artist_latitude, '{NUMERIC_PATTERN}')")} AS artist_latitude_score,
    TRY_CAST(artist_longitude AS DECIMAL(11,8)) AS artist_longitude,
    {_flag(f"regexp_matches(artist_longitude, '{NUMERIC_PATTERN}')")} AS artist_longitude_score,
    {_flag(f"regexp_matches(artist_latitude, '{NUMERIC_PATTERN}')")}
      + {_flag(f"regexp_matches(artist_longitude, '{NUMERIC_PATTERN}')")} AS artist_lat_long_score,
    artist_location,
    {_NOT_BLANK} AS artist_location_score
  FROM staging_songs""",
    "pairs": "SELECT DISTINCT artist_id, artist_name FROM staging_songs",
    "names_per_id": "SELECT artist_id, count(*) AS n FROM pairs GROUP BY artist_id",
    "ids_per_name": "SELECT artist_name, count(*) AS n FROM pairs GROUP BY artist_name",
    "id_name": f"""
  SELECT p.artist_id, p.artist_name,
    {_flag('i.n > 1')} AS multiple_name_indicator,
    {_flag('m.n > 1')} AS multiple_id_indicator
  FROM pairs p
  LEFT JOIN names_per_id i ON i.artist_id = p.artist_id
  LEFT JOIN ids_per_name m ON m.artist_name = p.artist_name""",
    "pair_best": f"""
  SELECT artist_id, artist_name, {_best_geo('artist_lat_long_score')} AS geo,
    {_best_place('artist_location_score')} AS loc
  FROM artist_row GROUP BY artist_id, artist_name""",
    "step1": _step(1, 0, 0, []),
    "step2": _step(2, 1, 0, [1]),
    "step3": _step(3, 0, 1, [1, 2]),
    "step4": _step(4, 1, 1, [1, 2, 3]),
    "steps14": " UNION ALL ".join(
        f"SELECT {_WORKING_COLUMNS} FROM step{i}" for i in (1, 2, 3, 4)
    ),
    "step5": """
  SELECT s.original_artist_id, s.artist_name, t.largest AS recalculated_artist_id,
    s.artist_latitude, s.artist_longitude, s.artist_location,
    CAST(NULL AS INTEGER) AS multiple_name_indicator,
    CAST(NULL AS INTEGER) AS multiple_id_indicator, CAST(5 AS INTEGER) AS step
  FROM steps14 s
  JOIN (SELECT artist_name, max(recalculated_artist_id) AS largest FROM steps14 GROUP BY 1) t
    ON t.artist_name IS NOT DISTINCT FROM s.artist_name""",
    "id_best": f"""
  SELECT recalculated_artist_id, {_best_geo(_PRESENT)} AS geo, {_best_place(_NOT_BLANK)} AS loc
  FROM step5 GROUP BY recalculated_artist_id""",
    "step6": """
  SELECT s.original_artist_id, s.artist_name, s.recalculated_artist_id,
    b.geo.lat AS artist_latitude, b.geo.lon AS artist_longitude, b.loc.place AS artist_location,
    s.multiple_name_indicator, s.multiple_id_indicator, CAST(6 AS INTEGER) AS step
  FROM step5 s
  JOIN id_best b ON b.recalculated_artist_id IS NOT DISTINCT FROM s.recalculated_artist_id""",
    "working": " UNION ALL ".join(
        f"SELECT {_WORKING_COLUMNS} FROM {name}" for name in ("steps14", "step5", "step6")
    ),
    "artist_names": """
  SELECT DISTINCT artist_name AS name, recalculated_artist_id AS artist_id,
    artist_latitude AS latitude, artist_longitude AS longitude, artist_location AS location
  FROM step6 WHERE artist_name IS NOT NULL""",
    "song_titles": """
  SELECT artist_name, title, max(TRY_CAST(year AS INTEGER)) AS year,
    max(TRY_CAST(duration AS DECIMAL(19,4))) AS duration
  FROM staging_songs GROUP BY artist_name, title""",
    "plays": """
  SELECT *, make_timestamp(CAST(ts AS BIGINT) * 1000) AS start_time
  FROM staging_events WHERE page = 'NextSong'""",
    "users": """
  SELECT user_id, first_name, last_name, gender, level FROM (
    SELECT TRY_CAST(userId AS INTEGER) AS user_id, firstName AS first_name,
      lastName AS last_name, gender, level,
      row_number() OVER (PARTITION BY TRY_CAST(userId AS INTEGER)
        ORDER BY TRY_CAST(ts AS BIGINT) DESC NULLS LAST,
          TRY_CAST(itemInSession AS BIGINT) DESC NULLS LAST,
          TRY_CAST(sessionId AS BIGINT) DESC NULLS LAST, level ASC NULLS LAST) AS newest
    FROM plays) WHERE newest = 1""",
    "time_dim": """
  SELECT CAST(year(h) * 1000000 + month(h) * 10000 + day(h) * 100 + hour(h) AS INTEGER) AS time_key,
    h AS timestamp_date,
    CAST(hour(h) AS INTEGER) AS hour, CAST(day(h) AS INTEGER) AS day,
    CAST(week(h) AS INTEGER) AS week, CAST(month(h) AS INTEGER) AS month,
    CAST(year(h) AS INTEGER) AS year, CAST(dayofweek(h) AS INTEGER) AS day_of_week,
    rpad(dayname(h), 9, ' ') AS day_of_week_name, dayofweek(h) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT date_trunc('hour', start_time) AS h FROM plays)""",
    "songplays": """
  SELECT start_time,
    CAST(year(start_time) * 1000000 + month(start_time) * 10000 + day(start_time) * 100
      + hour(start_time) AS INTEGER) AS start_time_key,
    TRY_CAST(userId AS INTEGER) AS user_id, level, song AS song_title, artist AS artist_name,
    TRY_CAST(sessionId AS INTEGER) AS session_id, location, userAgent AS user_agent,
    TRY_CAST(length AS DECIMAL(19,4)) AS stream_duration
  FROM plays""",
    "state_plays": """
  SELECT split_part(location, ',', 2) AS state, artist_name, count(start_time) AS stream_count,
    CAST(sum(stream_duration) AS DECIMAL(29,4)) AS stream_duration
  FROM songplays GROUP BY 1, 2""",
}
