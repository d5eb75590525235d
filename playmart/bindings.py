"""The two staging collections, derived from the driver's parquet tables.

Every row of ``events`` and ``orders`` takes part. The column expressions below are
one text that both Spark and DuckDB evaluate; only the few in ``_SPARK_ONLY`` /
``_DUCK_ONLY`` differ. See FIXTURES.md for the shapes they produce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.schemas import STAGING_EVENTS, STAGING_SONGS

_EVENT_COLUMNS = {
    "artist": "CASE WHEN event_id % 2 = 1 THEN 'Artist ' || CAST(user_id % 50 * 6 AS STRING) "
    "WHEN event_id % 3 = 0 THEN 'Various Artists' "
    "ELSE 'Artist ' || CAST(event_id AS STRING) END",
    "auth": "'Logged In'",
    "firstName": "split_part(c_name, '#', 1)",
    "gender": "CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END",
    "itemInSession": "CAST(event_id AS STRING)",
    "lastName": "split_part(c_name, '#', 2)",
    "length": "CAST(CAST(value AS DECIMAL(19,4)) AS STRING)",
    "level": "CASE WHEN value >= 20 THEN 'paid' ELSE 'free' END",
    "location": "r_name || ', ' || n_name",
    "method": "'PUT'",
    "page": "CASE WHEN event_type IN ('view', 'click') THEN 'NextSong' ELSE event_type END",
    "registration": "CAST(NULL AS STRING)",
    "sessionId": "CAST(user_id * 100 + day(ts) AS STRING)",
    "song": "CASE WHEN event_id % 4 = 0 THEN 'Song ' || CAST(event_id % 50 AS STRING) "
    "ELSE 'Song ' || CAST(user_id AS STRING) || '-' || CAST(event_id % 3 AS STRING) END",
    "status": "'200'",
    "ts": None,
    "userAgent": "props",
    "userId": "CAST(user_id AS STRING)",
}
_PEOPLE_COLUMNS = {"firstName", "lastName", "location"}

_SONG_COLUMNS = {
    "song_id": "'SO' || CAST(CASE WHEN o_orderkey % 5 < 3 THEN o_orderkey - o_orderkey % 3 "
    "ELSE o_orderkey END AS STRING)",
    "num_songs": "CASE WHEN o_orderkey % 10 = 0 THEN '2' ELSE '1' END",
    "title": "CASE WHEN o_orderkey % 4 = 0 THEN 'Song ' || CAST(o_orderkey % 50 AS STRING) "
    "ELSE 'Song ' || CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey % 3 AS STRING) END",
    "artist_name": "CASE WHEN o_orderkey % 101 = 0 THEN NULL "
    "WHEN o_custkey % 6 = 0 THEN 'Artist ' || CAST(o_custkey AS STRING) "
    "WHEN o_custkey % 6 = 1 THEN 'Artist ' || CAST(o_custkey AS STRING) || ' take ' "
    "|| CAST(o_orderkey % 3 AS STRING) "
    "WHEN o_custkey % 6 = 2 THEN 'Group ' || CAST(o_custkey - o_custkey % 12 AS STRING) "
    "WHEN o_custkey % 6 = 3 AND o_orderkey % 2 = 0 "
    "THEN 'Group ' || CAST(o_custkey - o_custkey % 12 AS STRING) "
    "WHEN o_custkey % 6 = 3 THEN 'Solo ' || CAST(o_custkey AS STRING) "
    "WHEN o_custkey % 6 = 4 THEN 'Collective ' || CAST(o_custkey - o_custkey % 30 AS STRING) "
    "|| '/' || CAST(o_orderkey % 4 AS STRING) "
    "ELSE 'Various Artists' END",
    "artist_latitude": "CASE WHEN (o_orderkey + v) % 3 = 0 THEN '' "
    "WHEN o_orderkey % 11 = 5 THEN 'n/a' WHEN o_orderkey % 13 = 7 THEN '123.5' "
    "ELSE CAST(CAST((o_custkey + 7 * o_orderkey) % 180 - 90 AS DECIMAL(10,2)) AS STRING) END",
    "year": "CAST(year(o_orderdate) AS STRING)",
    "duration": "CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS STRING)",
    "artist_id": "CASE WHEN o_orderkey % 103 = 0 THEN NULL "
    "ELSE 'AR' || lpad(CAST(o_custkey AS STRING), 12, '0') END",
    "artist_longitude": "CASE WHEN (o_orderkey + v) % 4 = 0 THEN '' "
    "ELSE CAST(CAST(o_orderkey % 360 - 180 AS DECIMAL(10,2)) AS STRING) END",
    "artist_location": "CASE WHEN o_orderkey % 17 = 3 THEN NULL "
    "WHEN (o_orderkey + v) % 2 = 0 THEN '  ' "
    "ELSE 'City ' || CAST(o_orderkey % 25 AS STRING) END",
}

_SPARK_ONLY = {
    "ts": "CAST(timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) AS STRING)"
}
_DUCK_ONLY = {"ts": "CAST(epoch_us(ts) // 1000 AS STRING)"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staging_events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The play log. Naming columns spares the joins when no person column is asked for."""
    wanted = columns or tuple(STAGING_EVENTS.columns)
    rows = table(spark, sf_dir, "events")
    if _PEOPLE_COLUMNS & set(wanted):
        people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
        nations = table(spark, sf_dir, "nation")
        regions = table(spark, sf_dir, "region")
        rows = (
            rows.join(people, rows.user_id == people.c_custkey, "left")
            .join(nations, people.c_nationkey == nations.n_nationkey, "left")
            .join(regions, nations.n_regionkey == regions.r_regionkey, "left")
        )
    return rows.select(
        *[F.expr(_EVENT_COLUMNS[c] or _SPARK_ONLY[c]).alias(c) for c in wanted]
    )


def staging_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The song metadata: two recorded versions of every order."""
    rows = table(spark, sf_dir, "orders").withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    return rows.select(*[F.expr(text).alias(c) for c, text in _SONG_COLUMNS.items()])


def _duck_select(columns: dict[str, str | None], names: list[str]) -> str:
    return ",\n    ".join(f"{columns[c] or _DUCK_ONLY[c]} AS {c}" for c in names)


STAGING_EVENTS_SQL = f"""
  SELECT {_duck_select(_EVENT_COLUMNS, STAGING_EVENTS.columns)}
  FROM events
  LEFT JOIN customer ON c_custkey = user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey"""

STAGING_SONGS_SQL = f"""
  SELECT {_duck_select(_SONG_COLUMNS, STAGING_SONGS.columns)}
  FROM (SELECT *, unnest([0, 1]) AS v FROM orders)"""
