"""Sources: JSON landing, load errors, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from playmart.bindings import staging_events, staging_songs, table
from playmart.operators import workspace
from playmart.plans import warehouse
from playmart.registry import Registry
from playmart.schemas import STAGING_EVENTS, STAGING_SONGS
from playmart.sources import framing, landing, objects

REGISTRY = Registry()
query = REGISTRY.query


#: Columns that exporters write as bare numbers.
EVENT_NUMBERS = {"ts": "bigint", "userId": "bigint", "sessionId": "bigint", "itemInSession": "bigint"}
EVENT_NUMBERS |= {"length": "decimal(19,4)"}
SONG_NUMBERS = {"num_songs": "int", "year": "int", "duration": "decimal(19,4)"}


def as_json(rows, numbers, name=lambda c: c, **options):
    """One JSON object per row, some of its values bare numbers."""
    columns = [F.col(c).cast(numbers.get(c, "string")).alias(name(c)) for c in rows.columns]
    return F.to_json(F.struct(*columns), options)


def event_lines(spark, sf_dir):
    """The play log as JSON lines."""
    rows = staging_events(spark, sf_dir)
    return rows.select(as_json(rows, EVENT_NUMBERS).alias("value"))


def song_lines(spark, sf_dir):
    """The song metadata as JSON lines whose keys vary in letter case."""
    rows = staging_songs(spark, sf_dir)
    shouted = as_json(rows, SONG_NUMBERS, str.upper)
    titled = as_json(rows, SONG_NUMBERS, str.title)
    return rows.select(F.when(F.col("num_songs") == "1", shouted).otherwise(titled).alias("value"))


def mixed_lines(spark, sf_dir):
    """Event ids as JSON lines: some blank, cut off, no object, or with something behind the object."""
    number = F.col("event_id").cast("string")
    user = F.concat(F.lit('{"userId":'), number)
    kind = F.col("event_id") % 7
    return table(spark, sf_dir, "events").select(
        F.when(kind == 0, F.concat(user, F.lit(",")))
        .when(kind == 1, F.concat(F.lit("["), number, F.lit("]")))
        .when(kind == 2, F.lit("   "))
        .when(kind == 3, F.concat(user, F.lit("},"), user, F.lit("}")))
        .when(kind == 4, F.concat(user, F.lit("} and more")))
        .otherwise(F.concat(user, F.lit(',"page":"NextSong"}')))
        .alias("value")
    )


def mixed_objects(spark, sf_dir):
    """Event ids as a sequence of objects: on several lines, two on a line, cut off, with text between."""
    number = F.col("event_id").cast("string")
    user = F.concat(F.lit('{"userId":'), number)
    kind = F.col("event_id") % 7
    return table(spark, sf_dir, "events").select(
        F.when(kind == 0, F.concat(user, F.lit(",\n"), user, F.lit("}")))
        .when(kind == 1, F.concat(F.lit("["), number, F.lit("]")))
        .when(kind == 2, F.lit("   "))
        .when(kind == 3, F.concat(user, F.lit("}"), user, F.lit("}")))
        .when(kind == 4, F.concat(user, F.lit("} and more")))
        .otherwise(F.concat(F.lit('{\n  "userId" :\n'), number, F.lit(',\n  "page" : "NextSong"\n}')))
        .alias("value")
    )


def framed(lines, **options):
    """The values as files in the shared folder, read back as objects of whole files."""
    spark = lines.sparkSession
    path = workspace.fresh_dir(spark, "objects")
    lines.write.options(**options).text(path)
    return framing.frame(framing.read_blocks(spark, path))


def stored_lines(lines):
    """The lines as objects in the shared folder, read back the way a source is."""
    path = workspace.fresh_dir(lines.sparkSession, "objects")
    lines.write.text(path)
    return landing.read_lines(lines.sparkSession, path)


@query("scan_events_jsonpaths", "SELECT * FROM staging_events")
def scan_events_jsonpaths(spark, sf_dir):
    return landing.parse_events(stored_lines(event_lines(spark, sf_dir)), on_error="fail")


@query("scan_songs_ignorecase", "SELECT * FROM staging_songs")
def scan_songs_ignorecase(spark, sf_dir):
    return landing.parse_songs(stored_lines(song_lines(spark, sf_dir)), on_error="fail")


@query("scan_events_concatenated", "SELECT * FROM staging_events")
def scan_events_concatenated(spark, sf_dir):
    """Objects one behind the other, without line ends; bare numbers included."""
    return landing.parse_events(framed(event_lines(spark, sf_dir), lineSep=" "), on_error="fail")


@query("scan_songs_multiline", "SELECT * FROM staging_songs")
def scan_songs_multiline(spark, sf_dir):
    """Objects spread over many lines, some of which begin behind the end of another."""
    rows = staging_songs(spark, sf_dir)
    spread = as_json(rows, SONG_NUMBERS, str.upper, pretty="true")
    nested = F.concat(F.lit('{"Tags": [{"a": [1, {}]}, "}{"],\n'), F.substr(spread, F.lit(2)))
    either = F.when(F.col("num_songs") == "1", spread).otherwise(nested)
    return landing.parse_songs(framed(rows.select(either.alias("value")), lineSep=" "), on_error="fail")


@query(
    "scan_prefix",
    """
SELECT CAST(year(ts) AS VARCHAR) || '/' || lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS sub_prefix,
  count(*) AS line_count, count(DISTINCT event_id) AS event_count
FROM events GROUP BY 1""",
)
def scan_prefix(spark, sf_dir):
    """Write the log as nested year/month objects, then read the prefix back."""
    root = workspace.fresh_dir(spark, "objects")
    rows = table(spark, sf_dir, "events")
    rows.select(
        F.to_json(F.struct("event_id", "user_id")).alias("value"),
        F.year("ts").alias("year"),
        F.lpad(F.month("ts").cast("string"), 2, "0").alias("month"),
    ).write.partitionBy("year", "month").text(root)
    lines = landing.read_lines(spark, root, "*.txt")
    year = F.regexp_extract("file_path", r"year=(\d+)", 1)
    month = F.regexp_extract("file_path", r"month=(\d+)", 1)
    event_id = F.get_json_object("value", "$.event_id").cast("bigint")
    return lines.groupBy(F.concat(year, F.lit("/"), month).alias("sub_prefix")).agg(
        F.count(F.lit(1)).alias("line_count"), F.count_distinct(event_id).alias("event_count")
    )


@query("raw_string_schema", "SELECT * FROM staging_songs")
def raw_string_schema(spark, sf_dir):
    """Land text as text: whatever a value looks like, its characters arrive as they were."""
    path = workspace.fresh_dir(spark, "songs-json")
    staging_songs(spark, sf_dir).write.json(path)
    return landing.parse_songs(landing.read_lines(spark, path), on_error="fail")


@query(
    "load_errors",
    """
SELECT CASE event_id % 7 WHEN 0 THEN '{"userId":' || CAST(event_id AS VARCHAR) || ','
    WHEN 1 THEN '[' || CAST(event_id AS VARCHAR) || ']'
    WHEN 3 THEN '{"userId":' || CAST(event_id AS VARCHAR) || '},{"userId":' || CAST(event_id AS VARCHAR) || '}'
    ELSE '{"userId":' || CAST(event_id AS VARCHAR) || '} and more' END AS line,
  CASE event_id % 7 WHEN 1 THEN 'not a JSON object' WHEN 3 THEN 'text after the object'
    ELSE 'malformed JSON' END AS reason
FROM events WHERE event_id % 7 IN (0, 1, 3, 4)""",
)
def load_errors(spark, sf_dir):
    return landing.load_errors(mixed_lines(spark, sf_dir))


@query(
    "load_errors_framed",
    """
SELECT CASE event_id % 7 WHEN 0 THEN '{"userId":' || CAST(event_id AS VARCHAR) || ','
    WHEN 1 THEN '[' || CAST(event_id AS VARCHAR) || ']' ELSE 'and more' END AS line,
  CASE event_id % 7 WHEN 1 THEN 'not a JSON object' ELSE 'malformed JSON' END AS reason
FROM events WHERE event_id % 7 IN (0, 1, 4)""",
)
def load_errors_framed(spark, sf_dir):
    """What is refused of whole files: the objects before, between and behind it are not."""
    return landing.load_errors(framed(mixed_objects(spark, sf_dir)).select("value"))


@query(
    "landing_counts",
    """
SELECT 'staging_events' AS collection,
  CAST(sum(CASE event_id % 7 WHEN 0 THEN 2 WHEN 2 THEN 0 WHEN 3 THEN 2 WHEN 4 THEN 2 ELSE 1 END) AS BIGINT) AS records,
  CAST(count_if(event_id % 7 IN (0, 1, 4)) AS BIGINT) AS refused,
  CAST(sum(CASE event_id % 7 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS BIGINT) AS staged,
  TRUE AS ok FROM events
UNION ALL
SELECT 'staging_songs', count(*), CAST(0 AS BIGINT), count(*), TRUE FROM staging_songs""",
)
def landing_counts(spark, sf_dir):
    """Landing a log with broken records: each source is read once and counted while it is written."""
    root = workspace.fresh_dir(spark, "landing")
    mixed_objects(spark, sf_dir).write.text(f"{root}/log")
    song_lines(spark, sf_dir).write.text(f"{root}/songs")
    sources = warehouse.Sources(f"{root}/log", f"{root}/songs", on_error="skip")
    return warehouse.land(spark, sources, f"{root}/tables")


@query(
    "reconcile_counts",
    """
SELECT 'staging_events' AS collection, (SELECT count(*) FROM events) AS source_n,
  (SELECT count(*) FROM staging_events) AS target_n,
  (SELECT count(*) FROM events) = (SELECT count(*) FROM staging_events) AS ok
UNION ALL
SELECT 'staging_songs', (SELECT count(*) * 2 FROM orders), (SELECT count(*) FROM staging_songs),
  (SELECT count(*) * 2 FROM orders) = (SELECT count(*) FROM staging_songs)""",
)
def reconcile_counts(spark, sf_dir):
    events = stored_lines(event_lines(spark, sf_dir))
    songs = stored_lines(song_lines(spark, sf_dir))
    return objects.reconcile_counts(
        {
            STAGING_EVENTS.name: (landing.non_blank(events), landing.parse_events(events)),
            STAGING_SONGS.name: (landing.non_blank(songs), landing.parse_songs(songs)),
        }
    )


@query("json_lines_count", "SELECT count(*) AS record_count FROM events WHERE event_id % 7 <> 2")
def json_lines_count(spark, sf_dir):
    return objects.json_lines_count(mixed_lines(spark, sf_dir))


@query(
    "peek_rows",
    "SELECT * FROM staging_events WHERE page = 'NextSong' "
    "ORDER BY ts NULLS LAST, userId NULLS LAST, itemInSession NULLS LAST LIMIT 5",
    order=("ts", "userId", "itemInSession"),
)
def peek_rows(spark, sf_dir):
    return objects.peek_rows(
        staging_events(spark, sf_dir),
        F.col("page") == "NextSong",
        ["ts", "userId", "itemInSession"],
        5,
    )
