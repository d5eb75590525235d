"""Table contracts: types, required columns, text lengths and keys of the ten tables.

Spark's Parquet tables enforce neither keys nor lengths, so the contract is data
here and is checked by ``operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

DEFAULT_TEXT = 256
LONG_TEXT = 1000

LATITUDE = T.DecimalType(10, 8)
LONGITUDE = T.DecimalType(11, 8)
SECONDS = T.DecimalType(19, 4)

_NAMED_TYPES = {
    "string": T.StringType(),
    "text": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "latitude": LATITUDE,
    "longitude": LONGITUDE,
    "seconds": SECONDS,
}


@dataclass(frozen=True)
class Table:
    """One table: its schema and the rules a stored row must satisfy.

    ``sort_by`` is the column order files are clustered on, ``spread_by`` the
    column that co-locates large tables; small dimensions set ``replicated``.
    """

    name: str
    schema: T.StructType
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    sort_by: tuple[str, ...] = ()
    spread_by: str | None = None
    replicated: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _table(name: str, columns: str, required: str = "", **rules) -> Table:
    """Build a table from ``column:type`` words; ``text`` means a long string."""
    fields, lengths = [], {}
    for word in columns.split():
        column, kind = word.split(":")
        fields.append(T.StructField(column, _NAMED_TYPES[kind], True))
        if kind in ("string", "text"):
            lengths[column] = LONG_TEXT if kind == "text" else DEFAULT_TEXT
    return Table(name, T.StructType(fields), tuple(required.split()), lengths=lengths, **rules)


# Table, column and type names of the staging, working and mart tables.

STAGING_EVENTS = _table(
    "staging_events",
    "artist:text auth:string firstName:string gender:string itemInSession:string "
    "lastName:string length:string level:string location:string method:string page:string "
    "registration:string sessionId:string song:text status:string ts:string "
    "userAgent:string userId:string",
)
STAGING_SONGS = _table(
    "staging_songs",
    "song_id:string num_songs:string title:text artist_name:text artist_latitude:string "
    "year:string duration:string artist_id:string artist_longitude:string artist_location:text",
)
STAGING_ARTIST_ROW = _table(
    "staging_artist_row",
    "artist_id:string artist_name:text artist_latitude:latitude artist_latitude_score:int "
    "artist_longitude:longitude artist_longitude_score:int artist_lat_long_score:int "
    "artist_location:text artist_location_score:int",
)
STAGING_ARTIST_ID_NAME = _table(
    "staging_artist_id_name",
    "artist_id:string artist_name:text multiple_name_indicator:int multiple_id_indicator:int",
)
STAGING_ARTIST_NAMES = _table(
    "staging_artist_names",
    "original_artist_id:string artist_name:text recalculated_artist_id:string "
    "artist_latitude:latitude artist_longitude:longitude artist_location:text "
    "multiple_name_indicator:int multiple_id_indicator:int step:int",
)
ARTIST_NAMES = _table(
    "artist_names",
    "name:text artist_id:string latitude:latitude longitude:longitude location:text",
    required="name artist_id",
    key=("name",),
    sort_by=("name",),
    replicated=True,
)
SONG_TITLES = _table(
    "song_titles",
    "artist_name:text title:text year:int duration:seconds",
    required="artist_name title year duration",
    key=("artist_name", "title"),
    sort_by=("artist_name", "title"),
    spread_by="title",
)
USERS = _table(
    "users",
    "user_id:int first_name:string last_name:string gender:string level:string",
    required="user_id first_name last_name gender level",
    key=("user_id",),
    sort_by=("user_id",),
    replicated=True,
)
TIME = _table(
    "time",
    "time_key:int timestamp_date:timestamp hour:int day:int week:int month:int year:int "
    "day_of_week:int day_of_week_name:string is_weekend:bool",
    required="time_key timestamp_date hour day week month year day_of_week day_of_week_name "
    "is_weekend",
    key=("time_key",),
    sort_by=("time_key",),
    replicated=True,
)
SONGPLAYS = _table(
    "songplays",
    "songplay_id:long start_time:timestamp start_time_key:int user_id:int level:string "
    "song_title:text artist_name:text session_id:int location:text user_agent:string "
    "stream_duration:seconds",
    required="start_time start_time_key user_id level song_title artist_name session_id "
    "location user_agent",
    key=("songplay_id",),
    sort_by=("start_time_key", "start_time"),
    spread_by="song_title",
)

STAGING_TABLES = (STAGING_EVENTS, STAGING_SONGS)
WORKING_TABLES = (STAGING_ARTIST_ROW, STAGING_ARTIST_ID_NAME, STAGING_ARTIST_NAMES)
MART_TABLES = (ARTIST_NAMES, SONG_TITLES, USERS, TIME, SONGPLAYS)
ALL_TABLES = {t.name: t for t in (*STAGING_TABLES, *WORKING_TABLES, *MART_TABLES)}
