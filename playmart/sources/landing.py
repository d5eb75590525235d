"""JSON lines to all-string staging rows.

Bare numbers are quoted first, so their text lands unchanged: ``250.10``, ``1e5`` and any
number of digits. Each record is then parsed once into a variant and every column is one path
into it. A record must hold one object and nothing else; a second object or text behind the
first makes it a load error, never a silent loss. The parsers take a DataFrame with a
``value`` column: lines as ``read_lines`` gives them, or objects of any number of lines as
``framing.frame`` cuts them out of whole files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.operators.quality import first_violation
from playmart.schemas import STAGING_EVENTS, STAGING_SONGS, Table

# The paths of the play log, in column order.
EVENT_PATHS = tuple(f"$.{column}" for column in STAGING_EVENTS.columns)

_PARSED = "__parsed"
_END = "end of line"

# One step from the end of the last number: over whole strings and whatever holds no digit, to
# a number as JSON writes it. Anything else stops the steps, and the parser then refuses it.
_NUMBER = (
    r"""\G((?:[^"0-9-]++|"(?:[^"\\]++|\\.)*+")*+(?<=[\s:,\[{]|^))"""
    r"(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?)(?=[\s,\]}]|$)"
)


def read_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Every text line under ``path``, nested folders included, with its file."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))


def non_blank(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").rlike(r"\S"))


def parse_events(
    lines: DataFrame, paths: tuple[str, ...] = EVENT_PATHS, on_error: str = "skip"
) -> DataFrame:
    """Play-log lines to ``staging_events``: the n-th path fills the n-th column."""
    return _objects(lines, on_error).select(*_event_columns(paths))


def parse_songs(lines: DataFrame, on_error: str = "skip") -> DataFrame:
    """Song lines to ``staging_songs``: keys match columns whatever their letter case.

    When several keys of one object differ only in case, the first key in the
    object's sorted key order wins.
    """
    return _song_columns(_objects(lines, on_error), [])


def tag_events(records: DataFrame, paths: tuple[str, ...] = EVENT_PATHS) -> DataFrame:
    """Every record once: its staging columns, and ``line`` and ``reason`` if it is refused."""
    parsed = _with_reason(records)
    others = [c for c in parsed.columns if c not in (_PARSED, "value", "reason")]
    return _tagged(parsed.select(*others, "value", "reason", *_event_columns(paths)), STAGING_EVENTS)


def tag_songs(records: DataFrame) -> DataFrame:
    """Like ``tag_events`` for song records."""
    parsed = _with_reason(records)
    others = [c for c in parsed.columns if c != _PARSED]
    return _tagged(_song_columns(parsed, others), STAGING_SONGS)


def refuse(tagged: DataFrame) -> DataFrame:
    """Fail the job on the first record that is refused."""
    place = F.col("file_path") if "file_path" in tagged.columns else F.lit("line")
    message = F.concat_ws(": ", F.lit("bad line"), "reason", place, "line")
    failing = F.when(F.col("reason").isNotNull(), F.raise_error(message).cast("string"))
    return tagged.withColumn("reason", failing)


def _tagged(rows: DataFrame, table: Table) -> DataFrame:
    reason = F.coalesce("reason", first_violation(table, rows.columns))
    rows = rows.withColumn("reason", reason)
    return rows.withColumn("line", F.when(F.col("reason").isNotNull(), F.col("value"))).drop("value")


def _event_columns(paths: tuple[str, ...]) -> list[Column]:
    if len(paths) != len(STAGING_EVENTS.columns):
        raise ValueError(f"expected {len(STAGING_EVENTS.columns)} paths, got {len(paths)}")
    return [
        F.try_variant_get(_PARSED, path, "string").alias(column)
        for column, path in zip(STAGING_EVENTS.columns, paths)
    ]


def _song_columns(parsed: DataFrame, others: list[str]) -> DataFrame:
    entries = F.try_variant_get(_PARSED, "$", "map<string,string>")
    keyed = parsed.select(*others, entries.alias("__entries")).select(
        *others,
        F.transform(F.map_keys("__entries"), F.lower).alias("__keys"),
        F.map_values("__entries").alias("__texts"),
    )
    place = lambda c: F.array_position("__keys", c.lower()).cast("int") - 1
    return keyed.select(*others, *[F.get("__texts", place(c)).alias(c) for c in STAGING_SONGS.columns])


def load_errors(lines: DataFrame) -> DataFrame:
    """Non-blank lines that hold no JSON object, with the reason they were refused."""
    checked = _with_reason(lines)
    kept = [c for c in lines.columns if c != "value"]
    return checked.where(F.col("reason").isNotNull()).select(
        *kept, F.col("value").alias("line"), "reason"
    )


def _objects(lines: DataFrame, on_error: str) -> DataFrame:
    checked = _with_reason(lines)
    if on_error == "skip":
        # not a filter: that would be pushed below the parse and parse every line twice
        good = F.explode_outer(F.when(F.col("reason").isNull(), F.array(_PARSED)))
        others = [c for c in checked.columns if c != _PARSED]
        return checked.select(*others, good.alias(_PARSED)).where(F.col(_PARSED).isNotNull())
    if on_error == "fail":
        place = F.col("file_path") if "file_path" in lines.columns else F.lit("line")
        message = F.concat_ws(": ", F.lit("bad line"), "reason", place, "value")
        guarded = F.when(F.col("reason").isNull(), F.col(_PARSED)).otherwise(
            F.raise_error(message).cast("variant")
        )
        return checked.withColumn(_PARSED, guarded)
    raise ValueError(f"on_error must be 'skip' or 'fail', not {on_error!r}")


def _with_reason(lines: DataFrame) -> DataFrame:
    quoted = F.regexp_replace("value", _NUMBER, '$1"$2"')
    wrapped = F.concat(F.lit("["), quoted, F.lit(f',"{_END}"]'))
    parsed = non_blank(lines).withColumn("__whole", F.try_parse_json(wrapped))
    is_object = F.col("value").rlike(r"^\s*\{")
    alone = F.try_variant_get("__whole", "$[1]", "string").eqNullSafe(F.lit(_END))
    alone &= F.try_variant_get("__whole", "$[2]", "variant").isNull()
    parsed = parsed.withColumns(
        {
            "reason": F.when(F.col("__whole").isNull(), "malformed JSON")
            .when(~alone, "text after the object")
            .when(~is_object, "not a JSON object"),
            _PARSED: F.try_variant_get("__whole", "$[0]", "variant"),
        }
    )
    return parsed.drop("__whole")
