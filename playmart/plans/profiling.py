"""Data-profiling questions about artists, songs, users and plays."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions import calendar as cal
from playmart.functions.casts import to_decimal
from playmart.operators.grouping import (
    attach,
    duplicate_groups,
    keep_first_groups,
    keep_groups,
    n_rows,
    several,
)
from playmart.operators.ranking import first_pairs
from playmart.operators.workspace import cut
from playmart.plans.dims import dim_time, plays
from playmart.plans.facts import fact_songplays
from playmart.plans.identity import PAIR, artist_pairs


def _ordered(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


# --- artists -----------------------------------------------------------------------


def artist_counts(songs: DataFrame) -> DataFrame:
    """Distinct pairs, names and ids."""
    return artist_pairs(songs).agg(
        n_rows().alias("artists_count"),
        F.count_distinct("artist_name").alias("artist_name_count"),
        F.count_distinct("artist_id").alias("artist_id_count"),
    )


def names_sharing_id(songs: DataFrame, n: int = 10) -> DataFrame:
    """First pairs of different names under one id."""
    return first_pairs(songs, "artist_id", "artist_name", n, ordered=False).select(
        "artist_id",
        F.col("left_member").alias("artist_name"),
        F.col("right_member").alias("other_artist_name"),
    )


def ids_sharing_name(songs: DataFrame, n: int = 10, names: list[str] | None = None) -> DataFrame:
    """First pairs of different ids under one name, larger id on the left."""
    if names is not None:
        songs = songs.where(F.col("artist_name").isin(names))
    return first_pairs(songs, "artist_name", "artist_id", n, ordered=True).select(
        "artist_name",
        F.col("left_member").alias("artist_id"),
        F.col("right_member").alias("other_artist_id"),
    )


def names_per_id(songs: DataFrame) -> DataFrame:
    return artist_pairs(songs).groupBy("artist_id").agg(n_rows().alias("artist_name_count"))


def ids_per_name(songs: DataFrame) -> DataFrame:
    return artist_pairs(songs).groupBy("artist_name").agg(n_rows().alias("artist_id_count"))


def multi_name_ids_summary(songs: DataFrame) -> DataFrame:
    """How many ids have several names, and how many names those are."""
    return names_per_id(songs).where("artist_name_count > 1").agg(
        n_rows().alias("artist_id_count"),
        F.sum("artist_name_count").alias("artist_name_count"),
    )


def names_with_most_ids(songs: DataFrame, n: int = 15) -> DataFrame:
    return (
        ids_per_name(songs)
        .where("artist_id_count > 1")
        .orderBy(F.desc("artist_id_count"), F.col("artist_name").asc_nulls_last())
        .limit(n)
    )


def single_name_id_count(songs: DataFrame) -> DataFrame:
    return names_per_id(songs).where("artist_name_count = 1").agg(n_rows().alias("artist_id_count"))


def single_id_name_count(songs: DataFrame) -> DataFrame:
    return ids_per_name(songs).where("artist_id_count = 1").agg(n_rows().alias("artist_name_count"))


def clean_pairs(songs: DataFrame) -> DataFrame:
    """Pairs whose id has no other name and whose name has no other id."""
    pairs = cut(artist_pairs(songs), "artist-pairs")
    crowded_ids = names_per_id(pairs).where("artist_name_count > 1").select("artist_id")
    crowded_names = ids_per_name(pairs).where("artist_id_count > 1").select("artist_name")
    clean = attach(pairs, crowded_ids, ["artist_id"], "left_anti")
    return attach(clean, crowded_names, ["artist_name"], "left_anti")


def clean_pair_count(songs: DataFrame) -> DataFrame:
    return clean_pairs(songs).agg(n_rows().alias("pair_count"))


def pair_flags_sample(flags: DataFrame, n: int = 10) -> DataFrame:
    return _ordered(flags, *PAIR).limit(n)


def geo_variants(songs: DataFrame, names: list[str], n: int = 50) -> DataFrame:
    """Recorded geo attributes of chosen names."""
    variants = songs.where(F.col("artist_name").isin(names)).select(
        *PAIR, "artist_latitude", "artist_longitude", "artist_location"
    )
    variants = variants.distinct()
    return _ordered(variants, "artist_name", "artist_id", *variants.columns[2:]).limit(n)


def names_with_located_ids(songs: DataFrame) -> DataFrame:
    """Names that have several ids among rows with a non-blank location."""
    located = songs.where(F.trim("artist_location") != "")
    return located.groupBy("artist_name").agg(several("artist_id").alias("many")).where(
        "many"
    ).select("artist_name")


def either(ids: list[str], names: list[str], id_column: str = "artist_id") -> Column:
    return F.col(id_column).isin(ids) | F.col("artist_name").isin(names)


def pair_lookup(flags: DataFrame, ids: list[str], names: list[str], n: int = 100) -> DataFrame:
    return _ordered(flags.where(either(ids, names)), "artist_name", "artist_id").limit(n)


def artist_row_lookup(rows: DataFrame, ids: list[str], names: list[str]) -> DataFrame:
    return rows.where(either(ids, names))


def located_rows_page(
    rows: DataFrame, flags: DataFrame, offset: int = 900, n: int = 10
) -> DataFrame:
    """A page of artist rows with a latitude, provided any name has several ids at all."""
    any_shared = flags.where("multiple_id_indicator = 1").exists()
    kept = rows.where(any_shared & F.col("artist_latitude").isNotNull())
    return _ordered(kept, "artist_name", "artist_id", *rows.columns[2:]).offset(offset).limit(n)


def step_progress(spark: SparkSession, flags: DataFrame, working: DataFrame) -> DataFrame:
    """Number of pairs beside the number of working rows."""
    return spark.range(1).select(
        flags.agg(n_rows()).scalar().alias("pair_count"),
        working.agg(n_rows()).scalar().alias("working_row_count"),
    )


def resolution_trace(
    rows: DataFrame, first_four: DataFrame, ids: list[str], names: list[str], n: int = 6
) -> DataFrame:
    """Recorded rows of chosen artists beside what the steps made of them."""
    chosen = rows.where(either(ids, names))
    made = first_four.where(either(ids, names, "original_artist_id")).select(
        F.col("original_artist_id").alias("artist_id"),
        "artist_name",
        "recalculated_artist_id",
        F.col("artist_latitude").alias("best_latitude"),
        F.col("artist_longitude").alias("best_longitude"),
        F.col("artist_location").alias("best_location"),
        "multiple_id_indicator",
        "multiple_name_indicator",
    )
    traced = attach(chosen, made, PAIR).select(
        *PAIR,
        "recalculated_artist_id",
        F.col("artist_latitude").alias("original_latitude"),
        "best_latitude",
        F.col("artist_longitude").alias("original_longitude"),
        "best_longitude",
        F.col("artist_location").alias("original_location"),
        "best_location",
        "multiple_id_indicator",
        "multiple_name_indicator",
    )
    return _ordered(
        traced,
        *PAIR,
        "original_latitude",
        "original_longitude",
        "original_location",
    ).limit(n)


def unresolved_count(working: DataFrame) -> DataFrame:
    return working.where(F.col("recalculated_artist_id").isNull()).agg(
        n_rows().alias("unresolved_count")
    )


def changed_id_groups(working: DataFrame) -> DataFrame:
    """Working rows of every resolved id that replaced another id and has several rows."""
    replaced = F.max(F.col("recalculated_artist_id") != F.col("original_artist_id"))
    return keep_groups(
        working,
        ["recalculated_artist_id"],
        (n_rows() > 1) & F.coalesce(replaced, F.lit(False)),
    )


def changed_id_groups_report(working: DataFrame, n: int = 200) -> DataFrame:
    order = ["artist_name", "step", "original_artist_id", "recalculated_artist_id"]
    return _ordered(changed_id_groups(working), *order).limit(n)


def names_with_many_final_ids(working: DataFrame) -> DataFrame:
    """Must be 0: names that still have several ids after step 6."""
    final = working.where("step = 6").groupBy("artist_name")
    return (
        final.agg(several("recalculated_artist_id").alias("many"))
        .where("many")
        .agg(n_rows().alias("name_count"))
    )


def resolved_lookup(working: DataFrame, ids: list[str], n: int = 100) -> DataFrame:
    chosen = working.where(F.col("original_artist_id").isin(ids))
    return _ordered(chosen, "artist_name", "original_artist_id", "step").limit(n)


# --- songs -------------------------------------------------------------------------

SONG_COLUMNS = ["song_id", "num_songs", "title", "artist_name", "year", "duration"]


def frequency_table(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(n_rows().alias("row_count"))


def text_and_number_range(rows: DataFrame, column: str) -> DataFrame:
    """Extremes of a staged number as text and as a wide decimal."""
    number = to_decimal(column, 38, 19)
    return rows.agg(
        F.min(column).alias("min_text"),
        F.max(column).alias("max_text"),
        F.min(number).alias("min_number"),
        F.max(number).alias("max_number"),
    )


def songs_of_crowded(
    songs: DataFrame, key: list[str], having: Column, n: int = 10, offset: int = 0
) -> DataFrame:
    """A page, by key, of song rows whose key group satisfies ``having``."""
    rest = [c for c in SONG_COLUMNS if c not in key]
    kept = keep_first_groups(songs.select(*SONG_COLUMNS), key, having, n + offset)
    page = _ordered(kept, *key, *rest)
    return (page.offset(offset) if offset else page).limit(n)


def song_id_many_titles(songs: DataFrame) -> DataFrame:
    return songs_of_crowded(songs, ["song_id"], several("title"))


def song_id_many_artists(songs: DataFrame) -> DataFrame:
    return songs_of_crowded(songs, ["song_id"], several("artist_name"))


def title_many_artists(songs: DataFrame, offset: int = 210) -> DataFrame:
    return songs_of_crowded(songs, ["title"], several("artist_name"), offset=offset)


def duplicate_artist_title(songs: DataFrame, offset: int = 2100) -> DataFrame:
    return songs_of_crowded(songs, ["title", "artist_name"], n_rows() > 1, offset=offset)


def song_title_count(songs: DataFrame) -> DataFrame:
    return songs.select("artist_name", "title").distinct().agg(n_rows().alias("song_title_count"))


def title_or_artist_lookup(
    songs: DataFrame, titles: list[str], artist: str, n: int = 20
) -> DataFrame:
    chosen = songs.where(F.col("title").isin(titles) | (F.col("artist_name") == artist))
    return _ordered(chosen, "title", "song_id", *[
        c for c in songs.columns if c not in ("title", "song_id")
    ]).limit(n)


# --- users and plays ---------------------------------------------------------------


def null_user_count(events: DataFrame) -> DataFrame:
    """Events that truly lack a user id."""
    return events.agg(F.count_if(F.col("userId").isNull()).alias("null_user_count"))


def users_many_levels(events: DataFrame, n: int = 10) -> DataFrame:
    """First users with several levels among their plays, one row per level."""
    rows = plays(events).select("userId", "firstName", "lastName", "level")
    kept = keep_first_groups(rows, ["userId"], several("level"), n).distinct()
    return _ordered(kept, "userId", "level", "firstName", "lastName").limit(n)


def duplicate_plays(events: DataFrame, n: int | None = None) -> DataFrame:
    """All plays recorded more than once; ``n`` lists only the first."""
    copies = duplicate_groups(fact_songplays(events))
    ordered = _ordered(copies, *copies.columns)
    return ordered if n is None else ordered.limit(n)


def unmatched_plays(songplays: DataFrame, song_titles: DataFrame) -> DataFrame:
    """Plays whose (artist, title) is not in the song dimension, as a quality count.

    Plays are counted per (artist, title) before the join.
    """
    played = songplays.groupBy("artist_name", F.col("song_title").alias("title")).agg(
        n_rows().alias("n")
    )
    missing = played.join(song_titles, ["artist_name", "title"], "left_anti")
    return missing.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("unmatched_plays"),
        n_rows().alias("unmatched_titles"),
    )


def epoch_exploration(events: DataFrame, n: int = 2) -> DataFrame:
    """The staged epoch text beside seconds, interval and timestamp."""
    seconds = (to_decimal("ts", 18, 0) * F.lit(Decimal("0.001"))).cast("decimal(18,6)")
    interval = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return _ordered(
        events.select(
            "ts",
            seconds.cast("decimal(18,3)").alias("seconds"),
            F.expr(cal.EPOCH).alias("epoch_start"),
            (F.expr(cal.EPOCH) + interval).alias("start_time"),
            "userId",
        ),
        "ts",
        "userId",
    ).limit(n)


def time_dim_preview(events: DataFrame, n: int = 14) -> DataFrame:
    return dim_time(events).orderBy("time_key").limit(n)
