"""The whole build: source objects to staging, working and mart tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart import schemas as S
from playmart.operators import layout, versions
from playmart.operators.quality import enforce_contract
from playmart.operators.workspace import Shared, cut, scratch
from playmart.plans import dims, facts, identity
from playmart.sources import framing, landing


@dataclass(frozen=True)
class Sources:
    """Where the two JSON collections lie; a sub-prefix gives a smaller build."""

    events: str
    songs: str
    event_paths: tuple[str, ...] = landing.EVENT_PATHS
    on_error: str = "fail"


COUNTS = "collection string, records long, refused long, staged long, ok boolean"


def land(spark: SparkSession, sources: Sources, root: str) -> DataFrame:
    """Parse the JSON objects into the two staging tables; returns ``landing_counts``.

    Each source is read once and each record parsed once, into one written result that is
    split by whether the record was refused. Counters ride along with that write; if the stored
    staging rows and the refused records do not add up to the records, the landing fails.
    With ``on_error='skip'`` the refused records are kept in ``load_errors``.
    """
    if sources.on_error not in ("fail", "skip"):
        raise ValueError(f"on_error must be 'skip' or 'fail', not {sources.on_error!r}")
    tagged = (
        (S.STAGING_EVENTS, landing.tag_events(_records(spark, sources.events), sources.event_paths)),
        (S.STAGING_SONGS, landing.tag_songs(_records(spark, sources.songs))),
    )
    counts, refused = [], []
    for table, rows in tagged:
        rows = landing.refuse(rows) if sources.on_error == "fail" else rows
        counts.append(_land_one(spark, rows, root, table))
        if counts[-1][2]:
            refused.append(spark.read.parquet(f"{root}/{table.name}_refused").select("file_path", "line", "reason"))
    counted = spark.createDataFrame(counts, COUNTS)
    counted.coalesce(1).write.mode("overwrite").parquet(f"{root}/landing_counts")
    if sources.on_error == "skip":
        none = spark.createDataFrame([], "file_path string, line string, reason string")
        errors = refused[0].unionByName(refused[1]) if len(refused) == 2 else refused[0] if refused else none
        errors.write.mode("overwrite").parquet(f"{root}/load_errors")
    lost = [row for row in counts if not row[-1]]
    if lost:
        raise RuntimeError(f"records and staged rows differ (collection, records, refused, staged): {lost}")
    return counted


def _records(spark: SparkSession, path: str) -> DataFrame:
    return framing.frame(framing.read_blocks(spark, path))


def _land_one(spark: SparkSession, tagged: DataFrame, root: str, table: S.Table) -> tuple:
    """Write the tagged records once, good and refused ones apart; returns the row of counts."""
    seen = Observation(f"landing of {table.name}")
    is_refused = F.col("reason").isNotNull()
    watched = tagged.withColumn("refused", is_refused).observe(
        seen, F.count(F.lit(1)).alias("records"), F.count_if("refused").alias("refused")
    )
    folder = f"{root}/{table.name}_landing"
    for old in (layout.table_path(root, table), f"{root}/{table.name}_refused"):
        versions.delete(spark, old)
    watched.write.mode("overwrite").partitionBy("refused").parquet(folder)
    if not versions.move(spark, f"{folder}/refused=false", layout.table_path(root, table)):
        layout.clear_table(spark, root, table)
    versions.move(spark, f"{folder}/refused=true", f"{root}/{table.name}_refused")
    versions.delete(spark, folder)
    staged = layout.read_table(spark, root, table).count()  # from the file footers
    got = seen.get
    return table.name, got["records"], got["refused"], staged, got["records"] == got["refused"] + staged


def build_working_tables(spark: SparkSession, root: str, shared: Shared | None = None) -> None:
    """The documented artist steps, kept for inspection; the marts do not need them."""
    songs = layout.read_table(spark, root, S.STAGING_SONGS)
    shared = shared or Shared()
    layout.replace_table(identity.artist_rows(songs, shared), root, S.STAGING_ARTIST_ROW)
    layout.replace_table(identity.artist_id_name_flags(songs, shared), root, S.STAGING_ARTIST_ID_NAME)
    layout.replace_table(identity.working_rows(songs, shared), root, S.STAGING_ARTIST_NAMES)


def build_marts(
    spark: SparkSession, root: str, dense_keys: bool = False, shared: Shared | None = None
) -> None:
    """Dimensions and fact from the staging tables, each written once.

    Rows that lack a required column, are too long or repeat a key go to ``<table>_rejects``
    with the rule they break, instead of failing the build or slipping in. The fact key has
    gaps unless ``dense_keys`` asks for 0, 1, 2, ...
    """
    events = layout.read_table(spark, root, S.STAGING_EVENTS)
    songs = layout.read_table(spark, root, S.STAGING_SONGS)
    _store(identity.dim_artist_names(songs, shared), root, S.ARTIST_NAMES)
    _store(dims.dim_song_titles(songs), root, S.SONG_TITLES)
    _store(dims.dim_users(events), root, S.USERS)
    _store(dims.dim_time(events), root, S.TIME)
    plays = facts.fact_songplays(events)
    if not dense_keys:
        plays = layout.sparse_key(plays, "songplay_id")
    _store(plays, root, S.SONGPLAYS, ("user_id", "songplay_id"), dense_keys)


def build(
    spark: SparkSession,
    sources: Sources,
    root: str,
    working: bool = False,
    dense_keys: bool = False,
) -> None:
    """Run everything into a new version of ``root``; readers see it once all tables are there.

    Running it again replaces all tables together. ``versions.current(spark, root)`` is the
    folder to read; a build that stops midway leaves the former version in place.
    """
    with versions.new_version(spark, root) as folder, scratch(spark):
        land(spark, sources, folder)
        shared = Shared() if working else None  # the steps and the dimension read the songs once
        if working:
            build_working_tables(spark, folder, shared)
        build_marts(spark, folder, dense_keys, shared)
        layout.create_tables(spark, folder, list(S.ALL_TABLES.values()))


def register_views(spark: SparkSession, root: str, replicate: bool = False) -> list[str]:
    """Name the stored tables for ``spark.sql``; returns the names.

    With ``replicate`` the replicated dimensions are measured, and those small enough are
    marked for broadcasting in every query that joins them.
    """
    names, root = [], versions.current(spark, root)
    for table in S.ALL_TABLES.values():
        try:
            rows = layout.read_table(spark, root, table)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if replicate and table.replicated:
            rows = layout.replicate_dim(rows)
        rows.createOrReplaceTempView(table.name)
        names.append(table.name)
    return names


def colocate(spark: SparkSession, root: str, buckets: int, prefix: str = "colocated_") -> None:
    """Save fact and song titles once more, bucketed on the title for shuffle-free joins."""
    tables = (S.SONGPLAYS, S.SONG_TITLES)
    names = tuple(prefix + t.name for t in tables)
    root = versions.current(spark, root)
    layout.write_colocated(
        layout.read_table(spark, root, S.SONGPLAYS),
        S.SONGPLAYS.spread_by,
        S.SONGPLAYS.key[0],
        layout.read_table(spark, root, S.SONG_TITLES),
        S.SONG_TITLES.spread_by,
        names,
        tuple(f"{root.rstrip('/')}/{n}" for n in names),
        buckets,
    )


def _store(
    rows: DataFrame,
    root: str,
    table: S.Table,
    tie_break: tuple[str, ...] = (),
    number: bool = False,
) -> None:
    # Written before it is clustered: range partitioning samples its input first, and
    # neither the job nor the row numbers should be computed a second time.
    path = layout.table_path(root, table)
    generated = table is S.SONGPLAYS
    complete, rejected = enforce_contract(cut(rows, table.name), table, unique=generated)
    if number:
        complete = layout.dense_key(complete, table.key[0])
    layout.cluster_by_sortkey(layout.conform(complete, table), path, table.sort_by, tie_break)
    rejected.write.mode("overwrite").parquet(f"{path}_rejects")
