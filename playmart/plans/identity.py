"""Artist identity resolution over a many-to-many id/name relation.

Two forms are offered. The *step* form follows the six documented steps and yields
the working table with its ``step`` tag. The *production* form (``resolve_artist_ids``,
``dim_artist_names``) gets the same result per name from a handful of grouped
aggregations; the tests hold the two against each other.

Why one aggregation is enough: a name with a single id keeps that id (steps 1 and 2).
In a name with several ids, ids that carry only this name keep themselves (step 3), the
others take the largest id of step 3 or, without one, keep themselves (step 4). Step 5
takes the largest id per name, hence

    resolved(name) = coalesce(max(id with one name only), max(id))

NULL names match nothing: they count as one more name of their id, but get no
attributes, and the production form leaves them out because the dimension is keyed by
name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.casts import numeric_score, present_score, text_score, to_decimal
from playmart.operators.grouping import attach, best_field, n_rows, pick_best
from playmart.operators.workspace import Shared, cut
from playmart.schemas import STAGING_ARTIST_NAMES

PAIR = ["artist_id", "artist_name"]
ARTIST_TEXTS = [*PAIR, "artist_latitude", "artist_longitude", "artist_location"]


def typed_artist_rows(songs: DataFrame) -> DataFrame:
    """Artist columns of the song rows with typed coordinates and validity scores."""
    return (
        songs.select(
            "artist_id",
            "artist_name",
            to_decimal("artist_latitude", 10, 8).alias("artist_latitude"),
            numeric_score("artist_latitude").alias("artist_latitude_score"),
            to_decimal("artist_longitude", 11, 8).alias("artist_longitude"),
            numeric_score("artist_longitude").alias("artist_longitude_score"),
            "artist_location",
            text_score("artist_location").alias("artist_location_score"),
        )
        .withColumn(
            "artist_lat_long_score",
            F.col("artist_latitude_score") + F.col("artist_longitude_score"),
        )
        .select(
            "artist_id",
            "artist_name",
            "artist_latitude",
            "artist_latitude_score",
            "artist_longitude",
            "artist_longitude_score",
            "artist_lat_long_score",
            "artist_location",
            "artist_location_score",
        )
    )


def artist_variants(songs: DataFrame, shared: Shared | None = None) -> DataFrame:
    """Distinct artist texts of the songs; with ``shared``, the one pass over the songs of a build."""
    distinct = songs.select(*ARTIST_TEXTS).distinct()
    return shared.get("artist-variants", lambda: distinct) if shared else distinct


def artist_rows(songs: DataFrame, shared: Shared | None = None) -> DataFrame:
    """Distinct artist rows: one song may repeat what another already said."""
    return typed_artist_rows(artist_variants(songs, shared) if shared else songs).distinct()


def artist_rows_once(songs: DataFrame) -> DataFrame:
    """Typed artist rows of the distinct texts: a hash aggregate in front of picks that sort."""
    return typed_artist_rows(artist_variants(songs))


def artist_pairs(rows: DataFrame) -> DataFrame:
    return rows.select(*PAIR).distinct()


def artist_id_name_flags(rows: DataFrame, shared: Shared | None = None) -> DataFrame:
    """Distinct (id, name) pairs with a flag for many names per id and many ids per name.

    The pairs are written once: three branches read them, and they are far fewer than
    the rows they come from. With ``shared`` they are those of the build's pair table.
    """
    pairs = pair_table(rows, shared).select(*PAIR) if shared else cut(artist_pairs(rows), "artist-pairs")
    many_ids = pairs.groupBy("artist_name").agg((n_rows() > 1).alias("many_ids"))
    flagged = attach(attach(pairs, _many_names(pairs), ["artist_id"]), many_ids, ["artist_name"])
    return flagged.select(
        *PAIR,
        _flag("many_names").alias("multiple_name_indicator"),
        _flag("many_ids").alias("multiple_id_indicator"),
    )


def best_attributes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the best-scored coordinate pair and, on its own, the best-scored location.

    ``rows`` carries the score columns of ``typed_artist_rows``. Rows with a NULL key
    keep NULL attributes, because an equality lookup would find nothing for them.
    """
    picked = rows.groupBy(*keys).agg(
        pick_best(F.col("artist_lat_long_score"), "artist_latitude", "artist_longitude").alias(
            "geo"
        ),
        pick_best(F.col("artist_location_score"), "artist_location").alias("place"),
    )
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return picked.select(
        *keys,
        F.when(known, best_field("geo", "artist_latitude")).alias("artist_latitude"),
        F.when(known, best_field("geo", "artist_longitude")).alias("artist_longitude"),
        F.when(known, best_field("place", "artist_location")).alias("artist_location"),
    )


def pair_table(songs: DataFrame, shared: Shared | None = None) -> DataFrame:
    """Written once per job, or once per build with ``shared``: the (id, name) pairs with their best attributes.

    This is the only pass over the song rows; every later step works on pairs. Equal
    artist texts collapse first, in a hash aggregate, so that casts, patterns and the
    sort-based pick see each variant once instead of once per song.
    """

    def make() -> DataFrame:
        return best_attributes(typed_artist_rows(artist_variants(songs, shared)), PAIR)

    return shared.get("artist-pairs", make) if shared else cut(make(), "artist-pairs")


# --- step form ---------------------------------------------------------------------


def steps_1_to_4(songs: DataFrame, shared: Shared | None = None) -> DataFrame:
    """Working rows of the first four steps, one per (id, name) pair.

    The step number is the pair's class: 1 neither flag, 2 only many names, 3 only many
    ids, 4 both. Only step 4 ever finds an earlier row of its name to inherit from.
    """
    pairs = pair_table(songs, shared)
    per_name = (
        _offers(pairs.select(*PAIR))
        .groupBy("artist_name")
        .agg(
            (F.count_if(~F.col("is_offer")) > 1).alias("many_ids"),
            F.max("settled_id").alias("settled_id"),
        )
    )
    both = attach(attach(pairs, _many_names(pairs), ["artist_id"]), per_name, ["artist_name"])
    both = both.withColumn("multiple_name_indicator", _flag("many_names")).withColumn(
        "multiple_id_indicator", _flag("many_ids")
    )
    step = 1 + F.col("multiple_name_indicator") + 2 * F.col("multiple_id_indicator")
    own = F.col("artist_id")
    inherited = F.when(step == 4, F.coalesce("settled_id", own)).otherwise(own)
    return both.select(
        F.col("artist_id").alias("original_artist_id"),
        "artist_name",
        inherited.alias("recalculated_artist_id"),
        "artist_latitude",
        "artist_longitude",
        "artist_location",
        "multiple_name_indicator",
        "multiple_id_indicator",
        step.cast("int").alias("step"),
    )


def one_step(songs: DataFrame, step: int) -> DataFrame:
    return steps_1_to_4(songs).where(F.col("step") == step)


def step_5(first_four: DataFrame) -> DataFrame:
    """One id per name: the largest recalculated id of the name."""
    per_name = first_four.groupBy("artist_name").agg(
        F.max("recalculated_artist_id").alias("largest")
    )
    return _as_step(
        attach(first_four, per_name, ["artist_name"], nulls_match=True)
        .drop("recalculated_artist_id")
        .withColumnRenamed("largest", "recalculated_artist_id"),
        5,
    )


def step_6(fifth: DataFrame) -> DataFrame:
    """Best coordinates and location per recalculated id, by what is present.

    ``fifth`` is read twice, so hand in a stored table.
    """
    per_id = _best_present(fifth, "recalculated_artist_id")
    rows = fifth.drop("artist_latitude", "artist_longitude", "artist_location")
    return _as_step(attach(rows, per_id, ["recalculated_artist_id"], nulls_match=True), 6)


def working_rows(songs: DataFrame, shared: Shared | None = None) -> DataFrame:
    """All six steps in one table, as each was appended."""
    first_four = cut(steps_1_to_4(songs, shared), "artist-steps")
    fifth = cut(step_5(first_four), "artist-step-5")
    return first_four.unionByName(fifth).unionByName(step_6(fifth))


# --- production form ---------------------------------------------------------------


def resolve_artist_ids(songs: DataFrame) -> DataFrame:
    """name -> recalculated id, in two grouped aggregations and no join."""
    offers = _offers(cut(artist_pairs(songs), "artist-pairs"))
    return (
        offers.where(F.col("artist_name").isNotNull())
        .groupBy("artist_name")
        .agg(_resolved().alias("recalculated_artist_id"))
    )


def resolved_names(songs: DataFrame, shared: Shared | None = None) -> DataFrame:
    """Per name: its resolved id and the best attributes among its own (id, name) pairs."""
    # An offered id comes without attributes; its score of 0 never displaces a pair's value.
    offers = _offers(pair_table(songs, shared)).where(F.col("artist_name").isNotNull())
    picked = offers.groupBy("artist_name").agg(
        _resolved().alias("recalculated_artist_id"), *_pick_present()
    )
    return picked.select("artist_name", "recalculated_artist_id", *_picked_attributes())


def dim_artist_names(songs: DataFrame, shared: Shared | None = None) -> DataFrame:
    """One row per name: resolved id, and the best attributes of all names of that id.

    The best of an id's pairs is the best of its names' bests, so attributes are folded
    pair -> name -> id. The per-name result is written once, because both the fold over
    ids and the final join read it.
    """
    names = cut(resolved_names(songs, shared), "artist-names")
    per_id = _best_present(names, "recalculated_artist_id")
    joined = attach(
        names.select("artist_name", "recalculated_artist_id"),
        per_id,
        ["recalculated_artist_id"],
        nulls_match=True,
    )
    return joined.select(
        F.col("artist_name").alias("name"),
        F.col("recalculated_artist_id").alias("artist_id"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
        F.col("artist_location").alias("location"),
    )


def _many_names(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("artist_id").agg((n_rows() > 1).alias("many_names"))


def _offers(pairs: DataFrame) -> DataFrame:
    """The pairs, plus a ``settled_id`` row for every id that carries one name only.

    A NULL name counts as a name of its id. Grouping the result by name answers both
    what ids the name has and which of them belong to no other name.
    """
    settled = (
        pairs.where(F.col("artist_id").isNotNull())
        .groupBy("artist_id")
        .agg(n_rows().alias("names"), F.min("artist_name").alias("artist_name"))
        .where("names = 1 and artist_name is not null")
        .select("artist_name", F.col("artist_id").alias("settled_id"))
        .withColumn("is_offer", F.lit(True))
    )
    return pairs.withColumn("is_offer", F.lit(False)).unionByName(settled, allowMissingColumns=True)


def _resolved() -> Column:
    return F.coalesce(F.max("settled_id"), F.max("artist_id"))


def _pick_present() -> list[Column]:
    coordinates = present_score("artist_latitude") + present_score("artist_longitude")
    return [
        pick_best(coordinates, "artist_latitude", "artist_longitude").alias("geo"),
        pick_best(text_score("artist_location"), "artist_location").alias("place"),
    ]


def _picked_attributes() -> list[Column]:
    return [
        best_field("geo", "artist_latitude").alias("artist_latitude"),
        best_field("geo", "artist_longitude").alias("artist_longitude"),
        best_field("place", "artist_location").alias("artist_location"),
    ]


def _best_present(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(*_pick_present()).select(key, *_picked_attributes())


def _as_step(rows: DataFrame, step: int) -> DataFrame:
    """Tag rows with a later step; the class flags no longer apply."""
    tagged = (
        rows.withColumn("multiple_name_indicator", F.lit(None).cast("int"))
        .withColumn("multiple_id_indicator", F.lit(None).cast("int"))
        .withColumn("step", F.lit(step))
    )
    return tagged.select(*STAGING_ARTIST_NAMES.columns)


def _flag(condition: str) -> Column:
    return F.coalesce(F.col(condition), F.lit(False)).cast("int")
