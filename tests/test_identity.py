"""The grouped forms against a row-by-row telling of the six steps, on random graphs."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from playmart.plans import identity
from playmart.schemas import STAGING_SONGS
from tests.conftest import rows_of


def song(artist_id, name, lat="", lon="", place="", **more):
    given = dict(
        artist_id=artist_id,
        artist_name=name,
        artist_latitude=lat,
        artist_longitude=lon,
        artist_location=place,
        **more,
    )
    return tuple(given.get(c) for c in STAGING_SONGS.columns)


def songs_frame(spark, songs):
    return spark.createDataFrame(songs, STAGING_SONGS.schema)


def literal_resolution(pairs):
    """name -> id as the steps say it: insert step by step, look names up in what is there."""
    names_of, ids_of = {}, {}
    for i, n in pairs:
        names_of.setdefault(i, set()).add(n)
        ids_of.setdefault(n, set()).add(i)
    done = []
    for many_names, many_ids in ((0, 0), (1, 0), (0, 1), (1, 1)):
        found = {}
        for _, n, r in done:
            if n is not None and r is not None:
                found[n] = max(found.get(n, r), r)
        for i, n in pairs:
            flags = (
                int(i is not None and len(names_of[i]) > 1),
                int(n is not None and len(ids_of[n]) > 1),
            )
            if flags == (many_names, many_ids):
                done.append((i, n, found.get(n, i)))
    final = {}
    for _, n, r in done:
        known = [x for x in (final.get(n), r) if x is not None]
        final[n] = max(known) if known else None
    return final


def random_pairs(rng):
    ids = [f"i{k}" for k in range(rng.randint(1, 6))] + [None]
    names = [f"n{k}" for k in range(rng.randint(1, 6))] + [None]
    return {(rng.choice(ids), rng.choice(names)) for _ in range(rng.randint(1, 14))}


def test_resolution_equals_literal_steps_on_many_graphs(spark):
    """300 random graphs at once; each graph has its own ids and names."""
    rng = random.Random(7)
    songs, expected = [], {}
    for g in range(300):
        pairs = set()
        for i, n in random_pairs(rng):
            # NULL ids or names would meet across graphs, so only one graph has any.
            if g and (i is None or n is None):
                continue
            pairs.add((i and f"{g:03}{i}", n and f"{g:03}{n}"))
        expected.update(literal_resolution(pairs))
        songs += [song(i, n) for i, n in pairs]
    expected.pop(None, None)
    frame = songs_frame(spark, songs).repartition(5)
    assert dict(rows_of(identity.resolve_artist_ids(frame))) == expected
    stepwise = identity.step_5(identity.steps_1_to_4(frame)).where("artist_name is not null")
    assert dict(rows_of(stepwise.select("artist_name", "recalculated_artist_id").distinct())) == (
        expected
    )


@pytest.mark.parametrize("seed", range(8))
def test_null_ids_and_names(spark, seed):
    rng = random.Random(100 + seed)
    pairs = set().union(*(random_pairs(rng) for _ in range(3)))
    expected = literal_resolution(pairs)
    expected.pop(None, None)
    frame = songs_frame(spark, [song(i, n) for i, n in pairs])
    assert dict(rows_of(identity.resolve_artist_ids(frame))) == expected


def test_production_dimension_equals_sixth_step(spark):
    rng = random.Random(3)
    coordinates = ["", "n/a", "12.5", "-7", "123.5", "5.", None, ".25"]
    places = [None, "", "  ", "Lima", "Oslo"]
    songs = [
        song(i, n, rng.choice(coordinates), rng.choice(coordinates), rng.choice(places))
        for _ in range(60)
        for i, n in random_pairs(rng)
    ]
    frame = songs_frame(spark, songs).repartition(7)
    sixth = identity.working_rows(frame).where("step = 6 and artist_name is not null")
    steps = sixth.select(
        F.col("artist_name").alias("name"),
        F.col("recalculated_artist_id").alias("artist_id"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
        F.col("artist_location").alias("location"),
    ).distinct()
    dimension = identity.dim_artist_names(frame)
    assert rows_of(dimension) == rows_of(steps)
    assert dimension.count() == dimension.select("name").distinct().count()


def test_one_hot_name_and_one_hot_id(spark):
    """A third of the rows under one name, a third under one id."""
    songs = [song(f"a{k:05}", "Everyone") for k in range(3000)]
    songs += [song("zz", f"alias {k:05}", "1.5", "2.5", "Quito") for k in range(3000)]
    songs += [song(f"b{k:05}", f"solo {k:05}") for k in range(3000)]
    dim = identity.dim_artist_names(songs_frame(spark, songs).repartition(8))
    assert dim.count() == 1 + 3000 + 3000
    assert dim.where("name = 'Everyone'").first()["artist_id"] == "a02999"
    aliases = dim.where("artist_id = 'zz'").groupBy("latitude", "longitude", "location").count()
    assert [tuple(r) for r in aliases.collect()] == [
        (Decimal("1.50000000"), Decimal("2.50000000"), "Quito", 3000)
    ]


def test_best_attributes_takes_a_coordinate_pair_from_one_row(spark):
    songs = [
        song("i", "n", "10.5", "", "  "),
        song("i", "n", "3.5", "4.5", ""),
        song("i", "n", "2.5", "9.5", "Zagreb"),
        song("i", "n", "", "1.5", "Accra"),
    ]
    best = identity.best_attributes(
        identity.typed_artist_rows(songs_frame(spark, songs)), identity.PAIR
    ).first()
    # Two rows score 2; the smaller latitude decides and brings its own longitude.
    assert (best["artist_latitude"], best["artist_longitude"]) == (
        Decimal("2.50000000"),
        Decimal("9.50000000"),
    )
    assert best["artist_location"] == "Accra"


def test_partitioning_and_row_order_do_not_matter(spark):
    rng = random.Random(11)
    songs = [
        song(i, n, rng.choice(["", "1.5", "2.5"]), rng.choice(["", "7.5"]), rng.choice(["", "X"]))
        for _ in range(20)
        for i, n in random_pairs(rng)
    ]
    expected = rows_of(identity.dim_artist_names(songs_frame(spark, songs)))
    rng.shuffle(songs)
    for partitions in (1, 9):
        frame = songs_frame(spark, songs).repartition(partitions)
        assert rows_of(identity.dim_artist_names(frame)) == expected
