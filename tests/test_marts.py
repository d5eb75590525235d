"""Hand-made cases for dimensions, fact and reports."""

from __future__ import annotations

import datetime
from decimal import Decimal

from playmart.plans import dims, facts, marts, profiling
from playmart.schemas import STAGING_EVENTS, STAGING_SONGS
from tests.conftest import rows_of

NOON = 1541937600000  # 2018-11-11 12:00:00, a Sunday


def events(spark, *rows):
    base = dict(
        page="NextSong",
        userId="1",
        level="free",
        sessionId="1",
        ts=str(NOON),
        firstName="Ann",
        lastName="Lee",
        gender="F",
        location="Lima, CA",
        userAgent="x",
        song="s",
        artist="a",
        length="1.5",
        itemInSession="0",
    )
    filled = [tuple({**base, **r}.get(c) for c in STAGING_EVENTS.columns) for r in rows]
    return spark.createDataFrame(filled, STAGING_EVENTS.schema)


def titles(spark, *rows):
    filled = [tuple(r.get(c) for c in STAGING_SONGS.columns) for r in rows]
    return spark.createDataFrame(filled, STAGING_SONGS.schema)


def test_latest_event_wins_by_number_not_by_text(spark):
    log = events(
        spark,
        dict(ts="999", level="free"),
        dict(ts="1000", level="paid"),
        dict(ts="5000", level="free", page="Logout"),
    )
    assert rows_of(dims.dim_users(log)) == [(1, "Ann", "Lee", "F", "paid")]


def test_equal_times_are_settled_by_item(spark):
    log = events(spark, dict(itemInSession="9"), dict(itemInSession="10", level="paid"))
    assert dims.dim_users(log).first()["level"] == "paid"


def test_duration_maximum_numeric_and_lexical(spark):
    songs = titles(
        spark,
        dict(artist_name="a", title="t", year="0", duration="99.5"),
        dict(artist_name="a", title="t", year="1999", duration="250.1"),
        dict(artist_name="a", title="t", year="x", duration=""),
    )
    assert rows_of(dims.dim_song_titles(songs)) == [("a", "t", 1999, Decimal("250.1000"))]
    assert rows_of(dims.dim_song_titles_lexical(songs)) == [("a", "t", None, Decimal("99.5000"))]


def test_time_row_of_a_sunday_and_iso_week(spark):
    log = events(spark, dict(ts=str(NOON + 59 * 60_000 + 796)), dict(ts=str(NOON)))
    row = dims.dim_time(log).first()
    assert row.asDict() == dict(
        time_key=2018111112,
        timestamp_date=datetime.datetime(2018, 11, 11, 12),
        hour=12,
        day=11,
        week=45,
        month=11,
        year=2018,
        day_of_week=0,
        day_of_week_name="Sunday   ",
        is_weekend=True,
    )


def test_results_do_not_move_with_the_session_time_zone(spark, settings):
    log = events(spark, dict(ts=str(NOON + 796)))
    expected = rows_of(dims.dim_time(log)) + rows_of(facts.fact_songplays(log))
    for zone in ("America/New_York", "Asia/Kolkata"):
        settings(spark__sql__session__timeZone=zone)
        assert rows_of(dims.dim_time(log)) + rows_of(facts.fact_songplays(log)) == expected


def test_fact_keeps_milliseconds_and_bad_text_becomes_null(spark):
    log = events(spark, dict(ts=str(NOON + 796), userId="", length="long", sessionId="12.7"))
    row = facts.fact_songplays(log).first()
    assert row["start_time"] == datetime.datetime(2018, 11, 11, 12, 0, 0, 796000)
    assert row["start_time_key"] == 2018111112
    assert row["user_id"] is row["stream_duration"] is row["session_id"] is None


def test_namesakes_count_together_and_unknown_users_show_as_null(spark):
    log = events(spark, dict(userId="1"), dict(userId="2"), dict(userId="3", firstName="Bo"))
    plays = facts.fact_songplays(log)
    users = dims.dim_users(log)
    assert rows_of(marts.top_users(plays, users)) == [("Ann Lee", 2), ("Bo Lee", 1)]
    assert rows_of(marts.top_users(plays, users.where("user_id > 2"))) == [
        ("Bo Lee", 1),
        (None, 2),
    ]


def test_state_is_the_text_between_first_and_second_comma(spark):
    log = events(
        spark,
        dict(location="Lima, CA"),
        dict(location="New York, NY, USA"),
        dict(location="Nowhere"),
        dict(location=None),
    )
    found = marts.plays_per_state(facts.fact_songplays(log)).collect()
    assert {r["state"] for r in found} == {" CA", " NY", "", None}


def test_top_artist_ties_go_to_duration_then_name(spark):
    log = events(
        spark,
        dict(artist="b", length="2"),
        dict(artist="a", length="2"),
        dict(artist="c", length="1"),
        dict(artist="z", length=None, location="x, NV"),
    )
    assert rows_of(marts.top_artist_by_state(facts.fact_songplays(log))) == [
        (" CA", "a", 1, Decimal("2.0000")),
        (" NV", "z", 1, None),
    ]


def test_duplicate_and_unmatched_plays(spark):
    log = events(spark, {}, {}, dict(song="other"))
    assert [r["copies"] for r in profiling.duplicate_plays(log).collect()] == [2]
    songs = titles(spark, dict(artist_name="a", title="s", year="1", duration="1"))
    found = profiling.unmatched_plays(facts.fact_songplays(log), dims.dim_song_titles(songs))
    assert rows_of(found) == [(1, 1)]


def test_users_with_null_id_are_counted_only_by_the_real_check(spark):
    log = events(spark, dict(userId=None), {})
    assert profiling.null_user_count(log).first()[0] == 1


def test_no_timestamp_ends_a_build(spark):
    stamps = ["1541990217796", "1541990217796000", str(2**63 - 1), str(-(2**63)), "-1", None, "x"]
    log = spark.createDataFrame([(t, "NextSong") for t in stamps], "ts string, page string")
    from playmart.functions import calendar as cal

    stamp = cal.epoch_millis_to_timestamp("ts")
    found = log.select("ts", stamp.alias("at"), cal.time_key(stamp).alias("key")).collect()
    keys = {r["ts"]: r["key"] for r in found}
    assert keys == {t: {"1541990217796": 2018111202, "-1": 1969123123}.get(t) for t in stamps}
    from playmart.plans import dims

    assert dims.dim_time(log).where("timestamp_date is not null").count() == 2
