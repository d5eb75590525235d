from __future__ import annotations

import pytest

from playmart.schemas import STAGING_EVENTS, STAGING_SONGS
from playmart.sources import landing, objects


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_events_keep_numbers_as_text_and_missing_as_null(spark):
    line = '{"artist":"Ø \\"x\\"","length":233.89995,"ts":1541990217796,"song":null,"sessionId":7}'
    row = landing.parse_events(lines(spark, line)).first()
    assert row["artist"] == 'Ø "x"'
    assert row["length"] == "233.89995" and row["ts"] == "1541990217796"
    assert row["song"] is None and row["userId"] is None
    assert row.__fields__ == STAGING_EVENTS.columns


def test_long_numbers_keep_their_digits(spark):
    row = landing.parse_events(lines(spark, '{"length":12345678901234567890.123456789}')).first()
    assert row["length"] == "12345678901234567890.123456789"


def test_event_paths_may_be_nested(spark):
    paths = tuple("$.who.name" if p == "$.firstName" else p for p in landing.EVENT_PATHS)
    row = landing.parse_events(lines(spark, '{"who":{"name":"Ada"},"page":"Home"}'), paths).first()
    assert (row["firstName"], row["page"]) == ("Ada", "Home")
    with pytest.raises(ValueError):
        landing.parse_events(lines(spark, "{}"), paths[:-1])


def test_event_keys_are_case_sensitive_song_keys_are_not(spark):
    event = landing.parse_events(lines(spark, '{"FIRSTNAME":"a","firstName":"b"}')).first()
    assert event["firstName"] == "b"
    song = landing.parse_songs(
        lines(spark, '{"Artist_ID":"A1","TITLE":"t","year":0,"num_songs":1,"other":5}')
    ).first()
    assert (song["artist_id"], song["title"], song["year"], song["num_songs"]) == (
        "A1",
        "t",
        "0",
        "1",
    )
    assert song["song_id"] is None and song.__fields__ == STAGING_SONGS.columns


def test_bad_lines_are_listed_or_fail_the_load(spark):
    frame = lines(spark, '{"userId":1}', '{"userId":', "[1]", "   ", "7", '{"userId":2}')
    errors = {(r["line"], r["reason"]) for r in landing.load_errors(frame).collect()}
    assert errors == {
        ('{"userId":', "malformed JSON"),
        ("[1]", "not a JSON object"),
        ("7", "not a JSON object"),
    }
    kept = landing.parse_events(frame).collect()
    assert sorted(r["userId"] for r in kept) == ["1", "2"]
    with pytest.raises(Exception, match="bad line"):
        landing.parse_events(frame, on_error="fail").collect()
    with pytest.raises(ValueError):
        landing.parse_songs(frame, on_error="ignore")


def test_prefix_reads_nested_objects(spark, tmp_path):
    for folder, name, text in (
        ("A/A", "one.json", '{"a":1}\n{"a":2}\n\n'),
        ("A/B", "two.json", '{"a":3}\n'),
        ("A/B", "notes.txt", "not data\n"),
    ):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    counted = objects.objects_under(spark, str(tmp_path), "*.json").collect()
    assert sorted((r["file_path"].rsplit("/", 1)[1], r["line_count"]) for r in counted) == [
        ("one.json", 2),
        ("two.json", 1),
    ]
    narrowed = landing.read_lines(spark, str(tmp_path / "A" / "B"), "*.json")
    assert objects.json_lines_count(narrowed).first()["record_count"] == 1


def test_reconcile_counts_reports_a_shortfall(spark):
    three, two = spark.range(3), spark.range(2)
    found = objects.reconcile_counts({"x": (three, two), "y": (two, two), "z": (two.where("id<0"), two.where("id<0"))})
    assert [tuple(r) for r in found.orderBy("collection").collect()] == [
        ("x", 3, 2, False),
        ("y", 2, 2, True),
        ("z", 0, 0, True),
    ]


def test_number_text_lands_unchanged(spark):
    numbers = ["250.10", "1.0", "1e5", "-0", "12345678901234567890123456789012345678901.5", "7"]
    line = '{"a":"1 \\" 2,3","n":[1,{"x":2.50}],' + ",".join(f'"k{i}": {n}' for i, n in enumerate(numbers)) + "}"
    paths = tuple(f"$.k{i}" if i < len(numbers) else "$.n[1].x" if i == 8 else "$.a" for i in range(18))
    row = landing.parse_events(lines(spark, line), paths).first()
    assert list(row[: len(numbers)]) == numbers
    assert row[8] == "2.50" and row[9] == '1 " 2,3'
    text = "9" * 40_000
    long = landing.parse_events(lines(spark, '{"song":"' + text + '","ts":5}')).first()
    assert (long["song"], long["ts"]) == (text, "5")


@pytest.mark.parametrize(
    "line",
    ['{"a":1}{"a":2}', '{"a":1},{"a":2}', '{"a":1} trailing', '{"a":1}]', '{"a":1},"end of line"', '{"a":01}', '{"a":-}', '{"a":1.}'],
)
def test_nothing_is_lost_behind_an_object(spark, line):
    frame = lines(spark, line, '{"a":3}', "\t ")
    assert [r["line"] for r in landing.load_errors(frame).collect()] == [line]
    assert landing.parse_events(frame).count() == 1


def test_lines_are_parsed_once(spark):
    plan = landing.parse_events(lines(spark, '{"a":3}'))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1
