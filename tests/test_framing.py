"""Objects of whole files against a character-by-character telling, and what a landing reads."""

from __future__ import annotations

import json
import random

import pytest

from playmart.plans import warehouse
from playmart.sources import framing, landing
from tests.test_layout import write_sources


def told(text):
    """Records of a file whose brackets match: cut where the depth outside strings is 0 again."""
    out, depth, quoted, start, escaped = [], 0, False, 0, False
    for i, c in enumerate(text):
        if quoted:
            quoted = not (c == '"' and not escaped)
            escaped = c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
            if depth == 0:
                out.append(text[start : i + 1].strip())
                start = i + 1
    return [x for x in [*out, text[start:].strip()] if x]


def some_object(rng, depth=0):
    texts = ["", "a}b", '{"', "\\", '\\"', "x" * 40, "é", "]", "  "]
    made = {f"k{i}": rng.choice([rng.choice(texts), 1.50, -3, None, True]) for i in range(rng.randrange(4))}
    if depth < 5 and rng.random() < 0.5:
        made["in"] = some_object(rng, depth + 1)
    if rng.random() < 0.4:
        made["list"] = [some_object(rng, 5), [], [1, "]"]]
    return made


def found(spark, folder, **how):
    rows = framing.frame(framing.read_blocks(spark, str(folder)), **how).collect()
    out = {}
    for r in rows:
        out.setdefault(r["file_path"].rsplit("/", 1)[1], []).append(r["value"])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("block", ["128m", "64", "700"])
def test_frames_match_characters(spark, settings, tmp_path, block):
    settings(spark__sql__files__maxPartitionBytes=block, spark__sql__files__openCostInBytes="1")
    rng, expected = random.Random(3), {}
    for k in range(12):
        parts = []
        for _ in range(rng.randrange(1, 25)):
            style = dict(indent=rng.choice([0, 2, None])) if k % 3 else {}
            parts.append(json.dumps(some_object(rng), ensure_ascii=False, **style))
            parts.append("\n" if k % 3 == 0 else rng.choice(["\n", "", " ", "\n\n", "\t"]))
        text = "".join(parts)
        (tmp_path / f"f{k}").write_text(text)
        expected[f"f{k}"] = sorted(told(text))
    assert found(spark, tmp_path) == expected


def test_a_broken_object_does_not_take_the_others_along(spark, tmp_path):
    (tmp_path / "a").write_text('{"a":1}\n{"a":\n{"a":2}{"a":3}\n{\n "a": 4\n}\n[1]\nand more\n{"a":5} x\n')
    (tmp_path / "b").write_text('}\n{"b":1}\n{\n"b": [\n')
    (tmp_path / "c").write_text(' \n{"c": "no end}\n{"c":2}\n')
    (tmp_path / "d").write_text("\n\n")
    assert found(spark, tmp_path) == {
        "a": sorted(['{"a":1}', '{"a":', '{"a":2}', '{"a":3}', '{\n "a": 4\n}', "[1]", "and more", '{"a":5}', "x"]),
        "b": sorted(["}", '{"b":1}', '{\n"b": [']),
        "c": sorted(['{"c": "no end}', '{"c":2}']),
    }


def test_an_endless_object_is_refused_by_its_first_piece(spark, tmp_path):
    items = ",\n".join('{"x": 1}' for _ in range(400))
    (tmp_path / "a").write_text('{"list": [\n' + items + ']}\n{"ok":\n1}\n')
    got = found(spark, tmp_path, largest=1000)
    assert got == {"a": sorted(['{"list": [\n{"x": 1}'.split("\n")[0], '{"ok":\n1}'])}
    records = framing.frame(framing.read_blocks(spark, str(tmp_path)), largest=1000)
    assert [r["reason"] for r in landing.load_errors(records).collect()] == ["malformed JSON"]


def test_landing_reads_each_source_once(spark, tmp_path, monkeypatch):
    log, songs = write_sources(tmp_path, '{"page":\n{\n"page":\n"Home"}\n')
    reads = []
    plain = framing.read_blocks

    def counted(session, path, pattern=None):
        reads.append(path)
        return plain(session, path, pattern)

    monkeypatch.setattr(framing, "read_blocks", counted)
    root = str(tmp_path / "out")
    got = warehouse.land(spark, warehouse.Sources(log, songs, on_error="skip"), root)
    assert sorted(reads) == sorted([log, songs])
    # nothing but the written lines is read after that: the result survives the sources
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == [("staging_events", 6, 1, 5, True), ("staging_songs", 2, 0, 2, True)]
    plan = framing.frame(plain(spark, log))._jdf.queryExecution().optimizedPlan().toString()
    assert log not in plan


def test_too_long_text_is_refused_by_the_landing(spark, tmp_path):
    log, songs = write_sources(tmp_path, json.dumps({"level": "x" * 257}) + "\n")
    root = str(tmp_path / "out")
    warehouse.land(spark, warehouse.Sources(log, songs, on_error="skip"), root)
    assert [r["reason"] for r in spark.read.parquet(f"{root}/load_errors").collect()] == ["max length 256: level"]
    with pytest.raises(Exception, match="max length 256: level"):
        warehouse.land(spark, warehouse.Sources(log, songs), root)


def test_landing_fails_when_rows_are_lost(spark, tmp_path, monkeypatch):
    log, songs = write_sources(tmp_path)
    real = warehouse.versions.move

    def lossy(session, source, target):
        done = real(session, source, target)
        if target.endswith("/staging_events"):
            part = next(p for p in (tmp_path / "out" / "staging_events").iterdir() if p.suffix == ".parquet")
            part.unlink()
        return done

    monkeypatch.setattr(warehouse.versions, "move", lossy)
    with pytest.raises(RuntimeError, match="staging_events"):
        warehouse.land(spark, warehouse.Sources(log, songs, on_error="skip"), str(tmp_path / "out"))


def test_one_line_of_many_objects_is_read_by_many_tasks(spark, settings, tmp_path):
    settings(spark__sql__files__maxPartitionBytes="200000", spark__sql__files__openCostInBytes="1")
    rng = random.Random(5)
    texts = ['{"a":1}', "} and {", '\\"', "[{", "é", "\\"]
    made = [json.dumps({"k": k, "t": rng.choice(texts), "in": {"x": rng.choice(texts) * 9}}) for k in range(14_000)]
    text = " ".join(made)
    assert len(text) > 3 * framing.CHUNK and "\n" not in text
    (tmp_path / "a").write_text(text)
    blocks = framing.read_blocks(spark, str(tmp_path))
    assert blocks.rdd.getNumPartitions() > 3
    assert blocks.selectExpr("max(octet_length(value))").first()[0] < 1000
    assert found(spark, tmp_path) == {"a": sorted(made)}


@pytest.mark.parametrize("k", range(2))
def test_broken_files_are_cut_alike_in_blocks_of_any_size(spark, settings, tmp_path, k):
    rng = random.Random(k)
    parts = ['{"a":', '"b{"', "}", "\n", "\n{", "]", "[", '"', " x ", '{"ok":1}', "\r\n", '\n{"ok":2}\n', "{}", "\\\\"]
    for n in range(3):
        (tmp_path / f"f{n}").write_bytes("".join(rng.choice(parts) for _ in range(60)).encode())
    (tmp_path / "cut").write_bytes(b'{"a":1}\n{')
    whole = found(spark, tmp_path)
    assert whole["cut"] == ["{", '{"a":1}']
    settings(spark__sql__files__maxPartitionBytes="40", spark__sql__files__openCostInBytes="1")
    assert found(spark, tmp_path) == whole
