"""Importance resampling, the factorisation machine and whitening against plain tellings."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from playmart.llm import factorisation, importance, queries, whitening

SF_DIR = "/root/testdata/sf0.001"
LONG = "word " * 30_000
AWKWARD = [(1, None), (2, ""), (3, "\n \n"), (4, "one"), (4, "one"), (None, "no id here"), (5, LONG), (6, "ß é 日本 🙂")]


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    made = [(i, t, len(t or ""), "x", 3, 0.5) for i, t in rows]
    return spark.createDataFrame(made, "doc_id long, text string, n_chars long, buckets string, y int, score double").repartition(3)


def told(documents, target):
    """The contract of the query, row by row; (doc_id, text) pairs in."""

    def features(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        pairs = [" ".join(words[i : i + 2]) for i in range(len(words) - 1)]
        return [zlib.crc32(f.encode()) % 10_000 for f in words + pairs], len(words)

    own, theirs = Counter(), Counter()
    for _, text in documents:
        own.update(features(text)[0])
    for text in target:
        theirs.update(features(text)[0])
    n_own, n_theirs = sum(own.values()), sum(theirs.values())
    gain = {}
    for b in own:
        gain[b] = math.floor(1000 * math.log((theirs[b] + 1) * (n_own + 10_000) / ((own[b] + 1) * (n_theirs + 10_000))))
    rows, able = [], []
    for doc_id, text in documents:
        found, n_words = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n_words >= 20:
                able.append((-score, doc_id, len(found), weight))
        rows.append((doc_id, len(found), weight, score))
    drawn = sorted(able)[: 25 * len(able) // 100]
    rank = {(d, n, w, -s): k + 1 for k, (s, d, n, w) in enumerate(drawn)}
    return Counter((*row, rank.get(row)) for row in rows)


def importance_rows(df):
    return Counter(tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect())


def test_importance_matches_contract(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect()]
    assert importance_rows(queries.op11_importance(spark, SF_DIR)) == told(docs, target)


def test_importance_awkward(spark):
    rows = AWKWARD + [(k, f"A{k}-b\x00C " * 30 + "é" * k) for k in range(10, 30)]
    target = [(1, "a b c word"), (2, None), (3, "")]
    bench = spark.createDataFrame(target, "item_id long, text string")
    docs = docs_of(spark, rows)
    assert importance_rows(importance.resample(docs, bench)) == told(rows, [t for _, t in target])
    assert importance_rows(importance.resample(docs, bench.limit(0))) == told(rows, [])
    assert importance.resample(docs.limit(0), bench).count() == 0
    few = importance.resample(docs, bench, widest=3, buckets=50, percent=100, least_words=1, seed=1)
    ranks = sorted(r["rank"] for r in few.where("rank is not null").collect())
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == 24


def test_importance_is_free_of_partitions(spark, settings):
    settings(spark__sql__shuffle__partitions="37", spark__sql__adaptive__enabled="false")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert importance_rows(importance.resample(docs.repartition(11), bench)) == importance_rows(importance.resample(docs, bench))


def test_machine_counts_all_pairs():
    """The linear form equals the sum over all pairs of inputs."""
    rng = np.random.default_rng(1)
    width = factorisation.SLOTS + 3
    model = {"w": rng.normal(size=width), "v": rng.normal(size=(width, factorisation.RANK)), "bias": 0.3}
    slots, dense = [np.array([3, 9, 4000], np.int32), np.array([], np.int32)], rng.normal(size=(2, 3))
    z, _ = factorisation.raw_scores(model, factorisation.Rows(slots, dense))
    for row in range(2):
        x = np.zeros(width)
        x[slots[row]] = 1 / np.sqrt(max(1, len(slots[row])))
        x[factorisation.SLOTS :] = dense[row]
        used = np.flatnonzero(x)
        pairs = sum(model["v"][i] @ model["v"][j] * x[i] * x[j] for i in used for j in used if i < j)
        assert z[row] == pytest.approx(0.3 + model["w"] @ x + pairs)


def test_machine_gradient():
    rng = np.random.default_rng(2)
    width = factorisation.SLOTS + 2
    model = {"w": rng.normal(size=width) / 9, "v": rng.normal(size=(width, factorisation.RANK)) / 9, "bias": 0.1}
    rows = factorisation.Rows([np.array([1, 5], np.int32), np.array([5], np.int32)], rng.normal(size=(2, 2)))
    y = np.array([1.0, 0.0])

    def loss():
        z, _ = factorisation.raw_scores(model, rows)
        return float((np.logaddexp(0, z) - y * z).mean())

    g, h, b = factorisation._gradient(model, rows, y)
    for name, at, own in (("w", 5, g[5]), ("w", width - 1, g[-1]), ("v", (5, 2), h[5, 2]), ("v", (width - 1, 0), h[-1, 0])):
        before = model[name][at]
        model[name][at] = before + 1e-6
        up = loss()
        model[name][at] = before - 1e-6
        assert (up - loss()) / 2e-6 == pytest.approx(own, abs=1e-6)
        model[name][at] = before


def test_machine_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = queries.op12_factorisation(spark, sf_dir)
    assert scored.count() == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored.collect())
    held = scored.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in held)
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    above = np.mean([[g > b for b in bad] for g in good])
    assert above >= 0.98
    # rows held out, row order and partitions leave the model as it is
    learned = labels.where(factorisation.in_training(labels["doc_id"]))
    again = factorisation.train(docs.repartition(7), learned.repartition(5).unionByName(labels.limit(0)))
    first = factorisation.train(docs, labels)
    assert all(np.array_equal(first[k], again[k]) for k in first)


def test_machine_scores_do_not_depend_on_the_batch():
    """A row's score is the same number alone, in a small batch and in a large one."""
    rng = np.random.default_rng(8)
    width = len(factorisation.STATISTICS) + 1
    slots = [np.unique(rng.integers(0, factorisation.SLOTS, rng.integers(0, 60))).astype(np.int32) for _ in range(400)]
    dense = rng.normal(size=(400, width))
    model = {"w": rng.normal(size=factorisation.SLOTS + width), "bias": 0.1}
    model["v"] = rng.normal(0, 0.1, (factorisation.SLOTS + width, factorisation.RANK))
    every = factorisation.raw_scores(model, factorisation.Rows(slots, dense))[0]
    for size in (1, 2, 7, 64):
        parts = [factorisation.Rows(slots[k : k + size], dense[k : k + size]) for k in range(0, 400, size)]
        assert np.array_equal(every, np.concatenate([factorisation.raw_scores(model, rows)[0] for rows in parts]))


def test_machine_awkward(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    train_docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs_of(spark, AWKWARD)
    model = factorisation.train(train_docs, labels)
    found = factorisation.score(docs, model).collect()
    assert len(found) == len(AWKWARD)
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [None]
    assert len({r["score"] for r in found if r["doc_id"] == 4}) == 1
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert factorisation.score(docs.limit(0), model).count() == 0
    for some, expected in ((labels.limit(0), 0.5), (labels.where("quality = 1"), None)):
        got = factorisation.score(docs, factorisation.train(train_docs, some)).collect()
        assert len({r["score"] for r in got}) == 1 and (expected is None or got[0]["score"] == expected)
    own = spark.createDataFrame([(k, k % 2) for k in range(8)], "doc_id long, quality int")
    assert factorisation.score(docs, factorisation.train(docs, own)).count() == len(AWKWARD)


def whitened_by_hand(vectors, weights="one", components=4):
    """(n, deviations, whitened, explained) of quantised rows."""
    x = np.array([[math.floor(256 * c) for c in v] for v in vectors], np.int64)
    distinct, copies = np.unique(x, axis=0, return_counts=True)
    w = copies if weights == "count" else np.ones(len(distinct), np.int64)
    n, sums = int(w.sum()), (w[:, None] * distinct).sum(axis=0)
    centred = distinct - sums / n
    v = (centred * w[:, None]).T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ q / np.sqrt(e), e / np.trace(v)


def check_whitened(df, ids, vectors, weights="one"):
    n, deviation, white, explained = whitened_by_hand(vectors, weights)
    rows = df.collect()
    assert len(rows) == 4 * len(ids) and {r["n"] for r in rows} == {n}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    place = {i: k for k, i in enumerate(ids)}
    signs = {}
    for r in rows:
        k, c = place[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == deviation[k]
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        sign = signs.setdefault(c, 1 if abs(white[k, c] - r["whitened"]) < abs(white[k, c] + r["whitened"]) else -1)
        assert sign * r["whitened"] == pytest.approx(white[k, c], abs=1e-6)


def test_whitening_of_the_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    check_whitened(queries.op13_whitening(spark, SF_DIR), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


SCHEMA = "vec_id long, embedding array<float>, name string, weight int, x int"


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_of_copies(spark, weights):
    rng = np.random.default_rng(5)
    vectors = [[float(c) for c in rng.normal(size=6).astype(np.float32)] for _ in range(40)]
    vectors += [vectors[0]] * 300 + [[c + 1e-7 for c in vectors[1]]]
    made = [(k, v, "a", 1, 2) for k, v in enumerate(vectors)]
    inf, nan = float("inf"), float("nan")
    bad = [(900, None, "a", 1, 2), (901, [1.0, None] + [0.0] * 4, "a", 1, 2), (902, [nan] * 6, "a", 1, 2), (903, [-inf] + [0.0] * 5, "a", 1, 2)]
    df = spark.createDataFrame(made + bad, SCHEMA).repartition(5)
    check_whitened(whitening.whiten(df, weights=weights), list(range(len(vectors))), vectors, weights)


def test_whitening_awkward(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame([(i, v, "a", 1, 2) for i, v in rows], SCHEMA)).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [])]) == []
    lone = run([(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25])])
    assert len(lone) == 6 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in lone)
    # a constant dimension and a short vector
    rows = run([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [3.0])])
    first = sorted((r["vec_id"], round(abs(r["whitened"]), 6)) for r in rows if r["component"] == 1)
    assert first == [(1, 1.224745), (2, 0.0), (3, 1.224745)]
    assert all(r["whitened"] is None for r in rows if r["component"] == 2)
    huge = run([(1, [3e30, 0.0]), (2, [-3e30, 1.0]), (3, [0.0, 2.0])])
    assert len(huge) == 6 and all(r["deviation"] is None for r in huge if r["vec_id"] != 3)
