"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata.

The score of a text is ``sigmoid(a * z + b)`` with ``z = bias + sum w_i x_i + sum over pairs i < j
of <v_i, v_j> x_i x_j``. The pairs are never spelled out: per factor they are half of the square
of the sum less the sum of the squares, so a text costs its distinct words times ``RANK``.

Inputs: the distinct words in lower case, hashed into ``SLOTS`` slots and scaled so that a
text's words have length one; the ``STATISTICS`` of the text; and numeric metadata columns
(``metadata``, here n_chars). Statistics and metadata are standardised by the training rows.
Labels, lang, source and ids are never inputs. ``train`` learns from at most ``sample``
labelled rows, those with the smallest hash of their doc_id, in the order of a hash of their
text, so neither row order nor partitions change the model; a fifth of them is kept from the
weights and calibrates the probability. Everything else covers all rows and whole texts.

A null or empty text has no words and all statistics 0; a null or non-finite metadata value
counts as the training mean. Rows are independent: repeated rows get equal scores, null ids
stay (their ``held_out`` is null), an empty table gives an empty result, other columns are not
read. A text under several labels counts once per label. Without labels the score is 0.5;
with one class only it is that class's constant.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, hash_words, slices, texts
from .linear import platt, sigmoid

#: Labelled rows used for training, at most.
SAMPLE = 6000
SLOTS, RANK = 1 << 13, 8
STEPS, BATCH, RATE = 200, 256, 0.02
L2_LINEAR, L2_FACTORS = 1e-5, 1e-4
#: Rows of every so many are kept for the calibration.
HELD = 5
SEED = 20
PREDICT_AT = 0.5

STATISTICS = (
    "log_chars log_words word_length upper digits symbols marks beyond_ascii distinct_words commonest_word"
    " same_as_before distinct_pairs repeated_lines words_per_line line_ends"
).split()

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>@^~=+_\\/{}[]"
_MARKS = b".,;:!?'\"()-"
_BEYOND = bytes(range(128, 256))
_STRIPPED = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in bytes(range(256)).lower())


def statistics(data: bytes, words: list[bytes]) -> list[float]:
    """The structure of a text, in the order of ``STATISTICS``."""
    if not words:
        return [0.0] * len(STATISTICS)
    size, n = len(data), len(words)

    def share(chars: bytes) -> float:
        return (size - len(data.translate(None, chars))) / size

    lines = [x for x in data.split(b"\n") if x.strip()]
    counts = Counter(words)
    return [
        np.log1p(size),
        np.log1p(n),
        sum(map(len, words)) / n,
        share(_UPPER),
        share(_DIGITS),
        share(_SYMBOLS),
        share(_MARKS),
        share(_BEYOND),
        len(counts) / n,
        max(counts.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / n,
        1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines),
    ]


def inputs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word slots, statistics) of a text."""
    data = text.encode("utf-8", "surrogatepass")
    plain = set(data.translate(_STRIPPED).split())
    slots = np.unique(hash_words(list(plain)) % np.uint64(SLOTS)).astype(np.int32)
    return slots, np.array(statistics(data, data.split()))


def _features(batches: Iterator[pa.RecordBatch], metadata: list[str]):
    for batch in slices(batches):
        got = [inputs(t) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("y").cast(pa.int32()),
                batch.column("at").cast(pa.int64()),
                pa.array([s for s, _ in got], pa.list_(pa.int32())),
                pa.array(list(np.hstack((np.array([x for _, x in got]), _columns(batch, metadata)))), pa.list_(pa.float64())),
            ],
            names=["y", "at", "slots", "dense"],
        )


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Metadata values on a log scale, null as NaN."""
    out = np.empty((batch.num_rows, len(names)))
    for k, name in enumerate(names):
        value = batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
        out[:, k] = np.sign(value) * np.log1p(np.abs(value))
    return out


class Rows:
    """Sparse rows in one flat run: slots with equal weight per row, and dense values."""

    def __init__(self, slots: list[np.ndarray], dense: np.ndarray):
        sizes = np.array([len(s) for s in slots], np.int64)
        self.slots = np.concatenate([*slots, np.empty(0, np.int32)]).astype(np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(sizes)))
        self.weight = 1 / np.sqrt(np.maximum(sizes, 1))
        self.dense = dense

    def __len__(self) -> int:
        return len(self.weight)

    def take(self, rows: np.ndarray) -> "Rows":
        return Rows([self.slots[self.bounds[i] : self.bounds[i + 1]] for i in rows], self.dense[rows])

    def word_sums(self, table: np.ndarray) -> np.ndarray:
        """Sum of the table's rows over each row's slots."""
        out, full = np.zeros((len(self), table.shape[1])), np.diff(self.bounds) > 0
        if full.any():
            out[full] = np.add.reduceat(table[self.slots], self.bounds[:-1][full], axis=0)
        return out


def _products(dense: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``dense @ table``, summed in the same order whatever the number of rows, so that equal rows get equal sums."""
    out = np.zeros((len(dense), table.shape[1]))
    for k in range(dense.shape[1]):
        out += dense[:, k, None] * table[k]
    return out


def raw_scores(model: dict, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """(z, factor sums) of rows, in time linear in their inputs."""
    scale = rows.weight[:, None]
    linear = rows.word_sums(model["w"][:SLOTS, None])[:, 0] * rows.weight
    linear += _products(rows.dense, model["w"][SLOTS:, None])[:, 0]
    v = model["v"]
    sums = rows.word_sums(v[:SLOTS]) * scale + _products(rows.dense, v[SLOTS:])
    squares = rows.word_sums(v[:SLOTS] ** 2) * scale**2 + _products(rows.dense**2, v[SLOTS:] ** 2)
    return model["bias"] + linear + 0.5 * _products(sums**2 - squares, np.ones((v.shape[1], 1)))[:, 0], sums


def _gradient(model: dict, rows: Rows, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    z, sums = raw_scores(model, rows)
    r = (sigmoid(z) - y) / len(y)
    row = np.repeat(np.arange(len(rows)), np.diff(rows.bounds))
    x = rows.weight[row]
    g = np.zeros_like(model["w"])
    g[:SLOTS] = np.bincount(rows.slots, x * r[row], SLOTS)
    g[SLOTS:] = rows.dense.T @ r
    h = np.empty_like(model["v"])
    squares = np.bincount(rows.slots, x * x * r[row], SLOTS)
    for f in range(h.shape[1]):
        h[:SLOTS, f] = np.bincount(rows.slots, x * (r * sums[:, f])[row], SLOTS)
    h[:SLOTS] -= model["v"][:SLOTS] * squares[:, None]
    h[SLOTS:] = rows.dense.T @ (r[:, None] * sums) - model["v"][SLOTS:] * (rows.dense**2).T.dot(r)[:, None]
    return g, h, float(r.sum())


def fit(rows: Rows, y: np.ndarray) -> dict:
    """Weights and factors by mini-batches with per-weight steps; the same for the same rows."""
    rng = np.random.default_rng(SEED)
    width = SLOTS + rows.dense.shape[1]
    model = {"w": np.zeros(width), "v": rng.normal(0, 0.05, (width, RANK)), "bias": float(np.log(y.mean() / (1 - y.mean())))}
    first, second = ([np.zeros(width), np.zeros((width, RANK)), 0.0] for _ in range(2))
    order = np.concatenate([rng.permutation(len(y)) for _ in range(-(-STEPS * BATCH // len(y)))])
    for t in range(1, STEPS + 1):
        own = order[(t - 1) * BATCH : t * BATCH]
        g, h, b = _gradient(model, rows.take(own), y[own])
        rate = RATE * (1 - t / (STEPS + 1))
        for k, (name, grad) in enumerate((("w", g + L2_LINEAR * model["w"]), ("v", h + L2_FACTORS * model["v"]), ("bias", b))):
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad * grad
            step = (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
            model[name] = model[name] - rate * step
    return model


def _standardise(dense: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Centred and scaled, drawn in to at most 3; a missing value is the mean."""
    return np.clip(np.nan_to_num((dense - mean) / spread, nan=0.0, posinf=3.0, neginf=-3.0), -3, 3) / 3


def in_training(doc_id: Column) -> Column:
    """Rows that labels may be learned from; ``held_out`` is the rest."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = ("n_chars",), sample: int = SAMPLE) -> dict:
    """The calibrated machine, fitted on the driver from ``sample`` rows at most."""
    picked = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    picked = picked.where(in_training(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    rows = docs.select("doc_id", "text", *metadata).join(F.broadcast(picked), "doc_id")  # ``sample`` rows at most
    rows = rows.select("y", F.xxhash64("text").alias("at"), "text", *metadata)
    got = arrow_map(rows, "y int, at long, slots array<int>, dense array<double>", _features, list(metadata))
    # a doc_id that documents repeat brings several rows: the bound holds after the join as well
    got = got.orderBy("at", "y", "dense").limit(sample).toArrow()
    y = got["y"].to_numpy().astype(float)
    width = len(STATISTICS) + len(metadata)
    if not 0 < y.sum() < len(y):
        bias = 0.0 if not len(y) else 8.0 if y[0] else -8.0
        constant = {"w": np.zeros(SLOTS + width), "v": np.zeros((SLOTS + width, RANK)), "bias": bias, "a": 1.0, "b": 0.0}
        return constant | {"mean": np.zeros(width), "spread": np.ones(width), "metadata": list(metadata)}
    dense = np.array(got["dense"].to_pylist(), float)
    dense[~np.isfinite(dense)] = np.nan
    known = np.isfinite(dense).any(axis=0)
    mean, spread = np.zeros(width), np.ones(width)
    mean[known] = np.nanmean(dense[:, known], axis=0)
    spread[known] = np.maximum(np.nanstd(dense[:, known], axis=0), 1e-6)
    every = Rows([np.asarray(s, np.int32) for s in got["slots"].to_pylist()], _standardise(dense, mean, spread))
    held = np.arange(len(y)) % HELD == HELD - 1
    inside = np.flatnonzero(~held)
    if not 0 < y[inside].sum() < len(inside):
        inside, held = np.arange(len(y)), np.ones(len(y), bool)
    model = fit(every.take(inside), y[inside])
    model["a"], model["b"] = platt(raw_scores(model, every.take(np.flatnonzero(held)))[0], y[held])
    return model | {"mean": mean, "spread": spread, "metadata": list(metadata)}


def probabilities(model: dict, got: list[tuple[np.ndarray, np.ndarray]], metadata: np.ndarray) -> np.ndarray:
    dense = _standardise(np.hstack((np.array([x for _, x in got]), metadata)), model["mean"], model["spread"])
    z, _ = raw_scores(model, Rows([s for s, _ in got], dense))
    return sigmoid(model["a"] * z + model["b"])


def _score(batches: Iterator[pa.RecordBatch], model: dict, at: float):
    for batch in slices(batches):
        p = probabilities(model, [inputs(t) for t in texts(batch)], _columns(batch, model["metadata"]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(p), pa.array((p >= at).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )


def score(docs: DataFrame, model: dict, at: float = PREDICT_AT) -> DataFrame:
    """One row per document: doc_id, held_out, score from 0 to 1, predicted."""
    rows = docs.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "text", *model["metadata"])
    return arrow_map(rows, "doc_id long, held_out boolean, score double, predicted int", _score, model, at)
