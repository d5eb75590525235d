"""Quality rules: counted base rules and a calibrated classifier over hashed n-grams.

The classifier is a logistic regression on relative frequencies of hashed words, pairs of words
and runs of three characters, trained on labelled rows. At most ``SAMPLE`` labelled rows are used,
those with the smallest hash of their doc_id, in the order of a hash of their text; a fifth of
them is held out to calibrate the probability. Everything else runs over all rows and whole texts, in Arrow batches.

A document is kept unless the base rules fail or its probability of being good lies under
``KEEP_AT``. A null text has no words and fails the base rules. Rows are independent:
repeated rows get equal results, null ids stay null, an empty table gives an empty result.
Without labels, or with one class only, the classifier keeps everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, hash_words, slices, texts, window_hashes
from .linear import Rows, fit, platt, sigmoid

#: Labelled rows used for training, at most.
SAMPLE = 4000
KEEP_AT = 0.5
#: Hashed features: so many bits for words, for pairs of words and for runs of three characters.
BITS = 17
KINDS = 3
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
MIN_WORDS, WINDOW, REPEAT_PERCENT = 50, 3, 50
#: Frequencies are small; this brings them into the range where the weights are.
SCALE = 20.0

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, p_good double"
)


def _word_slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _char_slots(text: str) -> np.ndarray:
    """Runs of three characters, whatever bytes they take."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    code = c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:]
    return (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


def slots_of(text: str, hashes: np.ndarray) -> list[np.ndarray]:
    """The slots of a text's features, one array per kind."""
    found = _word_slots(hashes), _word_slots(window_hashes(hashes, 2)), _char_slots(text)
    return [slots + (k << BITS) for k, slots in enumerate(found)]


def _mean_weight(weights: np.ndarray, slots: np.ndarray) -> float:
    return SCALE * float(weights[slots].mean()) if len(slots) else 0.0


def base_counts(text: str, data: bytes, hashes: np.ndarray) -> tuple[int, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    blanks = len(data) - len(data.translate(None, BLANKS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip(BLANKS)]
    windows = window_hashes(hashes, WINDOW)
    repeated = 0
    if len(windows):
        order = np.sort(windows)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        if len(twice):
            place = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
            hit = np.flatnonzero(twice[place] == windows)
            covered = np.zeros(len(hashes), bool)
            for i in range(WINDOW):
                covered[hit + i] = True
            repeated = int(covered.sum())
    return len(hashes), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated


def _features(batches: Iterator[pa.RecordBatch]):
    """Sparse training rows: slots and their scaled frequencies."""
    for batch in slices(batches):
        index, value = [], []
        for text in texts(batch):
            data = text.encode("utf-8", "surrogatepass")
            own_index, own_value = [], []
            for slots in slots_of(text, hash_words(data.split())):
                slot, count = np.unique(slots, return_counts=True)
                own_index.append(slot)
                own_value.append(SCALE * count / max(1, len(slots)))
            index.append(np.concatenate(own_index))
            value.append(np.concatenate(own_value))
        yield pa.RecordBatch.from_arrays(
            [batch.column("y").cast(pa.int32()), batch.column("at"), pa.array(index, pa.list_(pa.int64())), pa.array(value, pa.list_(pa.float64()))],
            names=["y", "at", "slots", "freqs"],
        )


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], n: int) -> DataFrame:
    """``n`` labelled rows at most, by the smallest hash of doc_id, with their texts."""
    picked = labels.where(F.col("doc_id").isNotNull()).select("doc_id", *columns).dropna()
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id", *columns).limit(n)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # n rows at most


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Weights of all slots, the bias and the calibration."""
    rows = labelled_sample(docs, labels, ["quality"], sample).select("text", F.xxhash64("text").alias("at"), F.col("quality").alias("y"))
    got = arrow_map(rows, "y int, at long, slots array<long>, freqs array<double>", _features)
    # a doc_id that documents repeat brings several rows: the bound holds after the join as well
    got = got.orderBy("at", "y").limit(sample).toArrow()
    width = KINDS << BITS
    if not got.num_rows:
        return {"weights": np.zeros(width, np.float32), "bias": 8.0, "a": 1.0, "b": 0.0}
    y = got["y"].to_numpy().astype(float)
    slots, freqs = (got[c].combine_chunks() for c in ("slots", "freqs"))
    del got  # what is not needed any more goes at once: the sample is the driver's largest piece of memory
    bounds = np.concatenate(([0], np.cumsum(slots.value_lengths().to_numpy())))
    index, values = slots.flatten().to_numpy(), freqs.flatten().to_numpy()
    seen = np.zeros(width, bool)
    seen[index] = True
    used, index = np.flatnonzero(seen), (np.cumsum(seen) - 1)[index]
    del slots
    x = Rows(index, values, bounds, len(used))
    held = np.arange(len(y)) % 5 == 4
    learned, other = x.take(~held), x.take(held)
    del x, index, values, freqs
    none = np.zeros((len(y), 0))
    w = fit(learned, none[~held], y[~held], l2=1e-5)
    a, b = platt(other.dot(w[:-1]) + w[-1], y[held])
    weights = np.zeros(width, np.float32)
    weights[used] = w[:-1]
    return {"weights": weights, "bias": float(w[-1]), "a": a, "b": b}


def _score(batches: Iterator[pa.RecordBatch], model: dict, keep_at: float):
    weights = model["weights"]
    for batch in slices(batches):
        rows = []
        for text in texts(batch):
            data = text.encode("utf-8", "surrogatepass")
            hashes = hash_words(data.split())
            counts = base_counts(text, data, hashes)
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > REPEAT_PERCENT * counts[0]
            z = model["bias"] + sum(_mean_weight(weights, slots) for slots in slots_of(text, hashes))
            p = float(sigmoid(model["a"] * z + model["b"]))
            rows.append((*counts, failed, not failed and p >= keep_at, p))
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)


def score(docs: DataFrame, model: dict, keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: base counts, base_failed, kept and the probability of being good."""
    return arrow_map(docs.select("doc_id", "text"), SCHEMA, _score, model, keep_at)
