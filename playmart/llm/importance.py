"""Importance resampling towards a target distribution over hashed n-grams.

ASCII letters are lower-cased and every run of other ASCII characters than letters and digits
becomes one space. One overlapped regular expression per length, held at word boundaries by
lookarounds, then meets every run of 1 to ``widest`` words as one span; the CRC-32 of its bytes
modulo ``buckets`` is its bucket. Counting over all documents and all target texts gives each
bucket a gain, the floored thousandfold logarithm of how much more frequent it is in the
target, smoothed by one. A document's weight is the floored mean of its features' gains; with
a Gumbel number drawn from a hash of its id added, the highest scores are a sample without
replacement in proportion to the weights (Gumbel top-k).

Text is scanned once: the buckets are written, counted and then weighed. What reaches the
driver are ``buckets`` counts. Ranks come from a range-partitioned sort of four numbers a row and
the row counts of its files, so no task sees all rows.

A null or empty text has no features and weight 0. Rows that repeat a doc_id are documents of
their own; ties go to the smaller doc_id, then to fewer features, then to the lower weight,
and rows equal in all of these take consecutive ranks. A row without doc_id counts in the
statistics, but has no score, is not drawn and not among the documents the share is taken
of. Empty tables give an empty result or, as the target, gains against nothing. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators.layout import dense_key
from playmart.operators.workspace import cut

from .common import arrow_map, slices, texts

#: Gains and Gumbel numbers are whole thousandths of a natural logarithm.
SCALE = 1000
FEATURES = "doc_id long, n_words long, buckets array<int>"

_LOWER = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


@lru_cache(maxsize=32)
def run_of(n: int) -> regex.Pattern:
    """Runs of ``n`` words in a text whose separators are single spaces; found overlapped."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def collapsed(text: str) -> bytes:
    """Lower case, with one space for each run of separators and none at the ends."""
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(_LOWER).split())


def buckets_of(data: bytes, widest: int, buckets: int) -> np.ndarray:
    """The bucket of every run of 1 to ``widest`` words, repeats included."""
    crc, found = zlib.crc32, []
    for n in range(1, widest + 1):
        spans = run_of(n).finditer(data, overlapped=True)
        found += [crc(data[m.start() : m.end()]) for m in spans]
    return (np.array(found, np.uint32) % np.uint32(buckets)).astype(np.int32)


def _features(batches: Iterator[pa.RecordBatch], widest: int, buckets: int):
    for batch in slices(batches):
        plain = [collapsed(t) for t in texts(batch)]
        words = [p.count(b" ") + 1 if p else 0 for p in plain]
        found = [buckets_of(p, widest, buckets) for p in plain]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(words, pa.int64()), pa.array(found, pa.list_(pa.int32()))],
            names=["doc_id", "n_words", "buckets"],
        )


def _counts(batches: Iterator[pa.RecordBatch], buckets: int):
    """The task's count of each bucket it met."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        total += np.bincount(batch.column("buckets").flatten().to_numpy(zero_copy_only=False), minlength=buckets)
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met])], names=["bucket", "n"])


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of each bucket over all rows."""
    counted = arrow_map(features.select("buckets"), "bucket int, n long", _counts, buckets)
    out = np.zeros(buckets, np.int64)
    got = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # ``buckets`` rows at most
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of shares) per bucket."""
    n, all_own, all_target = len(own), float(own.sum()), float(target.sum())
    ratio = [(t + 1.0) * (all_own + n) / ((s + 1.0) * (all_target + n)) for s, t in zip(own.tolist(), target.tolist())]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def gumbel(doc_id: int, seed: int) -> int:
    """floor(-1000 ln(-ln u)) for the uniform number u that a hash of seed and id gives."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray, seed: int):
    for batch in batches:
        lists = batch.column("buckets")
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.concatenate(([0], np.cumsum(gain[lists.flatten().to_numpy(zero_copy_only=False)])))
        ends = np.cumsum(sizes)
        weights = np.floor_divide(sums[ends] - sums[ends - sizes], np.maximum(sizes, 1))
        ids = batch.column("doc_id").to_pylist()
        scores = [None if i is None else w + gumbel(i, seed) for i, w in zip(ids, weights.tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(sizes), pa.array(weights), pa.array(scores, pa.int64())],
            names=["doc_id", "n_words", "n_features", "weight", "score"],
        )


def resample(
    docs: DataFrame,
    target: DataFrame,
    widest: int = 2,
    buckets: int = 10_000,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
) -> DataFrame:
    """Every document with doc_id, n_features, weight, score and, if it is drawn, its rank."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    wanted = target.select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    features = cut(arrow_map(source, FEATURES, _features, widest, buckets), "features")
    theirs = arrow_map(wanted, FEATURES, _features, widest, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(theirs, buckets))
    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    scored = cut(arrow_map(features, schema, _weigh, gain, seed), "scored")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = scored.where(able).count() * percent // 100
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight")]
    sorted_rows = scored.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.col("place") + 1
    ranked = dense_key(sorted_rows, "place").withColumn("rank", F.when(place <= drawn, place))
    others = scored.where(~able).withColumn("rank", F.lit(None).cast("bigint"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(others.select(*columns))
