"""Toxicity by a classifier chain.

The categories are predicted one after another, here ``poor`` (quality 0) and ``toxic``; each
model sees the words and the probabilities of the categories before it. For training those
probabilities are out of fold, so that a later model does not trust an earlier one more
than it may at scoring time.

Words are maximal runs of letters in lower case (ASCII letters, and all characters beyond
ASCII), taken as present or absent under a 64-bit hash, so the length of a text does not
dilute one insult. Languages that inflect spread one insult over many endings, each too rare to be
learnt, so a beginning of ``STEM`` letters that two of a text's words share is a feature as well, and
one that three share another. At most ``SAMPLE`` labelled rows are used, those with the smallest hash
of their doc_id; for each category the ``FEATURES`` words that tell it apart best, by at least ``LEAST_Z``, and
occur in ``MIN_SHARE`` of the sample are picked in Spark. Scoring covers every row and whole texts.

A null text has no words and gets the base rate. Rows are independent: repeated rows get
equal results, null ids stay null, an empty table gives an empty result. Without labels, or
with one class only, a category is constant.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, hash_words, slices, texts
from .linear import Rows, fit, sigmoid
from .quality import labelled_sample

SAMPLE = 8000
FEATURES = 300
#: Standardised log odds a word must reach; fewer would be chance among so many words.
LEAST_Z = 3.0
MIN_SHARE, MIN_ROWS = 0.004, 4
FOLDS = 3
L2 = 5e-5
#: Letters of a word's beginning; a word must be longer to have one.
STEM = 5
REJECT_AT = 0.3


def categories() -> dict[str, Column]:
    """The chain, in order, from the label columns."""
    return {"poor": (F.col("quality") == 0).cast("int"), "toxic": F.col("toxic").cast("int")}


_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in bytes(range(256)).lower())


def words(text: str) -> np.ndarray:
    """Distinct hashed words of a text, and beginnings that two, or three and more of them share."""
    own = set(text.encode("utf-8", "surrogatepass").translate(_LETTERS).split())
    longer = b" ".join(own).decode("utf-8", "surrogatepass").split(" ")
    shared = Counter(w[:STEM] for w in longer if len(w) > STEM)
    stems = [b" %d %s" % (k, s.encode("utf-8", "surrogatepass")) for s, n in shared.items() for k in (2, 3) if n >= k]
    return np.unique(hash_words([*own, *stems]))


def _word_sets(batches: Iterator[pa.RecordBatch], names: list[str]):
    for batch in slices(batches):
        sets = [words(t) for t in texts(batch)]
        sets = pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*(batch.column(n).cast(pa.int32()) for n in names), sets], names=[*names, "words"])


def _picked(sample: DataFrame, names: list[str], n: int) -> np.ndarray:
    """Hashes of the words with the largest standardised log odds for some category."""
    total = sample.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names]).first()
    counted = sample.select(*names, F.explode("words").alias("word"))
    counted = counted.groupBy("word").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names])
    counted = counted.where(F.col("n") >= max(MIN_ROWS, MIN_SHARE * total["n"]))
    keep: set[int] = set()
    for c in names:
        inside, outside = F.col(c) + 0.5, F.col("n") - F.col(c) + 0.5
        all_in, all_out = (total[c] or 0) + 1.0, total["n"] - (total[c] or 0) + 1.0
        odds = F.log(inside / all_in) - F.log(outside / all_out)
        z = F.abs(odds / F.sqrt(1 / inside + 1 / outside))
        best = counted.where(z >= LEAST_Z).orderBy(F.desc(z), "word").limit(n)
        keep.update(r[0] for r in best.select("word").collect())  # n rows at most
    return np.sort(np.array(sorted(keep), np.int64).astype(np.uint64))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> dict:
    """The picked words and one weight vector per category: words, earlier categories, bias."""
    chain = categories()
    names = list(chain)
    # one row per distinct text: copies of one document must not vote many times
    rows = labelled_sample(docs, labels, ["quality", "toxic"], sample)
    rows = rows.select("text", *[e.alias(c) for c, e in chain.items()])
    schema = ", ".join(f"{c} int" for c in names) + ", words array<long>"
    sets = arrow_map(rows, schema, _word_sets, names).dropDuplicates(["words"])
    # a doc_id that documents repeat brings several rows: the bound holds after the join as well
    sets = sets.orderBy(F.xxhash64("words"), *names).limit(sample)
    sets = sets.withColumn("fold", F.pmod(F.xxhash64("words"), F.lit(FOLDS)).cast("int")).persist()
    known = _picked(sets, names, features)
    picked = [_picked(sets.where(F.col("fold") != k), names, features) for k in range(FOLDS)]
    every = np.unique(np.concatenate((known, *picked)))
    place = F.array_intersect("words", F.lit(every.astype(np.int64).tolist()).cast("array<long>"))
    got = sets.select(*names, "fold", place.alias("words")).orderBy(F.xxhash64("words"), *names).toArrow()
    sets.unpersist()
    lists = got["words"].combine_chunks()
    index = np.searchsorted(every, lists.flatten().to_numpy().astype(np.uint64))
    bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
    x = Rows(index, np.ones(len(index)), bounds, len(every))
    parts = [x.only(np.isin(every, own)) for own in picked]
    x = x.only(np.isin(every, known))
    folds = got["fold"].to_numpy()
    earlier, weights = np.zeros((len(x), 0)), []
    kept = np.isin(every, known)
    for c in names:
        y = got[c].to_numpy().astype(float)
        unseen = np.zeros(len(x))
        for k, own in enumerate(parts):
            inside, out = folds != k, folds == k
            if out.any() and inside.any():
                w = fit(own.take(inside), earlier[inside], y[inside], l2=L2)
                unseen[out] = sigmoid(own.take(out).dot(w[: x.width]) + earlier[out] @ w[x.width : -1] + w[-1])
        if not len(x):
            weights.append(np.array([-8.0]))
            continue
        w = fit(x, earlier, y, l2=L2)
        weights.append(np.concatenate((w[: x.width][kept], w[x.width :])))
        earlier = np.column_stack((earlier, unseen))
    return {"names": names, "known": known, "weights": weights}


def probabilities(model: dict, sets: list[np.ndarray]) -> np.ndarray:
    """One row per word set, one column per category."""
    known, out = model["known"], np.zeros((len(sets), len(model["names"])))
    for i, own in enumerate(sets):
        place = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
        hit = place[known[place] == own] if len(known) else np.zeros(0, np.int64)
        for c, w in enumerate(model["weights"]):
            out[i, c] = sigmoid(w[hit].sum() + out[i, : len(w) - len(known) - 1] @ w[len(known) : -1] + w[-1])
    return out


def _rejected(model: dict, batch: pa.RecordBatch, at: float) -> tuple[np.ndarray, np.ndarray]:
    p = probabilities(model, [words(t) for t in texts(batch)])
    return p, p[:, model["names"].index("toxic")] >= at


def _score(batches: Iterator[pa.RecordBatch], model: dict, at: float):
    for batch in slices(batches):
        p, rejected = _rejected(model, batch, at)
        columns = [pa.array(p[:, c]) for c in range(p.shape[1])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), *columns, pa.array(rejected)],
            names=["doc_id", *(f"p_{c}" for c in model["names"]), "rejected"],
        )


def score(docs: DataFrame, model: dict, reject_at: float = REJECT_AT) -> DataFrame:
    """One row per document: doc_id, a probability per category, rejected."""
    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in model["names"]) + ", rejected boolean"
    return arrow_map(docs.select("doc_id", "text"), schema, _score, model, reject_at)


def _filter(batches: Iterator[pa.RecordBatch], model: dict, at: float):
    for batch in slices(batches):
        yield batch.filter(pa.array(~_rejected(model, batch, at)[1]))


def keep_clean(docs: DataFrame, model: dict, reject_at: float = REJECT_AT) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    return arrow_map(docs, docs.schema, _filter, model, reject_at)
