"""Embedding whitening with a weighted multiplicity covariance.

Entries are quantised to whole numbers, ``x = floor(scale * c)``, so that equal vectors are
exactly equal. Identical x vectors are grouped, and all arithmetic is done once per distinct
vector: its fit weight is its number of rows (``weights="count"``) or one (``"one"``). The mean
comes from exact integer sums; the covariance is a weighted, centred matrix product, added up
task by task; the eigenvectors of that dim x dim matrix are found on the driver. Each distinct
vector is whitened once, and the results are joined back to the rows by the SHA-256 of x, with
the join split where one vector holds many rows.

A row is dropped if its vector is null or holds a null or non-finite entry. Shorter vectors
count as filled up with zeros, an empty one included. Repeated rows and null ids keep their
rows. Components whose eigenvalue is not above 1e-12 of the largest have no whitened value
(null) and take no part in ``identity_error``; with a trace of 0 ``explained`` is null. A deviation
beyond 64 bits is null. Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.operators.grouping import attach, n_rows
from playmart.operators.workspace import cut

from .common import arrow_map

#: Bytes of vectors a task multiplies at once.
SLICE_BYTES = 8 << 20
#: Eigenvalues at or below this share of the largest count as 0.
NEGLIGIBLE = 1e-12


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * entry) as longs; null where the vector or an entry is not a finite number."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint")))


def name_of(x: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", F.transform(x, lambda c: c.cast("string"))), 256))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A batch of lists as rows of ``dim`` entries, short ones filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), flat.dtype)
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - (ends - sizes)[row]] = flat
    return out


def _parts(batch: pa.RecordBatch, dim: int) -> Iterator[pa.RecordBatch]:
    step = max(1, SLICE_BYTES // (8 * max(1, dim)))
    for low in range(0, batch.num_rows, step):
        yield batch.slice(low, step)


def _sums(batches: Iterator[pa.RecordBatch], dim: int):
    """Weighted sum of each dimension, in whole numbers; as text, because it may exceed 64 bits."""
    total = [0] * dim
    for batch in batches:
        for part in _parts(batch, dim):
            x, w = _matrix(part.column("x"), dim), part.column("weight").to_numpy(zero_copy_only=False)
            bound = float(np.abs(x.astype(float)).max(initial=0)) * float(w.sum())
            x, w = (x, w) if bound < 2**62 else (x.astype(object), w.astype(object))
            total = [t + int(s) for t, s in zip(total, w @ x)]
    yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(map(str, total))], names=["i", "total"])


def _products(batches: Iterator[pa.RecordBatch], dim: int, mean: np.ndarray):
    """The upper triangle of the weighted product of centred vectors."""
    total = np.zeros((dim, dim))
    for batch in batches:
        for part in _parts(batch, dim):
            centred = _matrix(part.column("x"), dim) - mean
            weight = part.column("weight").to_numpy(zero_copy_only=False).astype(float)
            total += (centred * weight[:, None]).T @ centred
    i, j = np.triu_indices(dim)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "value"]
    )


def covariance(points: DataFrame, dim: int, n: int, mean: np.ndarray) -> np.ndarray:
    """Covariance of ``x`` by ``weight``, with divisor n, centred before multiplying."""
    parts = arrow_map(points.select("x", "weight"), "i int, j int, value double", _products, dim, mean)
    got = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()  # dim * (dim + 1) / 2 rows
    out = np.zeros((dim, dim))
    i, j = got["i"].to_numpy(), got["j"].to_numpy()
    out[i, j] = out[j, i] = got["value"].to_numpy() / n
    return out


def _totals(points: DataFrame, dim: int) -> list[int]:
    parts = arrow_map(points.select("x", "weight"), "i int, total string", _sums, dim)
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    got = parts.groupBy("i").agg(total).collect()  # dim rows
    sums = {r["i"]: int(r["total"]) for r in got}
    return [sums.get(i, 0) for i in range(dim)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - sum)^2, exact; None beyond 64 bits."""
    reach = float(np.abs(x.astype(float)).max(initial=0)) * n + max((abs(s) for s in sums), default=0)
    kind = np.int64 if reach * reach * max(1, len(sums)) < 2**62 else object
    away = x.astype(kind) * n - np.array(sums, kind)
    return [int(v) if v < 2**63 else None for v in (away * away).sum(axis=1).tolist()]


def _whiten(batches: Iterator[pa.RecordBatch], dim: int, n: int, sums: list[int], axes: np.ndarray, spread: np.ndarray):
    mean = np.array([s / n for s in sums])
    for batch in batches:
        for part in _parts(batch, dim):
            x = _matrix(part.column("x"), dim)
            values = (x - mean) @ axes / np.where(spread > 0, spread, np.nan)
            lists = [[None if np.isnan(v) else v for v in row] for row in values.tolist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("name"), part.column("weight"), pa.array(deviations(x, n, sums), pa.int64()), pa.array(lists, pa.list_(pa.float64()))],
                names=["name", "weight", "deviation", "whitened"],
            )


def whiten(
    rows: DataFrame, row_id: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256, weights: str = "one"
) -> DataFrame:
    """Per row and component: id, component, n, deviation, whitened, explained, identity_error."""
    source = rows.select(F.col(row_id).alias("id"), quantised(F.col(vector), scale).alias("x")).where("x is not null")
    weight = {"one": F.lit(1).cast("bigint"), "count": F.col("copies")}[weights]
    distinct = source.groupBy("x").agg(n_rows().alias("copies"))
    points = cut(distinct.select(name_of(F.col("x")).alias("name"), "x", weight.alias("weight")), "distinct")
    size = points.agg(F.max(F.size("x")).alias("dim"), F.sum("weight").alias("n")).first()
    dim, n = size["dim"] or 0, size["n"] or 0
    n_out = min(components, dim)
    schema = f"{row_id} {rows.schema[row_id].dataType.simpleString()}, component int, n bigint, deviation bigint"
    if not n_out:
        return rows.sparkSession.createDataFrame([], schema + ", whitened double, explained double, identity_error double")
    sums = _totals(points, dim)
    v = covariance(points, dim, n, np.array([s / n for s in sums]))
    values, vectors = np.linalg.eigh(v)
    values, axes = np.maximum(values[::-1][:n_out], 0), np.ascontiguousarray(vectors[:, ::-1][:, :n_out])
    spread = np.sqrt(np.where(values > NEGLIGIBLE * values[0], values, 0))
    schema = "name binary, weight bigint, deviation bigint, whitened array<double>"
    white = cut(arrow_map(points, schema, _whiten, dim, n, sums, axes, spread), "whitened")
    live = int((spread > 0).sum())
    error = 0.0
    if live:
        used = white.select(F.slice("whitened", 1, live).alias("x"), "weight")
        centre = used.select(*[F.sum(F.col("weight") * F.col("x")[k]).alias(f"c{k}") for k in range(live)]).first()
        error = float(np.abs(covariance(used, live, n, np.array([c / n for c in centre])) - np.eye(live)).max())
    back = attach(source.select("id", name_of(F.col("x")).alias("name")), white, ["name"], "inner")
    explained = [float(e / np.trace(v)) if np.trace(v) > 0 else None for e in values]
    explained = F.lit(explained).cast("array<double>")
    placed = back.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return placed.select(
        F.col("id").alias(row_id),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
