"""Small helpers the text operators share."""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.operators.grouping import attach
from playmart.operators.workspace import cut

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Texts handled at once inside a task, in bytes; a longer text is a piece of its own.
SLICE_BYTES = 4 << 20

_U64 = np.uint64
MIX = tuple(_U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_map(df: DataFrame, schema: str, target: Callable, *args) -> DataFrame:
    """``target(batches, *args)`` over Arrow batches; workers find the package by its path."""
    module, name, root = target.__module__, target.__name__, ROOT

    def run(batches):
        if root not in sys.path:
            sys.path.append(root)
        yield from getattr(importlib.import_module(module), name)(batches, *args)
        pa.default_memory_pool().release_unused()  # the worker may idle beside others

    return df.mapInArrow(run, schema)


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text (or of a list of numbers), or one row."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column(text)
            listed = pa.types.is_list(column.type)
            sizes = pc.multiply(pc.list_value_length(column), 8) if listed else pc.binary_length(column)
            sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)
            start, held = 0, 0
            for i, size in enumerate(sizes.tolist()):
                if i > start and held + size > limit:
                    yield batch.slice(start, i - start)
                    start, held = i, 0
                held += size
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [x or "" for x in batch.column(text).to_pylist()]


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hashes that are the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U64, len(words))


def scramble(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that every bit depends on all."""
    x = (x ^ (x >> _U64(31))) * MIX[0]
    x = (x ^ (x >> _U64(29))) * MIX[1]
    return x ^ (x >> _U64(32))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive word hashes; order matters."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, _U64)
    out = np.zeros(n, _U64)
    for i in range(width):
        out = (out ^ words[i : i + n]) * MIX[1] + MIX[0]
        out ^= out >> _U64(29)
    return scramble(out)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a text.

    ASCII letters are lower-cased and words end at ASCII white space. Fewer words than
    ``width`` make one shingle of the whole sequence, no words make none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, _U64)
    if len(words) < width:
        return hash_words([b"\x00".join(words) + b"\x00%d" % len(words)])
    return np.unique(window_hashes(hash_words(words), width))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a long, b long) as (node, component = smallest node).

    Alternating large-star and small-star steps, which settle in a number of rounds that grows
    with the logarithm of the nodes. Each step lowers endpoints to the smallest neighbour with
    a plain minimum per node and a join back, so a hub of any degree is reduced before it is
    shuffled and the join can be split. Every round is one written table in the shared folder.
    Nodes without an edge are not listed.
    """
    now = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )

    def measure(df):
        """(edges, their fingerprint, nodes that are both an upper and a lower end)."""
        ends = df.select("a", F.lit(1).alias("up")).union(df.select("b", F.lit(0)))
        inner = ends.groupBy("a").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.sum("up").alias("n"))
        inner = inner.where("(low < high) or n > 1").limit(1).count()
        counted = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return (*counted, inner)

    state = measure(now)
    while state[0] and state[2]:  # done when every upper end has one edge, and no lower end has any
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = attach(both, least, ["a"], "inner").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = attach(large, least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a <> b").union(least.select("a", F.col("m").alias("b")))
        now = cut(small.distinct(), label)
        before, state = state, measure(now)
        if before == state:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
