"""Exact Jaccard join of word-shingle sets by PartEnum signatures.

Sizes fall into bands so that two sets that can link lie in one band or in neighbouring
ones; each set signs for its own band and the next. A band's largest sets bound the number k
of elements by which linked sets differ. The shingle domain is split into groups that are
split again into ``split`` partitions; with k differences spread over the groups, some group
has at most ``tolerated`` of them, so some subset of ``split - tolerated`` of its partitions
is free of differences: both sets have the same elements there, and so one signature.

A subset without any element says nothing, and all sets of a band that lack elements there would
meet. So a band has some groups more than it needs: linked sets then agree on ``spare + 1`` groups
at least, and a set with empty subsets in at most ``spare`` groups need not sign for them. The few
sets with more sign for their empty subsets together with a second enumeration (``SECOND``) over
another split of the domain: linked sets share a signature of every enumeration.

Equal sets are one node, named by a 64-bit hash of the set. Nodes that share a signature are
compared as ``clusters`` describes, first by their marks: counts of a set's elements in some
cells. The sum of absolute differences of two marks is at most the number of elements
by which the sets differ, so pairs beyond the bound for their sizes cannot link. What is left is
compared on the shingles themselves, and components come out as if all pairs had been compared.

Nulls and ties: a document without words has an empty set and links with nothing, a null
text likewise; copies share a component; rows that repeat a doc_id are linked through it;
a row without doc_id takes no part and has a null component. Empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators.grouping import attach
from playmart.operators.workspace import cut

from .clusters import if_small, linked_components, shared_buckets
from .common import MIX, arrow_map, components, scramble, shingles, slices, texts

#: Partitions of a group, and how many of them may differ: what a band chooses from for its first
#: enumeration, and the second one.
SHAPES, SECOND = ((2, 1), (3, 1), (4, 1), (5, 2)), (2, 1)
#: Of bands whose sets are too small for spare groups.
SMALL = (3, 1)
#: Cells of a mark: at least so many, and more for larger sets, so that a cell counts few elements.
LEAST_CELLS, PER_CELL = 64, 4

#: Standard deviations by which spare groups exceed the mean number of groups with empty subsets.
SURE = 2

PROFILE = "doc_id long, n_shingles long, node long, mark binary"


@lru_cache(maxsize=64)
def bands(percent: int, largest: int) -> tuple[list[int], list[int]]:
    """Lowest and highest size of each band, up to one band beyond ``largest``."""
    low, high = [1], [100 // percent]
    while low[-1] <= largest:
        low.append(high[-1] + 1)
        high.append(low[-1] * 100 // percent)
    return low, high


def node_of(items: np.ndarray) -> int:
    """A 64-bit name of a set, whatever the order; signed for Spark."""
    total = scramble(items * MIX[2]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(items))
    return int(scramble(total)[0].astype(np.int64))


@lru_cache(maxsize=1024)
def layout(k: int, size: int) -> tuple[tuple[int, int], int, int]:
    """(shape, groups, spare groups among them) for k differences between sets of ``size`` elements.

    Spare groups must exceed the mean number of groups with an empty subset by ``SURE`` standard
    deviations; of the shapes that allow it, the one with the fewest signatures is taken.
    """
    if not k:
        return (1, 0), 1, 0
    best = None
    for split, tolerated in SHAPES:
        needed = k // (tolerated + 1) + 1
        for spare in range(0, needed + 1, max(1, needed // 64)):
            groups, subsets = needed + spare, math.comb(split, tolerated)
            chance = min(1.0, subsets * math.exp(-size * (split - tolerated) / (split * groups)))
            if groups * chance + SURE * math.sqrt(groups * chance * (1 - chance)) <= spare:
                if best is None or groups * subsets < best[0]:
                    best = (groups * subsets, (split, tolerated), groups, spare)
                break
    return best[1:] if best else (SMALL, k // (SMALL[1] + 1) + 1, 0)


def _enumerate(
    items: np.ndarray, worth: np.ndarray, groups: int, shape: tuple[int, int], seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """(a hash per subset and group, whether the subset holds no element), groups in columns."""
    split, tolerated = shape
    place = (scramble(items + np.uint64(seed << 20)) % np.uint64(groups * split)).astype(np.int64)
    sums, filled = np.zeros(groups * split, np.uint64), np.zeros(groups * split, bool)
    np.add.at(sums, place, worth)
    filled[place] = True
    sums, filled = sums.reshape(groups, split), filled.reshape(groups, split)
    subsets = list(combinations(range(split), split - tolerated))
    seeds = np.arange(groups, dtype=np.uint64) + np.uint64(seed << 40)
    total = scramble(seeds + (np.arange(len(subsets), dtype=np.uint64) << np.uint64(32))[:, None])
    for k in range(split - tolerated):
        total = scramble(total ^ sums[:, [subset[k] for subset in subsets]].T)
    return total, np.array([~filled[:, subset].any(axis=1) for subset in subsets])


def signatures(items: np.ndarray, percent: int) -> np.ndarray:
    """The PartEnum signatures of a set of 64-bit items."""
    low, high = bands(percent, 1 << (len(items)).bit_length())
    own = int(np.searchsorted(high, len(items)))
    out, worth = [], scramble(items * MIX[1])
    for band in (own, own + 1):
        k = (100 - percent) * 2 * high[band] // (100 + percent)
        # the smallest sets that sign for a band come from the one below
        first, groups, spare = layout(k, low[band] * percent // 100)
        signed, empty = _enumerate(items, worth, groups, first, band)
        out.append(signed[~empty])
        if int(empty.any(axis=0).sum()) > spare:
            again, _ = _enumerate(items, worth, k // (SECOND[1] + 1) + 1, SECOND, band + 1000)
            out.append(scramble(signed[empty][:, None] ^ (again.ravel() * MIX[2])[None, :]).ravel())
    return np.concatenate(out)


def mark_of(items: np.ndarray) -> bytes:
    """How many elements lie in each cell, up to 255; the number of cells is a power of two."""
    cells = max(LEAST_CELLS, 1 << (len(items) // PER_CELL).bit_length())
    counts = np.bincount((scramble(items * MIX[0]) % np.uint64(cells)).astype(np.int64), minlength=cells)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _matrix(marks: list[bytes], cells: int) -> np.ndarray:
    """Marks as rows of ``cells`` counts; larger marks are folded, smaller ones are not possible."""
    out = np.empty((len(marks), cells), np.int16)
    lengths = np.array([len(m) for m in marks])
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        flat = np.frombuffer(b"".join(marks[i] for i in rows), np.uint8).reshape(len(rows), -1, cells)
        out[rows] = flat.sum(axis=1, dtype=np.int16)
    return out


def _profile(batches: Iterator[pa.RecordBatch], width: int):
    for batch in slices(batches):
        ids = batch.column("doc_id").cast(pa.int64())
        sizes, nodes, marks = [], [], []
        for text in texts(batch):
            items = shingles(text, width)
            sizes.append(len(items))
            nodes.append(node_of(items) if len(items) else None)
            marks.append(mark_of(items) if len(items) else None)
        columns = [ids, pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(marks, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "node", "mark"])


def _signed(batches: Iterator[pa.RecordBatch], width: int, percent: int):
    """(signature, node) rows; a set that this task has signed before is not signed again."""
    seen: set[int] = set()  # one number per distinct text of this task's split
    for batch in slices(batches):
        found, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for text in texts(batch):
            items = shingles(text, width)
            node = node_of(items)
            if len(items) and node not in seen:
                seen.add(node)
                found.append(signatures(items, percent).astype(np.int64))
                owners.append(np.full(len(found[-1]), node))
        columns = [pa.array(np.concatenate(x)) for x in (found, owners)]
        yield pa.RecordBatch.from_arrays(columns, names=["signature", "node"])


class ShingleSets:
    """The exact comparison: 100 * shared >= percent * union, on shingle hashes."""

    def __init__(self, width: int, percent: int):
        self.width, self.percent = width, percent

    def prepare(self, column: pa.Array) -> list[tuple[int, np.ndarray]]:
        return [(node_of(items), items) for items in (shingles(t or "", self.width) for t in column.to_pylist())]

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        small, large = (a, b) if len(a) < len(b) else (b, a)
        place = np.minimum(np.searchsorted(large, small), len(large) - 1)
        shared = int((large[place] == small).sum())
        return 100 * shared >= self.percent * (len(a) + len(b) - shared)

    def _within(self, difference: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Whether sets that differ in at least so many elements can link, by the sum of their sizes."""
        return (100 + self.percent) * difference <= (100 - self.percent) * total

    def near(self, sizes_a: np.ndarray, marks_a: list[bytes], sizes_b: np.ndarray, marks_b: list[bytes]) -> np.ndarray:
        total = sizes_a + sizes_b
        keep = self._within(np.abs(sizes_a - sizes_b), total)
        cells = np.array([min(len(a), len(b)) for a, b in zip(marks_a, marks_b)])
        for size in np.unique(cells[keep]):
            rows = np.flatnonzero(keep & (cells == size))
            for low in range(0, len(rows), 4096):
                own = rows[low : low + 4096]
                a, b = _matrix([marks_a[i] for i in own], size), _matrix([marks_b[i] for i in own], size)
                keep[own] = self._within(np.abs(a - b).sum(axis=1, dtype=np.int64), total[own])
        return keep

    def block(self, sizes: np.ndarray, marks: list[bytes]) -> "_Block":
        return _Block(self, sizes, marks)


class _Block:
    """Marks of some sets, to be held against that of another."""

    def __init__(self, sets: ShingleSets, sizes: np.ndarray, marks: list[bytes]):
        self.sets, self.sizes = sets, sizes
        self.cells = min(map(len, marks))
        self.by_cells = {self.cells: _matrix(marks, self.cells)}

    def near(self, size: int, mark: bytes) -> np.ndarray:
        total = self.sizes + size
        keep = self.sets._within(np.abs(self.sizes - size), total)
        rows = np.flatnonzero(keep)
        if len(rows):
            cells = min(self.cells, len(mark))
            if cells not in self.by_cells:
                self.by_cells[cells] = self.by_cells[self.cells].reshape(len(self.sizes), -1, cells).sum(axis=1, dtype=np.int16)
            difference = np.abs(self.by_cells[cells][rows] - _matrix([mark], cells)).sum(axis=1, dtype=np.int64)
            keep[rows] = self.sets._within(difference, total[rows])
        return keep


def node_components(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(profile of every row, components (node, component) of linked nodes)."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    profile = cut(arrow_map(source, PROFILE, _profile, width), "profile")
    named = source.where("doc_id is not null")
    members = shared_buckets(arrow_map(named.select("text"), "signature long, node long", _signed, width, percent))
    least = F.min("doc_id").alias("doc_id")
    facts = profile.where("doc_id is not null and node is not null")
    # equal sets have one size and one mark, so any row's will do
    facts = facts.groupBy("node").agg(least, F.max("n_shingles").alias("size"), F.max("mark").alias("mark"))
    first = cut(attach(facts, members.select("node").distinct(), ["node"], "left_semi"), "first")

    def fetch(nodes: DataFrame) -> DataFrame:
        """(node, item = text), each from the first of its documents."""
        wanted = cut(attach(first.select("node", "doc_id"), nodes, ["node"], "left_semi"), "wanted")
        return cut(named.join(if_small(wanted), "doc_id").select("node", F.col("text").alias("item")), "texts")

    comparison = (__name__, "ShingleSets", width, percent)
    return profile.drop("mark"), linked_components(members, first.drop("doc_id"), fetch, comparison)


def join(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    profile, found = node_components(docs, width, percent)
    rows = attach(profile, found, ["node"], "left")
    rows = rows.withColumn("part", F.coalesce("component", "node"))
    # an id that several rows share links their parts
    if not rows.where("part is not null").groupBy("doc_id").agg(F.count_distinct("part").alias("n")).where("n > 1").isEmpty():
        rows = _merged(rows)
    least = rows.where("part is not null").groupBy("part").agg(F.min("doc_id").alias("least"))
    rows = attach(rows, least, ["part"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"))


def _merged(rows: DataFrame) -> DataFrame:
    least = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("part").alias("first"))
    chained = attach(rows.drop("component"), least, ["doc_id"], "left")
    ties = chained.where("part is not null and first is not null").select(F.col("part").alias("a"), F.col("first").alias("b"))
    whole = components(ties.where("a <> b")).withColumnRenamed("node", "part")
    chained = attach(chained.drop("first"), whole, ["part"], "left")
    return chained.withColumn("part", F.coalesce("component", "part")).drop("component")


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest doc_id of each group, all columns; texts without words stay."""
    component = join(docs, width, percent).where("doc_id <> component_id")
    dropped = if_small(cut(component.select(F.col("doc_id").alias("dropped")).distinct(), "dropped"))
    return docs.join(dropped, docs["doc_id"] == dropped["dropped"], "left_anti")
