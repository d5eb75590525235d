"""JSON objects out of whole files, whatever lines they span.

A file is a sequence of objects: one a line, several on a line, or one spread over many lines,
as exporters that indent write them. Files are read up to each ``{``, not line by line, so one
line may hold a whole file and still be read by many tasks. What a task reads of a block of a
file (a split of the reader) is kept in chunks of about ``CHUNK`` bytes, each written once with
what it does to the text behind it: whether it ends within a string and what brackets outside
strings add to the depth, for both ways it may begin. Prefix sums over those few numbers, one
row per chunk, tell how each chunk begins; then every chunk is cut on its own. Only records
that pass from one chunk to another are shuffled.

An object ends where the bracket depth outside strings is 0 again. A string ends at its quote
or, if that is missing, with the line. A backslash escapes the character behind it wherever it
stands. A file whose brackets do not match starts anew, at depth 0, at every line that begins
with ``{`` in its first column, so that one broken object does not swallow those behind it.
Text between objects becomes records, cut behind line ends and closing brackets, which the
parser then refuses. A record of more than ``LARGEST`` bytes is never put together: its first
piece stands for it and is refused as malformed. What stands between two ``{`` must fit into a
task's memory. Of a compressed file that is cut off right behind a ``{`` this one character
is not seen.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from playmart.operators.grouping import attach
from playmart.operators.workspace import cut

#: Bytes of one object, at most.
LARGEST = 4 << 20
#: Bytes of text in a chunk, about, and of chunks or records handed on at once.
CHUNK, HANDED = 1 << 18, 4 << 20
#: Readers decode a row group at once; its bytes, compressed, are kept few, as rows of text are long.
ROW_GROUP = 8 << 20
#: Measured chunks up to which their few numbers are broadcast, some 50 bytes each.
BROADCAST_CHUNKS = 200_000

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Names of compressed files, whose size says nothing of their text.
_PACKED = r"\.(?:gz|bz2|deflate|lz4|snappy|zst|zstd|xz|lzo)$"
_BLANK = b" \t\n\x0b\x0c\r"
_QUOTE, _BREAK, _OPEN, _CLOSE = 1, 2, 3, 4
_KINDS = np.zeros(256, np.uint8)
for _kind, _bytes in ((_QUOTE, b'"'), (_BREAK, b"\r\n"), (_OPEN, b"{["), (_CLOSE, b"}]")):
    _KINDS[list(_bytes)] = _kind

#: What a chunk does if it begins outside a string, and (``_q``) within one.
_EFFECT = ("delta long", "low long", "fresh long", "inside boolean")
_CHUNKS = "file_path string, file_size long, block long, size long, broken boolean, quoted boolean, "
_CHUNKS += "at_line boolean, braced boolean, " + ", ".join(_EFFECT)
_CHUNKS += ", " + ", ".join(c.replace(" ", "_q ") for c in _EFFECT) + ", text binary"
#: Records that lie within a chunk; of others what each chunk has of them, with its place and whether it is their beginning.
_RECORDS = "file_path string, value string, first string, block long, at long, size long, begins boolean"


def read_blocks(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Everything under ``path`` up to each ``{``, with its file and its block."""
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "{")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def frame(blocks: DataFrame, largest: int = LARGEST) -> DataFrame:
    """(file_path, value) per object, from what ``read_blocks`` gives, which is read once."""
    seen = Observation("chunks")
    chunks = _in_batches(blocks, _CHUNKS, _chunks).withColumn("at", F.monotonically_increasing_id())
    chunks = cut(chunks.observe(seen, F.count(F.lit(1)).alias("n")), "chunks", **{"parquet.block.size": ROW_GROUP})
    chunks = chunks.coalesce(max(1, seen.get["n"]))  # no task without a chunk, however small the reader's splits are
    begins = cut(_begins(chunks.drop("text")), "begins")
    if seen.get["n"] <= BROADCAST_CHUNKS:
        begins = F.broadcast(begins)
    known = chunks.select("file_path", "block", "at", "text").join(begins, "at")
    records = cut(_in_batches(known, _RECORDS, _records, largest), "records")
    fragments = cut(records.where("begins is not null").repartition("at"), "fragments")
    return records.where("begins is null").select("file_path", "value").unionByName(_stitched(fragments, largest))


def _in_batches(df: DataFrame, schema: str, target: Callable, *args) -> DataFrame:
    """``target(batches, *args)`` over Arrow batches; workers find the package by its path."""
    module, name, root = target.__module__, target.__name__, _ROOT

    def run(batches):
        if root not in sys.path:
            sys.path.append(root)
        yield from getattr(importlib.import_module(module), name)(batches, *args)

    return df.mapInArrow(run, schema)


class _Marks:
    """Where quotes, line ends and brackets of a text stand."""

    def __init__(self, text: bytes):
        plain = text.replace(b"\\\\", b"  ").replace(b'\\"', b"  ") if b"\\" in text else text
        self.raw = np.frombuffer(plain, np.uint8)
        kinds = _KINDS[self.raw]
        self.places = np.flatnonzero(kinds)
        self.kinds = kinds[self.places]
        quotes = np.cumsum(self.kinds == _QUOTE)
        breaks = self.kinds == _BREAK
        self.quotes = quotes - np.maximum.accumulate(np.where(breaks, quotes, 0))
        self.first_break = int(breaks.argmax()) if breaks.any() else len(breaks)

    def outside(self, quoted: bool):
        """Places, kinds and depths behind them of brackets and line ends outside strings, and how the text ends."""
        inside = self.quotes & 1
        if quoted:
            inside[: self.first_break] ^= 1
        ends = bool(inside[-1]) if len(inside) else quoted
        seen = (self.kinds >= _BREAK) & (inside == 0)
        kinds = self.kinds[seen]
        depth = np.cumsum((kinds == _OPEN).astype(np.int64) - (kinds == _CLOSE))
        return self.places[seen], kinds, depth, ends

    def fresh(self, places: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Which of these are a ``{`` in the first column of a line that begins in this text."""
        before = _KINDS[self.raw[np.maximum(places - 1, 0)]] == _BREAK
        return (kinds == _OPEN) & (places > 0) & before & (self.raw[places] == 0x7B)


def _effect(text: bytes, marks: _Marks, quoted: bool) -> tuple[bool, list]:
    """Whether a text ends in a string, and its columns ``_EFFECT``, for one way it may begin."""
    places, kinds, depth, ends = marks.outside(quoted)
    if not len(places):
        return ends, [0, 0, None, bool(text.strip(_BLANK))]
    fresh = np.flatnonzero(marks.fresh(places, kinds))
    cuts = np.flatnonzero(kinds != _OPEN)
    rest = text[places[cuts[-1]] + 1 :] if len(cuts) else text
    at_fresh = int(depth[fresh[-1]]) - 1 if len(fresh) else None
    return ends, [int(depth[-1]), min(0, int(depth.min())), at_fresh, bool(rest.strip(_BLANK))]


def _chunk(path: str, file_size: int, block: int, text: bytes) -> tuple:
    marks = _Marks(text)
    broken = marks.first_break < len(marks.kinds)
    ends, own = _effect(text, marks, False)
    _, other = _effect(text, marks, True)
    at_line = text[-1:] in (b"\r", b"\n")
    return (path, file_size, block, len(text), broken, ends, at_line, text[:1] == b"{", *own, *other, text)


_CHUNK_TYPES = [pa.string(), *[pa.int64()] * 3, *[pa.bool_()] * 4, *[*[pa.int64()] * 3, pa.bool_()] * 2, pa.binary()]


def _batch(rows: list[tuple], schema: str, types: list[pa.DataType]) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _chunks(batches: Iterator[pa.RecordBatch]):
    """The rows of each block put together to chunks, in order."""
    done, waiting, key, held, rows, size = [], 0, None, [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, blocks = batch.column("file_path"), batch.column("block").to_numpy()
        named = pc.dictionary_encode(paths).indices.to_numpy()
        runs = (np.flatnonzero((np.diff(named) != 0) | (np.diff(blocks) != 0)) + 1).tolist()
        values = batch.column("value")
        total = np.cumsum(pc.binary_length(values).to_numpy() + 1)
        for low, high in zip([0, *runs], [*runs, batch.num_rows]):
            own = (paths[low].as_py(), batch.column("file_size")[low].as_py(), int(blocks[low]))
            if own != key:
                if rows:
                    done.append(_chunk(*key, b"{".join(held)))
                    waiting += size
                # all but what stands first in a file follow a brace
                key, held, rows, size = own, [] if own[2] == 0 else [b""], 0, 0
            while low < high:
                base = int(total[low - 1]) if low else 0
                stop = min(high, max(low + 1, int(np.searchsorted(total, base + CHUNK - size, "right"))))
                held += values.slice(low, stop - low).to_pylist()
                size += int(total[stop - 1]) - base
                rows, low = rows + stop - low, stop
                if size >= CHUNK or low < high:
                    done.append(_chunk(*key, b"{".join(held)))
                    waiting, held, rows, size = waiting + size, [b""], 0, 0
                if waiting >= HANDED or len(done) >= 1000:
                    yield _batch(done, _CHUNKS, _CHUNK_TYPES)
                    done, waiting = [], 0
    if rows:
        done.append(_chunk(*key, b"{".join(held)))
    if done:
        yield _batch(done, _CHUNKS, _CHUNK_TYPES)


def _begins(chunks: DataFrame) -> DataFrame:
    """How each chunk begins: within a string, at which depth, in the middle of a piece or of a line."""
    order = Window.partitionBy("file_path").orderBy("block", "at")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file_path")
    turns = F.when(F.col("broken"), 0).otherwise(F.col("quoted").cast("bigint"))
    chunks = chunks.withColumn("turns", F.sum(turns).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    reset = F.struct(F.col("quoted").cast("bigint").alias("quoted"), "turns")
    chunks = chunks.withColumns(
        {
            "reset": F.last(F.when(F.col("broken"), reset), ignorenulls=True).over(before),
            "turned": F.lag("turns", 1, 0).over(order),
            "on_line": F.lag("at_line", 1, True).over(order),
            "last": F.lead("at").over(order).isNull(),
            # bytes of the file that no row holds: a brace at its very end, beside a mark of byte order
            "more": (F.col("file_size") - F.sum("size").over(whole)).isin(1, 4) & ~F.col("file_path").rlike(_PACKED),
        }
    )
    none = F.lit(0).cast("bigint")
    odd = F.coalesce("reset.quoted", none) + F.col("turned") - F.coalesce("reset.turns", none)
    chunks = chunks.withColumn("begins_quoted", F.pmod(odd, F.lit(2)) == 1)
    picked = {c: F.when(F.col("begins_quoted"), F.col(f"{c}_q")).otherwise(F.col(c)) for c in ("delta", "low", "fresh", "inside")}
    ends = F.when(F.col("broken"), F.col("quoted")).otherwise(F.col("quoted") != F.col("begins_quoted"))
    chunks = chunks.select("*", *[v.alias(f"p_{c}") for c, v in picked.items()], (F.col("more") & F.col("last")).alias("brace"))
    delta = F.col("p_delta") + (F.col("brace") & ~ends).cast("bigint")
    starts_line = F.col("on_line") & F.col("braced")
    chunks = chunks.withColumns({"delta": delta, "starts_line": starts_line})
    chunks = chunks.withColumn("depth", F.coalesce(F.sum("delta").over(before), none))
    fresh = F.coalesce("p_fresh", F.when(F.col("starts_line"), none))
    matched = (F.sum("delta").over(whole) == 0) & (F.min(F.col("depth") + F.col("p_low")).over(whole) >= 0)
    return chunks.select(
        "at",
        "begins_quoted",
        "depth",
        F.coalesce(F.last(F.col("depth") + fresh, ignorenulls=True).over(before), none).alias("base"),
        matched.alias("matched"),
        F.lag("p_inside", 1, False).over(order).alias("entered"),
        "starts_line",
        "brace",
    )


def _cuts(text: bytes, quoted: bool, depth0: int, base0: int, matched: bool, entered: bool, starts_line: bool):
    """(starts of records in a chunk, behind which the pieces of a text end, whether the last record is complete)."""
    marks = _Marks(text)
    places, kinds, depth, _ = marks.outside(quoted)
    depth = depth + depth0
    ends = kinds != _OPEN
    behind, level = places[ends] + 1, depth[ends]
    if matched:
        base = np.zeros(len(behind), np.int64)
        base0 = last = 0
    else:
        base0 = depth0 if starts_line else base0
        fresh = marks.fresh(places, kinds)
        bases = np.concatenate(([base0], depth[fresh] - 1))
        base = bases[np.searchsorted(places[fresh], behind, side="right")]
        last = int(bases[-1])
    starts = behind[(level <= base) & (behind < len(text))]
    if not entered and depth0 <= base0:
        starts = np.concatenate(([0], starts))
    rest = text[behind[-1] :] if len(behind) else text
    at_end = int(depth[-1]) if len(depth) else depth0
    return starts, behind, at_end <= last and not rest.strip(_BLANK)


def _known(batch: pa.RecordBatch):
    names = ("begins_quoted", "depth", "base", "matched", "entered", "starts_line")
    begins = zip(*(batch.column(c).to_pylist() for c in names))
    for k, (begin, brace) in enumerate(zip(begins, batch.column("brace").to_pylist())):
        text = batch.column("text")[k].as_py()
        text = text + b"{" if brace else text
        yield k, text, *_cuts(text, *begin)


def _first(text: bytes, start: int, behind: np.ndarray) -> bytes:
    """The piece that begins at ``start``, as far as this text holds it."""
    k = int(np.searchsorted(behind, start, side="right"))
    return text[start : int(behind[k]) if k < len(behind) else len(text)].strip(_BLANK)


def _strings(values: list[bytes]) -> pa.Array:
    try:
        return pa.array(values, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([v.decode("utf-8", "replace") for v in values], pa.string())


def _records(batches: Iterator[pa.RecordBatch], largest: int):
    """The records of each chunk, and what it has of those that pass its ends."""
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    none = [pa.string(), *[pa.int64()] * 3, pa.bool_()]

    def handed(paths, values):
        rest = [pa.nulls(len(values), t) for t in none]
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), _strings(values), *rest], names=names)

    paths, values, size = [], [], 0
    for batch in batches:
        for k, text, starts, behind, complete in _known(batch):
            bounds = [*starts.tolist(), len(text)]
            found = [text[a:b].strip(_BLANK) for a, b in zip(bounds, bounds[1:] if complete else bounds[1:-1])]
            if len(text) > largest:
                found = [_first(text, a, behind) if len(x) > largest else x for a, x in zip(bounds, found)]
            found = [x for x in found if x]
            path = batch.column("file_path")[k].as_py()
            paths += [path] * len(found)
            values += found
            size += len(text)
            if size >= HANDED and values:
                yield handed(paths, values)
                paths, values, size = [], [], 0
            parts = [(False, text[: bounds[0]], b"")] if bounds[0] else []
            if len(starts) and not complete:
                parts.append((True, text[bounds[-2] :], _first(text, bounds[-2], behind)))
            if parts:
                begins, texts, firsts = zip(*parts)
                own = [[path] * len(parts), *[[batch.column(c)[k].as_py()] * len(parts) for c in ("block", "at")]]
                own = [pa.array(own[0]), _strings(texts), _strings(firsts), pa.array(own[1]), pa.array(own[2])]
                own += [pa.array([len(x) for x in texts], pa.int64()), pa.array(begins)]
                yield pa.RecordBatch.from_arrays(own, names=names)
    if values:
        yield handed(paths, values)


def _stitched(fragments: DataFrame, largest: int) -> DataFrame:
    """The fragments of each record put together; of a record too long only its first piece."""
    order = Window.partitionBy("file_path").orderBy("block", "at", "begins")
    start = F.last(F.when(F.col("begins"), F.col("at")), ignorenulls=True)
    places = fragments.select("file_path", "block", "at", "begins", "size")
    places = places.withColumn("start", start.over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = places.groupBy("start").agg(F.sum("size").alias("total"))
    places = cut(attach(places.select("at", "begins", "start"), sizes, ["start"]), "places")
    known = attach(fragments, places, ["at", "begins"])
    text = F.when(F.col("total") <= largest, F.col("value")).when(F.col("begins"), F.col("first"))
    known = known.select("file_path", "start", "block", "at", "begins", text.alias("text")).where("text is not null")
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "begins", "text")))  # ``largest`` bytes at most
    joined = known.groupBy("file_path", "start").agg(F.array_join(parts["text"], "").alias("value"))
    joined = joined.select("file_path", F.regexp_replace("value", r"^\s+|\s+$", "").alias("value"))
    return joined.where("value <> ''")
