"""Token ids as length-delimited binary records with a separate offset index.

A shard is a sequence of frames::

    u64 length | u32 masked crc32 of the length | payload | u32 masked crc32 of the payload

all little-endian; the mask is the usual rotation by 15 bits plus a constant, so that a
checksum of data that holds checksums stays sound. The payload is one flag byte
(bit 0: ids take four bytes instead of two, bit 1: the document has no id), the doc_id as
i64 and the ids. Two bytes are used whenever the vocabulary fits.

Beside every ``.rec`` shard lies a ``.idx`` file for shuffled reads: per record an i64
doc_id, a u64 offset and a u32 number of ids. The folder's ``index`` table lists the same
for all shards; only files named there count, so what a lost or repeated task attempt
left behind is never read.

Nulls and ties: a null text is an empty one (only the end id), a row without doc_id comes
first and keeps a null id, rows that share a doc_id are all written. An empty table gives
an empty index. Other columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmart.operators.workspace import fresh_dir

from .common import arrow_map, slices
from .wordcache import text_tokenizer

#: Fixed values of the checksum mask.
MASK_ROTATE, MASK_ADD = 15, 0xA282EAD8

WIDE, NO_ID = 1, 2
HEAD = struct.Struct("<QI")
LEAD = struct.Struct("<Bq")
ENTRY = struct.Struct("<qQI")
FOOT = struct.Struct("<I")

#: A shard is closed when it has grown beyond this.
SHARD_BYTES = 32 << 20

INDEX = "part int, seq int, shard string, row long, doc_id long, offset long, n_tokens long"
RECORDS = "part int, seq int, row long, doc_id long, before long, n_tokens long, ids_crc32 long"


def masked_crc(data) -> int:
    crc = zlib.crc32(data)
    return ((crc >> MASK_ROTATE | crc << (32 - MASK_ROTATE)) + MASK_ADD) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, FOOT.pack(masked_crc(length)), payload, FOOT.pack(masked_crc(payload))))


def unframe(data, at: int) -> tuple[memoryview, int]:
    """The payload of the frame at an offset and where the next one starts; checks both sums."""
    length, check = HEAD.unpack_from(data, at)
    start = at + HEAD.size
    if masked_crc(data[at : at + 8]) != check:
        raise ValueError(f"damaged length at {at}")
    payload = data[start : start + length]
    if len(payload) != length or masked_crc(payload) != FOOT.unpack_from(data, start + length)[0]:
        raise ValueError(f"damaged record at {at}")
    return payload, start + length + FOOT.size


def pack(doc_id: int | None, ids: np.ndarray, wide: bool) -> bytes:
    flags = WIDE * wide | NO_ID * (doc_id is None)
    return LEAD.pack(flags, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def unpack(payload) -> tuple[int | None, np.ndarray]:
    flags, doc_id = LEAD.unpack_from(payload, 0)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=LEAD.size)
    return (None if flags & NO_ID else doc_id), ids.astype("<u4")


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it; Hadoop's names for S3 are names for S3."""
    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else uri)


def read_record(path: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its index entry, for shuffled reads."""
    store, inner = store_of(path)
    with store.open_input_file(inner) as f:
        f.seek(offset)
        head = f.read(HEAD.size)
        payload, _ = unframe(memoryview(head + f.read(HEAD.unpack(head)[0] + FOOT.size)), 0)
    return unpack(payload)


class _Shard:
    """The shard a task is writing, with its index."""

    def __init__(self, folder: str, part: int, seq: int, attempt: int):
        self.name = f"{folder}/part-{part:06d}-{seq:04d}-{attempt}.rec"
        self.store, self.path = store_of(self.name)
        self.out, self.size, self.entries = self.store.open_output_stream(self.path), 0, []

    def add(self, doc_id: int | None, ids: np.ndarray, wide: bool) -> int:
        data, at = frame(pack(doc_id, ids, wide)), self.size
        self.out.write(data)
        self.size += len(data)
        self.entries.append(ENTRY.pack(doc_id or 0, at, len(ids)))
        return at

    def close(self) -> None:
        self.out.close()
        with self.store.open_output_stream(self.path.removesuffix(".rec") + ".idx") as out:
            out.write(b"".join(self.entries))


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int, limit: int):
    from pyspark import TaskContext

    context, schema = TaskContext.get(), _arrow(INDEX)
    part, seq, row, shard = context.partitionId(), 0, 0, None
    words = text_tokenizer(tokenizer)
    wide = words.size > 1 << 16
    end = np.array([end_id], np.uint32)
    for batch in slices(batches, limit=8 << 20):
        ids, bounds = words.encode(batch.column("text"))
        rows = []
        for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            shard = shard or _Shard(folder, part, seq, context.taskAttemptId())
            own = np.concatenate((ids[bounds[k] : bounds[k + 1]], end))
            rows.append((part, seq, shard.name, row, doc_id, shard.add(doc_id, own, wide), len(own)))
            row += 1
            if shard.size > limit:
                shard.close()
                shard, seq = None, seq + 1
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    if shard:
        shard.close()


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Encode every text and write the records in ascending doc_id order; returns the index.

    Rows are dealt out by ranges of (doc_id, hash of the text), so each task writes a run of
    consecutive documents and rows that repeat one id can be split. ``folder`` is a URI every
    executor can write to.
    """
    folder = folder if "://" in folder else "file://" + os.path.abspath(folder.removeprefix("file:"))
    store, inner = store_of(folder)
    store.create_dir(f"{inner}/shards", recursive=True)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    dealt = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    dealt = dealt.select("doc_id", "text")
    index = arrow_map(dealt, INDEX, _write, f"{folder}/shards", tokenizer, end_id, shard_bytes)
    index.write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _read(batches: Iterator[pa.RecordBatch]):
    schema = _arrow(RECORDS)
    for batch in batches:
        for part, seq, name, first in zip(*(batch.column(i).to_pylist() for i in range(4))):
            store, inner = store_of(name)
            with store.open_input_file(inner) as f:
                data = memoryview(f.read())
            at, row, before, rows = 0, first, 0, []
            while at < len(data):
                payload, at = unframe(data, at)
                doc_id, ids = unpack(payload)
                rows.append((part, seq, row, doc_id, before, len(ids), zlib.crc32(ids)))
                before += len(ids)
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_records(index: DataFrame) -> DataFrame:
    """Read all shards of an index back, checking every frame.

    Gives per record its place (part, seq, row), doc_id, ``before`` (ids of earlier records
    in the shard), n_tokens and the crc32 of its ids as little-endian u32.
    """
    shards = index.groupBy("part", "seq", "shard").agg(F.min("row").alias("first"))
    tasks = max(1, shards.count())
    return arrow_map(shards.repartition(tasks, "shard"), RECORDS, _read)


def start_positions(records: DataFrame, index: DataFrame) -> DataFrame:
    """Per record: doc_id, start (ids of all records before it), n_tokens, ids_crc32.

    Shard totals are one row per file, so the running sum over them is small; inside a
    shard the position comes from the file itself.
    """
    totals = index.groupBy("part", "seq").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", "seq", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    joined = records.join(base, ["part", "seq"])
    return joined.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op1(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    index = write_records(docs, fresh_dir(spark, "records"), tokenizer, end_id)
    return start_positions(read_records(index), index)
