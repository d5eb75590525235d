"""Connected components of items that share a signature and pass an exact comparison.

Signatures say which items may be linked; a mark of some bytes an item then refutes most pairs
before any text moves, and only for pairs it leaves open are the texts fetched and compared.

Within a bucket of one signature the members are first held against its centre, the node that
meets most others: one pair per member gives most links. Buckets that are still several
components after that are looked through once more, by marks alone: members outside the
bucket's largest component against all members of other components. Members of a pair that the
marks leave open stay, which makes most buckets equal, and buckets with the same members count once.
In those the texts are compared, and what a task finds linked is one component to it from then on, so
it hands on fewer links than it has rows, however many pairs there are. So components come out as
if all pairs in all buckets had been compared, no link between different items is lost, and
pairs inside a component are never spelled out. A busy centre, and a large bucket, are dealt to many
tasks: a task holds one item, or one block of marks or items, and reads one slice.

A comparison is a class, named by module and name with its arguments: ``prepare(column)`` gives
a (node, item) for each entry of the column that ``fetch`` fetched; ``linked(item, item)`` decides; ``near(sizes, marks, sizes, marks)`` is False for
pairs, row by row, that cannot be linked; ``block(sizes, marks)`` has ``near(size, mark)``, the same for one
item against a block.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.operators.grouping import attach
from playmart.operators.workspace import cut

from .common import arrow_map, components, slices

#: Members one task compares with a centre.
MEMBERS_PER_TASK = 128
#: Marks of a bucket that are held at once, and marks they are compared with by one task.
BLOCK, SLICE = 256, 8192
#: Entries of the items of one block, about.
ENTRIES = 1 << 20
#: Measured bytes up to which a written side is broadcast; beyond, Spark joins by a shuffle.
BROADCAST_BYTES = 16 << 20

Comparison = tuple  # (module, class, *arguments)


def if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a written side whose size, measured here, is small; lists count by their entries."""
    size = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            size = size + 32 + 16 * F.greatest(F.size(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + 32 + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            size = size + 16
    measured = df.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if measured <= limit else df


def _tool(comparison: Comparison):
    module, name, *args = comparison
    return getattr(importlib.import_module(module), name)(*args)


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _compare(batches: Iterator[pa.RecordBatch], comparison: Comparison):
    """Rows sorted by (a, salt, member): a centre's own row, then its members."""
    tool, centre, held = _tool(comparison), None, None
    for batch in slices(batches, "item"):
        a, b = [], []
        rows = zip(*(batch.column(n).to_pylist() for n in ("a", "node", "member")), tool.prepare(batch.column("item")))
        for c, node, member, (name, item) in rows:
            if name != node:
                continue  # another text under a repeated id
            if not member:
                centre, held = c, item
            elif centre == c and tool.linked(held, item):
                a.append(c)
                b.append(node)
        yield _pairs(a, b)


def _near(batches: Iterator[pa.RecordBatch], comparison: Comparison):
    """Pairs that their marks do not refute."""
    tool = _tool(comparison)
    for batch in batches:
        if batch.num_rows:
            size_a, mark_a, size_b, mark_b = (batch.column(n).to_pylist() for n in ("size_a", "mark_a", "size_b", "mark_b"))
            keep = tool.near(np.array(size_a), mark_a, np.array(size_b), mark_b)
            yield batch.select(["a", "b"]).filter(pa.array(keep))


_DEALT = ("signature", "block", "slice", "other", "major", "node", "part", "size", "mark")


def _met(batches: Iterator[pa.RecordBatch], comparison: Comparison):
    """Rows sorted by (signature, block, slice, other): the block's own marks, then those to compare.

    Gives (signature, node) of all that have an open pair here, each row once at most.
    """
    tool, key, own, block, nodes, met = _tool(comparison), None, [], None, [], []
    for batch in batches:
        signatures, found = [], []
        for signature, number, share, other, major, node, part, size, mark in zip(*(batch.column(n).to_pylist() for n in _DEALT)):
            if (signature, number, share) != key:
                if block is not None:
                    found += nodes[met].tolist()
                    signatures += [key[0]] * (len(found) - len(signatures))
                key, own, block = (signature, number, share), [], None
            if not other:
                own.append((node, part, size, mark))
            elif own:
                if block is None:
                    nodes, parts, sizes, marks = zip(*own)
                    nodes, parts, met = np.array(nodes), np.array(parts), np.zeros(len(own), bool)
                    block = tool.block(np.array(sizes), marks)
                keep = block.near(size, mark) & (parts != part)
                if not major:  # this one is held by a block as well; once is enough
                    keep &= nodes < node
                if keep.any():
                    met |= keep
                    found.append(node)
                    signatures.append(signature)
        yield _pairs(signatures, found).rename_columns(["signature", "node"])
    if block is not None:
        found = nodes[met].tolist()
        yield _pairs([key[0]] * len(found), found).rename_columns(["signature", "node"])


def _joined(batches: Iterator[pa.RecordBatch], comparison: Comparison):
    """Rows as for ``_met`` with their items: links, none between what earlier ones of its block have joined."""
    tool, key, own, block = _tool(comparison), None, [], None
    for batch in slices(batches, "item"):
        a, b = [], []
        rows = zip(*(batch.column(n).to_pylist() for n in _DEALT), tool.prepare(batch.column("item")))
        for signature, number, share, other, major, node, part, size, mark, (name, item) in rows:
            if (signature, number, share) != key:
                key, own, block = (signature, number, share), [], None
            if name != node:
                continue  # another text under a repeated id
            if not other:
                own.append((node, part, size, mark, item))
            elif own:
                if block is None:
                    nodes, parts, sizes, marks, items = zip(*own)
                    nodes, heads, above = np.array(nodes), np.array(parts), {}
                    block = tool.block(np.array(sizes), marks)
                while part in above:
                    part = above[part]
                keep = block.near(size, mark) & (heads != part)
                if not major:
                    keep &= nodes < node
                for i in np.flatnonzero(keep).tolist():
                    if heads[i] != part and tool.linked(items[i], item):
                        a.append(int(nodes[i]))
                        b.append(node)
                        above[int(heads[i])] = part
                        heads[heads == heads[i]] = part
        yield _pairs(a, b)


def shared_buckets(signed: DataFrame) -> DataFrame:
    """(signature, node, met = rows of the bucket) of buckets with at least two nodes, written.

    The window streams over a sorted bucket and spills; a bucket row is a few longs.
    """
    bucket = Window.partitionBy("signature")
    members = signed.withColumns(
        {"low": F.min("node").over(bucket), "high": F.max("node").over(bucket), "met": F.count("*").over(bucket)}
    )
    return cut(members.where("low < high").select("signature", "node", "met"), "members")


def _centres(members: DataFrame) -> DataFrame:
    """Per signature the node that meets most others: (signature, centre)."""
    score = members.groupBy("node").agg(F.sum("met").alias("score"))
    scored = attach(members, score, ["node"], "inner")
    best = F.max(F.struct("score", "node"))["node"]
    return scored.groupBy("signature").agg(best.alias("centre"))


def stars_of(members: DataFrame) -> DataFrame:
    """Distinct (a = centre, b = member) of all buckets, written."""
    stars = attach(members, _centres(members), ["signature"], "inner").where("node <> centre")
    return cut(stars.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "stars")


def linked_components(
    members: DataFrame, facts: DataFrame, fetch: Callable[[DataFrame], DataFrame], comparison: Comparison
) -> DataFrame:
    """(node, component) of all nodes with a link.

    ``members`` are written buckets (signature, node, met); ``facts`` has (node, size, mark binary), one row a
    node; ``fetch(nodes)`` gives (node, item) of a frame of nodes.
    """
    known = cut(attach(facts, members.select("node").distinct(), ["node"], "left_semi"), "known")
    near = cut(_open_pairs(stars_of(members), known, comparison), "near")
    found = cut(components(_verified(near, fetch, comparison)), "found")
    beside = _open_buckets(members, known, found, comparison)
    if beside.isEmpty():
        return found
    chains = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return cut(components(chains.union(_block_links(beside, known, fetch, comparison))), "found")


def _open_pairs(pairs: DataFrame, known: DataFrame, comparison: Comparison) -> DataFrame:
    for end in ("a", "b"):
        own = known.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("mark").alias(f"mark_{end}"))
        pairs = attach(pairs, own, [end], "inner")
    return arrow_map(pairs, "a long, b long", _near, comparison)


def _verified(pairs: DataFrame, fetch: Callable[[DataFrame], DataFrame], comparison: Comparison) -> DataFrame:
    """The pairs whose texts are linked; members of a busy ``a`` are dealt to several tasks."""
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_TASK).alias("shares"))
    salted = attach(pairs, shares, ["a"], "inner")
    salted = cut(salted.select("a", "b", F.pmod(F.xxhash64("b"), "shares").alias("salt")), "pairs")
    members = salted.select("a", "salt", F.col("b").alias("node"), F.lit(True).alias("member"))
    centres = salted.select("a", "salt", F.col("a").alias("node"), F.lit(False).alias("member")).distinct()
    rows = members.union(centres)
    rows = attach(rows, fetch(rows.select("node").distinct()), ["node"], "inner")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "member")
    return arrow_map(rows.select("a", "node", "member", "item"), "a long, b long", _compare, comparison)


def _open_buckets(members: DataFrame, known: DataFrame, found: DataFrame, comparison: Comparison) -> DataFrame:
    """(signature, node, part, n = rows of the bucket) of members with a pair of different components that marks leave open."""
    met = arrow_map(_dealt(_mixed(members, found), known), "signature long, node long", _met, comparison)
    return _mixed(cut(met, "met"), found)


def _block_links(buckets: DataFrame, known: DataFrame, fetch: Callable[[DataFrame], DataFrame], comparison: Comparison) -> DataFrame:
    """(a, b): links that join what all pairs of ``_open_buckets`` would."""
    held = cut(attach(fetch(buckets.select("node").distinct()), known, ["node"], "inner"), "items")
    return arrow_map(_dealt(buckets, held, "item"), "a long, b long", _joined, comparison)


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """(signature, node, part, n = rows of the bucket), written, of buckets of several components; one of those with equal members."""
    parts = attach(members.select("signature", "node").distinct(), found, ["node"], "left")
    parts = parts.select("signature", "node", F.coalesce("component", "node").alias("part"))
    whole = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20,0)"))
    mixed = parts.groupBy("signature").agg(
        F.min("part").alias("low"),
        F.max("part").alias("high"),
        F.count("*").alias("n"),
        F.struct(whole("node"), whole("node", F.lit(1))).alias("same"),
    )
    mixed = mixed.where("low < high").groupBy("same", "n").agg(F.min("signature").alias("signature"))
    return cut(attach(parts, mixed.select("signature", "n"), ["signature"], "inner"), "parts")


def _dealt(parts: DataFrame, facts: DataFrame, *more: str) -> DataFrame:
    """The members of buckets, with their facts, in blocks and slices, sorted for the task that holds them."""
    sized = attach(parts, facts.select("node", "size"), ["node"], "inner")
    sizes = sized.groupBy("signature", "part").agg(F.count("*").alias("own"), F.sum("size").alias("entries"))
    largest = sizes.groupBy("signature").agg(F.max(F.struct("own", "part", "entries")).alias("top"), F.sum("entries").alias("entries"))
    rest = F.col("entries") - F.col("top.entries")
    largest = largest.select("signature", F.col("top.part").alias("top"), F.col("top.own").alias("top_n"), rest.alias("entries"))
    rows = attach(attach(parts, largest, ["signature"], "inner"), facts, ["node"], "inner")
    blocks = F.ceil((F.col("n") - F.col("top_n")) / BLOCK)
    rows = rows.select(
        *["signature", "node", "part", "size", "mark", *more, (F.col("part") == F.col("top")).alias("major")],
        (F.greatest(blocks, F.ceil(F.col("entries") / ENTRIES)) if more else blocks).alias("blocks"),
        F.ceil(F.col("n") / SLICE).alias("slices"),
    )
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    held = rows.where("not major").withColumns({"block": F.pmod(F.xxhash64("node"), "blocks"), "other": F.lit(False)})
    others = rows.withColumns({"slice": F.pmod(F.xxhash64("node"), "slices"), "other": F.lit(True)})
    dealt = held.withColumn("slice", every("slices")).select(*_DEALT, *more)
    dealt = dealt.union(others.withColumn("block", every("blocks")).select(*_DEALT, *more))
    return dealt.repartition("signature", "block", "slice").sortWithinPartitions("signature", "block", "slice", "other")
