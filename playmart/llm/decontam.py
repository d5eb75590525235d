"""Benchmark decontamination by templates, with DataFrame functions only.

Numbers, units after numbers, and capitalised words inside a sentence become typed
placeholders; everything else is lower-cased and loses its marks. Windows of ``WIDTH``
template tokens of documents are hash-joined with those of the benchmark, so a question that
comes back with other numbers or names still matches. A window with fewer than ``PLAIN`` plain
tokens says little by its template and matches on its values as well, so that number-rich items
are found where they are copied.

Matches of one document and item that follow one another at one alignment are a run; it counts if
it covers ``MATCHED`` tokens in a row (or the whole item, if that is shorter) and if its slots are
consistent: each value of the item stands for one value in the document and the other way
round. Where in the document or the item a run stands makes no difference.

A null text has no windows. Items or documents with no tokens match nothing; an item shorter
than ``MATCHED`` is one window of its own length. Rows without doc_id are not reported; rows
that repeat a doc_id count as one document. Empty tables give an empty result. Extra columns
are kept by ``remove`` and not read otherwise. The markers of placeholders are characters for
private use; in a text they count as blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.operators.workspace import cut

from .clusters import if_small

WIDTH = 8
MATCHED = 13
#: So many plain tokens, or all of a shorter window, let its template alone speak for it.
PLAIN = 4
#: Measured bytes of benchmark windows up to which they are broadcast; beyond, they are joined by a shuffle.
BROADCAST_BYTES = 64 << 20

NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
#: Fixed word list: units that may follow a number.
UNITS = (
    "%|percent|kg|g|mg|lb|lbs|pounds?|km|m|cm|mm|miles?|feet|ft|inch|inches|hours?|h|minutes?|min|seconds?|s|days?|weeks?"
    "|months?|years?|dollars?|euros?|cents?|usd|eur|litres?|liters?|l|ml|degrees?|mph|kmh"
)
#: Each begins with what fails soonest; no group repeats in a way that could backtrack.
NUMBERS = r"([0-9](?<![\p{L}\p{N}][0-9])[0-9]*+(?:[.,][0-9]++)*+)"
NAMES = r" (?<=[\p{Ll},;] )(\p{Lu}\p{L}+)"
TOKEN = rf"[{NUMBER}{NAME}{UNIT}][^ ]+|\p{{L}}+"


def tokenized(rows: DataFrame) -> DataFrame:
    """Replace ``text`` by ``raw``, its template tokens; a placeholder carries its value behind the marker."""
    rows = rows.withColumn("text", F.regexp_replace("text", f"[{NUMBER}{NAME}{UNIT}]", " "))
    rows = rows.withColumn("text", F.regexp_replace("text", NAMES, f" {NAME}$1"))
    rows = rows.withColumn("text", F.lower(F.regexp_replace("text", NUMBERS, f" {NUMBER}$1 ")))
    unit = F.regexp_replace("text", rf"({NUMBER}[^ ]+ ) ?({UNITS})(?!\p{{L}})", f"$1{UNIT}$2 ")
    rows = rows.withColumn("text", F.when(F.contains("text", F.lit(NUMBER)), unit).otherwise(F.col("text")))
    return rows.withColumn("raw", F.coalesce(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)), F.array())).drop("text")


def _slot(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    return first.isin(NUMBER, NAME, UNIT)


def _windows_of(n: int, stride: int) -> Column:
    """Windows of ``n`` tokens at each ``stride``-th place.

    Elements are read by place, because a slice would copy the whole array each time.
    """

    def values(i):
        tokens = F.filter(F.array(*[F.get("raw", i + k) for k in range(n)]), _slot)
        return F.struct(i.alias("pos"), F.when(F.col("any"), tokens).otherwise(F.array().cast("array<string>")).alias("slots"))

    def window(at):
        template = F.xxhash64(*[F.get("codes", at["pos"] + k) for k in range(n)])
        told = F.xxhash64(F.lit("values"), *[F.get("raw", at["pos"] + k) for k in range(n)])
        speaks = n - F.size(at["slots"]) >= min(n, PLAIN)
        return F.struct(
            at["pos"].alias("pos"),
            F.when(speaks, template).otherwise(told).alias("window"),
            at["slots"].alias("slots"),
            F.lit(n).alias("width"),
        )

    places = F.when(F.size("codes") >= n, F.sequence(F.lit(0), F.size("codes") - n, F.lit(stride)))
    return F.transform(F.transform(F.coalesce(places, F.array().cast("array<int>")), values), window)


def windows(rows: DataFrame, keys: list[str], widths: list[tuple[int, int]]) -> DataFrame:
    """keys, n_tokens, pos, window (hash of its template), slots (its values), width.

    ``widths`` lists (tokens in a window, stride).
    """
    rows = tokenized(rows.select(*keys, "text"))
    code = lambda t: F.xxhash64(F.when(_slot(t), F.substring(t, 1, 1)).otherwise(t))
    rows = rows.select(*keys, "raw", F.transform("raw", code).alias("codes"), F.exists("raw", _slot).alias("any"))
    found = F.concat(*[_windows_of(*w) for w in widths])
    return rows.select(*keys, F.size("codes").alias("n_tokens"), F.inline(found))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_matched tokens, n_slots.

    A match covers ``MATCHED`` tokens in a row, so among the windows of a document at every
    ``MATCHED - WIDTH + 1``-th place there is one inside it: the first join takes only those.
    Documents it finds are cut into all windows and matched in full. Items of fewer than
    ``MATCHED`` tokens are one window of their own length, looked for at every place.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id is not null")
    sizes = tokenized(items).select(F.least(F.size("raw"), F.lit(MATCHED)).alias("n")).where("n > 0")
    lengths = sorted(r[0] for r in sizes.distinct().collect())  # MATCHED numbers at most
    if not lengths:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, n_matched bigint, n_slots int")
    full = [(WIDTH if n == MATCHED else n, 1) for n in lengths]
    sparse = [(WIDTH, MATCHED - WIDTH + 1) if n == MATCHED else (n, 1) for n in lengths]
    theirs = windows(items, ["item_id"], full)
    own_width = F.when(F.col("n_tokens") >= MATCHED, F.lit(WIDTH)).otherwise(F.col("n_tokens"))
    theirs = theirs.where(F.col("width") == own_width).select(
        "window",
        "width",
        "item_id",
        F.col("pos").alias("item_pos"),
        F.col("slots").alias("item_slots"),
        F.least("n_tokens", F.lit(MATCHED)).alias("needed"),
    )
    theirs = if_small(cut(theirs.distinct(), "benchmark"), BROADCAST_BYTES)
    ours = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    hit = windows(ours, ["doc_id"], sparse).join(theirs, ["window", "width"], "left_semi")
    hit = if_small(cut(hit.select("doc_id").distinct(), "hits"))
    met = windows(ours.join(hit, "doc_id", "left_semi"), ["doc_id"], full).join(theirs, ["window", "width"])
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    pairs = F.arrays_zip("item_slots", "slots").alias("pairs")
    met = met.select("doc_id", "item_id", shift, "item_pos", "needed", "width", pairs).distinct()
    # places that follow one another are as far from their rank as from each other; an item's windows at most,
    # of each text under the doc_id
    aligned = Window.partitionBy("doc_id", "item_id", "shift").orderBy("item_pos")
    met = met.withColumn("run", F.col("item_pos") - F.dense_rank().over(aligned))
    runs = met.groupBy("doc_id", "item_id", "shift", "run").agg(
        F.count_distinct("item_pos").alias("n"),
        F.max("width").alias("width"),
        F.max("needed").alias("needed"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    matched = F.col("n") + F.col("width") - 1
    one_to_one = F.size("pairs") == F.size(F.array_distinct("pairs.item_slots"))
    one_to_one &= F.size("pairs") == F.size(F.array_distinct("pairs.slots"))
    runs = runs.where((matched >= F.col("needed")) & one_to_one)
    return runs.groupBy("doc_id", "item_id").agg(
        F.max(matched).cast("bigint").alias("n_matched"), F.max(F.size("pairs")).alias("n_slots")
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a contaminated one, all columns kept."""
    bad = cut(find(docs, benchmark).select(F.col("doc_id").alias("bad")).distinct(), "contaminated")
    bad = if_small(bad)
    return docs.join(bad, docs["doc_id"] == bad["bad"], "left_anti")
