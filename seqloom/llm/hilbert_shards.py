"""Shards along a Hilbert curve over document metadata.

Language, source and size are quantised to ``2**BITS`` levels each by quantiles of the whole table
(names by their place in the order of whole strings), the levels are mapped to their place on a
Hilbert curve, and documents are sorted along it. The curve is cut into runs of near equal bytes, so a
shard's files cover few values of every dimension and a filter on any of them can pass over files.

Equal texts get the place of their least metadata, so they lie side by side, and a cut that falls
into such a group moves to the group's nearer end if that is within ``BALANCE`` of a shard; else it stays at
the byte where it fell, so no group of copies, large or small, can unbalance the shards.

The order is (curve index, text hash, doc_id), which spreads any hot value over many range
partitions; running sums add up partition totals, of which the driver sees one row each.

Rules: null text has size 1 (no bytes plus 1) and the CRC of the empty text, and nulls come first
in each dimension; rows that repeat a doc_id each take a slot; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from seqloom.llm.common import durable, sized_broadcast, table, unsigned_crc32, utf8_bytes

SHARDS = 8
BITS = 5
#: A cut moves by at most this part of a shard to keep a group of equal texts whole.
BALANCE = 0.01


def hilbert_index(levels: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points (n, dims) with coordinates below ``2**bits``.

    The coordinates are brought to the transposed index by undoing, from the top bit down, the
    reflections and exchanges of each sub-cube, then Gray-decoded and interleaved.
    """
    x = levels.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for d in range(dims):
            flip = (x[d] & q) > 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    gray = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        gray ^= np.where(x[-1] & (1 << b), (1 << b) - 1, 0)
    x ^= gray
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            out = out << 1 | x[d] >> b & 1
    return out


@F.pandas_udf(LongType())
def _curve_index(levels: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack(levels.to_numpy())) if len(levels) else np.zeros(0, np.int64))


def _name_levels(base: DataFrame, name: str) -> DataFrame:
    """(name, level): where each different value's first row stands among all rows in the order of values, nulls first.

    One row for each different language or source.
    """
    order = Window.orderBy(F.col(name).asc_nulls_first())
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = base.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    level = F.floor(before * (1 << BITS) / F.sum("n").over(Window.partitionBy()))
    return durable(counted.select(F.col(name).alias(f"of_{name}"), level.cast("int").alias(f"{name}_level")))


def _size_level(base: DataFrame) -> Column:
    steps = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    cuts = base.agg(F.percentile_approx("size", F.array(*map(F.lit, steps)), 10_000)).first()[0]
    return sum((F.when(F.col("size") > e, 1).otherwise(0) for e in sorted(set(cuts or []))), F.lit(0)).cast("int")


def curve_order(docs: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, size, text_crc32, key, curve, *carried): narrow rows, written once."""
    text = F.coalesce("text", F.lit(""))
    base = durable(
        docs.select(
            "doc_id",
            (F.coalesce(utf8_bytes(F.col("text")), F.lit(0)) + 1).cast("long").alias("size"),
            unsigned_crc32(F.col("text")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.col("lang").alias("lang"),
            F.col("source").alias("source"),
            *carried,
        )
    )
    levelled = base
    for name in ("lang", "source"):
        levelled = levelled.join(sized_broadcast(_name_levels(base, name)), F.col(name).eqNullSafe(F.col(f"of_{name}")))
    both = (F.col("lang_level") * (1 << BITS) + F.col("source_level")).alias("both")
    levelled = durable(levelled.select("doc_id", "size", "text_crc32", "key", both, *carried))
    least = levelled.groupBy("key", "size").agg(F.min("both").alias("least"), F.max("both").alias("most"))
    mixed = durable(least.filter("least <> most").select("key", "size", "least"))
    joined = levelled.join(sized_broadcast(mixed), ["key", "size"], "left")
    place = F.coalesce("least", "both")
    levels = F.array(F.shiftright(place, BITS), place.bitwiseAND((1 << BITS) - 1), _size_level(base))
    return joined.select("doc_id", "size", "text_crc32", "key", _curve_index(levels).alias("curve"), *carried)


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows and bytes before each row within its partition."""
    rows = size = 0
    for batch in batches:
        sizes = batch["size"].to_numpy()
        total = np.cumsum(sizes)
        yield batch.assign(row=np.arange(rows, rows + len(batch)), start=size + total - sizes)
        rows += len(batch)
        size += int(total[-1]) if len(batch) else 0


def shards(docs: DataFrame, count: int = SHARDS, carried: str = "") -> DataFrame:
    """(doc_id, size, text_crc32, curve, shard, slot) for each row of ``docs`` (doc_id, text, lang, source).

    ``carried`` may name a column of whole numbers that goes along.
    """
    spark = docs.sparkSession
    columns = "doc_id long, size long, text_crc32 long, key long, curve long" + f", {carried} long" * bool(carried)
    extra = [carried] * bool(carried)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = curve_order(docs, *extra).repartitionByRange(n, "curve", "key", "doc_id").sortWithinPartitions("curve", "key", "doc_id", "size")
    summed = durable(ranged.mapInPandas(_running, columns + ", row long, start long").withColumn("part", F.spark_partition_id()))
    parts = sorted((r["part"], r["n"], r["bytes"]) for r in summed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect())
    offsets, rows, size = {}, 0, 0
    for part, part_rows, part_bytes in parts:
        offsets[part] = (rows, size)
        rows, size = rows + part_rows, size + part_bytes
    known = spark.createDataFrame([(p, r, s) for p, (r, s) in offsets.items()], "part int, r long, s long")
    placed = summed.join(F.broadcast(known), "part").select("doc_id", "size", "text_crc32", "key", "curve", *extra, (F.col("row") + F.col("r")).alias("row"), (F.col("start") + F.col("s")).alias("start"))
    # cuts: the row that holds each share's end, moved to the nearer end of its group if that is near
    wanted = [size * k // count for k in range(1, count)]
    holds = [(F.col("start") <= w) & (F.col("start") + F.col("size") > w) for w in wanted]
    held = placed.filter(reduce(or_, holds)).select("curve", "key", "size", "start", "row").collect() if holds else []
    cuts = []
    if held:
        same = reduce(or_, [(F.col("curve") == r["curve"]) & (F.col("key") == r["key"]) & (F.col("size") == r["size"]) for r in held])
        ends = {(r["curve"], r["key"], r["size"]): r for r in placed.filter(same).groupBy("curve", "key", "size").agg(F.min("start").alias("a"), F.max(F.col("start") + F.col("size")).alias("b"), F.min("row").alias("row"), F.count(F.lit(1)).alias("n")).collect()}
        for w in wanted:
            r = next(x for x in held if x["start"] <= w < x["start"] + x["size"])
            group = ends[r["curve"], r["key"], r["size"]]
            whole = min((group["a"], group["row"]), (group["b"], group["row"] + group["n"]), key=lambda e: abs(e[0] - w))
            apart = min((r["start"], r["row"]), (r["start"] + r["size"], r["row"] + 1), key=lambda e: abs(e[0] - w))
            cuts.append((whole if abs(whole[0] - w) <= BALANCE * size / count else apart)[1])
    cuts = sorted(cuts)
    shard = sum((F.when(F.col("row") >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    first = F.element_at(F.array(*[F.lit(c).cast("long") for c in [0, *cuts]]), F.col("shard") + 1)
    return placed.withColumn("shard", shard).select("doc_id", "size", "text_crc32", "curve", "shard", (F.col("row") - first).alias("slot"), *extra)


def write_shards(docs: DataFrame, path: str, count: int = SHARDS, files: int = 8) -> None:
    """``docs`` with shard and slot as Parquet, a folder for each shard, sorted along the curve.

    Rows are numbered and written once before, so rows without doc_id and rows that repeat one keep their own places.
    """
    numbered = durable(docs.drop("shard", "slot", "curve").withColumn("_row", F.monotonically_increasing_id()))
    places = shards(numbered, count, "_row").select("_row", "shard", "slot", "curve")
    joined = numbered.join(places, "_row").drop("_row")
    joined.repartitionByRange(count * files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op1_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    found = shards(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
