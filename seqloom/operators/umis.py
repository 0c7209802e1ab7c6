"""UMIs that sequencing errors have split: networks of near UMIs at each place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators.align import umi_collapse
from seqloom.sources.scratch import Table

PLACE = ("sample_id", "place")
#: Most UMIs of a place that one task settles, and UMIs that it links at a time, about.
LARGE_PLACE = 20_000
BATCH_LINKS = 50_000
SETTLED = "sample_id string, place string, umi string, qname string, umis long, reads long"


def umi_links(nodes: DataFrame) -> DataFrame:
    """(sample_id, place, a, b): UMIs one mismatch apart of which a may have given rise to b.

    ``nodes`` is (sample_id, place, umi, reads). a leads to b if it has at least 2 n - 1 reads for b's n.
    Two UMIs are one mismatch apart exactly if they are equal with one base masked, so each UMI is
    listed under all of its maskings. Only UMIs that differ in that base meet under one: a handful,
    however many UMIs a place has.
    """
    umi = F.col("umi")
    masked = F.transform(F.sequence(F.lit(1), F.length(umi)), lambda i: F.concat(umi.substr(F.lit(1), i - 1), F.lit("*"), umi.substr(i + 1, F.length(umi))))
    met = nodes.filter(F.length(umi) > 0).select(*PLACE, F.struct("umi", "reads").alias("own"), F.explode(masked).alias("masked"))
    met = met.groupBy(*PLACE, "masked").agg(F.collect_list("own").alias("all")).filter(F.size("all") > 1)
    pairs = met.select(*PLACE, "all", F.explode("all").alias("a")).select(*PLACE, "a", F.explode("all").alias("b"))
    led = pairs.filter("a.umi <> b.umi and a.reads >= 2 * b.reads - 1")
    return led.select(*PLACE, F.col("a.umi").alias("a"), F.col("b.umi").alias("b"), F.col("a.reads").alias("reads_a"), F.col("b.reads").alias("reads_b"))


def _ids(*keys: np.ndarray) -> np.ndarray:
    """Rows that agree in all of ``keys`` have one number from 0, less than their count."""
    out = np.zeros(len(keys[0]), np.int64)
    for key in keys:
        one, other = (np.unique(k, return_inverse=True)[1] for k in (out, key))
        out = np.unique(one * len(out) + other, return_inverse=True)[1]
    return out


def _links(place: np.ndarray, umis: np.ndarray, reads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of different UMIs one mismatch apart at one place, of which a leads to b; as ``umi_links``."""
    bases = umis.view(np.uint32).reshape(len(umis), -1)
    width = bases.shape[1]
    left, right = [_ids(place, np.char.str_len(umis))], [np.zeros(len(umis), np.int64)]
    for k in range(width - 1):
        left.append(_ids(left[-1], bases[:, k]))
        right.append(_ids(right[-1], bases[:, width - 1 - k]))
    found = []
    for k in range(width):  # what stands before the masked base and after it
        masked = left[k] * len(umis) + right[width - 1 - k]
        order = np.argsort(masked, kind="stable")
        masked, step = masked[order], 1
        while (met := np.flatnonzero(masked[step:] == masked[:-step])).size:
            found.append((order[met], order[met + step]))
            step += 1
    one, other = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
    a, b = np.concatenate([one, other]), np.concatenate([other, one])
    leads = reads[a] >= 2 * reads[b] - 1
    return a[leads], b[leads]


def _tops(place: np.ndarray, umis: np.ndarray, reads: np.ndarray) -> np.ndarray:
    """For each row the row of the strongest UMI that leads to it, itself included; rows of a place are in the order of UMIs.

    Strengths pass along all links at once, and on to what their owners lead to, until nothing changes.
    """
    by_strength = np.argsort(-reads, kind="stable")
    rank = np.empty(len(reads), np.int64)
    rank[by_strength] = np.arange(len(reads))
    a, b = (rank[x] for x in _links(place, umis, reads))
    top = np.arange(len(reads))
    while True:
        now = top.copy()
        np.minimum.at(now, b, top[a])
        now = np.minimum(now, now[now])
        if (now == top).all():
            return by_strength[top[rank]]
        top = now


def _starts(nodes: pa.Table) -> np.ndarray:
    """Whether each row begins a place."""
    new = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False) for c in map(nodes.column, PLACE)]
    return np.concatenate([[True], new[0] | new[1]])


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """UMIs of whole places, one place after another and in order, to the networks of each."""

    def solve(nodes: pa.Table) -> list[pa.RecordBatch]:
        reads = nodes.column("reads").to_numpy()
        top = _tops(np.cumsum(_starts(nodes)), nodes.column("umi").to_numpy().astype(np.str_), reads)
        umis, total = np.bincount(top, minlength=len(top)), np.zeros(len(top), np.int64)
        np.add.at(total, top, reads)
        tops = np.flatnonzero(umis)
        own = nodes.select([*PLACE, "umi", "qname"]).take(tops)
        return own.append_column("umis", pa.array(umis[tops], pa.int64())).append_column("reads", pa.array(total[tops])).to_batches()

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= BATCH_LINKS:
            nodes = pa.Table.from_batches(held).combine_chunks()
            whole = int(np.flatnonzero(_starts(nodes))[-1])  # the last place may go on in the next batch
            if whole:
                yield from solve(nodes.slice(0, whole).combine_chunks())
            held = nodes.slice(whole).to_batches()
    if sum(map(len, held)):
        yield from solve(pa.Table.from_batches(held).combine_chunks())


def settled_places(nodes: DataFrame) -> DataFrame:
    """The networks of places that are small enough for a task, many at a time in numpy; after one shuffle by place."""
    rows = nodes.select(*PLACE, "umi", "qname", "reads").repartition(*PLACE).sortWithinPartitions(*PLACE, "umi")
    return rows.mapInArrow(_settled, SETTLED)


def tops_by_rounds(links: DataFrame) -> DataFrame:
    """(sample_id, place, umi, top): for each linked UMI the strongest one that leads to it, itself included.

    Stronger is more reads, then the first in order. All places at once: in each round a UMI takes the best of its own top, its top's top and the tops
    of those that lead to it, so paths shorten by half or more. The rounds end when nothing changes;
    each is a table that replaces the one before."""

    def strength(reads: str, umi: str) -> Column:
        return F.struct((-F.col(reads)).alias("n"), F.col(umi).alias("umi"))

    kept = Table(links)
    ends = [kept.df.select(*PLACE, F.col(u).alias("umi"), strength(n, u).alias("top")) for u, n in (("a", "reads_a"), ("b", "reads_b"))]
    tops = Table(ends[0].unionByName(ends[1]).distinct().withColumn("was", F.lit(None).cast("struct<n:bigint,umi:string>")))
    while tops.df.filter("was is null or top <> was").limit(1).count():
        now = tops.df.select(*PLACE, "umi", "top")
        above = now.select(*PLACE, F.col("umi").alias("a"), "top")
        led = kept.df.select(*PLACE, "a", F.col("b").alias("umi")).join(above, [*PLACE, "a"]).select(*PLACE, "umi", "top")
        jumped = now.select(*PLACE, "umi", F.col("top.umi").alias("a")).join(above, [*PLACE, "a"]).select(*PLACE, "umi", "top")
        every = now.withColumn("was", F.col("top")).unionByName(led.unionByName(jumped), allowMissingColumns=True)
        after = Table(every.groupBy(*PLACE, "umi").agg(F.min("top").alias("top"), F.max("was").alias("was")))
        tops.drop()
        tops = after
    kept.drop()
    return tops.df.select(*PLACE, "umi", F.col("top.umi").alias("top"))


def networks_by_rounds(nodes: DataFrame) -> DataFrame:
    """The networks of places that are too large for a task, by joins."""
    tops = tops_by_rounds(umi_links(nodes))
    named = nodes.join(tops, [*PLACE, "umi"], "left").withColumn("top", F.coalesce("top", "umi"))
    out = named.groupBy(*PLACE, "top").agg(F.min(F.when(F.col("umi") == F.col("top"), F.col("qname"))).alias("qname"), F.count(F.lit(1)).alias("umis"), F.sum("reads").alias("reads"))
    return out.withColumnRenamed("top", "umi")


def umi_network(aln: DataFrame, by: str = "coordinate", features: Column | None = None, large: int = LARGE_PLACE) -> DataFrame:
    """One read per (sample, place, network of UMIs): (sample_id, place, umi, qname, umis, reads).

    UMIs of a place are joined by the directional rule: a leads to b if they differ in one base and a
    has at least 2 n - 1 reads for b's n, and a UMI belongs to the strongest one that leads to it
    over any number of steps. umi is that one, qname its first name; umis and reads count what it stands for.
    Reads without a UMI are a group of their own. Places of up to ``large`` UMIs are settled in numpy,
    larger ones by rounds of joins, so that none gathers in one task. ``by`` and ``features`` as in ``umi_collapse``.
    """
    nodes = Table(umi_collapse(aln, by, features)).df
    named = "sample_id is not null and place is not null and umi is not null"
    alone = nodes.filter(f"not ({named})").select(*PLACE, "umi", "qname", F.lit(1).cast("long").alias("umis"), "reads")
    placed = nodes.filter(named)
    over = Table(placed.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > large).select(*PLACE)).df
    if not over.limit(1).count():
        return settled_places(placed).unionByName(alone)
    small = settled_places(placed.join(over, list(PLACE), "left_anti"))
    return small.unionByName(networks_by_rounds(placed.join(over, list(PLACE), "left_semi"))).unionByName(alone)
