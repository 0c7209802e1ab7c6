"""Near-duplicate linking of SimHash fingerprints through segment popcounts.

A 64-bit fingerprint is cut into 32 segments of two bits, and each segment is mapped to its
popcount. The Manhattan distance of two such vectors is never more than the Hamming distance
of the fingerprints, so vectors further apart than the radius can be passed over. The vector is
kept in unary (0 -> 00, 1 -> 01, 2 -> 11), so one XOR and popcount give the Manhattan distance.

Grid: the 32 coordinates form six groups. Within a radius of two, vectors differ in at most two
coordinates' worth of distance, so they agree on at least four whole groups: every choice of four
groups names one grid cell, and all pairs within the radius meet in some cell. Candidates of a
cell pass the Manhattan bound and then the exact Hamming test; a cell gives only the links of a
spanning forest. A cell with more than ``CELL_ROWS`` fingerprints (thousands of near copies) is
linked through one-bit neighbourhoods instead: two fingerprints are within two bits exactly if
they share a word at one bit or less from both, and such a word has at most 65 members.

Rules: null, empty or blank texts have fingerprint zero and are linked like others; repeated rows
with one doc_id are one document; rows without doc_id get a null component; columns other than
``doc_id`` and ``text`` are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from seqloom.llm.common import durable, sized_broadcast, text_batches, written

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Coordinates (two-bit segments) per group; four of the six groups name a cell.
GROUPS = (6, 5, 5, 6, 5, 5)
CELL_ROWS = 256
_VOTE_ROWS = 1 << 16


def fingerprint(text: str | None) -> int:
    """The signed 64-bit SimHash of the word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) < SHINGLE:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: -SHINGLE + 1], ends[SHINGLE - 1 :]
    digest = xxhash.xxh64_digest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), _VOTE_ROWS):
        found = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _VOTE_ROWS].tolist(), ends[at : at + _VOTE_ROWS].tolist(), strict=True)])
        votes += np.unpackbits(np.frombuffer(found, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(starts)).tobytes(), "big", signed=True)


@F.pandas_udf(LongType())
def fingerprint_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(word: int) -> int:
    return word - (1 << 64) if word >= 1 << 63 else word


def popcount_embedding(fp: Column) -> Column:
    """The popcounts of the 32 two-bit segments, each in unary in its own two bits."""
    odd, half = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    both = fp.bitwiseAND(half).bitwiseAND(odd)
    either = fp.bitwiseOR(half).bitwiseAND(odd)
    return F.shiftleft(both, 1).bitwiseOR(either)


def cell_masks() -> list[int]:
    """Masks of the coordinates that name a cell, one for each choice of four groups."""
    masks, at = [], 0
    for width in GROUPS:
        masks.append(((1 << 2 * width) - 1) << 2 * at)
        at += width
    whole = (1 << 64) - 1
    return [_signed(whole & ~(masks[i] | masks[j])) for i in range(len(masks)) for j in range(i + 1, len(masks))]


def _cell_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning links of the fingerprints in each cell."""
    odd = np.uint64(0x5555555555555555)
    one = np.uint64(1)
    for batch in batches:
        out: list[tuple[int, int]] = []
        for members in batch["members"]:
            ids = [m["node"] for m in members]
            x = np.array([m["fp"] for m in members], np.int64).view(np.uint64)
            unary = (((x & (x >> one)) & odd) << one) | ((x | (x >> one)) & odd)
            top = list(range(len(ids)))

            def root(i: int, top: list[int] = top) -> int:
                while top[i] != i:
                    top[i] = top[top[i]]
                    i = top[i]
                return i

            near = np.bitwise_count(unary[:, None] ^ unary[None, :]) <= RADIUS
            a, b = np.nonzero(np.triu(near, 1))
            exact = np.bitwise_count(x[a] ^ x[b]) <= RADIUS
            for i, j in zip(a[exact].tolist(), b[exact].tolist(), strict=True):
                if (r := root(i)) != (s := root(j)):
                    top[s] = r
                    out.append((ids[i], ids[j]))
        yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) whose closure is that of all pairs of ``nodes`` (fp, node) within the radius.

    ``nodes`` has each fingerprint once.
    """
    embedded = nodes.select("node", "fp", popcount_embedding(F.col("fp")).alias("counts"))
    cells = [F.struct(F.lit(i).alias("way"), F.col("counts").bitwiseAND(F.lit(mask)).alias("cell")) for i, mask in enumerate(cell_masks())]
    keys = embedded.select("node", "fp", F.explode(F.array(*cells)).alias("at")).select("node", "fp", "at.way", "at.cell")
    shared = durable(keys.groupBy("way", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    met = keys.join(sized_broadcast(shared), ["way", "cell"])
    found = (
        met.filter(F.col("n") <= CELL_ROWS)
        .groupBy("way", "cell")
        .agg(F.collect_list(F.struct("node", "fp")).alias("members"))
        .select("members")
        .mapInPandas(_cell_links, "a long, b long")
    )
    if shared.filter(F.col("n") > CELL_ROWS).limit(1).count():
        full = met.filter(F.col("n") > CELL_ROWS).select("node", "fp").distinct()
        flips = F.concat(F.array(F.col("fp")), F.array(*[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]))
        balls = full.select("node", F.explode(flips).alias("ball")).groupBy("ball").agg(F.min("node").alias("a"), F.collect_list("node").alias("all")).filter(F.size("all") > 1)
        found = found.unionByName(balls.select("a", F.explode("all").alias("b")).filter("a <> b").distinct())
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node that it reaches.

    Alternates large-star and small-star steps, each a grouped minimum joined back to the edges,
    until the edges stay the same. Minima are written before the join, so that Spark may split a
    hot node's edges.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    big, small = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = written(edges.filter("a <> b").select(big, small).distinct())
    before = None
    while (now := mark(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = written(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = written(large.groupBy("u").agg(F.min("v").alias("m")))
        stars = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(stars.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fp (signed long) and component_id."""
    text_batches(docs.sparkSession)
    base = durable(docs.select("doc_id", fingerprint_udf("text").alias("fp")))
    nodes = durable(base.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    same_doc = base.filter("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high").select("doc_id")
    edges = links(nodes)
    if same_doc.limit(1).count():  # a doc_id on rows with different texts joins their fingerprints
        shared = base.join(same_doc, "doc_id").join(nodes, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
        edges = edges.unionByName(shared)
    roots = components(edges)
    named = durable(nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id")))
    return base.join(named, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, linked: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """``docs`` with the document of the smallest doc_id of each component of ``linked``; other columns stay.

    Rows without doc_id stay; of rows that repeat a doc_id one stays.
    """
    found = durable(linked(docs))
    gone = durable(found.filter("doc_id <> component_id").select("doc_id").distinct())
    kept = docs.join(sized_broadcast(gone), "doc_id", "left_anti").select(*docs.columns)
    repeated = found.filter("doc_id = component_id").groupBy("doc_id").count().filter("count > 1").limit(1).count()
    if not repeated:
        return kept
    nameless = kept.filter("doc_id is null")
    return kept.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(nameless)


def op7_simhash_segments(spark, sf_dir: str) -> DataFrame:
    from seqloom.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")
