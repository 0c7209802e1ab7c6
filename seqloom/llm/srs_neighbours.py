"""Approximate nearest neighbours through a few stable projections and a kd-tree.

Unit vectors are projected to ``DIMS`` Gaussian (2-stable) coordinates: the squared projected
distance of two vectors, divided by their squared true distance, follows a chi-square law with
``DIMS`` degrees of freedom. Projected neighbours are taken in order of growing distance and
verified on the original vectors; once nothing left is nearer in projection than r, the search of
a query ends if r^2 >= chi2_quantile(CONFIDENCE) * d_k^2, as each true neighbour would have come by
then with that probability.

A kd-tree fitted on a bounded sample of the projections (``SAMPLE`` vectors) cuts the space into
cells of about ``CELL_ROWS`` vectors; every vector is indexed in its cell, and an overfull cell is
split by hash into blocks. A query first visits its own cell; the distances found there decide
which other cells the same chi-square test leaves open, and only those are visited. A visited cell's
queries are dealt by hash into chunks, so a group is one block of data and one chunk of queries,
both of bounded rows and values. In a group, only projected neighbours within the test's limit are
verified, nearest first, and the limit shrinks with each better neighbour.

Equal vectors are kept once, with as many of their smallest ids as can ever be returned, so a
vector that a third of all rows share costs one candidate. Nothing grows on the driver: the sample,
the cells and their counts are bounded.

Rules: null, zero and non-finite vectors take no part; so do rows without vec_id; vectors of
different lengths have no cosine, so each meets those of its own length, and lengths other than the
commonest have one cell; rows that repeat a vec_id count as one id; ties go to the smaller vec_id;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import durable, sized_broadcast, table

K = 5
DIMS = 24
CONFIDENCE = 0.95
SAMPLE = 20_000
CELL_ROWS = 8192
MAX_CELLS = 4096
#: Most queries of a group, and most numbers of its data, of its queries and of a table of projected distances.
QUERY_ROWS, VALUES = 4096, 1 << 21
#: Projected neighbours that are verified before the first stopping test; each further step takes twice as many.
FIRST = 64
SEED = 20


def chi2_quantile(q: float, dims: int) -> float:
    """The quantile of the chi-square law with an even number of degrees of freedom."""

    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < q else (low, mid)
    return high


def projection(length: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((length, DIMS))


def _rows(length: int, most: int) -> int:
    """Rows of vectors of ``length`` numbers in a group, at most."""
    return max(1, min(most, VALUES // length))


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Cells:
    """A kd-tree over sampled projections: half-space cells that cover the whole space."""

    def __init__(self, points: np.ndarray, cells: int):
        self.splits: list[tuple[int, float, int, int]] = []  # dimension, value, left, right; ~cell for leaves
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        dims = points.shape[1]
        self.root = self._grow(points, np.full(dims, -np.inf), np.full(dims, np.inf), max(0, math.ceil(math.log2(max(1, cells)))))
        self.lows, self.highs = np.array(self.low), np.array(self.high)

    def _grow(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
        spread = np.ptp(points, axis=0) if len(points) > 1 else np.zeros(len(low))
        d = int(np.argmax(spread))
        if not depth or not spread[d]:
            self.low.append(low)
            self.high.append(high)
            return ~(len(self.low) - 1)
        at = float(np.median(points[:, d]))
        left = points[:, d] < at
        if not left.any():
            at = float(points[points[:, d] > at, d].min())
            left = points[:, d] < at
        here = len(self.splits)
        self.splits.append((d, at, 0, 0))
        below, above = high.copy(), low.copy()
        below[d] = above[d] = at
        self.splits[here] = (d, at, self._grow(points[left], low, below, depth - 1), self._grow(points[~left], above, high, depth - 1))
        return here

    def __len__(self) -> int:
        return len(self.low)

    def find(self, points: np.ndarray) -> np.ndarray:
        node = np.full(len(points), self.root)
        while (going := np.nonzero(node >= 0)[0]).size:
            for n in np.unique(node[going]):
                d, at, left, right = self.splits[n]
                own = going[node[going] == n]
                node[own] = np.where(points[own, d] < at, left, right)
        return ~node

    def gap2(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each cell."""
        below = np.maximum(self.lows[None] - points[:, None], 0)
        above = np.maximum(points[:, None] - self.highs[None], 0)
        return (below**2 + above**2).sum(axis=2)


def _nearest(gap: np.ndarray, similarity, k: int, worst: float) -> tuple[np.ndarray, int]:
    """The rows of a query's nearest vectors, and how many were verified.

    gap: squared projected distances (used up); similarity: cosines of given rows; worst: squared
    distance that the k-th nearest is known not to exceed.
    """
    limit = chi2_quantile(CONFIDENCE, DIMS)
    rows, score, seen, step = np.zeros(0, np.int64), np.zeros(0), 0, FIRST
    order = np.argpartition(gap, FIRST)[:FIRST] if len(gap) > FIRST else np.arange(len(gap))
    while True:
        own = order[:step]
        own = own[gap[own] <= limit * worst]
        if not own.size:  # nothing left is near enough in projection
            return rows, seen
        seen += own.size
        rows, score = np.concatenate([rows, own]), np.concatenate([score, similarity(own)])
        best = np.lexsort((rows, -score))[:k]
        rows, score = rows[best], score[best]
        if len(rows) == k:
            worst = min(worst, max(0.0, 2 - 2 * float(score[-1])))
        if step == FIRST:  # those that the nearest ones leave open, in order
            gap[order] = np.inf
            order = np.nonzero(gap <= limit * worst)[0]
            order = order[np.argsort(gap[order], kind="stable")]
        else:
            order = order[step:]
        step *= 2


def search_block(data: pd.DataFrame, queries: pd.DataFrame, k: int, verified: list[int] | None = None) -> list[tuple]:
    """(qkey, ids, score) of each query's nearest verified vectors in one block.

    ``verified`` gets the number of vectors that were verified for each query.
    """
    if data.empty or queries.empty:
        return []
    data = data.sort_values("node", ignore_index=True)
    raw, asked = _matrix(data["vec"]), _matrix(queries["vec"])
    norm, q_norm = (np.sqrt((x * x).sum(axis=1)) for x in (raw, asked))
    g = projection(raw.shape[1])
    points, places = (raw / norm[:, None]) @ g, (asked / q_norm[:, None]) @ g
    square = (points * points).sum(axis=1)
    out: list[tuple] = []
    stride = max(1, VALUES // len(raw))
    for start in range(0, len(asked), stride):
        p = places[start : start + stride]
        gaps = (p * p).sum(axis=1)[:, None] + square[None] - 2 * (p @ points.T)
        for j, gap in enumerate(gaps, start):
            rows, seen = _nearest(gap, lambda own, j=j: (raw[own] @ asked[j]) / (norm[own] * q_norm[j]), k, float(queries["bound"].iat[j]))
            exact = (raw[rows] * asked[j]).sum(axis=1) / (norm[rows] * q_norm[j])
            out += [(queries["qkey"].iat[j], data["ids"].iat[rows[i]], float(exact[i])) for i in np.lexsort((rows, -exact))]
            if verified is not None:
                verified.append(seen)
    return out


def _vector(values) -> np.ndarray | None:
    """The vector, if it takes part."""
    v = np.asarray(values, np.float64) if values is not None else np.zeros(0)
    return v + 0.0 if len(v) and np.isfinite(v).all() and v.any() else None


def _key(v: np.ndarray) -> bytes:
    return hashlib.blake2b(v.tobytes(), digest_size=16).digest()


def _distinct(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Vectors that take part, once per batch, with their ``k`` smallest ids and whether one asks."""
    for batch in batches:
        found: dict[bytes, list] = {}
        for vec_id, vec, asks in zip(batch["vec_id"], batch["vec"], batch["asks"], strict=True):
            if (v := _vector(vec)) is not None:
                own = found.setdefault(_key(v), [set(), v, False])
                own[0].add(int(vec_id))
                own[2] |= bool(asks)
        yield pd.DataFrame([(key, v, sorted(ids)[:k], asks) for key, (ids, v, asks) in found.items()], columns=["key", "vec", "ids", "asks"])


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(int(i), _key(v)) for i, values in zip(batch["vec_id"], batch["vec"], strict=True) if (v := _vector(values)) is not None]
        yield pd.DataFrame(rows, columns=["query_id", "key"])


def _least(df: DataFrame, by: str, *order, keep: int) -> DataFrame:
    """The first ``keep`` rows of each ``by``, numbered r; tasks limit theirs before the shuffle, and sorts may spill."""
    return df.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("r") <= keep)


def once(rows: DataFrame, keep: int) -> DataFrame:
    """(key, vec, asks, ids, node, n): each different vector of ``rows`` with its ``keep`` smallest ids."""
    found = durable(rows.mapInPandas(lambda it: _distinct(it, keep), "key binary, vec array<double>, ids array<long>, asks boolean"))
    vectors = found.groupBy("key").agg(F.first("vec").alias("vec"), F.max("asks").alias("asks"))
    named = _least(found.select("key", F.explode("ids").alias("id")).distinct(), "key", "id", keep=keep)
    ids = named.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return durable(vectors.join(ids, "key").withColumn("node", F.col("ids")[0]).withColumn("n", F.size("vec")))


def neighbours(vectors: DataFrame, asks, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows of ``vectors`` (vec_id, vec) where ``asks`` holds."""
    spark = vectors.sparkSession
    rows = vectors.filter("vec_id is not null and vec is not null").select("vec_id", "vec", asks.alias("asks"))
    keep = k + 1  # a query passes over itself
    merged = once(rows, keep)
    lengths = {r["n"]: r["count"] for r in merged.groupBy("n").count().collect()}
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    common = max(lengths, key=lambda n: (lengths[n], n))
    share = min(1.0, 1.2 * SAMPLE / lengths[common])
    sample = merged.filter((F.col("n") == common) & (F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)).select("vec").limit(SAMPLE)
    points = _matrix([r["vec"] for r in sample.collect()] or [np.ones(common)])
    cells = Cells(_unit(points) @ projection(common), min(MAX_CELLS, max(1, round(lengths[common] / CELL_ROWS))))
    shared = spark.sparkContext.broadcast(cells)
    limit = chi2_quantile(CONFIDENCE, DIMS)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = projection(common)
        for batch in batches:
            cell, own = np.zeros(len(batch), np.int64), np.nonzero(batch["n"] == common)[0]
            if own.size:
                cell[own] = shared.value.find(_unit(_matrix(batch["vec"].iloc[own])) @ g)
            yield batch.assign(cell=cell)

    placed = durable(merged.mapInPandas(place, "key binary, vec array<double>, asks boolean, ids array<long>, node long, n int, cell long"))
    sizes = {(r["n"], r["cell"]): r["count"] for r in placed.groupBy("n", "cell").count().collect()}

    def open_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The other cells that the bound leaves open to each query."""
        g = projection(common)
        for batch in batches:
            found: list[list[int]] = [[] for _ in range(len(batch))]
            own = np.nonzero(batch["n"] == common)[0]
            for a in range(0, len(own), 64):
                at = own[a : a + 64]
                near = shared.value.gap2(_unit(_matrix(batch["vec"].iloc[at])) @ g) <= limit * batch["bound"].to_numpy()[at, None]
                for j, row in zip(at.tolist(), near, strict=True):
                    found[j] = [c for c in np.nonzero(row)[0].tolist() if c != batch["cell"].iat[j] and (common, c) in sizes]
            yield batch.drop(columns="cell").assign(cells=found)

    def block(_, data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(search_block(data, queries, keep), columns=["qkey", "ids", "score"])

    def search(visits: DataFrame) -> DataFrame:
        """The nearest in each cell of ``visits`` (qkey, vec, bound, n, cells), block by block and chunk by chunk."""
        visits = durable(visits).toDF(*visits.columns)  # columns apart from those of the data
        asked = visits.select("qkey", "vec", "bound", "n", F.explode("cells").alias("cell"))
        counts = asked.groupBy("n", "cell").count().collect()
        dealt = [(r["n"], r["cell"], -(-sizes[r["n"], r["cell"]] // _rows(r["n"], 2 * CELL_ROWS)), -(-r["count"] // _rows(r["n"], QUERY_ROWS))) for r in counts]
        plan = F.broadcast(spark.createDataFrame(dealt, "n int, cell long, parts int, chunks int"))  # a row for each cell

        def every(most: str):
            return F.explode(F.sequence(F.lit(0), F.col(most) - 1))

        data = placed.join(plan, ["n", "cell"]).select("vec", "ids", "node", "n", "cell", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), every("chunks").alias("chunk"))
        queries = asked.join(plan, ["n", "cell"]).select("qkey", "vec", "bound", "n", "cell", F.pmod(F.xxhash64("qkey"), F.col("chunks")).cast("int").alias("chunk"), every("parts").alias("part"))
        group = ["n", "cell", "part", "chunk"]
        return durable(data.groupBy(*group).cogroup(queries.groupBy(*group)).applyInPandas(block, "qkey long, ids array<long>, score double"))

    asked = placed.filter("asks").select(F.col("node").alias("qkey"), "vec", "n", "cell")
    near = search(asked.select("qkey", "vec", F.lit(4.0).alias("bound"), "n", F.array("cell").alias("cells")))
    nth = _least(near, "qkey", F.desc("score"), keep=keep).filter(F.col("r") == keep)
    bounds = nth.select("qkey", F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("bound"))
    bounded = asked.join(bounds, "qkey", "left").select("qkey", "vec", F.coalesce("bound", F.lit(4.0)).alias("bound"), "n", "cell")
    rest = search(bounded.mapInPandas(open_cells, "qkey long, vec array<double>, bound double, n int, cells array<long>"))
    every = near.unionByName(rest).select("qkey", "score", F.explode("ids").alias("vec_id"))
    best = _least(every, "qkey", F.desc("score"), "vec_id", keep=keep)
    lists = best.groupBy("qkey").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
    lists = durable(lists.join(placed.filter("asks").select(F.col("node").alias("qkey"), "key"), "qkey").select("key", "found"))
    queries = rows.filter("asks").mapInPandas(_keys, "query_id long, key binary").distinct()
    own = queries.join(sized_broadcast(lists), "key")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("pos", "hit"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def op5_srs_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return neighbours(vectors, F.col("vec_id") % 50 == 0)
