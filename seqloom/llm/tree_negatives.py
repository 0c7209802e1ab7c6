"""Hard negatives of anchors, found along a spanning tree of the anchors.

A score is the inner product of two whole-number vectors. For anchors p and c and a candidate x,
<c, x> = <p, x> + <c - p, x>, so c's score lies within |c - p| |x| of p's. Anchors are laid in
blocks of near ones; each block's tree is the least spanning tree of its vectors and the zero
vector, whose scores are all zero. The tree is walked from there: every candidate has bounds at
every anchor, its parent's widened by the edge, and exact scores only where the bounds reach what
the anchor is looking for. First that is its best candidates of the same label (its positives),
then the windows of scores below each positive.

Chunks of candidates meet blocks of anchors in a grid of groups of bounded size; each cell keeps
the first few of each anchor, and the cells' lists are merged. Nothing is broadcast.

Rules: a component x counts as floor(256 * x). Rows with a null label, a null id or vector, a null
or non-finite component, or one of 2**26 or more once multiplied (whose scores might not fit a
long), take no part. Vectors shorter than the longest end in zeros. Rows that repeat an id are rows
of their own, but never partners of one another. Extra columns are left alone; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import in_order, table, text_batches, written

SCALE = 256
LARGEST = 1 << 26
POSITIVES = 5
NEGATIVES = 5
#: Percent of a positive's score that a negative's reaches at least.
LEAST_PERCENT = 80
#: Anchors of a block, candidates of a chunk, and chunks that meet a block in one group.
BLOCK = 1024
CHUNK = 2048
CHUNKS = 64
#: Hyperplanes whose sides say which anchors are near.
PLANES = 12
SEED = 12


def whole_vectors(vectors: DataFrame, vector: str, label: Column) -> DataFrame:
    """(id, label, v): rows that take part, with components as whole numbers."""
    scaled = F.transform(vector, lambda x: F.floor(SCALE * x.cast("double")))
    fit = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LARGEST / SCALE), F.lit(False)))
    return vectors.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & fit).select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), scaled.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``width``, short ones ended by zeros."""
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width), np.int32)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _packed(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, label, v) to chunks (first, ids, labels, vectors)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
                yield pa.RecordBatch.from_pydict({"first": ids[:1], "ids": [ids.tobytes()], "labels": [labels.tobytes()], "vectors": [_matrix(part.column(2), width).tobytes()]})

    return work


def near_key(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, label, v) with the sides of fixed hyperplanes as one number, in Gray-code order."""
    planes = np.random.default_rng(SEED).standard_normal((width, PLANES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (_matrix(batch.column(2), width) @ planes > 0).astype(np.int64)
            binary = np.bitwise_xor.accumulate(sides, axis=1)
            yield batch.append_column("near", pa.array(binary @ (1 << np.arange(PLANES)[::-1])))

    return work


# --- one block of anchors against one chunk of candidates -----------------------------------------


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(anchor, parent, edge length) of the least spanning tree of the rows and zero, parents first and depth first; the parent of zero's neighbours is -1."""
    n = len(vectors)
    x = vectors.astype(np.float64)
    square = (x * x).sum(axis=1)
    distance, parent = square.copy(), np.full(n, -1)
    children: dict[int, list[int]] = {}
    for _ in range(n):
        nearest = int(np.argmin(distance))
        children.setdefault(int(parent[nearest]), []).append(nearest)
        distance[nearest] = np.inf
        fresh = square + square[nearest] - 2 * (x @ x[nearest])
        closer = (fresh < distance) & np.isfinite(distance)
        distance[closer], parent[closer] = fresh[closer], nearest
    out, todo = [], [(c, -1) for c in reversed(children.get(-1, []))]
    while todo:
        anchor, above = todo.pop()
        away = x[anchor] - (x[above] if above >= 0 else 0)
        out.append((anchor, above, float(np.sqrt(away @ away))))
        todo += [(c, anchor) for c in reversed(children.get(anchor, []))]
    return out


def walk(tree: list[tuple[int, int, float]], anchors: np.ndarray, candidates: np.ndarray, wanted: Callable, found: Callable) -> int:
    """Call ``found(anchor, rows, scores)`` with the exact scores of the candidates whose bounds at an anchor are ``wanted``.

    wanted(anchor, low, high) -> a mask of the candidates. Returns how many scores were computed.
    """
    x, a = candidates.astype(np.float64), anchors.astype(np.float64)
    norms = np.sqrt((x * x).sum(axis=1))
    exact = np.abs(a).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] < 2**53
    long_x, long_a = candidates.astype(np.int64), anchors.astype(np.int64)
    last = {above: k for k, (_, above, _) in enumerate(tree)}
    bounds = {-1: (np.zeros(len(x)), np.zeros(len(x)))}
    scored = 0
    for k, (anchor, above, edge) in enumerate(tree):
        reach = norms * (edge * (1 + 1e-9)) + 1e-6
        low, high = bounds[above][0] - reach, bounds[above][1] + reach
        if last[above] == k:
            del bounds[above]
        rows = np.flatnonzero(wanted(anchor, low, high))
        if len(rows):
            scores = (x[rows] @ a[anchor]).astype(np.int64) if exact else long_x[rows] @ long_a[anchor]
            scored += len(rows)
            low[rows] = high[rows] = scores
            found(anchor, rows, scores)
        if anchor in last:
            bounds[anchor] = low, high
    return scored


class Firsts:
    """The first ``k`` (score, id) of each of some lists: higher scores first, ties by smaller id."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64)] * lists
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * lists
        #: A list takes no score below this.
        self.least = np.full(lists, -np.inf)

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        near = scores >= self.least[at]
        scores, ids = np.concatenate([self.scores[at], scores[near]]), np.concatenate([self.ids[at], ids[near]])
        if len(scores) > self.k:
            if len(scores) > 8 * self.k:
                kept = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
                scores, ids = scores[kept], ids[kept]
            first = np.lexsort((ids, -scores))[: self.k]
            scores, ids = scores[first], ids[first]
        self.scores[at], self.ids[at] = scores, ids
        if len(scores) == self.k:
            self.least[at] = scores.min()


def _chunks(cells: pa.Table, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for ids, labels, vectors in zip(cells["ids"].to_pylist(), cells["labels"].to_pylist(), cells["vectors"].to_pylist(), strict=True):
        yield np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), np.frombuffer(vectors, np.int32).reshape(-1, width)


def _anchors(block: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    block = block.sort_by("place").combine_chunks()
    v = block["v"]
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
    return block["place"].to_numpy(), block["id"].to_numpy(), block["label"].to_numpy(), _matrix(v, width)


POSITIVE_ROWS = "place long, id long, label long, v array<long>, positive_id long, positive_score long"


def _positives(width: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(cells: pa.Table, block: pa.Table) -> pa.Table:
        names, kinds = ["place", "positive_id", "positive_score"], pa.schema([(c, pa.int64()) for c in ("place", "positive_id", "positive_score")])
        if not (cells.num_rows and block.num_rows):
            return kinds.empty_table()
        place, ids, labels, vectors = _anchors(block, width)
        tree, best = spanning_tree(vectors), Firsts(len(ids), k)
        for x_ids, x_labels, x in _chunks(cells, width):
            walk(
                tree,
                vectors,
                x,
                lambda a, low, high, x_ids=x_ids, x_labels=x_labels: (high >= best.least[a]) & (x_labels == labels[a]) & (x_ids != ids[a]),
                lambda a, rows, scores, x_ids=x_ids: best.add(a, scores, x_ids[rows]),
            )
        n = list(map(len, best.ids))
        return pa.Table.from_arrays([pa.array(np.repeat(place, n)), pa.array(np.concatenate(best.ids)), pa.array(np.concatenate(best.scores))], names)

    return work


def _negatives(width: int, k: int, percent: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(cells: pa.Table, block: pa.Table) -> pa.Table:
        kinds = pa.schema([(c, pa.int64()) for c in ("place", "nth", "negative_id", "negative_score")])
        if not (cells.num_rows and block.num_rows):
            return kinds.empty_table()
        place, ids, labels, vectors = _anchors(block, width)
        wide = block.sort_by("place")
        tops = [np.array(p, np.int64) for p in wide["positives"].to_pylist()]
        starts = np.concatenate([[0], np.cumsum([len(t) for t in tops])])
        top = np.concatenate(tops)
        # whole scores n with percent * p <= 100 * n <= 100 * p
        window = np.where(top >= 0, -(-percent * top // 100), top + 1)
        tree, best = spanning_tree(vectors), Firsts(len(top), k)
        best.least = window.astype(np.float64)
        for x_ids, x_labels, x in _chunks(cells, width):

            def wanted(a: int, low: np.ndarray, high: np.ndarray, x_ids: np.ndarray = x_ids, x_labels: np.ndarray = x_labels) -> np.ndarray:
                inside = np.zeros(len(low), bool)
                for w in range(starts[a], starts[a + 1]):
                    inside |= (high >= best.least[w]) & (low <= top[w])
                return inside & (x_labels != labels[a]) & (x_ids != ids[a])

            def found(a: int, rows: np.ndarray, scores: np.ndarray, x_ids: np.ndarray = x_ids) -> None:
                for w in range(starts[a], starts[a + 1]):
                    within = (scores <= top[w]) & (scores >= window[w])
                    if within.any():
                        best.add(w, scores[within], x_ids[rows[within]])

            walk(tree, vectors, x, wanted, found)
        n = np.array(list(map(len, best.ids)), np.int64)
        nth = np.concatenate([np.arange(len(t)) for t in tops])
        columns = [np.repeat(np.repeat(place, np.diff(starts)), n), np.repeat(nth, n), np.concatenate(best.ids), np.concatenate(best.scores)]
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in columns], kinds.names)

    return work


def _first(df: DataFrame, by: list[str], score: str, name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(name))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, label: Column | None = None, vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = LEAST_PERCENT, block: int = BLOCK
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, label and ``vector``; ``anchor`` is a condition on its rows, ``label`` an
    expression for the label, if not the column itself.
    """
    text_batches(vectors.sparkSession)
    label = F.col("label") if label is None else label
    rows = whole_vectors(vectors, vector, label)
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    chunks = written(rows.mapInArrow(_packed(width), "first long, ids binary, labels binary, vectors binary").withColumn("chunk", F.monotonically_increasing_id()))
    own = whole_vectors(vectors.filter(anchor), vector, label).mapInArrow(near_key(width), "id long, label long, v array<long>, near long")
    placed = written(in_order(own, F.asc("near"), F.asc("id")).withColumn("block", F.floor((F.col("place") - 1) / block)))
    n = placed.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    parts = -(-chunks.count() // CHUNKS)
    # every chunk meets every block: block b and part c of the chunks are one group
    part = F.pmod(F.xxhash64("chunk"), F.lit(parts)).alias("part")
    cells = chunks.select("ids", "labels", "vectors", part, F.explode(F.sequence(F.lit(0).cast("long"), F.lit((n - 1) // block).cast("long"))).alias("block"))

    def met(anchors: DataFrame, work: Callable, schema: str) -> DataFrame:
        each = anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return cells.groupBy("block", "part").cogroup(each.groupBy("block", "part")).applyInArrow(work, schema)

    best = met(placed, _positives(width, positives), "place long, positive_id long, positive_score long")
    first = written(_first(best, ["place"], "positive_score", "positive_id", positives).withColumn("nth", F.col("rank").cast("long") - 1).drop("rank"))
    lists = first.groupBy("place").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))), lambda p: p["positive_score"]).alias("positives"))
    found = met(placed.join(lists, "place"), _negatives(width, negatives, percent), "place long, nth long, negative_id long, negative_score long")
    ranked = _first(found, ["place", "nth"], "negative_score", "negative_id", negatives)
    return (
        ranked.join(first, ["place", "nth"])
        .join(placed.select("place", F.col("id").alias("anchor_id")), "place")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op12_tree_negatives(spark, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label = x.label AS same, x.vec_id AS other, list_dot_product(a.v, x.v)::BIGINT AS score FROM whole AS a JOIN whole AS x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS rank, n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positives AS p JOIN scored AS n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""
