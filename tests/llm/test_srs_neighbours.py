import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import srs_neighbours as N

SCHEMA = "vec_id long, vec array<float>, cell int, score double"


def brute(ids, x, asks, k=5):
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in sorted({i for i in ids if asks(i)}):
        at = ids.index(q)
        best = {}
        for i, v, n in zip(ids, x, norm, strict=True):
            if i != q:
                best[i] = max(best.get(i, -2), float((v * x[at]).sum() / (n * norm[at])))
        out[q] = sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k]
    return out


def test_chi2_quantile():
    # published values
    assert abs(N.chi2_quantile(0.95, 2) - 5.991) < 1e-3 and abs(N.chi2_quantile(0.95, 8) - 15.507) < 1e-3 and abs(N.chi2_quantile(0.99, 8) - 20.090) < 1e-3


@pytest.mark.parametrize("cell_rows, query_rows", [(8192, 4096), (100, 7)])
def test_recall_and_scores(spark, monkeypatch, cell_rows, query_rows):
    monkeypatch.setattr(N, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(N, "QUERY_ROWS", query_rows)
    r = np.random.default_rng(3)
    centres = r.normal(size=(12, 32))
    x = (centres[r.integers(0, 12, 3000)] + 0.4 * r.normal(size=(3000, 32))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0, 0.0) for i, v in enumerate(x)], SCHEMA)
    got = {}
    for row in N.neighbours(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    want = brute(list(range(3000)), x.astype(np.float64), lambda i: i % 50 == 0)
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for own in got.values():
        assert [k for k, _, _ in sorted(own)] == [1, 2, 3, 4, 5]
        s = [(-score, v) for _, v, score in sorted(own)]
        assert s == sorted(s)
    for q, own in got.items():
        a = x[q].astype(np.float64)
        for _, v, score in own:
            b = x[v].astype(np.float64)
            assert abs(score - (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())) < 1e-14


def test_ties_copies_and_unfit_rows(spark):
    same = [1.0, 2.0, 0.0]
    rows = [(i, same, 0, 0.0) for i in range(100, 160)]
    rows += [(0, [0.0, 1.0, 0.0], 0, 0.0), (1, [0.0, 3.0, 0.0], 0, 0.0), (2, None, 0, 0.0), (50, [0.0, 0.0, 0.0], 0, 0.0), (3, [float("nan"), 1.0, 1.0], 0, 0.0)]
    rows += [(200, [1.0], 0, 0.0), (None, same, 0, 0.0), (4, [None, 1.0, 1.0], 0, 0.0), (150, same, 0, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in N.neighbours(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert got[100] == {1: 101, 2: 102, 3: 103, 4: 104, 5: 105}
    assert got[150] == {1: 100, 2: 101, 3: 102, 4: 103, 5: 104}
    assert got[0][1] == 1 and set(got) == {0, 100, 150}
    few = spark.createDataFrame([(0, [1.0, 0.0], 0, 0.0), (7, [1.0, 1.0], 0, 0.0)], SCHEMA)
    assert [(r["rank"], r["vec_id"]) for r in N.neighbours(few, F.col("vec_id") % 50 == 0).collect()] == [(1, 7)]
    assert N.neighbours(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_lengths_meet_their_own_and_may_be_great(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=n).tolist(), 0, 0.0) for i, n in enumerate([3] * 40 + [2] * 20 + [200_000] * 3)]
    rows[50] = (50, [1.0, 0.0], 0, 0.0)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for row in N.neighbours(df, F.col("vec_id").isin(0, 50, 60)).collect():
        got.setdefault(row["query_id"], []).append(row["vec_id"])
    for q, own in got.items():
        like = [x for x in rows if len(x[1]) == len(rows[q][1])]
        want = brute([x[0] for x in like], np.array([x[1] for x in like], np.float32).astype(np.float64), lambda i, q=q: i == q)
        assert own == [v for v, _ in want[q]]
    assert set(got) == {0, 50, 60} and sorted(got[60]) == [61, 62]


def test_one_vector_on_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        df = spark.range(0, 3000, 1, 16).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.col("id").cast("double"), F.lit(1.0))).alias("vec"))
        kept = {r["node"]: r["ids"] for r in N.once(df.withColumn("asks", F.lit(True)), 6).collect()}
        assert kept[0] == [0, 3, 6, 9, 12, 15] and len(kept) == 2001 and kept[2999] == [2999]
        got = [r["vec_id"] for r in N.neighbours(df, F.col("vec_id") == 2400).orderBy("rank").collect()]
        assert got == [0, 3, 6, 9, 12]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_the_search_of_a_block_verifies_a_part(spark):
    import pandas as pd

    r = np.random.default_rng(9)
    x = r.normal(size=(6000, 64))
    data = pd.DataFrame({"vec": list(x), "ids": [[i] for i in range(len(x))], "node": range(len(x))})
    queries = pd.DataFrame({"qkey": range(100), "vec": list(x[:100]), "bound": 4.0})
    verified = []
    found = N.search_block(data, queries, 6, verified)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = np.argsort(-(unit[:100] @ unit.T), axis=1)[:, :6]
    hits = sum(ids[0] in want[q] for q, ids, _ in found)
    assert hits >= 0.9 * want.size and sum(verified) < 0.6 * 100 * len(x)
    near = r.normal(size=(60, 64))[r.integers(0, 60, 6000)] + 0.3 * x  # groups of near vectors stop far sooner
    queries = pd.DataFrame({"qkey": range(100), "vec": list(near[:100]), "bound": 4.0})
    verified.clear()
    assert len(N.search_block(data.assign(vec=list(near)), queries, 6, verified)) == 600
    assert sum(verified) < 0.05 * 100 * len(x)
