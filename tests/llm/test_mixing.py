import re

from seqloom.llm import mixing as M
from tests.llm.conftest import EDGE_ROWS, make_docs


def slow_targets(sizes, weights=(5, 2, 1), budget=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, free = budget * sum(sizes.values()), {}, set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_follow_repeated_resharing(spark):
    for sizes in ({"a": 100, "b": 5, "c": 900, "d": 0, None: 40}, {"x": 7}, {f"s{i}": (i * 37) % 101 for i in range(20)}, {"z": 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in M.targets(df).collect()}
        want = slow_targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 for s in want), (got, want)


def test_mixed_edge_rows(spark, edge_docs, no_docs):
    rows = M.mixed(edge_docs).collect()
    assert len(rows) == len(EDGE_ROWS)
    sizes = {}
    for _, text, _, source in EDGE_ROWS:
        sizes[source] = sizes.get(source, 0) + words(text)
    want = slow_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 2
        if want[r["source"]] == 2 * sizes[r["source"]] > 0:
            assert r["copies"] == 2
    assert M.mixed(no_docs).count() == 0


def test_emit_agrees_with_copies_and_reruns(spark, edge_docs, no_docs):
    docs = make_docs(spark, [(i, "w " * (i % 50 + 1), "en", f"s{i % 7}") for i in range(700)])
    copies = {r["doc_id"]: r["copies"] for r in M.mixed(docs).collect()}
    emitted = M.emit(docs)
    assert emitted.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in emitted.groupBy("doc_id").count().collect()}
    assert counts == {d: c for d, c in copies.items() if c}
    assert M.emit(edge_docs).columns == edge_docs.columns and M.emit(no_docs).count() == 0
    per = {}
    for r in M.mixed(docs).collect():
        t = per.setdefault(r["source"], [0, r["target"]])
        t[0] += r["size"] * r["copies"]
    assert all(abs(n - t) < 0.15 * t for n, t in per.values())
