import random
import re

import numpy as np
import pytest
import xxhash

from seqloom.llm import simhash_segments as S
from tests.llm.conftest import EDGE_ROWS, make_docs, prose


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def slow_components(ids, fps, radius=2):
    top = list(range(len(ids)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if ids[i] == ids[j] or bin(fps[i] ^ fps[j]).count("1") <= radius:
                top[root(i)] = root(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(ids[i])
    return {d: min(g) for g in groups.values() for d in g}


def test_fingerprint_follows_the_definition():
    for text in [None, "", "  ", "One", "one two", "A b C d", "x y z w v", prose(1), prose(2, 500), "É é A"]:
        assert S.fingerprint(text) & (1 << 64) - 1 == slow_fingerprint(text)


def test_embedding_is_a_lower_bound(spark):
    r = random.Random(3)
    words = [r.getrandbits(64) for _ in range(50)] + [0, (1 << 64) - 1]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(S._signed(w),) for w in words], "fp long")
    got = [row[0] & (1 << 64) - 1 for row in df.select(S.popcount_embedding(F.col("fp"))).collect()]
    for w, u in zip(words, got, strict=True):
        assert [bin(u >> k & 3).count("1") for k in range(0, 64, 2)] == [bin(w >> k & 3).count("1") for k in range(0, 64, 2)]
    for a, x in zip(words, got, strict=True):
        for b, y in zip(words, got, strict=True):
            assert bin(x ^ y).count("1") <= bin(a ^ b).count("1")


@pytest.mark.parametrize("cell_rows", [256, 3])
def test_components_equal_brute_force(spark, monkeypatch, cell_rows):
    """Planted words within and just beyond the radius, in chains and crowds; small cells take the other way."""
    monkeypatch.setattr(S, "CELL_ROWS", cell_rows)
    r = random.Random(cell_rows)
    fps = []
    for _ in range(25):
        w = r.getrandbits(64)
        fps.append(w)
        for _ in range(r.randint(0, 6)):
            w ^= sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 2, 3])))
            fps.append(w)
    crowd = r.getrandbits(64)
    fps += [crowd ^ (1 << b) for b in range(20)]
    fps = list(dict.fromkeys(fps))
    r.shuffle(fps)
    nodes = spark.createDataFrame([(S._signed(w), i) for i, w in enumerate(fps)], "fp long, node long")
    roots = {x["node"]: x["root"] for x in S.components(S.links(nodes)).collect()}
    want = slow_components(range(len(fps)), fps)
    assert {i: roots.get(i, i) for i in range(len(fps))} == want


def test_near_duplicates_of_edge_rows(spark, edge_docs, no_docs):
    got = S.near_duplicates(edge_docs)
    assert got.count() == len(EDGE_ROWS)
    rows = {r["doc_id"]: r for r in got.filter("doc_id is not null").collect()}
    assert {d: rows[d]["component_id"] for d in (1, 2, 3)} == {1: 1, 2: 1, 3: 1}  # fingerprint zero is linked like any other
    assert rows[7]["component_id"] == 6
    assert {r["component_id"] for r in got.filter("doc_id is null").collect()} == {None}
    assert S.near_duplicates(no_docs).count() == 0


def test_keep_one_keeps_columns_and_one_of_each(spark, edge_docs, no_docs):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect())
    assert ids == [1, 4, 5, 6, 8]
    assert kept.filter("doc_id is null").count() == 2
    assert S.keep_one(no_docs).count() == 0


def test_near_duplicates_equal_brute_force_on_texts(spark):
    texts = []
    for k in range(30):
        base = prose(k, 120).split()
        texts.append(" ".join(base))
        if k % 3 == 0:
            texts.append(" ".join(base[:-1] + ["changed"]))
        if k % 5 == 0:
            texts.append(" ".join(base).upper())
    docs = make_docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(docs).collect()}
    assert got == slow_components(range(len(texts)), [slow_fingerprint(t) for t in texts])
    assert np.unique(list(got.values())).size < len(texts)
