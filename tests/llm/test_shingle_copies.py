import random

import numpy as np
import pytest

import corpus_pipeline as P
from seqloom.llm import shingle_copies as C
from tests.llm.conftest import EDGE_ROWS, make_docs, prose


def slow_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def slow_components(texts):
    sets = [slow_set(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    return root


def near_texts(seed):
    """Texts with copies that differ in some words, short and long, in chains and in a crowd."""
    r = random.Random(seed)
    texts = []
    for k in range(40):
        words = prose(seed * 1000 + k, r.choice([3, 6, 9, 20, 60, 150, 400])).split()
        texts.append(" ".join(words))
        for _ in range(r.randint(0, 4)):
            words = list(words)
            for _ in range(r.randint(1, 1 + len(words) // 60)):
                words[r.randrange(len(words))] = f"w{r.random()}"
            texts.append(" ".join(words[: len(words) - r.randint(0, len(words) // 20)]))
    crowd = prose(seed, 100).split()
    for k in range(30):
        own = list(crowd)
        own[r.randrange(100)] = f"x{k}"
        texts.append(" ".join(own + [f"y{k}"] * r.randint(0, 12)))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_stage_equals_brute_force_jaccard(spark, seed):
    texts = near_texts(seed)
    want = slow_components(texts)
    assert len(set(want)) < len(set(texts)) - 20
    docs = make_docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["component_id"] for r in C.near_copies(docs).collect()}
    assert got == dict(enumerate(want))
    kept = P.drop_near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_similar_sets_share_a_key():
    r = np.random.default_rng(5)
    tried = 0
    for _ in range(4000):
        n = int(r.integers(1, 120))
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        gone = int(r.integers(0, n // 5 + 1))
        b = np.unique(np.concatenate([a[r.permutation(n)[gone:]], r.integers(0, 1 << 63, int(r.integers(0, n // 4 + 1))).astype(np.uint64)]))
        frequent = np.unique(r.choice(a, len(a) // 2))
        times = r.integers(1, 9, len(frequent))
        if C.similar(a, b):
            tried += 1
            assert np.intersect1d(C.keys(a), C.keys(b)).size
            assert np.intersect1d(C.keys(a, frequent, times), C.keys(b, frequent, times)).size
    assert tried > 500


def test_edge_rows(spark, edge_docs, no_docs):
    got = C.near_copies(edge_docs)
    assert got.count() == len(EDGE_ROWS)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, None: None}
    assert C.near_copies(no_docs).count() == 0


def test_blocks_and_rounds_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "HUBS", 0)
    monkeypatch.setattr(C, "BLOCK", 3)
    monkeypatch.setattr(C, "_PAIRS", 8)
    texts = near_texts(3)[::2]
    docs = make_docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["component_id"] for r in C.near_copies(docs).collect()}
    assert got == dict(enumerate(slow_components(texts)))
