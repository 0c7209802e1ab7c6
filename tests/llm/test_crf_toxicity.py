import itertools
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest

from seqloom.llm import crf_toxicity as C
from tests.llm.conftest import EDGE_ROWS, make_docs, prose


def slow_marginals(emit, trans, start):
    n, p, total = len(emit), np.zeros(len(emit)), 0.0
    for tags in itertools.product((0, 1), repeat=n):
        score = start[tags[0]] + sum(e for e, y in zip(emit, tags, strict=True) if y) + sum(trans[a, b] for a, b in itertools.pairwise(tags))
        total += np.exp(score)
        p += np.exp(score) * np.array(tags)
    return p / total


def test_marginals_equal_enumeration():
    r = np.random.default_rng(1)
    trans, start = r.normal(size=(2, 2)), r.normal(size=2)
    lengths = [1, 2, 7, 3, 9, 1]
    emits = [r.normal(size=n) * 2 for n in lengths]
    first = np.concatenate([[True] + [False] * (n - 1) for n in lengths])
    got = C.marginals(np.concatenate(emits), first, trans, start)
    want = np.concatenate([slow_marginals(e, trans, start) for e in emits])
    assert np.allclose(got, want, atol=1e-9)
    long = r.normal(size=20_000)
    whole = C.marginals(long, np.arange(20_000) == 0, trans, start)
    assert np.isfinite(whole).all() and ((whole >= 0) & (whole <= 1)).all()
    assert len(C.marginals(np.zeros(0), np.zeros(0, bool), trans, start)) == 0


def labelled(n=600):
    r = random.Random(9)
    bad = ["idiot", "moron", "schlimm", "schlimmer", "schlimmste"]
    rows, labels = [], []
    for i in range(n):
        words = prose(i, r.randint(5, 80)).split()
        toxic = i % 4 == 0
        for _ in range(r.randint(1, 4) if toxic else 0):
            words.insert(r.randrange(len(words) + 1), r.choice(bad).upper() + r.choice(["", ",", "!"]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_spans(spark):
    rows, labels = labelled()
    docs, known = make_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    score = C.scorer(C.fit(docs, known), spark)
    out = docs.select("doc_id", "text", score("text").alias("t")).collect()
    truth = dict(labels)
    aside = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(aside) > 80
    right = sum((r["t"]["score"] >= 0.5) == truth[r["doc_id"]] for r in aside)
    assert right >= 0.97 * len(aside)
    found = [[r["text"][s["start"] : s["end"]].lower() for s in r["t"]["spans"]] for r in aside if truth[r["doc_id"]] and r["t"]["score"] >= 0.5]
    planted = [[any(b in f for b in ("idiot", "moron", "schlimm")) for f in own] for own in found]
    assert sum(map(any, planted)) >= 0.95 * len(found)
    assert sum(map(sum, planted)) >= 0.85 * sum(map(len, planted))
    clean = C.keep_clean(docs, known)
    assert clean.columns == docs.columns and clean.count() < len(rows)


def test_held_out_labels_are_not_learned_from(spark):
    rows, labels = labelled(200)
    aside = [(d, 1 - y) if zlib.crc32(str(d).encode()) % 5 == 0 else (d, y) for d, y in labels]
    docs = make_docs(spark, rows)
    a, b = (C.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, aside))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.curve, b.curve)


def test_edge_rows(spark, edge_docs, no_docs):
    rows, labels = labelled(200)
    tagger = C.fit(make_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    score = C.scorer(tagger, spark)
    got = edge_docs.select("doc_id", score("text").alias("t")).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r["t"]["score"] <= 1 for r in got)
    empty = {round(r["t"]["score"], 12) for r, e in zip(got, EDGE_ROWS, strict=True) if not (e[1] or "").strip()}
    assert len(empty) == 1
    assert no_docs.select(score("text")).count() == 0
    # labels of one kind or none: a constant score
    for known, want in (([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (None, 1), (3, None)], 0.0)):
        flat = C.scorer(C.fit(edge_docs, spark.createDataFrame(known, "doc_id long, toxic int")), spark)
        assert {r[0]["score"] for r in edge_docs.select(flat("text")).collect()} == {want}
    assert C.keep_clean(no_docs, spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_segments_and_slices_change_nothing(monkeypatch):
    r = np.random.default_rng(4)
    trans, start, emit = r.normal(size=(2, 2)), r.normal(size=2), 3 * r.normal(size=5000)
    first = r.random(5000) < 0.01
    want = C.marginals(emit, first, trans, start)
    monkeypatch.setattr(C, "SEGMENT", 333)
    assert np.allclose(C.marginals(emit, first, trans, start), want, atol=1e-9)
    tagger = C.Tagger(r.normal(size=C.SLOTS).astype(np.float32), trans, start, np.ones(6))
    texts = [None, "", "  ", "Eins  zwei\tdrei!", prose(3, 400), prose(4, 30) + " \x0b", "w" * 300, prose(5, 900)]
    whole = list(C.tag(tagger, texts))
    monkeypatch.setattr(C, "CHUNK", 100)
    for (a, p), (b, q) in zip(whole, C.tag(tagger, texts), strict=True):
        assert np.allclose(a, b) and np.allclose(p, q, atol=1e-9)


def test_likelihood_grows_and_gradient_is_its_slope():
    r = np.random.default_rng(2)
    x = r.integers(0, 20, (6, C.WINDOW)).astype(np.int32)
    x[0, 5:] = -1
    y = ((r.random(x.shape) < 0.3) & (x >= 0)).astype(np.int8)
    score, trans, start = r.normal(size=20), r.normal(size=(2, 2)), r.normal(size=2)
    by_word, by_trans, by_start, base = C._gradient(x, y, score, trans, start)
    d = 1e-6
    for k in range(20):
        up = score.copy()
        up[k] += d
        assert abs((C._gradient(x, y, up, trans, start)[3] - base) / d - by_word[k]) < 1e-3
    for at in np.ndindex(2, 2):
        up = trans.copy()
        up[at] += d
        assert abs((C._gradient(x, y, score, up, start)[3] - base) / d - by_trans[at]) < 1e-3
    up = start + [0, d]
    assert abs((C._gradient(x, y, score, trans, up)[3] - base) / d - by_start[1]) < 1e-3


def test_repeated_ids_and_labels_that_disagree(spark, monkeypatch):
    rows, labels = labelled(200)
    once = C.fit(make_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    again = C.fit(make_docs(spark, rows + rows[::2]).repartition(7), spark.createDataFrame(labels + [(d, 0) for d, _ in labels], "doc_id long, toxic int"))
    assert np.array_equal(once.weights, again.weights) and np.array_equal(once.curve, again.curve)  # toxic, if any label says so
    texts = make_docs(spark, rows + [(d, "other " + t, a, b) for d, t, a, b in rows])
    x, y = (C.fit(t, spark.createDataFrame(labels, "doc_id long, toxic int")) for t in (texts, texts.repartition(5)))
    assert np.array_equal(x.weights, y.weights)
    monkeypatch.setattr(C, "CLASS_BYTES", 2000)  # documents that do not fit are passed over whole
    assert np.isfinite(C.fit(make_docs(spark, [*rows, (1000, "x" * 5000, "en", "s")]), spark.createDataFrame([*labels, (1000, 1)], "doc_id long, toxic int")).curve).all()


PEAK = """
import resource, sys, numpy as np
from seqloom.llm import crf_toxicity as C
tagger = C.Tagger(np.random.default_rng(0).normal(size=C.SLOTS).astype(np.float32), np.eye(2), np.zeros(2), np.ones(6))
text = ("the quick brown fox jumps over it " * (int(sys.argv[1]) * 31000))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
[(found, p)] = C.tag(tagger, [text])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""


@pytest.mark.parametrize("mb, most", [(16, 250), (64, 600)])
def test_peak_memory_of_long_texts(mb, most):
    said = subprocess.run([sys.executable, "-c", PEAK, str(mb)], capture_output=True, text=True, check=True)
    assert int(said.stdout) < most
