import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from seqloom.llm import suffix_repeats as S
from tests.llm.conftest import EDGE_ROWS, make_docs


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text, by a table of all its strings."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 2, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        kept = bytes(b for b, g in zip(r, gone[1:-1], strict=True) if not g)
        out.append((len(r), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def result(spark, texts, **how):
    df = S.without_repeats(make_docs(spark, [(k, t, "en", "s") for k, t in enumerate(texts)]), **how)
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r["doc_id"])]


def tangled(seed, n, alphabet="ab"):
    """Texts of few letters, runs and shared pieces."""
    r = random.Random(seed)
    parts = ["".join(r.choice(alphabet) for _ in range(r.randint(5, 60))) for _ in range(8)] + ["a" * 40, "ab" * 25]
    return ["".join(r.choice(parts) if r.random() < 0.5 else "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 40))) for _ in range(r.randint(0, 8))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("group", [1024, 3])
def test_all_repeats_as_by_brute_force(spark, seed, group):
    texts = tangled(seed, 60)
    assert result(spark, texts, length=24, gram=6, group=group) == brute(texts, 24)


def test_hot_passage_in_many_surroundings(spark):
    """One passage in every text: its anchors have as many contexts as there are texts."""
    r = random.Random(5)
    word = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    passage = word(90)
    texts = [word(r.randint(0, 50)) + passage[r.randint(0, 5) :] + word(r.randint(0, 50)) for _ in range(80)]
    want = brute(texts, 40)
    assert result(spark, texts, length=40, gram=8, group=10) == want
    assert result(spark, texts, length=40, gram=8, group=1024) == want


@pytest.mark.parametrize("gram", [1, 5, 8, 32])
def test_anchors_are_the_least_hashes_of_all_windows(gram):
    rng = np.random.default_rng(gram)
    texts = [bytes(rng.integers(97, 100, n, np.uint8)) for n in (0, 39, 40, 41, 500, 3000)]
    length = 40
    want = []
    for k, t in enumerate(texts):
        hashes = S.gram_hashes(np.frombuffer(t, np.uint8), gram) >> np.uint64(20)
        want += [(k, w, int(np.argmin(hashes[w : w + length - gram + 1])) + w) for w in range(len(t) - length + 1)]
    for piece in (S.PIECE, 700):
        old, S.PIECE = S.PIECE, piece
        try:
            got = [(i, w, p) for k, _, place, first, last in S.text_anchors(texts, length, gram) for i, p, a, b in zip(k.tolist(), place.tolist(), first.tolist(), last.tolist(), strict=True) for w in range(a, b + 1)]
        finally:
            S.PIECE = old
        assert got == want


def test_equal_grams_have_equal_hashes():
    data = np.frombuffer(b"xabcdefghabcdefgh", np.uint8)
    for gram in (1, 2, 3, 5, 7, 8):
        h = S.gram_hashes(data, gram)
        assert len(h) == len(data) - gram + 1 and h[1] == h[9] and len(set(h.tolist())) == len({bytes(data[i : i + gram]) for i in range(len(h))})


@pytest.mark.parametrize("seed", range(5))
def test_prefix_boundaries_of_the_transform(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, 4, 300).astype(np.int32)
    text[100:180] = text[10:90]
    text[::60] = 0
    depth = 20
    order = S.sorted_rotations(text, 2, depth)
    rotations = [tuple(np.roll(text, -i)[:depth]) for i in order.tolist()]
    assert rotations == sorted(rotations)
    known = S.common_prefix_reached(text[order - 1], 2, depth)
    assert known[1:-1].tolist() == [a != b for a, b in zip(rotations, rotations[1:], strict=False)]


def test_odd_rows_and_empty_tables(spark, no_docs):
    docs = make_docs(spark, EDGE_ROWS)
    got = sorted((tuple(r) for r in S.without_repeats(docs).collect()), key=repr)
    assert got == sorted(((i, *x) for (i, *_), x in zip(EDGE_ROWS, brute([r[1] for r in EDGE_ROWS], 200), strict=True)), key=repr)
    assert S.without_repeats(no_docs).collect() == []


def test_repeats_within_a_long_text(spark):
    r = random.Random(1)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    a, b = word(250), word(199)
    texts = [word(300_000) + a + word(400_000) + a + b + word(1000) + b, word(100) + b, a[1:201], "é" * 150]
    (n, removed, spans, _), *rest = result(spark, texts)
    assert (n, removed, spans) == (len(texts[0]), 500, 2)
    assert [x[1:3] for x in rest] == [(0, 0), (200, 1), (300, 1)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query_on_the_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: x for r, x in zip(rows, brute([r["text"] for r in rows], 200), strict=True)}
    assert {r["doc_id"]: tuple(r)[1:] for r in S.op11_suffix_repeats(spark, sf).collect()} == want
