import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqloom.llm import swap_packing as P
from tests.llm.conftest import EDGE_ROWS, prose

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(P.default_vocabulary())


def test_encoder_equals_the_tokenizer(tokenizer):
    encode = P.encoder(P.default_vocabulary())
    r = random.Random(5)
    texts = ["", " ", "a.b, c. d,", "x's don't", "İstanbul ΣΑΣ ẞ ﬁ é Á H̱", "<|endoftext|> x<|startoftext|>", "中文 テスト \U0001f600", "a\x1cb\x85c d", prose(1, 300)]
    texts += ["".join(chr(r.choice([r.randrange(9, 127), r.randrange(0xA0, 0x250), r.randrange(0x300, 0x380)])) for _ in range(120)) for _ in range(60)]
    for t in texts:
        want = np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode(t) == want, t


def test_pieces_of_edge_rows(spark, edge_docs, no_docs, tokenizer):
    rows = P.packed_documents(edge_docs).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, text, _, _ in EDGE_ROWS:
        if doc in (None, 7):
            continue
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // P.SEQ)))
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    assert len(by_doc[7]) == 2 and len(by_doc[None]) == 2
    assert P.packed_documents(no_docs).count() == 0
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= P.SEQ


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_packing_is_a_partition_within_bounds(lengths):
    bins = P.best_fit(lengths, 100)
    searched = P.local_search(bins, lengths, 100)
    for found in (bins, searched):
        assert sorted(i for b in found for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in found)
    assert len(searched) <= len(bins)


def slow_best_fit(lengths, seq):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(seq - n)
    return sorted(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_best_fit_and_the_end_of_the_search_by_brute_force(lengths):
    bins = P.best_fit(lengths, 100)
    assert sorted(100 - sum(lengths[i] for i in b) for b in bins) == slow_best_fit(lengths, 100)
    done = P.local_search(bins, lengths, 100)
    fill = [sum(lengths[i] for i in b) for b in done]
    if len(done) == -(-sum(lengths) // 100) or sum(100 - f for f in fill if f < 100) < 100:
        return
    for source, own in enumerate(done):  # no move or exchange to a bin that is as full or fuller is left
        for to, other in enumerate(done):
            if source == to or fill[source] == 100 or fill[to] < fill[source]:
                continue
            for i in own:
                for back in [(), *((j,) for j in other), *itertools.combinations(other, 2)]:
                    carried = lengths[i] - sum(lengths[j] for j in back)
                    assert carried <= 0 or carried > 100 - fill[to]


def test_local_search_empties_bins_by_every_change():
    # a move, a one-for-one and a two-for-one exchange each save a bin
    move = ([[0], [1]], [60, 40])
    swap = ([[0, 1], [2, 3], [4]], [50, 40, 50, 40, 20])
    pair = ([[0, 1, 2], [3, 4]], [30, 30, 20, 10, 10])
    for bins, lengths in (move, swap, pair):
        assert len(P.local_search(bins, lengths, 100)) == -(-sum(lengths) // 100)
    r = random.Random(1)
    big = [r.randrange(300, 550) for _ in range(400)]
    fit = P.best_fit(big, 1000)
    assert len(P.local_search(fit, big, 1000)) < len(fit)


def test_groups_cost_few_sequences(spark, monkeypatch):
    r = random.Random(2)
    rows = [(i, 0, 0, r.randint(1, 2048), 0) for i in range(3000)]
    cut = spark.createDataFrame(rows, P._PIECES)
    packed = P.pack(P.durable(cut), group_rows=500)
    assert packed.count() == len(rows)
    used = packed.select("sequence_id").distinct().count()
    assert used <= 1.03 * sum(x[3] for x in rows) / P.SEQ
