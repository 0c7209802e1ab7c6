import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from seqloom.llm import target_resampling as R
from tests.llm.conftest import EDGE_ROWS, make_docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    return words, [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def brute(docs, target, percent=10, least_words=20, longest=1, seed=2024):
    """(doc_id, n_features, weight, score, rank) by sorting all documents."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    of = [features(t, longest) for _, t in docs]
    source, wanted = Counter(bucket(f) for _, fs in of for f in fs), Counter(bucket(f) for t in target for f in features(t, longest)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((source[b] + 1) * (t + 10_000))))
    rows = []
    for k, ((i, _), (words, fs)) in enumerate(zip(docs, of, strict=True)):
        weight = sum(map(gain, map(bucket, fs))) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words), k])
    able = sorted((r for r in rows if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {r[5]: n for n, r in enumerate(able[: percent * len(able) // 100], 1)}
    return Counter((*r[:4], rank.get(r[5])) for r in rows)


def drawn(spark, docs, target, **how):
    out = R.resample(make_docs(spark, [(i, t, "en", "s") for i, t in docs]), spark.createDataFrame([(t, 1) for t in target], "text string, rank long"), **how)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return Counter(tuple(r) for r in out.collect())


@pytest.mark.parametrize("longest", [1, 3])
def test_as_brute_force(spark, longest, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 50)
    docs = [(k, prose(k % 90, 5 + k % 40)) for k in range(300)]
    target = [prose(k, 50) for k in range(5)]
    assert drawn(spark, docs, target, longest=longest, percent=35) == brute(docs, target, longest=longest, percent=35)


@pytest.mark.parametrize("percent", [0, 1, 50, 100])
def test_all_shares(spark, percent):
    docs = [(k, prose(k, 25)) for k in range(120)]
    assert drawn(spark, docs, [prose(1)], percent=percent) == brute(docs, [prose(1)], percent=percent)


def test_a_rough_sketch_is_widened(spark):
    docs = [(k, prose(k, 25)) for k in range(400)]
    assert drawn(spark, docs, [prose(1)], sketch=3, percent=20) == brute(docs, [prose(1)], percent=20)


def test_ties_of_repeated_rows_and_missing_ids(spark):
    docs = [(k // 40, prose(1, 30)) for k in range(120)] + [(None, prose(1, 30))] * 60 + [(k, prose(k, 30)) for k in range(200, 230)]
    for percent in (5, 30, 60, 90):
        assert drawn(spark, docs, [prose(2)], percent=percent) == brute(docs, [prose(2)], percent=percent)


def test_odd_rows_and_empty_tables(spark):
    docs = [r[:2] for r in EDGE_ROWS]
    assert drawn(spark, docs, [None, "", "Text here"], least_words=1, percent=50) == brute(docs, [None, "", "Text here"], least_words=1, percent=50)
    assert drawn(spark, docs, [], percent=50) == brute(docs, [], percent=50)
    assert not drawn(spark, [], ["a b"])


def test_buckets_of_long_texts_do_not_depend_on_slices(monkeypatch):
    text = (prose(3, 400) + " İstanbul ÄÖÜ 中文-x").encode()
    whole = [w for words in R.word_slices(text) for w in words]
    monkeypatch.setattr(R, "SLICE", 7)
    assert [w for words in R.word_slices(text) for w in words] == whole == [w.encode() for w in features(text.decode(), 1)[0]]
