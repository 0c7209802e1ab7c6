"""Saturation against brute force, with fragments and features of all lengths."""

import hashlib
import random
from collections import Counter

import pytest

from seqloom.operators import intervals as I
from seqloom.operators import sampling as M
from seqloom.plans import registry

registry.load()
FRAGS = "name string, sample_id string, acc string, start_pos int, end_pos int, strand string"
FEATURES = "acc string, start_pos int, end_pos int, strand string, name string"


def made(seed, n=150):
    r = random.Random(seed)
    features = [("x", p, p + r.choice([0, 1, 90, 300, 5_000]), "+", f"g{k % 50}") for k, p in enumerate(r.randint(-3_000, 60_000) for _ in range(60))]
    features += [("y", p, p + 700, "-", f"y{p}") for p in (5, 900, 1_023, 1_024)] + [("x", 1, 60_000, "+", "whole"), ("far", 0, 9, "+", None), ("far", 9, 0, "+", "turned")]
    frags = [(f"q{k}", r.choice(["a|1", "b", None]), r.choice("xxxyz"), p, p + r.choice([5, 10, 50, 200, 1_023, 1_024, 9_000, 40_000]), r.choice("+-")) for k, p in enumerate(r.randint(-2_000, 61_000) for _ in range(n))]
    return frags + frags[:9] + [("f", "b", "far", -50, 5, "+"), ("n", "b", None, 1, 50, "+"), (None, "b", "x", 1, 50, "+"), ("s", "b", "x", None, 50, "+")], features


def shares_of(frag, features):
    _, _, acc, start, end, _ = frag
    if None in (acc, start) or end - start < 10:
        return {}
    found = [(name, min(end, t) - max(start, s)) for a, s, t, _, name in features if a == acc]
    out = Counter()
    for name, ov in found:
        if ov > 0:
            out[name] += ov / sum(x for _, x in found if x > 0)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_shares_of_fragments_and_features_of_all_lengths(spark, seed):
    frags, features = made(seed)
    df, ft = spark.createDataFrame(frags, FRAGS).withColumnRenamed("name", "read"), spark.createDataFrame(features, FEATURES)
    want = Counter()
    for f in frags:
        for name, share in shares_of(f, features).items():
            want[f[0], name] += share
    for whole in (False, True):
        got, marked = Counter(), Counter()
        for x in I.feature_shares(df, ft, whole=whole).collect():
            if whole and x["whole"]:
                assert x["acc"] is None and x["name"] is None and x["share"] == 1
                marked[x["read"]] += 1
            else:
                got[x["read"], x["name"]] += x["share"]
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        assert not whole or marked == Counter(f[0] for f in frags)


@pytest.mark.parametrize("ladder", [M.depth_ladder(5, 100, 5, 3), M.depth_ladder(20, 60, 3, 2)])
def test_saturation_equals_brute_force(spark, ladder):
    frags, features = made(5, 400)
    df, ft, rungs = spark.createDataFrame(frags, FRAGS), spark.createDataFrame(features, FEATURES), M.ladder_frame(spark, ladder)
    counts, sizes = Counter(), Counter()
    for f in frags:
        for step, repeat, pct in ladder:
            if f[0] is not None and int(hashlib.md5(f"{f[0]}:1:{repeat}".encode()).hexdigest()[:8], 16) < pct / 100 * 2**32:
                sizes[f[1], step, repeat] += 1
                for name, share in shares_of(f, features).items():
                    counts[f[1], step, repeat, f[2], name] += share
    got = {(x["sample_id"], x["step"], x["repeat"], x["acc"], x["name"]): x["n"] for x in M.saturation_counts(df, rungs, ft).collect()}
    assert got.keys() == counts.keys() and all(abs(got[k] - counts[k]) < 1e-9 for k in counts)
    curve = {tuple(x)[:3]: tuple(x)[3:] for x in M.saturation_curve(df, rungs, ft).collect()}
    genes = Counter(k[:3] for k, n in counts.items() if round(n, 9) >= 0.5)
    assert curve == {k: (n, genes[k]) for k, n in sizes.items()}


def test_features_are_listed_three_times_on_average(spark):
    rows = [("c", 1, 248_956_422)] + [("c", p, p + 1_000) for p in range(0, 20_000_000, 20_000)] + [("d", p, p + 90) for p in range(0, 9_000, 300)]
    features = spark.createDataFrame(rows, "acc string, f_start long, f_end long")
    bits = {r["acc"]: r["_bits"] for r in I.near_bits(features).collect()}
    copies = {acc: sum((e >> b) - (s >> b) + 2 for a, s, e in rows if a == acc) / sum(a == acc for a, _, _ in rows) for acc, b in bits.items()}
    assert bits["d"] == I.NEAR_BITS and max(copies.values()) <= 3.1


@pytest.mark.parametrize("name", ["m4_saturation_counts", "m4_saturation_curve"])
def test_fragments_are_shuffled_once(spark, name):
    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    plan = plan.partition("Union")[2]
    near = plan[: plan.index("ShuffledHashJoin") + plan[plan.index("ShuffledHashJoin") :].index("FileScan")]
    assert near.count("Exchange hashpartitioning") == 1 and near.count("Window") == 0
