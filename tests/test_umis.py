import random
from collections import Counter, defaultdict

import pytest

from seqloom.operators import umis

READS = "sample_id string, qname string, flag int, rname string, pos int"


def one_apart(a, b):
    return len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1


def sequential(counts):
    """The published way: UMIs in falling order each take all that they lead to and that is not taken."""
    order = sorted(counts, key=lambda u: (-counts[u], u))
    by_mask = defaultdict(list)
    for u in order:
        for i in range(len(u)):
            by_mask[u[:i] + "*" + u[i + 1 :]].append(u)
    leads = {u: {v for i in range(len(u)) for v in by_mask[u[:i] + "*" + u[i + 1 :]] if v != u and counts[u] >= 2 * counts[v] - 1} for u in order}
    taken, groups = set(), {}
    for u in order:
        if u in taken:
            continue
        reached, todo = {u}, [u]
        while todo:
            for v in leads[todo.pop()] - reached:
                reached.add(v)
                todo.append(v)
        groups[u] = reached - taken
        taken |= reached
    return groups


def reads_of(spark, places):
    """places: (sample, pos) -> umi -> count"""
    rows = [(s, f"r{k}:umi_{u}", 0, "c", p) for (s, p), counts in places.items() for u, n in counts.items() for k in range(n)]
    return spark.createDataFrame(rows, READS)


def want(places):
    out = Counter()
    for (s, p), counts in places.items():
        for top, members in sequential(counts).items():
            out[s, f"c:{p}:+", top, f"r0:umi_{top}", len(members), sum(counts[u] for u in members)] += 1
    return out


@pytest.mark.parametrize("large", [0, 30, 20_000])
@pytest.mark.parametrize("seed", range(3))
def test_networks_as_by_the_sequential_rule(spark, seed, large, monkeypatch):
    monkeypatch.setattr(umis, "BATCH_LINKS", 25)
    r = random.Random(seed)
    places = {(f"s{k % 3}", k): {"".join(r.choice("ACGTN"[: 2 + seed]) for _ in range(6)): r.choice([1, 1, 1, 2, 3, 5, 9, 30]) for _ in range(r.randint(1, 40))} for k in range(12)}
    assert Counter(map(tuple, umis.umi_network(reads_of(spark, places), large=large).select("sample_id", "place", "umi", "qname", "umis", "reads").collect())) == want(places)


def test_chains_and_steps(spark):
    places = {
        ("a", 1): {"AAAAAA": 100, "AAAAAC": 50, "AAAACC": 25, "AAACCC": 1},  # 100 >= 99, 50 >= 49, 25 >= 1: one network
        ("a", 2): {"AAAAAA": 98, "AAAAAC": 50, "AAAACC": 25},  # 98 < 99: two
        ("a", 3): {"AAAAAA": 1, "AAAAAC": 1, "AAAACC": 1, "AAACCC": 1, "AACCCC": 1, "ACCCCC": 1, "CCCCCC": 1, "GGGGGG": 1},
        ("b", 1): {"AAAAAC": 3, "AAAAAG": 3},
    }
    got = Counter(map(tuple, umis.umi_network(reads_of(spark, places)).select("sample_id", "place", "umi", "qname", "umis", "reads").collect()))
    assert got == want(places) and got["a", "c:1:+", "AAAAAA", "r0:umi_AAAAAA", 4, 176] == 1 and got["a", "c:3:+", "AAAAAA", "r0:umi_AAAAAA", 7, 7] == 1


def test_a_place_with_thousands_of_umis(spark):
    r = random.Random(9)
    counts = {"".join(r.choice("ACGT") for _ in range(6)): r.choice([1, 1, 1, 1, 4]) for _ in range(6000)}
    places = {("s", 1): counts, ("s", 2): {"AAAAAA": 3, "AAAAAC": 1}}
    assert Counter(map(tuple, umis.umi_network(reads_of(spark, places), large=5000).select("sample_id", "place", "umi", "qname", "umis", "reads").collect())) == want(places)


def test_no_list_grows_with_a_place(spark):
    """Under one masking only UMIs that differ in the masked base meet."""
    r = random.Random(3)
    counts = {"".join(r.choice("ACGT") for _ in range(6)): 1 for _ in range(3000)}
    nodes = spark.createDataFrame([("s", "p", u, n) for u, n in counts.items()], "sample_id string, place string, umi string, reads long")
    links = umis.umi_links(nodes).collect()
    assert all(one_apart(x["a"], x["b"]) for x in links) and len({(x["a"], x["b"]) for x in links}) == len(links)
    assert max(Counter(x["a"] for x in links).values()) <= 18


def test_reads_without_a_umi_and_unmapped_ones(spark):
    rows = [("s", "plain", 0, "c", 1), ("s", "plain2", 0, "c", 1), ("s", "x:umi_AAAAAA", 4, "*", 0), ("s", "y:umi_AAAAAA", 0, "c", 1), ("s", "y:umi_AAAAAA", 256, "c", 9)]
    got = {tuple(r) for r in umis.umi_network(spark.createDataFrame(rows, READS)).select("place", "umi", "qname", "umis", "reads").collect()}
    assert got == {("c:1:+", None, "plain", 1, 2), ("c:1:+", "AAAAAA", "y:umi_AAAAAA", 1, 1)}
    assert umis.umi_network(spark.createDataFrame([], READS)).collect() == []


def test_small_places_are_settled_after_one_shuffle(spark):
    """Neither links nor tops of places that fit a task are joined or shuffled by masking."""
    places = {("s", k): {"AAAAAA": 3, "AAAAAC": 1, "GGGGGG": 1} for k in range(5)}
    plan = umis.umi_network(reads_of(spark, places))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_batches_cut_places_nowhere(spark, monkeypatch):
    monkeypatch.setattr(umis, "BATCH_LINKS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        counts = [("AAAAAA", 9), ("AAAAAC", 4), ("AAAACC", 1), ("GGGGGG", 1), ("GGGGGT", 1)]
        places = {("s", k): dict(counts[: k + 1]) for k in range(5)}
        assert Counter(map(tuple, umis.umi_network(reads_of(spark, places)).select("sample_id", "place", "umi", "qname", "umis", "reads").collect())) == want(places)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_reads_without_a_place_are_linked_with_none(spark):
    from pyspark.sql import functions as F

    rows = [("s", f"r{k}:umi_{u}", 0, None, 1) for u, n in (("AAAAAA", 3), ("AAAAAC", 1)) for k in range(n)]
    got = {tuple(r) for r in umis.umi_network(spark.createDataFrame(rows, READS), "feature", F.col("rname")).select("place", "umi", "umis", "reads").collect()}
    assert got == {(None, "AAAAAA", 1, 3), (None, "AAAAAC", 1, 1)}
