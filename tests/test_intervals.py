import random

from pyspark.sql import functions as F

from seqloom.operators import intervals as I
from seqloom.operators import sampling as S


def slow_counts(frags, features, min_len=10):
    out = {}
    for s, acc, a, b, strand, _ in frags:
        if b - a < min_len:
            continue
        hits = [(f, min(b, f[2]) - max(a, f[1])) for f in features if f[0] == acc]
        hits = [(f, ov) for f, ov in hits if ov > 0]
        total = sum(ov for _, ov in hits)
        for f, ov in hits:
            key = (s, acc, f[4])
            out.setdefault(key, [0.0, 0.0])[strand != f[3]] += ov / total
    return out


def test_shares_equal_brute_force(spark, monkeypatch):
    r = random.Random(1)
    features = [(f"c{r.randrange(2)}", a := r.randrange(1, 60_000), a + r.choice([5, 40, 300, 40_000]), r.choice("+-"), f"f{i}") for i in range(60)]
    frags = [(f"s{r.randrange(2)}", f"c{r.randrange(3)}", a := r.randrange(1, 60_000), a + r.choice([0, 5, 9, 10, 80, 400]), r.choice("+-"), True) for i in range(800)] * 2
    frags += [("s0", f[0], f[2], f[2] + 20, "+", True) for f in features[:5]]  # ends that touch do not count
    df = spark.createDataFrame(frags, "sample_id string, acc string, start_pos long, end_pos long, strand string, paired boolean")
    ft = spark.createDataFrame(features, "acc string, start_pos long, end_pos long, strand string, name string")
    got = {(x["sample_id"], x["acc"], x["name"]): (x["sense"], x["antisense"]) for x in I.count_features(df, ft).collect()}
    want = slow_counts(frags, features)
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    hit = sum(1 for s, acc, a, b, _, _ in frags if b - a >= 10 and any(f[0] == acc and min(b, f[2]) > max(a, f[1]) for f in features))
    assert abs(sum(map(sum, want.values())) - hit) < 1e-6
    assert I.count_features(df.withColumn("paired", F.lit(False)), ft, paired_only=True).count() == 0


def test_coverage_equals_brute_force(spark):
    r = random.Random(2)
    frags = [("s", "c", a := r.randrange(1, 500), a + r.randrange(0, 200), r.choice("+-")) for _ in range(120)]
    df = spark.createDataFrame(frags, "sample_id string, acc string, start_pos long, end_pos long, strand string")
    want = {}
    for _, _, a, b, s in frags:
        for p in range(a, b + 1):
            want.setdefault(p, [0, 0])[s == "-"] += 1
    for size in (16, 1 << 14):
        got = {x["pos"]: [x["plus"], x["minus"]] for x in I.dense_coverage(I.coverage(df, size)).collect()}
        assert got == want
    smooth = {x["pos"]: x["depth"] for x in I.smoothed_coverage(I.coverage(df), 10, stranded=False).collect()}
    assert all(abs(d - sum(sum(want.get(q, [0, 0])) for q in range(p - 5, p + 5)) / 10) < 1e-9 for p, d in smooth.items())


def test_merged_types_and_extension(spark):
    rows = [("c", 0, "gene", 5, 100, "+"), ("c", 1, "CDS", 5, 100, "+"), ("c", 0, "CDS", 200, 300, "-"), ("c", 0, "gene", 400, 500, "+"), ("c", 1, "pseudogene", 400, 500, "+"), ("c", 0, "tRNA", 600, 650, "+"), ("c", 1, "exon", 600, 650, "+"), ("c", 0, "gene", 700, 750, "-"), ("c", 1, "misc_RNA", 700, 750, "-")]
    gff = spark.createDataFrame([(*r, "L" if r[1] else "", "", "", "", "") for r in rows], "acc string, line_no int, type string, start_pos long, end_pos long, strand string, locus string, gene string, prod string, id string, name string")
    got = {r["full_tag"].split(":")[-1] + r["strand"]: r for r in I.merge_features(gff, 20, 10).collect()}
    by = sorted((r["start_pos"], r["end_pos"], r["type"]) for r in got.values()) if len(got) == 5 else sorted((r["start_pos"], r["end_pos"], r["type"]) for r in I.merge_features(gff, 20, 10).collect())
    assert by == [(1, 110, "CDS"), (190, 320, "CDS"), (400, 500, "pseudogene"), (600, 650, "tRNA"), (700, 750, "ncRNA")]


def test_gaps_use_the_row_before(spark):
    rows = [("c", 10, 100, "A"), ("c", 20, 30, "B"), ("c", 60, 90, "C")]
    df = spark.createDataFrame([(a, s, e, "+", "CDS", t) for a, s, e, t in rows], "acc string, start_pos long, end_pos long, strand string, type string, full_tag string")
    got = sorted((r["start_pos"], r["end_pos"]) for r in I.intergenic_regions(df).collect())
    assert got == [(1, 9), (31, 59)]  # the nested B hides A's end


def test_ladder_and_exact_samples(spark):
    rungs = S.depth_ladder(1.0, 100.0, 21, 2)
    assert abs(rungs[2][2] - 1.25893) < 1e-4 and rungs[-1][2] == 100 and len(rungs) == 41
    reads = spark.createDataFrame([(f"s{i % 3}", i // 3, f"r{i}") for i in range(3000)], "sample_id string, ord long, read_id string")
    want = {"s0": 100, "s1": 5000, "s2": 0}
    counts = spark.createDataFrame(list(want.items()), "sample_id string, k long")
    got = S.sample_exact(reads, counts, 3, 250)
    n = {r["sample_id"]: r["count"] for r in got.groupBy("sample_id").count().collect()}
    assert n == {"s0": 100, "s1": 1000}
    per = {r["b"]: r["count"] for r in got.filter("sample_id = 's0'").groupBy(F.floor(F.col("ord") / 250).alias("b")).count().collect()}
    assert per == {0: 25, 1: 25, 2: 25, 3: 25}
    assert {r["read_id"] for r in got.collect()} == {r["read_id"] for r in S.sample_exact(reads, counts, 3, 250).collect()}
