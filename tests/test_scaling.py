"""Operators whose plans must hold at scale: against brute force, and by what their plans do not contain."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators import align as A
from seqloom.operators import intervals as I
from seqloom.operators import keys as K
from seqloom.operators import norm as N
from seqloom.operators import reads as R
from seqloom.operators import sampling as M
from seqloom.operators.matching import containing, text_containing
from seqloom.plans import fixtures, registry
from seqloom.sources import sparse

registry.load()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def crossed(df):
    return [x for x in plan_of(df).splitlines() if "NestedLoop" in x or "Cartesian" in x]


# --- range joins


def intervals(seed, n, longest, spread=300_000):
    r = random.Random(seed)
    out = []
    for k in range(n):
        start = r.randint(-50, spread)
        out.append((r.choice("xy"), start, start + r.choice([0, 1, 100, 16_383, 16_384, longest]), k))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_intervals_of_all_lengths(spark, seed):
    left, right = intervals(seed, 120, 40_000), intervals(seed + 9, 80, 5_000_000) + [("x", 0, 90_000_000, 999), ("z", 5, 4, 998)]
    a = spark.createDataFrame(left, "acc string, start_pos long, end_pos long, l int")
    b = spark.createDataFrame(right, "acc string, f_start long, f_end long, r int")
    want = Counter((i, j) for (p, s, e, i), (q, t, f, j) in itertools.product(left, right) if p == q and min(e, f) >= max(s, t))
    assert Counter((x["l"], x["r"]) for x in I.overlapping(a, b).collect()) == want
    # the other way round, long ones on the left
    a, b = a.toDF("acc", "f_start", "f_end", "l"), b.toDF("acc", "start_pos", "end_pos", "r")
    assert Counter((x["l"], x["r"]) for x in I.overlapping(b, a).collect()) == want


def test_a_feature_over_a_chromosome_is_listed_a_few_times(spark):
    features = spark.createDataFrame([("c", 1, 248_956_422, "whole"), ("c", 100_000, 101_000, "gene"), ("c", 16_000, 17_000, "edge")], "acc string, f_start long, f_end long, name string")
    own = features.withColumn("_own", I.bin_level("f_start", "f_end"))
    ways = F.size(F.concat(I._bins("f_start", "f_end", lambda k: k == F.col("_own"), 0), I._bins("f_start", "f_end", lambda k: k > F.col("_own"), 1)))
    copies = {r["name"]: r["n"] for r in own.select("name", ways.alias("n")).collect()}
    assert max(copies.values()) <= 2 * (len(I.LEVELS) + 1) and copies["whole"] == 1
    frags = spark.createDataFrame([("s", "c", p, p + 50, "+", True) for p in (5, 100_500, 16_380, 200_000_000, 248_956_400)], "sample_id string, acc string, start_pos long, end_pos long, strand string, paired boolean")
    got = Counter((r["start_pos"], r["name"]) for r in I.overlapping(frags, features).collect())
    assert got == Counter({(p, "whole"): 1 for p in (5, 100_500, 16_380, 200_000_000, 248_956_400)} | {(100_500, "gene"): 1, (16_380, "edge"): 1})


def test_long_annotations_are_not_sent_to_the_driver(spark, tmp_path):
    """A file of a few bytes a row, which Spark takes for short, lists some hundred bytes a row and level."""
    spark.range(200_000).selectExpr("id % 5 as c", "id * 41 + 1 as f_start", "id % 2 as f").write.parquet(str(tmp_path / "features"))
    features = spark.read.parquet(str(tmp_path / "features")).selectExpr("concat('c', c) as acc", "f_start", "f_start + 600 as f_end", "concat('F', f_start) as name")
    frags = spark.range(1000).selectExpr("concat('c', id % 5) as acc", "id * 37 as start_pos", "id * 37 + 100 as end_pos")
    out = I.overlapping(frags, features)
    plan = plan_of(out)
    joins = [x for x in plan.splitlines() if "Join" in x and "_at" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
    assert out.count() > 1000


# --- texts that contain patterns


def test_windows_find_every_pattern_once(spark):
    r = random.Random(2)
    word = lambda n: "".join(r.choice("AC") for _ in range(n))
    texts = [(k, [word(r.randint(0, 30)) for _ in range(r.randint(0, 3))]) for k in range(60)] + [(99, None)]
    patterns = [(f"p{k}", word(r.randint(3, 8))) for k in range(30)] + [("twice", "ACAC"), ("null", None)]
    df = spark.createDataFrame(texts, "k int, all array<string>")
    found = containing(df, F.coalesce("all", F.array()), spark.createDataFrame(patterns, "name string, pattern string"), "pattern")
    want = Counter((k, n) for (k, ts), (n, p) in itertools.product(texts, patterns) if p and any(p in t for t in ts or []))
    assert Counter((x["k"], x["name"]) for x in found.collect()) == want and not crossed(found)
    assert containing(df, F.coalesce("all", F.array()), spark.createDataFrame([], "name string, pattern string"), "pattern").count() == 0


def test_wells_and_prefixes_without_nested_loops(spark):
    pairs = spark.createDataFrame([("s", "xxACGTxx", "GGTTx"), ("s", "ACGTACGT", "GGTT"), ("t", "ACG", "GGTT")], "sample_id string, r1_seq string, r2_seq string")
    wells = spark.createDataFrame([("w1", "ACGT", "GGTT"), ("w2", "ACG", "TTx"), ("w3", "CCC", "GG")], "well string, bc1 string, bc2 string")
    out = R.amplicon_motif_counts(pairs, wells, ["xx"])
    assert sorted((r["sample_id"], r["well"], r["reads"], r["with_motif"]) for r in out.collect()) == [("s", "w1", 2, 1), ("s", "w2", 1, 1)]
    assert not crossed(out)
    key = spark.createDataFrame([("a", "X1;X2", "lane1", "/run/p1_X1"), ("b", "", "lane2", "/run/lane2"), ("c", None, None, "")], "Sample_ID string, P7 string, Lane string, Path_to_SeqFile string")
    prefixes = spark.createDataFrame([("lane1_X1",), ("lane2_X1",), ("lane1_X2",), ("p1",)], "prefix string")
    out = K.sample_prefixes(key, prefixes)
    assert sorted(map(tuple, out.collect())) == [("a", "lane1_X1"), ("a", "lane1_X2"), ("b", "lane2_X1"), ("c", "lane1_X1"), ("c", "lane1_X2"), ("c", "lane2_X1"), ("c", "p1")]
    assert not crossed(out)
    out = K.sample_prefixes(key.drop("P7", "Lane"), prefixes, "contains")
    assert sorted(map(tuple, out.collect())) == [("a", "p1")] and not crossed(out)


# --- selection


@pytest.mark.parametrize("bits", [1, 4, 10])
def test_selection_takes_the_least_hashes_of_each_block(spark, bits):
    r = random.Random(bits)
    rows = [("a", k, f"r{k}") for k in range(1000)] + [("b", k, f"q{k}") for k in range(37)] + [("c", k, "same") for k in range(30)]
    r.shuffle(rows)
    reads = spark.createDataFrame(rows, "sample_id string, ord long, read_id string")
    counts = spark.createDataFrame([("a", 333), ("b", 99), ("c", 7), ("d", 5)], "sample_id string, k long")
    got = M.sample_exact(reads, counts, 3, 100, bits)
    with_hash = reads.withColumn("h", M.hashed(F.col("read_id"), 3)).collect()
    want = Counter()
    for s, k in (("a", 333), ("b", 37), ("c", 7)):
        own = [x for x in with_hash if x["sample_id"] == s]
        n, before = len(own), 0
        for b in sorted({x["ord"] // 100 for x in own}):
            block = sorted((x["h"], x["read_id"], x["ord"]) for x in own if x["ord"] // 100 == b)
            quota = k * (before + len(block)) // n - k * before // n
            before += len(block)
            want.update((s, i) for _, i, _ in block[:quota])
    assert Counter((x["sample_id"], x["read_id"]) for x in got.collect()) == want
    assert sum(want.values()) == 333 + 37 + 7


def test_selection_sorts_one_bucket_only(spark):
    reads = spark.createDataFrame([("a", k, f"r{k}") for k in range(50)], "sample_id string, ord long, read_id string")
    plan = plan_of(M.sample_exact(reads, spark.createDataFrame([("a", 10)], "sample_id string, k long"), 3))
    ranked = [x for x in plan.splitlines() if "row_number" in x and "Window" in x]
    assert ranked and "_bucket" in plan and "_cut" in plan


# --- correlations in tiles


@pytest.mark.parametrize("tiles", [(2, 3), (3, 100), (128, 2048)])
def test_correlations_by_tiles(spark, tiles):
    rng = np.random.default_rng(3)
    rows = [(f"g{g}", f"s{s}", float(rng.integers(0, 100))) for g in range(17) for s in range(7) if rng.random() < 0.8]
    got = {(r["sample_a"], r["sample_b"]): r["r"] for r in N.sample_correlation(spark.createDataFrame(rows, "gene string, sample_id string, value double"), True, *tiles).collect()}
    by = {}
    for g, s, v in rows:
        by.setdefault(s, {})[g] = math.log10(v + 1)
    names = sorted(by)
    assert set(got) == {(a, b) for a in names for b in names if a <= b}
    for a, b in got:
        both = sorted(set(by[a]) & set(by[b]))
        assert got[a, b] == pytest.approx(np.corrcoef([by[a][g] for g in both], [by[b][g] for g in both])[0, 1], abs=1e-9)


# --- zeros


def test_zeros_without_a_grid(spark, monkeypatch):
    aln = spark.createDataFrame([("s", "a", 0, "c1", 1), ("s", "b", 4, "*", 0), ("t", "c", 4, "*", 0), ("s", "d", 16, "other", 1)], "sample_id string, qname string, flag int, rname string, pos int")
    refs = spark.createDataFrame([("c1",), ("c2",)], "rname string")
    out = A.reads_per_accession(aln, refs)
    assert sorted(map(tuple, out.collect())) == [("s", "c1", 1), ("s", "c2", 0), ("t", "c1", 0), ("t", "c2", 0)]
    assert not crossed(out)
    counts = A.count_transcripts_single(aln, refs)
    assert sorted((r["sample_id"], r["transcript"], r["as_frag"]) for r in counts.collect()) == [("s", "c1", 1), ("s", "c2", 0)] and not crossed(counts)
    genes = A.gene_counts(counts, spark.createDataFrame([("c1", "g"), ("c9", "h")], "transcript string, gene string"))
    assert sorted(map(tuple, genes.collect())) == [("s", "AS:g", 1), ("s", "AS:h", 0), ("s", "g", 0), ("s", "h", 0)] and not crossed(genes)
    monkeypatch.setattr(A, "REFERENCE_BYTES", 3)
    with pytest.raises(Exception, match="over 3 bytes"):
        A.reads_per_accession(aln, refs).collect()


# --- sparse matrices


def test_fifty_thousand_cells(spark, tmp_path):
    counts = spark.range(50_000 * 12).selectExpr("concat('g', pmod(xxhash64(id), 300)) AS gene", "concat('cell', id div 12) AS sample_id", "pmod(xxhash64(id, 1), 4) AS n")
    sparse.write_sparse_matrix(counts, str(tmp_path / "m"))
    back = sparse.read_sparse_matrix(spark, str(tmp_path / "m"))
    want = counts.groupBy("gene", "sample_id").agg(F.sum("n").alias("n")).filter("n <> 0")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("gene", "sample_id", "n").cast("decimal(38,0)"))).first())
    assert mark(back) == mark(want)
    columns = spark.read.parquet(str(tmp_path / "m/columns"))
    assert columns.count() == 50_000 and columns.agg(F.max("column")).first()[0] == 49_999
    wide = sparse.matrix_columns(spark, str(tmp_path / "m"), ["cell7", "cell49999"])
    assert wide.count() == 300
    assert {r["gene"]: r["cell7"] for r in wide.collect() if r["cell7"]} == {r["gene"]: r["n"] for r in want.filter("sample_id = 'cell7'").collect()}


def test_order_zeros_and_odd_names(spark, tmp_path):
    rows = [("g2", "s1", 1), ("g2", "s1", 2), ("g1", "s2", 0), (None, "s1", 5), ("g3", None, 4)]
    counts = spark.createDataFrame(rows, "gene string, sample_id string, n long")
    order = spark.createDataFrame([("g2", 0), ("g3", 1), ("other", 2)], "gene string, line_no int")
    sparse.write_sparse_matrix(counts, str(tmp_path / "m"), order, 2, 1)
    assert [r["gene"] for r in spark.read.parquet(str(tmp_path / "m/rows")).orderBy("row").collect()] == ["g2", "g3", None, "g1"]
    assert Counter(map(tuple, sparse.read_sparse_matrix(spark, str(tmp_path / "m")).collect())) == Counter([("g2", "s1", 3), (None, "s1", 5), ("g3", None, 4)])
    assert sparse.read_sparse_matrix(spark, str(tmp_path / "m"), zeros=True).count() == 12
    with pytest.raises(KeyError):
        sparse.matrix_columns(spark, str(tmp_path / "m"), ["s9"])
    sparse.write_sparse_matrix(counts.filter("n > 9"), str(tmp_path / "none"))
    assert sparse.read_sparse_matrix(spark, str(tmp_path / "none")).count() == 0


def test_genes_that_samples_do_not_share(spark):
    counts = spark.createDataFrame([("g1", "s1", 1), ("g1", "s2", 1), ("g2", "s1", 1), ("g3", "s1", 1), ("g3", "s1", 1)], "gene string, sample_id string, n long")
    assert sorted(map(tuple, sparse.uneven_genes(counts).collect())) == [("g2", 1, 1), ("g3", 1, 2)]


# --- one pass over what is read


def scans(df):
    return plan_of(df).count("FileScan")


def test_mates_are_made_from_one_pass_over_pairs(spark):
    sf = "/root/testdata/sf0.001"
    got = fixtures.frame(spark, sf, "alignments")
    want = spark.sql(fixtures.FIXTURES["alignments"], pairs=fixtures.frame(spark, sf, "pairs"))
    assert got.dtypes == want.dtypes and scans(got) == 1
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("name", ["p12_split_pairs_concordant", "p12_split_pairs_any_mapped", "p12_split_pairs_nondup", "p13_unmap_broken_pairs"])
def test_pairs_are_split_in_one_shuffle(spark, name):
    plan = plan_of(registry.QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1


def test_marked_pairs_without_names_go(spark):
    rows = [("s", "a", 99), ("s", "a", 4), ("s", "b", 1024), ("s", "b", 0), ("s", None, 0), (None, "c", 0), ("s", "d", None)]
    aln = spark.createDataFrame(rows, "sample_id string, qname string, flag int")
    got = {m: sorted((r["qname"], r["flag"], r["keep"]) for r in R.mark_pairs(aln, m).collect()) for m in ("concordant", "nondup")}
    assert got["concordant"] == [("a", 4, False), ("a", 99, False), ("b", 0, True), ("b", 1024, True)]
    assert got["nondup"] == [("a", 4, True), ("a", 99, True), ("b", 0, False), ("b", 1024, False)]


def test_duplicates_of_piled_and_usual_places(spark):
    r = random.Random(4)
    rows, pairs = [], {}
    for k in range(300):
        sample, pos, rev, quals = r.choice("st"), r.choice([5, 5, 5, 9, 30 + k]), r.choice([0, 16]), ["".join(r.choice("#5I") for _ in range(2)) for _ in "12"]
        rows += [(sample, f"q{k:03}", 65 + rev, "c", pos, "4M", 0, "ACGT", quals[0]), (sample, f"q{k:03}", 129, "c", pos + 9, "4M", 0, "ACGT", quals[1])]
        pairs.setdefault((sample, pos, rev), []).append((-sum(map(ord, "".join(quals))), f"q{k:03}"))
    want = {q: q != min(own)[1] for own in pairs.values() for _, q in own}
    aln = spark.createDataFrame(rows, "sample_id string, qname string, flag int, rname string, pos int, cigar string, tlen int, seq string, qual string")
    for piled in (0, 20, 100_000):
        out = A.mark_duplicates(aln, piled=piled)
        assert {x["qname"]: x["duplicate"] for x in out.collect()} == want
        assert plan_of(out).count("SortMergeJoin") == 0


def test_one_text_a_row_is_cut_without_lists(spark):
    r = random.Random(5)
    word = lambda n: "".join(r.choice("AC") for _ in range(n))
    df = spark.createDataFrame([(k, word(r.randint(0, 30))) for k in range(80)] + [(98, None), (99, "")], "k int, text string")
    patterns = spark.createDataFrame([(f"p{k}", word(r.randint(3, 8))) for k in range(30)] + [("null", None)], "name string, pattern string")
    found = text_containing(df, "text", patterns, "pattern")
    rows = lambda d: Counter((x["k"], x["name"]) for x in d.collect())
    assert rows(found) == rows(containing(df, F.array("text"), patterns, "pattern")) and found.count()
    assert found.columns == ["k", "text", "name", "pattern"]
    plan = plan_of(registry.QUERIES["p15_amplicon_motif_counts"](spark, "/root/testdata/sf0.001"))
    assert "array_distinct" not in plan and "lambda" not in plan


def test_smoothing_hands_over_no_pandas_frames(spark):
    plan = plan_of(registry.QUERIES["i8_smoothed_coverage"](spark, "/root/testdata/sf0.001"))
    assert "FlatMapGroupsInArrow" in plan and "round(" not in plan[: plan.index("FlatMapGroupsInArrow")]


def test_coverage_reads_fragments_once(spark):
    out = I.coverage(fixtures.frame(spark, "/root/testdata/sf0.001", "frags"))
    assert out.collect()
    assert "ReusedExchange" in plan_of(out).partition("Initial Plan")[0]
