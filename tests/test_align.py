import pytest
from pyspark.sql import functions as F

from seqloom.operators import align as A
from seqloom.operators import qc

ALN = "sample_id string, qname string, flag int, rname string, pos int, cigar string, tlen int, seq string, qual string"


def aln(spark, rows):
    return spark.createDataFrame([("s", q, f, r, p, c, 0, "ACGT", "IIII") for q, f, r, p, c in rows], ALN)


CLASSES = {
    (77, 141): "unmapped", (99, 147): "antisense", (83, 163): "sense", (97, 145): "antisense", (65, 129): "both_forward", (113, 177): "both_reverse",
    (73, 133): "r1_antisense_single", (89, 165): "r1_sense_single", (69, 137): "r2_sense_single", (101, 153): "r2_antisense_single",
}


def test_classes_of_flags(spark):
    rows = []
    for a, b in CLASSES:
        rows += [(f"q{a}", a, "c1", 1, "4M"), (f"q{a}", b, "c2", 9, "4M")]
    rows += [("lone", 99, "c1", 1, "4M"), ("q99", 99 + 256, "c3", 5, "4M")]  # a mate missing; a secondary alignment
    got = {r["qname"]: r["class"] for r in A.classify_pairs(aln(spark, rows)).collect()}
    assert got == {f"q{a}": c for (a, _), c in CLASSES.items()} | {"lone": "broken"}


def test_tallies_add_up(spark):
    rows = []
    for k, (a, b) in enumerate(CLASSES):
        for i in range(k + 1):
            rows += [(f"q{a}_{i}", a, "c1", 1, "4M"), (f"q{a}_{i}", b, "c1" if i % 2 else "c2", 9, "4M")]
    pairs = A.classify_pairs(aln(spark, rows))
    m = {r["metrics_type"]: r["count"] for r in A.pair_metrics(pairs).collect()}
    assert m["total_reads"] == len(rows) == sum(n for k, n in m.items() if k.startswith("read")) + m["unmapped_reads"]
    assert m["aligned_frags"] == m["sense_frags"] + m["antisense_frags"]
    counts = A.count_transcripts(pairs, spark.createDataFrame([("c1",), ("c2",), ("c9",)], "rname string")).collect()
    assert sum(r["s_frag"] + r["as_frag"] for r in counts) == m["aligned_frags"]
    assert {r["transcript"] for r in counts} == {"c1", "c2", "c9"}


STRANDS = {0: "+", 16: "-", 73: "-", 89: "+", 77: "-", 83: "+", 97: "-", 99: "-", 113: "+", 129: "+", 137: "+", 145: "+", 147: "+", 161: "+", 163: "+", 177: "+", 65: "+"}


def slow_strand(f):
    bit = lambda n: f & n > 0
    s = "+" if f == 0 else "-" if f == 16 else "0"
    if bit(64):
        if not bit(16) or (bit(32) and not bit(8)):
            s = "-"
        if bit(16) or (not bit(32) and not bit(8)):
            s = "+"
    if bit(128):
        if bit(16) or not bit(32):
            s = "-"
        if not bit(16) or bit(32):
            s = "+"
    return s


def test_strands_follow_the_later_rule(spark):
    flags = [0, 4, 16, 65, 69, 73, 77, 83, 89, 97, 99, 101, 113, 129, 133, 137, 141, 145, 147, 153, 161, 163, 165, 177]
    df = spark.createDataFrame([(f,) for f in flags], "flag int")
    got = {r["flag"]: r["s"] for r in df.select("flag", A.strand_of(F.col("flag")).alias("s")).collect()}
    assert got == {f: slow_strand(f) for f in flags}
    back = {r["flag"]: r["s"] for r in df.select("flag", A.strand_of(F.col("flag"), True).alias("s")).collect()}
    assert all(back[f] == {"+": "-", "-": "+", "0": "0"}[s] for f, s in got.items())


def test_fragments(spark):
    rows = [("p", 99, "c", 10, "5M"), ("p", 147, "c", 20, "5M2D"), ("r", 83, "c", 50, "5M"), ("r", 163, "c", 40, "5M"), ("i", 97, "c", 1, "4M"), ("i", 145, "d", 9, "4M"), ("off", 77, "*", 0, "*"), ("off", 141, "*", 0, "*"), ("single", 16, "c", 3, "2S3M")]
    got = {(r["name"], r["acc"], r["start_pos"], r["end_pos"], r["paired"]) for r in A.fragments(aln(spark, rows)).collect()}
    assert got == {("p", "c", 10, 27, True), ("r", "c", 40, 55, True), ("i", "c", 1, 5, False), ("i", "d", 9, 13, False), ("single", "c", 3, 6, False)}


def test_umis_count_once_per_gene_and_strand(spark):
    t = spark.createDataFrame([("s", "t1", "AAA", 3, 0), ("s", "t2", "AAA", 2, 1), ("s", "t1", "CCC", 1, 0), ("s", "t9", "GGG", 5, 5)], "sample_id string, transcript string, umi string, s_frag long, as_frag long")
    tmap = spark.createDataFrame([("t1", "g"), ("t2", "g")], "transcript string, gene string")
    (r,) = A.gene_counts_umi(t, tmap).collect()
    assert (r["s_count"], r["as_count"], r["s_drop"], r["as_drop"]) == (2, 1, 4, 0)


GOLDEN = {"ribosomal_rna": (372, 9557), "protein_coding": (106513, 122972), "pseudogene": (4272, 4652), "long_noncoding": (24742, 17654), "short_noncoding": (1603, 1811), "uncategorized": (295, 1584)}
GENES = {"ribosomal_rna": "NR_1:r", "protein_coding": "G:t:s:protein_coding:1", "pseudogene": "P:t:s:processed_pseudogene:1", "long_noncoding": "L:t:s:lincRNA:1", "short_noncoding": "S:t:s:miRNA:1", "uncategorized": "U:t:s:odd:1"}


def test_published_sample(spark):
    """A saved run's class sums: 137,797 sense and 158,230 antisense fragments."""
    assert sum(s for s, _ in GOLDEN.values()) == 137_797 and sum(a for _, a in GOLDEN.values()) == 158_230
    rows = [("u", GENES[c], s) for c, (s, _) in GOLDEN.items()] + [("u", "AS:" + GENES[c], a) for c, (_, a) in GOLDEN.items()]
    got = {r["metrics_type"]: r["pct"] for r in A.biotype_metrics(spark.createDataFrame(rows, "sample_id string, Geneid string, Fragcount long")).collect()}
    for c, (s, a) in GOLDEN.items():
        assert got[f"{c}_frags_pct_of_aligned_frags"] == pytest.approx((s + a) * 100 / 296_027, abs=1e-4)
        assert got[f"{c}_frags_sense_pct"] == pytest.approx(s * 100 / (s + a), abs=1e-4)


def test_duplicates_keep_the_best(spark):
    rows = [("s", "a", 99, "c", 10, "4M", 0, "ACGT", "IIII"), ("s", "a", 147, "c", 20, "4M", 0, "ACGT", "IIII"), ("s", "b", 99, "c", 10, "4M", 0, "ACGT", "####"), ("s", "b", 147, "c", 20, "4M", 0, "ACGT", "####")]
    rows += [("s", "c", 99, "c", 10, "4M", 0, "ACGT", "IIII"), ("s", "c", 147, "c", 21, "4M", 0, "ACGT", "IIII"), ("t", "d", 99, "c", 10, "4M", 0, "ACGT", "####"), ("t", "d", 147, "c", 20, "4M", 0, "ACGT", "####")]
    got = {r["qname"]: r["duplicate"] for r in A.mark_duplicates(spark.createDataFrame(rows, ALN)).collect()}
    assert got == {"a": False, "b": True, "c": False, "d": False}


def test_zero_denominators(spark):
    counts = spark.createDataFrame([("s", "c", "CDS:x", 0)], "sample_id string, acc string, feature string, n long")
    total = spark.createDataFrame([("s", 0)], "sample_id string, total long")
    assert all(r["value"] == 0 for r in qc.featurecounts_metrics(counts, total).collect())
    km = spark.createDataFrame([("p", 0.0, *[0] * 9, *[0.0] * 14)], "Pool_ID string, Pcnt_bc_in_pool double, " + ", ".join(f"{a}_{b} long" for a in ("total", "trimmed", "empty") for b in ("read1s", "read2s", "read_pairs")) + ", Total_reads double, Total_frags_counted double, CDS_total double, " + ", ".join(f"{c} double" for c in ("pcnt_aligned", "pcnt_proper", "mean_insert", "pcnt_sense", "CDS_pcnt_sense", "rRNA_pcnt_of_counted", "rRNA_pcnt_sense", "misc_RNA_pcnt_of_counted", "misc_RNA_pcnt_sense", "tRNA_pcnt_of_counted", "tRNA_pcnt_sense")) + "")
    km = km.withColumn("IGR_pcnt_of_counted", F.lit(0.0))
    (r,) = qc.pool_metrics(km).collect()
    assert all(v in (0, 0.0, "p") for v in r)


def test_collapse_stats_without_small_collapses(spark):
    sizes = spark.createDataFrame([("a", 150), ("a", 250), ("b", 1), ("b", 3), ("b", 500)], "sample_id string, reads long")
    got = {r["sample_id"]: r for r in A.collapse_stats(sizes).collect()}
    assert (got["a"]["min"], got["a"]["median"], got["a"]["pcnt_single"], got["a"]["pcnt_single_100"]) == (150, 200.0, 0.0, None)
    assert (got["b"]["pcnt_single"], got["b"]["pcnt_single_100"]) == (33.3333, 50.0)
