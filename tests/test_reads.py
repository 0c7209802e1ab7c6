import random

import pytest

from seqloom.functions import bases
from seqloom.functions.protocols import PROTOCOLS, protocol
from seqloom.operators import reads as R


def slow_assign(seq, barcodes, p, cutoff, keep_last=False):
    width = p.size - (p.ignores_last and not keep_last)
    if len(seq) < p.start + p.size:
        return R.NO_MATCH, None
    cut = seq[p.start : p.start + width]
    found = [(sum(a != b for a, b in zip(cut, s[:width], strict=True)), n) for n, s in barcodes]
    least = min(d for d, _ in found)
    if least > cutoff:
        return R.NO_MATCH, None
    names = [n for d, n in found if d == least]
    return (names[0] if len(names) == 1 else R.AMBIGUOUS), least


@pytest.mark.parametrize("name,cutoff,keep_last", [("rts", 1, False), ("rts", 1, True), ("rts", 2, False), ("allseq", 1, False), ("rnatagseq", 0, False)])
def test_assign_barcode_equals_brute_force(spark, name, cutoff, keep_last):
    p = PROTOCOLS[name]
    r = random.Random(name)
    barcodes = [(f"b{i}", "".join(r.choice("ACGT") for _ in range(p.size))) for i in range(12)]
    barcodes.append(("near", "A" + barcodes[0][1][1:] if barcodes[0][1][0] != "A" else "C" + barcodes[0][1][1:]))
    seqs = ["", "ACG", "acgtacgtacgtacgt", "N" * 20]
    for _, s in barcodes:
        for _ in range(12):
            cut = list(s)
            for i in r.sample(range(p.size), r.choice([0, 1, 1, 2, 3])):
                cut[i] = r.choice("ACGTNx")
            seqs.append("G" * p.start + "".join(cut) + "ACGT")
        seqs.append("G" * p.start + s[:-1] + ("A" if s[-1] != "A" else "C") + "T")
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "read_id int, r1_seq string")
    bc = spark.createDataFrame(barcodes, "bc_name string, bc_seq string")
    got = {x["read_id"]: (x["barcode"], x["distance"]) for x in R.assign_barcode(df, bc, p, cutoff, keep_last).collect()}
    assert got == {i: slow_assign(s, barcodes, p, cutoff, keep_last) for i, s in enumerate(seqs)}


def test_reads_are_not_shuffled_for_barcodes(spark):
    bc = spark.createDataFrame([("a", "ACGTACGTA")], "bc_name string, bc_seq string")
    df = spark.createDataFrame([(1, "ACGTACGTAC")], "read_id int, r1_seq string")
    plan = R.assign_barcode(df, bc, PROTOCOLS["rts"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_too_large_a_neighbourhood_is_refused(spark):
    bc = spark.createDataFrame([(f"b{i}", "ACGTACGTACGTACGT") for i in range(3)], "bc_name string, bc_seq string")
    with pytest.raises(ValueError, match="reach"):
        R.barcode_neighbourhood(bc, protocol("customized", 0, 16), 4, most=1000)


def test_trims(spark):
    rows = [("full", "ACGTACGT"), ("short", "AC"), ("empty", ""), ("edge", "ACGTA")]
    df = spark.createDataFrame([(n, s, s.lower()) for n, s in rows], "read_id string, seq string, qual string")

    def out(d):
        return {r["read_id"]: (r["seq"], r["qual"]) for r in d.collect()}

    assert out(R.trim_ends(df, 2, 3)) == {"full": ("GTA", "gta"), "edge": ("", "")}
    assert out(R.trim_ends(df, 0, 0)) == {"full": ("ACGTACGT", "acgtacgt"), "short": ("AC", "ac"), "edge": ("ACGTA", "acgta")}
    assert out(R.keep_5p(df, 5)) == {"full": ("ACGTA", "acgta"), "edge": ("ACGTA", "acgta")}
    assert out(R.keep_3p(df, 5)) == {"full": ("TACGT", "tacgt"), "edge": ("ACGTA", "acgta")}
    assert out(R.keep_5p(df, 0)) == {}


def test_trim_polya(spark):
    base = "ACGTCGTCGTCGTCGTCGTCGT"
    rows = [("run", base + "AA" + "C" + "A" * 7 + "GG"), ("tail", base + "AAA"), ("none", base), ("all", "A" * 30), ("late", base + "AAAAAAC" + "A" * 9)]
    df = spark.createDataFrame([(n, s, s) for n, s in rows], "read_id string, seq string, qual string")
    got = {r["read_id"].split(":")[0]: r for r in R.trim_polya(df).collect()}
    assert set(got) == {"run", "tail", "none", "late"}
    assert got["run"]["seq"] == base + "AAC" and got["run"]["read_id"] == "run:trimmed_26_9"
    assert got["tail"]["seq"] == base and got["none"]["read_id"] == "none:untrimmed_0_0"
    assert got["late"]["seq"] == base + "AAAAAAC"
    assert all(r["seq"] == r["qual"] for r in got.values())


def test_scalar_functions(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("ACGTN", "10M2I5M3D", "x:umi_ACGTAC rest"), ("", "*", "none"), ("A", "5S20M", "umi_ACGTACG")], "seq string, cigar string, name string")
    got = df.select(bases.reverse_complement(F.col("seq")).alias("rc"), bases.cigar_ref_len(F.col("cigar")).alias("n"), bases.extract_umi(F.col("name")).alias("u")).collect()
    assert [tuple(r) for r in got] == [("NACGT", 18, "ACGTAC"), ("", 0, None), ("T", 20, None)]


def test_pairs(spark):
    rows = [("s", "both", 99, "c"), ("s", "both", 147, "c"), ("s", "one", 73, "c"), ("s", "one", 133, "c"), ("s", "off", 77, "*"), ("s", "off", 141, "*"), ("s", "dup", 99 + 1024, "c"), ("s", "dup", 147, "c")]
    aln = spark.createDataFrame([(*r, 5, 60, "4M", "=", 1, 2) for r in rows], "sample_id string, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int")
    names = {m: {r["qname"] for r in R.split_pairs(aln, m)[0].collect()} for m in ("concordant", "any_mapped", "nondup")}
    assert names == {"concordant": {"both", "off", "dup"}, "any_mapped": {"both", "one", "dup"}, "nondup": {"both", "one", "off"}}
    out, originals = R.unmap_broken_pairs(aln)
    assert out.count() == 8 and sorted(r["flag"] for r in originals.collect()) == [73, 133]
    assert sorted((r["flag"], r["rname"], r["pos"]) for r in out.filter("qname = 'one'").collect()) == [(77, "*", 0), (141, "*", 0)]
