import pytest
from pyspark.sql import functions as F

from seqloom.operators import norm as N
from seqloom.operators import qc
from seqloom.sources import io as S

def test_text_formats(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nq\t99\tc\t5\t60\t4M\t=\t9\t8\tACGT\tIIII\tNM:i:0\n")
    assert S.read_sam(spark, str(tmp_path / "a.sam")).first()[:3] == ("q", 99, "c")
    (tmp_path / "a.gff").write_text("##gff-version 3\nc\ts\tregion\t1\t9\t.\t+\t.\tID=c\nc\ts\tCDS\t2\t8\t.\t-\t0\tID=x;product=a (b) c\n##FASTA\n>c\nACGT\n")
    (r,) = S.read_gff(spark, str(tmp_path / "a.gff")).collect()
    assert (r["type"], r["start_pos"], r["end_pos"], r["strand"], r["attrs"]["product"]) == ("CDS", 2, 8, "-", "a_b_c")
    (tmp_path / "a.fa").write_text(">one x\nACG\nT\n>two\nGG\n")
    assert sorted(map(tuple, S.read_fasta(spark, str(tmp_path / "a.fa")).collect())) == [("one x", "ACGT"), ("two", "GG")]
    (tmp_path / "key.tsv").write_text("### note\nSample_ID\tP7\nmy s\tX1\n###\nt\t\n")
    assert sorted(map(tuple, S.read_key_table(spark, str(tmp_path / "key.tsv")).collect())) == [("my_s", "X1"), ("t", "")]
    (tmp_path / "bc.txt").write_text("L1 ACGT\n L2\tGGGG\nL0 ACGT\n\n")
    assert sorted(map(tuple, S.read_barcodes(spark, str(tmp_path / "bc.txt")).collect())) == [("L0", "ACGT"), ("L2", "GGGG")]
    (tmp_path / "hits.csv").write_text("q,s,99.5,10,0,0,1,10,5,14,1e-5,50\n")
    r = S.read_blast_hits(spark, str(tmp_path / "hits.csv")).first()
    assert (r["query_start"], r["query_end"], r["sub_start"], r["sub_end"], r["evalue"]) == (0, 9, 4, 13, 1e-5)


def test_sinks(spark, tmp_path):
    reads = spark.createDataFrame([(f"l{i % 2}", ["a", "no_match"][i % 3 > 0], f"r{i}", "AC") for i in range(60)], "file_prefix string, barcode string, read_id string, seq string")
    S.write_demux_table(reads, str(tmp_path / "demux"), 3)
    assert spark.read.parquet(str(tmp_path / "demux")).groupBy("file_prefix", "barcode").count().count() == 4
    counts = spark.createDataFrame([("g2", "s1", 1), ("g2", "s2", 2), ("g1", "s1", 3), ("g1", "s2", 4)], "gene string, sample_id string, n long")
    order = spark.createDataFrame([("g2", 0), ("g1", 1)], "gene string, line_no int")
    S.write_matrix(counts, str(tmp_path / "m"), ["s1", "s2"], order)
    text = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*")))
    assert [x for x in text.splitlines() if x != "Geneid\ts1\ts2"] == ["g2\t1\t2", "g1\t3\t4"]
    S.write_matrix(counts, str(tmp_path / "n"), ["s1", "s2"], order.filter("gene = 'g2'"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "n").glob("part-*")))
    assert [x for x in text.splitlines() if x != "Geneid\ts1\ts2"] == ["g2\t1\t2", "g1\t3\t4"]  # genes that are not listed come last


def test_best_reference_takes_the_later_accession_on_a_tie(spark):
    tests = spark.createDataFrame([("a", "NC_1", 0.5), ("a", "NC_2", 0.5), ("b", "NC_1", 0.4)], "strain string, accession string, frac_aligned double")
    assert {r["strain"]: r["best"] for r in qc.best_reference(tests).collect()} == {"a": "NC_2", "b": "NC_1"}


def test_two_sided_probability(spark):
    import math

    z = [0.0, 0.5, -1.96, 3.0, 6.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in z], "z double").select(N.two_sided(F.col("z"))).collect()]
    assert all(abs(p - math.erfc(abs(x) / math.sqrt(2))) < 2e-7 for p, x in zip(got, z, strict=True))


def test_matrices_must_agree(spark):
    counts = spark.createDataFrame([("g1", "s1", 1), ("g1", "s2", 1), ("g2", "s1", 1)], "gene string, sample_id string, n long")
    with pytest.raises(qc.GeneMismatch):
        qc.gene_matrix(counts, ["s1", "s2"])
    assert qc.gene_matrix(counts, ["s1", "s2"], check=False).count() == 2


def test_adjusted_p_values(spark):
    p = [0.01, 0.04, 0.03, 0.005, None]
    df = spark.createDataFrame([(f"g{i}", x) for i, x in enumerate(p)], "gene string, p double")
    got = {r["gene"]: r["padj"] for r in N.adjusted(df).collect()}
    assert got["g3"] == pytest.approx(0.02) and got["g0"] == pytest.approx(0.02) and got["g2"] == pytest.approx(0.04) and got["g1"] == pytest.approx(0.04) and got["g4"] is None


def test_contrast_finds_the_changed_gene(spark):
    rows = [(f"CDS:g{g}", f"{s}{i}", 100 + (g * 7 + i * 3) % 11 + (900 if g == 4 and s == "a" else 0)) for g in range(40) for s in "ab" for i in range(3)]
    rows += [("CDS:zero", f"{s}{i}", 0) for s in "ab" for i in range(3)]
    out = N.contrast(spark.createDataFrame(rows, "gene string, sample_id string, n long"), ["a0", "a1", "a2"], ["b0", "b1", "b2"], dispersion="moments")
    first = out.first()
    assert first["gene"] == "CDS:g4" and first["lfc"] > 3 and first["padj"] < 1e-3
    assert out.filter("gene = 'CDS:zero'").first()["p"] is None
    r = N.de_summary(out).first()
    assert (r["genes"], r["up"], r["down"]) == (41, 1, 0)


def test_sam_text_is_written_packed(spark, tmp_path, monkeypatch):
    from seqloom.plans import io as plans
    from seqloom.plans import registry

    monkeypatch.setattr(plans, "scratch", lambda _: str(tmp_path / "sam"))
    assert registry.QUERIES["s3_read_sam"](spark, "/root/testdata/sf0.001").count() > 0
    files = [f.name for f in (tmp_path / "sam").glob("part-*")]
    assert files and all(f.endswith(".gz") for f in files)
