"""Normalisation, similarity and contrasts of long counts (gene, sample_id, n)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Samples and genes of a tile of correlations.
TILE_SAMPLES = 128
TILE_GENES = 2048


def fpkmo(counts: DataFrame, fixed: bool = False) -> DataFrame:
    """N / (CDS total in millions + 1) / (length + 0.001), the length being the name's last part but
    one (0 counts as 1, sign ignored). ``fixed`` divides by (length + 1) / 1000 instead."""
    parts = F.split("gene", ":")
    cds = F.sum(F.when(parts[0] == "CDS", F.col("n")).otherwise(0)).over(Window.partitionBy("sample_id")) / 1e6
    raw = F.coalesce(F.get(parts, F.size(parts) - 2).try_cast("long"), F.lit(0))
    length = F.when(raw == 0, 1).otherwise(F.abs(raw))
    by = (length + 1) / 1000 if fixed else length + F.lit(1) / 1000
    return counts.select("gene", "sample_id", (F.col("n") / (cds + 1) / by).alias("value"))


def sample_correlation(values: DataFrame, log: bool = True, tile_samples: int = TILE_SAMPLES, tile_genes: int = TILE_GENES) -> DataFrame:
    """Pearson correlation of every pair of samples in name order, of log10(x + 1) or as they are.

    Samples and genes are dealt to tiles by hashes. A task has a tile of genes and two tiles of samples
    as two small matrices, of which only the sums of products of every two samples leave it; no row or
    task holds all samples, or all values of a gene. A pair counts the genes that both samples have.
    """
    x = F.log10(F.col("value") + 1) if log else F.col("value").cast("double")
    known = values.filter("value is not null")

    def tile(column: str, size: int) -> Column:
        parts = F.greatest(F.lit(1).cast("long"), F.ceil(known.select(F.count_distinct(column)).scalar() / size))
        return F.pmod(F.xxhash64(column), parts)

    cells = known.select("gene", "sample_id", x.alias("x"), tile("gene", tile_genes).alias("part"), tile("sample_id", tile_samples).alias("own"))
    last = F.greatest(F.lit(1).cast("long"), F.ceil(known.select(F.count_distinct("sample_id")).scalar() / tile_samples)) - 1
    pairs = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pairs = pairs.select("gene", "sample_id", "x", "own", "part", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def sums(cells: pa.Table) -> pa.Table:
        low, high = cells["low"][0].as_py(), cells["high"][0].as_py()
        gene, row = np.unique(cells["gene"].to_numpy(), return_inverse=True)
        own, sample, v = cells["own"].to_numpy(), cells["sample_id"].to_numpy(), cells["x"].to_numpy()

        def matrix(which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            names, column = np.unique(sample[own == which], return_inverse=True)
            m, there = (np.zeros((len(gene), len(names))) for _ in range(2))
            m[row[own == which], column], there[row[own == which], column] = v[own == which], 1.0
            return names, m, there

        (names_a, a, in_a), (names_b, b, in_b) = matrix(low), matrix(high)
        i, j = np.triu_indices(len(names_a)) if low == high else (k.ravel() for k in np.indices((len(names_a), len(names_b))))
        parts = {"n": in_a.T @ in_b, "sx": a.T @ in_b, "sy": in_a.T @ b, "sxx": (a * a).T @ in_b, "syy": in_a.T @ (b * b), "sxy": a.T @ b}
        out = {"sample_a": names_a[i], "sample_b": names_b[j]} | {k: p[i, j] for k, p in parts.items()}
        turned = out["sample_a"] > out["sample_b"]
        for one, two in (("sample_a", "sample_b"), ("sx", "sy"), ("sxx", "syy")):
            out[one], out[two] = np.where(turned, out[two], out[one]), np.where(turned, out[one], out[two])
        return pa.table({k: pa.array(x, pa.string() if k.startswith("sample") else pa.float64()) for k, x in out.items()})

    each = pairs.groupBy("part", "low", "high").applyInArrow(sums, "sample_a string, sample_b string, n double, sx double, sy double, sxx double, syy double, sxy double")
    total = each.groupBy("sample_a", "sample_b").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]).filter("n > 0")
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = F.sqrt((n * F.col("sxx") - sx * sx) * (n * F.col("syy") - sy * sy))
    return total.select("sample_a", "sample_b", F.when(spread > 0, (n * F.col("sxy") - sx * sy) / spread).alias("r"))


def value_histogram(values: DataFrame, width: float = 0.25) -> DataFrame:
    """Values per sample by bucket of log10(x + 1)."""
    bucket = F.floor(F.log10(F.col("value") + 1) / width).cast("int")
    return values.groupBy("sample_id", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def composition(metrics: DataFrame) -> DataFrame:
    """The table behind stacked bars: CDS and other counts, and shares of kinds and of antisense."""
    return metrics.select(
        "sample_id", F.col("CDS_total").alias("CDS"), (F.col("counted") - F.col("CDS_total")).alias("non_CDS"), F.col("CDS_pcnt_of_counted").alias("CDS_pcnt"), F.col("rRNA_pcnt_of_counted").alias("rRNA_pcnt"),
        F.col("tRNA_pcnt_of_counted").alias("tRNA_pcnt"), F.col("IGR_pcnt_of_counted").alias("IGR_pcnt"), F.col("misc_RNA_pcnt_of_counted").alias("misc_RNA_pcnt"), (100 - F.col("pcnt_sense")).alias("AS_pcnt"),
    )


def gene_subset(counts: DataFrame, which: str = "All") -> DataFrame:
    """All genes, or CDS and ncRNA alone."""
    return counts if which == "All" else counts.filter(F.col("gene").rlike("^(CDS|ncRNA):"))


def size_factors(counts: DataFrame) -> DataFrame:
    """Per sample the median, over genes without a zero anywhere, of its counts to their geometric mean."""
    gene = Window.partitionBy("gene")
    full = counts.withColumn("least", F.min("n").over(gene)).filter("least > 0").withColumn("ratio", F.log("n") - F.avg(F.log("n")).over(gene))
    return full.groupBy("sample_id").agg(F.exp(F.percentile("ratio", 0.5)).alias("factor"))


# A published rational approximation of the complementary error function (absolute error below 1.5e-7).
ERFC_P = 0.3275911
ERFC = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def two_sided(z: Column) -> Column:
    """The probability of a normal variable at least as far from zero as ``z``."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + F.lit(ERFC_P) * x)
    series = F.lit(0.0)
    for a in reversed(ERFC):
        series = (series + F.lit(a)) * t
    return series * F.exp(-x * x)


def contrast_moments(counts: DataFrame, group_a: list[str], group_b: list[str]) -> DataFrame:
    """Per gene the means of both groups' normalised counts and log2 of A / B (with half a count added)."""
    factors = size_factors(counts)
    side = F.when(F.col("sample_id").isin(group_a), "a").when(F.col("sample_id").isin(group_b), "b")
    x = counts.join(factors, "sample_id").select("gene", side.alias("side"), (F.col("n") / F.col("factor")).alias("x")).filter("side is not null")
    out = [f(F.when(F.col("side") == s, F.col("x"))).alias(f"{name}_{s}") for s in "ab" for name, f in (("mean", F.avg), ("var", F.var_samp), ("n", F.count))]
    return x.groupBy("gene").agg(*out).withColumn("lfc", F.log2((F.col("mean_a") + 0.5) / (F.col("mean_b") + 0.5)))


def contrast(counts: DataFrame, group_a: list[str], group_b: list[str], dispersion: str = "shrunken") -> DataFrame:
    """(gene, mean_a, mean_b, lfc, p, padj), ordered by padj; genes without counts have no p.

    ``shrunken`` fits negative binomials with dispersions drawn towards their trend
    (``negbin.negative_binomial_contrast``, which also gives the dispersions). ``moments`` is a quick
    approximation: dispersions are moment estimates (at least Poisson), p comes from a normal Wald
    test of the log fold change. padj is Benjamini-Hochberg's in both.
    """
    if dispersion == "shrunken":
        from seqloom.operators.negbin import negative_binomial_contrast

        return negative_binomial_contrast(counts, group_a, group_b).select("gene", "mean_a", "mean_b", "lfc", "p", "padj")
    if dispersion != "moments":
        raise ValueError(f"no such dispersion: {dispersion}")
    m = contrast_moments(counts, group_a, group_b)

    def spread(s: str) -> Column:
        mean = F.col(f"mean_{s}") + 0.5
        return F.greatest(F.coalesce(F.col(f"var_{s}"), F.lit(0.0)), mean) / F.col(f"n_{s}") / (mean * mean)

    z = (F.col("lfc") * math.log(2)) / F.sqrt(spread("a") + spread("b"))
    tested = m.withColumn("p", F.when(F.col("mean_a") + F.col("mean_b") > 0, two_sided(z)))
    return adjusted(tested.select("gene", "mean_a", "mean_b", "lfc", "p")).orderBy(F.asc_nulls_last("padj"), F.asc_nulls_last("p"), "gene")


def adjusted(tested: DataFrame) -> DataFrame:
    """Benjamini-Hochberg: p times tests over rank, and the least of that at this rank or above.

    One row for each gene of one contrast: a table of an annotation's size.
    """
    up = Window.orderBy(F.col("p"), F.col("gene"))
    have = tested.filter("p is not null")
    ranked = have.withColumns({"r": F.row_number().over(up), "m": F.count(F.lit(1)).over(Window.partitionBy())})
    down = Window.orderBy(F.desc("r")).rowsBetween(Window.unboundedPreceding, 0)
    done = ranked.withColumn("padj", F.least(F.lit(1.0), F.min(F.col("p") * F.col("m") / F.col("r")).over(down))).drop("r", "m")
    return done.unionByName(tested.filter("p is null").withColumn("padj", F.lit(None).cast("double")))


def de_summary(tested: DataFrame, fold: float = 2.0, p: float = 0.05) -> DataFrame:
    """Genes up (2^lfc >= fold) and down (<= 1 / fold) at padj <= p."""
    sure = F.col("padj") <= p
    return tested.agg(F.count(F.lit(1)).alias("genes"), F.count_if(sure & (F.pow(F.lit(2.0), "lfc") >= fold)).alias("up"), F.count_if(sure & (F.pow(F.lit(2.0), "lfc") <= 1 / fold)).alias("down"))
