"""Queries of normalisation, similarity and contrasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.operators import negbin
from seqloom.operators import norm as N
from seqloom.plans.qc import G9_SQL, GCOUNTS, _g9, fcounts, gcounts
from seqloom.plans.registry import query

FPKMO = GCOUNTS + """, parts AS (SELECT *, string_split(gene, ':') AS p, sum(CASE WHEN gene LIKE 'CDS:%' THEN n ELSE 0 END) OVER (PARTITION BY sample_id) / 1e6 AS cds FROM gcounts),
fpkmo AS (SELECT gene, sample_id, n / (cds + 1) / (CAST(p[len(p) - 1] AS BIGINT) + 1 / 1000) AS value FROM parts)
"""


@query("n1_fpkmo", "lines", sql=FPKMO + "SELECT gene, sample_id, round(value, 9) AS value FROM fpkmo")
def n1_fpkmo(lines):
    return N.fpkmo(gcounts(lines)).withColumn("value", F.round("value", 9))


@query("n1_fpkmo_fixed", "lines", sql=FPKMO + "SELECT gene, sample_id, round(n / (cds + 1) / ((CAST(p[len(p) - 1] AS BIGINT) + 1) / 1000), 6) AS value FROM parts")
def n1_fpkmo_fixed(lines):
    return N.fpkmo(gcounts(lines), fixed=True).withColumn("value", F.round("value", 6))


def _corr(x: str) -> str:
    return f"SELECT a.sample_id AS sample_a, b.sample_id AS sample_b, round(corr({x.format('a')}, {x.format('b')}), 8) AS r FROM gcounts a JOIN gcounts b ON a.gene = b.gene AND a.sample_id <= b.sample_id GROUP BY ALL"


@query("n2_sample_correlation", "lines", sql=GCOUNTS + _corr("log10({}.n + 1)"))
def n2_sample_correlation(lines):
    return N.sample_correlation(gcounts(lines).withColumnRenamed("n", "value")).withColumn("r", F.round("r", 8))


@query("n2_sample_correlation_raw", "lines", sql=GCOUNTS + _corr("{}.n::DOUBLE"))
def n2_sample_correlation_raw(lines):
    return N.sample_correlation(gcounts(lines).withColumnRenamed("n", "value"), log=False).withColumn("r", F.round("r", 8))


@query("n3_value_histogram", "lines", sql=GCOUNTS + "SELECT sample_id, CAST(floor(log10(n + 1) / 0.25) AS INT) AS bucket, count(*) AS n FROM gcounts GROUP BY ALL")
def n3_value_histogram(lines):
    return N.value_histogram(gcounts(lines).withColumnRenamed("n", "value"))


@query(
    "n4_composition",
    "lines",
    sql="SELECT sample_id, CDS_total AS CDS, counted - CDS_total AS non_CDS, CDS_pcnt_of_counted AS CDS_pcnt, rRNA_pcnt_of_counted AS rRNA_pcnt, tRNA_pcnt_of_counted AS tRNA_pcnt, IGR_pcnt_of_counted AS IGR_pcnt, misc_RNA_pcnt_of_counted AS misc_RNA_pcnt, 100 - pcnt_sense AS AS_pcnt FROM ("
    + "{g9}) WHERE replicon = 'ALL'",
)
def n4_composition(lines):
    return N.composition(_g9(fcounts(lines), ("sample_id",)).filter("replicon = 'ALL'"))


def _with_g9() -> None:
    from seqloom.plans.fixtures import with_fixtures
    from seqloom.plans.registry import ORACLES

    body = with_fixtures("lines") + ",\n" + G9_SQL.replace("{key}", "sample_id")
    head = ORACLES["n4_composition"]
    ORACLES["n4_composition"] = head[head.index("SELECT sample_id, CDS_total") :].replace("{g9}", body)


_with_g9()


@query("n5_gene_subset", "lines", sql=GCOUNTS + "SELECT gene, sample_id, n FROM gcounts WHERE gene LIKE 'CDS:%' OR gene LIKE 'ncRNA:%'")
def n5_gene_subset(lines):
    return N.gene_subset(gcounts(lines), "CDS").select("gene", "sample_id", "n")


FACTORS = GCOUNTS + """, full_genes AS (SELECT *, ln(n) - avg(ln(n)) OVER (PARTITION BY gene) AS ratio FROM (SELECT *, min(n) OVER (PARTITION BY gene) AS least FROM gcounts) WHERE least > 0),
factors AS (SELECT sample_id, exp(quantile_cont(ratio, 0.5)) AS factor FROM full_genes GROUP BY sample_id)
"""


@query("n6_size_factors", "lines", sql=FACTORS + "SELECT sample_id, round(factor, 8) AS factor FROM factors")
def n6_size_factors(lines):
    return N.size_factors(gcounts(lines)).withColumn("factor", F.round("factor", 8))


A, B = ["S0", "S1", "S2"], ["S3", "S4", "S5"]


@query(
    "n7_contrast_moments",
    "lines",
    sql=FACTORS
    + """, x AS (SELECT gene, sample_id IN ('S0','S1','S2') AS a, n / factor AS x FROM gcounts JOIN factors USING (sample_id)),
m AS (SELECT gene, avg(x) FILTER (a) AS mean_a, avg(x) FILTER (NOT a) AS mean_b FROM x GROUP BY gene) SELECT gene, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round(log2((mean_a + 0.5) / (mean_b + 0.5)), 6) AS lfc FROM m""",
)
def n7_contrast_moments(lines):
    return N.contrast_moments(gcounts(lines), A, B).select("gene", *[F.round(c, 6).alias(c) for c in ("mean_a", "mean_b", "lfc")])


ERFC = " + ".join(f"{a!r}::DOUBLE * pow(t, {k})" for k, a in enumerate(N.ERFC, 1))
TESTED = f""", x AS (SELECT gene, sample_id IN ('S0','S1','S2') AS a, n / factor AS x FROM gcounts JOIN factors USING (sample_id) WHERE sample_id IN ('S0','S1','S2','S3','S4','S5')),
m AS (SELECT gene, avg(x) FILTER (a) AS mean_a, avg(x) FILTER (NOT a) AS mean_b, coalesce(var_samp(x) FILTER (a), 0) AS var_a, coalesce(var_samp(x) FILTER (NOT a), 0) AS var_b,
 count(x) FILTER (a) AS n_a, count(x) FILTER (NOT a) AS n_b FROM x GROUP BY gene),
z AS (SELECT gene, mean_a, mean_b, log2((mean_a + 0.5) / (mean_b + 0.5)) AS lfc,
 greatest(var_a, mean_a + 0.5) / n_a / ((mean_a + 0.5) * (mean_a + 0.5)) + greatest(var_b, mean_b + 0.5) / n_b / ((mean_b + 0.5) * (mean_b + 0.5)) AS spread FROM m),
e AS (SELECT *, abs(lfc * ln(2) / sqrt(spread)) / sqrt(2) AS x, 1 / (1 + {N.ERFC_P!r}::DOUBLE * abs(lfc * ln(2) / sqrt(spread)) / sqrt(2)) AS t FROM z),
p AS (SELECT gene, mean_a, mean_b, lfc, CASE WHEN mean_a + mean_b > 0 THEN ({ERFC}) * exp(-x * x) END AS p FROM e),
ranked AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, gene) AS up FROM p WHERE p IS NOT NULL),
tested AS (SELECT gene, mean_a, mean_b, lfc, p, least(1.0, min(up) OVER (ORDER BY p DESC, gene DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padj FROM ranked
 UNION ALL SELECT gene, mean_a, mean_b, lfc, p, NULL FROM p WHERE p IS NULL)
"""
ROUNDED = ("mean_a", "mean_b", "lfc", "p", "padj")


@query("n7_contrast", "lines", sql=FACTORS + TESTED + f"SELECT gene, {', '.join(f'round({c}, 6) AS {c}' for c in ROUNDED)} FROM tested")
def n7_contrast(lines):
    return N.contrast(gcounts(lines), A, B, dispersion="moments").select("gene", *[F.round(c, 6).alias(c) for c in ROUNDED])


@query("n7_contrast_shrunken", "lines")
def n7_contrast_shrunken(lines):
    """Fits by iteration, which SQL doesn't express; tests hold them against a slow search and simulated counts."""
    return negbin.negative_binomial_contrast(gcounts(lines), A, B)


@query("n8_de_summary", "lines", sql=FACTORS + TESTED + "SELECT count(*) AS genes, count(*) FILTER (padj <= 0.2 AND pow(2, lfc) >= 1.2) AS up, count(*) FILTER (padj <= 0.2 AND pow(2, lfc) <= 1 / 1.2::DOUBLE) AS down FROM tested")
def n8_de_summary(lines):
    return N.de_summary(N.contrast(gcounts(lines), A, B, dispersion="moments"), 1.2, 0.2)
