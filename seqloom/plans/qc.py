"""Queries of the quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.operators import qc as Q
from seqloom.plans.reads import ASSIGNED, assigned
from seqloom.plans.registry import query
from seqloom.sources import sparse
from seqloom.sources.scratch import scratch

REPORT = ASSIGNED + """, report AS (SELECT l.barcode, count(a.read_id) AS reads, count(*) FILTER (a.distance = 0) AS zero, count(*) FILTER (a.distance = 1) AS one
 FROM (SELECT bc_name AS barcode FROM barcodes UNION ALL SELECT 'ambiguous' UNION ALL SELECT 'no_match') l LEFT JOIN assigned a ON a.barcode = l.barcode GROUP BY l.barcode)
"""


@query(
    "g1_demux_report",
    "reads",
    "barcodes",
    sql=REPORT
    + """SELECT CASE WHEN barcode IN ('NATION_1','NATION_3') THEN concat(barcode, '-*') ELSE barcode END AS barcode, reads, round(100.0::DOUBLE * reads / (SELECT count(*) FROM reads), 6) AS pcnt_of_total,
CASE WHEN reads = 0 THEN 0 ELSE round(100.0::DOUBLE * zero / reads, 6) END AS pcnt_zero_mismatch, CASE WHEN reads = 0 THEN 0 ELSE round(100.0::DOUBLE * one / reads, 6) END AS pcnt_one_mismatch FROM report""",
)
def g1_demux_report(reads, barcodes):
    return Q.demux_report(assigned(reads, barcodes), barcodes, ["NATION_1", "NATION_3"])


LANES = """lanes AS (SELECT concat('X', sample_no % 6) AS "index", file_prefix AS lane, true_barcode AS barcode, count(*) AS reads, CAST(length(true_barcode) * 7 AS DOUBLE) AS pcnt_zero_mismatch FROM reads GROUP BY ALL),
combined AS (SELECT "index", barcode, round(100.0::DOUBLE * reads / sum(reads) OVER (PARTITION BY "index"), 4) AS pcnt_of_pool, reads, round(100.0::DOUBLE * perfect / reads, 4) AS pcnt_perfect
 FROM (SELECT "index", barcode, CAST(sum(reads) AS BIGINT) AS reads, sum(reads * pcnt_zero_mismatch / 100) AS perfect FROM lanes GROUP BY ALL))
"""


def _combined(reads):
    lanes = reads.groupBy(F.concat(F.lit("X"), F.col("sample_no") % 6).alias("index"), F.col("file_prefix").alias("lane"), F.col("true_barcode").alias("barcode")).agg(F.count(F.lit(1)).alias("reads"))
    return Q.combine_demux_reports(lanes.withColumn("pcnt_zero_mismatch", (F.length("barcode") * 7).cast("double")))


@query("g2_combine_demux_reports", "reads", sql=LANES + "SELECT * FROM combined")
def g2_combine_demux_reports(reads):
    return _combined(reads)


_POOLS = [f"X{i}" for i in range(6)]


@query(
    "g2_pool_matrix",
    "reads",
    sql=LANES
    + "SELECT barcode, "
    + ", ".join(f"coalesce(max(pcnt_of_pool) FILTER (\"index\" = '{p}'), 0) AS {p}" for p in _POOLS)
    + " FROM combined GROUP BY barcode UNION ALL SELECT 'Total_Reads:', "
    + ", ".join(f"coalesce(sum(reads) FILTER (\"index\" = '{p}'), 0)::DOUBLE" for p in _POOLS)
    + " FROM combined",
)
def g2_pool_matrix(reads):
    return Q.pool_matrix(_combined(reads), _POOLS)


@query(
    "g3_inline_distribution",
    "key_table",
    "barcodes",
    "bc_log",
    sql="""combined AS (SELECT index, barcode, pcnt AS pcnt_of_pool, total AS reads, pcnt / 2 AS pcnt_perfect FROM bc_log WHERE index <> 'idx3'),
grid AS (SELECT * FROM (SELECT DISTINCT Project_ID AS project, Pool_index AS pool FROM key_table) CROSS JOIN (SELECT DISTINCT bc_seq AS barcode, bc_name FROM barcodes)),
joined AS (SELECT g.project, coalesce(k.Sample_ID, '-') AS sample, g.barcode, g.pool, c.pcnt_of_pool, coalesce(c.reads, -1) AS reads, c.pcnt_perfect, g.bc_name,
 CASE WHEN k.Sample_ID IS NULL THEN 'unkeyed' WHEN g.pool NOT IN (SELECT index FROM combined) THEN 'DATA_MISSING!' ELSE 'ok' END AS status
 FROM grid g LEFT JOIN key_table k ON k.Project_ID = g.project AND k.Pool_index = g.pool AND k.Inline_Seq = g.barcode LEFT JOIN combined c ON c.index = g.pool AND c.barcode = g.barcode)
SELECT *, CAST(row_number() OVER (PARTITION BY project ORDER BY CASE status WHEN 'ok' THEN 0 WHEN 'DATA_MISSING!' THEN 1 ELSE 2 END, pcnt_of_pool DESC NULLS LAST, pool, barcode, bc_name, sample) AS INT) AS place FROM joined""",
)
def g3_inline_distribution(key_table, barcodes, bc_log):
    key = key_table.select(F.col("Project_ID").alias("project"), F.col("Pool_index").alias("pool"), F.col("Inline_Seq").alias("bc"), F.col("Sample_ID").alias("sample"))
    combined = bc_log.filter("index <> 'idx3'").select("index", "barcode", F.col("pcnt").alias("pcnt_of_pool"), F.col("total").alias("reads"), (F.col("pcnt") / 2).alias("pcnt_perfect"))
    return Q.inline_distribution(key, combined, barcodes).withColumn("reads", F.coalesce("reads", F.lit(-1)))


@query(
    "g4_raw_inline_frequency",
    "reads",
    "barcodes",
    sql="""head AS (SELECT file_prefix, substr(r1_seq,1,9) AS kmer, count(*) AS n FROM reads WHERE ord < 5000 AND length(r1_seq) >= 9 GROUP BY ALL),
ranked AS (SELECT *, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY file_prefix), 6) AS pcnt, row_number() OVER (PARTITION BY file_prefix ORDER BY n DESC, kmer) AS rank FROM head)
SELECT file_prefix, r.kmer, n, pcnt, CAST(rank AS INT) AS rank, coalesce(b.bc_name, '-') AS bc_name FROM ranked r LEFT JOIN (SELECT substr(bc_seq,1,9) AS kmer, min(bc_name) AS bc_name FROM barcodes GROUP BY 1) b ON r.kmer = b.kmer WHERE rank <= 60""",
)
def g4_raw_inline_frequency(reads, barcodes):
    return Q.raw_inline_frequency(reads, barcodes, 5000, 9, 60)


ORPHANS = "orphans AS (SELECT ord, substr(index_seq,1,2) AS i1, substr(index_seq,3,2) AS i2 FROM reads)\n"


@query("g5_orphan_index_pairs", "reads", sql=ORPHANS + "SELECT i1, i2, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM orphans WHERE ord < 8000), 6) AS pcnt FROM orphans WHERE ord < 8000 GROUP BY i1, i2 ORDER BY n DESC, i1, i2 LIMIT 40")
def g5_orphan_index_pairs(reads):
    return Q.orphan_index_pairs(reads.select("ord", F.substring("index_seq", 1, 2).alias("i1"), F.substring("index_seq", 3, 2).alias("i2")), 8000, 40)


WALKUP = "walkup AS (SELECT concat('FC', sample_no % 3) AS flowcell, file_prefix AS lane, CASE WHEN sample_no % 5 = 0 THEN 'unmatched' ELSE concat('X', sample_no % 6) END AS \"index\", count(*) AS n FROM reads GROUP BY ALL)\n"


def _walkup(reads):
    index = F.when(F.col("sample_no") % 5 == 0, "unmatched").otherwise(F.concat(F.lit("X"), F.col("sample_no") % 6))
    return reads.groupBy(F.concat(F.lit("FC"), F.col("sample_no") % 3).alias("flowcell"), F.col("file_prefix").alias("lane"), index.alias("index")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "g6_walkup_metrics",
    "reads",
    sql=WALKUP
    + """, sums AS (SELECT flowcell, lane, "index", sum(n) AS reads FROM walkup GROUP BY GROUPING SETS ((flowcell, lane, "index"), (flowcell, lane), (flowcell)))
SELECT s.flowcell, s.lane, s."index", round(s.reads / 1e6, 6) AS mreads, round(100.0::DOUBLE * s.reads / w.whole, 6) AS pcnt FROM sums s JOIN (SELECT flowcell, sum(n) AS whole FROM walkup GROUP BY 1) w USING (flowcell)""",
)
def g6_walkup_metrics(reads):
    return Q.walkup_metrics(_walkup(reads))


@query(
    "g6_matched_share",
    "reads",
    sql=WALKUP
    + "SELECT flowcell, CAST(sum(CASE WHEN \"index\" <> 'unmatched' THEN n ELSE 0 END) AS BIGINT) AS matched, CAST(sum(CASE WHEN \"index\" = 'unmatched' THEN n ELSE 0 END) AS BIGINT) AS unmatched, round(100.0::DOUBLE * sum(CASE WHEN \"index\" <> 'unmatched' THEN n ELSE 0 END) / sum(n), 6) AS pcnt_matched FROM walkup GROUP BY flowcell",
)
def g6_matched_share(reads):
    return Q.matched_share(_walkup(reads))


@query(
    "g6_index_pool_totals",
    "reads",
    "key_table",
    sql="""per AS (SELECT concat('idx', length(r1_seq) % 3 + CASE WHEN substr(index_seq,1,1) IN ('A','C') THEN 0 ELSE 4 END) AS "index", count(*) AS reads FROM reads GROUP BY 1),
pools AS (SELECT Pool_index, min(Pool_ID) AS pool FROM key_table GROUP BY 1)
SELECT "index", coalesce(pool, '-') AS pool, reads, round(100.0::DOUBLE * reads / sum(reads) OVER (), 6) AS pcnt FROM per LEFT JOIN pools ON "index" = Pool_index""",
)
def g6_index_pool_totals(reads, key_table):
    number = F.length("r1_seq") % 3 + F.when(F.substring("index_seq", 1, 1).isin("A", "C"), 0).otherwise(4)
    return Q.index_pool_totals(reads.select(F.concat(F.lit("idx"), number).alias("index"), F.lit(1).alias("n")), key_table)


_FILES = [f"lane{i}" for i in range(4)]


@query(
    "g7_index_table",
    "reads",
    sql="""per AS (SELECT file_prefix AS file, substr(index_seq,1,2) AS "index", count(*) AS n FROM reads GROUP BY ALL), shares AS (SELECT *, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY file) AS pcnt FROM per)
SELECT "index", """
    + ", ".join(f"coalesce(round(sum(pcnt) FILTER (file = '{f}'), 6), 0) AS {f}" for f in _FILES)
    + """, round(sum(pcnt) / 4, 6) AS average, CASE WHEN "index" IN ('AC','GT') THEN '*' ELSE '' END AS used FROM shares GROUP BY "index" """,
)
def g7_index_table(reads):
    per = reads.groupBy(F.col("file_prefix").alias("file"), F.substring("index_seq", 1, 2).alias("index")).agg(F.count(F.lit(1)).alias("n"))
    return Q.index_table(per, _FILES, ["AC", "GT"])


# feature counts per sample and accession, named as I6 names them
FCOUNTS = """fcounts AS (SELECT concat('S', l_suppkey % 8) AS sample_id, concat('chr', l_partkey % 3) AS acc, concat(CASE WHEN l_linenumber % 3 = 0 THEN 'AS_' ELSE '' END, CASE l_partkey % 6 WHEN 0 THEN 'CDS' WHEN 1 THEN 'rRNA' WHEN 2 THEN 'misc_RNA' WHEN 3 THEN 'ncRNA' WHEN 4 THEN 'tRNA' ELSE 'IGR' END,
 ':L', l_partkey % 50, ':-:-:-:-:+:', 300 + l_partkey % 500) AS feature, CAST(sum(l_quantity) AS BIGINT) AS n FROM lines GROUP BY ALL)
"""


def fcounts(lines):
    sql = FCOUNTS[FCOUNTS.index("(") + 1 : FCOUNTS.rindex(")")].replace("FROM lines", "FROM {lines}").replace("GROUP BY ALL", "GROUP BY 1, 2, 3")
    return lines.sparkSession.sql(sql, lines=lines)


_KINDS = Q.KINDS
G9_SQL = FCOUNTS + """, typed AS (SELECT *, feature LIKE 'AS\\_%' ESCAPE '\\' AS is_as, split_part(regexp_replace(feature, '^AS_', ''), ':', 1) AS kind FROM fcounts),
rows_of AS (SELECT {key}, acc, kind, is_as, n FROM typed UNION ALL SELECT {key}, 'ALL', kind, is_as, n FROM typed),
sums AS (SELECT {key}, acc, sum(n) AS counted, coalesce(sum(n) FILTER (kind <> 'IGR' AND NOT is_as), 0) AS sense, coalesce(sum(n) FILTER (kind <> 'IGR'), 0) AS known, coalesce(sum(n) FILTER (kind = 'IGR'), 0) AS igr, """ + ", ".join(
    f"coalesce(sum(n) FILTER (kind = '{t}' AND {c}), 0) AS {t}_{s}" for t in _KINDS for s, c in (("s", "NOT is_as"), ("a", "is_as"))
) + """ FROM rows_of GROUP BY {key}, acc),
aligned AS (SELECT {key}, acc, sum(n) * 2 AS aligned FROM rows_of GROUP BY {key}, acc), summary AS (SELECT {key}, sum(n) * 3 AS total_reads FROM typed GROUP BY {key})
SELECT {key}, CAST(total_reads AS BIGINT) AS total_reads, acc AS replicon, round(aligned * 100.0::DOUBLE / total_reads, 4) AS pcnt_aligned, 50.0::DOUBLE AS pcnt_proper, CASE WHEN acc = 'ALL' THEN 120.0::DOUBLE END AS mean_insert, CAST(counted AS BIGINT) AS counted,
 CASE WHEN known = 0 THEN 0 ELSE round(sense * 100.0::DOUBLE / known, 4) END AS pcnt_sense, """ + ", ".join(
    f"round(({t}_s + {t}_a) * 100.0::DOUBLE / counted, 4) AS {t}_pcnt_of_counted, CASE WHEN {t}_s + {t}_a = 0 THEN 0 ELSE round({t}_s * 100.0::DOUBLE / ({t}_s + {t}_a), 4) END AS {t}_pcnt_sense" for t in _KINDS
) + ", CAST(CDS_s + CDS_a AS BIGINT) AS CDS_total, round(igr * 100.0::DOUBLE / counted, 4) AS IGR_pcnt_of_counted FROM sums JOIN aligned USING ({key}, acc) JOIN summary USING ({key})"


def _g9(counts, keys):
    summary = counts.groupBy(*keys).agg((F.sum("n") * 3).alias("total_reads"), F.lit(50.0).alias("pcnt_proper"), F.lit(120.0).alias("mean_insert"))
    per_acc = counts.groupBy(*keys, "acc").agg((F.sum("n") * 2).alias("reads"))
    return Q.replicon_metrics(counts, summary, per_acc, keys)


@query("g9_replicon_metrics", "lines", sql=G9_SQL.replace("{key}", "sample_id"))
def g9_replicon_metrics(lines):
    return _g9(fcounts(lines), ("sample_id",))


@query("g10_drop_metrics", "lines", sql=G9_SQL.replace("typed AS (SELECT *,", "typed AS (SELECT *, 'C0' AS cell,", 1).replace("'C0' AS cell", "concat('C', length(feature) % 4) AS cell").replace("{key}", "sample_id, cell").replace("CASE WHEN acc = 'ALL' THEN 120.0::DOUBLE END", "CASE WHEN acc = 'ALL' THEN 120.0::DOUBLE END"))
def g10_drop_metrics(lines):
    return _g9(fcounts(lines).withColumn("cell", F.concat(F.lit("C"), F.length("feature") % 4)), ("sample_id", "cell"))


_FC = ("CDS", "IGR", "rRNA", "ncRNA", "tRNA", "misc_RNA")
_FC_OUT = {
    "aligned_frag": "aligned", "unmapped_count": "total - aligned", "sense_frag": "sense", "aligned_frag_pct_of_total": "round(aligned * 100.0::DOUBLE / total, 4)", "unmapped_count_pct_of_total": "round((total - aligned) * 100.0::DOUBLE / total, 4)",
    "sense_frag_pct_of_aligned": "round(sense * 100.0::DOUBLE / aligned, 4)",
    **{f"{t}_pct_of_aligned": f"round(({t}_0 + {t}_1) * 100.0::DOUBLE / aligned, 4)" for t in _FC}, **{f"{t}_sense_pct": f"CASE WHEN {t}_0 + {t}_1 = 0 THEN 0 ELSE round({t}_0 * 100.0::DOUBLE / ({t}_0 + {t}_1), 4) END" for t in _FC},
}


@query(
    "g11_featurecounts_metrics",
    "lines",
    sql=FCOUNTS
    + ", typed AS (SELECT *, feature LIKE 'AS\\_%' ESCAPE '\\' AS is_as, split_part(regexp_replace(feature, '^AS_', ''), ':', 1) AS kind FROM fcounts), wide AS (SELECT sample_id, sum(n) AS aligned, sum(n) FILTER (NOT is_as) AS sense, sum(n) * 2 AS total, "
    + ", ".join(f"coalesce(sum(n) FILTER (kind = '{t}' AND {c}), 0) AS {t}_{s}" for t in _FC for s, c in (("0", "NOT is_as"), ("1", "is_as")))
    + " FROM typed GROUP BY sample_id) "
    + " UNION ALL ".join(f"SELECT sample_id, '{n}' AS metrics_type, CAST({e} AS DOUBLE) AS value FROM wide" for n, e in _FC_OUT.items()),
)
def g11_featurecounts_metrics(lines):
    counts = fcounts(lines)
    return Q.featurecounts_metrics(counts, counts.groupBy("sample_id").agg((F.sum("n") * 2).alias("total")))


# counts of every gene in every sample
GCOUNTS = """gcounts AS (SELECT g.gene, s.sample_id, CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS n FROM (SELECT DISTINCT concat(CASE WHEN l_partkey % 4 = 0 THEN 'rRNA' ELSE 'CDS' END, ':g', l_partkey % 400, ':', l_partkey % 400 + 100, ':+') AS gene, l_partkey % 400 AS k FROM lines) g
 CROSS JOIN (SELECT DISTINCT concat('S', l_suppkey % 6) AS sample_id, l_suppkey % 6 AS j FROM lines) s LEFT JOIN lines l ON l.l_partkey % 400 = g.k AND l.l_suppkey % 6 = s.j GROUP BY g.gene, s.sample_id)
"""
SAMPLES = [f"S{i}" for i in range(6)]


def gcounts(lines):
    sql = GCOUNTS[GCOUNTS.index("(") + 1 : GCOUNTS.rindex(")")].replace("FROM lines", "FROM {lines}").replace("JOIN lines", "JOIN {lines}")
    return lines.sparkSession.sql(sql, lines=lines)


@query("g12_gene_matrix", "lines", sql=GCOUNTS + "SELECT gene, " + ", ".join(f"CAST(sum(n) FILTER (sample_id = '{s}') AS BIGINT) AS {s}" for s in SAMPLES) + " FROM gcounts GROUP BY gene")
def g12_gene_matrix(lines):
    return Q.gene_matrix(gcounts(lines), SAMPLES)


def _cell_counts(lines):
    """Counts of genes by cells, as many as there are orders."""
    return lines.select(F.concat(F.lit("g"), F.col("l_partkey") % 1000).alias("gene"), F.concat(F.lit("cell"), "l_orderkey").alias("sample_id"), F.col("l_quantity").cast("long").alias("n"))


CELLS = "cells AS (SELECT concat('g', l_partkey % 1000) AS gene, concat('cell', l_orderkey) AS sample_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n FROM lines GROUP BY ALL)\n"


@query(
    "g12_sparse_matrix",
    "lines",
    sql=CELLS + """, r AS (SELECT gene, row_number() OVER (ORDER BY gene) - 1 AS row FROM (SELECT DISTINCT gene FROM cells)), c AS (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS "column" FROM (SELECT DISTINCT sample_id FROM cells))
SELECT row, "column", gene, sample_id, n FROM cells JOIN r USING (gene) JOIN c USING (sample_id) WHERE n <> 0""",
)
def g12_sparse_matrix(lines):
    """The index tables and coordinates of a matrix of thousands of cells, as they were written."""
    spark, path = lines.sparkSession, scratch(lines.sparkSession)
    sparse.write_sparse_matrix(_cell_counts(lines), path)
    rows, columns, entries = (spark.read.parquet(f"{path}/{t}") for t in ("rows", "columns", "entries"))
    return entries.join(rows, "row").join(columns, "column").select("row", "column", "gene", "sample_id", "n")


@query("s11_sparse_matrix", "lines", sql=GCOUNTS + "SELECT gene, " + ", ".join(f"CAST(sum(n) FILTER (sample_id = '{s}') AS BIGINT) AS {s}" for s in ("S1", "S4")) + " FROM gcounts GROUP BY gene")
def s11_sparse_matrix(lines):
    """Two columns of a written matrix."""
    spark, path = lines.sparkSession, scratch(lines.sparkSession)
    sparse.write_sparse_matrix(gcounts(lines), path, block_rows=64, block_columns=2)
    return sparse.matrix_columns(spark, path, ["S1", "S4"])


@query("g13_metrics_matrix", "lines", sql="SELECT concat('S', l_suppkey % 8) AS sample_id, count(*) AS reads, count(DISTINCT l_partkey) AS genes FROM lines GROUP BY 1")
def g13_metrics_matrix(lines):
    wide = lines.groupBy(F.concat(F.lit("S"), F.col("l_suppkey") % 8).alias("sample_id")).agg(F.count(F.lit(1)).alias("reads"), F.countDistinct("l_partkey").alias("genes"))
    return Q.metrics_matrix(wide.unpivot(["sample_id"], ["reads", "genes"], "metrics_type", "count"), ["reads", "genes"])


HALVES = GCOUNTS + ", a AS (SELECT * FROM gcounts WHERE sample_id <> 'S0'), b AS (SELECT gene, sample_id, n + 1 AS n FROM gcounts WHERE sample_id <> 'S5')\n"


def _halves(lines):
    counts = gcounts(lines)
    return counts.filter("sample_id <> 'S0'"), counts.filter("sample_id <> 'S5'").withColumn("n", F.col("n") + 1)


@query("g14_merge_count_matrices", "lines", sql=HALVES + "SELECT gene, sample_id, CAST(sum(n) AS BIGINT) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY gene, sample_id")
def g14_merge_count_matrices(lines):
    return Q.merge_count_matrices(*_halves(lines))


@query("g14_paste_count_matrices", "lines", sql=HALVES + "SELECT gene, concat(sample_id, '_1') AS sample_id, n FROM a UNION ALL SELECT gene, concat(sample_id, '_2'), n FROM b")
def g14_paste_count_matrices(lines):
    return Q.merge_count_matrices(*_halves(lines), how="paste")


@query("g15_column_totals", "lines", sql=GCOUNTS + "SELECT sample_id, CAST(sum(n) AS BIGINT) AS total FROM gcounts GROUP BY sample_id")
def g15_column_totals(lines):
    return Q.column_totals(gcounts(lines))


# key metrics as J7 and J8 would give them
KM = """km AS (SELECT concat('P', k.s % 3) AS Project_ID, concat('pool', k.s % 10) AS Pool_ID, concat('S', k.s) AS Sample_ID, CAST(k.s % 7 AS DOUBLE) AS Pcnt_bc_in_pool, k.n * 5000 AS Num_bc_reads, k.n * 4000 AS Total_reads, CAST(k.s % 90 + 5 AS DOUBLE) AS pcnt_aligned, CAST(k.s % 60 + 20 AS DOUBLE) AS pcnt_proper,
 CAST(100 + k.s % 50 AS DOUBLE) AS mean_insert, k.n * 2000 AS Total_frags_counted, CAST(k.s % 50 + 40 AS DOUBLE) AS pcnt_sense, k.n * (k.s % 12) * 100 AS CDS_total, CAST(k.s % 30 + 60 AS DOUBLE) AS CDS_pcnt_sense, 10.5 + k.s % 4 AS rRNA_pcnt_of_counted, 60.0 + k.s % 3 AS rRNA_pcnt_sense, 1.5 + k.s % 2 AS misc_RNA_pcnt_of_counted,
 55.0 + k.s % 5 AS misc_RNA_pcnt_sense, 2.25 + k.s % 3 AS tRNA_pcnt_of_counted, 70.0 + k.s % 6 AS tRNA_pcnt_sense, 3.0 + k.s % 7 AS IGR_pcnt_of_counted, k.n AS total_read1s, k.n % 100 AS trimmed_read1s, k.n % 10 AS empty_read1s, k.n AS total_read2s, k.n % 90 AS trimmed_read2s, k.n % 9 AS empty_read2s,
 CASE WHEN k.s % 10 = 3 THEN 0 ELSE k.n END AS total_read_pairs, k.n % 80 AS trimmed_read_pairs, k.n % 8 AS empty_read_pairs FROM (SELECT l_suppkey AS s, count(*) AS n FROM lines GROUP BY l_suppkey) k)
"""


def km(lines):
    sql = KM[KM.index("(") + 1 : KM.rindex(")")].replace("FROM lines", "FROM {lines}")
    return lines.sparkSession.sql(sql, lines=lines)


def _pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE round({a} * 100.0::DOUBLE / {b}, 4) END"


POOLS = KM + """, r1 AS (SELECT *, CAST(floor(Total_reads * pcnt_aligned / 100) AS BIGINT) AS ar, CAST(floor(CDS_pcnt_sense * CDS_total / 100) AS BIGINT) AS cds_s, CAST(floor(rRNA_pcnt_of_counted::DOUBLE * Total_frags_counted / 100) AS BIGINT) AS rf,
 CAST(floor(misc_RNA_pcnt_of_counted::DOUBLE * Total_frags_counted / 100) AS BIGINT) AS mf, CAST(floor(tRNA_pcnt_of_counted::DOUBLE * Total_frags_counted / 100) AS BIGINT) AS tf, CAST(floor(IGR_pcnt_of_counted::DOUBLE * Total_frags_counted / 100) AS BIGINT) AS igf FROM km),
r2 AS (SELECT *, CAST(floor(ar * pcnt_sense / 100) AS BIGINT) AS sr, CAST(floor(rRNA_pcnt_sense::DOUBLE * rf / 100) AS BIGINT) AS rs, CAST(floor(misc_RNA_pcnt_sense::DOUBLE * mf / 100) AS BIGINT) AS ms, CAST(floor(tRNA_pcnt_sense::DOUBLE * tf / 100) AS BIGINT) AS ts FROM r1),
p AS (SELECT Pool_ID, sum(Pcnt_bc_in_pool) AS mapped, sum(Total_reads) AS tr, sum(Total_frags_counted) AS fc, sum(ar) AS ar, sum(sr) AS sr, sum(CDS_total) AS ct, sum(cds_s) AS cds_s, sum(rf) AS rf, sum(rs) AS rs, sum(mf) AS mf, sum(ms) AS ms, sum(tf) AS tf, sum(ts) AS ts, sum(igf) AS igf,
 sum(pcnt_aligned * Pcnt_bc_in_pool) AS wa, sum(pcnt_proper * Pcnt_bc_in_pool) AS wp, sum(mean_insert * Pcnt_bc_in_pool) AS wi, """ + ", ".join(f"sum({q}_{r}) AS {q}_{r}" for q in ("total", "trimmed", "empty") for r in ("read1s", "read2s", "read_pairs")) + f""" FROM r2 GROUP BY Pool_ID)
SELECT Pool_ID, CAST(tr AS BIGINT) AS reads_assigned, CASE WHEN mapped = 0 THEN 0 ELSE CAST(floor(tr * 100.0::DOUBLE / mapped) AS BIGINT) END AS reads_with_unassigned, CAST(fc AS BIGINT) AS frags_counted, round(mapped, 4) AS pcnt_mapped_to_bcs, CASE WHEN mapped = 0 THEN 0 ELSE round(wa / mapped, 4) END AS pcnt_aligned,
 CASE WHEN mapped = 0 THEN 0 ELSE round(wp / mapped, 4) END AS pcnt_proper, CASE WHEN mapped = 0 THEN 0 ELSE round(wi / mapped, 4) END AS mean_insert, {_pct('sr', 'ar')} AS pcnt_sense, CAST(ct AS BIGINT) AS CDS_total, {_pct('ct', 'fc')} AS CDS_pcnt_of_counted, {_pct('cds_s', 'ct')} AS CDS_pcnt_sense,
 {_pct('rf', 'fc')} AS rRNA_pcnt_of_counted, {_pct('rs', 'rf')} AS rRNA_pcnt_sense, {_pct('mf', 'fc')} AS misc_RNA_pcnt_of_counted, {_pct('ms', 'mf')} AS misc_RNA_pcnt_sense, {_pct('tf', 'fc')} AS tRNA_pcnt_of_counted, {_pct('ts', 'tf')} AS tRNA_pcnt_sense, {_pct('igf', 'fc')} AS IGR_pcnt_of_counted, """ + ", ".join(
    f"{_pct(f'{q}_{r}', f'total_{r}')} AS pcnt_{q}_{r}" for r in ("read1s", "read2s", "read_pairs") for q in ("trimmed", "empty")
) + " FROM p"


@query("g16_pool_metrics", "lines", sql=POOLS)
def g16_pool_metrics(lines):
    return Q.pool_metrics(km(lines))


@query(
    "g17_depth_report",
    "lines",
    sql=KM
    + """SELECT Project_ID, Pool_ID, round(avg(Num_bc_reads) FILTER (Num_bc_reads > 0) / 1e6, 2) AS reads_avg, round(100.0::DOUBLE * count(*) FILTER (Num_bc_reads > 3e6) / count(*), 1) AS reads_pcnt, concat('(', count(*) FILTER (Num_bc_reads > 3e6), '/', count(*), ')') AS reads_met,
round(avg(CDS_total) FILTER (CDS_total > 0) / 1e6, 2) AS cds_avg, round(100.0::DOUBLE * count(*) FILTER (CDS_total > 5e5) / count(*), 1) AS cds_pcnt, concat('(', count(*) FILTER (CDS_total > 5e5), '/', count(*), ')') AS cds_met FROM km GROUP BY ALL""",
)
def g17_depth_report(lines):
    return Q.depth_report(km(lines), 3.0, 0.5)


@query(
    "g17_depth_misses",
    "lines",
    sql=KM
    + """SELECT k.Project_ID, k.Pool_ID, Sample_ID, CDS_total, CASE WHEN CDS_total > 0 THEN round((5e5 - CDS_total) / CDS_total * a, 4) END AS top_up FROM km k JOIN (SELECT Project_ID, Pool_ID, round(avg(Num_bc_reads) FILTER (Num_bc_reads > 0) / 1e6, 2) AS a FROM km GROUP BY ALL) r USING (Project_ID, Pool_ID) WHERE CDS_total < 5e5""",
)
def g17_depth_misses(lines):
    return Q.depth_misses(km(lines))


@query("g18_low_samples", "lines", sql=KM + "SELECT Sample_ID, CDS_total FROM km WHERE CDS_total < 300000")
def g18_low_samples(lines):
    return Q.low_samples(km(lines), 300_000).select("Sample_ID", "CDS_total")


@query("g19_missing_metric_samples", "key_table", sql="SELECT Sample_ID FROM key_table WHERE Bacterial_reference = '' OR CG_Pairs = '' OR Lane = ''")
def g19_missing_metric_samples(key_table):
    return Q.missing_metric_samples(key_table, ["Bacterial_reference", "CG_Pairs", "Lane", "Pool_ID"]).select("Sample_ID")


HOST = """host AS (SELECT concat('S', l_suppkey % 8) AS sample_id, concat(CASE WHEN l_linenumber = 1 THEN 'AS:' ELSE '' END, CASE l_partkey % 9 WHEN 0 THEN 'NR_003:rRNA' WHEN 1 THEN 'ENSG1:cdna:MT:Mt_rRNA:1' ELSE concat('ENSG', l_partkey % 90, ':cdna:s:protein_coding:1') END) AS Geneid, count(*) AS Fragcount FROM lines GROUP BY ALL)
"""


@query(
    "g20_host_rrna_pct",
    "lines",
    sql=HOST
    + """SELECT sample_id, round(100.0::DOUBLE * sum(CASE WHEN Geneid LIKE '%NR_003%' OR Geneid LIKE '%Mt_rRNA%' THEN Fragcount ELSE 0 END) / sum(Fragcount), 4) AS pcnt_rrna, round(100.0::DOUBLE * sum(CASE WHEN Geneid LIKE '%NR_003%' THEN Fragcount ELSE 0 END) / sum(Fragcount), 4) AS pcnt_nuclear,
round(100.0::DOUBLE * sum(CASE WHEN Geneid LIKE '%Mt_rRNA%' THEN Fragcount ELSE 0 END) / sum(Fragcount), 4) AS pcnt_mt FROM host GROUP BY sample_id""",
)
def g20_host_rrna_pct(lines):
    sql = HOST[HOST.index("(") + 1 : HOST.rindex(")")].replace("FROM lines", "FROM {lines}").replace("GROUP BY ALL", "GROUP BY 1, 2")
    return Q.host_rrna_pct(lines.sparkSession.sql(sql, lines=lines))


@query(
    "g21_gene_ratio",
    "lines",
    sql=FCOUNTS
    + "SELECT sample_id, round(sum(CASE WHEN feature LIKE 'rRNA:%' THEN n ELSE 0 END)::DOUBLE / sum(CASE WHEN feature LIKE 'CDS:%' THEN n ELSE 0 END), 6) AS rrna, round(sum(CASE WHEN feature LIKE 'tRNA:%' THEN n ELSE 0 END)::DOUBLE / sum(CASE WHEN feature LIKE 'CDS:%' THEN n ELSE 0 END), 6) AS trna FROM fcounts GROUP BY sample_id",
)
def g21_gene_ratio(lines):
    return Q.gene_ratio(fcounts(lines), {"rrna": "^rRNA:", "trna": "^tRNA:"})


LOG = """log AS (SELECT concat('S', l_suppkey % 8) AS sample_id, concat('r', l_orderkey, '_', l_partkey) AS read_name, concat(CASE WHEN l_linenumber % 2 = 1 THEN '1' ELSE '2' END, ':N:0') AS mate, CASE WHEN l_quantity < 6 THEN 0 ELSE 50 END AS surviving_len, CASE WHEN l_quantity > 45 THEN 3 ELSE 0 END AS first_base, CASE WHEN l_partkey % 7 = 0 THEN 5 ELSE 0 END AS trimmed_end FROM lines)
"""
_SHARES = ", ".join(f"CASE WHEN total_{r} = 0 THEN 0 ELSE round(100.0::DOUBLE * {p}_{r} / total_{r}, 2) END AS percent_{p}_{r}" for r in ("read1s", "read2s", "read_pairs") for p in ("trimmed", "empty"))


@query(
    "g22_trim_stats",
    "lines",
    sql=LOG
    + f""", flagged AS (SELECT *, surviving_len = 0 OR first_base <> 0 OR trimmed_end <> 0 AS cut, surviving_len = 0 AS gone, mate LIKE '1%' AS one FROM log),
pairs AS (SELECT sample_id, read_name, count(*) FILTER (one) AS r1, count(*) FILTER (NOT one) AS r2, count(*) FILTER (one AND cut) AS t1, count(*) FILTER (NOT one AND cut) AS t2, count(*) FILTER (one AND gone) AS e1, count(*) FILTER (NOT one AND gone) AS e2, bool_or(cut) AS cut, count(*) FILTER (gone) AS g FROM flagged GROUP BY ALL),
sums AS (SELECT sample_id, CAST(sum(r1) AS BIGINT) AS total_read1s, CAST(sum(t1) AS BIGINT) AS trimmed_read1s, CAST(sum(e1) AS BIGINT) AS empty_read1s, CAST(sum(r2) AS BIGINT) AS total_read2s, CAST(sum(t2) AS BIGINT) AS trimmed_read2s, CAST(sum(e2) AS BIGINT) AS empty_read2s, count(*) AS total_read_pairs, count(*) FILTER (cut) AS trimmed_read_pairs, count(*) FILTER (g = 2) AS empty_read_pairs FROM pairs GROUP BY sample_id)
SELECT *, {_SHARES} FROM sums""",
)
def g22_trim_stats(lines):
    sql = LOG[LOG.index("(") + 1 : LOG.rindex(")")].replace("FROM lines", "FROM {lines}")
    return Q.trim_stats(lines.sparkSession.sql(sql, lines=lines))


HITS = """hits AS (SELECT concat('q', l_orderkey) AS query_seqid, CASE WHEN l_linenumber % 3 = 0 THEN 'Index1' ELSE 'TruSeq' END AS sub_seqid, l_quantity / 1000 AS evalue, CAST(l_partkey % 60 AS INT) AS query_start, CAST(l_suppkey % 90 AS INT) AS sub_start FROM lines)
"""


def _hits(lines):
    sql = HITS[HITS.index("(") + 1 : HITS.rindex(")")].replace("FROM lines", "FROM {lines}")
    return lines.sparkSession.sql(sql, lines=lines)


def _insertions(protocol: str) -> str:
    liked, before, other, regions = Q.ADAPTERS[protocol]
    cases = " ".join(f"WHEN start < {until} THEN '{name}'" for (name, _), (_, until) in zip(regions[:-1], regions[1:], strict=True))
    return (
        HITS
        + f""", ranked AS (SELECT *, lower(sub_seqid) <> '{liked}' AS other, row_number() OVER (PARTITION BY query_seqid ORDER BY lower(sub_seqid) <> '{liked}', evalue, query_start, sub_start) AS r FROM hits),
placed AS (SELECT query_seqid, -(query_start - sub_start - CASE WHEN other THEN {other} ELSE {before} END) AS start FROM ranked WHERE r = 1),
insertions AS (SELECT query_seqid, start, CASE {cases} ELSE '{regions[-1][0]}' END AS region FROM placed)
"""
    )


def _register_insertions(protocol: str) -> None:
    @query(f"g23_adapter_insertions_{protocol}", "lines", sql=_insertions(protocol) + "SELECT * FROM insertions")
    def insertions(lines):
        return Q.adapter_insertions(_hits(lines), protocol)


for _p in ("rts", "scr"):
    _register_insertions(_p)


@query("g23_adapter_histogram", "lines", sql=_insertions("rts") + "SELECT region, start, count(*) AS n FROM insertions GROUP BY ALL")
def g23_adapter_histogram(lines):
    return Q.adapter_histogram(Q.adapter_insertions(_hits(lines), "rts"))


@query(
    "g23_adapter_totals",
    "lines",
    sql=_insertions("rts")
    + """, t AS (SELECT count(*) AS w, count(*) FILTER (region = 'dna') AS d FROM insertions)
SELECT 'total' AS what, CAST(1000000 AS BIGINT) AS reads FROM t UNION ALL SELECT 'with_adapter', w FROM t UNION ALL SELECT 'without_adapter', 1000000 - w FROM t UNION ALL SELECT 'only_adapter', w - d FROM t UNION ALL SELECT 'with_dna', d FROM t""",
)
def g23_adapter_totals(lines):
    return Q.adapter_totals(Q.adapter_insertions(_hits(lines), "rts"), 1_000_000)


@query(
    "g24_cell_barcode_counts",
    "reads",
    "lines",
    "barcodes",
    sql="SELECT r.true_barcode AS cell, count(*) AS total, count(h.id) AS aligned FROM reads r LEFT JOIN (SELECT DISTINCT id FROM lines WHERE l_partkey % 3 > 0) h ON r.read_id = h.id WHERE r.true_barcode IN (SELECT bc_name FROM barcodes WHERE bc_no < 15) GROUP BY 1",
)
def g24_cell_barcode_counts(reads, lines, barcodes):
    own = reads.select("read_id", F.col("true_barcode").alias("cell"))
    aln = lines.select(F.col("id").alias("read_id"), F.when(F.col("l_partkey") % 3 > 0, 0).otherwise(4).alias("flag"))
    return Q.cell_barcode_counts(own, aln, barcodes.filter("bc_no < 15").select(F.col("bc_name").alias("cell")))


CELLS = """cells AS (SELECT ord, concat(substr(r1_seq, 1, 5), CASE WHEN sample_no % 4 = 0 THEN 'A' ELSE 'C' END) AS cell, substr(index_seq, 1, 6) AS umi FROM reads WHERE length(r1_seq) >= 9)
"""


@query("g25_barcode_umis", "reads", sql=CELLS + "SELECT cell, count(DISTINCT umi) AS umis FROM cells GROUP BY cell")
def g25_barcode_umis(reads):
    return Q.barcode_umis(_cells(reads))


def _cells(reads):
    sql = CELLS[CELLS.index("(") + 1 : CELLS.rindex(")")].replace("FROM reads", "FROM {reads}")
    return reads.sparkSession.sql(sql, reads=reads)


@query(
    "g25_barcode_whitelist",
    "reads",
    sql=CELLS
    + """, counts AS (SELECT cell, count(DISTINCT umi) AS umis FROM cells GROUP BY cell), steps AS (SELECT umis, count(*) AS m FROM counts GROUP BY umis), ranked AS (SELECT umis, sum(m) OVER (ORDER BY umis DESC) AS rank FROM steps),
ends AS (SELECT max(umis) AS y1, min(umis) AS y2, min(rank) AS x1, max(rank) AS x2 FROM ranked),
knee AS (SELECT umis AS knee FROM ranked, ends ORDER BY abs((y2 - y1) * rank - (x2 - x1) * umis + x2 * y1 - y2 * x1) DESC, umis DESC LIMIT 1),
near AS (SELECT r.cell, r.umis, k.cell AS kept_as, hamming(r.cell, k.cell) AS d, min(hamming(r.cell, k.cell)) OVER (PARTITION BY r.cell) AS least FROM counts r, counts k, knee WHERE r.umis < knee AND k.umis >= knee)
SELECT cell, umis, cell AS kept_as FROM counts, knee WHERE umis >= knee UNION ALL SELECT cell, umis, min(kept_as) FROM near WHERE d = least AND d <= 1 GROUP BY cell, umis HAVING count(*) = 1""",
)
def g25_barcode_whitelist(reads):
    return Q.barcode_whitelist(_cells(reads), 1, None)


@query("g26_status_summary", "lines", sql="SELECT l_returnflag AS library_type, l_linestatus AS status, count(DISTINCT l_suppkey % 10) AS projects, count(DISTINCT l_suppkey) AS samples, count(*) AS n FROM lines GROUP BY ALL")
def g26_status_summary(lines):
    return Q.status_summary(lines.select(F.col("l_returnflag").alias("library_type"), F.col("l_linestatus").alias("status"), (F.col("l_suppkey") % 10).alias("project"), F.col("l_suppkey").alias("sample")))


TESTS = "tests AS (SELECT concat('st', l_suppkey) AS strain, concat('NC_', l_partkey % 7) AS accession, sum(l_quantity) / 1e5 AS frac_aligned FROM lines GROUP BY ALL)\n"


@query(
    "g27_best_reference",
    "lines",
    sql=TESTS
    + """, means AS (SELECT accession, avg(frac_aligned) AS mean FROM tests GROUP BY 1), overall AS (SELECT accession AS overall, mean AS overall_mean FROM means ORDER BY mean DESC, accession DESC LIMIT 1),
best AS (SELECT strain, accession AS best, frac_aligned AS best_frac FROM (SELECT *, row_number() OVER (PARTITION BY strain ORDER BY frac_aligned DESC, accession DESC) AS r FROM tests) WHERE r = 1), ranked AS (SELECT *, rank() OVER (PARTITION BY strain ORDER BY frac_aligned DESC) AS rank FROM tests)
SELECT strain, best, round(best_frac, 6) AS best_frac, overall, round(overall_mean, 6) AS overall_mean, round(frac_aligned, 6) AS frac_on_overall, round(best_frac - frac_aligned, 6) AS gap, CAST(rank AS INT) AS rank FROM best LEFT JOIN (SELECT * FROM ranked JOIN overall ON accession = overall) USING (strain)""",
)
def g27_best_reference(lines):
    return Q.best_reference(lines.groupBy(F.concat(F.lit("st"), "l_suppkey").alias("strain"), F.concat(F.lit("NC_"), F.col("l_partkey") % 7).alias("accession")).agg((F.sum("l_quantity") / 1e5).alias("frac_aligned")))


@query("g28_top_per_species", "part", sql="SELECT species, ord, name FROM (SELECT p_brand AS species, p_partkey AS ord, p_name AS name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part) WHERE r <= 5")
def g28_top_per_species(part):
    return Q.top_per_species(part.select(F.col("p_brand").alias("species"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("name")), 5)


@query(
    "g29_longest_per_gene",
    "part",
    sql="""seqs AS (SELECT p_type AS gene, p_brand AS strain, concat('n', p_partkey) AS name, repeat('A', p_size) AS seq FROM part), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene, strain ORDER BY length(seq) DESC, name) AS a FROM seqs) WHERE a = 1)
SELECT gene, strain, name, seq FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY length(seq) DESC, name) AS r FROM one) WHERE r <= 7""",
)
def g29_longest_per_gene(part):
    seqs = part.select(F.col("p_type").alias("gene"), F.col("p_brand").alias("strain"), F.concat(F.lit("n"), "p_partkey").alias("name"), F.repeat(F.lit("A"), F.col("p_size")).alias("seq"))
    return Q.longest_per_gene(seqs, 7)
