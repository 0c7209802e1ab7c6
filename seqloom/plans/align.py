"""Queries of the alignment operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.operators import align as A
from seqloom.operators import umis
from seqloom.plans.registry import query

MATES = "mated AS (SELECT sample_id, qname, max(CASE WHEN flag & 64 > 0 THEN {'f': flag, 'r': rname} END) AS r1, max(CASE WHEN flag & 128 > 0 THEN {'f': flag, 'r': rname} END) AS r2 FROM alignments GROUP BY ALL)\n"
CLASSIFIED = (
    MATES
    + """, classified AS (SELECT sample_id, qname, r1.f & 2 > 0 AS proper, r1.r AS ref1, r2.r AS ref2,
 CASE WHEN r1 IS NULL OR r2 IS NULL THEN 'broken' WHEN r1.f & 4 > 0 AND r2.f & 4 > 0 THEN 'unmapped'
  WHEN r2.f & 4 > 0 THEN CASE WHEN r1.f & 16 > 0 THEN 'r1_sense_single' ELSE 'r1_antisense_single' END
  WHEN r1.f & 4 > 0 THEN CASE WHEN r2.f & 16 > 0 THEN 'r2_antisense_single' ELSE 'r2_sense_single' END
  WHEN r1.f & 16 > 0 AND r2.f & 16 > 0 THEN 'both_reverse' WHEN r1.f & 16 = 0 AND r2.f & 16 = 0 THEN 'both_forward' WHEN r1.f & 16 > 0 THEN 'sense' ELSE 'antisense' END AS class FROM mated)
"""
)


@query("a1_classify_pairs", "alignments", sql=CLASSIFIED + "SELECT * FROM classified")
def a1_classify_pairs(alignments):
    return A.classify_pairs(alignments)


COUNTED = """, hits AS (
 SELECT sample_id, NOT contains(class, 'antisense') AS sense, CASE WHEN class LIKE 'r2%' THEN ref2 ELSE ref1 END AS transcript, 1 AS reads FROM classified WHERE class LIKE '%_single' UNION ALL
 SELECT sample_id, class = 'sense', ref1, 2 FROM classified WHERE class IN ('sense','antisense') AND ref1 = ref2 UNION ALL
 SELECT sample_id, class = 'sense', unnest([ref1, ref2]), 1 FROM classified WHERE class IN ('sense','antisense') AND ref1 <> ref2),
tcounts AS (SELECT s.sample_id, r.rname AS transcript, CAST(coalesce(sum(reads) FILTER (sense), 0) AS BIGINT) AS s_read, CAST(coalesce(sum(reads) FILTER (NOT sense), 0) AS BIGINT) AS as_read,
 count(reads) FILTER (sense) AS s_frag, count(reads) FILTER (NOT sense) AS as_frag
 FROM (SELECT DISTINCT sample_id FROM hits) s CROSS JOIN refs r LEFT JOIN hits h ON h.sample_id = s.sample_id AND h.transcript = r.rname GROUP BY ALL)
"""


@query("a2_count_transcripts", "alignments", "refs", sql=CLASSIFIED + COUNTED + "SELECT * FROM tcounts")
def a2_count_transcripts(alignments, references):
    return A.count_transcripts(A.classify_pairs(alignments), references)


SINGLES = """tcounts AS (SELECT s.sample_id, r.rname AS transcript, count(*) FILTER (h.flag = 16) AS s_read, count(*) FILTER (h.flag = 0) AS as_read, count(*) FILTER (h.flag = 16) AS s_frag, count(*) FILTER (h.flag = 0) AS as_frag
 FROM (SELECT DISTINCT sample_id FROM singles WHERE flag <> 4) s CROSS JOIN refs r LEFT JOIN singles h ON h.sample_id = s.sample_id AND h.rname = r.rname AND h.flag <> 4 GROUP BY ALL)
"""


@query("a3_count_transcripts_single", "singles", "refs", sql=SINGLES + "SELECT * FROM tcounts")
def a3_count_transcripts_single(singles, references):
    return A.count_transcripts_single(singles, references)


UMIS = r"""tumi AS (SELECT sample_id, rname AS transcript, regexp_extract(qname, '^\S+?umi_(\w{6})', 1) AS umi, count(*) FILTER (flag = 16) AS s_read, count(*) FILTER (flag = 0) AS as_read,
 count(*) FILTER (flag = 16) AS s_frag, count(*) FILTER (flag = 0) AS as_frag FROM singles WHERE flag <> 4 GROUP BY ALL)
"""


@query("a4_count_transcripts_umi", "singles", sql=UMIS + "SELECT * FROM tumi")
def a4_count_transcripts_umi(singles):
    return A.count_transcripts_umi(singles)


_TALLIES = {
    "read_both_forward": "2 * count(*) FILTER (class = 'both_forward')",
    "read_both_reverse": "2 * count(*) FILTER (class = 'both_reverse')",
    **{f"read{k}_{s}{i}": f"count(*) FILTER (class = '{c}' AND {p})" for k in (1, 2) for s, c in (("s", "sense"), ("as", "antisense")) for i, p in (("", "proper"), ("_i", "NOT proper"))},
    **{f"read{k}_{s}_mu": f"count(*) FILTER (class = 'r{k}_{c}_single')" for k in (1, 2) for s, c in (("s", "sense"), ("as", "antisense"))},
    "unmapped_reads": "2 * count(*) FILTER (class = 'unmapped') + count(*) FILTER (class LIKE '%_single')",
    "total_reads": "2 * count(*) FILTER (class <> 'broken')",
    **{n: f"coalesce(sum(CASE WHEN class IN ('sense','antisense') AND ref1 <> ref2 THEN 2 ELSE 1 END) FILTER ({c}), 0)" for n, c in (("sense_frags", "class LIKE '%sense%' AND class NOT LIKE '%antisense%'"), ("antisense_frags", "class LIKE '%antisense%'"), ("aligned_frags", "class LIKE '%sense%'"))},
}


@query("a5_pair_metrics", "alignments", sql=CLASSIFIED + " UNION ALL ".join(f"SELECT sample_id, '{n}' AS metrics_type, CAST({e} AS BIGINT) AS count FROM classified GROUP BY sample_id" for n, e in _TALLIES.items()).join(["SELECT * FROM (", ")"]))
def a5_pair_metrics(alignments):
    return A.pair_metrics(A.classify_pairs(alignments))


# genes of the reference sequences: some ribosomal, one class each for the others
TMAP = """tmap AS (SELECT rname AS transcript, CASE rname WHEN 'chr0' THEN 'NR_0:r' WHEN 'chr1' THEN 'G1:cdna:s:protein_coding:1' WHEN 'chr2' THEN 'G1:cdna:s:protein_coding:1' WHEN 'chr3' THEN 'G3:cdna:s:lincRNA:1' ELSE 'G4:cdna:s:odd:1' END AS gene
 FROM refs WHERE rname <> 'chr4')
"""


def _tmap(references):
    name = F.col("rname")
    gene = F.when(name == "chr0", "NR_0:r").when(name.isin("chr1", "chr2"), "G1:cdna:s:protein_coding:1").when(name == "chr3", "G3:cdna:s:lincRNA:1").otherwise("G4:cdna:s:odd:1")
    return references.filter(name != "chr4").select(name.alias("transcript"), gene.alias("gene"))


GENES = TMAP + """, genes AS (SELECT s.sample_id, g.gene, CAST(coalesce(sum(s_frag), 0) AS BIGINT) AS s, CAST(coalesce(sum(as_frag), 0) AS BIGINT) AS a
 FROM (SELECT DISTINCT sample_id FROM tcounts) s CROSS JOIN tmap g LEFT JOIN tcounts t ON t.sample_id = s.sample_id AND t.transcript = g.transcript GROUP BY ALL),
gcounts AS (SELECT sample_id, gene AS Geneid, s AS Fragcount FROM genes UNION ALL SELECT sample_id, concat('AS:', gene), a FROM genes)
"""


@query("a6_gene_counts", "singles", "refs", sql=SINGLES + "," + GENES + "SELECT * FROM gcounts")
def a6_gene_counts(singles, references):
    return A.gene_counts(A.count_transcripts_single(singles, references), _tmap(references))


@query(
    "a7_gene_counts_umi",
    "singles",
    "refs",
    sql=UMIS
    + ","
    + TMAP
    + """SELECT sample_id, gene, count(*) FILTER (s >= 1) AS s_count, count(*) FILTER (a >= 1) AS as_count, CAST(sum(s) - count(*) FILTER (s >= 1) AS BIGINT) AS s_drop, CAST(sum(a) - count(*) FILTER (a >= 1) AS BIGINT) AS as_drop
FROM (SELECT sample_id, gene, umi, sum(s_frag) AS s, sum(as_frag) AS a FROM tumi JOIN tmap USING (transcript) GROUP BY ALL) GROUP BY sample_id, gene""",
)
def a7_gene_counts_umi(singles, references):
    return A.gene_counts_umi(A.count_transcripts_umi(singles), _tmap(references))


_CLASS_SQL = "CASE WHEN g LIKE 'NR\\_%' ESCAPE '\\' THEN 'ribosomal_rna' WHEN g LIKE '%protein_coding%' THEN 'protein_coding' WHEN g LIKE '%lincRNA%' THEN 'long_noncoding' ELSE 'uncategorized' END"


@query(
    "a8_biotype_metrics",
    "singles",
    "refs",
    sql=SINGLES
    + ","
    + GENES
    + f""", named AS (SELECT sample_id, Fragcount AS n, Geneid LIKE 'AS:%' AS is_as, {_CLASS_SQL} AS class FROM (SELECT *, regexp_replace(Geneid, '^AS:', '') AS g FROM gcounts)),
sums AS (SELECT sample_id, c, coalesce(sum(n) FILTER (class = c AND NOT is_as), 0) AS s, coalesce(sum(n) FILTER (class = c AND is_as), 0) AS a, sum(n) AS whole FROM named, (SELECT unnest({list(A.CLASSES)}) AS c) GROUP BY ALL)
SELECT sample_id, concat(c, '_frags_pct_of_aligned_frags') AS metrics_type, CASE WHEN whole = 0 THEN 0 ELSE round((s + a) * 100.0::DOUBLE / whole, 4) END AS pct FROM sums UNION ALL
SELECT sample_id, concat(c, '_frags_sense_pct'), CASE WHEN s + a = 0 THEN 0 ELSE round(s * 100.0::DOUBLE / (s + a), 4) END FROM sums""",
)
def a8_biotype_metrics(singles, references):
    return A.biotype_metrics(A.gene_counts(A.count_transcripts_single(singles, references), _tmap(references)))


REF_LEN = r"CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MD]', 1), lambda x: CAST(x AS BIGINT))), 0) AS BIGINT)"


def strand_sql(f: str) -> str:
    rev, off, mrev = f"({f} & 16 > 0)", f"({f} & 8 > 0)", f"({f} & 32 > 0)"
    return f"""CASE WHEN {f} & 64 > 0 THEN CASE WHEN {rev} OR (NOT {mrev} AND NOT {off}) THEN '+' ELSE '-' END WHEN {f} & 128 > 0 THEN CASE WHEN NOT {rev} OR {mrev} THEN '+' ELSE '-' END
 WHEN {f} = 0 THEN '+' WHEN {f} = 16 THEN '-' ELSE '0' END"""


FRAGMENTS = f"""placed AS (SELECT *, CAST(pos AS BIGINT) AS s, CAST(pos AS BIGINT) + {REF_LEN} AS e FROM alignments),
couples AS (SELECT sample_id, qname, max(CASE WHEN flag & 64 > 0 THEN {{'f': flag, 'r': rname, 's': s, 'e': e}} END) AS r1, max(CASE WHEN flag & 128 > 0 THEN {{'f': flag, 'r': rname, 's': s, 'e': e}} END) AS r2
 FROM placed WHERE flag & 2 > 0 GROUP BY ALL),
fragments AS (SELECT sample_id, rname AS acc, s AS start_pos, e AS end_pos, {strand_sql('flag')} AS strand, FALSE AS paired, qname AS name FROM placed WHERE flag & 2 = 0 AND flag & 4 = 0 UNION ALL
 SELECT sample_id, r2.r, CASE WHEN r1.s <= r2.s THEN r1.s ELSE r2.s END, CASE WHEN coalesce(r1.s <= r2.s, TRUE) THEN r2.e ELSE r1.e END, {strand_sql('r2.f')}, TRUE, qname FROM couples WHERE r2 IS NOT NULL)
"""


@query("a9_fragments", "alignments", sql=FRAGMENTS + "SELECT * FROM fragments")
def a9_fragments(alignments):
    return A.fragments(alignments)


@query("a9_fragments_single", "singles", sql=f"SELECT sample_id, rname AS acc, CAST(pos AS BIGINT) AS start_pos, CAST(pos AS BIGINT) + {REF_LEN} AS end_pos, CASE flag WHEN 0 THEN '-' ELSE '+' END AS strand, FALSE AS paired, qname AS name FROM singles WHERE flag <> 4 AND rname = 'chr1'")
def a9_fragments_single(singles):
    return A.fragments(singles, strand_rev=True, ref_filter="chr1")


@query(
    "a10_alignment_summary",
    "alignments",
    sql=FRAGMENTS
    + """, n AS (SELECT sample_id, count(*) AS total_reads, count(*) FILTER (length(qual) < 0) AS short, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 2 > 0) AS proper FROM alignments GROUP BY ALL),
l AS (SELECT sample_id, sum(end_pos - start_pos) AS len FROM fragments WHERE paired GROUP BY ALL)
SELECT sample_id, total_reads, round(short * 100.0::DOUBLE / total_reads, 4) AS pcnt_short, round(mapped * 100.0::DOUBLE / total_reads, 4) AS pcnt_mapped, CASE WHEN mapped = 0 THEN 0 ELSE round(proper * 100.0::DOUBLE / mapped, 4) END AS pcnt_proper,
CASE WHEN proper = 0 THEN 0 ELSE round(len / (proper / 2), 4) END AS mean_insert FROM n LEFT JOIN l USING (sample_id)""",
)
def a10_alignment_summary(alignments):
    return A.alignment_summary(alignments)


@query(
    "a10_reads_per_accession",
    "alignments",
    "refs",
    sql='SELECT s.sample_id, r.rname, count(a.qname) AS reads FROM (SELECT DISTINCT sample_id FROM alignments) s CROSS JOIN refs r LEFT JOIN alignments a ON a.sample_id = s.sample_id AND a.rname = r.rname AND a.flag & 4 = 0 GROUP BY ALL',
)
def a10_reads_per_accession(alignments, references):
    return A.reads_per_accession(alignments, references)


@query("a11_distinct_fragments", "frags", sql="SELECT sample_id, acc, start_pos, end_pos, strand, paired, min(name) AS name FROM frags GROUP BY ALL")
def a11_distinct_fragments(frags):
    return A.distinct_fragments(frags)


@query(
    "a12_mark_duplicates",
    "alignments",
    sql=f"""sized AS (SELECT sample_id, qname, flag, CASE WHEN flag & 16 > 0 THEN pos + {REF_LEN} ELSE pos END AS five, rname, list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) AS q FROM alignments WHERE flag & 4 = 0),
paired AS (SELECT sample_id, qname, max(CASE WHEN flag & 64 > 0 THEN {{'f': flag, 'r': rname, 'five': five, 'q': q}} END) AS r1, max(CASE WHEN flag & 128 > 0 THEN {{'f': flag, 'r': rname, 'five': five, 'q': q}} END) AS r2 FROM sized GROUP BY ALL)
SELECT sample_id, qname, row_number() OVER (PARTITION BY sample_id, r1.r, r1.five, r1.f & 16, r2.r, r2.five, r2.f & 16 ORDER BY r1.q + r2.q DESC, qname) > 1 AS duplicate FROM paired WHERE r1 IS NOT NULL AND r2 IS NOT NULL""",
)
def a12_mark_duplicates(alignments):
    return A.mark_duplicates(alignments)


COLLAPSED = r"""collapsed AS (SELECT sample_id, concat_ws(':', rname, pos, CASE WHEN flag & 16 > 0 THEN '-' ELSE '+' END) AS place, substr(regexp_extract(qname, '^\S+?umi_(\w{6})', 1), 1, 6) AS umi, min(qname) AS qname, count(*) AS reads FROM singles WHERE flag & 4 = 0 GROUP BY ALL)
"""


@query("a13_umi_collapse", "singles", sql=COLLAPSED + "SELECT * FROM collapsed")
def a13_umi_collapse(singles):
    return A.umi_collapse(singles)


@query("a13_umi_collapse_feature", "singles", sql=r"SELECT sample_id, rname AS place, regexp_extract(qname, '^\S+?umi_(\w{6})', 1) AS umi, min(qname) AS qname, count(*) AS reads FROM singles WHERE flag & 4 = 0 GROUP BY ALL")
def a13_umi_collapse_feature(singles):
    return A.umi_collapse(singles, by="feature", features=F.col("rname"))


NETWORK = r"""nodes AS (SELECT sample_id, concat_ws(':', rname, pos, CASE WHEN flag & 16 > 0 THEN '-' ELSE '+' END) AS place, regexp_extract(qname, '^\S+?umi_(\w{6})', 1) AS umi,
 min(qname) AS qname, count(*) AS reads FROM umi_reads GROUP BY ALL),
links AS (SELECT a.sample_id, a.place, a.umi AS a, b.umi AS b FROM nodes AS a JOIN nodes AS b ON a.sample_id = b.sample_id AND a.place = b.place AND hamming(a.umi, b.umi) = 1 AND a.reads >= 2 * b.reads - 1),
reach AS (SELECT sample_id, place, umi AS root, umi FROM nodes UNION SELECT r.sample_id, r.place, r.root, l.b FROM reach AS r JOIN links AS l ON l.sample_id = r.sample_id AND l.place = r.place AND l.a = r.umi),
tops AS (SELECT r.sample_id, r.place, r.umi, r.root AS top FROM reach AS r JOIN nodes AS n ON n.sample_id = r.sample_id AND n.place = r.place AND n.umi = r.root
 QUALIFY row_number() OVER (PARTITION BY r.sample_id, r.place, r.umi ORDER BY n.reads DESC, r.root) = 1)
SELECT t.sample_id, t.place, t.top AS umi, min(n.qname) FILTER (n.umi = t.top) AS qname, count(*) AS umis, CAST(sum(n.reads) AS BIGINT) AS reads
FROM tops AS t JOIN nodes AS n ON n.sample_id = t.sample_id AND n.place = t.place AND n.umi = t.umi GROUP BY t.sample_id, t.place, t.top
"""


@query("a13_umi_network", "umi_reads", sql=NETWORK, recursive=True)
def a13_umi_network(umi_reads):
    return umis.umi_network(umi_reads)


BY_REF = r"collapsed AS (SELECT sample_id, count(*) AS reads FROM (SELECT sample_id, rname, substr(regexp_extract(qname, '^\S+?umi_(\w{6})', 1), 1, 3) AS umi FROM singles WHERE flag & 4 = 0) GROUP BY sample_id, rname, umi)" + "\n"


def _by_ref(singles):
    from seqloom.functions.bases import extract_umi, has_bit

    mapped = singles.filter(~has_bit(F.col("flag"), 4))
    return mapped.groupBy("sample_id", "rname", F.substring(extract_umi(F.col("qname")), 1, 3).alias("umi")).agg(F.count(F.lit(1)).alias("reads"))


@query(
    "a14_collapse_stats",
    "singles",
    sql=BY_REF
    + """SELECT sample_id, min(reads) AS min, quantile_cont(reads, 0.5) AS median, max(reads) AS max, round(100.0::DOUBLE * count(*) FILTER (reads = 1) / count(*), 4) AS pcnt_single,
round(100.0::DOUBLE * count(*) FILTER (reads = 1) / count(*) FILTER (reads <= 100), 4) AS pcnt_single_100, round(sum(reads)::DOUBLE / count(*), 4) AS compression FROM collapsed GROUP BY sample_id""",
)
def a14_collapse_stats(singles):
    return A.collapse_stats(_by_ref(singles)).fillna(float("nan"), ["pcnt_single_100"])  # 0 of 0 in SQL


@query("a14_collapse_histogram", "singles", sql=BY_REF + "SELECT sample_id, least(reads, 101) AS size, count(*) AS n FROM collapsed GROUP BY ALL")
def a14_collapse_histogram(singles):
    return A.collapse_histogram(_by_ref(singles))


@query("a15_insert_size_metrics", "alignments", sql="SELECT sample_id, count(*) AS pairs, round(avg(abs(tlen)), 4) AS mean, quantile_cont(abs(tlen), 0.5) AS median FROM alignments WHERE flag & 2 > 0 AND flag & 64 > 0 GROUP BY sample_id")
def a15_insert_size_metrics(alignments):
    return A.insert_size_metrics(alignments)


@query("a15_insert_size_histogram", "alignments", sql="SELECT sample_id, abs(tlen) AS size, count(*) AS pairs FROM alignments WHERE flag & 2 > 0 AND flag & 64 > 0 GROUP BY ALL")
def a15_insert_size_histogram(alignments):
    return A.insert_size_histogram(alignments)


@query("a15_quality_by_cycle", "alignments", sql="SELECT sample_id, CAST(i AS INT) AS cycle, round(sum(ascii(substr(qual, i, 1)) - 33)::DOUBLE / count(*), 4) AS mean_quality FROM alignments, (SELECT unnest(range(1, 200)) AS i) WHERE i <= length(qual) GROUP BY ALL")
def a15_quality_by_cycle(alignments):
    return A.quality_by_cycle(alignments)


@query(
    "a15_mapping_summary",
    "alignments",
    sql="""SELECT sample_id, category, count(*) AS reads, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 2 > 0) AS proper, count(*) FILTER (flag & 16 > 0 AND flag & 4 = 0) AS reverse
FROM (SELECT sample_id, flag, unnest([CASE WHEN flag & 64 > 0 THEN 'FIRST_OF_PAIR' WHEN flag & 128 > 0 THEN 'SECOND_OF_PAIR' ELSE 'UNPAIRED' END, 'ALL']) AS category FROM alignments) GROUP BY ALL""",
)
def a15_mapping_summary(alignments):
    return A.mapping_summary(alignments)
