"""Queries of the read-level operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.functions import bases
from seqloom.functions.protocols import PROTOCOLS, Protocol
from seqloom.operators import reads as R
from seqloom.plans.registry import query

RTS, ALLSEQ = PROTOCOLS["rts"], PROTOCOLS["allseq"]

#: Distances of each slice to each barcode by brute force, and the unique nearest within the cutoff.
ASSIGNED = """
pool AS (SELECT DISTINCT CASE WHEN length(r1_seq) >= 9 THEN substr(r1_seq,1,8) END AS slice FROM reads),
dist AS (SELECT slice, bc_name, hamming(slice, substr(bc_seq,1,8)) AS d FROM pool, barcodes WHERE slice IS NOT NULL),
best AS (SELECT slice, min(d) AS distance, count(*) AS n, min(bc_name) AS bc_name
         FROM (SELECT *, min(d) OVER (PARTITION BY slice) AS least FROM dist) WHERE d = least AND d <= 1 GROUP BY slice),
assigned AS (SELECT r.*, coalesce(CASE WHEN n = 1 THEN b.bc_name WHEN n > 1 THEN 'ambiguous' END, 'no_match') AS barcode, CAST(b.distance AS INT) AS distance
             FROM reads r LEFT JOIN best b ON substr(r1_seq,1,8) = b.slice AND length(r1_seq) >= 9)
"""


def assigned(reads, barcodes):
    return R.assign_barcode(reads, barcodes, RTS)


@query("p1_assign_barcode", "reads", "barcodes", sql=ASSIGNED + "SELECT read_id, barcode, coalesce(distance, -1) AS distance FROM assigned")
def p1_assign_barcode(reads, barcodes):
    return assigned(reads, barcodes).select("read_id", "barcode", F.coalesce("distance", F.lit(-1)).alias("distance"))


@query("p2_trim_barcode", "reads", sql="SELECT read_id, substr(r1_seq,10) AS r1_seq, substr(r1_qual,10) AS r1_qual FROM reads")
def p2_trim_barcode(reads):
    return R.trim_barcode(reads, RTS).select("read_id", "r1_seq", "r1_qual")


@query("p3_tag_umi", "reads", sql="SELECT read_id, concat(split_part(r2_name,' ',1), ':umi_', substr(r1_seq,1,6), substr(r2_name, length(split_part(r2_name,' ',1)) + 1)) AS r2_name FROM reads")
def p3_tag_umi(reads):
    return R.tag_umi(reads, ALLSEQ).select("read_id", "r2_name")


@query("p4_tag_umi_both", "reads", sql="SELECT read_id, replace(r1_name, ' ', concat('_', substr(r1_seq,1,8), ' ')) AS r1_name, replace(r2_name, ' ', concat('_', substr(r1_seq,1,8), ' ')) AS r2_name FROM reads")
def p4_tag_umi_both(reads):
    return R.tag_umi_both(reads).select("read_id", "r1_name", "r2_name")


@query("p5_tag_index", "reads", sql="SELECT read_id, concat(r1_name, index_seq) AS r1_name, concat(r2_name, index_seq) AS r2_name, concat(index_name, index_seq) AS index_name FROM reads")
def p5_tag_index(reads):
    return R.tag_index(reads).select("read_id", "r1_name", "r2_name", "index_name")


@query("p6_extract_umi", "pairs", sql=r"SELECT qname, nullif(regexp_extract(qname, '^\S+?umi_(\w{6})', 1), '') AS umi FROM pairs")
def p6_extract_umi(pairs):
    return pairs.select("qname", bases.extract_umi(F.col("qname")).alias("umi"))


@query("p7_trim_ends", "seqs", sql="SELECT read_id, substr(seq, 4, length(seq) - 26) AS seq, substr(qual, 4, length(seq) - 26) AS qual FROM seqs WHERE length(seq) > 3 AND length(seq) - 3 >= 23")
def p7_trim_ends(seqs):
    return R.trim_ends(seqs, 3, 23).select("read_id", "seq", "qual")


@query("p8_keep_5p", "seqs", sql="SELECT read_id, substr(seq,1,27) AS seq, substr(qual,1,27) AS qual FROM seqs WHERE length(seq) >= 27")
def p8_keep_5p(seqs):
    return R.keep_5p(seqs, 27).select("read_id", "seq", "qual")


@query("p8_keep_3p", "seqs", sql="SELECT read_id, right(seq,27) AS seq, right(qual,27) AS qual FROM seqs WHERE length(seq) >= 27")
def p8_keep_3p(seqs):
    return R.keep_3p(seqs, 27).select("read_id", "seq", "qual")


@query(
    "p9_trim_polya",
    "seqs",
    sql="""cut AS (SELECT *, length(rtrim(CASE WHEN instr(seq,'AAAAAAA') > 0 THEN substr(seq,1,instr(seq,'AAAAAAA')-1) ELSE seq END, 'A')) AS e FROM seqs)
SELECT concat(read_id, CASE WHEN e < length(seq) THEN concat(':trimmed_', e + 1, '_', length(seq) - e) ELSE ':untrimmed_0_0' END) AS read_id, substr(seq,1,e) AS seq, substr(qual,1,e) AS qual
FROM cut WHERE e >= 20""",
)
def p9_trim_polya(seqs):
    return R.trim_polya(seqs).select("read_id", "seq", "qual")


@query("p10_reverse_complement", "seqs", sql="SELECT read_id, reverse(translate(seq,'ACGT','TGCA')) AS rc FROM seqs")
def p10_reverse_complement(seqs):
    return seqs.select("read_id", bases.reverse_complement(F.col("seq")).alias("rc"))


@query("p11_cigar_ref_len", "alignments", sql=r"SELECT cigar, count(*) AS n, CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MD]', 1), lambda x: CAST(x AS BIGINT))), 0) AS BIGINT) AS ref_len FROM alignments GROUP BY cigar")
def p11_cigar_ref_len(alignments):
    return alignments.groupBy("cigar").agg(F.count(F.lit(1)).alias("n")).withColumn("ref_len", bases.cigar_ref_len(F.col("cigar")))


FACTS = "facts AS (SELECT sample_id, qname, max((flag & 4)::INT) > 0 AS any_off, min((flag & 4)::INT) > 0 AS all_off, max((flag & 1024)::INT) > 0 AS dup FROM alignments GROUP BY ALL)\n"


def _split_pairs(mode: str, keep: str):
    @query(f"p12_split_pairs_{mode}", "alignments", sql=FACTS + f"SELECT sample_id, qname, flag, {keep} AS kept FROM alignments JOIN facts USING (sample_id, qname)")
    def split(alignments):
        return R.mark_pairs(alignments.select("sample_id", "qname", "flag"), mode).withColumnRenamed("keep", "kept")


for _mode, _keep in (("concordant", "any_off = all_off"), ("any_mapped", "NOT all_off"), ("nondup", "NOT dup")):
    _split_pairs(_mode, _keep)


@query(
    "p13_unmap_broken_pairs",
    "alignments",
    sql=FACTS
    + """SELECT sample_id, qname, CASE WHEN any_off = all_off THEN flag WHEN flag & 64 > 0 THEN 77 ELSE 141 END AS flag, CASE WHEN any_off = all_off THEN rname ELSE '*' END AS rname,
CASE WHEN any_off = all_off THEN pos ELSE 0 END AS pos, CASE WHEN any_off = all_off THEN cigar ELSE '*' END AS cigar FROM alignments JOIN facts USING (sample_id, qname)""",
)
def p13_unmap_broken_pairs(alignments):
    return R.unmap_broken_pairs(alignments.select("sample_id", "qname", "flag", "rname", "pos", "cigar"))[0]


@query(
    "p14_unaligned_reads",
    "alignments",
    sql="""SELECT sample_id, CAST(r AS INT) AS rank, header, seq FROM (SELECT sample_id, row_number() OVER (PARTITION BY sample_id ORDER BY qname, flag) AS r, concat('>', qname) AS header, seq
FROM alignments WHERE flag & 4 > 0) WHERE r <= 50""",
)
def p14_unaligned_reads(alignments):
    return R.unaligned_reads(alignments, 50)


WELLS = "(SELECT bc_name AS well, substr(bc_seq,1,3) AS bc1, substr(bc_seq,4,3) AS bc2 FROM barcodes)"


@query(
    "p15_amplicon_motif_counts",
    "reads",
    "barcodes",
    sql=f"""met AS (SELECT sample_no AS sample_id, well, CASE WHEN contains(r1_seq,'ACGT') OR contains(r2_seq,'ACGT') OR contains(r1_seq,'GATTA') OR contains(r2_seq,'GATTA') THEN 1 ELSE 0 END AS m
FROM reads JOIN {WELLS} w ON contains(substr(r1_seq,1,100), bc1) AND contains(substr(r2_seq,1,100), bc2))
SELECT sample_id, well, count(*) AS reads, CAST(sum(m) AS BIGINT) AS with_motif, round(100 * sum(m) / count(*), 4) AS pcnt FROM met GROUP BY sample_id, well""",
)
def p15_amplicon_motif_counts(reads, barcodes):
    wells = barcodes.select(F.col("bc_name").alias("well"), F.substring("bc_seq", 1, 3).alias("bc1"), F.substring("bc_seq", 4, 3).alias("bc2"))
    return R.amplicon_motif_counts(reads.withColumnRenamed("sample_no", "sample_id"), wells, ["ACGT", "GATTA"])


@query("p16_limit_reads", "reads", sql="SELECT read_id, file_prefix, ord FROM reads WHERE ord < 1000")
def p16_limit_reads(reads):
    return R.limit_reads(reads, 1000).select("read_id", "file_prefix", "ord")


# stand-ins for FASTA records: headers and lengths of features
FASTA = """fasta AS (SELECT concat(type, '|', name) AS name, CASE type WHEN 'rRNA' THEN '16S' WHEN 'tRNA' THEN '5S' ELSE '23S' END AS gene,
  concat(repeat(translate(md5(name),'0123456789abcdef','ACGTACGTACGTACGT'), CAST((end_pos - start_pos) / 4 AS INT)), CASE WHEN start_pos % 11 = 0 THEN 'NN' ELSE '' END) AS seq FROM features)
"""


def _fasta(features):
    return features.sparkSession.sql(FASTA[FASTA.index("(") + 1 : FASTA.rindex(")")].replace("FROM features", "FROM {features}"), features=features)


@query("p17_select_fasta", "features", sql=FASTA + "SELECT name, length(seq) AS n FROM fasta WHERE regexp_matches(name, '^(tRNA|ncRNA)')")
def p17_select_fasta(features):
    return R.select_fasta(_fasta(features), "^(tRNA|ncRNA)").select("name", F.length("seq").cast("long").alias("n"))


@query(
    "p17_select_rrna",
    "features",
    sql=FASTA
    + "SELECT name, gene, length(seq) AS n FROM fasta WHERE NOT contains(seq,'NN') AND ((gene = '23S' AND length(seq) BETWEEN 2000 AND 3000) OR (gene = '16S' AND length(seq) BETWEEN 1000 AND 2000) OR (gene = '5S' AND length(seq) BETWEEN 100 AND 200))",
)
def p17_select_rrna(features):
    return R.select_rrna(_fasta(features)).select("name", "gene", F.length("seq").cast("long").alias("n"))


HEADERS = """headers AS (SELECT CASE WHEN p_partkey % 13 = 0 THEN concat('>ENST', p_partkey, '.1 cdna chromosome:G38:CHR_HSCHR', p_size, '_PATCH:1:5:1 gene:G1 gene_symbol:x')
  WHEN p_partkey % 5 = 0 THEN concat('>NR_', p_partkey, '.2 Homo sapiens ribosomal (RNA', p_size, ')')
  ELSE concat('>ENST', p_partkey, '.1 cdna chromosome:G38:', p_size % 26, ':', p_partkey, ':', p_partkey + p_size, ':', CASE WHEN p_size % 2 = 0 THEN '1' ELSE '-1' END,
    ' gene:ENSG', p_partkey % 100, ' gene_biotype:', lower(p_type), ' transcript_biotype:', lower(p_brand), ' gene_symbol:S', p_partkey % 100) END AS header FROM part)
"""


def _headers(part):
    return part.sparkSession.sql(HEADERS[HEADERS.index("(") + 1 : HEADERS.rindex(")")].replace("FROM part", "FROM {part}"), part=part)


@query("p18_filter_chromosomes", "part", sql="""maps AS (SELECT concat_ws(':', concat('T', p_partkey), 'x', 'y', CASE WHEN p_size % 30 = 0 THEN '' WHEN p_size % 30 = 1 THEN 'X' WHEN p_size % 30 = 2 THEN 'MT' ELSE CAST(p_size % 30 AS VARCHAR) END) AS header FROM part)
SELECT header, split_part(header, ':', 4) IN ('1','2','3','4','5','6','7','8','9','10','11','12','13','14','15','16','17','18','19','20','21','22','X','Y','MT','') AS kept FROM maps""")
def p18_filter_chromosomes(part):
    size = F.col("p_size") % 30
    last = F.when(size == 0, "").when(size == 1, "X").when(size == 2, "MT").otherwise(size.cast("string"))
    maps = part.select(F.concat_ws(":", F.concat(F.lit("T"), "p_partkey"), F.lit("x"), F.lit("y"), last).alias("header"))
    kept, rest = R.filter_chromosomes(maps)
    return kept.withColumn("kept", F.lit(True)).unionByName(rest.withColumn("kept", F.lit(False)))


FULL = r"^>(\S+)\s+(\S+)\s+(\S+)\s+gene:(\S+)\s+gene_biotype:(\S+)\s+transcript_biotype:(\S+)\s+gene_symbol:(\S+)"


@query(
    "p19_parse_transcript_headers",
    "part",
    sql=HEADERS
    + rf""", p AS (SELECT header, regexp_replace(regexp_extract(header, '{FULL}', 3), '^\S+?:\S+?:', '') AS place, contains(header, 'gene_symbol') AS f,
  concat(regexp_extract(header, '^>(\S+?)\..*\((\S+)\)', 1), ':', regexp_extract(header, '^>(\S+?)\..*\((\S+)\)', 2)) AS short FROM headers WHERE NOT regexp_matches(header, '(?i)CHR_\S+_PATCH'))
SELECT CASE WHEN f THEN concat_ws(':', regexp_extract(header, '{FULL}', 1), regexp_extract(header, '{FULL}', 2), regexp_extract(header, '{FULL}', 6), place) ELSE short END AS transcript,
  CASE WHEN f THEN concat_ws(':', regexp_extract(header, '{FULL}', 4), regexp_extract(header, '{FULL}', 2), regexp_extract(header, '{FULL}', 7), regexp_extract(header, '{FULL}', 5), string_split(place, ':')[-1]) ELSE short END AS gene FROM p""",
)
def p19_parse_transcript_headers(part):
    return R.parse_transcript_headers(_headers(part))[0]


@query(
    "g8_base_dominance",
    "seqs",
    sql="SELECT base, avg(CASE WHEN (length(seq) - length(replace(seq, base, ''))) * 100 > length(seq) * 40 THEN 100.0::DOUBLE ELSE 0 END) AS pcnt FROM seqs, (VALUES ('A'),('C'),('G'),('T')) AS b(base) WHERE length(seq) > 0 GROUP BY base",
)
def g8_base_dominance(seqs):
    return R.base_dominance(seqs, 40.0)
