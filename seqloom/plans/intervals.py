"""Queries of the interval operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.operators import intervals as I
from seqloom.plans.registry import query

# features twice under two types at one place, with a few attributes
GFF = """gff AS (SELECT acc, CAST(start_pos AS BIGINT) AS start_pos, CAST(end_pos AS BIGINT) AS end_pos, strand, name, CASE k WHEN 0 THEN 'gene' ELSE type END AS type, k AS line_no, CASE WHEN k = 1 THEN name ELSE '' END AS locus,
 CASE WHEN start_pos % 3 = 0 THEN concat('g', k) ELSE '' END AS gene, '' AS prod, concat('i', k, name) AS id FROM features CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1) AS two WHERE k = 0 OR start_pos % 5 > 0)
"""


def _gff(features):
    return features.sparkSession.sql(GFF[GFF.index("(") + 1 : GFF.rindex(")")].replace("FROM features", "FROM {features}"), features=features)


MERGED = GFF + """, sides AS (SELECT acc, start_pos, end_pos, strand, max(CASE WHEN line_no = 0 THEN type END) AS t0, max(CASE WHEN line_no = 1 THEN type END) AS t1,
 coalesce(string_agg(nullif(locus, ''), ',' ORDER BY line_no, type, locus), '-') AS locus, coalesce(string_agg(nullif(gene, ''), ',' ORDER BY line_no, type, locus, gene), '-') AS gene, string_agg(id, ',' ORDER BY line_no, type, locus, gene, prod, id) AS id,
 string_agg(name, ',' ORDER BY line_no, type, locus, gene, prod, id, name) AS name FROM gff GROUP BY ALL),
typed AS (SELECT *, CASE WHEN t1 IS NULL THEN t0 WHEN t1 = 'misc_RNA' THEN 'ncRNA' ELSE t1 END AS type FROM sides),
merged AS (SELECT acc, CASE WHEN type = 'CDS' THEN CASE WHEN start_pos - CASE WHEN strand = '+' THEN 20 ELSE 10 END < 0 THEN 1 ELSE start_pos - CASE WHEN strand = '+' THEN 20 ELSE 10 END END ELSE start_pos END AS start_pos,
 CASE WHEN type = 'CDS' THEN end_pos + CASE WHEN strand = '+' THEN 10 ELSE 20 END ELSE end_pos END AS end_pos, strand, type, concat_ws(':', type, locus, gene, '-', id, name, strand, end_pos - start_pos) AS full_tag FROM typed)
"""


@query("i1_merge_features", "features", sql=MERGED + "SELECT * FROM merged")
def i1_merge_features(features):
    return I.merge_features(_gff(features), 20, 10)


IGR = MERGED + """, igr AS (SELECT acc, s AS start_pos, e AS end_pos, '+' AS strand, 'IGR' AS type, concat('IGR:(', replace(l, ':', ','), '/', replace(full_tag, ':', ','), '):+:', e - s) AS full_tag FROM (
 SELECT acc, coalesce(lag(end_pos + 1) OVER w, 1) AS s, greatest(start_pos - 1, 0) AS e, coalesce(lag(full_tag) OVER w, 'ORIGIN') AS l, full_tag FROM merged WINDOW w AS (PARTITION BY acc ORDER BY start_pos, end_pos, full_tag)) WHERE s < e)
"""


@query("i2_intergenic_regions", "features", sql=IGR + "SELECT * FROM igr")
def i2_intergenic_regions(features):
    return I.intergenic_regions(I.merge_features(_gff(features), 20, 10))


@query("i3_feature_table", "features", sql=IGR + "SELECT *, 'feature' AS kind FROM (SELECT * FROM merged UNION ALL SELECT * FROM igr)")
def i3_feature_table(features):
    merged = I.merge_features(_gff(features), 20, 10)
    return I.feature_table(merged, I.intergenic_regions(merged))


@query(
    "i4_dedupe_feature_types",
    "features",
    sql=GFF + "SELECT acc, start_pos, end_pos, strand, coalesce(max(CASE WHEN line_no = 1 THEN type END), 'gene') AS type, string_agg(id, ';' ORDER BY line_no, type, id) AS tag FROM gff GROUP BY ALL",
)
def i4_dedupe_feature_types(features):
    return I.dedupe_feature_types(_gff(features).withColumn("tag", F.col("id")))


COUNTS = """stacks AS (SELECT sample_id, acc, start_pos, end_pos, strand, count(*) AS n FROM frags WHERE end_pos - start_pos >= 10 GROUP BY ALL),
hits AS (SELECT s.*, f.name, f.strand AS f_strand, CAST(least(s.end_pos, f.end_pos) - greatest(s.start_pos, f.start_pos) AS DOUBLE) AS ov FROM stacks s JOIN features f ON s.acc = f.acc AND least(s.end_pos, f.end_pos) > greatest(s.start_pos, f.start_pos)),
shared AS (SELECT *, ov / sum(ov) OVER (PARTITION BY sample_id, acc, start_pos, end_pos, strand) * n AS share FROM hits),
counts AS (SELECT sample_id, acc, name, sum(CASE WHEN strand = f_strand THEN share ELSE 0 END) AS sense, sum(CASE WHEN strand <> f_strand THEN share ELSE 0 END) AS antisense FROM shared GROUP BY ALL)
"""


@query("i5_count_features", "frags", "features", sql=COUNTS + "SELECT sample_id, acc, name, round(sense, 6) AS sense, round(antisense, 6) AS antisense FROM counts")
def i5_count_features(frags, features):
    counts = I.count_features(frags, features)
    return counts.withColumns({c: F.round(c, 6) for c in ("sense", "antisense")})


@query(
    "i6_feature_counts_output",
    "frags",
    "features",
    sql=COUNTS
    + """SELECT sample_id, concat(name, ':', acc) AS feature, acc, CAST(round_even(round(sense, 9), 0) AS BIGINT) AS n FROM counts UNION ALL SELECT sample_id, concat('AS_', name, ':', acc), acc, CAST(round_even(round(antisense, 9), 0) AS BIGINT) FROM counts""",
)
def i6_feature_counts_output(frags, features):
    counts = I.count_features(frags, features)
    return I.feature_counts_output(counts.withColumns({c: F.round(c, 9) for c in ("sense", "antisense")}))  # sums differ in the last bits by order


@query("i7_replicon_totals", "frags", "features", sql=COUNTS + "SELECT sample_id, acc, round(sum(sense + antisense), 4) AS total FROM counts GROUP BY ALL")
def i7_replicon_totals(frags, features):
    return I.replicon_totals(I.count_features(frags, features)).withColumn("total", F.round("total", 4))


EVENTS = """events AS (SELECT sample_id, acc, CAST(p AS BIGINT) AS p, sum(CASE WHEN strand = '+' THEN d ELSE 0 END) AS dx, sum(CASE WHEN strand = '-' THEN d ELSE 0 END) AS dy
 FROM (SELECT sample_id, acc, strand, start_pos AS p, 1 AS d FROM frags UNION ALL SELECT sample_id, acc, strand, end_pos + 1, -1 FROM frags) GROUP BY ALL),
runs AS (SELECT sample_id, acc, p AS start_pos, lead(p) OVER w - 1 AS end_pos, CAST(sum(dx) OVER w AS BIGINT) AS plus, CAST(sum(dy) OVER w AS BIGINT) AS minus FROM events WINDOW w AS (PARTITION BY sample_id, acc ORDER BY p)),
covered AS (SELECT * FROM runs WHERE plus > 0 OR minus > 0)
"""


@query("i8_coverage", "frags", sql=EVENTS + "SELECT * FROM covered")
def i8_coverage(frags):
    return I.coverage(frags)


@query(
    "i8_smoothed_coverage",
    "frags",
    sql=EVENTS
    + """, dense AS (SELECT sample_id, acc, unnest(range(start_pos, end_pos + 1)) AS pos, plus, minus FROM covered),
near AS (SELECT sample_id, acc, pos + k AS pos, plus, minus FROM dense, (SELECT unnest(range(-4, 6)) AS k))
SELECT sample_id, acc, pos, round(sum(plus) / 10, 6) AS plus, round(-sum(minus) / 10, 6) AS minus FROM near GROUP BY ALL""",
)
def i8_smoothed_coverage(frags):
    return I.smoothed_coverage(I.coverage(frags), 10)  # whole numbers by ten, which rounding leaves as they are


BODY = EVENTS + """, dense AS (SELECT sample_id, acc, unnest(range(start_pos, end_pos + 1)) AS pos, plus, minus FROM covered),
body AS (SELECT sample_id, name, end_pos - start_pos + 1 AS len, CASE WHEN strand = '+' THEN plus ELSE minus END AS depth,
 least(CAST(floor(CASE WHEN strand = '+' THEN pos - start_pos ELSE end_pos - pos END * 20 / (end_pos - start_pos + 1)) AS INT), 19) AS bin FROM dense d JOIN features f ON d.acc = f.acc AND d.pos BETWEEN f.start_pos AND f.end_pos),
summed AS (SELECT sample_id, name, len, bin, sum(depth) AS depth FROM body WHERE depth > 0 GROUP BY sample_id, name, len, bin),
totals AS (SELECT *, sum(depth) OVER (PARTITION BY sample_id, name, len) AS total FROM summed),
gene_bins AS (SELECT sample_id, name, CAST(len AS BIGINT) AS len, CAST(total AS BIGINT) AS total, bin, round(depth / total * 100, 6) AS pcnt FROM totals)
"""


@query("i9_gene_body_coverage", "frags", "features", sql=BODY + "SELECT * FROM gene_bins")
def i9_gene_body_coverage(frags, features):
    return I.gene_body_coverage(I.coverage(frags), features)


@query(
    "i10_coverage_profile",
    "frags",
    "features",
    sql=BODY
    + """, chosen AS (SELECT sample_id, name, total FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY total DESC, name) AS r FROM (SELECT DISTINCT sample_id, name, total FROM gene_bins WHERE len >= 300)) WHERE r <= 50)
SELECT sample_id, bin, round(sum(pcnt * g.total) / (SELECT sum(total) FROM chosen c2 WHERE c2.sample_id = g.sample_id), 4) AS mean_pcnt FROM gene_bins g JOIN chosen USING (sample_id, name) GROUP BY sample_id, bin""",
)
def i10_coverage_profile(frags, features):
    return I.coverage_profile(I.gene_body_coverage(I.coverage(frags), features), 300, 50)


@query(
    "i11_start_site_profile",
    "alignments",
    "features",
    sql="""starts AS (SELECT a.sample_id, f.name, CAST(a.pos AS BIGINT) AS pos, count(*) AS n FROM alignments a JOIN features f ON a.rname = f.acc AND a.pos > f.start_pos - 100 AND a.pos < f.end_pos + 100 WHERE a.flag & 64 > 0 AND f.type = 'rRNA' GROUP BY ALL),
shares AS (SELECT *, n / sum(n) OVER g * 100 AS pcnt, min(pos) OVER g AS first, max(pos) OVER g AS last FROM starts WINDOW g AS (PARTITION BY sample_id, name))
SELECT sample_id, name, p AS pos, round(sum(pcnt), 6) AS pcnt FROM (SELECT sample_id, name, pcnt, last, unnest(range(greatest(pos - 25, first), pos + 1)) AS p FROM shares) WHERE p < last GROUP BY ALL""",
)
def i11_start_site_profile(alignments, features):
    return I.start_site_profile(alignments, features.filter("type = 'rRNA'"))


@query(
    "i12_hits_to_coords",
    "lines",
    sql="SELECT id AS query_seqid, concat('chr', l_suppkey % 4) AS acc, least(l_partkey, l_orderkey) AS start_pos, greatest(l_partkey, l_orderkey) AS end_pos, CASE WHEN l_partkey > l_orderkey THEN '-' ELSE '+' END AS strand FROM lines",
)
def i12_hits_to_coords(lines):
    hits = lines.select(F.col("id").alias("query_seqid"), F.concat(F.lit("chr"), F.col("l_suppkey") % 4).alias("sub_seqid"), F.col("l_partkey").alias("sub_start"), F.col("l_orderkey").alias("sub_end"))
    return I.hits_to_coords(hits)
