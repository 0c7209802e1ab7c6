"""Queries of the sampling operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.operators import sampling as S
from seqloom.plans.registry import query


def hashed_sql(key: str, seed: str) -> str:
    return f"('0x' || substr(md5(concat({key}, ':{seed}')), 1, 8))::BIGINT"


@query(
    "m1_sample_exact",
    "lines",
    sql=f"""r AS (SELECT concat('S', l_suppkey % 8) AS sample_id, l_orderkey AS ord, id AS read_id, l_orderkey // 2000 AS block FROM lines), sizes AS (SELECT sample_id, count(*) AS n, least(count(*), 1000 + 100 * length(sample_id)) AS k FROM r GROUP BY 1),
b AS (SELECT sample_id, block, count(*) AS m FROM r GROUP BY ALL), q AS (SELECT *, coalesce(sum(m) OVER (PARTITION BY sample_id ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b),
plan AS (SELECT q.sample_id, q.block, floor(k * (before + m) / n) - floor(k * before / n) AS quota FROM q JOIN sizes USING (sample_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id, block ORDER BY {hashed_sql('read_id', '7')}, read_id) AS rn FROM r) SELECT sample_id, ord, read_id FROM ranked JOIN plan USING (sample_id, block) WHERE rn <= quota""",
)
def m1_sample_exact(lines):
    reads = lines.select(F.concat(F.lit("S"), F.col("l_suppkey") % 8).alias("sample_id"), F.col("l_orderkey").alias("ord"), F.col("id").alias("read_id"))
    counts = reads.select("sample_id").distinct().withColumn("k", (1000 + 100 * F.length("sample_id")).cast("long"))
    return S.sample_exact(reads, counts, 7, 2000)


@query(
    "m2_sample_fraction",
    "alignments",
    sql=f"""names AS (SELECT DISTINCT sample_id, qname FROM alignments), sized AS (SELECT *, greatest(1, ceil(count(*) OVER (PARTITION BY sample_id) / 2000)) AS blocks FROM names), placed AS (SELECT *, {hashed_sql('qname', '4')} % blocks AS block FROM sized),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id, block ORDER BY {hashed_sql('qname', '3')}, qname) AS r, count(*) OVER (PARTITION BY sample_id, block) AS m FROM placed)
SELECT sample_id, qname, flag FROM alignments JOIN (SELECT sample_id, qname FROM ranked WHERE r <= floor(m * 12.5::DOUBLE / 100)) USING (sample_id, qname)""",
)
def m2_sample_fraction(alignments):
    return S.sample_fraction(alignments, 12.5, 3, 2000).select("sample_id", "qname", "flag")


LADDER = "ladder AS (SELECT CAST(j AS INT) AS step, CAST(r AS INT) AS repeat, pow(2, log2(5) + j * (log2(100) - log2(5)) / 4) AS pct FROM (SELECT unnest(range(5)) AS j), (SELECT unnest(range(3)) AS r) WHERE j < 4 OR r = 0)\n"


@query("m3_depth_ladder", "lines", sql=LADDER + ", sizes AS (SELECT concat('S', l_suppkey % 8) AS sample_id, count(*) AS n FROM lines GROUP BY 1) SELECT sample_id, step, repeat, round(pct, 9) AS pct, CAST(floor(n * round(pct, 9) / 100) AS BIGINT) AS reads FROM sizes, ladder")
def m3_depth_ladder(lines):
    sizes = lines.groupBy(F.concat(F.lit("S"), F.col("l_suppkey") % 8).alias("sample_id")).agg(F.count(F.lit(1)).alias("n"))
    return S.ladder_reads(sizes, [(s, r, round(p, 9)) for s, r, p in S.depth_ladder(5, 100, 5, 3)])


TAKEN = LADDER + """, taken AS (SELECT f.*, step, repeat FROM frags f, ladder WHERE ('0x' || substr(md5(concat(name, ':1:', repeat)), 1, 8))::BIGINT < pct / 100 * 4294967296::DOUBLE),
stacks AS (SELECT sample_id, step, repeat, acc, start_pos, end_pos, strand, count(*) AS n FROM taken WHERE end_pos - start_pos >= 10 GROUP BY ALL),
hits AS (SELECT s.*, f.name, CAST(least(s.end_pos, f.end_pos) - greatest(s.start_pos, f.start_pos) AS DOUBLE) AS ov FROM stacks s JOIN features f ON s.acc = f.acc AND least(s.end_pos, f.end_pos) > greatest(s.start_pos, f.start_pos)),
shared AS (SELECT *, ov / sum(ov) OVER (PARTITION BY sample_id, step, repeat, acc, start_pos, end_pos, strand) * n AS share FROM hits)
"""


@query(
    "m4_saturation_curve",
    "frags",
    "features",
    sql=TAKEN
    + """, genes AS (SELECT sample_id, step, repeat, count(*) AS genes FROM (SELECT sample_id, step, repeat, acc, name FROM shared GROUP BY ALL HAVING round(sum(share), 9) >= 0.5) GROUP BY ALL)
SELECT sample_id, step, repeat, frags, coalesce(genes, 0) AS genes FROM (SELECT sample_id, step, repeat, count(*) AS frags FROM taken GROUP BY ALL) LEFT JOIN genes USING (sample_id, step, repeat)""",
)
def m4_saturation_curve(frags, features):
    ladder = S.ladder_frame(frags.sparkSession, S.depth_ladder(5, 100, 5, 3))
    return S.saturation_curve(frags, ladder, features)


@query("m4_saturation_counts", "frags", "features", sql=TAKEN + "SELECT sample_id, step, repeat, acc, name, round(sum(share), 6) AS n FROM shared GROUP BY ALL")
def m4_saturation_counts(frags, features):
    ladder = S.ladder_frame(frags.sparkSession, S.depth_ladder(5, 100, 5, 3))
    return S.saturation_counts(frags, ladder, features).withColumn("n", F.round("n", 6))
