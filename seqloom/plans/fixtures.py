"""Sequencing tables derived from the driver's tables by SQL that Spark and DuckDB read alike.

Each fixture is one SELECT over driver tables and other fixtures, written as ``{name}``. ``frame``
gives it as a DataFrame, ``with_fixtures`` as the WITH clause of a query for the other engine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

HEX = "'0123456789abcdef'"
TO_BASES = "'0123456789abcdef','ACGTACGTACGTACGT'"


def bases_of(x: str) -> str:
    return f"translate(md5({x}),{TO_BASES})"


def digit(h: str, k: int) -> str:
    """The k-th hex digit (from 1) of a hash as a number."""
    return f"(instr({HEX}, substr({h},{k},1)) - 1)"


FIXTURES: dict[str, str] = {}

FIXTURES["barcodes"] = f"SELECT n_name AS bc_name, substr({bases_of('n_name')},1,9) AS bc_seq, n_nationkey AS bc_no FROM {{nation}}"

FIXTURES["lines"] = """
SELECT id, md5(id) AS h, md5(concat(id, 'x')) AS g, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice*100) AS BIGINT)) AS id,
         l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM {lineitem}) AS keyed
"""

# a read's slice is its supplier's barcode: exact, one base off (third or last), two off, or random
FIXTURES["reads"] = f"""
SELECT id AS read_id, concat('lane', l_linenumber % 4) AS file_prefix, l_orderkey AS ord, l_suppkey AS sample_no,
  concat(id, ' 1:N:0') AS r1_name, concat(id, ' 2:N:0') AS r2_name, concat(id, ' 3:N:0') AS index_name,
  concat(CASE WHEN d < 10 THEN bc_seq
              WHEN d < 13 THEN concat(substr(bc_seq,1,2), translate(substr(bc_seq,3,1),'ACGT','CGTA'), substr(bc_seq,4,6))
              WHEN d = 13 THEN concat(substr(bc_seq,1,8), translate(substr(bc_seq,9,1),'ACGT','CGTN'))
              WHEN d = 14 THEN concat(translate(substr(bc_seq,1,2),'ACGT','CGTA'), substr(bc_seq,3,7))
              ELSE substr({bases_of("concat(id,'r')")},1,9) END, substr({bases_of("id")},1,CASE WHEN e = 0 THEN 0 ELSE 20 + e END)) AS r1_seq,
  substr(translate(md5(concat(id,'q')),{HEX},'#-AEFIIIIIIIIIII'),1,29) AS r1_qual,
  concat(substr({bases_of("concat(id,'s')")},1,24), CASE WHEN e > 12 THEN 'AAAAAAAA' WHEN e > 9 THEN 'AAAC' ELSE 'TG' END) AS r2_seq,
  substr({bases_of("concat(id,'i')")},1,8) AS index_seq, bc_name AS true_barcode
FROM (SELECT *, {digit('h', 1)} AS d, {digit('h', 2)} AS e FROM {{lines}}) AS l JOIN {{barcodes}} AS b ON l.l_suppkey % 25 = b.bc_no
"""

FIXTURES["seqs"] = """
SELECT read_id, file_prefix, ord, r2_seq AS seq, substr(concat(r1_qual, r1_qual),1,length(r2_seq)) AS qual FROM {reads}
"""

# two mates of one fragment; the flags of a pair are drawn by a hash digit
FIXTURES["pairs"] = f"""
SELECT concat(id, ':umi_', substr({bases_of("concat(id,'u')")},1,6)) AS qname, concat('S', l_suppkey % 8) AS sample_id, d, e, f,
  concat('chr', l_partkey % 5) AS acc1, CASE WHEN f = 0 THEN concat('chr', (l_partkey + 1) % 5) ELSE concat('chr', l_partkey % 5) END AS acc2,
  CAST(l_partkey * 37 + 1 AS INT) AS pos1, CAST(l_partkey * 37 + 1 + e * 10 AS INT) AS pos2,
  CASE WHEN d < 6 THEN 99 WHEN d < 10 THEN 83 WHEN d = 10 THEN 97 WHEN d = 11 THEN 65 WHEN d = 12 THEN 73 WHEN d = 13 THEN 69 WHEN d = 14 THEN 77 ELSE 113 END AS flag1,
  CASE WHEN d < 6 THEN 147 WHEN d < 10 THEN 163 WHEN d = 10 THEN 145 WHEN d = 11 THEN 129 WHEN d = 12 THEN 133 WHEN d = 13 THEN 137 WHEN d = 14 THEN 141 ELSE 177 END AS flag2,
  CASE WHEN e < 12 THEN '48M' WHEN e < 14 THEN '10M2I5M3D' ELSE '5S20M' END AS cigar, CASE WHEN e = 3 THEN 1024 ELSE 0 END AS dup,
  {bases_of("id")} AS seq, translate(md5(concat(id,'q')),{HEX},'#-AEFIIIIIIIIIII') AS qual
FROM (SELECT *, {digit('g', 1)} AS d, {digit('g', 2)} AS e, {digit('g', 3)} AS f FROM {{lines}}) AS l
"""

FIXTURES["alignments"] = """
SELECT sample_id, qname, CAST(flag1 + dup AS INT) AS flag, CASE WHEN d IN (13, 14) THEN '*' ELSE acc1 END AS rname, CASE WHEN d IN (13, 14) THEN 0 ELSE pos1 END AS pos,
       CASE WHEN d IN (13, 14) THEN '*' ELSE cigar END AS cigar, seq, qual, CASE WHEN d < 10 THEN pos2 - pos1 + 48 ELSE 0 END AS tlen FROM {pairs}
UNION ALL
SELECT sample_id, qname, CAST(flag2 AS INT) AS flag, CASE WHEN d IN (12, 14) THEN '*' ELSE acc2 END AS rname, CASE WHEN d IN (12, 14) THEN 0 ELSE pos2 END AS pos,
       CASE WHEN d IN (12, 14) THEN '*' ELSE cigar END AS cigar, seq, qual, CASE WHEN d < 10 THEN pos1 - pos2 - 48 ELSE 0 END AS tlen FROM {pairs}
"""

# single-end alignments: forward, reverse or unmapped
FIXTURES["singles"] = """
SELECT sample_id, qname, CASE WHEN d < 8 THEN 0 WHEN d < 13 THEN 16 ELSE 4 END AS flag, CASE WHEN d < 13 THEN acc1 ELSE '*' END AS rname,
       CASE WHEN d < 13 THEN pos1 ELSE 0 END AS pos, CASE WHEN d < 13 THEN cigar ELSE '*' END AS cigar, seq, qual FROM {pairs}
"""

# reads of a few molecules a place, some more frequent than others; one or two bases of a UMI may be read wrong
_WRONG = "concat(substr({u},1,{k}), translate(substr({u},{k}+1,1),'ACGT','CGTA'), substr({u},{k}+2,6))"
_ONCE = _WRONG.format(u="molecule", k="(e % 6)")
FIXTURES["umi_reads"] = f"""
SELECT concat(id, ':umi_', CASE WHEN d < 11 THEN molecule WHEN d < 15 THEN {_ONCE} ELSE {_WRONG.format(u=_ONCE, k="((e + 1 + f % 5) % 6)")} END) AS qname,
  sample_id, CASE WHEN d = 10 THEN 16 ELSE 0 END AS flag, concat('chr', bin % 5) AS rname, CAST(bin * 370 + 1 AS INT) AS pos
FROM (SELECT *, substr({bases_of("concat('m', least(m, f), sample_id, bin)")},1,6) AS molecule FROM (
  SELECT id, concat('S', l_suppkey % 8) AS sample_id, CAST(floor(l_partkey / 200) AS BIGINT) AS bin, {digit('g', 1)} AS d, {digit('g', 2)} AS e, {digit('g', 3)} AS f, {digit('g', 4)} AS m FROM {{lines}}) AS drawn) AS placed
"""

FIXTURES["refs"] = "SELECT DISTINCT concat('chr', p_partkey % 6) AS rname FROM {part}"

FIXTURES["features"] = """
SELECT concat('chr', p_partkey % 5) AS acc, CAST(p_partkey * 41 + 1 AS INT) AS start_pos, CAST(p_partkey * 41 + 1 + p_size * 12 AS INT) AS end_pos,
  CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  CASE p_partkey % 7 WHEN 0 THEN 'rRNA' WHEN 1 THEN 'tRNA' WHEN 2 THEN 'ncRNA' WHEN 3 THEN 'misc_RNA' ELSE 'CDS' END AS type,
  concat('F', p_partkey) AS name
FROM {part}
"""

# fragments as A9 would give them, for the interval operators
FIXTURES["frags"] = f"""
SELECT qname AS name, sample_id, acc1 AS acc, pos1 AS start_pos, pos2 + 47 AS end_pos, CASE WHEN d % 2 = 0 THEN '+' ELSE '-' END AS strand, d < 10 AS paired
FROM {{pairs}} WHERE d < 13
"""


# a sample sheet: suppliers are samples, their nations pools; some rows list several indexes or barcodes
FIXTURES["key_table"] = """
SELECT concat('PRJ', s_nationkey % 4) AS Project_ID, concat('S', s_suppkey) AS Sample_ID,
  CASE WHEN s_suppkey % 5 = 0 THEN concat('X', s_suppkey % 3, '; X', 3 + s_suppkey % 3) ELSE concat('X', s_suppkey % 6) END AS P7,
  CASE WHEN s_suppkey % 3 = 0 THEN concat(substr(b.bc_seq,1,8), 'A|', substr(b.bc_seq,1,8), 'C') ELSE b.bc_seq END AS Inline_Seq,
  CASE s_suppkey % 5 WHEN 0 THEN 'NC_1;NC_2' WHEN 1 THEN 'NC_2' WHEN 2 THEN 'Unknown' WHEN 3 THEN '' ELSE 'NC_3|NC_1' END AS Bacterial_reference,
  concat('CG', s_suppkey % 4) AS CG_ID, CASE WHEN s_suppkey % 2 = 0 THEN 'CG0,CG1;CG2:CG3,CG0' ELSE '' END AS CG_Pairs,
  concat('/seq/', s_suppkey % 7, '/lane', s_suppkey % 4, '_x,/seq/old/lane', (s_suppkey + 1) % 4, '_y') AS Path_to_SeqFile,
  concat('pool', s_nationkey) AS Pool_ID, concat('idx', s_nationkey % 6) AS Pool_index, CASE WHEN s_suppkey % 2 = 0 THEN 'lane1,lane3' ELSE '' END AS Lane, s_suppkey AS sample_no
FROM {supplier} AS s JOIN {barcodes} AS b ON s.s_nationkey = b.bc_no
"""

FIXTURES["prefixes"] = "SELECT concat('lane', n_nationkey % 4, '_', CASE WHEN n_nationkey < 12 THEN 'x' ELSE 'y' END, '_X', n_nationkey % 6) AS prefix FROM {nation}"

FIXTURES["bc_log"] = """
SELECT concat('idx', n_nationkey % 6) AS index, bc_seq AS barcode, CAST((n_nationkey * 7) % 100 AS DOUBLE) AS pcnt, CAST(100000 + n_nationkey * 13 AS BIGINT) AS total
FROM {nation} AS n JOIN {barcodes} AS b ON (n.n_nationkey + 1) % 25 = b.bc_no
"""

FIXTURES["sample_metrics"] = """
SELECT concat('S', s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN '_combined' ELSE '' END, '_NC_', 1 + r_regionkey % 3) AS Sample, CASE WHEN r_regionkey < 3 THEN concat('NC_00', r_regionkey) WHEN s_suppkey % 2 = 0 THEN 'ALL' ELSE 'NC_009' END AS For_replicon,
  CAST(s_suppkey * 1000 + r_regionkey AS BIGINT) AS Total_reads FROM {supplier}, {region}
"""


def _needs(name: str, found: list[str]) -> list[str]:
    for other in re.findall(r"\{(\w+)\}", FIXTURES[name]):
        if other in FIXTURES:
            _needs(other, found)
    if name not in found:
        found.append(name)
    return found


def with_fixtures(*names: str) -> str:
    """The WITH clause that defines the named fixtures."""
    order: list[str] = []
    for name in names:
        _needs(name, order)
    return "WITH " + ",\n".join(f"{n} AS ({re.sub(r'\{(\w+)\}', r'\1', FIXTURES[n])})" for n in order)


#: Fixtures whose columns are hashes and digits of hashes: they are computed once a row.
HASHED = ("pairs",)


def _computed(df: DataFrame) -> DataFrame:
    """``df``, with columns that Spark does not work out anew in every expression and filter on them.

    Expressions of a projection are put into those that use them, and conditions move below it, which
    would hash a row some hundred times; not so through a column that depends on the row's place.
    """
    return df.withColumn("_at", F.monotonically_increasing_id()).filter("_at >= 0").drop("_at")


def _both_mates(pairs: DataFrame) -> DataFrame:
    """The fixture ``alignments`` from one pass over ``pairs``; each side of its UNION ALL would read and hash all of them."""
    off = "CASE mate WHEN 1 THEN d IN (13, 14) ELSE d IN (12, 14) END"
    return pairs.withColumn("mate", F.explode(F.array(F.lit(1), F.lit(2)))).selectExpr(
        "sample_id",
        "qname",
        "CAST(CASE mate WHEN 1 THEN flag1 + dup ELSE flag2 END AS INT) AS flag",
        f"CASE WHEN {off} THEN '*' WHEN mate = 1 THEN acc1 ELSE acc2 END AS rname",
        f"CASE WHEN {off} THEN 0 WHEN mate = 1 THEN pos1 ELSE pos2 END AS pos",
        f"CASE WHEN {off} THEN '*' ELSE cigar END AS cigar",
        "seq",
        "qual",
        "CASE WHEN d >= 10 THEN 0 WHEN mate = 1 THEN pos2 - pos1 + 48 ELSE pos1 - pos2 - 48 END AS tlen",
    )


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a fixture as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "alignments":
        return _both_mates(frame(spark, sf_dir, "pairs"))
    uses = set(re.findall(r"\{(\w+)\}", FIXTURES[name]))
    found = spark.sql(FIXTURES[name], **{n: frame(spark, sf_dir, n) for n in uses})
    return _computed(found) if name in HASHED else found
