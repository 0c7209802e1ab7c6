"""Readers and writers: SAM, GFF3, FASTA, key tables, barcode lists, BLAST tables, matrices.

Text is read by Spark's own readers, which stream gzip files and split plain ones; FASTQ has a data
source of its own (``seqloom.sources.fastq``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from seqloom.sources.fastq import PLACE_BITS

def pair_reads(r1: DataFrame, r2: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Mates (and index reads) of a file prefix by their place in the file.

    ord has to count the reads of a file without gaps (``fastq.number_reads``); the query fails on
    reads of a plain file in several ranges that were not numbered.
    """
    far = F.col("ord") >= 1 << PLACE_BITS
    place = F.when(far, F.raise_error(F.lit("number_reads has to number the reads of a file in several ranges before they are paired"))).otherwise(F.col("ord"))

    def named(df: DataFrame, tag: str) -> DataFrame:
        name = F.concat_ws(" ", "read_id", F.when(F.col("comment") != "", F.col("comment")))
        return df.select("file_prefix", place.cast("long").alias("ord"), name.alias(f"{tag}_name"), F.col("seq").alias(f"{tag}_seq"), F.col("qual").alias(f"{tag}_qual"))

    out = named(r1, "r1").join(named(r2, "r2"), ["file_prefix", "ord"])
    return out.join(named(index, "index"), ["file_prefix", "ord"]) if index is not None else out


# The columns of alignment text.
SAM = "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string"


def parse_sam(lines: DataFrame, column: str = "value") -> DataFrame:
    parts = F.split(column, "\t")
    return lines.filter(~F.startswith(column, F.lit("@"))).select(*[F.get(parts, F.lit(i)).cast(c.split()[1]).alias(c.split()[0]) for i, c in enumerate(SAM.split(", "))])


def read_sam(spark: SparkSession, *paths: str) -> DataFrame:
    """S3: alignment rows, header lines left out."""
    return parse_sam(spark.read.text(list(paths)))


def parse_gff(lines: DataFrame, column: str = "value") -> DataFrame:
    """Features of GFF3 lines (value, [line_no]): comments, regions and sources go, blanks become ``_``, ``()`` and ``|`` go."""
    clean = F.translate(F.regexp_replace(column, " ", "_"), "()|", "")
    parts = F.split(clean, "\t")
    kept = lines.filter(~F.startswith(column, F.lit("#")) & (F.size(F.split(column, "\t")) >= 9))
    rest = [c for c in lines.columns if c != column]
    names = ("acc", "source", "type", "start_pos", "end_pos", "score", "strand", "phase")
    fields = [F.get(parts, F.lit(i)).cast("long" if n.endswith("_pos") else "string").alias(n) for i, n in enumerate(names)]
    out = kept.select(*rest, *fields, F.str_to_map(F.get(parts, F.lit(8)), F.lit(";"), F.lit("=")).alias("attrs"))
    return out.filter(~F.contains("type", F.lit("region")) & ~F.contains("type", F.lit("ource")))


def read_gff(spark: SparkSession, *paths: str) -> DataFrame:
    """Features with their file and line; the sequences that may follow ``##FASTA`` have no nine columns and go."""
    lines = spark.read.text(list(paths)).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line_no"), "value")
    return parse_gff(lines)


def parse_fasta(records: DataFrame, column: str = "value") -> DataFrame:
    """(name, seq) of texts that each hold one FASTA record, with or without its leading ``>``."""
    text = F.regexp_replace(column, r"^>", "")
    head = F.substring_index(text, "\n", 1)
    return records.filter(F.trim(column) != "").select(F.trim(F.regexp_replace(head, r"\r", "")).alias("name"), F.regexp_replace(text.substr(F.length(head) + 1, F.length(text)), r"\s", "").alias("seq"))


def read_fasta(spark: SparkSession, *paths: str) -> DataFrame:
    """Records are split at line starts with ``>``; sequences over several lines are joined."""
    return parse_fasta(spark.read.text(list(paths), lineSep="\n>"))


def read_key_table(spark: SparkSession, path: str) -> DataFrame:
    """A sample sheet of strings: rows starting with ``###`` go, blanks in cells become ``_``."""
    lines = spark.read.text(path).filter(~F.startswith("value", F.lit("###")) & (F.trim("value") != ""))
    header = lines.first()["value"].split("\t")
    parts = F.split("value", "\t")
    cells = [F.regexp_replace(F.coalesce(F.get(parts, F.lit(i)), F.lit("")), " ", "_").alias(h.strip()) for i, h in enumerate(header)]
    return lines.filter(F.col("value") != "\t".join(header)).select(*cells)


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """(bc_name, bc_seq); of names that share a sequence the first in order stays."""
    pairs = spark.read.text(path).select(F.regexp_extract("value", r"^\s*(\S+)\s+(\S+)", 1).alias("bc_name"), F.regexp_extract("value", r"^\s*(\S+)\s+(\S+)", 2).alias("bc_seq"))
    return pairs.filter("bc_seq <> ''").groupBy("bc_seq").agg(F.min("bc_name").alias("bc_name")).select("bc_name", "bc_seq")


BLAST = StructType(
    [StructField(n, StringType()) for n in ("query_seqid", "sub_seqid")]
    + [StructField("percent_identity", DoubleType())]
    + [StructField(n, IntegerType()) for n in ("alignment_length", "mismatch", "gapopen", "query_start", "query_end", "sub_start", "sub_end")]
    + [StructField(n, DoubleType()) for n in ("evalue", "bitscore")]
)


def read_blast_hits(spark: SparkSession, *paths: str) -> DataFrame:
    """Twelve columns; starts and ends count from 0."""
    hits = spark.read.csv(list(paths), schema=BLAST)
    return hits.withColumns({c: F.col(c) - 1 for c in ("query_start", "query_end", "sub_start", "sub_end")})


def write_demux_table(reads: DataFrame, path: str, files: int = 8) -> None:
    """S9 as Parquet by prefix and barcode, for further jobs (``fastq.write_demux`` writes FASTQ); each bucket is spread over
    ``files`` tasks by a hash of the read, so that unmatched reads do not gather."""
    n = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = reads.withColumn("_salt", F.pmod(F.xxhash64("read_id"), F.lit(files)))
    salted.repartition(n, "file_prefix", "barcode", "_salt").drop("_salt").write.partitionBy("file_prefix", "barcode").parquet(path)


def fastq_lines(name: Column, seq: Column, qual: Column) -> Column:
    """The four lines of a read as one value."""
    return F.concat_ws("\n", F.concat(F.lit("@"), name), seq, F.lit("+"), qual)


def fasta_lines(name: Column, seq: Column) -> Column:
    """S10."""
    return F.concat_ws("\n", F.concat(F.lit(">"), name), seq)


def fasta_to_fastq(name: Column, seq: Column, trim5: int = 0, trim3: int = 0) -> Column:
    """A FASTA record as a read with quality ``A`` throughout, both ends cut; blanks in names become ``_``."""
    kept = seq.substr(F.lit(trim5 + 1), F.greatest(F.lit(0), F.length(seq) - trim5 - trim3))
    return fastq_lines(F.regexp_replace(name, " ", "_"), kept, F.repeat(F.lit("A"), F.length(kept)))


def write_matrix(counts: DataFrame, path: str, samples: list[str], order: DataFrame | None = None) -> None:
    """Genes by samples as tab-separated text with a header, in the order of ``order`` (gene, line_no), else by name.

    Genes that ``order`` does not list come last, by name.
    """
    wide = counts.groupBy("gene").pivot("sample_id", samples).agg(F.sum("n"))
    by = ["gene"] if order is None else ["line_no", "gene"]
    listed = wide if order is None else wide.join(order, "gene", "left").withColumn("line_no", F.coalesce("line_no", F.lit((1 << 63) - 1)))
    placed = listed.repartitionByRange(*by).sortWithinPartitions(*by).drop("line_no")
    placed.withColumnRenamed("gene", "Geneid").write.csv(path, sep="\t", header=True)
