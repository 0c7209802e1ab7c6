"""Alignment operators: pair classification, transcript and gene counts, fragments, duplicates, UMIs.

Alignments are rows (sample_id, qname, flag, rname, pos, cigar, tlen, seq, qual). Mates meet by a
grouping on (sample_id, qname) of the few columns that are needed; sequences are not shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from seqloom.functions.bases import cigar_ref_len, extract_umi, has_bit
from seqloom.sources.scratch import Table

KEYS = ("sample_id", "qname")
#: Most bytes of the names of references whose zeros are filled in.
REFERENCE_BYTES = 64 << 20


def primary(aln: DataFrame) -> DataFrame:
    return aln.filter(~has_bit(F.col("flag"), 0x900))


def mates(aln: DataFrame, *columns: str) -> DataFrame:
    """(sample_id, qname, r1, r2): the mates' flag and ``columns`` as structs, null where one is missing."""
    row = F.struct("flag", *columns)
    of = [F.max(F.when(has_bit(F.col("flag"), bit), row)).alias(name) for bit, name in ((64, "r1"), (128, "r2"))]
    # a name has two rows, so nothing combines before the shuffle: rows are sorted once, after it
    return primary(aln).select(*KEYS, "flag", *columns).repartition(*KEYS).groupBy(*KEYS).agg(*of)


def classify_pairs(aln: DataFrame) -> DataFrame:
    """A1: (sample_id, qname, class, proper, ref1, ref2).

    class: unmapped, both_forward, both_reverse, sense, antisense, or r1_/r2_ with sense/antisense
    and _single where the other mate is unmapped; broken if a mate is missing.
    """
    f1, f2 = F.col("r1.flag"), F.col("r2.flag")
    off1, off2, rev1, rev2 = has_bit(f1, 4), has_bit(f2, 4), has_bit(f1, 16), has_bit(f2, 16)
    kind = (
        F.when(F.col("r1").isNull() | F.col("r2").isNull(), "broken")
        .when(off1 & off2, "unmapped")
        .when(off2, F.when(rev1, "r1_sense_single").otherwise("r1_antisense_single"))
        .when(off1, F.when(rev2, "r2_antisense_single").otherwise("r2_sense_single"))
        .when(rev1 & rev2, "both_reverse")
        .when(~rev1 & ~rev2, "both_forward")
        .when(rev1, "sense")
        .otherwise("antisense")
    )
    return mates(aln, "rname").select(*KEYS, kind.alias("class"), has_bit(f1, 2).alias("proper"), F.col("r1.rname").alias("ref1"), F.col("r2.rname").alias("ref2"))


def every_reference(samples: DataFrame, references: DataFrame, column: str) -> DataFrame:
    """(sample_id, column): each sample with all names of ``references`` (column).

    The names are one list, a sub-query of the plan, unrolled where the samples are; the query fails if they come to over
    ``REFERENCE_BYTES``.
    """
    fits = F.sum(F.octet_length(column)) <= REFERENCE_BYTES
    names = F.when(F.coalesce(fits, F.lit(True)), F.collect_set(column)).otherwise(F.raise_error(F.lit(f"the names of references take over {REFERENCE_BYTES} bytes")))
    return samples.select("sample_id").distinct().withColumn(column, F.explode(references.select(names).scalar()))


def with_zeros(counts: DataFrame, references: DataFrame, column: str) -> DataFrame:
    """Counts (sample_id, column, numbers...) of all references in each of their samples, zeros where there are none, and of no other."""
    numbers = [c for c in counts.columns if c not in ("sample_id", column)]
    zeros = every_reference(counts, references, column).select("sample_id", column, *[F.lit(0).cast("long").alias(c) for c in numbers], F.lit(True).alias("_listed"))
    both = counts.select("sample_id", column, *[F.col(c).cast("long").alias(c) for c in numbers], F.lit(False).alias("_listed")).unionByName(zeros)
    return both.groupBy("sample_id", column).agg(*[F.sum(c).alias(c) for c in numbers], F.max("_listed").alias("_listed")).filter("_listed").drop("_listed")


def _counted(hits: DataFrame, references: DataFrame | None, *extra: str) -> DataFrame:
    """Sums of (sample_id, transcript, *extra, sense, reads) by strand; zeros for references not hit."""
    sums = [F.sum(F.when(F.col("sense") == s, F.col(c)).otherwise(0)).alias(n) for s, c, n in ((True, "reads", "s_read"), (False, "reads", "as_read"), (True, "frags", "s_frag"), (False, "frags", "as_frag"))]
    out = hits.groupBy("sample_id", "transcript", *extra).agg(*sums)
    return out if references is None else with_zeros(out, references.select(F.col("rname").alias("transcript")), "transcript")


def count_transcripts(classified: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """A2: fragments and reads of every reference by strand, zeros included if ``references`` are given.

    Mates on one reference are one fragment of two reads; on two, or with one mate mapped, each is
    one fragment of one read.
    """
    own = classified.filter(F.col("class").rlike("sense"))
    single = F.col("class").endswith("_single")

    def one(ref: Column, reads: int) -> Column:
        return F.struct(ref.alias("transcript"), F.lit(reads).alias("reads"))

    gives = (
        F.when(single, F.array(one(F.when(F.startswith("class", F.lit("r1")), F.col("ref1")).otherwise(F.col("ref2")), 1)))
        .when(F.col("ref1") == F.col("ref2"), F.array(one(F.col("ref1"), 2)))
        .otherwise(F.array(one(F.col("ref1"), 1), one(F.col("ref2"), 1)))
    )
    sense = ~F.contains("class", F.lit("antisense"))
    hits = own.select("sample_id", sense.alias("sense"), F.explode(gives).alias("g")).select("sample_id", "sense", "g.transcript", "g.reads", F.lit(1).alias("frags"))
    return _counted(hits, references)


def single_hits(aln: DataFrame, forward_is_sense: bool = False) -> DataFrame:
    """Mapped single-end reads by strand: forward ones are antisense unless told otherwise."""
    reverse = has_bit(F.col("flag"), 16)
    sense = ~reverse if forward_is_sense else reverse
    mapped = primary(aln).filter(~has_bit(F.col("flag"), 4))
    return mapped.select("sample_id", "qname", F.col("rname").alias("transcript"), sense.alias("sense"), F.lit(1).alias("reads"), F.lit(1).alias("frags"))


def count_transcripts_single(aln: DataFrame, references: DataFrame | None = None, forward_is_sense: bool = False) -> DataFrame:
    """A3."""
    return _counted(single_hits(aln, forward_is_sense), references)


def count_transcripts_umi(aln: DataFrame, forward_is_sense: bool = False) -> DataFrame:
    """A4: A3 for each (transcript, umi); names without a UMI count under null."""
    hits = single_hits(aln, forward_is_sense).withColumn("umi", extract_umi(F.col("qname")))
    return _counted(hits, None, "umi")


def pair_metrics(classified: DataFrame) -> DataFrame:
    """A5: the tallies of all classes per sample, in long form; they add up to total_reads."""
    kind = F.col("class")
    proper = F.col("proper")

    def n(cond: Column, times: int = 1) -> Column:
        return (F.count_if(cond) * times).cast("long")

    single = kind.endswith("_single")
    tallies = {
        "read_both_forward": n(kind == "both_forward", 2),
        "read_both_reverse": n(kind == "both_reverse", 2),
        "read1_s": n((kind == "sense") & proper),
        "read1_s_i": n((kind == "sense") & ~proper),
        "read2_s": n((kind == "sense") & proper),
        "read2_s_i": n((kind == "sense") & ~proper),
        "read1_as": n((kind == "antisense") & proper),
        "read1_as_i": n((kind == "antisense") & ~proper),
        "read2_as": n((kind == "antisense") & proper),
        "read2_as_i": n((kind == "antisense") & ~proper),
        "read1_s_mu": n(kind == "r1_sense_single"),
        "read1_as_mu": n(kind == "r1_antisense_single"),
        "read2_s_mu": n(kind == "r2_sense_single"),
        "read2_as_mu": n(kind == "r2_antisense_single"),
        "unmapped_reads": n(kind == "unmapped", 2) + n(single),
        "total_reads": n(kind != "broken", 2),
    }
    split = kind.isin("sense", "antisense") & (F.col("ref1") != F.col("ref2"))
    frags = F.when(split, 2).otherwise(1)
    is_sense = kind.rlike("^(r[12]_)?sense")
    for name, cond in (("sense_frags", is_sense), ("antisense_frags", F.contains("class", F.lit("antisense"))), ("aligned_frags", kind.rlike("sense"))):
        tallies[name] = F.sum(F.when(cond, frags).otherwise(0)).cast("long")
    wide = classified.groupBy("sample_id").agg(*[v.alias(k) for k, v in tallies.items()])
    return wide.unpivot(["sample_id"], list(tallies), "metrics_type", "count")


def gene_counts(tcounts: DataFrame, tmap: DataFrame) -> DataFrame:
    """(sample_id, Geneid, Fragcount): sense sums, and antisense sums under ``AS:``; all mapped genes are there.

    The transcript map is an annotation's size and joined as Spark sees fit; unmapped transcripts go.
    """
    summed = tcounts.join(tmap, "transcript").groupBy("sample_id", "gene").agg(F.sum("s_frag").alias("s"), F.sum("as_frag").alias("a"))
    seen = tcounts.select("sample_id").distinct().select("sample_id", F.lit(None).cast("string").alias("gene"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("a"))
    every = with_zeros(summed.unionByName(seen), tmap.select("gene"), "gene")  # samples without a mapped transcript too
    rows = F.array(F.struct(F.col("gene").alias("Geneid"), F.col("s").alias("n")), F.struct(F.concat(F.lit("AS:"), "gene").alias("Geneid"), F.col("a").alias("n")))
    return every.select("sample_id", F.explode(rows).alias("r")).select("sample_id", "r.Geneid", F.col("r.n").cast("long").alias("Fragcount"))


def gene_counts_umi(tcounts_umi: DataFrame, tmap: DataFrame) -> DataFrame:
    """Per gene and strand the UMIs seen, each once, and the fragments that this drops."""
    by_umi = tcounts_umi.join(tmap, "transcript").groupBy("sample_id", "gene", "umi").agg(F.sum("s_frag").alias("s"), F.sum("as_frag").alias("a"))
    return by_umi.groupBy("sample_id", "gene").agg(
        F.count_if(F.col("s") >= 1).alias("s_count"), F.count_if(F.col("a") >= 1).alias("as_count"), (F.sum("s") - F.count_if(F.col("s") >= 1)).alias("s_drop"), (F.sum("a") - F.count_if(F.col("a") >= 1)).alias("as_drop")
    )


# Biotypes by class.
BIOTYPES = {
    "protein_coding": "IG_C_gene IG_D_gene IG_J_gene IG_V_gene polymorphic_pseudogene protein_coding TR_C_gene TR_D_gene TR_J_gene TR_V_gene",
    "pseudogene": (
        "IG_C_pseudogene IG_J_pseudogene IG_pseudogene IG_V_pseudogene processed_pseudogene pseudogene transcribed_processed_pseudogene "
        "transcribed_unprocessed_pseudogene TR_J_pseudogene TR_V_pseudogene unitary_pseudogene unprocessed_pseudogene transcribed_unitary_pseudogene"
    ),
    "long_noncoding": "3prime_overlapping_ncRNA antisense lincRNA non_coding processed_transcript sense_intronic sense_overlapping",
    "short_noncoding": "miRNA misc_RNA Mt_rRNA Mt_tRNA rRNA scRNA snoRNA snRNA",
}
CLASSES = ("ribosomal_rna", *BIOTYPES, "uncategorized")


def biotype_class(gene: Column) -> Column:
    """The class of a packed gene name: ``NR_`` genes are ribosomal, others go by their fourth part; null without one."""
    bio = F.regexp_extract(gene, r"^\S+?:\S+?:\S+?:(\w+)", 1)
    out = F.when(F.startswith(gene, F.lit("NR_")), "ribosomal_rna")
    for name, types in BIOTYPES.items():
        out = out.when(bio.isin(types.split()), name)
    return out.when(bio != "", "uncategorized")


def percent(part: Column, whole: Column) -> Column:
    """A share in percent with four decimals; 0 of nothing is 0."""
    return F.when(whole == 0, 0.0).otherwise(F.round(part * 100.0 / whole, 4))


def biotype_metrics(counts: DataFrame) -> DataFrame:
    """Per sample, each class's share of all aligned fragments and its share of sense ones, in long form."""
    antisense = F.startswith("Geneid", F.lit("AS:"))
    named = counts.select("sample_id", "Fragcount", antisense.alias("anti"), biotype_class(F.regexp_replace("Geneid", "^AS:", "")).alias("class"))
    sums = [F.sum(F.when((F.col("class") == c) & (F.col("anti") == a), F.col("Fragcount")).otherwise(0)).alias(f"{c}_{'as' if a else 's'}") for c in CLASSES for a in (False, True)]
    wide = named.groupBy("sample_id").agg(F.sum("Fragcount").alias("aligned"), *sums)
    out, names = [F.col("sample_id")], []
    for c in CLASSES:
        both = F.col(f"{c}_s") + F.col(f"{c}_as")
        out += [percent(both, F.col("aligned")).alias(f"{c}_frags_pct_of_aligned_frags"), percent(F.col(f"{c}_s"), both).alias(f"{c}_frags_sense_pct")]
        names += [f"{c}_frags_pct_of_aligned_frags", f"{c}_frags_sense_pct"]
    return wide.select(*out).unpivot(["sample_id"], names, "metrics_type", "pct")


# --- fragments --------------------------------------------------------------------------------


def strand_of(flag: Column, reverse: bool = False) -> Column:
    """The transcript strand that an alignment's flag stands for; ``0`` if it tells none."""
    rev, mate_off, mate_rev = has_bit(flag, 16), has_bit(flag, 8), has_bit(flag, 32)
    plus, minus = ("-", "+") if reverse else ("+", "-")
    first = F.when(rev | (~mate_rev & ~mate_off), plus).when(~rev | (mate_rev & ~mate_off), minus)
    second = F.when(~rev | mate_rev, plus).otherwise(minus)
    return F.when(has_bit(flag, 64), first).when(has_bit(flag, 128), second).when(flag == 0, plus).when(flag == 16, minus).otherwise("0")


def fragments(aln: DataFrame, strand_rev: bool = False, min_len: int = 0, ref_filter: str | None = None) -> DataFrame:
    """(sample_id, acc, start_pos, end_pos, strand, paired, name).

    A properly paired couple is one fragment from the smaller start, placed by its second mate; any
    other mapped read is one of its own. Ends are starts plus the reference length of the alignment.
    Only properly paired reads are shuffled, once; the others pass as they are read.
    """
    kept = primary(aln).filter(F.length("qual") >= min_len)
    if ref_filter is not None:
        kept = kept.filter(F.col("rname") == ref_filter)
    flag = F.col("flag")
    proper, start = has_bit(flag, 2), F.col("pos").cast("long")
    placed = kept.select(*KEYS, "flag", "rname", start.alias("start_pos"), (start + cigar_ref_len(F.col("cigar"))).alias("end_pos"))
    alone = placed.filter(~proper & ~has_bit(flag, 4)).select(
        "sample_id", F.col("rname").alias("acc"), "start_pos", "end_pos", strand_of(flag, strand_rev).alias("strand"), F.lit(False).alias("paired"), F.col("qname").alias("name")
    )
    couples = mates(placed.filter(proper), "rname", "start_pos", "end_pos").filter("r2 is not null")
    first_starts = F.col("r1.start_pos") <= F.col("r2.start_pos")
    both = couples.select(
        "sample_id",
        F.col("r2.rname").alias("acc"),
        F.when(first_starts, F.col("r1.start_pos")).otherwise(F.col("r2.start_pos")).alias("start_pos"),
        F.when(F.coalesce(first_starts, F.lit(True)), F.col("r2.end_pos")).otherwise(F.col("r1.end_pos")).alias("end_pos"),
        strand_of(F.col("r2.flag"), strand_rev).alias("strand"),
        F.lit(True).alias("paired"),
        F.col("qname").alias("name"),
    )
    return alone.unionByName(both)


def alignment_summary(aln: DataFrame, min_len: int = 0) -> DataFrame:
    """A10: per sample: total reads, % short, % mapped, % in proper pairs of the mapped ones, mean insert."""
    mapped, proper = ~has_bit(F.col("flag"), 4), has_bit(F.col("flag"), 2)
    short = F.length("qual") < min_len
    frags = fragments(aln, min_len=min_len).filter("paired").groupBy("sample_id").agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("len"))
    n = aln.groupBy("sample_id").agg(F.count(F.lit(1)).alias("total_reads"), F.count_if(short).alias("short"), F.count_if(mapped & ~short).alias("mapped"), F.count_if(proper & ~short).alias("proper"))
    insert = F.when(F.col("proper") == 0, 0.0).otherwise(F.round(F.col("len") / (F.col("proper") / 2), 4))
    out = n.join(frags, "sample_id", "left")
    return out.select("sample_id", "total_reads", percent(F.col("short"), F.col("total_reads")).alias("pcnt_short"), percent(F.col("mapped"), F.col("total_reads")).alias("pcnt_mapped"), percent(F.col("proper"), F.col("mapped")).alias("pcnt_proper"), insert.alias("mean_insert"))


def reads_per_accession(aln: DataFrame, references: DataFrame) -> DataFrame:
    """A10: mapped reads of every (sample, accession), zeros included."""
    hits = aln.groupBy("sample_id", "rname").agg(F.count_if(~has_bit(F.col("flag"), 4)).alias("reads"))
    return with_zeros(hits, references.select("rname"), "rname")


def distinct_fragments(frags: DataFrame) -> DataFrame:
    """One fragment for each coordinate."""
    return frags.groupBy("sample_id", "acc", "start_pos", "end_pos", "strand", "paired").agg(F.min("name").alias("name"))


def quality_sum(qual: Column) -> Column:
    """The sum of base qualities, added up in numpy a batch at a time; 0 for null."""

    @F.pandas_udf(LongType())
    def total(quals: pd.Series) -> pd.Series:
        raw = [(q or "").encode() for q in quals]
        ends = np.cumsum([len(q) for q in raw], dtype=np.int64)
        sums = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) - 33)])
        return pd.Series(np.diff(sums[ends], prepend=0), dtype="int64")

    return total(qual)


def mark_duplicates(aln: DataFrame, piled: int = 100_000) -> DataFrame:
    """(sample_id, qname, duplicate) of pairs with both mates mapped.

    Pairs of one sample with the same 5' positions and orientations of both mates are copies; all
    but the one with the best sum of base qualities (then the first name) are duplicates. Pairs are
    made once and written, with their place as two 64-bit hashes, and sorted by place. Places of more than ``piled``
    pairs, which are few, are neither sorted nor met in one task: the best pair of each is a grouped maximum, sent to all tasks.
    """
    mapped = primary(aln).filter(~has_bit(F.col("flag"), 4))
    five = F.when(has_bit(F.col("flag"), 16), F.col("pos") + cigar_ref_len(F.col("cigar"))).otherwise(F.col("pos").cast("long"))
    sized = mapped.select(*KEYS, "flag", "rname", five.alias("five"), quality_sum(F.col("qual")).alias("q"))
    pairs = mates(sized, "rname", "five", "q").filter("r1 is not null and r2 is not null")
    ends = [c for r in ("r1", "r2") for c in (F.coalesce(f"{r}.rname", F.lit("")), F.coalesce(f"{r}.five", F.lit(-1)), has_bit(F.col(f"{r}.flag"), 16))]
    place = [F.xxhash64(F.lit(k), F.col("sample_id"), *ends).alias(f"p{k}") for k in (1, 2)]
    keyed = Table(pairs.select(*KEYS, *place, (F.col("r1.q") + F.col("r2.q")).alias("q"))).df
    piles = F.broadcast(keyed.groupBy("p1").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > piled).select("p1"))
    order = Window.partitionBy("p1", "p2").orderBy(F.desc("q"), "qname")
    usual = keyed.join(piles, "p1", "left_anti").select(*KEYS, (F.row_number().over(order) > 1).alias("duplicate"))
    many = keyed.join(piles, "p1", "left_semi")
    best = F.broadcast(many.groupBy("p1", "p2").agg(F.max("q").alias("best")))
    first = F.broadcast(many.join(best, ["p1", "p2"]).filter("q = best").groupBy("p1", "p2").agg(F.max("best").alias("best"), F.min("qname").alias("first")))
    copies = many.join(first, ["p1", "p2"]).select(*KEYS, ((F.col("q") < F.col("best")) | (F.col("qname") != F.col("first"))).alias("duplicate"))
    return usual.unionByName(copies)


def umi_collapse(aln: DataFrame, by: str = "coordinate", features: Column | None = None) -> DataFrame:
    """One read per (sample, place, umi), and how many it stands for.

    place: (rname, pos, strand), or ``features`` (a column of the alignments).
    """
    mapped = primary(aln).filter(~has_bit(F.col("flag"), 4))
    place = F.concat_ws(":", "rname", "pos", F.when(has_bit(F.col("flag"), 16), "-").otherwise("+")) if by == "coordinate" else features
    return mapped.select("sample_id", "qname", extract_umi(F.col("qname")).alias("umi"), place.alias("place")).groupBy("sample_id", "place", "umi").agg(F.min("qname").alias("qname"), F.count(F.lit(1)).alias("reads"))


def collapse_stats(sizes: DataFrame) -> DataFrame:
    """Per sample min, median and max of reads per collapse, % singletons of all and of those up to 100 (null if
    there are none so small), and reads before / after."""
    n = F.col("reads")
    small = F.count_if(n <= 100)
    return sizes.groupBy("sample_id").agg(
        F.min(n).alias("min"),
        F.percentile(n, 0.5).alias("median"),
        F.max(n).alias("max"),
        F.round(100.0 * F.count_if(n == 1) / F.count(F.lit(1)), 4).alias("pcnt_single"),
        F.round(F.try_divide(100.0 * F.count_if(n == 1), small), 4).alias("pcnt_single_100"),
        F.round(F.sum(n) / F.count(F.lit(1)), 4).alias("compression"),
    )


def collapse_histogram(sizes: DataFrame) -> DataFrame:
    """Collapses by size, 101 standing for all above 100."""
    return sizes.groupBy("sample_id", F.least("reads", F.lit(101)).alias("size")).agg(F.count(F.lit(1)).alias("n"))


def insert_size_metrics(aln: DataFrame) -> DataFrame:
    """Number, mean and median of the template lengths of proper pairs, per sample."""
    first = primary(aln).filter(has_bit(F.col("flag"), 2) & has_bit(F.col("flag"), 64))
    size = F.abs("tlen")
    return first.groupBy("sample_id").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg(size), 4).alias("mean"), F.percentile(size, 0.5).alias("median"))


def insert_size_histogram(aln: DataFrame) -> DataFrame:
    """Proper pairs by template length, per sample."""
    first = primary(aln).filter(has_bit(F.col("flag"), 2) & has_bit(F.col("flag"), 64))
    return first.groupBy("sample_id", F.abs("tlen").alias("size")).agg(F.count(F.lit(1)).alias("pairs"))


def quality_by_cycle(aln: DataFrame) -> DataFrame:
    """Mean base quality at each position, per sample.

    Every batch is summed by position in numpy before anything is shuffled.
    """

    def sums(batches):
        for batch in batches:
            for sample, own in batch.groupby("sample_id"):
                raw = [q.encode() for q in own["qual"] if q]
                width = max(map(len, raw), default=0)
                if not width:
                    continue
                flat = np.frombuffer(b"".join(q.ljust(width, b"\0") for q in raw), np.uint8).reshape(-1, width)
                there = flat > 0
                yield pd.DataFrame({"sample_id": sample, "cycle": np.arange(1, width + 1), "total": np.where(there, flat.astype(np.int64) - 33, 0).sum(axis=0), "n": there.sum(axis=0)})

    part = aln.select("sample_id", "qual").mapInPandas(sums, "sample_id string, cycle int, total long, n long")
    return part.groupBy("sample_id", "cycle").agg(F.round(F.sum("total") / F.sum("n"), 4).alias("mean_quality"))


def mapping_summary(aln: DataFrame) -> DataFrame:
    """Reads by category, per sample: all, first mates, second mates and unpaired."""
    flag = F.col("flag")
    category = F.when(has_bit(flag, 64), "FIRST_OF_PAIR").when(has_bit(flag, 128), "SECOND_OF_PAIR").otherwise("UNPAIRED")
    rows = primary(aln).select("sample_id", F.explode(F.array(category, F.lit("ALL"))).alias("category"), "flag")
    return rows.groupBy("sample_id", "category").agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(~has_bit(flag, 4)).alias("mapped"), F.count_if(has_bit(flag, 2)).alias("proper"), F.count_if(has_bit(flag, 16) & ~has_bit(flag, 4)).alias("reverse")
    )
