"""Quality reports: demultiplexing, composition, replicon and pool metrics, and selection tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.align import percent
from seqloom.operators.reads import AMBIGUOUS, NO_MATCH


def n_rows() -> Column:
    return F.count(F.lit(1))


def ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    """part / whole as a rounded percentage; 0 where there is nothing."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, 0.0).otherwise(F.round(100.0 * part / whole, digits))


def demux_report(assigned: DataFrame, barcodes: DataFrame, used: list[str] | None = None) -> DataFrame:
    """G1: one row for each barcode of the list and for ambiguous and unmatched reads: reads, their
    share of all, and the shares with no and one mismatch. Used barcodes are shown with ``-*``.

    The list is a kit's; reads are read once and counted in each task first, and the total is that of their counts.
    """
    counts = assigned.groupBy("barcode").agg(n_rows().alias("reads"), F.count_if(F.col("distance") == 0).alias("zero"), F.count_if(F.col("distance") == 1).alias("one"))
    listed = barcodes.select(F.col("bc_name").alias("barcode")).distinct().unionByName(assigned.sparkSession.createDataFrame([(AMBIGUOUS,), (NO_MATCH,)], "barcode string"))
    both = listed.withColumn("listed", F.lit(True)).join(counts, "barcode", "full").withColumn("total", F.coalesce(F.sum("reads").over(Window.partitionBy()), F.lit(0)))
    every = both.filter("listed").fillna(0, ["reads", "zero", "one"])
    name = F.when(F.col("barcode").isin(used), F.concat("barcode", F.lit("-*"))).otherwise(F.col("barcode")) if used else F.col("barcode")
    return every.select(name.alias("barcode"), "reads", ratio(F.col("reads"), F.col("total")).alias("pcnt_of_total"), ratio(F.col("zero"), F.col("reads")).alias("pcnt_zero_mismatch"), ratio(F.col("one"), F.col("reads")).alias("pcnt_one_mismatch"))


def combine_demux_reports(reports: DataFrame) -> DataFrame:
    """(index, barcode, pcnt_of_pool, reads, pcnt_perfect) of reports (index, lane, barcode, reads, pcnt_zero_mismatch), lanes summed."""
    sums = reports.groupBy("index", "barcode").agg(F.sum("reads").alias("reads"), F.sum(F.col("reads") * F.col("pcnt_zero_mismatch") / 100).alias("perfect"))
    pool = F.sum("reads").over(Window.partitionBy("index"))
    return sums.withColumn("pool", pool).select("index", "barcode", ratio(F.col("reads"), F.col("pool"), 4).alias("pcnt_of_pool"), "reads", ratio(F.col("perfect"), F.col("reads"), 4).alias("pcnt_perfect"))


def pool_matrix(combined: DataFrame, indexes: list[str]) -> DataFrame:
    """Barcodes by pools with the shares, and a ``Total_Reads:`` row."""
    shares = combined.groupBy("barcode").pivot("index", indexes).agg(F.max("pcnt_of_pool"))
    totals = combined.groupBy(F.lit("Total_Reads:").alias("barcode")).pivot("index", indexes).agg(F.sum("reads").cast("double"))
    return shares.unionByName(totals).fillna(0.0)


def inline_distribution(key: DataFrame, combined: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Every barcode in every pool of the key: sample or ``-``, share, reads and % perfect; status
    ``ok``, ``DATA_MISSING!`` (keyed, no data) or ``unkeyed``, and the place in that order, by share."""
    pools = key.select("project", "pool").distinct()
    grid = pools.crossJoin(F.broadcast(barcodes.select(F.col("bc_seq").alias("barcode"), "bc_name").distinct()))
    keyed = key.select("project", "pool", F.col("bc").alias("barcode"), "sample")
    have = combined.select(F.col("index").alias("pool")).distinct().withColumn("has_pool", F.lit(True))
    data = combined.withColumnRenamed("index", "pool")
    out = grid.join(keyed, ["project", "pool", "barcode"], "left").join(data, ["pool", "barcode"], "left").join(have, "pool", "left")
    out = out.withColumn("status", F.when(F.col("sample").isNull(), "unkeyed").when(F.col("has_pool").isNull(), "DATA_MISSING!").otherwise("ok"))
    group = F.when(F.col("status") == "ok", 0).when(F.col("status") == "DATA_MISSING!", 1).otherwise(2)
    order = Window.partitionBy("project").orderBy(group, F.desc_nulls_last("pcnt_of_pool"), "pool", "barcode", "bc_name", "sample")
    return out.select("project", F.coalesce("sample", F.lit("-")).alias("sample"), "barcode", "pool", "pcnt_of_pool", "reads", "pcnt_perfect", "bc_name", "status", F.row_number().over(order).alias("place"))


def raw_inline_frequency(reads: DataFrame, barcodes: DataFrame, n: int = 100_000, k: int = 9, top: int = 200) -> DataFrame:
    """Per file the ``top`` most frequent first k bases of its first n reads, as a share, with the exact barcode's name or ``-``."""
    head = reads.filter((F.col("ord") < n) & (F.length("r1_seq") >= k)).groupBy("file_prefix", F.substring("r1_seq", 1, k).alias("kmer")).agg(n_rows().alias("n"))
    total = F.sum("n").over(Window.partitionBy("file_prefix"))
    rank = F.row_number().over(Window.partitionBy("file_prefix").orderBy(F.desc("n"), "kmer"))
    listed = barcodes.groupBy(F.substring("bc_seq", 1, k).alias("kmer")).agg(F.min("bc_name").alias("bc_name"))
    ranked = head.withColumns({"pcnt": F.round(100.0 * F.col("n") / total, 6), "rank": rank}).filter(F.col("rank") <= top)
    return ranked.join(listed, "kmer", "left").select("file_prefix", "kmer", "n", "pcnt", "rank", F.coalesce("bc_name", F.lit("-")).alias("bc_name"))


def orphan_index_pairs(pairs: DataFrame, n: int = 100_000, top: int = 100) -> DataFrame:
    """The most frequent index pairs (i1, i2) of the first n unmatched reads, as shares."""
    head = pairs.filter(F.col("ord") < n)
    counts = head.groupBy("i1", "i2").agg(n_rows().alias("n"))
    total = head.agg(n_rows().alias("total"))
    best = counts.orderBy(F.desc("n"), "i1", "i2").limit(top)
    return best.crossJoin(F.broadcast(total)).select("i1", "i2", "n", ratio(F.col("n"), F.col("total")).alias("pcnt"))


def walkup_metrics(reads: DataFrame) -> DataFrame:
    """Reads in millions and as a share of their flowcell for every (flowcell, lane, index), and
    for each flowcell and lane and each flowcell in all (null below)."""
    sums = reads.rollup("flowcell", "lane", "index").agg(F.sum("n").alias("reads"), F.grouping_id().alias("level")).filter("flowcell is not null")
    whole = F.max(F.when(F.col("level") == 3, F.col("reads"))).over(Window.partitionBy("flowcell"))
    return sums.withColumn("whole", whole).select("flowcell", "lane", "index", F.round(F.col("reads") / 1e6, 6).alias("mreads"), ratio(F.col("reads"), F.col("whole")).alias("pcnt"))


def index_pool_totals(reads: DataFrame, key: DataFrame) -> DataFrame:
    """(index, pool, reads, pcnt): reads of each index over all flowcells and lanes, with the name of its
    pool (of several, the first in order; ``-`` if the key has none) and its share of all reads.

    reads (index, n), key (Pool_index, Pool_ID).
    """
    pools = key.groupBy(F.col("Pool_index").alias("index")).agg(F.min("Pool_ID").alias("pool"))
    sums = reads.groupBy("index").agg(F.sum("n").alias("reads")).join(pools, "index", "left")
    return sums.select("index", F.coalesce("pool", F.lit("-")).alias("pool"), "reads", ratio(F.col("reads"), F.sum("reads").over(Window.partitionBy())).alias("pcnt"))


def matched_share(reads: DataFrame) -> DataFrame:
    """Per flowcell the reads with a known index and the rest."""
    known = F.col("index") != "unmatched"
    return reads.groupBy("flowcell").agg(F.sum(F.when(known, F.col("n")).otherwise(0)).alias("matched"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("unmatched"), ratio(F.sum(F.when(known, F.col("n")).otherwise(0)), F.sum("n")).alias("pcnt_matched"))


def index_table(per_file: DataFrame, files: list[str], used: list[str]) -> DataFrame:
    """Index by file with the shares, their average over all files, and a star for used ones."""
    total = F.sum("n").over(Window.partitionBy("file"))
    shares = per_file.withColumn("pcnt", 100.0 * F.col("n") / total)
    wide = shares.groupBy("index").pivot("file", files).agg(F.round(F.sum("pcnt"), 6)).fillna(0.0)
    mean = shares.groupBy("index").agg(F.round(F.sum("pcnt") / len(files), 6).alias("average"))
    return wide.join(mean, "index").withColumn("used", F.when(F.col("index").isin(used), "*").otherwise(""))


# --- counts -----------------------------------------------------------------------------------

KINDS = ("CDS", "rRNA", "misc_RNA", "ncRNA", "tRNA")


def typed_counts(counts: DataFrame) -> DataFrame:
    """Counts (feature, n, ...) with the feature's kind and whether it is antisense, from its packed name."""
    anti = F.col("feature").rlike("^AS[_:]")
    name = F.regexp_replace("feature", "^AS[_:]", "")
    return counts.withColumns({"is_as": anti, "kind": F.split(name, ":")[0]})


def replicon_metrics(counts: DataFrame, summary: DataFrame, per_acc: DataFrame, keys: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """A row for each sample (or cell) and replicon, and ``ALL`` where there are several.

    counts (keys, acc, feature, n), summary (keys, total_reads, pcnt_proper, mean_insert), per_acc
    (keys, acc, reads). Shares of sense leave intergenic regions out; each kind has its share of all
    counted and its own share of sense; 0 of nothing is 0.
    """
    k = list(keys)
    typed = typed_counts(counts)

    def of(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    kind, anti = F.col("kind"), F.col("is_as")
    igr = kind == "IGR"
    aggs = [F.sum("n").alias("counted"), of(~igr & ~anti).alias("sense"), of(~igr).alias("known"), of(igr).alias("igr")]
    aggs += [of((kind == t) & cond).alias(f"{t}_{name}") for t in KINDS for name, cond in (("s", ~anti), ("a", anti))]
    by_acc = typed.groupBy(*k, "acc").agg(*aggs)
    several = by_acc.groupBy(*k).agg(n_rows().alias("replicons"))
    sums = [c for c in by_acc.columns if c not in (*k, "acc")]
    whole = by_acc.groupBy(*k).agg(F.lit("ALL").alias("acc"), *[F.sum(c).alias(c) for c in sums], n_rows().alias("m")).filter("m > 1").drop("m")
    reads = per_acc.select(*k, "acc", F.col("reads").alias("aligned"))
    all_reads = reads.groupBy(*k).agg(F.lit("ALL").alias("acc"), F.sum("aligned").alias("aligned"))
    both = by_acc.unionByName(whole).filter("counted > 0").join(reads.unionByName(all_reads), [*k, "acc"], "left").join(summary, k, "left").join(several, k)
    shown = F.when((F.col("replicons") > 1) & (F.col("acc") != "ALL"), None).otherwise(F.col("mean_insert"))
    out = [*k, "total_reads", F.col("acc").alias("replicon"), percent(F.col("aligned"), F.col("total_reads")).alias("pcnt_aligned"), "pcnt_proper", shown.alias("mean_insert"), "counted", percent(F.col("sense"), F.col("known")).alias("pcnt_sense")]
    for t in KINDS:
        n = F.col(f"{t}_s") + F.col(f"{t}_a")
        out += [percent(n, F.col("counted")).alias(f"{t}_pcnt_of_counted"), percent(F.col(f"{t}_s"), n).alias(f"{t}_pcnt_sense")]
    out += [(F.col("CDS_s") + F.col("CDS_a")).alias("CDS_total"), percent(F.col("igr"), F.col("counted")).alias("IGR_pcnt_of_counted")]
    return both.select(*out)


def featurecounts_metrics(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Per sample aligned, unmapped and sense fragments and each kind's share of aligned and of sense, in long form."""
    typed = typed_counts(counts)
    kinds = ("CDS", "IGR", "rRNA", "ncRNA", "tRNA", "misc_RNA")
    sums = [F.sum(F.when((F.col("kind") == t) & (F.col("is_as") == a), F.col("n")).otherwise(0)).alias(f"{t}_{int(a)}") for t in kinds for a in (False, True)]
    wide = typed.groupBy("sample_id").agg(*sums).join(totals, "sample_id")
    sense, anti = (sum((F.col(f"{t}_{a}") for t in kinds), F.lit(0)) for a in (0, 1))
    wide = wide.withColumns({"sense": sense, "aligned": sense + anti})
    out = {"aligned_frag": F.col("aligned"), "unmapped_count": F.col("total") - F.col("aligned"), "sense_frag": F.col("sense")}
    out |= {"aligned_frag_pct_of_total": percent(F.col("aligned"), F.col("total")), "unmapped_count_pct_of_total": percent(F.col("total") - F.col("aligned"), F.col("total")), "sense_frag_pct_of_aligned": percent(F.col("sense"), F.col("aligned"))}
    for t in kinds:
        n = F.col(f"{t}_0") + F.col(f"{t}_1")
        out |= {f"{t}_pct_of_aligned": percent(n, F.col("aligned")), f"{t}_sense_pct": percent(F.col(f"{t}_0"), n)}
    return wide.select("sample_id", *[v.cast("double").alias(m) for m, v in out.items()]).unpivot(["sample_id"], list(out), "metrics_type", "value")


class GeneMismatch(ValueError):
    """Samples of one matrix list different genes."""


def mismatched_genes(counts: DataFrame, samples: list[str]) -> DataFrame:
    """(gene, n, rows): genes that are not in each of ``samples`` exactly once, for callers that check before they build."""
    listed = counts.groupBy("gene").agg(F.countDistinct("sample_id").alias("n"), n_rows().alias("rows"))
    return listed.filter((F.col("n") != len(samples)) | (F.col("rows") != len(samples)))


def gene_matrix(counts: DataFrame, samples: list[str], check: bool = True) -> DataFrame:
    """Genes by samples; all samples must list the same genes, each once, which ``check`` makes sure of at once.

    For up to some thousand samples; ``seqloom.sources.sparse`` writes matrices of any number of cells.
    """
    wrong = mismatched_genes(counts, samples).limit(1).collect() if check else None
    if wrong:
        raise GeneMismatch(f"gene {wrong[0]['gene']!r} is in {wrong[0]['n']} of {len(samples)} samples, {wrong[0]['rows']} times")
    return counts.groupBy("gene").pivot("sample_id", samples).agg(F.sum("n"))


def metrics_matrix(metrics: DataFrame, kinds: list[str]) -> DataFrame:
    """A row for each sample and a column for each metric."""
    return metrics.groupBy("sample_id").pivot("metrics_type", kinds).agg(F.first("count"))


def merge_count_matrices(a: DataFrame, b: DataFrame, how: str = "sum") -> DataFrame:
    """Long counts (gene, sample_id, n) of both, samples of one name added up (``sum``), or set side by side (``paste``), then named apart."""
    if how == "paste":
        return a.withColumn("sample_id", F.concat("sample_id", F.lit("_1"))).unionByName(b.withColumn("sample_id", F.concat("sample_id", F.lit("_2"))))
    return a.unionByName(b).groupBy("gene", "sample_id").agg(F.sum("n").alias("n"))


def column_totals(counts: DataFrame) -> DataFrame:
    """G15."""
    return counts.groupBy("sample_id").agg(F.sum("n").alias("total"))


def pool_metrics(km: DataFrame) -> DataFrame:
    """Per pool: sums, means weighted by the samples' shares of the pool's reads, and shares of
    counts that are recovered from percentages as whole numbers first (cut off, not rounded)."""

    def whole(x: Column) -> Column:
        return F.floor(x).cast("long")

    frags = F.col("Total_frags_counted")
    rows = km.withColumn("aligned_reads", whole(F.col("Total_reads") * F.col("pcnt_aligned") / 100))
    rows = rows.withColumn("sense_reads", whole(F.col("aligned_reads") * F.col("pcnt_sense") / 100)).withColumn("CDS_sense", whole(F.col("CDS_pcnt_sense") * F.col("CDS_total") / 100))
    for t in ("rRNA", "misc_RNA", "tRNA", "IGR"):
        rows = rows.withColumn(f"{t}_frags", whole(F.col(f"{t}_pcnt_of_counted") * frags / 100))
    for t in ("rRNA", "misc_RNA", "tRNA"):
        rows = rows.withColumn(f"{t}_sense", whole(F.col(f"{t}_pcnt_sense") * F.col(f"{t}_frags") / 100))
    weight = F.col("Pcnt_bc_in_pool")
    summed = ["Total_reads", "Total_frags_counted", "aligned_reads", "sense_reads", "CDS_total", "CDS_sense", "rRNA_frags", "misc_RNA_frags", "tRNA_frags", "IGR_frags", "rRNA_sense", "misc_RNA_sense", "tRNA_sense"]
    read_cols = [f"{p}_{r}" for p in ("total", "trimmed", "empty") for r in ("read1s", "read2s", "read_pairs")]
    pools = rows.groupBy("Pool_ID").agg(F.sum(weight).alias("mapped"), *[F.sum(c).alias(c) for c in summed + read_cols], *[F.sum(F.col(c) * weight).alias(f"w_{c}") for c in ("pcnt_aligned", "pcnt_proper", "mean_insert")])

    def mean(c: str) -> Column:
        return F.when(F.col("mapped") == 0, 0.0).otherwise(F.round(F.col(f"w_{c}") / F.col("mapped"), 4))

    out = ["Pool_ID", F.col("Total_reads").alias("reads_assigned"), F.when(F.col("mapped") == 0, 0).otherwise(whole(F.col("Total_reads") * 100.0 / F.col("mapped"))).alias("reads_with_unassigned"), F.col("Total_frags_counted").alias("frags_counted"), F.round("mapped", 4).alias("pcnt_mapped_to_bcs")]
    out += [mean("pcnt_aligned").alias("pcnt_aligned"), mean("pcnt_proper").alias("pcnt_proper"), mean("mean_insert").alias("mean_insert"), percent(F.col("sense_reads"), F.col("aligned_reads")).alias("pcnt_sense"), "CDS_total"]
    out += [percent(F.col("CDS_total"), frags).alias("CDS_pcnt_of_counted"), percent(F.col("CDS_sense"), F.col("CDS_total")).alias("CDS_pcnt_sense")]
    for t in ("rRNA", "misc_RNA", "tRNA"):
        out += [percent(F.col(f"{t}_frags"), frags).alias(f"{t}_pcnt_of_counted"), percent(F.col(f"{t}_sense"), F.col(f"{t}_frags")).alias(f"{t}_pcnt_sense")]
    out += [percent(F.col("IGR_frags"), frags).alias("IGR_pcnt_of_counted")]
    out += [percent(F.col(f"{p}_{r}"), F.col(f"total_{r}")).alias(f"pcnt_{p}_{r}") for r in ("read1s", "read2s", "read_pairs") for p in ("trimmed", "empty")]
    return pools.select(*out)


def depth_report(km: DataFrame, target_reads: float = 1.0, target_cds: float = 0.5) -> DataFrame:
    """Per project and pool the mean of positive reads and CDS counts in millions, and the share
    of samples above their target with ``(k/n)``."""

    def mean(c: str) -> Column:
        return F.round(F.avg(F.when(F.col(c) > 0, F.col(c))) / 1e6, 2)

    def above(c: str, target: float) -> tuple[Column, Column]:
        k, n = F.count_if(F.col(c) > target * 1e6), F.count(c)
        return F.round(100.0 * k / n, 1), F.concat(F.lit("("), k, F.lit("/"), n, F.lit(")"))

    rp, rk = above("Num_bc_reads", target_reads)
    cp, ck = above("CDS_total", target_cds)
    return km.groupBy("Project_ID", "Pool_ID").agg(mean("Num_bc_reads").alias("reads_avg"), rp.alias("reads_pcnt"), rk.alias("reads_met"), mean("CDS_total").alias("cds_avg"), cp.alias("cds_pcnt"), ck.alias("cds_met"))


def depth_misses(km: DataFrame, target: float = 0.5, column: str = "CDS_total") -> DataFrame:
    """Samples below the target and the millions of reads that would top them up: (target - x) / x times the pool's mean reads."""
    report = km.groupBy("Project_ID", "Pool_ID").agg(F.round(F.avg(F.when(F.col("Num_bc_reads") > 0, F.col("Num_bc_reads"))) / 1e6, 2).alias("avg"))
    low = km.filter(F.col(column) < target * 1e6).join(report, ["Project_ID", "Pool_ID"])
    top_up = F.when(F.col(column) > 0, F.round((target * 1e6 - F.col(column)) / F.col(column) * F.col("avg"), 4))
    return low.select("Project_ID", "Pool_ID", "Sample_ID", column, top_up.alias("top_up"))


def low_samples(metrics: DataFrame, min_cds: int) -> DataFrame:
    """G18."""
    return metrics.filter(F.col("CDS_total") < min_cds)


def missing_metric_samples(joined: DataFrame, fields: list[str]) -> DataFrame:
    """Rows lacking any of the fields."""
    lacks = F.lit(False)
    for f in fields:
        lacks |= F.col(f).isNull() | (F.col(f).cast("string") == "")
    return joined.filter(lacks)


def host_rrna_pct(counts: DataFrame) -> DataFrame:
    """Per sample the shares of all, nuclear and mitochondrial ribosomal RNA among cDNA counts.

    Ribosomal genes start with ``NR_`` (nuclear) or hold ``Mt_rRNA``.
    """
    gene = F.regexp_replace("Geneid", "^AS:", "")
    nuclear, mt = F.startswith(gene, F.lit("NR_")), F.contains(gene, F.lit("Mt_rRNA"))

    def n(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("Fragcount")).otherwise(0))

    total = F.sum("Fragcount")
    return counts.groupBy("sample_id").agg(ratio(n(nuclear | mt), total, 4).alias("pcnt_rrna"), ratio(n(nuclear), total, 4).alias("pcnt_nuclear"), ratio(n(mt), total, 4).alias("pcnt_mt"))


def gene_ratio(counts: DataFrame, numerators: dict[str, str], reference: str = r"^CDS:") -> DataFrame:
    """Per sample the counts of features that match each pattern, divided by those of the reference."""
    def n(pattern: str) -> Column:
        return F.sum(F.when(F.col("feature").rlike(pattern), F.col("n")).otherwise(0))

    ref = n(reference)
    return counts.groupBy("sample_id").agg(*[F.when(ref == 0, 0.0).otherwise(F.round(n(p) / ref, 6)).alias(name) for name, p in numerators.items()])


def trim_stats(log: DataFrame) -> DataFrame:
    """Per sample total, trimmed and empty reads of both mates and pairs, with shares to 2 decimals.

    log: (sample_id, read_name, mate, surviving_len, first_base, trimmed_end). A read is trimmed if
    nothing survives or either end was cut; a pair is if either mate is, and empty if both are.
    """
    cut = (F.col("surviving_len") == 0) | (F.col("first_base") != 0) | (F.col("trimmed_end") != 0)
    gone = F.col("surviving_len") == 0
    one, two = F.startswith("mate", F.lit("1")), F.startswith("mate", F.lit("2"))
    pairs = log.groupBy("sample_id", "read_name").agg(
        F.count_if(one).alias("r1"), F.count_if(two).alias("r2"), F.count_if(one & cut).alias("t1"), F.count_if(two & cut).alias("t2"), F.count_if(one & gone).alias("e1"), F.count_if(two & gone).alias("e2"), F.max(cut).alias("cut"), F.count_if(gone).alias("gone")
    )
    sums = pairs.groupBy("sample_id").agg(
        *[F.sum(c).alias(n) for c, n in (("r1", "total_read1s"), ("t1", "trimmed_read1s"), ("e1", "empty_read1s"), ("r2", "total_read2s"), ("t2", "trimmed_read2s"), ("e2", "empty_read2s"))],
        n_rows().alias("total_read_pairs"), F.count_if("cut").alias("trimmed_read_pairs"), F.count_if(F.col("gone") == 2).alias("empty_read_pairs"),
    )
    return sums.select("*", *[ratio(F.col(f"{p}_{r}"), F.col(f"total_{r}"), 2).alias(f"percent_{p}_{r}") for r in ("read1s", "read2s", "read_pairs") for p in ("trimmed", "empty")])


# Bases before each adapter, and where the regions of a read start, by protocol.
ADAPTERS = {
    "rts": ("index1", 9, 8 + 33 + 9, (("dna", None), ("wb", 0), ("index1", 9), ("p5", 42), ("truseq", 50))),
    "scr": ("truseq", 8 + 13, 16 + 47 + 8 + 13, (("dna", None), ("wb", 0), ("umi", 13), ("truseq", 21), ("boa", 54), ("bb", 68), ("index2", 84))),
}


def adapter_insertions(hits: DataFrame, protocol: str) -> DataFrame:
    """(query_seqid, start, region) of one hit per read: the best of the preferred adapter (named
    without regard to case), else the best of any; start is where the read begins in the adapter."""
    preferred, before, before_other, regions = ADAPTERS[protocol]
    liked = F.lower("sub_seqid") == preferred
    best = hits.groupBy("query_seqid").agg(F.min(F.struct((~liked).alias("other"), "evalue", "query_start", "sub_start")).alias("b"))
    start = -(F.col("b.query_start") - F.col("b.sub_start") - F.when(F.col("b.other"), before_other).otherwise(before))
    out = best.select("query_seqid", start.alias("start"))
    region = F.when(F.col("start") < 0, "dna")
    for (name, _), (_, until) in zip(regions[1:-1], regions[2:], strict=True):
        region = region.when(F.col("start") < until, name)
    return out.withColumn("region", region.otherwise(regions[-1][0]))


def adapter_totals(insertions: DataFrame, total_reads: int) -> DataFrame:
    """Reads in all, with an adapter, without one, with nothing but adapter, and with DNA."""
    with_adapter, dna = n_rows(), F.count_if(F.col("region") == "dna")
    wide = insertions.agg(F.lit(total_reads).cast("long").alias("total"), with_adapter.alias("with_adapter"), (F.lit(total_reads) - with_adapter).cast("long").alias("without_adapter"), (with_adapter - dna).alias("only_adapter"), dna.alias("with_dna"))
    return wide.unpivot([], wide.columns, "what", "reads")


def adapter_histogram(insertions: DataFrame) -> DataFrame:
    """Reads by region and start."""
    return insertions.groupBy("region", "start").agg(n_rows().alias("n"))


def cell_barcode_counts(reads: DataFrame, aln: DataFrame, valid: DataFrame) -> DataFrame:
    """Total and aligned reads of each valid cell barcode (a whitelist, joined as Spark sees fit)."""
    own = reads.join(valid, "cell")
    mapped = aln.filter(F.col("flag").bitwiseAND(4) == 0).select("read_id").distinct().withColumn("hit", F.lit(1))
    return own.join(mapped, "read_id", "left").groupBy("cell").agg(n_rows().alias("total"), F.count("hit").alias("aligned"))


def barcode_umis(reads: DataFrame, n: int | None = None) -> DataFrame:
    """Distinct UMIs of each cell barcode, counted exactly in two steps."""
    used = reads if n is None else reads.filter(F.col("ord") < n)
    return used.select("cell", "umi").distinct().groupBy("cell").agg(n_rows().alias("umis"))


def barcode_whitelist(reads: DataFrame, error: int = 2, n: int | None = 100_000) -> DataFrame:
    """(cell, umis, kept_as): barcodes up to the knee of the ranked UMI counts are kept; others
    within ``error`` mismatches of exactly one nearest kept barcode are assigned to it.

    The knee is the rank furthest from the chord between the first and last point; ranks are taken
    over the counts' histogram, which is short. Mismatches are found by shared pieces: of error + 1
    pieces of a barcode one must be the same, so candidates meet by an equi-join.
    """
    counts = barcode_umis(reads, n)
    steps = counts.groupBy("umis").agg(n_rows().alias("m"))
    down = Window.orderBy(F.desc("umis"))
    ranked = steps.withColumn("rank", F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ranked.agg(F.max("umis").alias("y1"), F.min("umis").alias("y2"), F.min("rank").alias("x1"), F.max("rank").alias("x2"))
    far = F.abs((F.col("y2") - F.col("y1")) * F.col("rank") - (F.col("x2") - F.col("x1")) * F.col("umis") + F.col("x2") * F.col("y1") - F.col("y2") * F.col("x1"))
    knee = ranked.crossJoin(F.broadcast(ends)).select("umis", far.alias("far")).groupBy().agg(F.max_by("umis", F.struct("far", "umis")).alias("knee"))
    marked = counts.crossJoin(F.broadcast(knee)).withColumn("kept", F.col("umis") >= F.col("knee"))
    kept, rest = marked.filter("kept").select(F.col("cell").alias("kept_as")), marked.filter("not kept").select("cell", "umis")
    pieces = error + 1

    def cut(c: str) -> Column:
        size = F.ceil(F.length(c) / pieces).cast("int")
        return F.posexplode(F.array(*[F.substring(F.col(c), (F.lit(i) * size + 1).cast("int"), size) for i in range(pieces)])).alias("part", "piece")

    met = rest.select("cell", "umis", cut("cell")).join(kept.select("kept_as", cut("kept_as")), ["part", "piece"]).select("cell", "umis", "kept_as").distinct()
    apart = F.aggregate(F.zip_with(F.split("cell", ""), F.split("kept_as", ""), lambda a, b: F.when(a == b, 0).otherwise(1)), F.lit(0), lambda t, x: t + x)
    near = met.withColumn("d", apart).filter(F.col("d") <= error)
    best = near.groupBy("cell", "umis").agg(F.min(F.struct("d", "kept_as")).alias("b"), F.min("d").alias("least"), F.collect_list("d").alias("all"))
    unique = best.filter(F.size(F.filter("all", lambda d: d == F.col("least"))) == 1).select("cell", "umis", F.col("b.kept_as").alias("kept_as"))
    return marked.filter("kept").select("cell", "umis", F.col("cell").alias("kept_as")).unionByName(unique)


def status_summary(db: DataFrame) -> DataFrame:
    """Per library type projects, samples and rows of each status."""
    return db.groupBy("library_type", "status").agg(F.countDistinct("project").alias("projects"), F.countDistinct("sample").alias("samples"), n_rows().alias("n"))


def best_reference(tests: DataFrame) -> DataFrame:
    """Per strain its best accession by share aligned, each accession's mean, the best of all by
    mean, the strain's share on that one, its gap and rank."""
    best = tests.groupBy("strain").agg(F.max_by("accession", F.struct("frac_aligned", "accession")).alias("best"), F.max("frac_aligned").alias("best_frac"))
    means = tests.groupBy("accession").agg(F.avg("frac_aligned").alias("mean"))
    overall = means.groupBy().agg(F.max_by("accession", F.struct("mean", "accession")).alias("overall"), F.max("mean").alias("overall_mean"))
    rank = F.rank().over(Window.partitionBy("strain").orderBy(F.desc("frac_aligned")))
    ranked = tests.withColumn("rank", rank).join(F.broadcast(overall), F.col("accession") == F.col("overall"))
    return best.join(ranked, "strain", "left").select("strain", "best", F.round("best_frac", 6).alias("best_frac"), "overall", F.round("overall_mean", 6).alias("overall_mean"), F.round("frac_aligned", 6).alias("frac_on_overall"), F.round(F.col("best_frac") - F.col("frac_aligned"), 6).alias("gap"), "rank")


def top_per_species(seqs: DataFrame, n: int) -> DataFrame:
    """The first n sequences of each species, in the order of the file."""
    return seqs.withColumn("r", F.row_number().over(Window.partitionBy("species").orderBy("ord"))).filter(F.col("r") <= n).drop("r")


def longest_per_gene(seqs: DataFrame, n: int) -> DataFrame:
    """One sequence of each gene and strain (the longest, then the first name), then the n longest of each gene."""
    one = seqs.groupBy("gene", "strain").agg(F.min(F.struct((-F.length("seq")).alias("m"), "name", "seq")).alias("b")).select("gene", "strain", "b.name", "b.seq")
    order = Window.partitionBy("gene").orderBy(F.desc(F.length("seq")), "name")
    return one.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= n).drop("r")
