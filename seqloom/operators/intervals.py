"""Interval operators: feature tables, fractional overlap counts, coverage and profiles.

Intervals are (acc, start_pos, end_pos) with inclusive ends, 1-based.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Genome bins of coverage.
BIN = 1 << 14
#: Bins of range joins by level; the last level is one bin, the whole accession.
LEVELS = (1 << 14, 1 << 18, 1 << 22, 1 << 26)
#: Least bits of the bins in which a fragment finds all its features.
NEAR_BITS = 10

# Types that win over others at one place, by what they are called there.
PRIORITY = {"CDS": "CDS", "tRNA": "tRNA", "rRNA": "rRNA", "miscRNA": "ncRNA", "misc_RNA": "ncRNA", "ncRNA": "ncRNA", "tmRNA": "ncRNA"}


def _ranked(t: Column) -> Column:
    out = None
    for name, called in PRIORITY.items():
        out = F.when(t == name, called) if out is None else out.when(t == name, called)
    return out


def merge_features(gff: DataFrame, add5: int = 0, add3: int = 0, extend_rna: bool = False) -> DataFrame:
    """One feature for each (acc, start, end, strand) of ``gff`` (acc, line_no, type, start_pos,
    end_pos, strand, locus, gene, prod, id, name).

    Types are folded in file order: of two, the later one with priority wins, else the later one.
    Attribute lists are joined by commas, ``-`` if there is none. CDS (with ``extend_rna`` also rRNA
    and ncRNA) are extended by add5 and add3 along their strand; a negative start becomes 1.
    """
    row = F.struct("line_no", "type", "locus", "gene", "prod", "id", "name")
    grouped = gff.groupBy("acc", "start_pos", "end_pos", "strand").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    types = F.transform("rows", lambda r: r["type"])
    folded = F.aggregate(F.slice(types, 2, F.greatest(F.size(types) - 1, F.lit(0))), types[0], lambda one, two: F.coalesce(_ranked(two), _ranked(one), two))

    def listing(field: str) -> Column:
        found = F.filter(F.transform("rows", lambda r: r[field]), lambda x: x.isNotNull() & (x != ""))
        return F.when(F.size(found) == 0, "-").otherwise(F.array_join(found, ","))

    out = grouped.withColumn("type", folded)
    shown = F.when(F.col("type").isin("transcript", "tmRNA"), "ncRNA").otherwise(F.col("type"))
    length = F.col("end_pos") - F.col("start_pos")
    out = out.withColumn("full_tag", F.concat_ws(":", shown, *[listing(f) for f in ("locus", "gene", "prod", "id", "name")], "strand", length.cast("string")))
    grows = F.col("type").isin("CDS", "rRNA", "ncRNA") if extend_rna else F.col("type") == "CDS"
    plus = F.col("strand") == "+"
    start = F.when(grows, F.col("start_pos") - F.when(plus, add5).otherwise(add3)).otherwise(F.col("start_pos"))
    end = F.when(grows, F.col("end_pos") + F.when(plus, add3).otherwise(add5)).otherwise(F.col("end_pos"))
    kind = F.when(F.col("type") == "tmRNA", "ncRNA").otherwise(F.col("type"))
    return out.select("acc", F.when(grows & (start < 0), 1).otherwise(start).alias("start_pos"), end.alias("end_pos"), "strand", kind.alias("type"), "full_tag")


def intergenic_regions(features: DataFrame) -> DataFrame:
    """Gaps before each feature in start order, counted from the end of the row before (not the
    furthest end), the first from 1; strand +, tag ``IGR:(left/right):+:length``."""
    order = Window.partitionBy("acc").orderBy("start_pos", "end_pos", "full_tag")
    left = F.coalesce(F.lag(F.col("end_pos") + 1).over(order), F.lit(1))
    left_tag = F.coalesce(F.lag("full_tag").over(order), F.lit("ORIGIN"))
    gaps = features.select("acc", left.alias("start_pos"), F.greatest(F.col("start_pos") - 1, F.lit(0)).alias("end_pos"), left_tag.alias("l"), F.col("full_tag").alias("r"))
    tag = F.concat(F.lit("IGR:("), F.translate("l", ":", ","), F.lit("/"), F.translate("r", ":", ","), F.lit("):+:"), F.col("end_pos") - F.col("start_pos"))
    return gaps.filter("start_pos < end_pos").select("acc", "start_pos", "end_pos", F.lit("+").alias("strand"), F.lit("IGR").alias("type"), tag.alias("full_tag"))


def feature_table(features: DataFrame, igr: DataFrame) -> DataFrame:
    """Both, sorted within each accession's partition, the kind set to ``feature``."""
    both = features.unionByName(igr).withColumn("kind", F.lit("feature"))
    return both.repartition("acc").sortWithinPartitions("acc", "start_pos", "end_pos")


def dedupe_feature_types(gff: DataFrame) -> DataFrame:
    """I4: one row per place: gene and exon yield to other types, pseudogene beats CDS, tags are joined by ``;``."""
    row = F.struct("line_no", "type", "tag")
    grouped = gff.groupBy("acc", "start_pos", "end_pos", "strand").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    types = F.transform("rows", lambda r: r["type"])

    def fold(one: Column, two: Column) -> Column:
        return F.when(one == "gene", two).when(((one == "pseudogene") & (two == "CDS")) | ((one == "CDS") & (two == "pseudogene")), "pseudogene").otherwise(one)

    folded = F.aggregate(F.slice(types, 2, F.greatest(F.size(types) - 1, F.lit(0))), types[0], fold)
    return grouped.select("acc", "start_pos", "end_pos", "strand", folded.alias("type"), F.array_join(F.transform("rows", lambda r: r["tag"]), ";").alias("tag"))


def bin_level(start: str, end: str) -> Column:
    """The first level whose bins are as long as the interval, which so touches one or two of them."""
    out = F.lit(len(LEVELS))
    for k, size in reversed(list(enumerate(LEVELS))):
        out = F.when(F.col(end) - F.col(start) < size, F.lit(k)).otherwise(out)
    return out


def _bins(start: str, end: str, wanted: Column, way: int) -> Column:
    """The bins that an interval touches on the levels that ``wanted`` is true of, as (way, level, bin); ``wanted`` takes a level."""
    at = [(k, F.floor(F.col(start) / size), F.floor(F.greatest(start, end) / size)) for k, size in enumerate(LEVELS)] + [(len(LEVELS), F.lit(0).cast("long"), F.lit(0).cast("long"))]
    none = F.array().cast("array<struct<way:int,level:int,bin:bigint>>")

    def of(k: int, low: Column, high: Column) -> Column:
        return F.transform(F.sequence(low, high), lambda b: F.struct(F.lit(way).alias("way"), F.lit(k).alias("level"), b.alias("bin")))

    return F.concat(*[F.when(wanted(F.lit(k)), of(k, low, high)).otherwise(none) for k, low, high in at])


def overlapping(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of rows of ``left`` (acc, start_pos, end_pos, ...) and ``right`` (acc, f_start, f_end, ...)
    that overlap.

    Bins are of five lengths, up to the whole accession. An interval's own level is the first whose bins are as long as it
    is; two intervals meet on the higher of their own levels, by equi-join on the bins that they
    touch: way 0, where that is the right one's level, way 1, where it is the left one's and higher. They are
    paired in the first bin that they share. An interval of any length is so listed twice a level and
    way at most. Levels of which an accession has no interval on the right side are passed over, so
    that fragments over usual genes are listed once or twice in all. Both sides are shuffled by bins, also
    a short annotation: a file of few bytes a row is listed in some hundred bytes a row and level, which Spark's size
    check does not see, and the driver would hold the list. Spark may split the bins on which fragments pile up.
    """
    own = F.col("_own")
    placed = right.withColumn("_own", bin_level("f_start", "f_end"))
    used = placed.groupBy("acc").agg(F.collect_set("_own").alias("_used"))
    listed = placed.withColumn("_at", F.explode(F.concat(_bins("f_start", "f_end", lambda k: k == own, 0), _bins("f_start", "f_end", lambda k: k > own, 1)))).drop("_own")
    probes = left.join(used, "acc").withColumn("_own", bin_level("start_pos", "end_pos"))
    ways = F.concat(_bins("start_pos", "end_pos", lambda k: (k >= own) & F.array_contains("_used", k), 0), _bins("start_pos", "end_pos", lambda k: (k == own) & (own > F.array_min("_used")), 1))
    met = probes.withColumn("_at", F.explode(ways)).drop("_own", "_used").join(listed.hint("merge"), ["acc", "_at"])
    begin = F.greatest("start_pos", "f_start")
    first = F.lit(0).cast("long")
    for k, size in enumerate(LEVELS):
        first = F.when(F.col("_at.level") == k, F.floor(begin / size)).otherwise(first)
    return met.filter((F.col("_at.bin") == first) & (F.least("end_pos", "f_end") >= begin)).drop("_at")


def count_features(frags: DataFrame, features: DataFrame, min_frag_len: int = 10, paired_only: bool = False) -> DataFrame:
    """(sample_id, acc, name, sense, antisense): every fragment counts one in all, shared among the
    features that it overlaps, on either strand, in proportion to the overlap (ends apart: 0).

    Fragments at one place are counted together first (counts are linear), so stacks of reads on a
    ribosomal gene cost one row, and the shares are taken within such a place.
    """
    kept = frags.filter(F.col("end_pos") - F.col("start_pos") >= min_frag_len)
    if paired_only:
        kept = kept.filter("paired")
    place = ["sample_id", "acc", "start_pos", "end_pos", "strand"]
    stacks = kept.groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
    right = features.select("acc", F.col("start_pos").alias("f_start"), F.col("end_pos").alias("f_end"), F.col("strand").alias("f_strand"), "name")
    hits = overlapping(stacks, right).withColumn("ov", (F.least("end_pos", "f_end") - F.greatest("start_pos", "f_start")).cast("double")).filter("ov > 0")
    share = F.col("ov") / F.sum("ov").over(Window.partitionBy(*place)) * F.col("n")
    shared = hits.withColumn("share", share)
    same = F.col("strand") == F.col("f_strand")
    sums = shared.groupBy("sample_id", "acc", "name").agg(F.sum(F.when(same, F.col("share")).otherwise(0.0)).alias("sense"), F.sum(F.when(~same, F.col("share")).otherwise(0.0)).alias("antisense"))
    return sums


def near_bits(features: DataFrame) -> DataFrame:
    """(acc, _bits): the bits of the bins of an accession, which are as long as its ``features`` (acc, f_start, f_end) on average and 1,024 at least."""
    bits = F.greatest(F.lit(NEAR_BITS), F.ceil(F.log2(F.avg(F.col("f_end") - F.col("f_start")))))
    return features.groupBy("acc").agg(bits.cast("int").alias("_bits"))


def feature_shares(frags: DataFrame, features: DataFrame, min_frag_len: int = 10, whole: bool = False) -> DataFrame:
    """``frags`` (acc, start_pos, end_pos, ...), once for each feature that they overlap, with its ``name`` and ``share``, as
    ``count_features`` takes it; rows of equal fragments may be put together and their shares added.
    With ``whole``, each fragment also has a row of share 1 whose acc and name are null, also those that are too short, and a column ``whole`` says which these are.

    A fragment goes to the bin in which it starts, where all features that it may overlap are listed, so one shuffle of
    fragments brings both together. Bins of an accession are as long as its features are on average, and 1,024 at
    least: a feature is listed some three times or less on average, and a list is no longer than what lies in three
    bins, or some four times as long as what fragments overlap on average. Fragments that are longer than a bin meet features by ``overlapping``.
    """
    own = frags.columns
    right = features.select("acc", F.col("start_pos").cast("long").alias("f_start"), F.col("end_pos").cast("long").alias("f_end"), "name").filter("f_end > f_start")
    bins = F.broadcast(near_bits(right))  # one row per reference
    at = F.explode(F.expr("sequence(shiftright(f_start, _bits) - 1, shiftright(f_end, _bits))"))
    listed = right.join(bins, "acc").withColumn("_bin", at).groupBy("acc", "_bin").agg(F.collect_list(F.struct("f_start", "f_end", "name")).alias("_near"))
    length = F.col("end_pos") - F.col("start_pos")
    long_ = F.expr("end_pos - start_pos >= shiftleft(1L, _bits)")
    kept = frags if whole else frags.filter(length >= min_frag_len)
    placed = kept.join(bins, "acc", "left" if whole else "inner").withColumn("_bin", F.expr(f"shiftright(cast(start_pos as bigint), coalesce(_bits, {NEAR_BITS}))"))
    placed = (placed if whole else placed.filter(~long_)).withColumn("_found", (length >= min_frag_len) & ~long_).drop("_bits")
    met = placed.join(listed.hint("shuffle_hash"), ["acc", "_bin"], "left" if whole else "inner")

    def overlap(start: Column, end: Column) -> Column:
        return F.least(F.col("end_pos"), end) - F.greatest(F.col("start_pos"), start)

    total = F.aggregate("_near", F.lit(0).cast("long"), lambda sum_, x: sum_ + F.greatest(overlap(x["f_start"], x["f_end"]), F.lit(0)))
    ov, nothing = overlap(F.col("f_start"), F.col("f_end")), F.array().cast(listed.schema["_near"].dataType)
    if whole:
        mark = F.array(F.struct(F.lit(None).cast("long").alias("f_start"), F.lit(None).cast("long").alias("f_end"), F.lit(None).cast(features.schema["name"].dataType).alias("name")))
        near = F.concat(mark, F.coalesce(F.when(F.col("_found"), F.col("_near")), nothing))
        hits = met.withColumn("_total", total).select(*own, "_total", F.inline(near)).withColumn("whole", F.col("f_start").isNull()).filter((ov > 0) | F.col("whole"))
        acc, share = F.when(~F.col("whole"), F.col("acc")).alias("acc"), F.when(F.col("whole"), 1.0).otherwise(ov.cast("double") / F.col("_total"))
    else:
        hits = met.withColumn("_total", total).select(*own, "_total", F.inline("_near")).filter(ov > 0)
        acc, share = F.col("acc"), ov.cast("double") / F.col("_total")
    flag = ["whole"] if whole else []
    near_hits = hits.select(*[acc if c == "acc" else F.col(c) for c in own], "name", share.alias("share"), *flag)
    # few or none: asked of the fragments alone first, before all that was worked out for them
    far = frags.filter((length >= 1 << NEAR_BITS) & (length >= min_frag_len)).join(bins, "acc").filter(long_).groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
    far_met = overlapping(far, right).withColumn("ov", ov.cast("double")).filter("ov > 0")
    far_share = F.col("ov") / F.sum("ov").over(Window.partitionBy(*own)) * F.col("_n")
    return near_hits.unionByName(far_met.select(*own, "name", far_share.alias("share"), *[F.lit(False).alias(c) for c in flag]))


def feature_counts_output(counts: DataFrame) -> DataFrame:
    """Rounded counts by ``tag:acc``, antisense ones under ``AS_``."""
    rows = F.array(F.struct(F.concat_ws(":", "name", "acc").alias("feature"), F.bround("sense").cast("long").alias("n")), F.struct(F.concat(F.lit("AS_"), F.concat_ws(":", "name", "acc")).alias("feature"), F.bround("antisense").cast("long").alias("n")))
    return counts.select("sample_id", "acc", F.explode(rows).alias("r")).select("sample_id", "r.feature", "acc", "r.n")


def replicon_totals(counts: DataFrame) -> DataFrame:
    """Sense plus antisense per accession, unrounded."""
    return counts.groupBy("sample_id", "acc").agg(F.sum(F.col("sense") + F.col("antisense")).alias("total"))


def coverage(frags: DataFrame, size: int = BIN) -> DataFrame:
    """I8: (sample_id, acc, start_pos, end_pos, plus, minus): runs of positions with one depth by strand.

    Starts and ends are +1 and -1 events, summed by position. Running sums are taken within genome
    bins, on top of the depth that a much shorter table of bins carries over, so an accession of any
    length is spread over tasks. Uncovered runs are left out.
    """
    plus, minus = (F.when(F.col("strand") == s, 1).otherwise(0) for s in "+-")
    ends = F.array(F.struct(F.col("start_pos").alias("p"), F.lit(1).alias("d")), F.struct((F.col("end_pos") + 1).alias("p"), F.lit(-1).alias("d")))
    own = frags.filter("start_pos > 0 and end_pos > 0 and strand in ('+', '-')").select("sample_id", "acc", plus.alias("x"), minus.alias("y"), F.explode(ends).alias("e"))
    events = own.groupBy("sample_id", "acc", F.col("e.p").cast("long").alias("pos")).agg(F.sum(F.col("e.d") * F.col("x")).alias("dx"), F.sum(F.col("e.d") * F.col("y")).alias("dy"))
    # without nulls on either side of the join, so that Spark adds no condition to one side only and reads and shuffles both as one
    events = events.dropna(subset=["sample_id", "acc", "pos"]).withColumn("bin", F.coalesce(F.floor(F.col("pos") / size), F.lit(0)))
    bins = events.groupBy("sample_id", "acc", "bin").agg(F.sum("dx").alias("bx"), F.sum("dy").alias("by"), F.min("pos").alias("first"))
    over = Window.partitionBy("sample_id", "acc").orderBy("bin")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.select("sample_id", "acc", "bin", F.coalesce(F.sum("bx").over(before), F.lit(0)).alias("cx"), F.coalesce(F.sum("by").over(before), F.lit(0)).alias("cy"), F.lead("first").over(over).alias("following"))
    within = Window.partitionBy("sample_id", "acc", "bin").orderBy("pos")
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    runs = events.join(carried, ["sample_id", "acc", "bin"]).select(
        "sample_id", "acc", F.col("pos").alias("start_pos"), (F.coalesce(F.lead("pos").over(within), F.col("following")) - 1).alias("end_pos"), (F.sum("dx").over(running) + F.col("cx")).alias("plus"), (F.sum("dy").over(running) + F.col("cy")).alias("minus")
    )
    return runs.filter("plus > 0 or minus > 0")


def dense_coverage(runs: DataFrame) -> DataFrame:
    """Coverage runs as one row per covered position."""
    return runs.select("sample_id", "acc", F.explode(F.sequence("start_pos", "end_pos")).alias("pos"), "plus", "minus")


def smoothed_coverage(runs: DataFrame, window: int, stranded: bool = True, size: int = BIN) -> DataFrame:
    """I8: the mean depth of the ``window`` positions around each position with coverage in reach.

    Runs are cut at bins, which carry copies of what lies within reach of their edges, so each bin is
    smoothed on its own, in numpy, by differences of running sums. The minus strand is shown negative,
    or added to the plus strand if not ``stranded``.
    """
    half = window // 2
    before, after = (half, half - 1) if window > 1 else (0, 0)  # positions in reach of each

    def smooth(key: tuple, own: pa.Table) -> pa.Table:
        sample, acc, at = key[0], key[1], key[2].as_py()
        low = at * size - before
        places = size + before + after
        a, b = np.clip(own["start_pos"].to_numpy() - low, 0, places), np.clip(own["end_pos"].to_numpy() + 1 - low, 0, places)

        def around(depth) -> np.ndarray:
            steps = np.zeros(places + 1, np.int64)
            np.add.at(steps, a, depth)
            np.add.at(steps, b, -np.asarray(depth))
            sums = np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]))])
            return sums[before + after + 1 :] - sums[: len(sums) - before - after - 1]

        reached = np.nonzero(around(np.ones(len(own), np.int64)))[0]
        means = [around(own[c].to_numpy().astype(np.int64))[reached] / (before + after + 1) for c in ("plus", "minus")]
        named = [pa.repeat(x, len(reached)) for x in (sample, acc)]  # strings that numpy never sees
        return pa.table([*named, pa.array(at * size + reached), *map(pa.array, means)], ["sample_id", "acc", "pos", "plus", "minus"])

    reach = F.explode(F.sequence(F.floor((F.col("start_pos") - after) / size), F.floor((F.col("end_pos") + before) / size))).alias("bin")
    mean = runs.select("sample_id", "acc", "start_pos", "end_pos", "plus", "minus", reach).groupBy("sample_id", "acc", "bin").applyInArrow(smooth, "sample_id string, acc string, pos long, plus double, minus double")
    if stranded:
        return mean.select("sample_id", "acc", "pos", "plus", (0 - F.col("minus")).alias("minus"))
    return mean.select("sample_id", "acc", "pos", (F.col("plus") + F.col("minus")).alias("depth"))


def gene_body_coverage(runs: DataFrame, genes: DataFrame, bins: int = 20, add5: int = 0, add3: int = 0) -> DataFrame:
    """(sample_id, name, len, total, bin, pcnt): the share of a gene's depth on its own strand in
    each of ``bins`` parts, from 5' to 3', for genes with any; empty parts are not listed."""
    plus = F.col("strand") == "+"
    start = F.col("start_pos") - F.when(plus, add5).otherwise(add3)
    end = F.col("end_pos") + F.when(plus, add3).otherwise(add5)
    spans = genes.select("acc", start.alias("f_start"), end.alias("f_end"), F.col("strand").alias("f_strand"), "name")
    met = overlapping(runs, spans).withColumn("depth", F.when(F.col("f_strand") == "+", F.col("plus")).otherwise(F.col("minus"))).filter("depth > 0")
    n = (F.col("f_end") - F.col("f_start") + 1).cast("long").alias("len")
    a, b = F.greatest("start_pos", "f_start"), F.least("end_pos", "f_end")
    forward = F.col("f_strand") == "+"
    low, high = F.when(forward, a - F.col("f_start")).otherwise(F.col("f_end") - b), F.when(forward, b - F.col("f_start")).otherwise(F.col("f_end") - a)
    ranked = met.select("sample_id", "name", "depth", n, low.alias("low"), high.alias("high"))
    part = F.explode(F.sequence(F.floor(F.col("low") * bins / F.col("len")), F.floor(F.col("high") * bins / F.col("len"))))
    cut = ranked.select("*", part.alias("bin")).withColumn("bin", F.col("bin").cast("int"))
    # a part holds the ranks from ceil(bin * len / bins) on
    first, following = (F.ceil((F.col("bin") + k) * F.col("len") / bins) for k in (0, 1))
    held = F.least("high", following - 1) - F.greatest("low", first) + 1
    cut = cut.withColumn("held", held).filter("held > 0")  # genes shorter than the parts leave some empty
    sums = cut.groupBy("sample_id", "name", "len", "bin").agg(F.sum(F.col("depth") * F.col("held")).alias("depth"))
    total = F.sum("depth").over(Window.partitionBy("sample_id", "name", "len"))
    return sums.withColumn("total", total).select("sample_id", "name", "len", "total", "bin", F.round(F.col("depth") / F.col("total") * 100, 6).alias("pcnt"))


def coverage_profile(gene_bins: DataFrame, min_len: int = 800, top: int = 500) -> DataFrame:
    """Per sample and part, the depth-weighted mean share over the ``top`` deepest genes that are long enough."""
    genes = gene_bins.filter(F.col("len") >= min_len).select("sample_id", "name", "total").distinct()
    rank = F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("total"), "name"))
    chosen = genes.withColumn("r", rank).filter(F.col("r") <= top)
    weight = chosen.groupBy("sample_id").agg(F.sum("total").alias("weight"))
    sums = gene_bins.join(chosen.select("sample_id", "name"), ["sample_id", "name"]).groupBy("sample_id", "bin").agg(F.sum(F.col("pcnt") * F.col("total")).alias("s"))
    return sums.join(weight, "sample_id").select("sample_id", "bin", F.round(F.col("s") / F.col("weight"), 4).alias("mean_pcnt"))


def start_site_profile(aln: DataFrame, gene_ranges: DataFrame, extend: int = 100, width: int = 25) -> DataFrame:
    """First-mate starts within reach of each gene as a share by position, and for each position
    from the first to the last but one the sum of shares of it and the ``width`` after it."""
    spans = gene_ranges.select(F.col("acc"), (F.col("start_pos") - extend + 1).alias("f_start"), (F.col("end_pos") + extend - 1).alias("f_end"), "name")
    starts = aln.filter(F.col("flag").bitwiseAND(64) != 0).select("sample_id", F.col("rname").alias("acc"), F.col("pos").alias("start_pos"), F.col("pos").alias("end_pos"))
    stacks = starts.groupBy("sample_id", "acc", "start_pos", "end_pos").agg(F.count(F.lit(1)).alias("n"))
    met = overlapping(stacks, spans).select("sample_id", "name", F.col("start_pos").cast("long").alias("pos"), "n")
    gene = Window.partitionBy("sample_id", "name")
    shares = met.select("sample_id", "name", "pos", (F.col("n") / F.sum("n").over(gene) * 100).alias("pcnt"), F.min("pos").over(gene).alias("first"), F.max("pos").over(gene).alias("last"))
    reach = shares.select("sample_id", "name", "pcnt", "last", F.explode(F.sequence(F.greatest(F.col("pos") - width, F.col("first")), F.col("pos"))).alias("pos"))
    return reach.filter("pos < last").groupBy("sample_id", "name", "pos").agg(F.round(F.sum("pcnt"), 6).alias("pcnt"))


def hits_to_coords(hits: DataFrame) -> DataFrame:
    """Hits with start above end lie on the minus strand and are turned."""
    back = F.col("sub_start") > F.col("sub_end")
    return hits.select(
        "query_seqid", F.col("sub_seqid").alias("acc"), F.least("sub_start", "sub_end").alias("start_pos"), F.greatest("sub_start", "sub_end").alias("end_pos"), F.when(back, "-").otherwise("+").alias("strand")
    )
