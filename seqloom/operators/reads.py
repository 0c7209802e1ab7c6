"""Read-level operators: demultiplexing, tagging, trimming and selection.

Reads are rows (file_prefix, ord, read_id, comment, r1_seq, r1_qual, r2_seq, r2_qual[, index_seq]).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import bases
from seqloom.functions.protocols import Protocol
from seqloom.operators.matching import text_containing

AMBIGUOUS, NO_MATCH = "ambiguous", "no_match"
#: Any base that no barcode has counts as this one: it differs from all of theirs.
OTHER = "?"


def _neighbours(seq: str, alphabet: str, distance: int) -> dict[str, int]:
    """All words within a Hamming distance, with their distance."""
    found = {seq: 0}
    ring = {seq}
    for d in range(1, distance + 1):
        ring = {w[:i] + b + w[i + 1 :] for w in ring for i in range(len(w)) for b in alphabet} - found.keys()
        found |= dict.fromkeys(ring, d)
    return found


def barcode_list(barcodes: DataFrame) -> dict[str, str]:
    """Sequence -> name of a kit's barcodes, collected once; of names that share a sequence the first in order."""
    return {r["bc_seq"]: r["bc_name"] for r in barcodes.groupBy("bc_seq").agg(F.min("bc_name").alias("bc_name")).collect()}


def barcode_neighbourhood(barcodes: DataFrame, p: Protocol, max_mismatch: int = 1, keep_last: bool = False, most: int = 2_000_000, known: dict[str, str] | None = None) -> DataFrame:
    """(slice, barcode, distance) for every slice within reach of a barcode: the unique nearest one,
    or ``ambiguous`` where several are nearest.

    The barcode list is small by nature; the table's size is checked against ``most`` before use. ``known`` is
    the list as ``barcode_list`` gives it, if the caller has it.
    """
    width = p.size - (p.ignores_last and not keep_last)
    listed: dict[str, list[str]] = {}
    for seq, name in (barcode_list(barcodes) if known is None else known).items():
        listed.setdefault(seq[:width], []).append(name)
    alphabet = "".join(sorted({b for s in listed for b in s})) + OTHER
    reach = sum((width * len(alphabet)) ** d for d in range(max_mismatch + 1)) * len(listed)
    if reach > most:
        raise ValueError(f"{len(listed)} barcodes within {max_mismatch} mismatches reach up to {reach} slices; raise `most` or lower the mismatches")
    nearest: dict[str, tuple[int, list[str]]] = {}
    for seq, names in listed.items():
        for word, d in _neighbours(seq, alphabet, max_mismatch).items():
            known = nearest.get(word)
            if known is None or d < known[0]:
                nearest[word] = (d, list(names))
            elif d == known[0]:
                known[1].extend(names)
    rows = [(w, names[0] if len(names) == 1 else AMBIGUOUS, d) for w, (d, names) in nearest.items()]
    return barcodes.sparkSession.createDataFrame(rows, "slice string, barcode string, distance int")


def normalised_slice(seq: Column, p: Protocol, known: str, keep_last: bool = False) -> Column:
    """The slice with every base that no barcode has replaced by ``OTHER``."""
    return F.regexp_replace(bases.barcode_slice(seq, p, keep_last), f"[^{known}]", OTHER)


def assign_barcode(reads: DataFrame, barcodes: DataFrame, p: Protocol, max_mismatch: int = 1, keep_last: bool = False, seq: str = "r1_seq") -> DataFrame:
    """``reads`` with barcode and distance.

    The barcodes' neighbourhood is broadcast and met by an equi-join on the slice, so reads are
    neither compared one by one nor shuffled. A read that is too short has no match.
    """
    listed = barcode_list(barcodes)
    known = "".join(sorted({b for seq in listed for b in seq}))
    table = barcode_neighbourhood(barcodes, p, max_mismatch, keep_last, known=listed)
    keyed = reads.withColumn("slice", normalised_slice(F.col(seq), p, known, keep_last))
    joined = keyed.join(F.broadcast(table), "slice", "left").drop("slice")
    return joined.withColumn("barcode", F.coalesce("barcode", F.lit(NO_MATCH)))


def trim_barcode(reads: DataFrame, p: Protocol) -> DataFrame:
    """P2."""
    return reads.withColumns({"r1_seq": bases.trimmed(F.col("r1_seq"), p), "r1_qual": bases.trimmed(F.col("r1_qual"), p)})


def _cut_ends(text: Column, n5: int, n3: int) -> Column:
    return text.substr(F.lit(n5 + 1), F.length(text) - n5 - n3)


def trim_ends(reads: DataFrame, n5: int = 0, n3: int = 0) -> DataFrame:
    """P7 on (seq, qual): empty reads, reads that n5 uses up and reads shorter than both cuts go; one that n3 just empties stays."""
    n = F.length("seq")
    kept = reads.filter((n > n5) & (n >= n5 + n3))
    return kept.withColumns({c: _cut_ends(F.col(c), n5, n3) for c in ("seq", "qual")})


def keep_5p(reads: DataFrame, n: int) -> DataFrame:
    """The first n bases; reads with fewer go."""
    return reads.filter((F.length("seq") >= n) & F.lit(n > 0)).withColumns({c: F.substring(c, 1, n) for c in ("seq", "qual")})


def keep_3p(reads: DataFrame, n: int) -> DataFrame:
    """The last n bases; reads with fewer go."""
    return reads.filter((F.length("seq") >= n) & F.lit(n > 0)).withColumns({c: F.right(c, F.lit(n)) for c in ("seq", "qual")})


def trim_polya(reads: DataFrame, max_a: int = 7, min_len: int = 20) -> DataFrame:
    """P9 on (read_id, seq, qual): the name tells where the cut is."""
    end, n = bases.polya_end(F.col("seq"), max_a), F.length("seq")
    cut = reads.withColumns({"_end": end, "_n": n}).filter(F.col("_end") >= min_len)
    cut = cut.withColumn("_tag", F.when(F.col("_end") < F.col("_n"), F.concat(F.lit(":trimmed_"), F.col("_end") + 1, F.lit("_"), F.col("_n") - F.col("_end"))).otherwise(":untrimmed_0_0"))
    out = cut.withColumns({"read_id": F.concat("read_id", "_tag"), "seq": F.substring("seq", F.lit(1), F.col("_end")), "qual": F.substring("qual", F.lit(1), F.col("_end"))})
    return out.drop("_end", "_n", "_tag")


def tag_umi(reads: DataFrame, p: Protocol) -> DataFrame:
    """The UMI in the second mate's name."""
    return reads.withColumn("r2_name", bases.tag_umi(F.col("r2_name"), F.col("r1_seq"), p))


def tag_umi_both(reads: DataFrame, size: int = 8) -> DataFrame:
    """The UMI in both mates' names."""
    return reads.withColumns({c: bases.tag_umi_before_blanks(F.col(c), F.col("r1_seq"), size) for c in ("r1_name", "r2_name")})


def tag_index(reads: DataFrame, names: tuple[str, ...] = ("r1_name", "r2_name", "index_name")) -> DataFrame:
    """P5: the raw index sequence at the end of all names."""
    return reads.withColumns({c: F.concat(F.col(c), F.col("index_seq")) for c in names})


def limit_reads(reads: DataFrame, n: int) -> DataFrame:
    """The first n reads of every file."""
    return reads.filter(F.col("ord") < n)


def base_dominance(reads: DataFrame, pct: float = 80.0, most: int | None = None, seq: str = "seq") -> DataFrame:
    """Per base, the share of reads of which it makes up more than ``pct`` percent."""
    looked = limit_reads(reads, most) if most is not None else reads
    n = F.length(seq)
    shares = [F.avg(F.when((n - F.length(F.replace(F.col(seq), F.lit(b), F.lit("")))) * 100 > n * pct, 100.0).otherwise(0.0)).alias(b) for b in "ACGT"]
    wide = looked.filter(n > 0).agg(*shares)
    return wide.unpivot([], list("ACGT"), "base", "pcnt")


def amplicon_motif_counts(pairs: DataFrame, bc_pairs: DataFrame, motifs: list[str], head: int = 100) -> DataFrame:
    """Per sample and well, the reads and those with any motif.

    ``bc_pairs`` is (well, bc1, bc2). The beginnings of first mates are cut into all windows of the shortest
    first barcode's length, which meet the barcodes that begin so by equi-join; both barcodes are looked for
    in full after that.
    """
    first, second = F.substring("r1_seq", 1, head), F.substring("r2_seq", 1, head)
    any_motif = F.greatest(F.lit(0), *[F.when(F.contains("r1_seq", F.lit(m)) | F.contains("r2_seq", F.lit(m)), 1).otherwise(0) for m in motifs])
    looked = pairs.select("sample_id", first.alias("_first"), second.alias("_second"), any_motif.alias("_motif"))
    met = text_containing(looked, "_first", bc_pairs, "bc1").filter(F.contains("_second", F.col("bc2")))
    out = met.groupBy("sample_id", "well").agg(F.count(F.lit(1)).alias("reads"), F.sum("_motif").alias("with_motif"))
    return out.withColumn("pcnt", F.round(100 * F.col("with_motif") / F.col("reads"), 4))


def mark_pairs(aln: DataFrame, mode: str) -> DataFrame:
    """Alignments with a column ``keep``, the same for the mates of a pair (sample_id, qname).

    concordant: both mates or neither are mapped; any_mapped: at least one is; nondup: neither has
    the duplicate bit. Alignments are read, shuffled and sorted once; those without a sample or name go.
    """
    from pyspark.sql import Window

    flag, keys = F.col("flag"), ["sample_id", "qname"]
    pair = Window.partitionBy(*keys)
    any_off, all_off = (f(bases.has_bit(flag, 4)).over(pair) for f in (F.max, F.min))
    keep = {"concordant": any_off == all_off, "any_mapped": ~all_off, "nondup": ~F.max(bases.has_bit(flag, 1024)).over(pair)}[mode]
    return aln.dropna(subset=keys).withColumn("keep", keep).filter("keep is not null")


def split_pairs(aln: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Alignments of pairs to keep and the rest, by ``mark_pairs``."""
    marked = mark_pairs(aln, mode)
    return marked.filter("keep").drop("keep"), marked.filter("not keep").drop("keep")


def unmap_broken_pairs(aln: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All pairs, those with one mate mapped rewritten as unmapped; and the originals of these."""
    marked = mark_pairs(aln, "concordant")
    first = bases.has_bit(F.col("flag"), 64)
    as_off = {
        "flag": F.when(first, 77).otherwise(141),
        "rname": F.lit("*"),
        "pos": F.lit(0),
        "mapq": F.lit(0),
        "cigar": F.lit("*"),
        "rnext": F.lit("*"),
        "pnext": F.lit(0),
        "tlen": F.lit(0),
    }
    every = marked.withColumns({c: F.when(F.col("keep"), F.col(c)).otherwise(v.cast(aln.schema[c].dataType)) for c, v in as_off.items() if c in aln.columns})
    return every.drop("keep"), marked.filter("not keep").drop("keep")


def unaligned_reads(aln: DataFrame, n: int) -> DataFrame:
    """FASTA lines of the first n unmapped reads of each sample, by name.

    A hash threshold is not needed: the window's top n per sample are cut in each partition first.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("sample_id").orderBy("qname", "flag")
    top = aln.filter(bases.has_bit(F.col("flag"), 4)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return top.select("sample_id", "rank", F.concat(F.lit(">"), "qname").alias("header"), "seq")


def select_fasta(seqs: DataFrame, pattern: str) -> DataFrame:
    """P17 by a regular expression on headers."""
    return seqs.filter(F.col("name").rlike(pattern))


# Lengths that a whole ribosomal RNA gene may have.
RRNA_BANDS = (("23S", 2000, 3000), ("16S", 1000, 2000), ("5S", 100, 200))


def select_rrna(seqs: DataFrame, bands=RRNA_BANDS) -> DataFrame:
    """P17 by gene: sequences of a gene's length band without unknown stretches."""
    n = F.length("seq")
    fits = F.lit(False)
    for gene, low, high in bands:
        fits |= (F.col("gene") == gene) & n.between(low, high)
    return seqs.filter(fits & ~F.contains("seq", F.lit("NN")))


CHROMOSOMES = [*map(str, range(1, 23)), "X", "Y", "MT", ""]


def filter_chromosomes(tmap: DataFrame, column: str = "header") -> tuple[DataFrame, DataFrame]:
    """Rows on whole chromosomes (fourth ``:`` part; headers with fewer parts stay), and the rest."""
    parts = F.split(F.col(column), ":")
    keep = (F.size(parts) < 4) | F.get(parts, F.lit(3)).isin(CHROMOSOMES)
    return tmap.filter(keep), tmap.filter(~keep)


def parse_transcript_headers(headers: DataFrame, column: str = "header") -> tuple[DataFrame, DataFrame]:
    """Packed (transcript, gene) keys of FASTA headers, and the headers of patch contigs.

    A full header is ``>id type chromosome:build:place gene:g gene_biotype:b transcript_biotype:t
    gene_symbol:s`` and gives ``id:type:t:place`` and ``g:type:s:b:strand``, the strand being the
    place's last part. One without gene_symbol gives ``id:(words in brackets)`` for both, the id
    without its version.
    """
    h = F.col(column)
    patched = h.rlike(r"(?i)CHR_\S+_PATCH")
    full = r"^>(\S+)\s+(\S+)\s+(\S+)\s+gene:(\S+)\s+gene_biotype:(\S+)\s+transcript_biotype:(\S+)\s+gene_symbol:(\S+)"
    name, kind, place, gene, bio, tbio, symbol = (F.regexp_extract(h, full, k) for k in range(1, 8))
    place = F.regexp_replace(place, r"^\S+?:\S+?:", "")
    short = F.concat_ws(":", F.regexp_extract(h, r"^>(\S+?)\..*\((\S+)\)", 1), F.regexp_extract(h, r"^>(\S+?)\..*\((\S+)\)", 2))
    is_full = F.contains(h, F.lit("gene_symbol"))
    keys = headers.filter(~patched).select(
        F.when(is_full, F.concat_ws(":", name, kind, tbio, place)).otherwise(short).alias("transcript"),
        F.when(is_full, F.concat_ws(":", gene, kind, symbol, bio, F.element_at(F.split(place, ":"), -1))).otherwise(short).alias("gene"),
    )
    return keys, headers.filter(patched)
