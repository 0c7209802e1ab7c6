"""Column expressions on bases, qualities, CIGAR strings and read names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqloom.functions.protocols import Protocol


def reverse_complement(seq: Column) -> Column:
    """P10."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def cigar_ref_len(cigar: Column) -> Column:
    """Sum of the lengths of M and D; ``*`` has none."""
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MD]"), F.lit(1))
    summed = F.coalesce(F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n.cast("long")), F.lit(0).cast("long"))
    plain = F.translate(cigar, "0123456789", "") == "M"  # most alignments are one match
    return F.when(plain, F.rtrim(cigar, F.lit("M")).try_cast("long")).otherwise(summed)


def extract_umi(name: Column) -> Column:
    """The six characters after the first ``umi_`` of a name's first word; null if there is none."""
    found = F.regexp_extract(name, r"^\S+?umi_(\w{6})", 1)
    return F.when(found != "", found)


def barcode_slice(seq: Column, p: Protocol, keep_last: bool = False) -> Column:
    """The bases that a barcode match looks at; null if the read is too short for the barcode."""
    width = p.size - (p.ignores_last and not keep_last)
    return F.when(F.length(seq) >= p.start + p.size, F.substring(seq, p.start + 1, width))


def trimmed(seq: Column, p: Protocol) -> Column:
    """The read without UMI and barcode, for protocols that cut them off."""
    return seq.substr(F.lit(p.start + p.size + 1), F.length(seq)) if p.trims else seq


def tag_umi(name: Column, r1_seq: Column, p: Protocol) -> Column:
    """``:umi_`` and the UMI before the first blank of a name."""
    umi = F.concat(F.lit(":umi_"), F.substring(r1_seq, p.umi_start + 1, p.umi_size))
    head = F.substring_index(name, " ", 1)
    return F.concat(head, umi, name.substr(F.length(head) + 1, F.length(name)))


def tag_umi_before_blanks(name: Column, r1_seq: Column, size: int = 8) -> Column:
    """``_`` and the first bases of the first mate before each blank of a name."""
    return F.replace(name, F.lit(" "), F.concat(F.lit("_"), F.substring(r1_seq, 1, size), F.lit(" ")))


def polya_end(seq: Column, max_a: int = 7) -> Column:
    """Bases left of the first run of ``max_a`` A's, without the A's right before it."""
    at = F.instr(seq, "A" * max_a)
    return F.when(at > 0, F.length(F.rtrim(seq.substr(F.lit(1), at - 1), F.lit("A")))).otherwise(F.length(F.rtrim(seq, F.lit("A"))))


def has_bit(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(bit) != 0
