"""Filters on aligned reads (flag, mapq, cigar, seq length, nm, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigars as C

PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 1, 2, 4, 8, 16, 32, 256, 512, 1024, 2048


def has(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def flag_filter(flag: Column, secondary: bool = False, supplementary: bool = False, improper: bool = False) -> Column:
    """True for reads to keep; each argument says whether that kind is let in."""
    out = F.lit(True)
    if not secondary:
        out = out & ~has(flag, SECONDARY)
    if not supplementary:
        out = out & ~has(flag, SUPPLEMENTARY)
    if not improper:
        out = out & has(flag, PROPER)
    return out


def passes(aligned: Column, length: Column, nm: Column, min_aligned: int, min_identity: float, min_percent: float) -> Column:
    return (aligned >= min_aligned) & (aligned / length >= min_percent) & (1.0 - nm / aligned >= min_identity)


def single_filter(reads: DataFrame, min_aligned: int, min_identity: float, min_percent: float) -> Column:
    return passes(C.aligned_single(F.col("cigar")), F.col("length"), F.col("nm"), min_aligned, min_identity, min_percent)


def filtered(reads: DataFrame, min_aligned: int = 0, min_identity: float = 0.0, min_percent: float = 0.0) -> DataFrame:
    """Rows that pass the flags and, if any threshold is set, the thresholds."""
    kept = reads.where(flag_filter(F.col("flag")))
    return kept.where(single_filter(reads, min_aligned, min_identity, min_percent)) if min_aligned > 0 or min_identity > 0 or min_percent > 0 else kept


def pair_filter(reads: DataFrame, min_aligned: int, min_identity: float, min_percent: float, keep_failing: bool = False) -> DataFrame:
    """Both mates of pairs on one contig, each pair judged on its sums. Secondary, supplementary and improper reads don't pair. (sample, tid, qname) is a pair if it has two reads."""
    w = Window.partitionBy("sample", "tid", "qname")
    d = reads.where(flag_filter(F.col("flag")))
    a, n = C.aligned_pair(F.col("cigar")), F.col("length")
    d = d.withColumn("__k", F.count("*").over(w)).withColumn("__a", F.sum(a).over(w)).withColumn("__n", F.sum(n).over(w)).withColumn("__nm", F.sum("nm").over(w))
    ok = passes(F.col("__a"), F.col("__n"), F.col("__nm"), min_aligned, min_identity, min_percent)
    return d.where((F.col("__k") == 2) & (~ok if keep_failing else ok)).drop("__k", "__a", "__n", "__nm")


def caller_filter(mapq_least: int = 20, long_length: int = 1500, long_qual: int = 20) -> Column:
    """Reads that the caller uses; needs flag, mapq, length, cigar, tid, mtid, read_type and mean_qual."""
    f, c = F.col("flag"), F.col("cigar")
    bad = has(f, UNMAPPED) | has(f, SECONDARY) | has(f, DUPLICATE) | has(f, QC_FAIL) | (F.col("mapq") < mapq_least) | (F.col("mapq") == 255)
    bad = bad | (F.col("length") < 30) | (C.read_length(c) != F.col("length")) | F.exists(c, lambda x: x["op"] == "N") | C.consecutive_indels(c) | C.ends_in_deletion(c) | ~C.is_valid(c)
    return ~bad & ((F.col("read_type") != "Long") | ((F.col("length") >= long_length) & (F.floor("mean_qual") >= long_qual)))


def before_genotyping(mapq_least: int = 20, length_least: int = 10) -> Column:
    return (F.col("unclipped") >= length_least) & (F.col("mapq") >= mapq_least) & (~has(F.col("flag"), PAIRED) | has(F.col("flag"), MATE_UNMAPPED) | (F.col("mtid") == F.col("tid")))


def mates(reads: DataFrame) -> DataFrame:
    """Pairs (left, right) of reads by (sample, qname): first mate and second."""
    a = reads.where("mate = 1").select("sample", "qname", F.col("start").alias("start1"), F.col("end").alias("end1"))
    b = reads.where("mate = 2").select("sample", "qname", F.col("start").alias("start2"), F.col("end").alias("end2"))
    return a.join(b, ["sample", "qname"])


def cap_overlap(a: Column, b: Column, qa: Column, qb: Column, cap: int) -> Column:
    """Qualities of two mates where they overlap: capped where bases agree, 0 where not."""
    return F.when(a == b, F.struct(F.least(qa, F.lit(cap)).alias("q1"), F.least(qb, F.lit(cap)).alias("q2"))).otherwise(F.struct(F.lit(0).alias("q1"), F.lit(0).alias("q2")))
