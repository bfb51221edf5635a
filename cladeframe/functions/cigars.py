"""CIGARs as array<struct<len:int,op:string>>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(cigar: Column) -> Column:
    lens = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    return F.zip_with(lens, ops, lambda n, o: F.struct(n.cast("int").alias("len"), o.alias("op")))


def text(cigar: Column) -> Column:
    return F.array_join(F.transform(cigar, lambda c: F.concat(c["len"].cast("string"), c["op"])), "")


def length_of(cigar: Column, ops: str) -> Column:
    return F.aggregate(F.filter(cigar, lambda c: c["op"].isin(*ops)), F.lit(0), lambda a, c: a + c["len"])


def reference_length(cigar: Column) -> Column:
    return length_of(cigar, "MDN=X")


def read_length(cigar: Column) -> Column:
    return length_of(cigar, "MIS=X")


def aligned_single(cigar: Column) -> Column:
    return length_of(cigar, "MIDX=")


def aligned_pair(cigar: Column) -> Column:
    """Without deletions, unlike ``aligned_single``."""
    return length_of(cigar, "MIX=")


def clip_left(cigar: Column) -> Column:
    """Soft-clipped bases before the first aligned one."""
    first = F.filter(cigar, lambda c: c["op"] != "H")
    return F.when((F.size(first) > 0) & (first[0]["op"] == "S"), first[0]["len"]).otherwise(0)


def clip_right(cigar: Column) -> Column:
    rest = F.filter(cigar, lambda c: c["op"] != "H")
    last = F.element_at(rest, -1)
    return F.when((F.size(rest) > 1) & (last["op"] == "S"), last["len"]).otherwise(0)


def inner(cigar: Column) -> Column:
    return F.filter(cigar, lambda c: ~c["op"].isin("S", "H"))


def ends_in_deletion(cigar: Column) -> Column:
    i = inner(cigar)
    return (F.size(i) > 0) & ((i[0]["op"] == "D") | (F.element_at(i, -1)["op"] == "D"))


def consecutive_indels(cigar: Column) -> Column:
    return text_ops(cigar).rlike("[ID][ID]")


def text_ops(cigar: Column) -> Column:
    return F.array_join(F.transform(cigar, lambda c: c["op"]), "")


def is_valid(cigar: Column) -> Column:
    """Positive lengths; hard clips outside soft clips, clips only at the ends, something that consumes bases between them."""
    return (F.size(cigar) > 0) & ~F.exists(cigar, lambda c: c["len"] <= 0) & text_ops(cigar).rlike("^H?S?[MIDNP=X]+S?H?$") & text_ops(cigar).rlike("[MI=X]")


def revert_soft_clips(cigar: Column) -> Column:
    """Soft clips count as matches again."""
    return F.transform(cigar, lambda c: F.struct(c["len"].alias("len"), F.when(c["op"] == "S", "M").otherwise(c["op"]).alias("op")))


def blocks(cigar: Column, pos: Column) -> Column:
    """array<struct<start, end, read_at>> of the aligned runs (M, =, X), end exclusive."""
    zero = F.struct(pos.cast("long").alias("ref"), F.lit(0).alias("read"), F.array().cast("array<struct<start:bigint,end:bigint,read_at:int>>").alias("out"))

    def step(a, c):
        on_ref, on_read = c["op"].isin(*"MDN=X"), c["op"].isin(*"MIS=X")
        run = F.array(F.struct(a["ref"].alias("start"), (a["ref"] + c["len"]).alias("end"), a["read"].alias("read_at")))
        return F.struct(
            (a["ref"] + F.when(on_ref, c["len"]).otherwise(0)).alias("ref"), (a["read"] + F.when(on_read, c["len"]).otherwise(0)).alias("read"),
            F.when(c["op"].isin("M", "=", "X"), F.concat(a["out"], run)).otherwise(a["out"]).alias("out"),
        )

    return F.aggregate(cigar, zero, step, lambda a: a["out"])
