"""Genomic intervals: 0-based, both ends inclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlaps(t1, s1, e1, t2, s2, e2, margin: int = 0) -> Column:
    return (t1 == t2) & (s1 <= e2 + margin) & (s2 <= e1 + margin)


def contains(t1, s1, e1, t2, s2, e2) -> Column:
    return (t1 == t2) & (s1 <= s2) & (e1 >= e2)


def within_distance(t1, s1, e1, t2, s2, e2, distance: int) -> Column:
    return overlaps(t1, s1, e1, t2, s2, e2, distance)


def size(start: Column, end: Column) -> Column:
    return end - start + 1


def expand(start: Column, end: Column, by: int, contig_length: Column) -> tuple[Column, Column]:
    """Padded and cut to the contig."""
    return F.greatest(F.lit(0), start - by), F.least(contig_length - 1, end + by)
