"""Aligned reads as a table laid out for range scans, read sets, and merged structural variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Positions of a bin by which files are cut and ordered.
BIN = 1 << 14


def write_reads(reads: DataFrame, path: str, genome: str = "genome", contig: str = "contig", start: str = "start", bin_size: int = BIN) -> None:
    """Writes reads once, a folder for each genome; files hold neighbouring bins of a contig in order, so that a range scan prunes folders, files and row groups.

    Sorting by ranges spreads a deep contig over tasks. Null genomes get a folder of their own."""
    d = reads.withColumn("__bin", F.floor(F.col(start) / bin_size))
    d.repartitionByRange(genome, contig, "__bin").sortWithinPartitions(genome, contig, "__bin", start).drop("__bin").write.mode("overwrite").partitionBy(genome).parquet(path)


def scan_reads(spark: SparkSession, path: str, contig=None, low: int | None = None, high: int | None = None, genome=None, longest: int | None = None) -> DataFrame:
    """Reads of the table that touch low..high (inclusive) of a contig. ``longest`` bounds the reads' spans on the reference and so where such reads can start."""
    d = spark.read.parquet(path)
    if genome is not None:
        d = d.where(F.col("genome") == genome)
    if contig is not None:
        d = d.where(F.col("contig") == contig)
    if high is not None:
        d = d.where(F.col("start") <= high)
    if low is not None:
        d = d.where(F.col("end") >= low)
        if longest is not None:
            d = d.where(F.col("start") >= low - longest)
    return d


def primaries(reads: DataFrame) -> DataFrame:
    """(sample, alignments, primary): a sample's alignments, and those of them that are neither secondary nor supplementary."""
    return reads.groupBy("sample").agg(F.count("*").alias("alignments"), F.count_if(F.col("flag").bitwiseAND(F.lit(256 | 2048)) == 0).alias("primary"))


def read_sets(spark: SparkSession, coupled=(), interleaved=(), single=(), read1=(), read2=(), longreads=()) -> DataFrame:
    """(sample_idx, read_type, format, path1, path2) of the given files, short sets first, in the order of the parameters. Coupled files come in pairs, read1 and read2 in equal numbers; else an error."""
    if len(coupled) % 2:
        raise ValueError(f"{len(coupled)} coupled files; they come in pairs")
    if len(read1) != len(read2):
        raise ValueError(f"{len(read1)} files of first reads and {len(read2)} of second ones")
    pairs = [*zip(coupled[::2], coupled[1::2]), *zip(read1, read2)]
    rows = [("short", "coupled", a, b) for a, b in pairs] + [("short", "interleaved", a, None) for a in interleaved] + [("short", "single", a, None) for a in single] + [("long", "single", a, None) for a in longreads]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "sample_idx int, read_type string, format string, path1 string, path2 string")


def merge_structural(variants: DataFrame, least: float = 2.0) -> DataFrame:
    """variants: (sample, contig, pos, kind, end, qual) of all samples. (contig, pos, kind, end, qual, samples): those of quality ``least`` or more, a row for each that samples share, with the best quality; null quality fails."""
    g = variants.where(F.col("qual") >= least).groupBy("contig", "pos", "kind", "end")
    return g.agg(F.max("qual").alias("qual"), F.array_sort(F.collect_set("sample")).alias("samples")).select("contig", "pos", "kind", "end", "qual", "samples")
