"""Text formats as DataFrames. Files are split and read by Spark; nothing passes through the driver but VCF headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cigars as C


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(genome, contig, description, seq, length): one row per record, genome from the file's stem. A contig named genome~contig is split."""
    return parse_fasta(spark.read.option("lineSep", ">").text(path).withColumn("stem", F.regexp_extract("_metadata.file_name", r"^(.*?)\.[^.]*$", 1)))


def parse_fasta(records: DataFrame) -> DataFrame:
    """records: (value, stem), a value being what follows a ``>``."""
    r = records.where("trim(value) != ''")
    head = F.regexp_extract("value", r"^([^\n\r]*)", 1)
    name = F.regexp_extract(head, r"^(\S*)", 1)
    seq = F.regexp_replace(F.expr("substr(value, length(regexp_extract(value, '^([^\\n\\r]*)', 1)) + 1)"), r"\s", "")
    return r.select(F.when(F.contains(name, F.lit("~")), genome_of(name)).otherwise(F.col("stem")).alias("genome"), contig_of(name).alias("contig"), F.regexp_extract(head, r"^\S*\s*(.*)$", 1).alias("description"), seq.alias("seq"), F.length(seq).cast("long").alias("length"))


def genome_of(name):
    return F.substring_index(name, "~", 1)


def contig_of(name):
    return F.coalesce(F.try_element_at(F.split(name, "~", 2), F.lit(2)), name)


def duplicate_genomes(fasta: DataFrame) -> DataFrame:
    """Contigs that one genome holds more than once."""
    return fasta.groupBy("genome", "contig").count().where("count > 1")


def concatenated(fasta: DataFrame) -> DataFrame:
    return fasta.select(F.concat_ws("~", "genome", "contig").alias("name"), "seq", "length")


def read_genome_definition(spark: SparkSession, path: str) -> DataFrame:
    """(genome, contig); rows without exactly two fields fail."""
    return spark.read.csv(path, sep="\t", schema="genome string, contig string", mode="FAILFAST")


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="name string, length long, offset long, linebases int, linewidth int", mode="FAILFAST")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment lines of SAM text; see ``parse_sam``."""
    return parse_sam(spark.read.text(path))


def parse_sam(lines: DataFrame) -> DataFrame:
    """lines: (value). Parsed CIGAR, qualities and NM; header lines are left out."""
    f = F.split("value", "\t")
    tags = F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(0)))
    nm = F.try_element_at(F.filter(tags, lambda t: F.startswith(t, F.lit("NM:i:"))), F.lit(1))
    return lines.where("value not like '@%' and value != ''").select(
        f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("contig"), (f[3].cast("long") - 1).alias("pos"), f[4].cast("int").alias("mapq"), C.parse(f[5]).alias("cigar"),
        F.when(f[6] == "=", f[2]).otherwise(f[6]).alias("mcontig"), (f[7].cast("long") - 1).alias("mpos"), f[8].cast("long").alias("tlen"), f[9].alias("seq"),
        F.transform(F.split(f[10], ""), lambda c: (F.ascii(c) - 33).cast("smallint")).alias("qual"), F.substr(nm, F.lit(6)).cast("int").alias("nm"),
    )


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 rows, starts and ends from 0, attributes as a map."""
    return parse_gff(spark.read.text(path))


def parse_gff(lines: DataFrame) -> DataFrame:
    """lines: (value); comments are left out."""
    f = F.split("value", "\t")
    names = ["seqname", "source", "type", "start", "end", "score", "strand", "frame", "attributes"]
    d = lines.where("value not like '#%' and value != ''").select(*[f[i].cast("long" if n in ("start", "end") else "string").alias(n) for i, n in enumerate(names)])
    null = lambda c: F.nullif(F.col(c), F.lit("."))
    return d.select("seqname", "source", "type", (F.col("start") - 1).alias("start"), (F.col("end") - 1).alias("end"), null("score").cast("double").alias("score"), "strand", null("frame").cast("int").alias("frame"), F.str_to_map(F.regexp_replace("attributes", ";$", ""), F.lit(";"), F.lit("=")).alias("attributes"))


def vcf_samples(spark: SparkSession, path: str) -> list[str]:
    head = spark.read.text(path).where("value like '#CHROM%'").first()
    return head[0].split("\t")[9:] if head else []


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """(contig, pos from 0, alleles, qual, log10_p_error, filters, info map, genotypes array<struct<sample, gt, ad>>). A depth list of one entry gives zeros for every allele."""
    return parse_vcf(spark.read.text(path))


def parse_vcf(lines: DataFrame) -> DataFrame:
    """lines: (value); see ``read_vcf``."""
    f = F.split("value", "\t")
    d = lines.where("value not like '#%' and value != ''").select(f.alias("f"))
    d = d.select("f", F.concat(F.array(F.col("f")[3]), F.filter(F.split(F.col("f")[4], ","), lambda a: a != ".")).alias("alleles"), F.split(F.try_element_at("f", F.lit(9)), ":").alias("keys"))

    def genotype(g, i):
        parts = F.split(g, ":")
        field = lambda k: F.try_element_at(parts, F.array_position(F.col("keys"), k).cast("int"))
        ad = F.split(field("AD"), ",")
        zeros = F.transform("alleles", lambda _: F.lit(0))
        return F.struct(i.alias("sample"), F.when(F.array_contains("keys", "GT"), field("GT")).alias("gt"), F.when(F.array_contains("keys", "AD") & (F.size(ad) > 1), F.transform(ad, lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))).otherwise(zeros).alias("ad"))

    qual = F.nullif(F.col("f")[5], F.lit(".")).cast("double")
    return d.select(
        F.col("f")[0].alias("contig"), (F.col("f")[1].cast("long") - 1).alias("pos"), "alleles", qual.alias("qual"), (qual / -10).alias("log10_p_error"), F.filter(F.split(F.col("f")[6], ";"), lambda x: x != ".").alias("filters"),
        F.str_to_map(F.col("f")[7], F.lit(";"), F.lit("=")).alias("info"), F.transform(F.slice("f", 10, F.greatest(F.size("f") - 9, F.lit(0))), genotype).alias("genotypes"),
    )


def vcf_header(samples: list[str], contigs: list[tuple[str, int]], source: str = "cladeframe") -> list[str]:
    # The INFO and FORMAT fields.
    info = [("QD", "1", "Float", "Quality by depth"), ("DP", "1", "Integer", "Depth"), ("AF", "A", "Float", "Allele frequency"), ("MQ", "R", "Integer", "Median mapping quality"), ("BQ", "R", "Integer", "Median base quality"), ("VG", "1", "Integer", "Variant group"), ("ST", ".", "Integer", "Strains"), ("QF", "1", "String", "Quality verdict")]
    fmt = [("GT", "1", "String", "Genotype"), ("PL", "G", "Integer", "Phred-scaled likelihoods"), ("AD", "R", "Integer", "Allele depths"), ("GQ", "1", "Integer", "Genotype quality"), ("DP", "1", "Integer", "Depth")]
    out = ["##fileformat=VCFv4.2", f"##source={source}", *(f"##sample=<ID={i + 1},name={s}>" for i, s in enumerate(samples)), *(f"##contig=<ID={n},length={k}>" for n, k in contigs)]
    out += [f'##INFO=<ID={a},Number={b},Type={c},Description="{d}">' for a, b, c, d in info] + [f'##FORMAT=<ID={a},Number={b},Type={c},Description="{d}">' for a, b, c, d in fmt]
    return [*out, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])]


def vcf_lines(variants: DataFrame) -> DataFrame:
    """variants: (contig, pos, alleles, qual, qd, dp, genotypes array<struct<gt, pl, ad, gq, dp>>; af, mq, bq, vg, st, qf if there) -> (contig, pos, line). A genotype without depth is missing, with GQ and DP 0."""

    def one(g):
        none = g["dp"].isNull() | g["dp"].isin(-1, 0)
        ints = lambda x: F.array_join(F.transform(x, lambda v: v.cast("string")), ",")
        return F.concat_ws(":", F.when(none, F.lit("./.")).otherwise(g["gt"]), ints(g["pl"]), ints(g["ad"]), F.when(none, F.lit("0")).otherwise(g["gq"].cast("string")), F.when(none, F.lit("0")).otherwise(g["dp"].cast("string")))

    alts = F.slice("alleles", 2, F.size("alleles"))
    listed = lambda c, how: F.array_join(F.transform(F.col(c), how), ",")
    whole, share = lambda x: x.cast("string"), lambda x: F.format_string("%.3f", x)
    # what is null or not among the columns is left out
    fields = {
        "qd": lambda: F.format_string("%.2f", "qd"), "dp": lambda: F.col("dp").cast("string"), "af": lambda: listed("af", share), "mq": lambda: listed("mq", whole), "bq": lambda: listed("bq", whole),
        "vg": lambda: F.col("vg").cast("string"), "st": lambda: listed("st", whole), "qf": lambda: F.col("qf").cast("string"),
    }
    info = F.concat_ws(";", *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c.upper()}="), value())) for c, value in fields.items() if c in variants.columns])
    return variants.select("contig", "pos", F.concat_ws("\t", "contig", (F.col("pos") + 1).cast("string"), F.lit("."), F.col("alleles")[0], F.when(F.size(alts) > 0, F.array_join(alts, ",")).otherwise("."), F.format_string("%.2f", "qual"), F.lit("."), info, F.lit("GT:PL:AD:GQ:DP"), F.array_join(F.transform("genotypes", one), "\t")).alias("line"))


def write_vcf(variants: DataFrame, path: str, samples: list[str], contigs: list[tuple[str, int]]) -> None:
    """One part for the header and range-sorted parts after it; their concatenation by name is the file."""
    spark = variants.sparkSession
    head = spark.createDataFrame([(-1, i, x) for i, x in enumerate(vcf_header(samples, contigs))], "o long, pos long, line string")
    order = spark.createDataFrame([(n, i) for i, (n, _) in enumerate(contigs)], "contig string, o long")
    body = vcf_lines(variants).join(F.broadcast(order), "contig").select("o", "pos", "line")
    head.unionByName(body).orderBy("o", "pos").select("line").write.mode("overwrite").text(path)


def fasta_lines(df: DataFrame, header, seq: str = "seq", width: int = 60) -> DataFrame:
    """(record): header and sequence in lines of ``width``."""
    return df.select(F.concat(F.lit(">"), header, F.lit("\n"), F.regexp_replace(F.regexp_replace(F.col(seq), f"(.{{{width}}})", "$1\n"), "\n$", "")).alias("record"))


def contig_chunks(contigs: DataFrame, size: int = 10_000) -> DataFrame:
    """contigs: (contig, seq) -> (contig, chunk, seq): pieces that random access reads instead of whole contigs."""
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("seq") - 1) / size).cast("int"))))
    return contigs.select("contig", at.alias("chunk"), "seq").select("contig", "chunk", F.substring(F.col("seq"), F.col("chunk") * size + 1, F.lit(size)).alias("seq"))


def fetch(chunks: DataFrame, intervals: DataFrame, size: int = 10_000) -> DataFrame:
    """intervals: (contig, start, end), from 0 and inclusive -> with ``bases``. Only the chunks that an interval touches are joined to it; the end is cut to the contig's. Each distinct interval gives a row."""
    each = intervals.select("contig", "start", "end").distinct()
    wanted = each.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / size).cast("int"), F.floor(F.col("end") / size).cast("int"))))
    got = wanted.join(chunks, ["contig", "chunk"]).groupBy("contig", "start", "end").agg(F.array_sort(F.collect_list(F.struct("chunk", "seq"))).alias("p"))
    seq = F.array_join(F.transform("p", lambda x: x["seq"]), "")
    skip = F.col("start") - F.col("p")[0]["chunk"] * size
    return got.select("contig", "start", "end", F.substring(seq, skip.cast("int") + 1, (F.col("end") - F.col("start") + 1).cast("int")).alias("bases"))


def strain_coverage_lines(weights: DataFrame, samples: list[str], source: str = "cladeframe") -> DataFrame:
    """weights: (strain, sample from 0, weight) -> (strain, line): a strain's weights by sample with two decimals, 0.00 where there is none. Header lines have negative numbers."""
    head = [f"##source={source}", *(f"##sample=<ID={i + 1}, name={n}>" for i, n in enumerate(samples)), "\t".join([f"{'strainID':<10}", *(f"{i + 1:<6}" for i in range(len(samples)))])]
    rows = [F.coalesce(F.max(F.when(F.col("sample") == i, F.col("weight"))), F.lit(0.0)).alias(f"s{i}") for i in range(len(samples))]
    body = weights.groupBy("strain").agg(*rows).select(F.col("strain").cast("long").alias("strain"), F.concat_ws("\t", F.concat(F.lit("strain_"), F.col("strain").cast("string")), *[F.format_string("%.2f", f"s{i}") for i in range(len(samples))]).alias("line"))
    return weights.sparkSession.createDataFrame([(i - len(head), x) for i, x in enumerate(head)], "strain long, line string").unionByName(body)


def find_references(spark: SparkSession, files: list[str] | None = None, directory: str | None = None, extension: str = "fna") -> list[str]:
    """The given files, or those of a folder with the extension, sorted. Neither: an error. Only names are read."""
    if files:
        return list(files)
    if not directory:
        raise ValueError("neither files nor a folder of references")
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}").load(directory).select("path")
    return sorted(r[0] for r in found.collect())


def sample_manifest(spark: SparkSession, short: list[str], long: list[str] = (), expected: tuple[int, int] | None = None) -> DataFrame:
    """(sample, read_type, path): short samples first, then long ones, numbered in the given order. Counts other than ``expected`` are an error."""
    if expected is not None and expected != (len(short), len(long)):
        raise ValueError(f"expected {expected} samples, got {(len(short), len(long))}")
    rows = [(i, "Short" if i < len(short) else "Long", p) for i, p in enumerate([*short, *long])]
    return spark.createDataFrame(rows, "sample int, read_type string, path string")


def read_samples(spark: SparkSession, short: list[str], long: list[str] = ()) -> DataFrame:
    """All alignment files as one table with sample and read_type; any mix of short and long samples. Empty lists give no rows."""
    out = None
    for i, path in enumerate([*short, *long]):
        one = read_sam(spark, path).withColumn("sample", F.lit(i)).withColumn("read_type", F.lit("Short" if i < len(short) else "Long"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = parse_sam(spark.createDataFrame([], "value string")).withColumn("sample", F.lit(0)).withColumn("read_type", F.lit("Short"))
    return out


def write_vcfs(variants: DataFrame, path: str, samples: list[str], contigs: list[tuple[str, str, int]]) -> None:
    """contigs: (genome, name, length). A folder ``genome=...`` for each genome of ``contigs``, its lines in order, header first; a genome without variants has its header only."""
    spark = variants.sparkSession
    names = list(dict.fromkeys(g for g, _, _ in contigs))
    head = [(g, -1, i, x) for g in names for i, x in enumerate(vcf_header(samples, [(n, k) for h, n, k in contigs if h == g]))]
    order = spark.createDataFrame([(n, g, i) for i, (g, n, _) in enumerate(contigs)], "contig string, genome string, o long")
    body = vcf_lines(variants).join(F.broadcast(order), "contig").select("genome", "o", "pos", "line")
    lines = spark.createDataFrame(head, "genome string, o long, pos long, line string").unionByName(body)
    lines.repartitionByRange("genome", "o", "pos").sortWithinPartitions("genome", "o", "pos").select("genome", "line").write.mode("overwrite").partitionBy("genome").text(path)


def write_once(df: DataFrame, path: str, force: bool = False) -> None:
    """Parquet that stays as it is if it is there already, unless ``force``."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)


def write_lines(lines: DataFrame, path: str | None = None) -> None:
    """One text column to ``path``, or to standard output, line by line, without gathering it."""
    if path:
        lines.write.mode("overwrite").text(path)
    else:
        for row in lines.toLocalIterator():
            print(row[0])
