"""Variant tables: quality gate, consensus, identity between samples, fixation index, splitting of sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maths import total


def quality_gate(qf: Column, qd: Column, log10_p_error: Column, qd_least: float = 25.0, qual_least: float = 150.0) -> Column:
    """A stored verdict wins; else QD (if there is one) and the error probability must pass."""
    p = log10_p_error <= qual_least / -10.0
    return F.coalesce(qf == "true", F.when(qd.isNull(), p).otherwise((qd >= qd_least) & p), F.lit(False))


def present(ad: Column, least: int) -> Column:
    return F.transform(ad, lambda x: x >= least)


def consensus_index(ad: Column) -> Column:
    """First allele with the most reads; null without reads."""
    return F.when(F.array_max(ad) > 0, F.array_position(ad, F.array_max(ad)) - 1).cast("int")


def compared_bases(depths: DataFrame, least: int) -> DataFrame:
    """depths: (site, sample, depth). (s1, s2, compared) for s1 <= s2: sites where both samples are deep enough; the diagonal counts a sample's own."""
    d = depths.where(F.col("depth") >= least).select("site", "sample")
    a, b = d.withColumnRenamed("sample", "s1"), d.withColumnRenamed("sample", "s2")
    return a.join(b, "site").where("s1 <= s2").groupBy("s1", "s2").agg(F.count("*").alias("compared"))


def identity_counts(ad: DataFrame, least: int) -> DataFrame:
    """ad: (site, sample, ad array<int>, lens array<int>), allele 0 the reference. For s1 <= s2 the sites that both samples are deep enough for, compared, and the summed differences
    con, pop and subpop over those where both have an allele of ``least`` reads. One join of the sites and one aggregation.

    The join is by site, and a site has a row for each sample: pairs grow with the square of the number of samples, not of sites.
    """
    d = ad.where(F.aggregate("ad", F.lit(0), lambda a, x: a + x) >= least).withColumn("pres", present(F.col("ad"), least)).withColumn("some", F.exists("pres", lambda x: x)).withColumn("con", F.coalesce(consensus_index(F.col("ad")), F.lit(0)))
    a = d.select("site", "lens", F.col("sample").alias("s1"), F.col("pres").alias("p1"), F.col("con").alias("c1"), F.col("some").alias("o1"))
    b = d.select("site", F.col("sample").alias("s2"), F.col("pres").alias("p2"), F.col("con").alias("c2"), F.col("some").alias("o2"))
    j = a.join(b, "site").where("s1 <= s2")
    lens = F.col("lens")

    def mean_len(flags):
        got = F.filter(F.zip_with(flags, lens, lambda f, n: F.when(f, n)), lambda x: x.isNotNull())
        return F.when(F.size(got) > 0, total(F.transform(got, lambda x: x.cast("double"))) / F.size(got)).otherwise(0.0)

    diff = F.zip_with("p1", "p2", lambda x, y: x != y)
    bd = mean_len(diff)
    la, lb, l0 = F.element_at(lens, F.col("c1") + 1), F.element_at(lens, F.col("c2") + 1), lens[0]
    con = lambda x, y: F.when((x == 1) & (y == 1), 1).otherwise(F.abs(x - y)).cast("double")
    shared = F.exists(F.zip_with("p1", "p2", lambda x, y: x & y), lambda x: x)
    own = F.col("s1") == F.col("s2")
    away = F.when(~F.col("p1")[0], mean_len(F.col("p1"))).otherwise(0.0)
    j = j.select(
        "s1", "s2", (F.col("o1") & F.col("o2")).alias("both"),
        F.when(own, F.when(F.col("c1") != 0, con(la, l0)).otherwise(0.0)).otherwise(F.when(F.col("c1") != F.col("c2"), con(la, lb)).otherwise(0.0)).alias("con"),
        F.when(own, away).otherwise(F.when(shared, 0.0).otherwise(bd)).alias("pop"),
        F.when(own, away).otherwise(F.when(F.exists(diff, lambda x: x), bd).otherwise(0.0)).alias("subpop"),
    )
    return j.groupBy("s1", "s2").agg(F.count("*").alias("compared"), *[F.coalesce(F.sum(F.when(F.col("both"), F.col(c))), F.lit(0.0)).alias(c) for c in ("con", "pop", "subpop")])


def ani(ad: DataFrame, least: int) -> DataFrame:
    """(s1, s2, con_ani, pop_ani, subpop_ani) for s1 <= s2: one less differences over compared bases."""
    n = identity_counts(ad, least)
    return n.select("s1", "s2", *[(1.0 - F.col(c) / F.col("compared")).alias(f"{c}_ani") for c in ("con", "pop", "subpop")])


def hudson_fst(ad: DataFrame, least: int) -> DataFrame:
    """(s1, s2, fst, sites) for s1 < s2 from read depths taken as allele counts: per site num/den, NaN to 0, clipped to 0..1, averaged."""
    d = ad.withColumn("n", F.aggregate("ad", F.lit(0), lambda a, x: a + x)).where(F.col("n") >= least)
    d = d.withColumn("within", 1.0 - F.aggregate("ad", F.lit(0.0), lambda a, x: a + x * (x - 1)) / (F.col("n") * (F.col("n") - 1)))
    a = d.select("site", F.col("sample").alias("s1"), F.col("ad").alias("a1"), F.col("n").alias("n1"), F.col("within").alias("w1"))
    b = d.select("site", F.col("sample").alias("s2"), F.col("ad").alias("a2"), F.col("n").alias("n2"), F.col("within").alias("w2"))
    j = a.join(b, "site").where("s1 < s2")
    between = 1.0 - total(F.zip_with("a1", "a2", lambda x, y: (x * y).cast("double"))) / (F.col("n1") * F.col("n2"))
    r = (between - (F.col("w1") + F.col("w2")) / 2) / F.nullif(between, F.lit(0.0))
    site = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.when(F.isnan(r), 0.0).otherwise(r), F.lit(0.0))))
    return j.select("s1", "s2", site.alias("f")).groupBy("s1", "s2").agg(F.avg("f").alias("fst"), F.count("*").alias("sites"))


def split_sites(variants: DataFrame, qd_least: float, depth_least: int, p_most: float = -15.0, gq_least: int = 100) -> DataFrame:
    """One row for each alternative allele, with ``kept``: quality passes and the summed alt depth of samples with GQ >= gq_least reaches depth_least.

    variants: (site, alleles, qd, log10_p_error, genotypes array<struct<sample, ad, gq>>). Depths of less certain samples count 0.
    """
    d = variants.select("*", F.posexplode(F.slice("alleles", 2, F.size("alleles"))).alias("k", "alt"))
    trust = F.transform("genotypes", lambda g: F.struct(g["sample"].alias("sample"), g["ad"][0].alias("ref_ad"), F.when(g["gq"] >= gq_least, F.element_at(g["ad"], F.col("k") + 2)).otherwise(0).alias("alt_ad")))
    d = d.withColumn("split", trust).withColumn("alt_depth", F.aggregate("split", F.lit(0), lambda a, g: a + g["alt_ad"].cast("int")))
    ok = (F.col("qd") >= qd_least) & (F.col("log10_p_error") <= p_most) & (F.col("alt_depth") >= depth_least)
    return d.select("site", (F.col("k") + 1).alias("alt_index"), "alt", "split", "alt_depth", ok.alias("kept"))


def matrix(pairs: DataFrame, value: str, samples: list[int], digits: int = 8) -> DataFrame:
    """(s1, s2, value) of a triangle as a full matrix with one column for each sample, both numbered from 1."""
    both = pairs.select("s1", "s2", value).union(pairs.where("s1 != s2").select("s2", "s1", value))
    out = both.groupBy("s1").pivot("s2", samples).agg(F.round(F.first(value), digits))
    return out.select((F.col("s1") + 1).alias("sample"), *[F.col(str(s)).alias(f"s{s + 1}") for s in samples])


def upper_median(values: Column) -> Column:
    """sorted[n / 2], 30 for none."""
    s = F.array_sort(values)
    return F.when(F.size(s) > 0, F.element_at(s, F.floor(F.size(s) / 2).cast("int") + 1)).otherwise(30)


def merge_contexts(contexts: DataFrame) -> DataFrame:
    """contexts: (contig, start, priority, ref, alts, and info map<string,string>), refs of one start being prefixes of each other. (contig, start, ref, alts, info, merged): the longest ref,
    the distinct alts on it by priority, then by place, without those that become the ref, and the attributes that no two contexts tell differently."""
    longest = F.max(F.struct(F.length("ref").alias("n"), "ref"))["ref"]
    g = contexts.groupBy("contig", "start").agg(longest.alias("ref"), F.array_sort(F.collect_list(F.struct("priority", F.col("ref").alias("old"), "alts", F.array_sort(F.map_entries("info")).alias("info")))).alias("all"), F.count("*").alias("merged"))
    full = F.flatten(F.transform("all", lambda c: F.transform(c["alts"], lambda a: F.concat(a, F.substr(F.col("ref"), F.length(c["old"]) + 1)))))
    g = g.withColumn("full", full).withColumn("pairs", F.array_distinct(F.flatten(F.transform("all", lambda c: c["info"]))))
    sure = F.filter("pairs", lambda e: F.size(F.filter("pairs", lambda o: o["key"] == e["key"])) == 1)
    return g.select("contig", "start", "ref", F.filter(F.array_distinct("full"), lambda a: a != F.col("ref")).alias("alts"), F.map_from_entries(sure).alias("info"), "merged")


#: Bases kept beside a substitution, another insertion or deletion, and one in a tandem repeat.
SNP_PAD, INDEL_PAD, REPEAT_PAD = 20, 75, 75


def trimmed_regions(regions: DataFrame, variants: DataFrame, pads: tuple[int, int, int] = (SNP_PAD, INDEL_PAD, REPEAT_PAD)) -> DataFrame:
    """regions: (region, r_tid, r_start, r_end, p_start, p_end: the padded span), variants: (tid, start, end, indel, repeat). (region, start, end): what a region's variants need, each with the pad of its kind, inside the padded span. Regions without variants are left out."""
    from .ranges import range_join

    pad = F.when(F.col("repeat"), pads[2]).when(F.col("indel"), pads[1]).otherwise(pads[0])
    j = range_join(regions, variants.withColumn("pad", pad), ("r_tid", "r_start", "r_end"), ("tid", "start", "end"), 1024)
    low, high = F.min(F.col("start") - F.col("pad")), F.max(F.col("end") + F.col("pad"))
    g = j.groupBy("region").agg(low.alias("low"), high.alias("high"), F.first("p_start").alias("p_start"), F.first("p_end").alias("p_end"))
    return g.select("region", F.greatest("low", "p_start").alias("start"), F.least("high", "p_end").alias("end"))
