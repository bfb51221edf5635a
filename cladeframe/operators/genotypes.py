"""Genotype enumeration, likelihoods, allele-frequency estimation and calls."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import maths as M


def genotypes(ploidy: int, alleles: int) -> list[tuple[int, ...]]:
    """Allele indices of each genotype in VCF order: by the highest allele, then the next."""
    return sorted(combinations_with_replacement(range(alleles), ploidy), key=lambda g: g[::-1])


def genotype_dim(spark: SparkSession, ploidies: list[int], alleles: list[int]) -> DataFrame:
    """(ploidy, n_alleles, idx, counts array<int>, gt, log10_comb)."""
    rows = []
    for p in ploidies:
        for n in alleles:
            for i, g in enumerate(genotypes(p, n)):
                c = [g.count(a) for a in range(n)]
                comb = math.log10(math.factorial(p)) - sum(math.log10(math.factorial(x)) for x in c)
                rows.append((p, n, i, c, "/".join(map(str, g)), comb))
    return spark.createDataFrame(rows, "ploidy int, n_alleles int, idx int, counts array<int>, gt string, log10_comb double")


def genotype_likelihoods(lk: DataFrame, alleles: int, ploidy: int, depths: bool = False) -> DataFrame:
    """lk: (site, sample, read, lks array<double>) of log10 likelihoods by allele. (site, sample, gl array<double>) for rows of ``alleles`` alleles.

    Each read gives each genotype log10 of the count-weighted sum of its alleles' likelihoods. There is a sum for each genotype, all in one
    aggregation with partial sums before the shuffle; rows are not multiplied by genotypes. ``depths`` adds ad, the reads whose best allele is clearly each one.
    """
    x = [F.col("lks")[i] for i in range(alleles)]
    sums = []
    for g in genotypes(ploidy, alleles):
        parts = [(a, g.count(a)) for a in sorted(set(g))]
        if len(parts) == 1:
            term = x[parts[0][0]] + math.log10(ploidy)
        else:
            top = F.greatest(*[x[a] for a, _ in parts])
            weights = [F.pow(F.lit(10.0), x[a] - top) * c for a, c in parts]
            total = weights[0]
            for w in weights[1:]:
                total = total + w
            term = top + F.log10(total)
        sums.append(F.sum(term) - F.count("*") * math.log10(ploidy))
    best = best_allele(F.col("lks"))
    reads = [F.array(*[F.count_if((F.col("best.allele") == a) & F.col("best.informative")).cast("int") for a in range(alleles)]).alias("ad")] if depths else []
    lk = lk.where(F.size("lks") == alleles)
    return (lk.withColumn("best", best) if depths else lk).groupBy("site", "sample").agg(F.array(*sums).alias("gl"), *reads)


#: Ways to assign a genotype.
METHODS = ("pls", "posterior", "no_call", "no_call_bare", "original", "none")


def assign(pl: Column, gts: list[str], method: str = "pls", prior: Column | None = None, original: Column | None = None, kept: Column | None = None) -> Column:
    """Genotype of a sample. pls: by the smallest PL, no call if they tell nothing apart; posterior: by PLs and log10 priors; no_call, and no_call_bare, whose sample loses its
    annotations too (see ``called``); original: the ``original`` allele numbers as an array, those that aren't in ``kept`` as the reference, a negative one as no call; none: null."""
    at = lambda v: F.element_at(F.array(*[F.lit(g) for g in gts]), F.array_position(v, F.array_min(v)).cast("int"))
    if method == "pls":
        return F.when(F.size(F.filter(pl, lambda v: v == F.array_min(pl))) == F.size(pl), F.lit("./.")).otherwise(at(pl))
    if method == "posterior":
        return at(F.zip_with(pl, prior, lambda v, p: v - 10.0 * p))
    if method in ("no_call", "no_call_bare"):
        return F.lit("./.")
    if method == "original":
        return F.array_join(F.transform(original, lambda x: F.when(x < 0, F.lit(".")).when(F.array_contains(kept, x), (F.array_position(kept, x) - 1).cast("string")).otherwise(F.lit("0"))), "/")
    return F.lit(None).cast("string")


def called(pl: Column, ad: Column, gts: list[str], method: str = "pls", **how) -> Column:
    """struct<gt, pl, ad, gq, dp> of a sample: no call has no GQ, and without annotations no PL, AD and DP either."""
    gt = assign(pl, gts, method, **how)
    none = lambda c: F.when(F.lit(method != "no_call_bare"), c)
    return F.struct(gt.alias("gt"), none(pl).alias("pl"), none(ad).alias("ad"), F.when(~F.coalesce(gt, F.lit(".")).contains("."), M.gq(pl)).alias("gq"), none(F.aggregate(ad, F.lit(0), lambda a, x: a + x)).alias("dp"))


def best_allele(lks: Column, informative: float = 0.2) -> Column:
    """struct<allele, confidence, informative>: the first most likely allele, and how far the second lies below."""
    top = F.array_max(lks)
    at = F.array_position(lks, top).cast("int")
    second = F.array_max(F.filter(lks, lambda x, i: i != at - 1))
    conf = F.coalesce(top - second, F.lit(0.0))
    return F.struct((at - 1).alias("allele"), conf.alias("confidence"), (conf > informative).alias("informative"))


def normalize_to_best(lks: Column, cap: float) -> Column:
    """Floors each likelihood at the best less ``cap``."""
    top = F.array_max(lks)
    return F.transform(lks, lambda x: F.greatest(x, top - cap))


def non_ref_likelihood(lks: Column) -> Column:
    """Median of those strictly below the best; the best if there is none."""
    top = F.array_max(lks)
    rest = F.array_sort(F.filter(lks, lambda x: x < top))
    n = F.size(rest)
    mid = F.floor(n / 2).cast("int")
    return F.when(n == 0, top).when(n % 2 == 1, F.element_at(rest, mid + 1)).otherwise((F.element_at(rest, F.greatest(mid, F.lit(1))) + F.element_at(rest, mid + 1)) / 2)


def genotype_priors(ploidy: int, alleles: list[str], snp_het: float = 0.001, indel_het: float = 0.000125, het_hom_ratio: float | None = None) -> list[float]:
    """log10 priors of the genotypes in VCF order; the reference's is 0.

    An alt allele's first copy costs its kind's heterozygosity, each further one the step from het to hom: the heterozygosity again (Hardy-Weinberg), or the
    given ratio. A substitution's is shared among the three other bases, once for each allele.
    """
    out = []
    for g in genotypes(ploidy, len(alleles)):
        prior = 0.0
        for a in {x for x in g if x}:
            snp = len(alleles[a]) == len(alleles[0])
            het = math.log10(snp_het if snp else indel_het)
            step = het if het_hom_ratio is None else -math.log10(het_hom_ratio)
            prior += het - (math.log10(3) if snp else 0.0) + step * (g.count(a) - 1)
        out.append(prior)
    return out


def allele_frequencies(gls: list[list[float]], alleles: list[str], ploidy: int = 2, snp_het: float = 0.001, indel_het: float = 0.000125, stdev: float = 0.01) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation maximisation with Dirichlet pseudocounts: expected allele counts, log10 P(no variant) and log10 P(absent) of each alt."""
    n = len(alleles)
    ref = snp_het / stdev**2
    prior = np.array([ref, *((snp_het if len(a) == len(alleles[0]) else indel_het) * ref for a in alleles[1:])])
    gt = genotypes(ploidy, n)
    counts = np.array([[g.count(a) for a in range(n)] for g in gt], float)
    comb = math.lgamma(ploidy + 1) - np.array([sum(math.lgamma(c + 1) for c in row) for row in counts])
    comb /= math.log(10)
    gl = np.array(gls, float)
    logf = np.full(n, -math.log10(n))
    got = np.zeros(n)
    while True:
        post = gl + comb + counts @ logf
        post -= post.max(axis=1, keepdims=True)
        prob = 10**post
        prob /= prob.sum(axis=1, keepdims=True)
        new = (prob @ counts).sum(axis=0)
        done = np.abs(new - got).max() <= 0.01
        got = new
        f = (prior + got) / (prior.sum() + got.sum())
        logf = np.log10(f)
        if done:
            break
    with np.errstate(divide="ignore"):
        none = float(np.log10(np.maximum(prob[:, 0], 1e-300)).sum())
        absent = np.array([np.log10(np.clip(prob[:, counts[:, a] == 0].sum(axis=1), 1e-300, 1.0)).sum() for a in range(1, n)])
    if n == 2:
        absent = np.array([none])
    return got, none, absent


def effective_counts(gls: DataFrame, alleles: int, ploidy: int, log10_frequencies: list[float]) -> DataFrame:
    """gls: (site, sample, gl). (site, counts array<double>): the expected allele counts of all samples at the given allele frequencies, one step of the expectation maximisation."""
    gt = genotypes(ploidy, alleles)
    comb = [math.log10(math.factorial(ploidy)) - sum(math.log10(math.factorial(g.count(a))) for a in range(alleles)) for g in gt]
    logs = [F.col("gl")[i] + float(c + sum(log10_frequencies[a] for a in g)) for i, (g, c) in enumerate(zip(gt, comb))]
    post = gls.select("site", F.array(*logs).alias("p")).withColumn("top", F.array_max("p"))
    post = post.select("site", F.transform("p", lambda v: F.pow(F.lit(10.0), v - F.col("top"))).alias("p")).withColumn("all", M.total(F.col("p")))

    def share(a):
        out = F.lit(0.0)
        for i, g in enumerate(gt):
            if a in g:
                out = out + F.col("p")[i] * g.count(a)
        return out / F.col("all")

    return post.groupBy("site").agg(F.array(*[F.sum(share(a)) for a in range(alleles)]).alias("counts"))


def call_sites(sites: DataFrame, ploidy: int = 2, confidence: float = 25.0) -> DataFrame:
    """sites: (site, alleles array<string>, gls array<array<double>>). (site, af, mle_ac, qual, emitted): whether -10 log10 P(no variant) reaches ``confidence``."""

    def one(batches):
        for pdf in batches:
            rows = []
            for site, alleles, gls in zip(pdf.site, pdf.alleles, pdf.gls):
                count, none, absent = allele_frequencies([list(g) for g in gls], list(alleles), ploidy)
                plausible = absent + 1e-10 < -confidence / 10
                rows.append((site, [float(x) for x in count[1:] / max(count.sum(), 1e-9)], [int(round(x)) for x in count[1:]], -10 * none, bool(-10 * none >= confidence and plausible.any())))
            yield pd.DataFrame(rows, columns=["site", "af", "mle_ac", "qual", "emitted"])

    return sites.select("site", "alleles", "gls").mapInPandas(one, "site long, af array<double>, mle_ac array<int>, qual double, emitted boolean")


def likely_alleles(gl: np.ndarray, gt: list[tuple[int, ...]], alleles: int, most: int) -> list[int]:
    """The reference and the ``most`` alts with the largest summed gain of the samples' best genotypes over the reference, in order; ties to the first."""
    gain = np.zeros(alleles)
    for row in gl:
        best = int(np.argmax(row))
        for a in set(gt[best]) - {0}:
            gain[a] += row[best] - row[0]
    order = sorted(range(1, alleles), key=lambda a: (-gain[a], a))
    return [0, *sorted(order[:most])]


def call_site(alleles: list[str], pls: list[list[int]], ads: list[list[int]], ploidy: int = 2, confidence: float = 25.0, most: int = 6, given: tuple[str, ...] = ()) -> dict:
    """Calls a site of several samples: alts beyond ``most`` are left out before the frequencies are estimated; those are put out that the samples make plausible, or that are ``given``.

    Without any the site is monomorphic, its quality that of having no variant. Genotypes are over the alleles put out: PLs from 0, GT by the best of them
    (no call where they tell nothing apart), reads by allele, GQ and depth.
    """
    gl, n = np.array(pls, float) / -10, len(alleles)
    gt = genotypes(ploidy, n)
    kept = likely_alleles(gl, gt, n, most)
    at = lambda keep: [gt.index(tuple(sorted(keep[a] for a in g))) for g in genotypes(ploidy, len(keep))]
    count, none, absent = allele_frequencies(gl[:, at(kept)].tolist(), [alleles[a] for a in kept], ploidy) if len(kept) > 1 else (np.array([float(ploidy * len(gl))]), 0.0, np.array([]))
    plausible = {a for a, x in zip(kept[1:], absent) if x + 1e-10 < -confidence / 10}
    out = [0, *sorted(plausible | {a for a in range(1, n) if alleles[a] in given})]
    polymorphic = bool(plausible)
    p = none if polymorphic else math.log10(max(1e-300, 1 - 10.0**none)) if none < 0 else -300.0
    rows = []
    for pl, ad in zip(pls, ads):
        mine = [pl[i] for i in at(out)]
        mine = [x - min(mine) for x in mine]
        order = sorted(mine)
        informative = sum(mine) > 1 and len(out) > 1
        names = "/".join(map(str, genotypes(ploidy, len(out))[mine.index(0)])) if informative else "/".join("." if len(out) > 1 else "0" for _ in range(ploidy))
        rows.append((names, mine, [ad[a] for a in out], min(99, order[1]) if informative else 0, sum(ad[a] for a in out)))
    total = float(count.sum())
    mle = dict(zip(kept, count))
    return {
        "alleles": [alleles[a] for a in out], "qual": -10.0 * p + 0.0, "polymorphic": polymorphic, "emitted": polymorphic and -10 * p >= confidence,
        "mle_ac": [int(round(mle.get(a, 0.0))) for a in out[1:]], "mle_af": [min(1.0, float(mle.get(a, 0.0)) / total) if total else 0.0 for a in out[1:]], "genotypes": rows,
    }


#: Called sites that a task holds.
_KNOWN = 1 << 12
_CALL = "alleles array<string>, qual double, polymorphic boolean, emitted boolean, mle_ac array<int>, mle_af array<double>, genotypes array<struct<sample:int,gt:string,pl:array<int>,ad:array<int>,gq:int,dp:int>>"


def call_genotypes(sites: DataFrame, ploidy: int = 2, confidence: float = 25.0, most: int = 6) -> DataFrame:
    """sites: (site of any type, alleles, samples array<struct<sample, pl, ad>>). Adds what ``call_site`` gives. One row holds a site's samples, as the estimate needs them all."""
    kind = sites.schema["site"].dataType.simpleString()

    def run(batches):
        known: dict = {}  # sites with equal alleles, PLs and depths are called once
        for pdf in batches:
            rows = []
            for site, alleles, samples in zip(pdf.site, pdf.alleles, pdf.samples):
                samples = sorted(samples, key=lambda x: x["sample"])
                what = tuple(alleles), tuple(tuple(x["pl"]) for x in samples), tuple(tuple(x["ad"]) for x in samples)
                if what not in known:
                    if len(known) >= _KNOWN:
                        known.clear()
                    known[what] = call_site(list(alleles), *([list(x) for x in xs] for xs in what[1:]), ploidy, confidence, most)
                got = known[what]
                called = [dict(zip(("sample", "gt", "pl", "ad", "gq", "dp"), (x["sample"], *g))) for x, g in zip(samples, got["genotypes"])]
                rows.append({"site": site, **got, "genotypes": called})
            yield pd.DataFrame(rows, columns=["site", *(f.split()[0] for f in _CALL.split(", "))])

    return sites.select("site", "alleles", "samples").mapInPandas(run, f"site {kind}, {_CALL}")


def call_annotations(calls: DataFrame, cap: float = 45.0) -> DataFrame:
    """calls as of ``call_genotypes``. Adds dp, an, ac and af from the called genotypes, and qd: quality by the depth of samples with alt reads (of all, if none has any), at most ``cap``."""
    g = F.col("genotypes")
    numbers = F.flatten(F.transform(g, lambda x: F.filter(F.split(x["gt"], "[/|]"), lambda a: a != ".")))
    total = lambda keep: F.aggregate(F.filter(g, keep), F.lit(0), lambda a, x: a + x["dp"])
    alt_dp = total(lambda x: F.exists(F.slice(x["ad"], 2, F.size(x["ad"])), lambda v: v > 0))
    d = calls.withColumn("__n", numbers).withColumn("dp", total(lambda x: F.lit(True))).withColumn("an", F.size("__n"))
    alts = F.when(F.size("alleles") > 1, F.sequence(F.lit(1), F.size("alleles") - 1)).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("ac", F.transform(alts, lambda a: F.size(F.filter("__n", lambda x: x == a.cast("string")))))
    d = d.withColumn("af", F.transform("ac", lambda x: F.when(F.col("an") > 0, x / F.col("an")).otherwise(0.0)))
    depth = F.coalesce(F.nullif(alt_dp, F.lit(0)), F.col("dp"))
    return d.withColumn("qd", F.when(depth > 0, F.least(F.lit(cap), F.col("qual") / depth))).drop("__n")


def site_annotations(reads: DataFrame, alleles: int) -> DataFrame:
    """reads: (site, allele from 0, mapq, qual). (site, dp, ad, af, mq, bq): depth, reads by allele, share of each alt, and the upper medians of both qualities by allele (30 without reads)."""
    from .variants import upper_median

    of = lambda c: [F.collect_list(F.when(F.col("allele") == a, F.col(c))) for a in range(alleles)]
    ad = [F.count_if(F.col("allele") == a).cast("int") for a in range(alleles)]
    g = reads.groupBy("site").agg(F.count("*").alias("dp"), F.array(*ad).alias("ad"), F.array(*of("mapq")).alias("m"), F.array(*of("qual")).alias("b"))
    return g.select("site", "dp", "ad", F.transform(F.slice("ad", 2, alleles), lambda x: x / F.col("dp")).alias("af"), F.transform("m", upper_median).alias("mq"), F.transform("b", upper_median).alias("bq"))


def subset_pls(pl: Column, ploidy: int, alleles: int, keep: list[int]) -> Column:
    """PLs of the genotypes over the kept alleles (the reference first), shifted so that the best is 0."""
    old = {g: i for i, g in enumerate(genotypes(ploidy, alleles))}
    at = [old[tuple(sorted(keep[a] for a in g))] for g in genotypes(ploidy, len(keep))]
    got = F.array(*[pl[i] for i in at])
    low = F.array_min(got)
    return F.transform(got, lambda x: x - low)


def subset(pl: Column, ad: Column, ploidy: int, alleles: int, keep: list[int]) -> Column:
    """struct<pl, ad, gq, dp> over the kept alleles; dp counts their reads."""
    pls, depths = subset_pls(pl, ploidy, alleles, keep), F.array(*[ad[i] for i in keep])
    return F.struct(pls.alias("pl"), depths.alias("ad"), M.gq(pls).alias("gq"), F.aggregate(depths, F.lit(0), lambda a, x: a + x).alias("dp"))


def annotations(ad: DataFrame, qual: Column) -> DataFrame:
    """ad: (site, sample, ad array<int>, and what ``qual`` needs, the same on all rows of a site). (site, dp, ac, af, qd), one aggregation.

    dp sums the depths of the samples, ac counts the samples' reads of each alt allele, af is their share, qd is ``qual`` by the depth of samples that carry an alt (null without one).
    """
    depth = F.aggregate("ad", F.lit(0), lambda a, x: a + x)
    carries = F.exists(F.slice("ad", 2, F.size("ad")), lambda x: x > 0)
    alts = F.collect_list(F.struct("sample", F.slice("ad", 2, F.size("ad")).alias("alt")))
    g = ad.groupBy("site").agg(F.sum(depth).alias("dp"), F.sum(F.when(carries, depth)).alias("alt_dp"), F.max(qual).alias("qual"), alts.alias("alts"))
    ac = F.aggregate("alts", F.transform(F.col("alts")[0]["alt"], lambda _: F.lit(0)), lambda a, x: F.zip_with(a, x["alt"], lambda p, q: p + q))
    g = g.withColumn("ac", ac)
    return g.select("site", "dp", "ac", F.transform("ac", lambda x: F.when(F.col("dp") > 0, x / F.col("dp")).otherwise(0.0)).alias("af"), F.when(F.col("alt_dp") > 0, F.col("qual") / F.col("alt_dp")).alias("qd"))
