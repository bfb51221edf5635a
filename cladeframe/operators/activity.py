"""Pileup likelihoods, activity profiles and active regions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import maths as M


def pileup_likelihoods(bases: DataFrame, ploidy: int = 2) -> DataFrame:
    """bases: (sample, tid, pos, is_alt, qual). Per locus ref_depth, non_ref_depth and gl: array of ploidy + 1 log10 genotype likelihoods.

    Sums are taken before the shuffle; only one row a locus and task is sent.
    """
    p = max(ploidy, 2)
    e = M.qual_to_error_prob(F.col("qual").cast("double"))
    hit, miss = F.log10(1.0 - e), F.log10(e) - math.log10(3)
    alt, ref = F.when(F.col("is_alt"), hit).otherwise(miss), F.when(F.col("is_alt"), miss).otherwise(hit)
    d = bases.withColumn("alt", alt).withColumn("ref", ref)
    terms = [F.sum(F.col("ref") + math.log10(p))]
    terms += [F.sum(M.log10_sum(F.array(F.col("ref") + math.log10(p - i), F.col("alt") + math.log10(i)))) for i in range(1, p)]
    terms += [F.sum(F.col("alt") + math.log10(p))]
    n = F.count("*")
    return d.groupBy("sample", "tid", "pos").agg(
        F.sum(F.when(F.col("is_alt"), 0).otherwise(1)).alias("ref_depth"), F.sum(F.when(F.col("is_alt"), 1).otherwise(0)).alias("non_ref_depth"), F.array(*[t - n * math.log10(p) for t in terms]).alias("gl")
    )


def capped_by_hom_ref(gl: Column) -> Column:
    return F.transform(gl, lambda x: F.least(x, gl[0]))


def kernel(sigma: float = 17.0, most: int = 50, least: float = 1e-5) -> list[tuple[int, float]]:
    """(offset, weight) of the band-pass filter: a normal curve, cut where it is under ``least``, summing to 1."""
    w = [math.exp(-(i * i) / (2 * sigma * sigma)) / (sigma * math.sqrt(2 * math.pi)) for i in range(-most, most + 1)]
    s = sum(w)
    kept = [(i, x / s) for i, x in zip(range(-most, most + 1), w) if x / s >= least]
    t = sum(x for _, x in kept)
    return [(i, x / t) for i, x in kept]


def smooth(activity: DataFrame, lengths: DataFrame, sigma: float = 17.0, most: int = 50) -> DataFrame:
    """activity: (tid, pos, prob), lengths: (tid, length). Each state is spread over its neighbours inside the contig and summed; map-side sums keep the shuffle near the number of loci."""
    k = F.array(*[F.struct(F.lit(i).alias("d"), F.lit(w).alias("w")) for i, w in kernel(sigma, most)])
    d = activity.where("prob > 0").join(F.broadcast(lengths) if lengths.limit(100_001).count() <= 100_000 else lengths, "tid")
    d = d.select("tid", "length", "pos", "prob", F.explode(k).alias("k")).select("tid", "length", (F.col("pos") + F.col("k.d")).alias("pos"), (F.col("prob") * F.col("k.w")).alias("prob"))
    return d.where("pos >= 0 and pos < length").groupBy("tid", "pos").agg(F.sum("prob").alias("prob"))


def spread_soft_clips(activity: DataFrame, least: float = 6.0, most: int = 50) -> DataFrame:
    """activity: (tid, pos, prob, clips). States with a mean of ``least`` high-quality soft clips or more are repeated over min(clips, most) positions on both sides."""
    n = F.when(F.col("clips") >= least, F.least(F.floor("clips"), F.lit(most))).otherwise(0)
    d = activity.select("tid", F.explode(F.sequence(F.col("pos") - n, F.col("pos") + n)).alias("pos"), "prob")
    return d.where("pos >= 0").groupBy("tid", "pos").agg(F.sum("prob").alias("prob"))


def best_cuts(activity: DataFrame, largest: int, smallest: int) -> DataFrame:
    """activity: (tid, pos, prob). For each piece of ``largest`` positions where it is best cut: (tid, piece, cut), the position after its lowest local minimum from ``smallest`` on, the last of equals.

    A minimum is below the state before it and not above the one after; neighbours are met by a join on positions, so no contig is ordered."""
    a = activity.select("tid", "pos", "prob")
    near = lambda by, name: a.select("tid", (F.col("pos") + by).alias("pos"), F.col("prob").alias(name))
    low = a.where(F.pmod("pos", F.lit(largest)) >= smallest).join(near(1, "before"), ["tid", "pos"]).join(near(-1, "after"), ["tid", "pos"]).where("prob < before and prob <= after")
    best = low.groupBy("tid", F.floor(F.col("pos") / largest).alias("piece")).agg(F.min(F.struct("prob", (-F.col("pos")).alias("at"))).alias("x"))
    return best.select("tid", "piece", (1 - F.col("x.at")).alias("cut"))


def cut_run(probs: np.ndarray, n: int, smallest: int, largest: int) -> list[tuple[int, int]]:
    """Regions (start, end exclusive) of an active run of n states; ``probs`` goes on past the run by one state unless the contig ends there.

    A region of ``largest`` states is cut after the lowest local minimum from ``smallest`` on, the last of equals; after ``largest`` if there is none.
    """
    out, at = [], 0
    while at < n:
        end = min(at + largest, n)
        if end - at == largest:
            i = np.arange(at + smallest, end)
            i = i[(i > 0) & (i + 1 < len(probs))]
            low = i[(probs[i] <= probs[np.minimum(i + 1, len(probs) - 1)]) & (probs[i] < probs[i - 1])]
            if len(low):
                end = int(low[::-1][np.argmin(probs[low[::-1]])]) + 1
        out.append((at, end))
        at = end
    return out


def regions(activity: DataFrame, threshold: float = 0.002, smallest: int = 50, largest: int = 300, padding: int = 100, lengths: DataFrame | None = None) -> DataFrame:
    """activity: (tid, pos, prob), dense or not (missing: 0); lengths: (tid, length) of the contigs. (tid, start, end, active, density, padded_start, padded_end).

    A change of state always ends a region, so runs are cut one by one: inactive ones and short active ones by arithmetic, and only active runs
    of ``largest`` states or more by their probabilities. density is the share of states over 0.05. Padding stops at the contig's ends (without ``lengths`` at its last state).
    """
    from .ranges import range_join, run_lengths

    a = activity.select(F.col("tid").cast("int").alias("tid"), F.col("pos").cast("long").alias("pos"), "prob")
    span = a.groupBy("tid").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    runs = run_lengths(a.where(F.col("prob") > threshold), ["tid"], "pos", F.lit(True)).select("tid", "start", "end")
    # a row for each active run, and one past the last state, tell what lies between
    marks = runs.unionByName(span.select("tid", (F.col("last") + 1).alias("start"), (F.col("last") + 1).alias("end"))).join(span, "tid")
    low = F.coalesce(F.lag("end").over(Window.partitionBy("tid").orderBy("start")) + 1, F.col("first"))
    quiet = marks.withColumn("low", low).where("low < start").select("tid", (F.col("start") - 1).alias("last"), F.explode(F.sequence("low", F.col("start") - 1, F.lit(largest))).alias("start"))
    out = quiet.select("tid", "start", F.least(F.col("start") + largest - 1, F.col("last")).alias("end"), F.lit(False).alias("active"))
    long = F.col("end") - F.col("start") + 1 >= largest
    out = out.unionByName(runs.where(~long).withColumn("active", F.lit(True)))

    def one(key, pdf):
        tid, start, end, last = (int(x) for x in key)
        probs = np.zeros(min(end + 1, last) - start + 1)
        probs[pdf.pos.to_numpy() - start] = pdf.prob.to_numpy()
        return pd.DataFrame([(tid, start + s, start + e - 1, True) for s, e in cut_run(probs, end - start + 1, smallest, largest)], columns=["tid", "start", "end", "active"])

    wide = runs.where(long).join(span.select("tid", "last"), "tid").select(F.col("tid").alias("r_tid"), F.col("start").alias("r_start"), F.col("end").alias("r_end"), "last", F.least(F.col("end") + 1, "last").alias("r_last"))
    met = range_join(a.withColumn("pos2", F.col("pos")), wide, ("tid", "pos", "pos2"), ("r_tid", "r_start", "r_last"), 1 << 12)
    out = out.unionByName(met.groupBy("r_tid", "r_start", "r_end", "last").applyInPandas(one, "tid int, start long, end long, active boolean"))
    busy = a.where("prob > 0.05").select(F.col("tid").alias("b_tid"), F.col("pos").alias("b_pos"), F.col("pos").alias("b_end"))
    n = range_join(out.select("tid", "start", "end"), busy, ("tid", "start", "end"), ("b_tid", "b_pos", "b_end"), largest).groupBy("tid", "start").agg(F.count("*").alias("busy"))
    size = F.col("end") - F.col("start") + 1
    out = out.join(n, ["tid", "start"], "left").join((span.select("tid", (F.col("last") + 1).alias("length")) if lengths is None else lengths.select("tid", "length")), "tid")
    return out.select("tid", "start", "end", "active", (F.coalesce("busy", F.lit(0)) / size).alias("density"), F.greatest(F.lit(0), F.col("start") - padding).alias("padded_start"), F.least(F.col("length") - 1, F.col("end") + padding).alias("padded_end"))
