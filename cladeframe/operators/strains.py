"""Linkage of variant groups, strain abundances, codon evolution and consensus sequences."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import codon_table


def shared_reads(members: DataFrame) -> DataFrame:
    """members: (grp, read), repeats allowed. (g1, g2, inter, uni, jaccard) for g1 < g2 that share a read."""
    d = members.select("grp", "read").distinct()
    size = d.groupBy("grp").agg(F.count("*").alias("n"))
    pairs = d.withColumnRenamed("grp", "g1").join(d.withColumnRenamed("grp", "g2"), "read").where("g1 < g2").groupBy("g1", "g2").agg(F.count("*").alias("inter"))
    s1, s2 = size.select(F.col("grp").alias("g1"), F.col("n").alias("n1")), size.select(F.col("grp").alias("g2"), F.col("n").alias("n2"))
    return pairs.join(s1, "g1").join(s2, "g2").select("g1", "g2", "inter", (F.col("n1") + F.col("n2") - F.col("inter")).alias("uni"), (F.col("inter") / (F.col("n1") + F.col("n2") - F.col("inter"))).alias("jaccard"))


def linkage_edges(shared: DataFrame, depths: DataFrame, separation: DataFrame | None = None) -> DataFrame:
    """Directed edges (src, dst, weight) from the deeper group to the shallower. Weight: 1 - jaccard, times 1 + f with f = 1 - ln(min depth)/ln(max depth); groups that share almost nothing take their separation instead."""
    d1 = depths.select(F.col("grp").alias("g1"), F.col("depth").alias("d1"))
    d2 = depths.select(F.col("grp").alias("g2"), F.col("depth").alias("d2"))
    j = shared.join(d1, "g1").join(d2, "g2")
    if separation is not None:
        j = j.join(separation, ["g1", "g2"], "left")
    else:
        j = j.withColumn("sep", F.lit(1.0))
    f = 1.0 - F.log(F.least("d1", "d2")) / F.log(F.greatest("d1", "d2"))
    w = 1.0 - F.col("jaccard")
    down = F.col("d1") > F.col("d2")
    return j.select(F.when(down, F.col("g1")).otherwise(F.col("g2")).alias("src"), F.when(down, F.col("g2")).otherwise(F.col("g1")).alias("dst"), (F.when(w < 0.98, w).otherwise(F.coalesce("sep", F.lit(1.0))) * (1.0 + f)).alias("weight"))


def strain_paths(edges: list[tuple[int, int, float]], depths: dict[int, float], share: float = 0.35) -> list[list[int]]:
    """Strains as cheapest paths from sources to sinks of the group graph; a path counts if it takes depth that earlier ones left, or reaches a group not seen yet. The graph has a vertex for each group, some dozens."""
    if not edges:
        return [[g] for g in sorted(depths)]
    out = defaultdict(list)
    into = defaultdict(list)
    for a, b, w in edges:
        out[a].append((b, w))
        into[b].append(a)
    used: dict[int, float] = defaultdict(float)
    seen: set[int] = set()
    strains = []
    for tip in sorted((g for g in depths if not into[g]), key=lambda g: (-depths[g], g)):
        best = {tip: (0.0, [tip])}
        heap = [(0.0, tip)]
        while heap:
            c, v = heapq.heappop(heap)
            if c > best[v][0]:
                continue
            for b, w in sorted(out[v]):
                if b not in best or c + w < best[b][0]:
                    best[b] = (c + w, best[v][1] + [b])
                    heapq.heappush(heap, (c + w, b))
        for sink in sorted((v for v in best if not out[v]), key=lambda v: (best[v][0] / len(best[v][1]), v)):
            path = best[sink][1]
            fresh = any(g not in seen for g in path)
            if fresh or all(1 - used[g] / depths[g] >= share for g in path):
                strains.append(path)
                low = min(depths[g] for g in path)
                for g in path:
                    used[g] += low
                    seen.add(g)
    for g in sorted(set(depths) - seen):
        strains.append([g])
    return strains


def strains(edges: DataFrame, depths: DataFrame, share: float = 0.35) -> DataFrame:
    """edges: (genome, src, dst, weight), depths: (genome, grp, depth). (genome, strain, place, grp): ``strain_paths`` of each genome, its groups by place. A genome's groups, some dozens, are one task's."""

    def one(key, e, d):
        paths = strain_paths([(int(a), int(b), float(w)) for a, b, w in sorted(zip(e.src, e.dst, e.weight))], {int(g): float(x) for g, x in zip(d.grp, d.depth)}, share) if len(d) else []
        return pd.DataFrame([(key[0], k, i, g) for k, path in enumerate(paths) for i, g in enumerate(path)], columns=["genome", "strain", "place", "grp"])

    return edges.select("genome", "src", "dst", "weight").groupBy("genome").cogroup(depths.select("genome", "grp", "depth").groupBy("genome")).applyInPandas(one, f"genome {depths.schema['genome'].dataType.simpleString()}, strain int, place int, grp long")


def abundances(strains: list[tuple[int, list[int], list[float]]], eps: float = 1e-2) -> dict[int, float]:
    """strains: (strain, variant ids, weights). Expectation maximisation: each weight is shared among the strains of its variant by their current abundance."""
    of = defaultdict(list)
    for i, (_, ids, _) in enumerate(strains):
        for v in ids:
            of[v].append(i)
    theta = np.ones(len(strains))
    old = [np.array(w, float) for _, _, w in strains]
    while True:
        new = []
        for i, (_, ids, _) in enumerate(strains):
            pool = np.array([sum(theta[j] for j in of[v]) for v in ids])
            pool = np.where(pool <= eps, 1.0, pool)
            new.append(old[i] * theta[i] / pool if theta[i] > 0 else old[i] * 0)
        total = sum(w.sum() for w in old)
        got = np.array([w.sum() / total if total else math.nan for w in new])
        got = np.where(~np.isfinite(got) | (got < 0.01), 0.0, got)
        change = float(np.abs(got - theta).sum())
        theta, old = got, new
        if change <= eps:
            break
    return {s: float(t) for (s, _, _), t in zip(strains, theta)}


def strain_abundances(weights: DataFrame) -> DataFrame:
    """weights: (sample, strain, variant, weight). (sample, strain, abundance); a sample's strains and variants form one group, which is its model."""

    def one(key, pdf):
        s = [(int(k), g.variant.tolist(), g.weight.tolist()) for k, g in pdf.sort_values(["strain", "variant"]).groupby("strain")]
        return pd.DataFrame([(int(key[0]), k, v) for k, v in abundances(s).items()], columns=["sample", "strain", "abundance"])

    return weights.groupBy("sample").applyInPandas(one, "sample int, strain int, abundance double")


def strain_presence(ref_depth: DataFrame, share: float = 0.97) -> DataFrame:
    """ref_depth: (variant, sample, ref_ad). (variants, with_ref, present): the reference strain is present if that share of variants has reference depth in any sample."""
    v = ref_depth.groupBy("variant").agg(F.max("ref_ad").alias("m"))
    return v.agg(F.count("*").alias("variants"), F.sum(F.when(F.col("m") > 0, 1).otherwise(0)).alias("with_ref")).withColumn("present", F.col("with_ref") >= share * F.col("variants"))


_TABLE = {c: (a, n) for c, a, _, n in codon_table(11)}


@lru_cache(None)
def codon_change(before: str, after: str) -> tuple[float, float]:
    """(non-synonymous, synonymous) steps between two codons, averaged over all orders of the changes."""
    places = [i for i in range(3) if before[i] != after[i]]
    nd = sd = k = 0
    for order in permutations(places):
        at = before
        for i in order:
            to = at[:i] + after[i] + at[i + 1 :]
            if _TABLE[to][0] == _TABLE[at][0]:
                sd += 1
            else:
                nd += 1
            at = to
        k += 1
    return (nd / k, sd / k) if k else (0.0, 0.0)


def site_counts(gene: str) -> tuple[float, float]:
    """Non-synonymous and synonymous sites of a gene; codons with other letters or short ones are left out."""
    ns = [_TABLE[gene[i : i + 3]][1] for i in range(0, len(gene) - 2, 3) if gene[i : i + 3] in _TABLE]
    return sum(ns), 3 * len(ns) - sum(ns)


def dnds(gene: str, changes: list[tuple[int, str]]) -> float:
    """changes: (position in the gene, base). All of a codon's changes apply together; the last codon counts too."""
    n, s = site_counts(gene)
    by: dict[int, list[str]] = {}
    for p, b in sorted(changes):
        c = p // 3
        by.setdefault(c, list(gene[c * 3 : c * 3 + 3]))[p % 3] = b
    nd = sd = 0.0
    for c, new in by.items():
        old, to = gene[c * 3 : c * 3 + 3], "".join(new)
        if old in _TABLE and to in _TABLE:
            a, b = codon_change(old, to)
            nd, sd = nd + a, sd + b
    if not n or not s:
        return 1.0

    def d(p):
        p = 0.7499 if p == 0.75 else p
        return -0.75 * math.log(1 - 4 * p / 3) if p < 0.75 else math.nan

    dn, ds = d(nd / n), d(sd / s)
    if math.isnan(dn) or math.isnan(ds) or ds <= 2.3e-16:
        return 1.0
    return max(0.0, dn / ds)


def gene_dnds(genes: DataFrame, variants: DataFrame) -> DataFrame:
    """genes: (gene, tid, start, end, strand, seq), variants: (tid, pos, sample, alt). (gene, sample, snps, dnds); minus-strand genes are read from their reverse complement."""
    from .ranges import range_join

    g = genes.select("gene", F.col("tid").alias("g_tid"), F.col("start").alias("g_start"), F.col("end").alias("g_end"), "strand", "seq")
    j = range_join(g, variants.withColumn("pos_end", F.col("pos")), ("g_tid", "g_start", "g_end"), ("tid", "pos", "pos_end"), 1000)
    back = str.maketrans("ACGT", "TGCA")

    # a row for each gene and sample: rows, not groups, go to Python
    changes = F.collect_list(F.struct("pos", "alt"))
    first = [F.first(c).alias(c) for c in ("g_start", "g_end", "strand", "seq")]
    by = j.groupBy("gene", "sample").agg(*first, changes.alias("changes"))
    by = by.select("gene", "sample", "g_start", "g_end", "strand", "seq", F.transform("changes", lambda c: c["pos"]).alias("places"), F.transform("changes", lambda c: c["alt"]).alias("alts"))

    def run(batches):
        for b in batches:
            n, rates = [], []
            for start, end, strand, seq, places, alts in zip(*(b.column(i).to_pylist() for i in range(2, 8))):
                minus = strand == "-"
                seq = seq.translate(back)[::-1] if minus else seq
                ch = [(int(end - p), a.translate(back)) if minus else (int(p - start), a) for p, a in zip(places, alts)]
                n.append(len(ch))
                rates.append(dnds(seq, ch))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(pa.int32()), pa.array(n, pa.int32()), pa.array(rates, pa.float64())], ["gene", "sample", "snps", "dnds"])

    return by.mapInArrow(run, "gene long, sample int, snps int, dnds double")


def dnds_lines(genes: DataFrame, rates: DataFrame, samples: list[int]) -> DataFrame:
    """genes: (gene, tid, start, end), rates as of ``gene_dnds``. (gene, line): tid, gene, start and end from 1, then each sample's substitutions and each one's dN/dS with four decimals, tab-separated; 0 and 1 where a sample has none."""
    of = lambda k, c, none: F.coalesce(F.max(F.when(F.col("sample") == k, F.col(c))), F.lit(none))
    by = rates.groupBy("gene").agg(*[of(k, "snps", 0).alias(f"n{k}") for k in samples], *[of(k, "dnds", 1.0).alias(f"d{k}") for k in samples])
    j = genes.select("gene", "tid", "start", "end").join(by, "gene", "left")
    cells = [F.col("tid"), F.col("gene"), F.col("start") + 1, F.col("end") + 1, *[F.coalesce(f"n{k}", F.lit(0)) for k in samples]]
    return j.select("gene", F.concat_ws("\t", *[c.cast("string") for c in cells], *[F.format_string("%.4f", F.coalesce(f"d{k}", F.lit(1.0))) for k in samples]).alias("line"))


def splice(seq: str, variants: list[tuple[int, str, str]]) -> str:
    """Applies (offset, ref, alt) from left to right, carrying the shift of earlier ones; a variant inside a base that is already replaced is left out. ``*`` deletes all but the first base."""
    out, at = [], 0
    for p, ref, alt in sorted(variants):
        if p < at or ref == alt:
            continue
        out += [seq[at:p], ref[:1] if alt == "*" else alt]
        at = p + len(ref)
    return "".join([*out, seq[at:]])


def consensus(contigs: DataFrame, calls: DataFrame) -> DataFrame:
    """contigs: (tid, seq), calls: (sample, tid, pos, ref, alt). (sample, tid, seq, old_length, new_length, variations) of each sample's consensus."""

    def one(key, a, b):
        rows = []
        if len(a) and len(b):
            seq = a.seq.iloc[0]
            for sample, g in b.groupby("sample"):
                v = [(int(p), r, t) for p, r, t in zip(g.pos, g.ref, g.alt) if r != t]
                got = splice(seq, v)
                rows.append((int(sample), int(key[0]), got, len(seq), len(got), len(v)))
        return pd.DataFrame(rows, columns=["sample", "tid", "seq", "old_length", "new_length", "variations"])

    return contigs.groupBy("tid").cogroup(calls.groupBy("tid")).applyInPandas(one, "sample int, tid int, seq string, old_length long, new_length long, variations int")
