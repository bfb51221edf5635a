"""The caller's chain of one region: assembly, read likelihoods, events, genotype likelihoods and calls for each locus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import maths as M
from ..streaming.activity import shared_folder
from . import genotypes as G
from . import kernels as K

_EVENT = "struct<start:long,ref:string,alt:string>"
_EVENTS = pa.list_(pa.struct([("start", pa.int64()), ("ref", pa.string()), ("alt", pa.string())]))
#: Haplotypes of which a task holds the events.
_KNOWN = 1 << 14


def haplotype_events(regions: DataFrame, haplotypes: DataFrame) -> DataFrame:
    """regions: (region, start, ref); haplotypes as of ``assemble_regions``. Adds ``events``: array<struct<start, ref, alt>> against the reference."""

    def run(batches):
        known = {}
        for b in batches:
            rows = []
            for ref, hap, cigar, start in zip(*(b.column(n).to_pylist() for n in ("ref", "hap", "cigar", "start"))):
                if len(known) >= _KNOWN:
                    known.clear()
                if (ref, hap, cigar) not in known:
                    known[ref, hap, cigar] = K.events(ref, hap, cigar, 0)
                rows.append([{"start": start + p, "ref": x, "alt": y} for p, x, y in known[ref, hap, cigar]])
            kept = ["region", "hap_idx", "score", "hap", "cigar"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), pa.array(rows, _EVENTS)], [*kept, "events"])

    # no broadcast: the size of what Python returns is guessed from the small columns that it reads
    whole = haplotypes.join(regions.select("region", F.col("start").cast("long").alias("start"), "ref").hint("merge"), "region")
    return whole.mapInArrow(run, f"region long, hap_idx int, score double, hap string, cigar string, events array<{_EVENT}>")


def locus_likelihoods(reads: DataFrame, haplotypes: DataFrame) -> DataFrame:
    """reads: (region, sample, read, seq, quals); haplotypes with events. (region, sample, read, start, ref, alts, lks): for each start of events the longest ref of them, their alts on it,
    and log10 likelihoods of the read, the best over the haplotypes without an event there, then over those with each alt.

    One row of a read holds its region's haplotypes, of which assembly returns a bounded number. A deletion that spans a start from before counts as no event there."""
    pairs = reads.select(*[F.col(c).cast(t).alias(c) for c, t in (("region", "long"), ("sample", "int"), ("read", "long"))], F.col("seq").alias("read_seq"), "quals").join(haplotypes.select("region", F.col("hap").alias("hap_seq"), "events").hint("merge"), "region")

    def run(batches):
        for b in batches:
            haps, seqs = (b.column(n).to_pylist() for n in ("hap_seq", "read_seq"))
            lists = b.column("quals")
            sizes, flat = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes).tolist()
            # equal pairs are computed once
            keys = [(h, r, flat[e - n : e].tobytes()) for h, r, e, n in zip(haps, seqs, ends, sizes.tolist())]
            once = {k: i for i, k in reversed(list(enumerate(keys)))}
            got = K.pair_hmm_all([k[:2] for k in once], [flat[ends[i] - sizes[i] : ends[i]] for i in once.values()])
            lk = dict(zip(once, got.tolist()))
            kept = ["region", "sample", "read", "events"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), pa.array([lk[k] for k in keys], pa.float64())], [*kept, "lk"])

    scored = pairs.mapInArrow(run, f"region long, sample int, read long, events array<{_EVENT}>, lk double")
    by_read = scored.groupBy("region", "sample", "read").agg(F.collect_list(F.struct("events", "lk")).alias("haps"))
    every = by_read.withColumn("all", F.array_sort(F.array_distinct(F.flatten(F.transform("haps", lambda h: h["events"])))))
    at = every.withColumn("start", F.explode(F.array_distinct(F.transform("all", lambda e: e["start"])))).withColumn("here", F.filter("all", lambda e: e["start"] == F.col("start")))
    at = at.withColumn("ref", F.array_max(F.transform("here", lambda e: F.struct(F.length(e["ref"]).alias("n"), e["ref"].alias("ref"))))["ref"])
    best = lambda keep: F.array_max(F.transform(F.filter("haps", keep), lambda h: h["lk"]))
    without = best(lambda h: ~F.exists(h["events"], lambda e: e["start"] == F.col("start")))
    alts = F.transform("here", lambda e: F.concat(e["alt"], F.substr(F.col("ref"), F.length(e["ref"]) + 1)))
    lks = F.concat(F.array(without), F.transform("here", lambda e: best(lambda h: F.array_contains(h["events"], e))))
    return at.select("region", "sample", "read", "start", "ref", alts.alias("alts"), lks.alias("lks"))


def call_regions(regions: DataFrame, reads: DataFrame, ploidy: int = 2, confidence: float = 25.0, **how) -> DataFrame:
    """(region, start, alleles, qual, polymorphic, emitted, mle_ac, mle_af, genotypes, dp, an, ac, af, qd): the sites that assembly finds, all alts of a start together.

    regions: (region, start, ref), reads: (region, sample, read, seq, quals)."""
    haps = haplotype_events(regions, K.assemble_regions(regions, reads.select("region", "seq", "quals"), **how))
    lk = locus_likelihoods(reads, haps).select(F.struct("region", "start", "ref", "alts").alias("site"), "sample", "read", "lks")
    # read once for each number of alleles: written, or each would assemble anew
    path = f"{shared_folder(regions.sparkSession)}.lk"
    lk.write.parquet(path)
    lk = regions.sparkSession.read.schema(lk.schema).parquet(path)
    gl = None
    for n in range(2, (lk.agg(F.max(F.size("lks"))).first()[0] or 2) + 1):  # sites of n alleles each
        part = G.genotype_likelihoods(lk, n, ploidy, depths=True)
        gl = part if gl is None else gl.unionByName(part)
    samples = F.collect_list(F.struct("sample", M.gls_to_pls(F.col("gl")).alias("pl"), "ad")).alias("samples")
    sites = gl.groupBy("site").agg(samples).withColumn("alleles", F.concat(F.array("site.ref"), "site.alts")).withColumn("site", F.struct("site.region", "site.start"))
    return G.call_annotations(G.call_genotypes(sites, ploidy, confidence)).select("site.*", "*").drop("site")
