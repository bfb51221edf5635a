"""Regions that placed reads settle, held against the graphs."""

import random
from collections import Counter

from pyspark.sql import functions as F

from cladeframe.operators import kernels as K
from cladeframe.operators import placed as P


def other(base):
    return {"A": "C", "C": "G", "G": "T", "T": "A"}[base]


def changed(ref, x):
    return ref[:x] + other(ref[x]) + ref[x + 1 :]


def tiled(hap, size, step, start=0):
    return Counter(hap[p : p + size] for p in range(start, max(len(hap) - size + 1, start + 1), step))


def made(rng, n, x=None, size=40, step=7, repeat=0):
    ref = "".join(rng.choice("ACGT") for _ in range(n))
    if repeat:
        ref = ref[: n - repeat] + ref[:repeat]
    hap = ref if x is None else changed(ref, x)
    return ref, tuple(sorted((tiled(hap, size, step) + (tiled(ref, size, 11) if rng.random() < 0.5 else Counter())).items()))


def regions(seed):
    rng = random.Random(seed)
    out = [made(rng, n, x, size, step) for n in (8, 26, 60, 150) for x in (None, 0, 3, n // 2, n - 20, n - 2) if x is None or 0 <= x < n for size, step in ((40, 7), (30, 15), (60, 1))]
    out += [made(rng, 150, rng.randrange(150), 40, 9, repeat) for repeat in (8, 12, 20, 40, 70) for _ in range(4)]
    ref, pieces = made(rng, 150, 70)
    out.append((ref, tuple(sorted((Counter(dict(pieces)) + tiled(changed(ref, 75), 40, 7)).items()))))  # two places
    out.append((ref, tuple(sorted(tiled(ref[:60] + ref[63:], 40, 7).items()))))  # a deletion
    out.append((ref[:50] + "N" + ref[51:], pieces))
    out.append((ref, tuple(sorted(tiled("ACGTT" * 6 + ref, 40, 7).items()))))  # reads from before the region
    return out


def differing(jobs, *how):
    """How many regions are settled without a graph, and with another haplotype; all are as by graphs."""
    prune, sizes, by_odds, recover = how
    lie = P.of(jobs, min(P.LONGEST, *sizes))
    got = K.settled(lie, *lie.haplotypes(sizes, prune, 6, by_odds, recover))
    want = K._by_graphs(list(dict.fromkeys(jobs)), sizes, prune, 128, 6, by_odds, recover)
    assert all(g is None or g == want[j] for j, g in zip(jobs, got))
    return sum(g is not None for g in got), sum(len(g or ()) > 1 for g in got)


def test_ends_are_recovered_without_graphs(monkeypatch):  # gen04
    jobs = regions(1)
    for how in ((1, (9,), False, 1), (2, (9, 13), False, 1), (0, (25,), False, 4), (3, (11,), False, None)):
        sure, two = differing(jobs, *how)
        assert sure > 0.6 * len(jobs) and two > 3
    built = []
    monkeypatch.setattr(K, "Graph", lambda *a: built.append(a) or 1 / 0)
    tail = [made(random.Random(k), 240, 219, 70, 15) for k in range(20)]
    found = K.assemble_all([(ref, Counter(dict(pieces))) for ref, pieces in tail], (25,), 1)
    assert not built and all([h for _, h, _ in f] == [ref, changed(ref, 219)] for (ref, _), f in zip(tail, found))


def test_rows_hold_their_reads(spark):  # gen04
    rng = random.Random(5)
    rows, flat = [], []
    for region, (ref, pieces) in zip([1, 2, 2, None, *range(5, 30)], regions(2)[20:]):
        reads = [(s, [rng.choice((30, 30, 30, 9, 12)) if region and region % 3 == 0 else 30] * len(s)) for s, n in pieces for _ in range(n)]
        rows.append((region, ref, [(s, "".join(chr(33 + x) for x in q)) for s, q in reads]))
        flat += [(region, s, q) for s, q in reads]
    rows[2] = (2, rows[1][1], rows[2][2])  # one reference for the rows of a region
    rows.append((99, "ACGTTGCAACCGTAGGCTAAC", []))
    nested = spark.createDataFrame(rows, "region long, ref string, reads array<struct<seq string, quals string>>").repartition(3, "region").sortWithinPartitions("region")
    refs = spark.createDataFrame([r[:2] for k, r in enumerate(rows) if k != 2], "region long, ref string").withColumn("start", F.lit(0))
    reads = spark.createDataFrame(flat, "region long, seq string, quals array<int>")
    for how in ({"prune": 1}, {"prune": 0, "depth": 5}, {"by_odds": True, "recover": None}):
        got, want = K.assemble_rows(nested, (9,), **how), K.assemble_regions(refs, reads, (9,), **how)
        key = lambda r: (r.region is None, r.region or 0, r.hap_idx)
        assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert K.assemble_rows(nested.limit(0), (9,)).count() == 0


def test_profiles_are_counted_in_one_pass(spark):  # gen33
    rows = [(k, ref, [(s, "?" * len(s)) for s, n in pieces for _ in range(n)]) for k, (ref, pieces) in enumerate(regions(3))]
    rows += [(100 + k, ref, [(s, "?" * 70) for s, _ in pieces]) for k, (ref, pieces) in enumerate(made(random.Random(k), 240, 219, 70, 15, (0, 60)[k % 2]) for k in range(8))]
    nested = spark.createDataFrame(rows, "region long, ref string, reads array<struct<seq string, quals string>>")
    out = K.count_haplotypes(nested, K.PROFILES)
    assert out._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1
    want = {}
    for name, (prune, sizes) in K.PROFILES.items():
        jobs = {region: (ref, tuple(sorted(Counter(s for s, _ in reads if not set(s) - set("ACGT")).items()))) for region, ref, reads in rows}
        got = K._by_graphs(list(dict.fromkeys(jobs.values())), sizes, prune, 128, 6, False, 1)
        want |= {(region, name): len(got[job]) for region, job in jobs.items()}
    assert {(r.region, r.profile): r.haplotypes for r in out.collect()} == want and 2 in want.values()


def test_pruning_by_odds_of_placed_reads(monkeypatch):  # gen03
    jobs = regions(4)
    for sizes, recover in (((9,), None), ((25,), None), ((9, 13), 1)):
        assert differing(jobs, 1, sizes, True, recover)[0] > 0.3 * len(jobs)
    monkeypatch.setattr(K, "Graph", lambda *a: 1 / 0)
    line = "ACGTTGCAACCGTAGGCTAACTTAGGCCATGCATCGGA"
    ends = [made(random.Random(k), 240, 219, 70, 15) for k in range(20)] + [(line * 6, tuple(sorted(tiled(changed(line * 6, 200), 70, 15).items())))]
    found = K.assemble_all([(ref, Counter(dict(pieces))) for ref, pieces in ends], (25,), by_odds=True, recover=None)
    assert [[h for _, h, _ in f] for f in found] == [[ref] for ref, _ in ends]


def test_pruning_by_odds_of_repeats():  # gen03
    rng = random.Random(8)
    unit = lambda: "".join(rng.choice("ACGT") for _ in range(rng.randrange(2, 12)))
    refs = [(unit() * 40)[: rng.randrange(30, 120)] + (unit() * 60)[:120] + (unit() * 10)[: rng.randrange(20)] for _ in range(40)]
    refs += ["".join(rng.choice("ACGT") for _ in range(n)) for n in range(26, 46)]  # shorter than a read, each window with the differing base
    jobs = [(ref, tuple(sorted(tiled(changed(ref, len(ref) - 21), 70, 15).items()))) for ref in refs]
    assert differing(jobs, 1, (25,), True, None)[0] > 0.95 * len(jobs)
    ref = made(rng, 60)[0] + "ACGTTGAC" * 15
    reached = [(ref, tuple(sorted(tiled("GATTACA" * 4 + ref, size, 7).items()))) for size in (40, 70)]
    assert differing(reached, 1, (25,), True, None)[0] == 0
    for size in (2, 5, 9):
        lie = P.of(jobs, size)
        for k in (2 * size, 57, 3 * size + 1, 128, size, 25):
            assert lie.longer(k).tolist() == [len({r[i : i + k] for i in range(len(r) - k + 1)}) < len(r) - k + 1 for r in refs]


def test_whole_texts_with_repeats(monkeypatch):  # gen10
    rng = random.Random(6)
    jobs = []
    for n, repeat in ((900, 0), (900, 30), (900, 45), (900, 200), (1500, 60)):
        ref, pieces = made(rng, n, n // 2, 75, 15, repeat)
        jobs.append((ref, pieces))
    assert differing(jobs, 2, (25,), False, 1)[0] >= 4
    monkeypatch.setattr(K, "Graph", lambda *a: 1 / 0)
    assert [len(f) for f in K.assemble_all([(ref, Counter(dict(pieces))) for ref, pieces in (jobs[0], jobs[3])], (25,), 2)] == [2, 1]
