import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeframe.functions import cigars as C
from cladeframe.functions import intervals as I
from cladeframe.functions import maths as M
from cladeframe.functions import sequences as S
from cladeframe.operators import activity as A
from cladeframe.operators import calling as CA
from cladeframe.operators import genotypes as G
from cladeframe.operators import kernels as K
from cladeframe.operators import ranges as R
from cladeframe.operators import realign as RA
from cladeframe.operators import strains as ST
from cladeframe.operators import variants as V
from cladeframe.sources import files
from cladeframe.streaming import activity as stream

lit = F.lit


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_intervals(spark):
    o = lambda a, b, t=0: I.overlaps(lit(0), lit(10), lit(20), lit(t), lit(a), lit(b))
    assert one(spark, o(1, 9), o(1, 10), o(20, 25), o(21, 25), o(12, 13, 1)) == (False, True, True, False, False)


def test_repeats(spark):
    assert one(spark, S.trailing_repeats(lit("AT"), lit("GATAT")), S.leading_repeats(lit("AT"), lit("GATAT")), S.leading_repeats(lit("A"), lit("ATATG")), S.leading_repeats(lit("AT"), lit("ATATG"))) == (2, 0, 1, 2)
    assert one(spark, S.repeat_unit(lit("ATATAT")), S.repeat_unit(lit("ATG"))) == ("AT", "ATG")
    assert RA.tandem_unit("GATATATC", 4) == ("AT", 3)


def test_running_average(spark):
    d = spark.createDataFrame([(float(x),) for x in (1, 2, 4, 5, 3, 128, 25678, -24)], "x double")
    m, sd = d.agg(F.avg("x"), F.stddev_samp("x")).first()
    assert m == 3224.625 and abs(sd - 9072.6515881128) < 1e-6


def test_log10_sum(spark):
    a, b = one(spark, M.log10_sum(F.array(lit(0.0), lit(0.0), lit(0.0))), M.log10_sum(F.array().cast("array<double>")))
    assert abs(a - math.log10(3)) < 1e-12 and b == -math.inf


def test_digamma_and_ratio(spark):
    x, y = one(spark, M.digamma(lit(1.0)), M.digamma(lit(7.25)))
    assert abs(x + 0.5772156649015329) < 1e-9 and abs(y - 1.9104535) < 1e-5
    lb = math.lgamma(101) + math.lgamma(6) - math.lgamma(107)
    got = one(spark, RA.log_likelihood_ratio(lit(100), F.array_repeat(lit(40), 5)))[0]
    assert abs(got - (lb - 5 * math.log(1e-4))) < 0.07 * abs(lb - 5 * math.log(1e-4))


def test_event_map():
    assert K.events("TTTGGGAAA", "TTTCCCAAA", "3M3X3M".replace("X", "M"), 0, 1)[0][1:] == ("GGG", "CCC")
    assert [e[1:] for e in K.events("TTTGGGAAA", "TTTCCCAAA", "9M", 0, 0)] == [("G", "C")] * 3
    assert K.events("ACGT", "ACTTGT", "2M2I2M", 10) == [(11, "C", "CTT")] and K.events("ACGGT", "ACT", "2M2D1M", 0) == [(1, "CGG", "C")]


def test_splice():
    ref = "A" * 100
    assert ST.splice(ref, [(0, "A", "C")])[:2] == "CA"
    assert len(ST.splice(ref, [(6, "A", "ACCCCCC")])) == 106 and len(ST.splice(ref, [(1, "AAAAAA", "A")])) == 95
    assert ST.splice("ACGTACGT", [(0, "A", "T"), (2, "GT", "G"), (4, "A", "ACC"), (6, "GT", "*")]) == "TCGACCCG"


def test_genotype_order_and_tag():
    assert G.genotypes(2, 3) == [(0, 0), (0, 1), (1, 1), (0, 2), (1, 2), (2, 2)]
    assert len(G.genotypes(4, 3)) == math.comb(3 + 4 - 1, 4)


def test_allele_frequency_symmetry():
    for low in ([0.0, -2.0, -100.0], [-2.0, 0.0, -2.0]):
        a, none, _ = G.allele_frequencies([low], ["A", "C"])
        assert abs(a.sum() - 2) < 1e-6 and none <= 0
    hom, _, _ = G.allele_frequencies([[-100.0, -2.0, 0.0]] * 10, ["A", "C"])
    assert hom[1] > 19


def slow_hmm(hap, read, q, ins=45, dele=45, gcp=10):
    e = [10 ** (-x / 10) for x in q]
    mi, md, g = 10 ** (-ins / 10), 10 ** (-dele / 10), 10 ** (-gcp / 10)
    n, r = len(hap), len(read)
    m = [[0.0] * (n + 1) for _ in range(r + 1)]
    i = [[0.0] * (n + 1) for _ in range(r + 1)]
    d = [[0.0] * (n + 1) for _ in range(r + 1)]
    d[0] = [1.0 / n] * (n + 1)
    for a in range(1, r + 1):
        for b in range(1, n + 1):
            p = 1 - e[a - 1] if read[a - 1] == hap[b - 1] else e[a - 1] / 3
            m[a][b] = p * (m[a - 1][b - 1] * (1 - mi - md) + (i[a - 1][b - 1] + d[a - 1][b - 1]) * (1 - g))
            i[a][b] = m[a - 1][b] * mi + i[a - 1][b] * g
            d[a][b] = m[a][b - 1] * md + d[a][b - 1] * g
    return math.log10(sum(m[r][1:]) + sum(i[r][1:]))


def test_pair_hmm_matches_recurrence():
    rng = random.Random(0)
    for _ in range(20):
        hap = "".join(rng.choice("ACGT") for _ in range(rng.randrange(5, 25)))
        read = "".join(rng.choice("ACGT") for _ in range(rng.randrange(2, 15)))
        q = [rng.randrange(5, 40) for _ in read]
        assert abs(K.pair_hmm(hap, read, q) - slow_hmm(hap, read, q)) < 1e-9


def score(ref, alt, offset, cigar, p):
    i, j, s = offset, 0, 0
    for n, op in RA.parse(cigar):
        if op == "M":
            s += sum(p[0] if ref[i + x] == alt[j + x] else p[1] for x in range(n))
            i, j = i + n, j + n
        else:
            s += p[2] + p[3] * (n - 1)
            i, j = i + n * (op == "D"), j + n * (op == "I")
    assert j == len(alt) and i == len(ref)
    return s


def best(ref, alt, p):
    n, m = len(ref), len(alt)
    lo = -1e18
    t = {k: np.full((n + 1, m + 1), lo) for k in "MID"}
    t["M"][0, 0] = 0
    for i, j in itertools.product(range(n + 1), range(m + 1)):
        if i and j:
            t["M"][i, j] = max(t[k][i - 1, j - 1] for k in "MID") + (p[0] if ref[i - 1] == alt[j - 1] else p[1])
        if i:
            t["D"][i, j] = max(max(t["M"][i - 1, j], t["I"][i - 1, j]) + p[2], t["D"][i - 1, j] + p[3])
        if j:
            t["I"][i, j] = max(max(t["M"][i, j - 1], t["D"][i, j - 1]) + p[2], t["I"][i, j - 1] + p[3])
    return max(t[k][n, m] for k in "MID")


def test_alignment_is_optimal():
    rng = random.Random(1)
    for _ in range(40):
        ref = "".join(rng.choice("AC") for _ in range(rng.randrange(3, 12)))
        alt = "".join(rng.choice("AC") for _ in range(rng.randrange(3, 12)))
        off, cigar = K.align(ref, alt, K.NEW_SW, "indel")
        assert abs(score(ref, alt, off, cigar, K.NEW_SW) - best(ref, alt, K.NEW_SW)) < 1e-9
    assert K.align("AACCGGTT", "CCGG") == (2, "4M")


def slow_align(ref, alt, p, overhang):
    """By the definition: every gap length is tried in every cell; the longest gap among equals."""
    n, m = len(ref), len(alt)
    charged = overhang in ("indel", "leading_indel")
    if not charged and alt in ref:
        return ref.rfind(alt), f"{m}M"
    cost = lambda k: p[2] + p[3] * (k - 1)
    top, way = {}, {}
    for i, j in itertools.product(range(n + 1), range(m + 1)):
        if not i or not j:
            top[i, j] = cost(i + j) if charged and i + j else 0
            continue
        ways = [(top[i - 1, j - 1] + (p[0] if ref[i - 1] == alt[j - 1] else p[1]), 2, 1, "M")]
        ways += [(top[i, j - k] + cost(k), 1, k, "I") for k in range(1, j + 1)]
        ways += [(top[i - k, j] + cost(k), 0, k, "D") for k in range(1, i + 1)]
        top[i, j], _, *way[i, j] = max(ways)
    if overhang == "indel":
        i, j = n, m
    else:
        ends = [((top[a, m], a), (a, m)) for a in range(1, n + 1)]
        i, j = max(ends)[1]
        if not charged:
            a, b = max(((top[n, b], -abs(n - b), -b), (n, b)) for b in range(1, m + 1))[1]
            if (top[a, b], -abs(a - b)) > (top[i, j], -abs(i - j)):
                i, j = a, b
    outer = {"soft_clip": "S", "ignore": "M"}.get(overhang, "I")
    ops = outer * (m - j)
    while i and j:
        k, op = way[i, j]
        ops = op * k + ops
        i, j = i - k * (op != "I"), j - k * (op != "D")
    ops = (("D" * i if charged else "") + outer * j) + ops
    at = 0 if charged else i if overhang == "soft_clip" else i - j
    return at, "".join(f"{len(list(g))}{op}" for op, g in itertools.groupby(ops))


@pytest.mark.parametrize("overhang", ["soft_clip", "ignore", "indel", "leading_indel"])
def test_alignment_against_definition(overhang):
    rng = random.Random(7)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 16)))
    pairs = [(word(x), word(x)) for x in ("AC", "ACGT") for _ in range(60)]
    for p in (K.ORIGINAL, K.STANDARD, K.NEW_SW, RA.TO_BEST_HAPLOTYPE):
        assert K.align_all(pairs, p, overhang, cells=2000) == [slow_align(a, b, p, overhang) for a, b in pairs]


def test_alignment_cases():
    assert K.align("AAAGGACTGACTG", "ACTGACTGACTG", K.ORIGINAL) == (1, "12M")
    assert K.align("AAAGACTACTG", "AACGGACACTG", (50, -100, -220, -12)) == (1, "2M2I3M1D4M") and K.align("AAAGACTACTG", "AACGGACACTG", (200, -50, -300, -22)) == (0, "11M")
    assert K.align("AAACCCCC", "CCCCCGGG", K.ORIGINAL) == (3, "5M3S")
    assert K.align("TG" * 7 + "AC" + "AG" * 14 + "A", "AC" + "AG" * 24 + "A", K.STANDARD) == (14, "31M20S")
    assert [K.align("AAACCCCC", "CCCCC", K.ORIGINAL, o) for o in ("soft_clip", "indel", "leading_indel", "ignore")] == [(3, "5M"), (0, "3D5M"), (0, "3D5M"), (3, "5M")]


def test_alignment_edges():
    assert K.align_all([]) == [] and K.align("ACGT", "") == (4, "") and K.align("", "ACG") == (0, "3S") and K.align("ACG", "", K.NEW_SW, "indel") == (0, "3D")


def test_pair_hmm_in_batches():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    pairs = [(word(rng.randrange(1, 40)), word(rng.randrange(1, 30))) for _ in range(80)] + [("", "A"), ("A", "")]
    quals = [[rng.randrange(5, 40) for _ in r] for _, r in pairs]
    got = K.pair_hmm_all(pairs, quals, cells=100)
    assert np.allclose(got[:-2], [slow_hmm(h, r, q) for (h, r), q in zip(pairs[:-2], quals)], atol=1e-9) and not got[-2:].any()


def test_assembly_finds_planted_variants():
    rng = random.Random(1)
    ref = "".join(rng.choice("ACGT") for _ in range(220))
    alt = ref[:90] + ("A" if ref[90] != "A" else "C") + ref[91:130] + "GATTACA" + ref[130:]
    reads = [(alt[i : i + 80], [30] * 80) for i in range(0, len(alt) - 79, 4)]
    haps = {h for _, h, _ in K.assemble(ref, reads)}
    assert ref in haps and alt in haps
    noisy = reads + [(ref[20:60] + "T" + ref[61:100], [30] * 80)]
    assert len(K.assemble(ref, noisy, prune=2)) <= len(K.assemble(ref, noisy, prune=0))


def test_left_align_and_clip():
    assert RA.left_align("GGATATATCC", 0, "6M2D2M", "GGATATCC") == "2M2D6M"
    assert RA.clip_to(10, "5M2D5M", "ACGTACGTAC", 12, 18) == (12, "2H3M2D2M3H", "GTACG")
    assert RA.clip_to(10, "5M", "ACGTA", 50, 60) is None


def test_phase():
    a, b = frozenset({1, 2}), frozenset({3})
    assert RA.phase([(5, a), (9, b), (12, a)], a | b) == {0: (5, "0|1"), 1: (5, "1|0"), 2: (5, "0|1")}
    assert RA.phase([(5, frozenset({1})), (9, frozenset({2}))], frozenset({1, 2, 3})) == {}


def test_codons_and_dnds():
    assert ST.codon_change("TTT", "TTC") == (0.0, 1.0)
    n, s = ST.site_counts("ATGTTT")
    assert abs(n + s - 6) < 1e-9
    assert ST.dnds("ATGTTTGGG", []) == 1.0 and ST.dnds("ATGTTTGGGCCC" * 5, [(5, "C"), (0, "T")]) > 0


def test_strain_paths():
    assert ST.strain_paths([], {1: 3.0, 2: 1.0}) == [[1], [2]]
    assert ST.strain_paths([(1, 2, 0.5), (1, 3, 0.4)], {1: 10.0, 2: 4.0, 3: 5.0}) == [[1, 3], [1, 2]]


def slow_regions(probs, threshold, smallest, largest, padding):
    """State by state, as the definition says."""
    out, at, n = [], 0, len(probs)
    while at < n:
        on, end = probs[at] > threshold, at
        while end < n and end - at < largest and (probs[end] > threshold) == on:
            end += 1
        if on and end - at == largest:
            best = None
            for i in range(end - 1, at + smallest - 1, -1):
                if 1 <= i < n - 1 and probs[i] <= probs[i + 1] and probs[i] < probs[i - 1] and (best is None or probs[i] < probs[best]):
                    best = i
            end = end if best is None else best + 1
        out.append((at, end - 1, on, sum(p > 0.05 for p in probs[at:end]) / (end - at), max(0, at - padding), min(n - 1, end - 1 + padding)))
        at = end
    return out


def test_regions_against_definition(spark):
    rng = random.Random(4)
    probs = {0: [0.9] * 40, 1: [round(rng.random(), 2) for _ in range(900)], 2: [round(abs(math.sin(i / 9)), 1) for i in range(700)], 3: [0.0] * 25, 4: [0.5 + 0.01 * (i % 7) for i in range(333)], 5: [0.4] * 30 + [0.0]}
    rows = [(t, i, p) for t, ps in probs.items() for i, p in enumerate(ps)]
    d = spark.createDataFrame(rows, "tid int, pos long, prob double")
    for threshold, smallest, largest in ((0.3, 5, 20), (0.05, 10, 50), (0.002, 50, 300)):
        got = sorted(tuple(r) for r in A.regions(d, threshold, smallest, largest, 15).collect())
        assert got == sorted((t, s, e, a, x, lo, hi) for t, ps in probs.items() for s, e, a, x, lo, hi in slow_regions(ps, threshold, smallest, largest, 15))
    # missing states are zeros, and a longer contig leaves room for padding
    few = spark.createDataFrame([(7, 10, 0.9), (7, 14, 0.9)], "tid int, pos long, prob double")
    got = sorted((r.start, r.end, r.active, r.padded_end) for r in A.regions(few, padding=3, lengths=spark.createDataFrame([(7, 16)], "tid int, length long")).collect())
    assert got == [(10, 10, True, 13), (11, 13, False, 15), (14, 14, True, 15)]
    assert A.regions(few.limit(0)).count() == 0


def test_best_cuts(spark):
    ps = [0.9, 0.8, 0.7, 0.8, 0.7, 0.7, 0.9, 0.1, 0.9, 0.05, 0.9]
    d = spark.createDataFrame([(0, i, p) for i, p in enumerate(ps)], "tid int, pos long, prob double")
    assert [tuple(r) for r in A.best_cuts(d, 8, 1).orderBy("piece").collect()] == [(0, 0, 8), (0, 1, 10)]
    assert [tuple(r) for r in A.best_cuts(d.where("pos < 7"), 100, 2).collect()] == [(0, 0, 5)]


def test_binned_operators_match_whole_contigs(spark):
    rng = random.Random(6)
    rows = [(t, s, s + rng.choice([0, 1, 5, 40, 900])) for t in range(3) for s in rng.choices(range(3000), k=120)] + [(3, 0, 5000), (3, 10, 12), (3, 4999, 6000), (3, 6002, 6003)]
    d = spark.createDataFrame(rows, "t int, s int, e int")

    def merged(rows, gap):
        out = []
        for s, e in sorted(rows):
            if out and s <= out[-1][1] + 1 + gap:
                out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + 1)
            else:
                out.append((s, e, 1))
        return out

    for gap in (0, 3):
        want = sorted((t, *x) for t in range(4) for x in merged([(s, e) for k, s, e in rows if k == t], gap))
        for size in (7, 64, 1 << 20):
            assert sorted(map(tuple, R.merge_contiguous(d, "t", "s", "e", gap, size).select("t", "s", "e", "merged").collect())) == want
    for size in (16, 1 << 20):
        got = sorted((r.t, r.s, r.e, r.up) for r in R.covered_upstream(d, "t", "s", "e", "up", size).collect())
        assert got == sorted((t, s, e, any(k == t and a < s <= b for k, a, b in rows)) for t, s, e in rows)
    states = [(t, p, rng.random() < 0.8) for t in range(2) for p in rng.sample(range(400), 350)] + [(2, p, True) for p in range(100)] + [(3, p, None if p < 40 else False) for p in range(80)]
    d = spark.createDataFrame(states, "t int, p int, on boolean")

    def runs(rows):
        out = []
        for p, on in sorted(rows, key=lambda x: x[0]):
            if out and out[-1][0] is on and out[-1][2] == p - 1:
                out[-1] = (on, out[-1][1], p, out[-1][3] + 1)
            else:
                out.append((on, p, p, 1))
        return out

    want = sorted(((t, *x) for t in range(4) for x in runs([(p, on) for k, p, on in states if k == t])), key=str)
    for size in (1, 8, 50, 1 << 20):
        assert sorted(map(tuple, R.run_lengths(d, ["t"], "p", F.col("on"), size).select("t", "state", "start", "end", "n").collect()), key=str) == want


def test_kmer_rows(spark):
    rng = random.Random(1)
    seqs = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (0, 4, 5, 6, 16, 17, 200)]
    got = S.kmer_rows(spark.createDataFrame([(x,) for x in [*seqs, None]], "seq string"), "seq", 5, size=12).collect()
    assert sorted(r.k for r in got) == sorted(x[i : i + 5] for x in seqs for i in range(len(x) - 4))


def test_range_join_matches_brute_force(spark):
    rng = random.Random(3)
    a = [(i, rng.randrange(2), s, s + rng.randrange(200)) for i, s in enumerate(rng.choices(range(1000), k=80))]
    b = [(i, rng.randrange(2), s, s + rng.randrange(30)) for i, s in enumerate(rng.choices(range(1000), k=80))]
    left, right = spark.createDataFrame(a, "a int, t int, s int, e int"), spark.createDataFrame(b, "b int, t2 int, s2 int, e2 int")
    for margin in (0, 15):
        got = sorted((r.a, r.b) for r in R.range_join(left, right, ("t", "s", "e"), ("t2", "s2", "e2"), 50, margin).collect())
        assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] + margin and y[2] <= x[3] + margin)


def test_range_join_of_deep_bins_and_chosen_bins(spark):
    rng = random.Random(5)
    a = [(i, 0, s, s + rng.randrange(40)) for i, s in enumerate(rng.choices(range(30), k=120))] + [(500 + i, 1, s, s) for i, s in enumerate(rng.choices(range(900), k=30))]
    b = [(i, rng.randrange(2), s, s + rng.randrange(300)) for i, s in enumerate(rng.choices(range(900), k=40))]
    left, right = spark.createDataFrame(a, "a int, t int, s int, e int"), spark.createDataFrame(b, "b int, t2 int, s2 int, e2 int")
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    for how in ({}, {"deep": 7}, {"bin_size": 16, "deep": 10}):
        assert sorted((r.a, r.b) for r in R.range_join(left, right, ("t", "s", "e"), ("t2", "s2", "e2"), **how).collect()) == want
    assert R.range_join(left, right.limit(0), ("t", "s", "e"), ("t2", "s2", "e2")).count() == 0


def test_read_tables_and_sets(spark, tmp_path):
    from cladeframe.sources import tables

    rows = [(g, f"c{g}", i, i * 10, i * 10 + 30) for g in range(3) for i in range(400)] + [(None, "u", 1, 1, 2)]
    tables.write_reads(spark.createDataFrame(rows, "genome int, contig string, rid int, start long, end long"), str(tmp_path / "r"), bin_size=500)
    scan = tables.scan_reads(spark, str(tmp_path / "r"), "c1", 1000, 1100, genome=1, longest=40)
    assert sorted(r.rid for r in scan.collect()) == [i for i in range(400) if i * 10 <= 1100 and i * 10 + 30 >= 1000]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = tables.scan_reads(spark, str(tmp_path / "r"), "c1", 1000, 1100, genome=1, longest=40)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(genome" in plan and "GreaterThanOrEqual(start,960)" in plan and "EqualTo(contig,c1)" in plan
    assert tables.scan_reads(spark, str(tmp_path / "r")).count() == len(rows)
    sets = [tuple(r) for r in tables.read_sets(spark, ["a1", "a2", "b1", "b2"], ["i"], ["s"], ["f"], ["r"], ["l"]).collect()]
    assert [(x[1], x[2], x[3], x[4]) for x in sets] == [("short", "coupled", "a1", "a2"), ("short", "coupled", "b1", "b2"), ("short", "coupled", "f", "r"), ("short", "interleaved", "i", None), ("short", "single", "s", None), ("long", "single", "l", None)]
    for bad in ({"coupled": ["a"]}, {"read1": ["a"], "read2": []}):
        with pytest.raises(ValueError):
            tables.read_sets(spark, **bad)


def test_ani_by_hand(spark):
    ad = spark.createDataFrame([(1, 0, [9, 0, 0]), (1, 1, [0, 9, 0]), (2, 0, [5, 5, 0]), (2, 1, [5, 0, 0]), (3, 0, [0, 0, 9]), (3, 1, [9, 0, 0])], "site int, sample int, ad array<int>").withColumn("lens", F.array(lit(1), lit(1), lit(3)))
    got = {(r.s1, r.s2): (r.con, r.pop, r.subpop) for r in V.identity_counts(ad, 5).collect()}
    assert got[0, 1] == (3.0, 3.0, 4.0) and got[0, 0] == (2.0, 3.0, 3.0) and got[1, 1] == (1.0, 1.0, 1.0)


def test_cigars(spark):
    c = C.parse(lit("2H3S10M2I5M4D1M2S"))
    assert one(spark, C.reference_length(c), C.read_length(c), C.clip_left(c), C.clip_right(c), C.is_valid(c), C.consecutive_indels(c)) == (20, 23, 3, 2, True, False)
    assert one(spark, C.is_valid(C.parse(lit("3M2S4M"))), C.ends_in_deletion(C.parse(lit("2S3M1D"))), C.consecutive_indels(C.parse(lit("3M1I1D3M")))) == (False, True, True)


def test_files(spark, tmp_path):
    (tmp_path / "g1.fna").write_text(">seq1 first one\nAC\nGT\n>other~seq2\nTTTT\n")
    got = sorted(map(tuple, files.read_fasta(spark, str(tmp_path / "g1.fna")).collect()))
    assert got == [("g1", "seq1", "first one", "ACGT", 4), ("other", "seq2", "", "TTTT", 4)]
    (tmp_path / "a.gff").write_text("##gff-version 3\nc1\tf\tCDS\t1\t9\t5.5\t-\t0\tID=1_1;partial=00\n")
    g = files.read_gff(spark, str(tmp_path / "a.gff")).first()
    assert (g.start, g.end, g.score, g.frame, g.attributes["ID"]) == (0, 8, 5.5, 0, "1_1")
    (tmp_path / "a.sam").write_text("@SQ\tSN:c1\tLN:9\nr1\t99\tc1\t5\t60\t3M1I\t=\t9\t8\tACGT\tII#I\tXX:Z:a\tNM:i:2\n")
    r = files.read_sam(spark, str(tmp_path / "a.sam")).first()
    assert (r.pos, r.mcontig, r.mpos, r.nm, r.qual) == (4, "c1", 8, 2, [40, 40, 2, 40])
    (tmp_path / "d.tsv").write_text("g\tc\n")
    assert files.read_genome_definition(spark, str(tmp_path / "d.tsv")).first() == ("g", "c")
    v = spark.createDataFrame([("c1", 4, ["A", "C"], 50.0, 25.0, 9, [("0/1", [10, 0, 30], [4, 5], 30, 9), ("0/0", [0, 0, 0], [0, 0], 0, 0)]), ("c1", 2, ["G"], 20.0, 1.0, 1, [("0/0", [0], [1], 3, 1), ("0/0", [0], [1], 3, -1)])], "contig string, pos long, alleles array<string>, qual double, qd double, dp int, genotypes array<struct<gt:string,pl:array<int>,ad:array<int>,gq:int,dp:int>>")
    files.write_vcf(v, str(tmp_path / "out.vcf"), ["s1", "s2"], [("c1", 100)])
    assert files.vcf_samples(spark, str(tmp_path / "out.vcf")) == ["s1", "s2"]
    back = files.read_vcf(spark, str(tmp_path / "out.vcf")).orderBy("pos").collect()
    assert [b.pos for b in back] == [2, 4] and back[1].alleles == ["A", "C"] and back[1].genotypes[0].ad == [4, 5] and back[1].genotypes[1].gt == "./." and back[0].genotypes[0].ad == [0]
    line = files.fasta_lines(spark.createDataFrame([("A" * 125,)], "seq string"), lit("s")).first()[0]
    assert [len(x) for x in line.split("\n")] == [2, 60, 60, 5]


def test_streamed_islands(spark, tmp_path):
    rows = [(0, i, 0.9 if i % 10 < 4 else 0.0) for i in range(60)]
    for k in range(3):
        spark.createDataFrame(rows[k * 20 : k * 20 + 20], "tid int, pos long, prob double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("tid int, pos long, prob double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = sorted((r.start, r.end, r.n) for r in stream.finished(spark, stream.islands(s, 0.5)).collect())
    assert got == [(a, a + 3, 4) for a in range(0, 60, 10)]


def test_streamed_islands_are_flushed_at_the_end(spark, tmp_path):
    rows = [(t, i, 0.9 if i in (3, 4, 5, 8, 9) else 0.0) for t in (0, 1) for i in range(10)]
    for part in (rows[:5], rows[5:] + [(0, None, None)]):
        spark.createDataFrame(part, "tid int, pos long, prob double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("tid int, pos long, prob double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = sorted(map(tuple, stream.finished(spark, stream.islands(s, 0.5)).collect()))
    assert got == [(0, 3, 5, 3), (0, 8, 9, 2), (1, 3, 5, 3)]  # contig 1 isn't closed


def test_late_rows_are_dropped_and_windows_closed(spark, tmp_path):
    import datetime as dt

    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    for k, part in enumerate(([(at(1), "a", 1.0), (at(8), "a", 2.0)], [(at(8, 30), "b", 1.0)], [(at(1, 30), "a", 5.0), (at(9), "a", 3.0)])):
        spark.createDataFrame(part, "ts timestamp, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    kind = "ts timestamp, event_type string, value double"
    read = lambda: spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    rows = lambda d: sorted((r.start.hour, r.event_type, r.n, r.total) for r in d.collect())
    late = rows(stream.finished(spark, stream.windowed(read())))
    assert late == [(1, "a", 1, 1.0)]  # the row of 1:30 comes two batches after 8:00; windows from 8:00 on are open
    whole = stream.closed(spark, spark.readStream.schema(kind).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), at(9))
    assert rows(stream.finished(spark, stream.windowed(whole))) == [(1, "a", 2, 6.0), (8, "a", 1, 2.0), (8, "b", 1, 1.0), (9, "a", 1, 3.0)]


def test_abundances_and_presence(spark):
    got = ST.abundances([(0, [1, 2], [0.5, 0.5]), (1, [2, 3], [0.5, 0.2])])
    assert 0 < got[1] < got[0] < 1
    d = spark.createDataFrame([(v, 0, 0 if v == 0 else 3) for v in range(100)], "variant int, sample int, ref_ad int")
    assert ST.strain_presence(d).first().present
    w = spark.createDataFrame([(0, 0, 1, 0.5), (0, 1, 1, 0.5)], "sample int, strain int, variant int, weight double")
    assert ST.strain_abundances(w).count() == 2


def test_gene_dnds_and_consensus(spark):
    genes = spark.createDataFrame([(1, 0, 10, 18, "+", "ATGTTTGGG"), (2, 0, 30, 38, "-", "CCCAAACAT")], "gene long, tid int, start long, end long, strand string, seq string")
    v = spark.createDataFrame([(0, 15, 0, "C"), (0, 33, 0, "G")], "tid int, pos long, sample int, alt string")
    got = {r.gene: (r.snps, r.dnds) for r in ST.gene_dnds(genes, v).collect()}
    assert got == {1: (1, 0.0), 2: (1, 0.0)}
    c = ST.consensus(spark.createDataFrame([(0, "ACGTACGT")], "tid int, seq string"), spark.createDataFrame([(0, 0, 1, "C", "CTT"), (1, 0, 2, "G", "G")], "sample int, tid int, pos long, ref string, alt string"))
    assert {(r.sample, r.seq, r.variations) for r in c.collect()} == {(0, "ACTTGTACGT", 1), (1, "ACGTACGT", 0)}


def test_assign(spark):
    pl, none = F.array(lit(0), lit(10), lit(20)), F.array(lit(0), lit(0), lit(0))
    g = ["0/0", "0/1", "1/1"]
    assert one(spark, G.assign(pl, g), G.assign(none, g), G.assign(pl, g, "posterior", F.array(lit(-3.0), lit(-1.0), lit(0.0)))) == ("0/0", "./.", "0/1")
    original = lambda *x: G.assign(pl, g, "original", original=F.array(*map(lit, x)), kept=F.array(lit(0), lit(2)))
    assert one(spark, original(0, 1), original(2, -1), original(2, 0), G.assign(pl, g, "none"), G.assign(pl, g, "no_call")) == ("0/0", "1/.", "1/0", None, "./.")
    bare, plain = (G.called(pl, F.array(lit(3), lit(2)), g, m) for m in ("no_call_bare", "pls"))
    assert one(spark, bare, plain) == (("./.", None, None, None, None), ("0/0", *one(spark, pl, F.array(lit(3), lit(2))), one(spark, M.gq(pl))[0], 5)) and set(G.METHODS) >= {"pls", "none"}


@pytest.mark.parametrize("n", [1, 2, 5])
def test_kmers(spark, n):
    assert one(spark, S.kmers(lit("ACGTA"), n))[0] == ["ACGTA"[i : i + n] for i in range(6 - n)]


def _sub(seq, at):
    return seq[:at] + ("A" if seq[at] != "A" else "C") + seq[at + 1 :]


def _cover(seq, starts, n=70):
    return [(seq[p : p + n], [30] * n) for p in starts]


REF = "".join(random.Random(5).choices("ACGT", k=150))


@pytest.mark.parametrize("at, starts", [(100, range(0, 36, 5)), (40, range(30, 41, 3))])
def test_dangling_ends_are_recovered(at, starts):
    hap = _sub(REF, at)
    reads = _cover(hap, starts)
    assert [h for _, h, _ in K.assemble(REF, reads, (25,), recover=None)] == [REF]
    assert [h for _, h, _ in K.assemble(REF, reads, (25,))] == [REF, hap]


def test_pruning_by_odds_drops_errors_and_keeps_variants():
    good, error = _cover(REF, range(0, 80, 2)) * 3, _cover(_sub(REF, 50), [20])
    assert len(K.assemble(REF, good + error, (25,), prune=0)) == 2
    assert [h for _, h, _ in K.assemble(REF, good + error, (25,), by_odds=True)] == [REF]
    hap = _sub(REF, 70)
    assert [h for _, h, _ in K.assemble(REF, good + error + _cover(hap, range(0, 80, 2)), (25,), by_odds=True)] == [REF, hap]
    assert abs(K.log_odds(100, 5, 1e-4) - (math.lgamma(101) + math.lgamma(6) - math.lgamma(107) - 5 * math.log(1e-4))) < 0.07
    K.Graph("ACGTACGTTT", 12).prune_by_odds()


def test_given_alleles_are_injected():
    hap = _sub(REF, 70)
    base = [(0.0, REF, "150M"), (-1.0, hap, "150M")]
    new = (60, REF[60], "ACGT".replace(REF[60], "")[0])
    out = K.inject(REF, base, [new, new])
    assert [h for _, h, _ in out[2:]] == [h[:60] + new[2] + h[61:] for h in (REF, hap)]
    assert len(K.inject(REF, base, [(70, REF[70], hap[70])])) == 2  # assembled already
    assert len(K.inject(REF, base, [(69, REF[69:72], REF[69])])) == 3  # overlaps the event of the second
    assert len(K.inject(REF, base, [(60, "N", "A")])) == 2


def test_zipped_graph_keeps_the_sequences():
    g = K.Graph(REF, 25)
    for seq, quals in _cover(_sub(REF, 70), range(0, 80, 2)):
        g.thread(seq, quals, 10)
    bases, edges = g.zipped()
    starts = set(range(len(bases))) - {b for _, b, _ in edges}
    found, left = set(), [(v, bases[v]) for v in starts]
    while left:
        v, seq = left.pop()
        nexts = [b for a, b, _ in edges if a == v]
        left += [(b, seq + bases[b]) for b in nexts]
        if not nexts:
            found.add(seq)
    assert found == {REF, _sub(REF, 70)}


def test_genotype_priors():
    snp, indel, third = math.log10(0.001), math.log10(0.000125), math.log10(3)
    want = [0.0, snp - third, 2 * snp - third, indel, snp - third + indel, 2 * indel]
    assert np.allclose(G.genotype_priors(2, ["A", "C", "GTT"]), want)
    assert np.allclose(G.genotype_priors(2, ["A", "C"], het_hom_ratio=2.0), [0.0, snp - third, snp - third - math.log10(2)])


def test_read_threshold(spark):
    # of one base of quality 10: mean 1.88893867, variance 18.43922003
    got = one(spark, M.read_threshold(F.array(lit(10)), error_rate=9.0, capped=False), M.read_threshold(F.array_repeat(lit(40), 100)), M.read_threshold(F.array_repeat(lit(40), 10)))
    assert math.isclose(got[0], -36.0)
    assert math.isclose(got[1], -8.0)
    assert math.isclose(got[2], -4.0)
    low = one(spark, M.read_threshold(F.array_repeat(lit(10), 50)))[0]
    assert math.isclose(low, -0.1 * (50 * 1.88893867 + math.sqrt(50 * 18.43922003)), rel_tol=1e-7)


def test_fetch_and_strain_lines(spark):
    contigs = spark.createDataFrame([("a", REF), ("b", REF[::-1]), ("e", "")], "contig string, seq string")
    spans = spark.createDataFrame([("a", 0, 149), ("a", 38, 41), ("b", 79, 200), ("x", 1, 2)], "contig string, start long, end long")
    got = {(r[0], r[1]): r[3] for r in files.fetch(files.contig_chunks(contigs, 40), spans, 40).collect()}
    assert got == {("a", 0): REF, ("a", 38): REF[38:42], ("b", 79): REF[::-1][79:]}
    w = spark.createDataFrame([(2, 0, 1.0), (2, 1, 0.25)], "strain int, sample int, weight double")
    lines = [r.line for r in files.strain_coverage_lines(w, ["x", "y"]).orderBy("strain").collect()]
    assert lines[1:] == ["##sample=<ID=1, name=x>", "##sample=<ID=2, name=y>", "strainID  \t1     \t2     ", "strain_2\t1.00\t0.25"]


def spelled(bases, edges):
    """All sequences from vertices without parents to those without children."""
    out, has_parent = {}, {b for _, b, _ in edges}
    for a, b, _ in edges:
        out.setdefault(a, []).append(b)

    def walk(v, seq):
        seq += bases[v]
        return {seq} if v not in out else set().union(*(walk(b, seq) for b in out[v]))

    return set().union(*(walk(v, "") for v in range(len(bases)) if v not in has_parent))


def test_simplified_graphs_spell_the_same_and_cycles_go():
    rng = random.Random(3)
    merged = cut = 0
    for _ in range(120):
        ref = "".join(rng.choice("ACGT") for _ in range(60))
        g = K.Graph(ref, 7)
        if g.repeats:
            continue
        for _ in range(3):
            alt = list(ref)
            for _ in range(rng.randrange(1, 4)):
                alt[rng.randrange(8, 52)] = rng.choice("ACGT")
            if rng.random() < 0.5:
                del alt[rng.randrange(10, 50)]
            g.thread("".join(alt), [30] * 60, 10)
        if g.cyclic():
            g.acyclic()
            cut += 1
            assert not g.cyclic() and g.best_paths(4)
            continue
        plain, merge = g.zipped(), g.simplified()
        assert spelled(*plain) == spelled(*merge)
        merged += sum(map(len, merge[0])) < sum(map(len, plain[0]))
    assert merged > 50
    assert g.dot()[0] == "digraph region {" and g.dot()[-1] == "}"


def test_a_cycle_is_cut():
    g = K.Graph("ACGTTGCAAC", 4)
    g.add("CAAC", "GTTG")
    g.add("GCAA", "GTTG")
    assert g.cyclic()
    g.acyclic()
    assert not g.cyclic() and [s for _, s in g.best_paths(4)] == ["ACGTTGCAAC"]


def test_reads_go_to_the_reference_through_their_haplotype():
    assert RA.to_reference("ACGTTTGGA", "CCACGTTTGGATT", "5M2I6M", "CCACGTGGATT", 100) == (102, "3M2I4M")
    assert RA.to_reference("ACGTGGA", "CCACGTGGATT", "6M2D5M", "CCACGTTTGGATT", 100) == (102, "3M2D4M")
    assert RA.to_reference("GGATT", "CCACGTTTGGATT", "5M2I6M", "CCACGTGGATT", 0) == (6, "5M")
    assert RA.trim_haplotype(100, "5M2I6M", "CCACGTTTGGATT", 103, 108) == ("CGTTTGGA", "2M2I4M")
    assert RA.trim_haplotype(100, "5M2D6M", "CCACGGGATTA", 102, 105) is None
    assert K.extra_kmer_sizes(0.1, (21, 33)) == [] and K.extra_kmer_sizes(0.3, (21, 33)) == [38] and K.extra_kmer_sizes(0.7, (10, 25)) == [19, 35, 47]


def test_region_is_called(spark):
    ref = "ACGTTGCAAGGCTTACGATCCATTGCATTGGC"
    alt = ref[:15] + "T" + ref[16:]
    reg = spark.createDataFrame([(1, 100, ref)], "region long, start long, ref string")
    reads = spark.createDataFrame([(1, s, 10 * s + i, ref if s == 0 or i % 2 else alt, [30] * len(ref)) for s in (0, 1) for i in range(8)], "region long, sample int, read long, seq string, quals array<int>")
    (c,) = CA.call_regions(reg, reads, kmer_sizes=(9,)).collect()
    assert (c.start, c.alleles, c.emitted, c.an, c.ac, c.dp) == (115, ["C", "T"], True, 4, [1], 16) and [(g.sample, g.gt, g.ad) for g in c.genotypes] == [(0, "0/0", [8, 0]), (1, "0/1", [4, 4])]
    # two alts of one place, one of them longer
    alts = [ref[:15] + "T" + ref[16:], ref[:15] + "CAA" + ref[16:]]
    many = spark.createDataFrame([(1, s, 10 * s + i, x, [30] * len(x)) for s in (0, 1) for i in range(10) for x in [alts[s] if i % 2 else ref]], "region long, sample int, read long, seq string, quals array<int>")
    (c,) = CA.call_regions(reg, many, kmer_sizes=(9,)).collect()
    assert c.start == 115 and set(c.alleles[1:]) == {"T", "CAA"} and c.alleles[0] == "C" and c.ac == [1, 1] and [g.gt for g in c.genotypes] == [f"0/{c.alleles.index(x)}" for x in ("T", "CAA")]
    assert CA.call_regions(reg.limit(0), reads.limit(0)).count() == 0


def test_references_manifest_and_sinks(spark, tmp_path, capsys):
    for n in ("b.fna", "a.fna", "c.txt"):
        (tmp_path / n).write_text(">x\nACGT\n")
    assert [p.rsplit("/", 1)[1] for p in files.find_references(spark, directory=str(tmp_path))] == ["a.fna", "b.fna"]
    with pytest.raises(ValueError):
        files.find_references(spark)
    assert [tuple(r) for r in files.sample_manifest(spark, ["s"], ["l"], (1, 1)).collect()] == [(0, "Short", "s"), (1, "Long", "l")]
    with pytest.raises(ValueError):
        files.sample_manifest(spark, ["s"], [], (2, 0))
    sam = "@SQ\tSN:c\tLN:9\nq\t2\tc\t1\t60\t4M\t*\t0\t0\tACGT\tIIII\n"
    (tmp_path / "s.sam").write_text(sam)
    (tmp_path / "l.sam").write_text(sam)
    both = files.read_samples(spark, [str(tmp_path / "s.sam")], [str(tmp_path / "l.sam")])
    assert sorted((r.sample, r.read_type) for r in both.collect()) == [(0, "Short"), (1, "Long")]
    assert files.read_samples(spark, []).columns == both.columns
    kept = str(tmp_path / "once")
    files.write_once(spark.range(3), kept)
    files.write_once(spark.range(5), kept)
    assert spark.read.parquet(kept).count() == 3
    files.write_once(spark.range(5), kept, force=True)
    assert spark.read.parquet(kept).count() == 5
    files.write_lines(spark.createDataFrame([("one",)], "line string"))
    assert capsys.readouterr().out == "one\n"
    v = spark.createDataFrame([("c", 4, ["A", "T"], 30.0, 1.0, 3, [("0/1", [1, 0, 2], [1, 2], 9, 3)])], "contig string, pos long, alleles array<string>, qual double, qd double, dp int, genotypes array<struct<gt:string,pl:array<int>,ad:array<int>,gq:int,dp:int>>")
    out = str(tmp_path / "vcf")
    files.write_vcfs(v, out, ["s"], [("g", "c", 9), ("h", "d", 9)])
    lines = spark.read.text(out)
    assert {r.genome: r["count"] for r in lines.where("value not like '#%'").groupBy("genome").count().collect()} == {"g": 1}
    assert lines.where("value like '#CHROM%'").count() == 2


def test_percentages(spark):
    assert one(spark, S.percentage(lit(95.0)), S.percentage(lit(0.5)), S.percentage(lit(1.0)), S.percentage(lit(None).cast("double"))) == (0.95, 0.5, 0.01, 0.0)
    with pytest.raises(Exception, match="Invalid percentage"):
        one(spark, S.percentage(lit(101.0)))
    f, b = one(spark, S.strand_rates(lit("FORWARD")), S.strand_rates(lit("NONE")))
    assert (f.forward, f.reverse) == (0.0, -math.inf) and abs(b.forward - math.log(0.5)) < 1e-12


def test_assembly_keeps_reads_beyond_ten_thousand(spark):
    rng = random.Random(12)
    ref = "".join(rng.choice("ACGT") for _ in range(120))
    alt = ref[:60] + {"A": "C", "C": "G", "G": "T", "T": "A"}[ref[60]] + ref[61:]
    regions = spark.createDataFrame([(1, 0, ref)], "region long, start int, ref string")
    reads = spark.range(10_040).select(F.lit(1).cast("long").alias("region"), F.when(F.col("id") < 10_000, ref).otherwise(alt).alias("seq"), F.array_repeat(F.when(F.col("id") < 10_000, 40).otherwise(30), 120).alias("quals"))
    for how in ({}, {"depth": None}):
        assert {r.hap for r in K.assemble_regions(regions, reads, (25,), 2, **how).collect()} == {ref, alt}
    assert {r.hap for r in K.assemble_regions(regions, reads, (25,), 2, depth=10_000).collect()} == {ref}


def slow_em(gls, alleles):
    """Diploid frequencies by plain loops over allele pairs."""
    n = len(alleles)
    pairs = sorted(((a, b) for b in range(n) for a in range(b + 1)), key=lambda g: (g[1], g[0]))
    prior = [10.0] + [0.01 if len(x) == len(alleles[0]) else 0.00125 for x in alleles[1:]]
    f, was = [1 / n] * n, [0.0] * n
    while True:
        count, posts = [0.0] * n, []
        for gl in gls:
            w = [10 ** (x - max(gl)) * (1 if a == b else 2) * f[a] * f[b] for x, (a, b) in zip(gl, pairs)]
            posts.append([x / sum(w) for x in w])
            for x, (a, b) in zip(posts[-1], pairs):
                count[a] += x
                count[b] += x
        done = max(abs(x - y) for x, y in zip(count, was)) <= 0.01
        was, total = count, sum(prior) + sum(count)
        f = [(p + c) / total for p, c in zip(prior, count)]
        if done:
            break
    none = sum(math.log10(max(p[0], 1e-300)) for p in posts)
    absent = [sum(math.log10(min(1, max(1e-300, sum(x for x, g in zip(p, pairs) if k not in g)))) for p in posts) for k in range(1, n)]
    return count, none, [none] if n == 2 else absent, pairs


def test_called_sites_against_plain_loops():
    rng = random.Random(12)
    seen = set()
    for _ in range(150):
        n = rng.choice([2, 3, 4])
        alleles = ["A", "C", "GTT", "T"][:n]
        size = n * (n + 1) // 2
        pls = []
        for _ in range(rng.randrange(1, 5)):
            x = [rng.choice([0, 3, 20, 60, 200]) for _ in range(size)] if rng.random() < 0.6 else [200] * size
            x[0 if rng.random() < 0.5 else rng.randrange(size)] = 0
            pls.append([v - min(x) for v in x])
        ads = [[rng.randrange(9) for _ in range(n)] for _ in pls]
        got = G.call_site(alleles, pls, ads)
        count, none, absent, pairs = slow_em([[-v / 10 for v in pl] for pl in pls], alleles)
        kept = [0] + [k for k, x in enumerate(absent, 1) if x + 1e-10 < -2.5]
        assert got["alleles"] == [alleles[k] for k in kept] and got["polymorphic"] == (len(kept) > 1)
        if len(kept) > 1:
            assert abs(got["qual"] + 10 * none) < 1e-6 and got["emitted"] == (-10 * none >= 25) and got["mle_ac"] == [round(count[k]) for k in kept[1:]]
        new = sorted(((a, b) for b in range(len(kept)) for a in range(b + 1)), key=lambda g: (g[1], g[0]))
        for (gt, pl, ad, gq, dp), old, reads in zip(got["genotypes"], pls, ads):
            mine = [old[pairs.index(tuple(sorted((kept[a], kept[b]))))] for a, b in new]
            mine = [v - min(mine) for v in mine]
            assert pl == mine and ad == [reads[k] for k in kept] and dp == sum(ad)
            if sum(mine) > 1:
                assert gt == "/".join(map(str, new[mine.index(0)])) and gq == min(99, sorted(mine)[1])
            else:
                assert gt == ("./." if len(kept) > 1 else "0/0") and gq == 0
        seen.add((len(kept), got["emitted"]))
    assert {(1, False), (2, True), (3, True)} <= seen
    assert G.call_site(["A", "C", "G", "T"], [[50] * 9 + [0]], [[0, 0, 0, 9]], most=1)["alleles"] == ["A", "T"]
    assert G.call_site(["A", "C"], [[0, 30, 300]], [[9, 0]], given=("C",))["alleles"] == ["A", "C"]


def test_density_groups(spark):
    from cladeframe.operators import density as DG

    rng = random.Random(8)
    pts = [(i, [rng.gauss(c, 0.05), rng.gauss(c / 2, 0.05)]) for i, c in enumerate(rng.choices([0.2, 0.9, 1.6], k=150))] + [(200 + i, [rng.random() * 4, rng.random() * 4]) for i in range(25)] + [(300, None), (301, [0.2, 0.1])]
    d = spark.createDataFrame(pts, "id int, features array<double>")
    eps, least = 0.1, 4
    got = {r.id: r.grp for r in DG.density_groups(d, eps, least).collect()}
    cell = {i: tuple(math.floor(x / eps) for x in f) for i, f in pts if f}
    n = {c: list(cell.values()).count(c) for c in cell.values()}
    dense = {c for c in n if n[c] >= least}
    near = lambda a, b: all(abs(x - y) <= 1 for x, y in zip(a, b))
    group = {c: c for c in dense}
    for _ in dense:
        for a in dense:
            for b in dense:
                if near(a, b):
                    group[a] = group[b] = min(group[a], group[b])
    number = {c: k for k, c in enumerate(sorted(set(group.values())))}
    want = {300: -1}
    for i, c in cell.items():
        at = c if c in dense else min((x for x in dense if near(x, c)), key=lambda x: (-n[x], x), default=None)
        want[i] = -1 if at is None else number[group[at]]
    assert got == want and len(number) >= 3 and -1 in got.values()
    assert DG.density_groups(d.limit(0), eps, least).count() == 0


def test_strains_of_genomes(spark):
    edges = [("x", 1, 2, 0.5), ("x", 1, 3, 0.4), ("y", 5, 6, 0.1)]
    depths = [("x", 1, 10.0), ("x", 2, 4.0), ("x", 3, 5.0), ("y", 5, 3.0), ("y", 6, 2.0), ("z", 9, 1.0)]
    got = ST.strains(spark.createDataFrame(edges, "genome string, src long, dst long, weight double"), spark.createDataFrame(depths, "genome string, grp long, depth double")).collect()
    assert sorted((r.genome, r.strain, r.place, r.grp) for r in got) == [("x", 0, 0, 1), ("x", 0, 1, 3), ("x", 1, 0, 1), ("x", 1, 1, 2), ("y", 0, 0, 5), ("y", 0, 1, 6), ("z", 0, 0, 9)]
