"""Rows of registered queries without an SQL twin, against slow versions that share no code with the library."""

import itertools
import math
import os
from collections import Counter, defaultdict

import pytest

from cladeframe.plans import adapters as D
from cladeframe.plans import queries as plans
from test_operators import slow_align, slow_em, slow_hmm, slow_regions

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
LEFT, RIGHT = "ACGTTGCAAGGCTTAC", "GGATCCATTG"


@pytest.fixture(scope="module")
def alleles(spark):
    return {r.key: (r.ref, r.alt) for r in D.alleles(spark, DATA).collect()}


def rows(spark, name, key):
    return {tuple(r[k] for k in key): r for r in plans.QUERIES[name](spark, DATA).collect()}


def close(a, b, e=1e-5):
    return abs(a - b) <= e * max(1, abs(a))


def copies(unit, text):
    n = 0
    while unit and text[n * len(unit) :].startswith(unit):
        n += 1
    return n


def test_repeat_units(spark, alleles):
    got = rows(spark, "str05_repeat_units", ["key"])
    for k, (ref, _) in alleles.items():
        unit = next(ref[:n] for n in range(1, len(ref) + 1) if len(ref) % n == 0 and ref[:n] * (len(ref) // n) == ref)
        assert (got[(k,)].unit, got[(k,)].copies) == (unit, copies(unit, ref))


def test_tandem_units(spark, alleles):
    got = rows(spark, "str06_tandem_units", ["key"])
    for k, (ref, alt) in alleles.items():
        q = (ref + alt) * 3
        at, best = len(q) // 2, None
        for n in range(1, 9):
            unit = q[at + 1 - n : at + 1]
            if at + 1 - n < 0:
                break
            c = 1 + copies(unit, q[at + 1 :]) + copies(unit[::-1], q[: at + 1 - n][::-1])
            if best is None or c > best[1]:
                best = (unit, c)
        if best[1] == 1:
            best = (q[at], 1)
        assert (got[(k,)].unit, got[(k,)].copies) == best


def test_trimmed_alleles(spark, alleles):
    got = rows(spark, "str09_trimmed_alleles", ["key"])
    for k, (ref, alt) in alleles.items():
        a, b, shift = ref, alt, 0
        while min(len(a), len(b)) > 1 and a[-1] == b[-1]:
            a, b = a[:-1], b[:-1]
        while min(len(a), len(b)) > 1 and a[0] == b[0]:
            a, b, shift = a[1:], b[1:], shift + 1
        assert (got[(k,)].ref, got[(k,)].alt, got[(k,)].shift) == (a, b, shift)


def test_alignments_and_cigars(spark, alleles):
    from cladeframe.operators import kernels as K

    got, cigars = rows(spark, "gen11_alignment", ["key"]), rows(spark, "str12_haplotype_cigar", ["key"])
    for k, (ref, alt) in list(alleles.items())[:60]:
        a, b = LEFT + ref + RIGHT + "CA", LEFT + alt + RIGHT + "CA"
        assert (got[(k,)].offset, got[(k,)].cigar) == slow_align(a, b, K.NEW_SW, "indel")
        a, b = LEFT + ref + RIGHT, LEFT + alt + RIGHT
        same = len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= 2
        assert cigars[(k,)].cigar == (f"{len(a)}M" if same else slow_align(a, b, K.NEW_SW, "indel")[1])


def test_left_aligned(spark, alleles):
    got = rows(spark, "str13_left_aligned", ["key"])
    for k, (ref, _) in alleles.items():
        n, whole = len(ref), "GCA" + ref * 4 + "TGC"
        hap = whole[: 3 + 3 * n] + whole[3 + 4 * n :]
        at = min(i for i in range(1, len(whole) - n) if whole[:i] + whole[i + n :] == hap)
        assert got[(k,)].cigar == f"{at}M{n}D{len(hap) - at}M"


def test_codon_changes(spark):
    letters = "TCAG"
    code = dict(zip(("".join(x) for x in itertools.product(letters, repeat=3)), "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"))
    got = rows(spark, "str23_codon_changes", ["before", "after"])
    assert len(got) == 64 * 63
    for (a, b), r in got.items():
        ways = []
        for order in itertools.permutations([i for i in range(3) if a[i] != b[i]]):
            at, n = list(a), 0
            for i in order:
                was = code["".join(at)]
                at[i] = b[i]
                n += code["".join(at)] != was
            ways.append((n, len(order) - n))
        assert close(r.nd, sum(w[0] for w in ways) / len(ways)) and close(r.sd, sum(w[1] for w in ways) / len(ways))


def digamma(x):
    out = 0.0
    while x < 20:
        out, x = out - 1 / x, x + 1
    return out + math.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6)


def test_dirichlet_and_likelihood_ratio(spark):
    parts = {r.p_partkey: r.p_size for r in D.table(spark, DATA, "part").collect()}
    got, ratio = rows(spark, "mth12_dirichlet", ["p_partkey"]), rows(spark, "mth14_likelihood_ratio", ["p_partkey"])
    for k, size in parts.items():
        a = size + 0.5
        assert close(got[(k,)].log_weight, digamma(a) - digamma(a + 1)) and close(got[(k,)].expected, -1 / a)
        n, m, e = 3 * size, k % 6, 1e-3
        z = (1 - e) / (1 - e + e * math.exp(digamma(n + 1) - digamma(m + 1)))
        q = z * (1 - z)
        gain = z * (math.log(1 - e) - math.log(e)) + q * (11 + 33 * q) / (2 + 20 * q)
        want = math.lgamma(n + 1) + math.lgamma(m + 1) - math.lgamma(n + m + 2) + m * gain
        assert close(ratio[(k,)].lr, want, 1e-4)


def test_pair_hmm_rows(spark, alleles):
    got, region = rows(spark, "gen12_pair_hmm", ["region"]), rows(spark, "gen13_region_likelihoods", ["region", "read", "hap_idx"])
    for k, (ref, alt) in alleles.items():
        hap = "ACGTTGCA" + ref + alt + "GGATCCA"
        assert close(got[(k,)].log10_lk, slow_hmm(hap, hap[3:12], [30] * 9))
        haps = ["ACGTTGCA" + x + "GGATCCA" for x in (ref, alt)]
        for i, j in itertools.product(range(2), repeat=2):
            assert close(region[k, i, j].log10_lk, slow_hmm(haps[j], haps[i][4:13], [30] * len(haps[i][4:13])))


def site_likelihoods(spark):
    out = defaultdict(lambda: defaultdict(lambda: [0.0] * 6))
    for r in D.likelihoods(spark, DATA).collect():
        p = [10**x for x in r.lks]
        for g, (a, b) in enumerate([(0, 0), (0, 1), (1, 1), (0, 2), (1, 2), (2, 2)]):
            out[r.site][r.sample][g] += math.log10((p[a] + p[b]) / 2)
    return out


def test_allele_frequencies_and_calls(spark):
    names = ["A", "C", "GTT"]
    depths = {(r.site, r.sample): r.ad for r in D.allele_depths(spark, DATA).collect()}
    got, calls = rows(spark, "gen21_allele_frequencies", ["site"]), rows(spark, "gen22_called_sites", ["site"])
    some = site_likelihoods(spark)
    assert set(calls) == set(got) == {(s,) for s in some}
    for site, of in some.items():
        gls = [of[k] for k in sorted(of)]
        count, none, absent, pairs = slow_em(gls, names)
        assert all(close(x, c / sum(count), 1e-6) for x, c in zip(got[(site,)].af, count[1:])) and close(got[(site,)].qual, -10 * none, 1e-6)
        assert got[(site,)].emitted == (-10 * none >= 25 and any(x + 1e-10 < -2.5 for x in absent))
        pls = [[round(-10 * (x - max(gl))) for x in gl] for gl in gls]
        count, none, absent, pairs = slow_em([[-p / 10 for p in pl] for pl in pls], names)
        kept = [0] + [k for k, x in enumerate(absent, 1) if x + 1e-10 < -2.5]
        c = calls[(site,)]
        assert c.alleles == [names[k] for k in kept]
        if len(kept) > 1:
            assert close(c.qual, -10 * none, 1e-4) and c.mle_ac == [round(count[k]) for k in kept[1:]]
            new = sorted(((a, b) for b in range(len(kept)) for a in range(b + 1)), key=lambda g: (g[1], g[0]))
            gts = []
            for pl in pls:
                mine = [pl[pairs.index(tuple(sorted((kept[a], kept[b]))))] for a, b in new]
                mine = [v - min(mine) for v in mine]
                gts.append("/".join(map(str, new[mine.index(0)])) if sum(mine) > 1 else "./.")
            assert c.gts == gts and c.an == sum(2 * ("." not in g) for g in gts) and c.ac == [sum(g.split("/").count(str(k)) for g in gts) for k in range(1, len(kept))]
            ads = [[depths[site, k][a] for a in kept] for k in sorted(of)]
            deep = sum(sum(a) for a in ads if any(a[1:])) or sum(map(sum, ads))
            assert c.dp == sum(map(sum, ads)) and (close(c.qd, min(45, -10 * none / deep), 1e-3) if deep else c.qd is None)


def test_active_region_rows(spark):
    smooth = defaultdict(dict)
    for r in plans._smooth(spark, DATA).collect():
        smooth[r.tid][r.pos] = r.prob
    got = sorted(tuple(r) for r in plans.QUERIES["win06_active_regions"](spark, DATA).collect())
    want = []
    for t, of in smooth.items():
        first, last = min(of), max(of)
        for s, e, on, x, _, _ in slow_regions([of.get(p, 0.0) for p in range(first, last + 1)], 0.4, 50, 300, 100):
            want.append((t, first + s, first + e, on, x, max(0, first + s - 100), min(last, first + e + 100)))
    assert [g[:4] + g[5:] for g in got] == [w[:4] + w[5:] for w in sorted(want)] and all(close(g[4], w[4]) for g, w in zip(got, sorted(want)))


def test_strain_abundances(spark):
    of = defaultdict(list)
    for r in D.allele_depths(spark, DATA).collect():
        if max(r.ad) > 0:
            of[r.sample].append((r.site % 3, r.site // 3, r.ad[1] / sum(r.ad)))
    got = rows(spark, "agg29_strain_abundance", ["sample", "strain"])
    for sample, all_ in of.items():
        strains = sorted({s for s, _, _ in all_})
        theta, weight = {s: 1.0 for s in strains}, {(s, v): w for s, v, w in all_}
        while True:
            new = {}
            for (s, v), w in weight.items():
                pool = sum(theta[t] for t in strains if (t, v) in weight)
                new[s, v] = w * theta[s] / (pool if pool > 0.01 else 1.0)
            total = sum(weight.values())
            next_ = {s: sum(w for (t, _), w in new.items() if t == s) / total if total else 0.0 for s in strains}
            next_ = {s: x if x >= 0.01 else 0.0 for s, x in next_.items()}
            change = sum(abs(next_[s] - theta[s]) for s in strains)
            theta, weight = next_, new
            if change <= 0.01:
                break
        assert all(close(got[sample, s].abundance, theta[s]) for s in strains)


def test_linkage_and_strain_paths(spark):
    reads, depth = defaultdict(set), Counter()
    for r in D.table(spark, DATA, "lineitem").collect():
        reads[r.l_partkey % 20].add(r.l_orderkey)
        depth[r.l_partkey % 20] += 1
    edges = {}
    for a, b in itertools.combinations(sorted(reads), 2):
        both = len(reads[a] & reads[b])
        if both:
            far = 1 - both / len(reads[a] | reads[b])
            src, dst = (a, b) if depth[a] > depth[b] else (b, a)
            edges[src, dst] = (far if far < 0.98 else 1.0) * (2 - math.log(min(depth[a], depth[b])) / math.log(max(depth[a], depth[b])))
    got = {(r.src, r.dst): r.weight for r in plans.QUERIES["gen28_linkage_edges"](spark, DATA).collect()}
    assert set(got) == set(edges) and all(close(got[e], w) for e, w in edges.items())
    # cheapest ways by relaxing every edge as often as there are groups
    out = {g: [b for a, b in edges if a == g] for g in depth}
    used, seen, strains = Counter(), set(), []
    for tip in sorted((g for g in depth if not any(b == g for _, b in edges)), key=lambda g: (-depth[g], g)):
        cost = {tip: (0.0, [tip])}
        for _ in depth:
            for (a, b), w in sorted(edges.items()):
                if a in cost and (b not in cost or cost[a][0] + w < cost[b][0] - 1e-12):
                    cost[b] = (cost[a][0] + w, cost[a][1] + [b])
        for sink in sorted((v for v in cost if not out[v]), key=lambda v: (cost[v][0] / len(cost[v][1]), v)):
            path = cost[sink][1]
            if set(path) - seen or all(1 - used[g] / depth[g] >= 0.35 for g in path):
                strains.append(path)
                used.update({g: min(depth[x] for x in path) for g in path})
                seen |= set(path)
    strains += [[g] for g in sorted(set(depth) - seen)]
    found = sorted((r.strain, r.place, r.grp) for r in plans.QUERIES["gen28_strain_paths"](spark, DATA).collect())
    assert found == [(k, i, g) for k, path in enumerate(strains) for i, g in enumerate(path)]


def test_best_haplotypes(spark, alleles):
    got = rows(spark, "srt02_k_best_haplotypes", ["key", "place"])
    for k, (ref, alt) in alleles.items():
        a, b = (LEFT + x + "GGATCCATTGCATTGGC" for x in (ref, alt))
        kmers = lambda x: [x[i : i + 9] for i in range(len(x) - 8)]
        twice = {x for x, n in Counter(kmers(a)).items() if n > 1}
        n = Counter()
        for read in (a, b, b):
            n.update((x, y) for x, y in zip(kmers(read), kmers(read)[1:]) if not {x, y} & twice)
        on_ref = set(zip(kmers(a), kmers(a)[1:]))
        edges = defaultdict(dict)
        for x, y in {*n, *on_ref}:
            edges[x][y] = max(n[x, y], 1) if (x, y) in on_ref else n[x, y]
        source, sink = kmers(a)[0], kmers(a)[-1]
        good = {source}
        paths, left = [], [(0.0, [source])]
        cyclic = False

        def reaches(v, seen=()):
            return v == sink or any(reaches(w, (*seen, v)) for w in edges[v] if w not in seen)

        while left:
            score, path = left.pop()
            if path[-1] == sink:
                paths.append((score, path[0] + "".join(v[-1] for v in path[1:])))
                continue
            ways = {w: c for w, c in edges[path[-1]].items() if reaches(w)}
            for w, c in ways.items():
                if w in path:
                    cyclic = True
                elif c:
                    left.append((score + math.log10(c / sum(ways.values())), [*path, w]))
        mine = [(r.score, r.hap) for (key, _), r in sorted(got.items()) if key == k]
        if cyclic:
            assert mine == []
            continue
        want = sorted(paths, key=lambda p: -p[0])
        assert good and len(mine) == min(4, len(want)) and all(close(m[0], w[0]) for m, w in zip(mine, want)) and {m[1] for m in mine} <= {w[1] for w in want}


def test_phase_groups(spark):
    haps = defaultdict(set)
    for r in D.table(spark, DATA, "lineitem").collect():
        haps[(r.l_suppkey % 50) * 1_000_000 + r.l_partkey // 40, r.l_partkey].add(r.l_linenumber % 2)
    regions = defaultdict(list)
    for (g, p), h in haps.items():
        regions[g].append((p, frozenset(h)))
    want = {}
    for g, calls in regions.items():
        calls.sort()
        whole, out, bad = frozenset({0, 1}), {}, False
        for (i, (p, a)), (j, (q, b)) in itertools.combinations(enumerate(calls), 2):
            link = 1 if a == b else -1 if not a & b and a | b == whole else 0
            if not link or bad:
                continue
            if i not in out:
                if j in out:
                    bad = True
                    continue
                out[i] = (p, 1)
            told = (out[i][0], out[i][1] * link)
            bad |= out.setdefault(j, told) != told
        if not bad:
            want |= {(g, calls[i][0]): (s, "0|1" if x > 0 else "1|0") for i, (s, x) in out.items()}
    got = {k: (r.phase_set, r.gt) for k, r in rows(spark, "win11_phase_groups", ["region", "start"]).items()}
    assert got == want and len(want) > 20


def test_dnds_lines(spark):
    letters = "TCAG"
    code = dict(zip(("".join(x) for x in itertools.product(letters, repeat=3)), "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"))
    back = str.maketrans("ACGT", "TGCA")
    got = {r.gene: r.line.split("\t") for r in plans.QUERIES["snk09_dnds_lines"](spark, DATA).collect()}
    n = 0
    for r in D.sequences(spark, DATA).collect()[:25]:
        for a in range(0, len(r.seq) - 59, 150):
            line = got[r.doc_id * 1_000_000 + a]
            assert line[:4] == [str(r.doc_id), str(r.doc_id * 1_000_000 + a), str(a + 1), str(a + 60)]
            for sample in range(4):
                gene = r.seq[a : a + 60]
                new = list(gene)
                at = [p for p in range(0, len(r.seq), 13) if p % 4 == sample and a <= p < a + 60]
                for p in at:
                    new[p - a] = new[p - a].translate(str.maketrans("ACGT", "CGTA"))
                new = "".join(new)
                if a % 300:
                    gene, new = gene.translate(back)[::-1], new.translate(back)[::-1]
                sites = wrong = silent = 0.0
                for i in range(0, 60, 3):
                    x, y = gene[i : i + 3], new[i : i + 3]
                    # a site counts by the share of its three changes that change the amino acid
                    sites += sum(code[x[:j] + b + x[j + 1 :]] != code[x] for j in range(3) for b in letters if b != x[j]) / 3
                    ways = []
                    for order in itertools.permutations([j for j in range(3) if x[j] != y[j]]):
                        now, k = list(x), 0
                        for j in order:
                            was = code["".join(now)]
                            now[j] = y[j]
                            k += code["".join(now)] != was
                        ways.append((k, len(order) - k))
                    wrong, silent = wrong + sum(w[0] for w in ways) / len(ways), silent + sum(w[1] for w in ways) / len(ways)

                def jc(p):
                    p = 0.7499 if p == 0.75 else p
                    return -0.75 * math.log(1 - 4 * p / 3) if p < 0.75 else math.nan

                dn, ds = jc(wrong / sites), jc(silent / (60 - sites)) if sites < 60 else math.nan
                want = 1.0 if not at or math.isnan(dn) or math.isnan(ds) or ds <= 2.3e-16 else max(0.0, dn / ds)
                assert line[4 + sample] == str(len(at)) and abs(float(line[8 + sample]) - want) < 2e-3 * max(1, want), (r.doc_id, a, sample, line, want)
                n += bool(at)
    assert n > 100
