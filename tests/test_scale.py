"""What larger tables need: equal work done once, alignments of many regions at once, no broadcast of tables whose size is guessed."""

from collections import Counter

import pytest

from cladeframe.functions import sequences as S
from cladeframe.operators import calling as CA
from cladeframe.operators import kernels as K
from cladeframe.operators import strains as ST

FLANKS = "ACGTTGCAAGGCTTAC", "GGATCCATTGCATTGGC"


def counted(monkeypatch, module, name):
    """Calls of ``module.name`` from now on."""
    calls, was = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **k: calls.append(a) or was(*a, **k))
    return calls


@pytest.fixture
def short(spark):
    pair = lambda i: (FLANKS[0] + "AC" + FLANKS[1], FLANKS[0] + "ACG"[: 1 + i % 3] + "T" * (i % 2) + FLANKS[1])
    regions = spark.createDataFrame([(i, 100 * i, pair(i)[0]) for i in range(12)], "region long, start long, ref string")
    reads = spark.createDataFrame([(i, k % 2, k, pair(i)[k > 0], [30] * len(pair(i)[k > 0])) for i in range(12) for k in range(4)], "region long, sample int, read long, seq string, quals array<int>")
    return regions, reads


def test_no_region_is_broadcast(spark, short):  # gen20
    regions, reads = short
    haps = CA.haplotype_events(regions, K.assemble_regions(regions, reads.select("region", "seq", "quals"), (9,)))
    plan = CA.locus_likelihoods(reads, haps)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_called_regions_assemble_once(spark, short):  # gen19
    calls = CA.call_regions(*short, kmer_sizes=(9,))
    assert "MapInArrow" not in calls._jdf.queryExecution().analyzed().toString()  # likelihoods are read back, for each number of alleles
    assert calls.count() > 0


def test_haplotypes_of_many_pairs_are_aligned_at_once(monkeypatch):  # gen17, str12
    calls = counted(monkeypatch, K, "align_all")
    pairs = [(FLANKS[0] + a + FLANKS[1], FLANKS[0] + b + FLANKS[1]) for a in ("A", "ACG", "TTGAC") for b in ("C", "GT", "CAGTT", "")] * 3
    got = K.cigars(pairs)
    assert len(calls) == 1 and len(calls[0][0]) == len(set(calls[0][0]))
    assert got == [K.haplotype_cigar(a, b) for a, b in pairs]
    assert K.cigars([("ACGT", ""), ("ACGT", "ACGA")]) == ["4D", "4M"]


def test_equal_regions_are_assembled_once(monkeypatch):  # gen16
    made, aligned = counted(monkeypatch, K, "Graph"), counted(monkeypatch, K, "align_all")
    a, b, c = FLANKS[0] + "AC" + FLANKS[1], FLANKS[0] + "ACGTT" + FLANKS[1], FLANKS[0] + "T" + FLANKS[1]
    jobs = [(a, Counter([a, x, x])) for x in (b, c, b, c, b)]
    got = K.assemble_all(jobs, (9,), 1)
    assert len(made) == 2 and len(aligned) <= 2
    assert got[0] == got[2] == got[4] == K.assemble(a, [(x, [30] * len(x)) for x in (b, a, b)], (9,), 1) and {h for _, h, _ in got[1]} == {a, c}


def test_kmers_of_a_row_are_counted_where_it_is(spark, monkeypatch):  # gen01
    monkeypatch.setattr(S, "_CODES", 64)
    texts = [(1, "ACGT" * 90 + "A" * 40), (2, "ACGTTGCAAG" * 5), (2, "TTTTTACGTTGCAAGGCTTACGGATC"), (3, "ACGT"), (None, "G" * 30), (None, "G" * 27), (4, None)]
    by = {}
    for i, t in texts:
        if t and len(t) >= 26:
            by.setdefault(i, Counter()).update(t[p : p + 26] for p in range(len(t) - 25))
    want = {i: (len(c), sum(c.values()), max(c.values())) for i, c in by.items()}
    rows = spark.createDataFrame(texts, "doc_id long, seq string")
    got = S.kmer_multiplicities(rows, "doc_id", "seq", 26)
    assert {r.doc_id: (r.edges, r.threaded, r.most) for r in got.collect()} == want
    once = S.kmer_multiplicities(rows.where("doc_id = 1"), "doc_id", "seq", 26)
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert [r.threaded for r in once.collect()] == [sum(by[1].values())]
    for k in (1, 2, 7, 31):
        raw = b"ACGTTGCAAGGCTTACGGATCCATTGCATTGGCAAAC"
        assert S._coded(raw, k).tolist() == [int("".join(str(b"ACGT".index(x)) for x in raw[p : p + k]), 4) for p in range(len(raw) - k + 1)]


def test_genes_go_to_python_as_rows(spark):  # snk09
    genes = spark.createDataFrame([(1, 0, 0, 29, "+", "ATGTTTGGGCCCAAATTTGGGCCCAAATAA"), (2, 0, 30, 59, "-", "ATGTTTGGGCCCAAATTTGGGCCCAAATAA")], "gene long, tid int, start long, end long, strand string, seq string")
    variants = spark.createDataFrame([(0, p, p % 2, "ACGT"[p % 4]) for p in range(3, 58, 5)], "tid int, pos long, sample int, alt string")
    rates = ST.gene_dnds(genes, variants)
    assert "FlatMapGroups" not in rates._jdf.queryExecution().analyzed().toString()
    got = {(r.gene, r.sample): (r.snps, r.dnds) for r in rates.collect()}
    back = str.maketrans("ACGT", "TGCA")
    for (gene, sample), (snps, rate) in got.items():
        at, minus, seq = 30 * (gene - 1), gene == 2, "ATGTTTGGGCCCAAATTTGGGCCCAAATAA"
        ch = [(at + 29 - p if minus else p - at, "ACGT"[p % 4].translate(back) if minus else "ACGT"[p % 4]) for p in range(3, 58, 5) if at <= p < at + 30 and p % 2 == sample]
        assert snps == len(ch) and rate == ST.dnds(seq.translate(back)[::-1] if minus else seq, ch)
    assert len(got) == 4
