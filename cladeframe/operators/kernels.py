"""Local assembly and what is made of its haplotypes: recurrences and graphs that no relational plan expresses, run as Arrow functions."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import placed
from .dynamic import NEW_SW, ORIGINAL, STANDARD, align, align_all, pair_hmm, pair_hmm_all  # noqa: F401

def read_likelihoods(pairs: DataFrame) -> DataFrame:
    """pairs: (region, read, hap_idx, read_seq, quals array<int>, hap_seq). Adds log10_lk; pairs of one region need not be in one task."""

    def run(batches):
        for pdf in batches:
            out = pdf[["region", "read", "hap_idx"]].copy()
            out["log10_lk"] = pair_hmm_all(list(zip(pdf.hap_seq, pdf.read_seq)), pdf.quals.tolist())
            yield out

    return pairs.select("region", "read", "hap_idx", "read_seq", "quals", "hap_seq").mapInPandas(run, "region long, read long, hap_idx int, log10_lk double")


def haplotype_cigar(ref: str, alt: str) -> str:
    """One run for equal lengths with two mismatches or fewer, one deletion for an empty alt, else an alignment with padded ends."""
    return haplotype_cigars(ref, [alt])[0]


def haplotype_cigars(ref: str, alts: list[str]) -> list[str]:
    """``haplotype_cigar`` of several haplotypes of one region, aligned at once."""
    return cigars([(ref, alt) for alt in alts])


def cigars(pairs: list[tuple[str, str]]) -> list[str]:
    """``haplotype_cigar`` of pairs (ref, alt) of any regions: equal pairs are aligned once, and all at once."""
    out: dict[tuple[str, str], str] = {}
    for ref, alt in dict.fromkeys(pairs):
        if not alt:
            out[ref, alt] = f"{len(ref)}D"
        elif len(ref) == len(alt) and sum(a != b for a, b in zip(ref, alt)) <= 2:
            out[ref, alt] = f"{len(ref)}M"
    rest = sorted({p for p in pairs if p not in out})
    out |= {p: cigar for p, (_, cigar) in zip(rest, align_all(rest, NEW_SW, "indel"))}
    return [out[p] for p in pairs]


def events(ref: str, hap: str, cigar: str, start: int, mnp_distance: int = 0) -> list[tuple[int, str, str]]:
    """(start, ref, alt) of a haplotype against the reference; substitutions at most ``mnp_distance`` apart are one event."""
    out, i, j = [], 0, 0
    for k, op in ((int(n), o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar)):
        if op in "M=X":
            bad = [x for x in range(k) if ref[i + x] != hap[j + x]]
            run: list[int] = []
            for x in [*bad, None]:
                if run and (x is None or x - run[-1] > mnp_distance):
                    out.append((start + i + run[0], ref[i + run[0] : i + run[-1] + 1], hap[j + run[0] : j + run[-1] + 1]))
                    run = []
                if x is not None:
                    run.append(x)
            i, j = i + k, j + k
        elif op == "I":
            if i > 0:
                out.append((start + i - 1, ref[i - 1], ref[i - 1] + hap[j : j + k]))
            j += k
        elif op == "D":
            if i > 0:
                out.append((start + i - 1, ref[i - 1 : i + k], ref[i - 1]))
            i += k
        elif op == "S":
            j += k
    return out


def log_odds(n_ref: int, n_alt: int, error: float) -> float:
    """Natural-log evidence that ``n_alt`` observations, all of one error rate, are a variant and no errors."""
    e = 10.0 ** (-min(254, max(1, round(-10 * math.log10(max(error, 1e-26))))) / 10)
    ratio = math.exp(sum(1 / i for i in range(n_alt + 1, n_ref + 1)) - sum(1 / i for i in range(n_ref + 1, n_alt + 1)))
    z = (1 - e) / (1 - e + e * ratio)
    q = z * (1 - z)
    gain = z * (math.log1p(-e) - math.log(e)) + q * (11 + 33 * q) / (2 + 20 * q)
    return math.lgamma(n_ref + 1) + math.lgamma(n_alt + 1) - math.lgamma(n_ref + n_alt + 2) + n_alt * gain


_OTHER = str.maketrans("", "", "ACGT")


def usable(read: str, quals, min_qual: int) -> list[str]:
    """The runs of bases A, C, G and T of a quality of ``min_qual`` and more."""
    read = read[: len(quals)]
    if not read.translate(_OTHER) and min(quals, default=min_qual) >= min_qual:
        return [read] if read else []
    return "".join(b if b in "ACGT" and q >= min_qual else " " for b, q in zip(read, quals)).split()


class Graph:
    """De Bruijn graph of a region: vertices are k-mers, edges carry the reads' multiplicity and whether the reference takes them."""

    def __init__(self, ref: str, k: int):
        self.k, self.ref = k, ref
        self.out: dict[str, Counter] = defaultdict(Counter)
        self.into: dict[str, Counter] = defaultdict(Counter)
        self.on_ref: set[tuple[str, str]] = set()
        kmers = [ref[i : i + k] for i in range(len(ref) - k + 1)]
        self.repeats = {x for x, n in Counter(kmers).items() if n > 1}
        self.source, self.sink = (kmers[0], kmers[-1]) if kmers else ("", "")
        for a, b in zip(kmers, kmers[1:]):
            self.add(a, b, 0)
            self.on_ref.add((a, b))

    def add(self, a: str, b: str, n: int = 1) -> None:
        self.out[a][b] += n
        self.into[b][a] += n

    def thread(self, read: str, quals, min_qual: int) -> None:
        """Pieces of usable bases of length k and more; k-mers that repeat in the reference are left out."""
        for piece in usable(read, quals, min_qual):
            self.thread_piece(piece)

    def thread_piece(self, s: str, n: int = 1) -> None:
        """``n`` times a piece whose bases are all usable."""
        k, repeats, out, into = self.k, self.repeats, self.out, self.into
        kmers = [s[i : i + k] for i in range(len(s) - k + 1)]
        plain = not repeats or repeats.isdisjoint(kmers)
        for a, b in zip(kmers, kmers[1:]):
            if plain or (a not in repeats and b not in repeats):
                out[a][b] += n
                into[b][a] += n

    def chains(self) -> list[list[tuple[str, str]]]:
        """Edges in runs that neither branch nor join inside."""
        out = []
        for v in list(self.out):
            if len(self.into[v]) == 1 and len(self.out[v]) == 1:
                continue
            for b in list(self.out[v]):
                chain = [(v, b)]
                while len(self.into[b]) == 1 and len(self.out[b]) == 1 and b != v:
                    chain.append((b, next(iter(self.out[b]))))
                    b = chain[-1][1]
                out.append(chain)
        return out

    def _drop(self, chain: list[tuple[str, str]]) -> None:
        for x, y in chain:
            del self.out[x][y], self.into[y][x]

    def prune(self, factor: int) -> None:
        """Chains whose edges are all off the reference and under ``factor`` go."""
        for chain in self.chains() if factor > 0 else ():
            if all(e not in self.on_ref and self.out[e[0]][e[1]] < factor for e in chain):
                self._drop(chain)

    def prune_by_odds(self, error: float = 0.001, least: float = math.log(10), seed: float = 4 * math.log(10), variants: int = 100) -> None:
        """Drops chains that errors explain, in two passes: the chains doubtful at ``error`` give the rate of the second pass."""
        chains = self.chains()
        if not chains:
            return
        doubtful = self._doubtful(chains, error, least, seed, variants)
        every = sum(sum(c.values()) for c in self.out.values())
        wrong = sum(self.out[x][y] for x, y in (chains[i][-1] for i in doubtful))
        for i in self._doubtful(chains, wrong / every if every else 0.0, least, seed, variants):
            if chains[i][0] not in self.on_ref:
                self._drop(chains[i])

    def _doubtful(self, chains, error: float, least: float, seed: float, variants: int) -> list[int]:
        """Places of the chains that a search by evidence doesn't reach. It starts from the heaviest chain and from vertices with three well-founded ends, the best odds first."""
        ends = [(c[0][0], c[-1][1]) for c in chains]
        odds = []
        for c, (a, b) in zip(chains, ends):
            left, right = self.out[a][c[0][1]], self.into[b][c[-1][0]]
            odds.append((log_odds(sum(self.out[a].values()) - left, left, error) if self.into[a] else 0.0, log_odds(sum(self.into[b].values()) - right, right, error) if self.out[b] else 0.0))
        at: dict[str, list[tuple[float, int]]] = defaultdict(list)
        sure: Counter = Counter()
        for i, both in enumerate(odds):
            for v, o in zip(ends[i], both):
                if o >= least or chains[i][0] in self.on_ref:
                    at[v].append((-o, i))
                sure[v] += min(both) >= seed
        heaviest = max(range(len(chains)), key=lambda i: (max(self.out[x][y] for x, y in chains[i]), len(chains[i]), chains[i]))
        seen = {v for v, n in sure.items() if n > 2}
        heap = [(-math.inf, heaviest), *(x for v in seen for x in at[v])]
        heapq.heapify(heap)
        good: set[int] = set()
        left_from: Counter = Counter()
        while heap:
            i = heapq.heappop(heap)[1]
            if i in good:
                continue
            good.add(i)
            left_from[ends[i][0]] += 1
            if sum(n - 1 for n in left_from.values()) > variants:
                break
            for v in set(ends[i]) - seen:
                seen.add(v)
                for x in at[v]:
                    heapq.heappush(heap, x)
        return [i for i in range(len(chains)) if i not in good]

    def recover(self, shortest: int = 1) -> None:
        """Joins dangling ends to the reference: tails where their last bases match it, heads (same length only) where their first bases do. New edges have multiplicity 1; a join that closes a cycle is undone."""
        _together([self.recovering(shortest)])

    def recovering(self, shortest: int = 1):
        """``recover`` that yields the pairs (ref, alt) it wants aligned and is sent their CIGARs."""
        kmers = [self.ref[i : i + self.k] for i in range(len(self.ref) - self.k + 1)]
        place = {v: i for i, v in enumerate(kmers) if v not in self.repeats}
        for v in [v for v in list(self.into) if not self.out[v] and self.into[v] and v != self.sink]:
            way = [v]
            while way[-1] not in place and len(self.into[way[-1]]) == 1:
                way.append(next(iter(self.into[way[-1]])))
            if way[-1] in place and len(way) > max(shortest, 1):
                tail = self._tail(way[::-1], kmers[place[way[-1]] :])
                self._join((yield from tail))
        for v in [v for v in list(self.out) if not self.into[v] and self.out[v] and v != self.source]:
            way = [v]
            while way[-1] not in place and len(self.out[way[-1]]) == 1:
                way.append(next(iter(self.out[way[-1]])))
            if way[-1] in place and len(way) > shortest:
                self._join(self._head(v, place[way[-1]] - len(way) + 1))

    def _tail(self, way: list[str], ref_way: list[str]):
        alt, ref = ("".join(x[-1] for x in w) for w in (way, ref_way[: 2 * len(way) + 10]))
        parts = [(int(n), op) for n, op in re.findall(r"(\d+)([MIDS])", (yield ref, alt))]
        while parts and parts[-1][1] == "D":
            parts.pop()
        if not 1 <= len(parts) <= 3 or parts[-1][1] != "M":
            return []
        used, same = sum(n for n, op in parts if op in "MD"), 0
        while same < min(parts[-1][0], used - 1, len(alt) - 1) and alt[-1 - same] == ref[used - 1 - same]:
            same += 1
        return [way[len(alt) - same - 1], ref_way[used - same]] if same else []

    def _head(self, v: str, start: int) -> list[str]:
        if start < 0:
            return []
        same = 0
        while same < self.k - 1 and v[same] == self.ref[start + same]:
            same += 1
        before = start + same - self.k
        seq = self.ref[before : before + self.k] + v[same:]
        return [seq[i : i + self.k] for i in range(len(seq) - self.k + 1)] if same and before >= 0 else []

    def _join(self, way: list[str]) -> None:
        new = [(a, b) for a, b in zip(way, way[1:]) if b not in self.out[a]]
        for a, b in new:
            self.add(a, b)
        if new and self.cyclic():
            self._drop(new)

    def zipped(self) -> tuple[list[str], list[tuple[int, int, int]]]:
        """The sequence graph: bases of each vertex (k-mer chains zipped; a chain's first vertex whole where nothing leads to it) and edges (from, to, multiplicity)."""
        heads = {v for v in {*self.out, *self.into} if (self.out[v] or self.into[v]) and (len(self.into[v]) != 1 or len(self.out[next(iter(self.into[v]))]) != 1)}
        number = {v: i for i, v in enumerate(sorted(heads))}
        bases, edges = [], []
        for v in sorted(heads):
            seq, last = v if not self.into[v] else v[-1], v
            while len(self.out[last]) == 1 and (nxt := next(iter(self.out[last]))) not in number:
                seq, last = seq + nxt[-1], nxt
            bases.append(seq)
            edges += [(number[v], number[b], n) for b, n in sorted(self.out[last].items())]
        return bases, edges

    def reachable(self) -> set[str]:
        def walk(start, step):
            seen, left = {start}, [start]
            while left:
                for y in step[left.pop()]:
                    if y not in seen:
                        seen.add(y)
                        left.append(y)
            return seen

        return walk(self.source, self.out) & walk(self.sink, self.into)

    def cyclic(self) -> bool:
        good = self.reachable()
        degree = {v: sum(1 for a in self.into[v] if a in good) for v in good}
        left, n = [v for v, d in degree.items() if d == 0], 0
        while left:
            v = left.pop()
            n += 1
            for b in self.out[v]:
                if b in good:
                    degree[b] -= 1
                    if degree[b] == 0:
                        left.append(b)
        return n < len(good)

    def acyclic(self) -> None:
        """Drops each edge that leads back into the way walked from the source (depth first, successors by name), then what is on no way from source to sink."""
        on_way, done, back = {self.source}, set(), []
        stack = [(self.source, iter(sorted(self.out[self.source])))]
        while stack:
            v, rest = stack[-1]
            for b in rest:
                if b in on_way:
                    back.append((v, b))
                elif b not in done:
                    on_way.add(b)
                    stack.append((b, iter(sorted(self.out[b]))))
                    break
            else:
                stack.pop()
                on_way.discard(v)
                done.add(v)
        self._drop(back)
        good = self.reachable()
        self._drop([(a, b) for a in list(self.out) for b in list(self.out[a]) if a not in good or b not in good])

    def simplified(self, most: int = 100) -> tuple[list[str], list[tuple[int, int, int]]]:
        """The zipped graph with shared bases merged: siblings with one parent give up their common prefix, those with one child their common suffix, and chains are zipped again, until nothing changes. Spelled sequences stay the same."""
        bases, edges = self.zipped()
        seq = dict(enumerate(bases))
        out, into = defaultdict(Counter), defaultdict(Counter)
        for a, b, n in edges:
            out[a][b] += n
            into[b][a] += n
        number = len(seq)
        for _ in range(most):
            changed = False
            for near, far, lead in ((into, out, True), (out, into, False)):
                for v in sorted(seq):
                    kin = sorted(b for b in far[v] if len(near[b]) == 1) if v in seq else []
                    # kin that end the graph, or that would be left without a base, keep one
                    for _, group in groupby(sorted(kin, key=lambda b: seq[b][:1] if lead else seq[b][-1:]), key=lambda b: seq[b][:1] if lead else seq[b][-1:]):
                        group = list(group)
                        if len(group) < 2:
                            continue
                        words = [seq[b] if lead else seq[b][::-1] for b in group]
                        same = 0
                        while same < min(map(len, words)) - 1 and len({w[same] for w in words}) == 1:
                            same += 1
                        if not same:
                            continue
                        changed, new, number = True, number, number + 1
                        seq[new] = words[0][:same] if lead else words[0][:same][::-1]
                        for b in group:
                            n = far[v].pop(b)
                            del near[b][v]
                            far[v][new] += n
                            near[new][v] += n
                            far[new][b] += n
                            near[b][new] += n
                            seq[b] = seq[b][same:] if lead else seq[b][:-same]
            for v in sorted(seq):
                while v in seq and len(out[v]) == 1 and (b := next(iter(out[v]))) != v and len(into[b]) == 1:
                    changed = True
                    seq[v] += seq.pop(b)
                    out[v] = out.pop(b, Counter())
                    into.pop(b)
                    for c in out[v]:
                        into[c][v] = into[c].pop(b)
            if not changed:
                break
        place = {v: i for i, v in enumerate(sorted(seq))}
        return [seq[v] for v in sorted(seq)], sorted((place[a], place[b], n) for a in list(out) for b, n in out[a].items())

    def dot(self, prune: int = 0) -> list[str]:
        """Lines of a DOT graph: edges with their multiplicity, dotted where it is under ``prune``, red on the reference; vertices with the bases they add."""
        names = {v: i for i, v in enumerate(sorted({*(v for v in self.out if self.out[v]), *(v for v in self.into if self.into[v])}))}
        lines = []
        for a in names:
            for b, n in sorted(self.out[a].items()):
                style = "style=dotted,color=grey," if 0 < n < prune else "color=red," if (a, b) in self.on_ref else ""
                lines.append(f'  {names[a]} -> {names[b]} [{style}label="{n}"];')
        return ["digraph region {", *lines, *(f'  {i} [label="{v[-1] if self.into[v] else v}",shape=box];' for v, i in names.items()), "}"]

    def best_paths(self, most: int = 128) -> list[tuple[float, str]]:
        """The ``most`` best source-to-sink sequences by the summed log10 share of each edge among those that leave its vertex."""
        good = self.reachable()
        heap, visits, out = [(0.0, 0, self.source, self.source)], Counter(), []
        tick = 0
        while heap and len(out) < most:
            cost, _, v, seq = heapq.heappop(heap)
            if v == self.sink:
                out.append((-cost, seq))
                continue
            if visits[v] >= most:
                continue
            visits[v] += 1
            nexts = {b: max(n, 1) if (v, b) in self.on_ref else n for b, n in self.out[v].items() if b in good}
            total = sum(nexts.values())
            for b, n in nexts.items():
                if n:
                    tick += 1
                    heapq.heappush(heap, (cost - math.log10(n / total), tick, b, seq + b[-1]))
        return out


# The least multiplicity of a chain and the k-mer sizes of each assembly profile.
PROFILES = {
    "very-fast": (2, (33,)),
    "fast": (2, (21, 33)),
    "precise": (2, (21, 33, 45)),
    "sensitive": (0, (21, 33, 45)),
    "super-sensitive": (0, (21, 33, 45, 57)),
}


def _together(jobs: list) -> list:
    """What the generators return. They yield pairs (ref, alt); what all of them wait for is aligned at once, equal pairs once."""
    out: list = [None] * len(jobs)
    waiting: list[tuple[int, tuple[str, str]]] = []

    def go_on(i, cigar):
        try:
            waiting.append((i, jobs[i].send(cigar)))
        except StopIteration as e:
            out[i] = e.value

    for i in range(len(jobs)):
        go_on(i, None)
    while waiting:
        now, asked = waiting, sorted({p for _, p in waiting})
        waiting = []
        got = dict(zip(asked, align_all(asked, STANDARD, "leading_indel")))
        for i, p in now:
            go_on(i, got[p][1])
    return out


def _found(ref: str, pieces, kmer_sizes, prune: int, most: int, tries: int, by_odds: bool, recover: int | None):
    """Haplotypes and scores of a region; a generator, as of ``_together``. pieces: ((usable bases, how often), ...)."""
    found: dict[str, float] = {ref: 0.0}
    sizes, k = list(kmer_sizes), max(kmer_sizes)
    for attempt in range(tries):
        done = False
        for size in sizes:
            if size + 1 > len(ref):
                continue
            g = Graph(ref, size)
            if g.source in g.repeats or g.sink in g.repeats:
                continue
            for piece, n in pieces:
                g.thread_piece(piece, n)
            if by_odds:
                g.prune_by_odds()
            else:
                g.prune(prune)
            if g.cyclic():
                continue
            if recover is not None:
                yield from g.recovering(recover)
            done = True
            for score, seq in g.best_paths(most):
                found[seq] = max(found.get(seq, -math.inf), score) if seq != ref else 0.0
        if done:
            break
        k += 13 + (k % 2 == 0)
        sizes = [k]
    return found


def assemble(
    ref: str, reads: list[tuple[str, list[int]]], kmer_sizes=(21, 33), prune: int = 1, min_qual: int = 10, most: int = 128, tries: int = 6, by_odds: bool = False, recover: int | None = 1, given=()
) -> list[tuple[float, str, str]]:
    """(score, haplotype, CIGAR) of a region, the reference always among them. k grows by 13 while graphs are cyclic or empty.

    ``by_odds`` prunes by evidence instead of multiplicity; ``recover`` is the shortest dangling branch that is joined (None: none is); ``given`` alleles (offset, ref, alt) are injected.
    """
    pieces = Counter(p for seq, quals in reads for p in usable(seq, quals, min_qual))
    out = assemble_all([(ref, pieces)], kmer_sizes, prune, most, tries, by_odds, recover)[0]
    return inject(ref, out, given) if given else out


def settled(lie: placed.Placed, sure: np.ndarray, score: np.ndarray) -> list[list[tuple[float, str, str]] | None]:
    """(score, haplotype, CIGAR) of each region that needs no graph, None for the others."""
    out: list = []
    for r, (ref, known, x) in enumerate(zip(lie.refs, sure.tolist(), score.tolist())):
        cigar = f"{len(ref)}M"
        found = [(0.0, ref, cigar)]
        if x == x:
            found.append((x, lie.other_haplotype(r), cigar))
        out.append(found if known and ref else None)
    return out


def assemble_all(jobs: list[tuple[str, Counter]], kmer_sizes=(21, 33), prune: int = 1, most: int = 128, tries: int = 6, by_odds: bool = False, recover: int | None = 1) -> list[list[tuple[float, str, str]]]:
    """``assemble`` of regions (ref, usable pieces of reads and how often each occurs). Equal regions are assembled once; no graph is built where placed reads settle a region; alignments of all others are made at once."""
    keys = [(ref, tuple(sorted(pieces.items()))) for ref, pieces in jobs]
    once, made = list(dict.fromkeys(keys)), {}
    if most > 1:
        for at in range(0, len(once), placed.REGIONS):
            some = once[at : at + placed.REGIONS]
            lie = placed.of(some, min(placed.LONGEST, *kmer_sizes))
            made |= {key: out for key, out in zip(some, settled(lie, *lie.haplotypes(kmer_sizes, prune, tries, by_odds, recover))) if out}
    made |= _by_graphs([key for key in once if key not in made], kmer_sizes, prune, most, tries, by_odds, recover)
    return [made[k] for k in keys]


def _by_graphs(once, kmer_sizes, prune: int, most: int, tries: int, by_odds: bool, recover: int | None) -> dict:
    """For each region (ref, ((piece, how often), ...)) its (score, haplotype, CIGAR)."""
    found = _together([_found(ref, pieces, kmer_sizes, prune, most, tries, by_odds, recover) for ref, pieces in once])
    spelled = iter(cigars([(ref, seq) for (ref, _), of in zip(once, found) for seq in of]))
    made = {}
    for (ref, pieces), of in zip(once, found):
        out = [(score, seq, cigar) for (seq, score), cigar in zip(of.items(), spelled) if cigar and "N" not in cigar]
        out.sort(key=lambda x: (x[1] != ref, -x[0], len(x[1]), x[1]))
        made[ref, pieces] = out
    return made


# The density from which regions take more k-mer sizes, those sizes, and how far they keep from others.
DENSE, EXTRA_SIZES, APART, STEP = 0.2, (19, 35, 47), 5, 3


def extra_kmer_sizes(density: float, sizes, dense: float = DENSE) -> list[int]:
    """More k-mer sizes for an active region: the middle one from ``dense`` on, the last two over 0.2 more, all over 0.4 more; each moved up until it is 5 away from those in use."""
    over = density - dense
    if over < 0:
        return []
    out = []
    for k in EXTRA_SIZES if over > 0.4 else EXTRA_SIZES[1:] if over > 0.2 else EXTRA_SIZES[1:2]:
        while any(abs(k - x) < APART for x in sizes):
            k += STEP
        out.append(k)
    return out


def inject(ref: str, haplotypes: list[tuple[float, str, str]], given, best: int = 5) -> list[tuple[float, str, str]]:
    """``haplotypes`` (the reference first, then by score), and those of the ``best`` with each given allele (offset, ref, alt) that none of them has.

    A haplotype with an event that overlaps the allele is left as it is. Alleles whose ref isn't the region's are left out."""
    from .strains import splice

    has = [events(ref, h, c, 0) for _, h, c in haplotypes]
    known, held, out = {e for es in has for e in es}, {h for _, h, _ in haplotypes}, list(haplotypes)
    for at, old, new in given:
        if (at, old, new) in known or ref[at : at + len(old)] != old:
            continue
        for (score, _, _), es in list(zip(haplotypes, has))[:best]:
            if any(p < at + len(old) and at < p + len(r) for p, r, _ in es):
                continue
            seq = splice(ref, [*es, (at, old, new)])
            if seq not in held and (cigar := haplotype_cigar(ref, seq)):
                held.add(seq)
                out.append((score, seq, cigar))
    return out


#: Reference bases, and regions, that are assembled at once.
_BASES, _REGIONS = 1 << 17, 1 << 12


def assemble_regions(regions: DataFrame, reads: DataFrame, kmer_sizes=(21, 33), prune: int = 1, depth: int | None = 200_000, profile: str | None = None, by_odds: bool = False, recover: int | None = 1) -> DataFrame:
    """regions: (region, start, ref), reads: (region, seq, quals). (region, hap_idx, score, hap, cigar). ``depth`` reads of a region at most, the best by mean quality; the default is that of the reference's ``max-input-depth``, None keeps all. A ``profile`` sets the k-mer sizes and ``prune``."""
    if profile:
        prune, kmer_sizes = PROFILES[profile]
    refs = regions.select("region", F.lit(0).alias("kind"), F.col("ref").alias("seq"), F.lit(None).cast("array<int>").alias("quals"))
    both = refs.unionByName(reads.select("region", F.lit(1).alias("kind"), "seq", "quals"))
    # small rows, long kernels: partitions by bytes would leave most cores idle
    dealt = both.repartition(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), "region").sortWithinPartitions("region", "kind")

    def run(batches):
        jobs: list[tuple[int, str, Counter]] = []
        bases = 0
        for region, ref, pieces in _gathered(batches, depth):
            jobs.append((region, ref, pieces))
            bases += len(ref)
            if bases >= _BASES or len(jobs) >= _REGIONS:
                yield _haplotype_rows(jobs, kmer_sizes, prune, by_odds=by_odds, recover=recover)
                jobs, bases = [], 0
        if jobs:
            yield _haplotype_rows(jobs, kmer_sizes, prune, by_odds=by_odds, recover=recover)

    return dealt.mapInArrow(run, "region long, hap_idx int, score double, hap string, cigar string")


def _haplotype_rows(jobs, *how, **more) -> pa.RecordBatch:
    got = assemble_all([(ref, pieces) for _, ref, pieces in jobs], *how, **more)
    return _as_rows([region for region, _, _ in jobs], got)


def _as_rows(regions: list, got: list) -> pa.RecordBatch:
    rows = [(region, i, float(score), hap, cigar) for region, found in zip(regions, got) for i, (score, hap, cigar) in enumerate(found)]
    types = {"region": pa.int64(), "hap_idx": pa.int32(), "score": pa.float64(), "hap": pa.string(), "cigar": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types.values())], list(types))


def _gathered(batches, depth: int | None, min_qual: int = 10):
    """Rows (region, kind, seq, quals) by region and kind, a region's reference (kind 0) first -> (region, reference, usable pieces). Reads without a reference go."""
    at, ref = None, None
    pieces: Counter = Counter()
    held: list[tuple[float, str, list[str]]] = []

    def end():
        if ref is not None:
            best = sorted(held, key=lambda x: x[:2])[:depth] if len(held) > (depth or 0) else held
            pieces.update(p for _, _, ps in best for p in ps)
            yield at, ref, pieces

    for batch in batches:
        keys, kinds, seqs = (batch.column(i).to_pylist() for i in range(3))
        lists = batch.column(3)
        sizes = np.array(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
        sums, low = (np.concatenate(([0], np.cumsum(x, dtype=np.int64))) for x in (flat, flat < min_qual))
        starts = ends - sizes
        total, bad = ((x[ends] - x[starts]).tolist() for x in (sums, low))
        ends, starts = ends.tolist(), starts.tolist()
        for i, (region, kind, seq) in enumerate(zip(keys, kinds, seqs)):
            if region != at:
                yield from end()
                at, ref, pieces, held = region, None, Counter(), []
            if not kind:
                ref = seq if ref is None else ref
            elif ref is not None:
                n = ends[i] - starts[i]
                whole = not bad[i] and n == len(seq) and not seq.translate(_OTHER)
                parts = ([seq] if n else []) if whole else usable(seq, flat[starts[i] : ends[i]].tolist(), min_qual)
                if depth is None:
                    pieces.update(parts)
                    continue
                held.append((-total[i] / max(n, 1), seq, parts))
                if len(held) >= 2 * max(depth, 1):
                    held = sorted(held, key=lambda x: x[:2])[:depth]
    yield from end()


def assemble_rows(regions: DataFrame, kmer_sizes=(21, 33), prune: int = 1, depth: int | None = 200_000, by_odds: bool = False, recover: int | None = 1) -> DataFrame:
    """``assemble_regions`` for regions (region, ref, reads) that hold their reads, array<struct<seq, quals>> with qualities as in FASTQ (a character each, 33 more than the level). Rows of one region are taken together, the first one's reference for all."""

    def run(batches):
        for some in _nested(batches, min(placed.LONGEST, *kmer_sizes), depth):
            sure, score = some.lie.haplotypes(kmer_sizes, prune, by_odds=by_odds, recover=recover)
            got = settled(some.lie, sure, score)
            rest = {g: some.job(g) for g, found in enumerate(got) if not found}
            made = _by_graphs(list(dict.fromkeys(rest.values())), kmer_sizes, prune, 128, 6, by_odds, recover)
            yield _as_rows(some.regions, [found or made[rest[g]] for g, found in enumerate(got)])

    return _by_region(regions).mapInArrow(run, "region long, hap_idx int, score double, hap string, cigar string")


def count_haplotypes(regions: DataFrame, ways: dict[str, tuple[int, tuple[int, ...]]], depth: int | None = 200_000) -> DataFrame:
    """(region, profile, haplotypes): how many ``assemble_rows`` finds for each of ``ways``, name -> (prune, k-mer sizes) as in ``PROFILES``. Regions are read, and their reads placed, once for all."""

    def run(batches):
        for some in _nested(batches, min(placed.LONGEST, *(k for _, sizes in ways.values() for k in sizes)), depth):
            for name, (prune, sizes) in ways.items():
                sure, score = some.lie.haplotypes(sizes, prune)
                count = np.where(np.isnan(score), 1, 2)
                rest = {g: some.job(g) for g in np.flatnonzero(~sure).tolist()}
                made = _by_graphs(list(dict.fromkeys(rest.values())), sizes, prune, 128, 6, False, 1)
                for g, job in rest.items():
                    count[g] = len(made[job])
                yield pa.RecordBatch.from_arrays([pa.array(some.regions, pa.int64()), pa.array([name] * len(count)), pa.array(count, pa.int64())], ["region", "profile", "haplotypes"])

    return _by_region(regions).mapInArrow(run, "region long, profile string, haplotypes long")


def _by_region(regions: DataFrame) -> DataFrame:
    return regions.select(F.col("region").cast("long").alias("region"), "ref", F.transform("reads", lambda x: F.struct(x["seq"].alias("seq"), x["quals"].alias("quals"))).alias("reads"))


class _Nested:
    """Some regions with their references, pieces and ``placed.Placed``."""

    def __init__(self, regions: list, refs: list[str], bases: np.ndarray, sizes: np.ndarray, owner: np.ndarray, size: int):
        self.regions, self.refs, self.bases = regions, refs, bases
        self.ends = np.cumsum(sizes)
        self.starts, self.first = self.ends - sizes, np.searchsorted(owner, np.arange(len(refs) + 1))
        self.lie = placed.Placed(refs, bases, sizes, owner, np.ones(len(sizes), np.int64), size)

    def job(self, g: int) -> tuple[str, tuple]:
        mine = range(self.first[g], self.first[g + 1])
        pieces = Counter(bytes(self.bases[self.starts[p] : self.ends[p]]).decode() for p in mine)
        return self.refs[g], tuple(sorted(pieces.items()))


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and how many are each row's."""
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], np.diff(ends)


def _nested(batches, size: int, depth: int | None, min_qual: int = 10):
    """Batches of rows (region, ref, reads), those of a region one after the other -> ``_Nested``."""
    for batch in _whole(batches):
        ids = batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
        begins = np.concatenate(([0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)]))
        lengths = np.concatenate(([0], np.cumsum(_letters(batch.column(1))[1])))
        at = 0
        while at < len(begins) - 1:
            to = int(np.searchsorted(lengths[begins], lengths[begins[at]] + 2 * _BASES))
            to = max(at + 1, min(to, len(begins) - 1, at + placed.REGIONS))
            yield _some(batch.slice(begins[at], begins[to] - begins[at]), begins[at : to + 1] - begins[at], size, depth, min_qual)
            at = to


def _whole(batches):
    """The same rows; no region goes on in another batch."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0] if batch.num_rows else held
        if not batch.num_rows:
            continue
        ids = batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
        others = np.flatnonzero(ids != ids[-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield batch.slice(0, cut)
        held = batch.slice(cut)
    if held is not None:
        yield held


def _some(rows: pa.RecordBatch, begins: np.ndarray, size: int, depth: int | None, min_qual: int) -> _Nested:
    regions, refs = (rows.column(c).take(pa.array(begins[:-1])).to_pylist() for c in (0, 1))
    reads = rows.column(2)
    ends = np.concatenate(([0], np.cumsum(reads.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
    counts = np.diff(ends[begins])
    owner = np.repeat(np.arange(len(refs)), counts)
    seq, quals = reads.flatten().flatten()
    bases, sizes = _letters(seq)
    levels, given = _letters(quals)
    if (given < sizes).any() or (levels < 33 + min_qual).any() or (placed.CODES[bases] > 3).any() or (depth is not None and (counts > depth).any()):
        kept: list[list[str]] = [[] for _ in refs]
        scored: list[list[tuple[float, str, list[str]]]] = [[] for _ in refs]
        for g, s, q in zip(owner.tolist(), seq.cast(pa.binary()).to_pylist(), quals.cast(pa.binary()).to_pylist()):
            s, q = (s or b"").decode(), [x - 33 for x in q or b""]
            scored[g].append((-sum(q) / max(len(q), 1), s, usable(s, q, min_qual)))
        for g, held in enumerate(scored):
            best = sorted(held, key=lambda x: x[:2])[:depth] if depth is not None and len(held) > depth else held
            kept[g] = [p for _, _, ps in best for p in ps]
        sizes = np.array([len(p) for ps in kept for p in ps], np.int64)
        bases = np.frombuffer("".join(p for ps in kept for p in ps).encode(), np.uint8)
        owner = np.repeat(np.arange(len(refs)), [len(ps) for ps in kept])
    return _Nested(regions, refs, bases, sizes, owner, size)
