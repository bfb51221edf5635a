"""Scalar kernels on one read or haplotype: clipping, left alignment, tandem repeats, phasing, likelihood ratio."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import maths as M


def parse(cigar: str) -> list[list]:
    return [[int(n), op] for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]


def join(parts) -> str:
    out: list[list] = []
    for n, op in parts:
        if n <= 0:
            continue
        if out and out[-1][1] == op:
            out[-1][0] += n
        else:
            out.append([n, op])
    return "".join(f"{n}{op}" for n, op in out)


def clip_to(start: int, cigar: str, seq: str, low: int, high: int) -> tuple[int, str, str] | None:
    """(start, CIGAR, bases) of the part of a read on low..high (inclusive); what lies outside is hard-clipped. None if nothing is left. Deletions at the new ends go."""
    ref, at = start, 0
    kept, left, right, first = [], 0, 0, None
    bases = []
    for n, op in parse(cigar):
        if op in "M=X":
            for _ in range(n):
                if low <= ref <= high:
                    first = ref if first is None else first
                    kept.append([1, op])
                    bases.append(seq[at])
                elif ref < low:
                    left += 1
                else:
                    right += 1
                ref, at = ref + 1, at + 1
        elif op in "DN":
            for _ in range(n):
                if low <= ref <= high and kept:
                    kept.append([1, op])
                ref += 1
        elif op in "IS":
            inside = op == "I" and low < ref <= high and kept
            if inside:
                kept.append([n, op])
                bases.append(seq[at : at + n])
            elif ref <= low or not kept:
                left += n
            else:
                right += n
            at += n
    while kept and kept[-1][1] in "DN":
        kept.pop()
    if first is None:
        return None
    return first, join([[left, "H"], *kept, [right, "H"]]), "".join(bases)


def left_align(ref: str, start: int, cigar: str, seq: str) -> str:
    """Moves each indel to its leftmost equivalent place within the match run before it."""
    parts = parse(cigar)
    i = j = 0
    pos = []
    for n, op in parts:
        pos.append((i, j))
        i += n if op in "MDN=X" else 0
        j += n if op in "MIS=X" else 0
    for k, (n, op) in enumerate(parts):
        if op in "ID" and 0 < k < len(parts) - 1 and parts[k - 1][1] == "M" and parts[k + 1][1] == "M":
            r, q = pos[k]
            shift = 0
            while shift < parts[k - 1][0] - 1:
                a, b = start + r - shift - 1, q - shift - 1
                same = ref[a] == ref[a + n] if op == "D" else seq[b] == seq[b + n]
                if not same or ref[a] != seq[b]:
                    break
                shift += 1
            parts[k - 1][0] -= shift
            parts[k + 1][0] += shift
            pos[k] = (r - shift, q - shift)
    return join(parts)


def trim_haplotype(start: int, cigar: str, hap: str, low: int, high: int) -> tuple[str, str] | None:
    """(bases, CIGAR) of a haplotype on low..high (inclusive, within its span). Insertions at the new ends go, deletions there stay. None if either end lies in a deletion or no base is left."""
    ref, at, kept, bases = start, 0, [], []
    first = last = None
    for n, op in parse(cigar):
        if op in "M=XD":
            for _ in range(n):
                if low <= ref <= high:
                    first, last = first or op, op
                    kept.append((1, op))
                    bases.append("" if op == "D" else hap[at])
                ref, at = ref + 1, at + (op != "D")
        else:
            if low < ref <= high:
                kept.append((n, op))
                bases.append(hap[at : at + n])
            at += n
    return None if first in (None, "D") or last == "D" else ("".join(bases), join(kept))


#: match, mismatch, gap open, gap extend of reads against their best haplotype
TO_BEST_HAPLOTYPE = (10, -15, -30, -5)


def to_reference(read: str, hap: str, hap_cigar: str, ref: str, ref_start: int) -> tuple[int, str] | None:
    """(start, CIGAR) of a read on the reference by way of its best haplotype: aligned to the haplotype, mapped through the haplotype's CIGAR, moved left, deletions at its ends dropped. None if no base lands on the reference."""
    from .kernels import align

    places: list[int | None] = []
    at = 0
    for n, op in parse(hap_cigar):
        if op in "M=X":
            places += range(at, at + n)
        elif op in "IS":
            places += [None] * n
        at += n if op in "M=XDN" else 0
    j, on_read = align(hap, read, TO_BEST_HAPLOTYPE, "soft_clip")
    parts: list[tuple[int, str]] = []
    first = last = None
    for n, op in parse(on_read):
        if op in "SI":
            parts.append((n, op))
            continue
        for place in places[j : j + n]:
            if place is not None:
                if last is not None and place > last + 1:
                    parts.append((place - last - 1, "D"))
                first, last = place if first is None and op == "M" else first, place if first is not None or op == "M" else last
            if op == "M" or (place is not None and first is not None):
                parts.append((1, "I" if place is None else "M" if op == "M" else "D"))
        j += n
    if first is None:
        return None
    whole = parse(left_align(ref, first, join(parts), read))
    while whole and any(op == "D" for _, op in (whole[0], whole[-1])):
        first += whole[0][0] if whole[0][1] == "D" else 0
        whole = whole[whole[0][1] == "D" : len(whole) - (len(whole) > 1 and whole[-1][1] == "D")]
    return ref_start + first, join(whole)


def tandem_unit(bases: str, offset: int, longest: int = 8) -> tuple[str, int]:
    """Repeat unit of up to ``longest`` bases that ends at ``offset``, going on after it, with most copies around it; ties to the shorter unit."""
    best = (bases[offset : offset + 1], 1)
    for size in range(1, longest + 1):
        if offset + 1 - size < 0:
            break
        unit = bases[offset + 1 - size : offset + 1]
        n, at = 1, offset + 1 - 2 * size
        while at >= 0 and bases[at : at + size] == unit:
            n, at = n + 1, at - size
        at = offset + 1
        while bases[at : at + size] == unit:
            n, at = n + 1, at + size
        if n > best[1]:
            best = (unit, n)
    return best


def adaptor_boundary(start: Column, mate_start: Column, insert: Column, reverse: Column) -> Column:
    """Where the adaptor begins: before the mate for reverse reads, after the fragment for forward ones."""
    return F.when(reverse, mate_start - 1).otherwise(start + F.abs(insert))


def fragment_defined(paired: Column, unmapped: Column, mate_unmapped: Column, insert: Column, reverse: Column, mate_reverse: Column, start: Column, end: Column, mate_start: Column) -> Column:
    ok = F.when(reverse, end > mate_start).otherwise(start <= mate_start + insert)
    return paired & ~unmapped & ~mate_unmapped & (insert != 0) & (reverse != mate_reverse) & ok


def log_likelihood_ratio(n_ref: Column, alt_quals: Column, repeat: float = 1.0) -> Column:
    """Natural-log evidence of a variant over errors, with a flat prior on its frequency: the log of the beta integral over the counts plus each alt read's expected gain."""
    n_alt = F.size(alt_quals)
    import math

    beta = (M.log10_factorial(n_ref) + M.log10_factorial(n_alt) - M.log10_factorial(n_ref + n_alt + 1)) * math.log(10)
    ratio = F.exp(M.digamma((n_ref + 1).cast("double")) - M.digamma((n_alt + 1).cast("double")))

    def gain(q):
        e = M.qual_to_error_prob(q.cast("double"))
        z = (1.0 - e) / (1.0 - e + e * ratio)
        return z * (F.log(1.0 - e) - F.log(e)) + M.fast_bernoulli_entropy(z)

    return beta + M.total(F.transform(alt_quals, gain)) * repeat


def phase(calls: list[tuple[int, frozenset]], everything: frozenset) -> dict[int, tuple[int, str]]:
    """calls: (start, haplotypes that carry the alt). Call index -> (phase set, genotype): calls on the same haplotypes are 0|1 together, on complementary ones 1|0; a contradiction clears all."""
    out: dict[int, tuple[int, str]] = {}
    turn = {"0|1": "1|0", "1|0": "0|1"}
    for i in range(len(calls)):
        for j in range(i + 1, len(calls)):
            a, b = calls[i][1], calls[j][1]
            if not a or not b:
                continue
            same = a == b
            across = not same and not (a & b) and a | b == everything
            if not (same or across):
                continue
            if i in out:
                want = (out[i][0], out[i][1] if same else turn[out[i][1]])
                if j in out and out[j] != want:
                    return {}
                out[j] = want
            elif j in out:
                return {}
            else:
                out[i] = (calls[i][0], "0|1")
                out[j] = (calls[i][0], "0|1" if same else "1|0")
    return out


def clip_reads(reads: DataFrame, low: str, high: str) -> DataFrame:
    """reads: (rid, start, cigar_text, seq, ...). Their parts on [low, high]; reads without one are left out."""

    def run(batches):
        for pdf in batches:
            rows = []
            for rid, s, c, q, a, b in zip(pdf.rid, pdf.start, pdf.cigar_text, pdf.seq, pdf[low], pdf[high]):
                got = clip_to(int(s), c, q, int(a), int(b))
                if got:
                    rows.append((rid, *got))
            yield pd.DataFrame(rows, columns=["rid", "start", "cigar", "seq"])

    return reads.select("rid", "start", "cigar_text", "seq", low, high).mapInPandas(run, "rid long, start long, cigar string, seq string")
