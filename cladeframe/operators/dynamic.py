"""Dynamic programs over batches of sequence pairs: affine-gap alignment and the pair hidden Markov model.

All cells of an anti-diagonal depend on the two before it only, so each step is one set of array operations over a diagonal of every pair of
the batch. Shorter pairs are padded: a cell never depends on cells right of it or below it, so padding changes nothing inside a pair.
"""

from __future__ import annotations

import numpy as np

#: match, mismatch, gap open, gap extend
ORIGINAL, STANDARD, NEW_SW = (3, -1, -4, -3), (25, -50, -110, -6), (200, -150, -260, -11)

#: Cells of one batch.
CELLS = 1 << 24
_NONE = np.iinfo(np.int64).min // 4
# what a cell's best score comes from, and whether a gap that ends in it is longer than one
_FROM_INSERTION, _FROM_DELETION, _LONGER_INSERTION, _LONGER_DELETION = 1, 2, 4, 8


def _padded(texts: list[str], fill: int) -> np.ndarray:
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    out = np.full((len(raw), max(map(len, raw), default=0)), fill, np.uint8)
    for row, x in zip(out, raw):
        row[: len(x)] = x
    return out


def batches(sizes: list[tuple[int, int]], cells: int = CELLS):
    """Places of pairs of like size, so many at once that their padded grids hold at most ``cells`` (one pair at least)."""
    group: list[int] = []
    width = height = 0
    for i in sorted(range(len(sizes)), key=lambda k: sizes[k]):
        n, m = max(width, sizes[i][0] + 1), max(height, sizes[i][1] + 1)
        if group and n * (n + m) * (len(group) + 1) > cells:
            yield group
            group, n, m = [], sizes[i][0] + 1, sizes[i][1] + 1
        group.append(i)
        width, height = n, m
    if group:
        yield group


class _Grid:
    """Scores on the last column and row of each pair, and the moves of all cells, [diagonal, pair, row]."""

    def __init__(self, refs: list[str], alts: list[str], params, charged: bool):
        match, mismatch, opening, extend = params
        ref, alt = _padded(refs, 0), _padded(alts, 1)
        k, n, m = len(refs), ref.shape[1], alt.shape[1]
        self.n, self.m = np.array([len(x) for x in refs]), np.array([len(x) for x in alts])
        self.moves = np.zeros((n + m + 1, k, n + 1), np.uint8)
        self.column, self.row = np.full((k, n + 1), _NONE), np.full((k, m + 1), _NONE)
        edge = lambda d: opening + extend * (d - 1) if charged and d else 0
        every = np.arange(k)
        best2 = np.full((k, n + 1), _NONE)
        best1 = best2.copy()
        best1[:, 0] = 0
        gap_in, gap_out = np.full((k, n + 1), _NONE), np.full((k, n + 1), _NONE)
        self._note(0, best1, every)
        for d in range(1, n + m + 1):
            best = np.full((k, n + 1), _NONE)
            ins, dele = best.copy(), best.copy()
            low, high = max(1, d - m), min(n, d - 1)
            if low <= high:
                here, above = slice(low, high + 1), slice(low - 1, high)
                same = ref[:, low - 1 : high] == alt[:, d - high - 1 : d - low][:, ::-1]
                diagonal = best2[:, above] + np.where(same, match, mismatch)
                fresh, longer = best1[:, above] + opening, gap_out[:, above] + extend
                dele[:, here] = np.maximum(fresh, longer)
                moves = np.where(longer >= fresh, _LONGER_DELETION, 0)
                fresh, longer = best1[:, here] + opening, gap_in[:, here] + extend
                ins[:, here] = np.maximum(fresh, longer)
                moves |= np.where(longer >= fresh, _LONGER_INSERTION, 0)
                gap = np.maximum(ins[:, here], dele[:, here])
                best[:, here] = np.maximum(diagonal, gap)
                moves |= np.where(diagonal >= gap, 0, np.where(ins[:, here] == gap, _FROM_INSERTION, _FROM_DELETION))
                self.moves[d, :, here] = moves
            if d <= m:
                best[:, 0] = edge(d)
            if d <= n:
                best[:, d] = edge(d)
            self._note(d, best, every)
            best2, best1, gap_in, gap_out = best1, best, ins, dele

    def _note(self, d: int, best: np.ndarray, every: np.ndarray) -> None:
        i = d - self.m
        on = every[(i >= 0) & (i <= self.n)]
        self.column[on, i[on]] = best[on, i[on]]
        j = d - self.n
        on = every[(j >= 0) & (j <= self.m)]
        self.row[on, j[on]] = best[on, self.n[on]]

    def end(self, p: int, overhang: str) -> tuple[int, int]:
        """Where the alignment of pair p ends. Ties: the cell of the last column that is lowest; one of the last row only if it is nearer to the main diagonal."""
        n, m = int(self.n[p]), int(self.m[p])
        if overhang == "indel":
            return n, m
        column, row = self.column[p, 1 : n + 1], self.row[p, 1 : m + 1]
        if not len(column):
            return n, m
        i, j, top = n - int(np.argmax(column[::-1])), m, int(column.max())
        if overhang != "leading_indel" and len(row):
            most = int(row.max())
            ends = np.flatnonzero(row == most) + 1
            nearest = int(ends[np.argmin(np.abs(n - ends))])
            if most > top or (most == top and abs(n - nearest) < abs(i - m)):
                i, j = n, nearest
        return i, j

    def steps(self, p: int, i: int, j: int):
        """Operations from the end (i, j) backwards until an edge is met; last the edge's place."""
        state = ""
        while i and j:
            moves = int(self.moves[i + j, p, i])
            if not state:
                state = "I" if moves & _FROM_INSERTION else "D" if moves & _FROM_DELETION else ""
            if not state:
                i, j = i - 1, j - 1
                yield "M"
                continue
            yield state
            stays = moves & (_LONGER_INSERTION if state == "I" else _LONGER_DELETION)
            i, j = (i, j - 1) if state == "I" else (i - 1, j)
            state = state if stays else ""
        yield i, j


def _runs(ops: list[tuple[int, str]]) -> str:
    out: list[list] = []
    for k, op in ops:
        if k and out and out[-1][1] == op:
            out[-1][0] += k
        elif k:
            out.append([k, op])
    return "".join(f"{k}{op}" for k, op in out)


def align_all(pairs: list[tuple[str, str]], params=NEW_SW, overhang: str = "soft_clip", cells: int = CELLS) -> list[tuple[int, str]]:
    """(offset of alt on ref, CIGAR) of each (ref, alt) by affine-gap alignment. Ties: diagonal, then insertion, then deletion; a longer gap before a new one.

    overhang: soft_clip (free ends, clipped), ignore (free ends, as matches beyond the reference), indel (end to end; ends are gaps) or leading_indel
    (as indel, but the reference may go on). With free ends an alt that the reference holds is placed where it occurs last. ``params`` must not reward gaps.
    """
    out: list = [None] * len(pairs)
    charged = overhang in ("indel", "leading_indel")
    left = []
    for k, (ref, alt) in enumerate(pairs):
        at = -1 if charged else ref.rfind(alt)
        if at >= 0:
            out[k] = (at, _runs([(len(alt), "M")]))
        else:
            left.append(k)
    outside = {"soft_clip": "S", "ignore": "M"}.get(overhang, "I")
    for group in batches([tuple(map(len, pairs[k])) for k in left], cells):
        chosen = [left[g] for g in group]
        grid = _Grid([pairs[k][0] for k in chosen], [pairs[k][1] for k in chosen], params, charged)
        for p, k in enumerate(chosen):
            end = grid.end(p, overhang)
            out[k] = _spelled(list(grid.steps(p, *end)), end[1], len(pairs[k][1]), outside, overhang)
    return out


def _spelled(steps: list, end: int, length: int, outside: str, overhang: str) -> tuple[int, str]:
    """``steps`` backwards from column ``end`` of the alt, then the place on the edge."""
    *back, (i, j) = steps
    inner, tail = [(1, op) for op in reversed(back)], (length - end, outside)
    if overhang in ("indel", "leading_indel"):
        return 0, _runs([(i, "D"), (j, "I"), *inner, tail])
    return (i if overhang == "soft_clip" else i - j), _runs([(j, outside), *inner, tail])


def align(ref: str, alt: str, params=NEW_SW, overhang: str = "soft_clip") -> tuple[int, str]:
    """``align_all`` of one pair."""
    return align_all([(ref, alt)], params, overhang)[0]


_SCALE = 2.0**1020


def _odds(levels, lengths: list[int], width: int) -> np.ndarray:
    """Error probabilities of Phred levels: one level for all, or one list for each read. Column 0 stands for no base."""
    out = np.zeros((len(lengths), width + 1))
    if np.isscalar(levels):
        out[:] = 10.0 ** (levels / -10.0)
    else:
        for row, n, x in zip(out, lengths, levels):
            row[1 : n + 1] = 10.0 ** (np.broadcast_to(np.asarray(x, float), n) / -10.0)
    return out


def pair_hmm_all(pairs: list[tuple[str, str]], quals, ins=45, dele=45, gcp=10, cells: int = 1 << 16) -> np.ndarray:
    """log10 likelihood of each pair (haplotype, read); 0 if either is empty. ``quals`` holds a list for each read, the gap levels a number or such lists."""
    out = np.zeros(len(pairs))
    some = [k for k, (h, r) in enumerate(pairs) if h and r]
    pick = lambda x, group: x if np.isscalar(x) else [x[k] for k in group]
    sizes = [(len(pairs[k][1]), len(pairs[k][0])) for k in some]
    at = 0
    order = sorted(range(len(some)), key=lambda g: sizes[g])
    while at < len(order):
        many = max(1, cells // (sizes[order[at]][0] + 1))
        group = [some[g] for g in order[at : at + many]]
        at += many
        out[group] = _hmm([pairs[k][0] for k in group], [pairs[k][1] for k in group], *(pick(x, group) for x in (quals, ins, dele, gcp)))
    return out


def _hmm(haps: list[str], reads: list[str], quals, ins, dele, gcp) -> np.ndarray:
    """States by read position, a diagonal of read and haplotype positions a step."""
    hap, read = _padded(haps, 0), _padded(reads, 1)
    k, n, width = len(haps), hap.shape[1], read.shape[1]
    lengths, spans = [len(x) for x in reads], np.array([len(x) for x in haps])
    last, every = np.array(lengths), np.arange(k)
    err, mi, md, gap = (_odds(x, lengths, width) for x in (quals, ins, dele, gcp))
    stay, back, wrong = 1 - (mi + md), 1 - gap, err / 3
    zero = np.zeros((k, width + 1))
    m1, i1, d1, m2, i2, d2 = (zero.copy() for _ in range(6))
    start = _SCALE / spans
    d1[:, 0] = start
    total = np.zeros(k)
    for t in range(1, n + width + 1):
        m, i, d = zero.copy(), zero.copy(), zero.copy()
        low, high = max(1, t - n), min(width, t - 1)
        if low <= high:
            here, above = slice(low, high + 1), slice(low - 1, high)
            x, y = read[:, low - 1 : high], hap[:, t - high - 1 : t - low][:, ::-1]
            prior = np.where((x == y) | (x == 78) | (y == 78), 1 - err[:, here], wrong[:, here])
            m[:, here] = prior * (m2[:, above] * stay[:, here] + (i2[:, above] + d2[:, above]) * back[:, here])
            i[:, here] = m1[:, above] * mi[:, here] + i1[:, above] * gap[:, here]
            d[:, here] = m1[:, here] * md[:, here] + d1[:, here] * gap[:, here]
        if t <= n:
            d[:, 0] = start
        on = every[(t > last) & (t - last <= spans)]
        total[on] += m[on, last[on]] + i[on, last[on]]
        m2, i2, d2, m1, i1, d1 = m1, i1, d1, m, i, d
    return np.log10(total) - np.log10(_SCALE)


def pair_hmm(hap: str, read: str, quals, ins=45, dele=45, gcp=10) -> float:
    """``pair_hmm_all`` of one pair."""
    return float(pair_hmm_all([(hap, read)], [quals], *(x if np.isscalar(x) else [x] for x in (ins, dele, gcp)))[0])
