"""Assembly of many regions at once where no graph has to be built: those whose reads, placed on the reference, differ from it in one base at most.

Two facts settle a region as ``kernels.Graph`` would. A reference with a repeated k-mer makes the graph of that k cyclic, whatever the reads are, as edges of
the reference are never pruned. And if no k-mer repeats, and none over the differing base is one of the reference's, the graph is the reference's chain
and one chain beside it, whose ends, multiplicities and recovered end follow from where the reads lie. Any other region is left to the graphs.
"""

from __future__ import annotations

import math

import numpy as np

#: Letters of the k-mers by which reads are placed, at most, and regions of a batch: both fit 64 bits.
LONGEST, REGIONS = 25, 1 << 13
CODES = np.full(256, 4, np.uint8)
CODES[np.frombuffer(b"ACGT", np.uint8)] = range(4)


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """The two-bit code of each window of ``size`` letters."""
    power, width, out, have = codes.astype(np.int64), 1, None, 0
    while True:
        if size & width:
            out = power if out is None else (out[: len(power) - have] << 2 * width) | power[have : have + max(len(out) - width, 0)]
            have += width
        if have == size:
            return out
        power = (power[: max(len(power) - width, 0)] << 2 * width) | power[width:]
        width *= 2


class Placed:
    """Regions ``refs`` and their pieces: letters ``bases`` one after the other, their ``sizes``, whose they are (``owner``, ascending) and how often each occurs."""

    def __init__(self, refs: list[str], bases: np.ndarray, sizes: np.ndarray, owner: np.ndarray, times: np.ndarray, size: int):
        self.refs, self.s = refs, size
        self.n = np.array([len(r) for r in refs], np.int64)
        starts = np.cumsum(sizes) - sizes
        if (sizes <= size).any():  # they hold no edge
            long = sizes > size
            bases = bases[np.repeat(long, sizes)]
            sizes, owner, times = sizes[long], owner[long], times[long]
            starts = np.cumsum(sizes) - sizes
        self.sizes, self.owner, self.times, self.starts, self.bases = sizes, owner, times, starts, bases
        self.most = np.zeros(len(refs), np.int64)
        np.maximum.at(self.most, owner, sizes)
        self.ref = np.frombuffer("".join(refs).encode("latin-1", "replace"), np.uint8)
        self.at = np.cumsum(self.n) - self.n
        self._longer: dict[int, np.ndarray] = {}
        self._same: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._unreached: dict[int, int] = {}
        self._index()
        self.good = np.ones(len(refs), bool)
        odd = np.flatnonzero(CODES[self.ref] > 3)
        self.plain = np.ones(len(refs), bool)
        self.plain[np.searchsorted(self.at + self.n, odd, "right")] = False
        self.good &= self.plain
        self._place()
        self._differ()

    def _index(self) -> None:
        """All windows of the references in order, with their region, and which of them repeat in it."""
        s, total = self.s, len(self.ref)
        region = np.repeat(np.arange(len(self.refs)), self.n)
        if total < s:
            self.keys = self.where = np.empty(0, np.int64)
            self.twice, self.window = np.empty(0, bool), np.empty(0, np.int64)
        else:
            self.window = _rolled(CODES[self.ref] & 3, s)
            here = region[: total - s + 1]
            valid = np.flatnonzero(here == region[s - 1 :])
            keys = (here[valid] << 2 * s) | self.window[valid]
            order = np.argsort(keys)
            self.keys, self.where = keys[order], valid[order]
            same = self.keys[1:] == self.keys[:-1]
            self.twice = np.zeros(len(keys), bool)
            self.twice[1:] |= same
            self.twice[:-1] |= same

    def _found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its place in the order."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[k] == keys, k

    def _place(self) -> None:
        """``lies``: the place of each piece on its reference, by a window of it that occurs there once, or over all of it; where neither does its region isn't good."""
        s, many = self.s, len(self.sizes)
        self.lies = np.full(many, -1, np.int64)
        for share in (0, 4, 2, 1, 3):
            left = np.flatnonzero((self.lies < 0) & self.good[self.owner])
            if not len(left):
                break
            off = (self.sizes[left] - s) * share // 4
            first, code = self.starts[left] + off, np.zeros(len(left), np.int64)
            for t in range(s):
                code = (code << 2) | CODES[self.bases[first + t]]
            own = self.owner[left]
            hit, k = self._found((own << 2 * s) | code)
            lies = self.where[k] - self.at[own] - off if len(self.where) else off
            hit &= ~self.twice[k] if len(self.twice) else False
            hit &= (lies >= 0) & (lies + self.sizes[left] <= self.n[own])
            self.lies[left[hit]] = lies[hit]
        # what is as long as the reference lies nowhere else; one window of it after the other can hold a differing base
        self.lies[(self.lies < 0) & (self.sizes == self.n[self.owner])] = 0
        self.good[self.owner[self.lies < 0]] = False

    def _differ(self) -> None:
        """``x``, ``base``: the one base of a region's pieces that isn't the reference's (-1: none)."""
        r = len(self.refs)
        self.x, self.base = np.full(r, -1, np.int64), np.zeros(r, np.uint8)
        self.other = np.zeros(len(self.sizes), bool)
        if not len(self.sizes):
            return
        far = np.maximum(self.lies, 0) + self.at[self.owner] - self.starts
        index = np.repeat(far, self.sizes)
        index += np.arange(len(self.bases))
        letters = np.flatnonzero(self.bases != self.ref.take(index, mode="clip"))
        piece = np.searchsorted(self.starts, letters, "right") - 1
        count = np.bincount(piece, minlength=len(self.sizes))
        usable = self.good[self.owner]
        self.good[self.owner[usable & (count > 1)]] = False
        self.other = count == 1
        letters = letters[self.other[piece]]
        owner, base = self.owner[self.other], self.bases[letters]
        x = index[letters] - self.at[owner]
        # of several the last is taken, and all have to be like it
        self.x[owner], self.base[owner] = x, base
        self.good[owner[(self.x[owner] != x) | (self.base[owner] != base)]] = False
        self._new(np.flatnonzero(self.good & (self.x >= 0)))

    def _new(self, rs: np.ndarray) -> None:
        """Regions of which a window over the differing base occurs elsewhere aren't good."""
        s = self.s
        if not len(rs):
            return
        x, shift = self.x[rs], CODES[self.base[rs]].astype(np.int64) - CODES[self.ref[self.at[rs] + self.x[rs]]]
        made = np.empty((len(rs), s), np.int64)
        for t in range(s):
            w = x - t
            there = (w >= 0) & (w + s <= self.n[rs])
            made[:, t] = -1 - t
            made[there, t] = (rs[there] << 2 * s) | (self.window[self.at[rs[there]] + w[there]] + (shift[there] << 2 * (s - 1 - t)))
            self.good[rs[self._found(made[:, t])[0]]] = False
        made.sort(axis=1)
        self.good[rs[(made[:, 1:] == made[:, :-1]).any(axis=1)]] = False

    def longer(self, k: int) -> np.ndarray:
        """Regions whose reference holds a k-mer twice, k at least as long as the windows."""
        if k not in self._longer:
            self._longer[k] = np.zeros(len(self.refs), bool)
            self._longer[k][np.searchsorted(self.at + self.n, self._alike(k)[0], "right")] = True
        return self._longer[k]

    def _alike(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of k-mers that repeat in their reference, ascending, and a number for each that equal ones share. A k-mer is two shorter ones, one at its beginning and one at its end."""
        if not self._same:
            order = np.argsort(self.where[self.twice])
            keys = self.keys[self.twice]
            self._same[self.s] = self.where[self.twice][order], np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1])))[order] if len(keys) else keys
        size = max(j for j in self._same if j <= k)
        while size < k:
            where, same = self._same[size]
            step = min(size, k - size)
            size += step
            if len(where):
                other = np.minimum(np.searchsorted(where, where + step), len(where) - 1)
                ends = (self.at + self.n)[np.searchsorted(self.at + self.n, where, "right")]
                both = np.flatnonzero((where[other] == where + step) & (where + size <= ends))
                pairs = same[both] * (int(same.max()) + 1) + same[other[both]]
                order = np.argsort(pairs)
                pairs = pairs[order]
                first = np.concatenate(([True], pairs[1:] != pairs[:-1]))[: len(pairs)]
                alone = first & np.concatenate((first[1:], [True]))[: len(pairs)]
                kept, number = both[order][~alone], np.cumsum(first)[~alone]
                order = np.argsort(kept)
                where, same = where[kept[order]], number[order]
            self._same[size] = where, same
        return self._same[k]

    def _beside(self, k: int, prune: int, by_odds: bool, recover: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For regions without a repeated k-mer: whether that is settled, and the multiplicity of the other base's way where it leaves the reference (0: there is no such way), of all ways there."""
        r = len(self.refs)
        held = self.sizes > k
        p = np.flatnonzero(held & self.other & self.good[self.owner])
        own, x = self.owner[p], self.x[self.owner[p]]
        # edges j of the other chain: those of windows of k + 1 bases over x, counted from x - k
        low = np.maximum(self.lies[p], x - k) - (x - k)
        high = np.minimum(self.lies[p] + self.sizes[p] - k - 1, x) - (x - k)
        rs, row = np.unique(own, return_inverse=True)
        wide = k + 2
        size = len(rs) * wide
        steps = np.bincount(row * wide + low, self.times[p], size) - np.bincount(row * wide + high + 1, self.times[p], size)
        n = np.rint(np.cumsum(steps.reshape(len(rs), wide), axis=1)[:, : k + 1]).astype(np.int64)
        on = n > 0
        first, last = on.argmax(axis=1), k - on[:, ::-1].argmax(axis=1)
        whole = on.sum(axis=1) == last - first + 1
        # without a piece over k there is but the reference's chain
        settled, weight, total = self.good | (self.most <= k), np.zeros(r, np.int64), np.zeros(r, np.int64)
        leaves, joins = on[:, 0], on[:, k]
        # where it is broken, parts in the middle are on no way; one that joins the reference again would be led back through them
        settled[rs[joins & ~whole]] = False
        unbroken = np.logical_and.accumulate(on, axis=1)
        last = np.where(leaves, unbroken.sum(axis=1) - 1, last)
        kept = ~(np.where(leaves[:, None], n * unbroken, n).max(axis=1, initial=0) < prune)
        mine = np.where(leaves, n[:, 0] if len(rs) else 0, 1)
        joins = joins & whole
        if by_odds:
            unsure = (leaves & joins) | (leaves | joins if recover is not None else False)
            settled[rs[unsure]] = False
            return settled, weight, total
        way = leaves & joins
        if recover is not None:
            way |= leaves & ~joins & (last + 2 > max(recover, 2))
            way |= joins & ~leaves & (k + 2 - first > recover) & (first < k) & (self.x[rs] >= k)
        way &= kept
        q = np.flatnonzero(held & ~self.other)
        y = self.x[self.owner[q]]
        over = (y >= 0) & (self.lies[q] <= y - k) & (self.lies[q] + self.sizes[q] > y)
        straight = np.rint(np.bincount(self.owner[q], self.times[q] * over, r)).astype(np.int64)
        weight[rs] = np.where(way, mine, 0)
        total[rs] = weight[rs] + np.maximum(straight[rs], 1)
        return settled, weight, total

    def haplotypes(self, kmer_sizes, prune: int = 1, tries: int = 6, by_odds: bool = False, recover: int | None = 1) -> tuple[np.ndarray, np.ndarray]:
        """(settled, score): whether each region is, and the score of its one haplotype beside the reference (nan: there is none). Sizes are those of the windows or more."""
        r = len(self.refs)
        settled, score, open_ = np.ones(r, bool), np.full(r, np.nan), np.ones(r, bool)
        sizes, k = list(kmer_sizes), max(kmer_sizes)
        for _ in range(tries):
            done = np.zeros(r, bool)
            for size in sizes:
                fits = open_ & (self.n > size)
                repeats = self.longer(size)
                settled &= ~fits | self.plain
                if by_odds:  # a chain that reaches the first k-mer, if it doesn't repeat, from a read may be dropped with edges of the reference in it
                    unsure = np.flatnonzero(fits & repeats & ~self.good)
                    settled[[i for i in unsure.tolist() if self.refs[i].find(self.refs[i][:size], 1) < 0 and self._reached(i, size)]] = False
                active = fits & ~repeats
                if not active.any():
                    continue
                sure, weight, total = self._beside(size, prune, by_odds, recover)
                settled &= ~active | sure
                for i in np.flatnonzero(active & sure & (weight > 0)).tolist():
                    score[i] = np.fmax(score[i], -(0.0 - math.log10(int(weight[i]) / int(total[i]))))
                done |= active
            open_ &= ~done
            if not open_.any():
                break
            k += 13 + (k % 2 == 0)
            sizes = [k]
        return settled, score

    def _reached(self, r: int, k: int) -> bool:
        """Whether a piece holds the first k-mer of the reference after its own beginning."""
        if k >= self._unreached.get(r, math.inf):
            return False
        a, b = np.searchsorted(self.owner, (r, r + 1)).tolist()
        if a < b:
            begins, ends = self.starts[a:b] - self.starts[a], self.starts[a:b] - self.starts[a] + self.sizes[a:b]
            text, first = self.bases[self.starts[a] : self.starts[b - 1] + self.sizes[b - 1]].tobytes(), self.refs[r][:k].encode()
            at = text.find(first)
            while at >= 0:
                p = int(np.searchsorted(begins, at, "right")) - 1
                if begins[p] < at <= ends[p] - k:
                    return True
                at = text.find(first, at + 1)
        self._unreached[r] = k
        return False

    def other_haplotype(self, r: int) -> str:
        x = int(self.x[r])
        return self.refs[r][:x] + chr(self.base[r]) + self.refs[r][x + 1 :]


def of(jobs, size: int) -> Placed:
    """jobs: (ref, ((piece, how often), ...)), up to ``REGIONS`` of them."""
    pieces = [p for _, of in jobs for p in of]
    bases = np.frombuffer("".join(p for p, _ in pieces).encode(), np.uint8)
    sizes = np.array([len(p) for p, _ in pieces], np.int64)
    owner = np.repeat(np.arange(len(jobs)), [len(of) for _, of in jobs])
    return Placed([ref for ref, _ in jobs], bases, sizes, owner, np.array([n for _, n in pieces], np.int64), size)
