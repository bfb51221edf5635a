"""Benchmark decontamination by template canonicalisation.

Words are stripped of outer punctuation and lower-cased; numbers, names and units become typed placeholders. Windows of five
words of the benchmark, as templates and as they are, form a hash table that documents probe. A document is
contaminated by an item if windows close together cover 0.8 of all the item's, after those are left out that bind a
placeholder's value otherwise than earlier ones did: a re-parameterised question puts one new value for each old one.
Templates of placeholders alone are not probed; they count beside other windows of the item. Windows of numbers alone
are probed as they are.

Items too short for a window match as they are.

The table is broadcast. Its size is checked: a larger benchmark is taken in slices of ``SLICE`` windows, one pass each, one table at a time.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh64_intdigest

from .shared import Memo, keep, values

SIZE, SHARE = 5, 0.8
#: Windows of one broadcast table: about 150 MB.
SLICE = 1_000_000
#: Literal words that a match with changed values must hold, so that placeholders alone match nothing.
LITERAL = 3

# Words that are units after a number.
UNITS = frozenset(
    "km m cm mm mile miles foot feet inch inches yard yards kg g mg lb lbs ounce ounces pound pounds ton tons liter liters litre litres ml gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years percent degree degrees dollar dollars cent cents euro euros mph kmh watt watts".split()
)

_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th|[a-z]{1,3})?$", re.IGNORECASE)
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_TITLE, _ENDS, _UNIT, _DIGITS, _FLAGS = 1, 2, 4, 8, np.uint64(15)
_NUM, _NAME, _UNITS = (xxh64_intdigest(x) & ~15 for x in (b"<number>", b"<name>", b"<unit>"))
_BASE = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(SIZE)], np.uint64)


def _word(raw: str) -> int:
    """Hash of the canonical word in the upper bits, flags in the lower four; 0 for mere punctuation."""
    core = _OUTER.sub("", raw)
    if not core:
        return 0
    ends = _ENDS if raw.rstrip("\"')]»”").endswith((".", "!", "?", ":")) else 0
    low = core.lower()
    if _NUMBER.match(core):
        return (xxh64_intdigest(low.encode()) & ~15) | ends | _DIGITS
    title = _TITLE if len(core) > 1 and core[0].isupper() and core[1:].islower() else 0
    return (xxh64_intdigest(low.encode()) & ~15) | title | ends | (_UNIT if low in UNITS else 0)


class Canon:
    def __init__(self):
        self.of = Memo(_word)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the words that aren't mere punctuation: their places, templates, hashes with numbers as placeholders, and literal hashes."""
        v = np.fromiter(map(self.of.__getitem__, words), np.uint64, len(words))
        place = np.flatnonzero(v)
        v = v[place]
        flags, exact = v & _FLAGS, v & ~_FLAGS
        number = (flags & np.uint64(_DIGITS)) > 0
        plain = np.where(number, np.uint64(_NUM), exact)
        template = plain.copy()
        if len(v):
            starts = np.concatenate(([True], (flags[:-1] & np.uint64(_ENDS)) > 0))
            after = np.concatenate(([False], number[:-1]))
            template[((flags & np.uint64(_TITLE)) > 0) & ~starts] = _NAME
            template[((flags & np.uint64(_UNIT)) > 0) & after] = _UNITS
        return place, template, plain, exact


def _windows(v: np.ndarray) -> np.ndarray:
    n = len(v) - SIZE + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(SIZE) if n > 0 else ():
        out += v[j : j + n] * _BASE[j]
    return out


def _slots(template: np.ndarray) -> np.ndarray:
    return (template == np.uint64(_NUM)) | (template == np.uint64(_NAME)) | (template == np.uint64(_UNITS))


def _full(marked: np.ndarray) -> np.ndarray:
    """Where windows of marked words alone begin."""
    n = len(marked) - SIZE + 1
    return np.flatnonzero(np.lib.stride_tricks.sliding_window_view(marked, SIZE).all(axis=1)) if n > 0 else np.empty(0, np.int64)


class Item:
    """An item's words as far as matching needs them. ``windows`` holds for each window the hashes that stand for it: as a template, with names as they are, or, for numbers alone, as it is."""

    def __init__(self, item_id, text: str | None, canon: Canon):
        self.id = item_id
        words = (text or "").split()
        place, self.template, plain, exact = canon(words)
        self.slots, number = _slots(self.template), plain == np.uint64(_NUM)
        self.tokens = [_OUTER.sub("", words[i]).lower() for i in place.tolist()]
        self.total = max(len(self.template) - SIZE + 1, 0)
        self.bare = _full(self.slots)
        numbers = _full(number)
        self.windows = np.stack([_windows(self.template), _windows(plain)], axis=1) if self.total else np.empty((0, 2), np.uint64)
        self.windows[self.bare, 0] = 0
        self.windows[numbers, 1] = _windows(exact)[numbers]
        self.numbers = bool(len(numbers))
        self.exact = exact

    def least(self, share: float) -> int:
        """Windows that a match holds by their hashes at least: those of placeholders alone may come from their place."""
        return max(1, int(np.ceil(share * self.total - 1e-9)) - len(self.bare))


class Table:
    """Hashes of items' windows. Each item is posted under its rarest windows only: so many that a match can't miss them all.
    A window that many items share is posted for few of them, and the others aren't touched when a document holds it."""

    def __init__(self, items: list[tuple[object, str]], share: float = SHARE):
        canon, self.share = Canon(), share
        self.items = [Item(i, text, canon) for i, text in items]
        self.numbers = any(x.numbers for x in self.items)
        long = [k for k, x in enumerate(self.items) if x.total]
        flat = np.concatenate([self.items[k].windows.ravel() for k in long] or [np.empty(0, np.uint64)])
        self.hashes, codes, often = np.unique(flat, return_inverse=True, return_counts=True)
        if len(self.hashes) and self.hashes[0] == 0:
            often[0] = 0
        of, owners, at = [], [], 0
        for k in long:
            x = self.items[k]
            x.codes = codes[at : at + 2 * x.total].reshape(-1, 2)
            at += 2 * x.total
            rare = np.argsort(often[x.codes].max(axis=1), kind="stable")[: x.total - x.least(share) + 1]
            posted = np.unique(x.codes[rare])
            of.append(posted)
            owners.append(np.full(len(posted), k, np.int32))
        of, owners = (np.concatenate(v or [np.empty(0, np.int64)]) for v in (of, owners))
        order = np.argsort(of, kind="stable")
        self.owners = owners[order]
        self.ends = np.searchsorted(of[order], np.arange(len(self.hashes) + 1))
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        # items without a window: whole, as they are, by their number of words
        self.short: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, x in enumerate(self.items):
            if not x.total and len(x.exact):
                self.short[len(x.exact)][x.exact.tobytes()].append(k)
        self.short = {n: dict(of) for n, of in self.short.items()}

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, and codes of the hashes there, of those in the table."""
        at = np.flatnonzero(self.sieve[(hashes >> np.uint64(44)).astype(np.int64)])
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0]
        k = np.searchsorted(self.hashes, hashes[at])
        k[k == len(self.hashes)] = 0
        ok = (self.hashes[k] == hashes[at]) & (hashes[at] != 0)
        return at[ok], k[ok]

    def matches(self, text: str | None, canon: Canon):
        """(item id, matched windows, windows, first word, last word, bindings) for each item that contaminates the text."""
        words = (text or "").split()
        place, template, plain, exact = canon(words)
        out = [(self.items[k].id, 1, 1, int(place[p]), int(place[p + n - 1]), "") for k, p, n in self._whole(exact)]
        found = [self.hits(_windows(template)), self.hits(_windows(plain))]
        if self.numbers and len(at := _full(plain == np.uint64(_NUM))):
            p, k = self.hits(_windows(exact)[at])
            found.append((at[p], k))
        places, codes = (np.concatenate(x) for x in zip(*found))
        if not len(codes):
            return out
        order = np.lexsort((places, codes))
        places, codes = places[order], codes[order]
        held, first = np.unique(codes, return_index=True)
        ends = np.append(first, len(codes))
        posted = [self.owners[self.ends[c] : self.ends[c + 1]] for c in held.tolist() if self.ends[c] < self.ends[c + 1]]
        for k in np.unique(np.concatenate(posted)).tolist() if posted else ():
            x = self.items[k]
            at = np.searchsorted(held, x.codes)
            at[at == len(held)] = 0
            there = held[at] == x.codes
            offsets = np.flatnonzero(there.any(axis=1))
            need = self.share * x.total
            if len(np.union1d(offsets, x.bare)) < need:
                continue
            pairs = {(p, o) for o in offsets.tolist() for j in np.flatnonzero(there[o]).tolist() for p in places[first[at[o, j]] : ends[at[o, j] + 1]].tolist()}
            bare = x.bare.tolist()
            for d in {p - o for p, o in pairs} if bare else ():
                pairs |= {(d + o, o) for o in bare if d + o >= 0 and np.array_equal(template[d + o : d + o + SIZE], x.template[o : o + SIZE])}
            best = self._best(sorted(pairs), need, len(x.template), x.slots, x.tokens, words, place)
            if best:
                out.append((x.id, best[0], x.total, int(place[best[1]]), int(place[min(best[2] + SIZE - 1, len(place) - 1)]), best[3]))
        return out

    def _whole(self, exact: np.ndarray):
        """(item, place, words) of items of under five words that the text holds as they are; of those under three only if they are all of it."""
        for n, of in self.short.items():
            if n < LITERAL:
                starts = [0] if len(exact) == n else []
            else:
                some = np.isin(exact[: max(0, len(exact) - n + 1)], np.array([np.frombuffer(w, np.uint64)[0] for w in of], np.uint64))
                starts = np.flatnonzero(some).tolist()
            seen = set()
            for p in starts:
                for k in of.get(exact[p : p + n].tobytes(), ()):
                    if k not in seen:
                        seen.add(k)
                        yield k, p, n

    @staticmethod
    def _best(found, need, length, slots, tokens, words, place):
        """The stretch of about the item's length with most of its windows, their slots bound consistently.

        Bindings are tried as by place, with unchanged windows first, and with each window's alignment first, those nearest to it before others."""
        reach, best, start = length + max(SIZE, length // 2), None, 0
        for end in range(len(found)):
            while found[end][0] - found[start][0] > reach:
                start += 1
            if end + 1 < len(found) and found[end + 1][0] - found[start][0] <= reach:
                continue
            part = found[start : end + 1]
            most = len({o for _, o in part})
            if most < need or (best and most <= best[0]):
                continue
            pairs = {(p, o): tuple((tokens[o + j], _OUTER.sub("", words[place[p + j]]).lower()) for j in range(SIZE) if slots[o + j]) for p, o in part}
            for order in Table._orders(part, pairs):
                bound: dict[str, str] = {}
                back: dict[str, str] = {}
                taken, offsets = [], set()
                for w in order:
                    here, there = dict(pairs[w]), {b: a for a, b in pairs[w]}
                    if all(here[a] == b and there[b] == a and bound.get(a, b) == b and back.get(b, a) == a for a, b in pairs[w]):
                        bound |= here
                        back |= there
                        taken.append(w[0])
                        offsets.add(w[1])
                held = {o + j for o in offsets for j in range(SIZE) if not slots[o + j]}
                if len(offsets) >= need and (best is None or len(offsets) > best[0]) and (len(held) >= LITERAL or all(a == b for a, b in bound.items())):
                    changed = ",".join(f"{a}={b}" for a, b in sorted(bound.items()) if a != b)
                    best = (len(offsets), min(taken), max(taken), changed)
                if best and best[0] >= most:
                    break
        return best

    @staticmethod
    def _orders(part, pairs):
        """Orders in which windows (place, offset) of a stretch may bind their slots."""
        yield part
        same = {w for w in part if all(a == b for a, b in pairs[w])}
        if any(pairs[w] for w in same):
            yield [w for w in part if w in same]
            yield sorted(part, key=lambda w: w not in same)
        tried = set()
        for p, o in part:
            if pairs[p, o] and (kind := (p - o, pairs[p, o])) not in tried:
                tried.add(kind)
                yield sorted(part, key=lambda w: (abs(w[0] - w[1] - p + o), abs(w[0] - p)))


def _slices(benchmark: DataFrame, share: float, id_col: str, text_col: str):
    """Tables of at most about SLICE windows; one item at least."""
    held, n = [], 0
    for row in benchmark.select(id_col, F.col(text_col).cast("string")).orderBy(id_col, text_col).toLocalIterator():
        held.append((row[0], row[1]))
        n += 2 * len((row[1] or "").split())
        if n >= SLICE:
            yield Table(held, share)
            held, n = [], 0
    if held:
        yield Table(held, share)


def _passes(docs: DataFrame, benchmark: DataFrame, share: float, item_col: str, item_text_col: str, one):
    """What ``one`` makes of ``docs`` and each table, one table at a time: with more than one each pass is written before the next table is broadcast, and the table is given up then."""
    sc, slices = docs.sparkSession.sparkContext, _slices(benchmark, share, item_col, item_text_col)
    table = next(slices, None)
    while table is not None:
        following, held = next(slices, None), sc.broadcast(table)
        if following is None:
            docs = one(docs, held, True)
        else:
            docs = one(docs, held, False)
            held.destroy()
        table = following
    return docs


_FOUND = "matched int, windows int, first_word int, last_word int, bindings string"


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, matched, windows, first_word, last_word, bindings): one row for each document and item that it leaks.

    ``windows`` counts the item's windows, ``matched`` those that the document holds close together; words count from 0. ``bindings`` names changed values as old=new.
    Null or empty texts and items match nothing. Items of three or four words match where they stand as they are (one window), those of one or two words only
    documents that hold nothing else. Items with fewer than three literal words match only unchanged. Of tied stretches the first counts. Repeated rows and items repeat.
    Texts are taken whole, however long. Empty tables: no rows. Other columns are left out; ``id_col`` must not be one of the result's other columns.
    """
    names = ["item_id", *(f.split()[0] for f in _FOUND.split(", "))]
    if id_col in names:
        raise ValueError(f"id_col must not be {id_col}, which the result has")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("item_id", benchmark.schema[item_col].dataType), *T._parse_datatype_string(_FOUND).fields])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[1:]]
    done = []

    def one(docs, held, last):
        def run(batches):
            canon, t = Canon(), held.value
            for b in batches:
                ids, found = [], []
                for i, text in enumerate(values(b.column(1))):
                    for m in t.matches(text and text.decode(), canon):
                        ids.append(i)
                        found.append(m)
                cols = list(zip(*found)) if found else [()] * 6
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["id", *names])

        part = docs.mapInArrow(run, schema)
        done.append(part if last else keep(part, "leaks"))
        return docs

    _passes(rows, benchmark, share, item_col, item_text_col, one)
    out = done[0] if done else docs.sparkSession.createDataFrame([], schema)
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that an item contaminates (see ``contaminated``); the rest is passed through in place with all columns, whatever their names; nothing is joined.

    Null and empty texts stay. Repeated rows are judged alike. Empty tables: all rows stay."""
    at = docs.columns.index(text_col)

    def one(docs, held, last):
        def run(batches):
            canon, t = Canon(), held.value
            for b in batches:
                clean = [not t.matches(text and text.decode(), canon) for text in values(b.column(at))]
                yield b.filter(pa.array(clean, pa.bool_()))

        part = docs.mapInArrow(run, docs.schema)
        return part if last else keep(part, "clean")

    return _passes(docs, benchmark, share, item_col, item_text_col, one)
