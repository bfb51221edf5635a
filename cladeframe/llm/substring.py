"""Substring deduplication with a log-structured index of window fingerprints.

A window is ``size`` consecutive words of one document. Documents are taken in blocks of consecutive rows (a long one is a block
of its own) and in batches. A task collects the windows of its blocks and, every ``MEMTABLE`` of them, writes an immutable run: a
file of (fingerprint, digest, holder) in order, without repeats. The holder is the one block that has the window, or none where several
do: these are told at once, so a window that a third of all documents share is one entry a run. The fingerprint space is cut into
slots of equal width; the manifest, a table that only committed tasks add to, says where each run keeps each slot.

A merge takes one slot at a time: the parts of all historical runs and of the new ones are joined in order, equal windows are verified, and
each block that held one alone is told that it repeats, blocks of earlier batches too. Compaction is the same join with one run as its
result. The blocks then remove the words that their repeating windows cover.

A fingerprint is 64 bits of a polynomial in the words' XXH64. It is verified by 32 bits of an independent polynomial, in runs, merges
and answers alike: windows are taken for equal if all 96 bits agree (at 2e13 windows, 100 TB, a chance of 0.3 % that any two differ).
"""

from __future__ import annotations

import struct
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from .shared import Memo, free, keep, located, shared_path, values

SIZE = 35
#: Rows of a block, and bytes from which a text is a block of its own.
ROWS, LONG = 256, 1 << 16
#: Windows of a run, and of a slot of the whole index as it is planned.
MEMTABLE, SLOT = 1 << 21, 1 << 20
#: Batches that ``op6`` takes the table in.
BATCHES = 4

# Odd multipliers of the two polynomials.
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
#: The holder of a window that several blocks have: all of them are told already.
_SHARED = -1


class Windows:
    """Window fingerprints of texts; keeps powers of the bases and word hashes."""

    def __init__(self, size: int):
        self.size, self.hash = size, Memo(xxh64_intdigest)
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        self.powers = []
        for base in _BASES:
            back = pow(base, -1, 1 << 64)
            both = []
            for b in (base, back):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
            self.powers.append((both[0], both[1]))

    def __call__(self, words: list[bytes], second: bool = False) -> tuple[np.ndarray, ...]:
        """Of each window the fingerprint, and if asked for the second polynomial."""
        n, k = len(words), self.size
        none = np.empty(0, np.uint64)
        if n < k:
            return (none, none) if second else (none,)
        if n > len(self.powers[0][0]):
            self._grow(1 << n.bit_length())
        h = np.fromiter(map(self.hash.__getitem__, words), np.uint64, n)
        out = []
        for up, down in self.powers[: 1 + second]:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(h * up[:n], out=total[1:])
            out.append((total[k:] - total[:-k]) * down[: n - k + 1])
        return tuple(out)


def _grouped(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal (fingerprint, digest) together, stable, and where a new pair begins in it."""
    order = np.argsort(h, kind="stable")
    hs, gs = h[order], g[order]
    same = hs[1:] == hs[:-1]
    if (same & (gs[1:] != gs[:-1])).any():  # one fingerprint for different windows: order these by digest too
        order = np.lexsort((g, h))
        hs, gs = h[order], g[order]
        same = hs[1:] == hs[:-1]
    return order, np.concatenate(([True], ~(same & (gs[1:] == gs[:-1])))) if len(h) else np.empty(0, bool)


def _pack(h: np.ndarray, g: np.ndarray, who: np.ndarray, blocks: np.ndarray) -> bytes:
    """A part of a run: fingerprints in order as differences of as few bytes as the largest takes, digests, holders as places in a list of blocks."""
    used = np.unique(who[who != _SHARED])
    names = np.zeros(len(blocks) + 1, np.uint32)
    names[used] = np.arange(1, len(used) + 1)
    gaps = np.diff(h, prepend=h[:1])
    wide = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    kind = np.uint16 if len(used) < 1 << 16 else np.uint32
    head = struct.pack("<QQBBQ", len(h), int(h[0]), wide, kind().itemsize, len(used))
    return b"".join((head, blocks[used].tobytes(), gaps.view(np.uint8).reshape(-1, 8)[:, :wide].tobytes(), g.tobytes(), names[who].astype(kind).tobytes()))


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, first, wide, kind, m = struct.unpack_from("<QQBBQ", raw)
    at = struct.calcsize("<QQBBQ")
    blocks = np.frombuffer(raw, np.int64, m, at)
    at += 8 * m
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :wide] = np.frombuffer(raw, np.uint8, n * wide, at).reshape(n, wide)
    at += n * wide
    g = np.frombuffer(raw, np.uint32, n, at)
    who = np.frombuffer(raw, np.uint16 if kind == 2 else np.uint32, n, at + 4 * n).astype(np.int64) - 1
    return np.cumsum(gaps.reshape(-1).view(np.uint64)) + np.uint64(first), g, who, blocks


_ROWS = "slot int, file string, offset long, length long, block long, prints binary, digests binary"
_KINDS = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
_NAMES = ["slot", "file", "offset", "length", "block", "prints", "digests"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS)], names=_NAMES)


def _answers(who: np.ndarray, h: np.ndarray, g: np.ndarray, blocks: np.ndarray) -> list[tuple]:
    """A row for each block with the windows that it is told of."""
    order = np.argsort(who, kind="stable")
    who, h, g = who[order], h[order], g[order]
    at = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1]))) if len(who) else []
    return [(None, None, None, None, int(blocks[who[s]]), h[s:e].tobytes(), g[s:e].tobytes()) for s, e in zip(at, [*at[1:], len(who)])]


class _Run:
    """A run file that is being written; slots come in order."""

    def __init__(self, folder: str):
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        task = TaskContext.get()
        self.name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:12]}.run"
        self.sink, self.at = store.open_output_stream(f"{top}/{self.name}", compression=None), 0

    def add(self, slot: int, raw: bytes) -> tuple:
        self.sink.write(raw)
        self.at += len(raw)
        return slot, self.name, self.at - len(raw), len(raw), None, None, None


def _spilled(folder: str, size: int, bits: int):
    """Rows (block, text) -> manifest rows of the runs that are written, and answers to blocks whose windows repeat within a run."""

    def run(batches):
        windows, hs, gs, whos, blocks, n = Windows(size), [], [], [], [], 0

        def flush():
            h, g, who, names = np.concatenate(hs), np.concatenate(gs), np.concatenate(whos), np.array(blocks, np.int64)
            order, new = _grouped(h, g)
            h, g, who = h[order], g[order], who[order]
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(h)))
            many = np.repeat(times > 1, times)
            # a block is told once of a window that it holds several times
            told = many & np.concatenate(([True], new[1:] | (who[1:] != who[:-1])))
            answers = _answers(who[told], h[told], g[told], names)
            h, g, who = h[first], g[first], np.where(times > 1, _SHARED, who[first])
            cuts = np.searchsorted(h, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
            sink, out = _Run(folder), []
            for slot, (s, e) in enumerate(zip([0, *cuts], [*cuts, len(h)])):
                if s < e:
                    out.append(sink.add(slot, _pack(h[s:e], g[s:e], who[s:e], names)))
            sink.sink.close()
            for at in range(0, len(answers), 1000):
                yield _rows(answers[at : at + 1000])
            yield _rows(out)

        for b in batches:
            for block, text in zip(b.column(0).to_pylist(), values(b.column(1))):
                h, g = windows((text or b"").split(), True)
                if not len(h):
                    continue
                if not blocks or blocks[-1] != block:
                    blocks.append(block)
                hs.append(h)
                gs.append((g >> np.uint64(32)).astype(np.uint32))
                whos.append(np.full(len(h), len(blocks) - 1, np.int64))
                n += len(h)
                if n >= MEMTABLE:
                    yield from flush()
                    hs, gs, whos, blocks, n = [], [], [], [], 0
        if n:
            yield from flush()

    return run


class _Files:
    """Byte ranges of run files; a few files stay open."""

    def __init__(self, folder: str, most: int = 128):
        self.store, self.top = fs.FileSystem.from_uri(folder)
        self.open, self.most = OrderedDict(), most

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= self.most:
                self.open.popitem(last=False)[1].close()
            self.open[name] = self.store.open_input_file(f"{self.top}/{name}")
        self.open.move_to_end(name)
        return self.open[name].read_at(length, offset)


def merged(parts: list[tuple[bool, tuple]]) -> tuple[list[tuple], tuple]:
    """parts: (new, what ``_unpack`` gives) of one slot. Answers to the blocks that held a window alone which a new run holds too, and the one part that stands for all: (h, g, who, blocks)."""
    blocks, place = np.unique(np.concatenate([p[3] for _, p in parts]), return_inverse=True)
    at, whos = 0, []
    for _, (_, _, who, names) in parts:
        own = np.append(place[at : at + len(names)], _SHARED)
        whos.append(own[who])
        at += len(names)
    h, g, who = np.concatenate([p[0] for _, p in parts]), np.concatenate([p[1] for _, p in parts]), np.concatenate(whos)
    fresh = np.repeat([new for new, _ in parts], [len(p[0]) for _, p in parts])
    order, new = _grouped(h, g)
    h, g, who, fresh = h[order], g[order], who[order], fresh[order]
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    met = (times > 1) & np.logical_or.reduceat(fresh, first)
    told = np.repeat(met, times) & (who != _SHARED)
    return _answers(who[told], h[told], g[told], blocks), (h[first], g[first], np.where(times > 1, _SHARED, who[first]), blocks)


def _merge(folder: str, compact: bool):
    """Manifest rows (slot, file, offset, length, new), ordered by slot -> answers, or the manifest of the one run that replaces all."""

    def run(batches):
        files, sink, slot, held = _Files(folder), None, None, []

        def end():
            nonlocal sink
            parts = [(new, _unpack(files.read(f, o, n))) for f, o, n, new in held]
            answers, one = merged(parts)
            if compact:
                sink = sink or _Run(folder)
                return [sink.add(slot, _pack(*one))]
            return answers

        for b in batches:
            for s, *part in zip(*(b.column(i).to_pylist() for i in range(5))):
                if s != slot and held:
                    yield _rows(end())
                    held = []
                slot = s
                held.append(part)
        if held:
            yield _rows(end())
        if sink is not None:
            sink.sink.close()

    return run


def covered(repeats: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of n words lie in a window that repeats."""
    step = np.zeros(n + 1, np.int32)
    step[: len(repeats)] += repeats
    step[size : size + len(repeats)] -= repeats
    return np.cumsum(step)[:n] > 0


def _cleaned(size: int, names: list[str], text_col: str):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        windows = Windows(size)
        told = [np.concatenate([np.frombuffer(r, kind) for r in answers[c].to_pylist()] or [np.empty(0, kind)]) for c, kind in (("prints", np.uint64), ("digests", np.uint32))]
        order, new = _grouped(*told)
        h, g = (x[order][new] for x in told)
        twin = np.concatenate(([False], h[1:] == h[:-1])) if len(h) else np.empty(0, bool)
        more: dict[int, set] = {}
        for i in np.flatnonzero(twin).tolist():  # a fingerprint of different windows
            more.setdefault(int(h[i]), set()).add(int(g[i]))
        h, g = h[~twin], g[~twin]

        def repeats(words):
            mine = windows(words)[0] if len(h) else h
            if not len(mine):
                return None
            at = np.searchsorted(h, mine)
            at[at == len(h)] = 0
            hit = h[at] == mine
            if not hit.any():
                return None
            digest = (windows(words, True)[1] >> np.uint64(32)).astype(np.uint32)
            same = hit & (g[at] == digest)
            for i in np.flatnonzero(hit & ~same).tolist() if more else ():
                same[i] = int(digest[i]) in more.get(int(mine[i]), ())
            return same if same.any() else None

        kept, n_words, n_removed = [], [], []
        for text in docs[text_col].cast(pa.binary()).to_pylist():
            w = left = (text or b"").split()
            if (hit := repeats(w)) is not None:
                left = [x for x, gone in zip(w, covered(hit, len(w), size).tolist()) if not gone]
            kept.append(b" ".join(left))
            n_words.append(len(w))
            n_removed.append(len(w) - len(left))
        out = docs.select(names)
        out = out.set_column(names.index(text_col), text_col, pa.array(kept, pa.binary()).cast(pa.string()))
        return out.append_column("n_words", pa.array(n_words, pa.int64())).append_column("n_removed", pa.array(n_removed, pa.int64()))

    return run


class FingerprintIndex:
    """Runs under ``path``, a folder that all executors see, in 2 ** ``bits`` slots: ``path/data`` holds their files, ``path/<number>-<batch>`` a committed manifest for each batch or compaction.

    What isn't named in a committed manifest doesn't count, so tasks that were lost or repeated leave nothing behind but unread files."""

    def __init__(self, spark: SparkSession, path: str, bits: int = 8):
        self.spark, self.path, self.bits = spark, path.rstrip("/"), bits
        self.data = f"{self.path}/data"
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def manifests(self) -> list[str]:
        """Committed ones, oldest first."""
        if not self._fs.exists(self._path("")):
            return []
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path("")))
        return [n for n in names if n != "data" and self._fs.exists(self._path(f"{n}/_SUCCESS"))]

    def _table(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(_ROWS).parquet(*[f"{self.path}/{n}" for n in names])

    def _commit(self, rows: DataFrame, batch: str) -> str:
        held = self.manifests()
        name = f"{int(held[-1].split('-')[0]) + 1 if held else 0:08d}-{batch}"
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return name

    def _merged(self, manifest: DataFrame, compact: bool = False) -> DataFrame:
        """A task takes slots that follow each other, one at a time. The number of tasks follows the index, not the manifest's few bytes."""
        tasks = min(1 << self.bits, max(self.spark.sparkContext.defaultParallelism, (1 << self.bits) // 4))
        dealt = manifest.repartitionById(tasks, F.floor(F.col("slot") * tasks / (1 << self.bits)).cast("int")).sortWithinPartitions("slot", "file", "offset")
        return dealt.select("slot", "file", "offset", "length", "new").mapInArrow(_merge(self.data, compact), _ROWS)

    def absorb(self, rows: DataFrame, size: int, batch: str) -> DataFrame:
        """rows: (block, text) of a batch. Its runs join the index; returns the answers (block, prints, digests) that it gives, to its own blocks and to those of earlier batches.

        A batch that is absorbed again replaces its own runs, if these aren't compacted yet."""
        if batch == "compact" or not batch.replace("_", "").isalnum():
            raise ValueError("a batch is named by letters, digits and underscores")
        if self._fs.exists(self._path(f"data/compacted-{batch}")):
            raise ValueError(f"batch {batch} is compacted already")
        was = [n for n in self.manifests() if n.split("-", 1)[1] == batch]
        old = [n for n in self.manifests() if n not in was]
        name = self._commit(rows.mapInArrow(_spilled(self.data, size, self.bits), _ROWS), batch)
        for n in was:
            self._fs.delete(self._path(n), True)
        new = self._table([name])
        every = new.where("file is not null").withColumn("new", F.lit(True))
        if old:
            every = every.unionByName(self._table(old).where("file is not null").withColumn("new", F.lit(False)))
        told = self._merged(every).unionByName(new.where("block is not null"))
        return keep(told.select("block", "prints", "digests"), "answers")

    def compact(self) -> None:
        """Merges all runs into one for each range of slots; the old ones go when the new manifest is written."""
        old = self.manifests()
        if len(old) < 2:
            return
        held = self._table(old).where("file is not null")
        gone = [r.file for r in held.select("file").distinct().toLocalIterator()]
        self._commit(self._merged(held.withColumn("new", F.lit(False)), compact=True), "compact")
        for n in old:
            self._fs.create(self._path(f"data/compacted-{n.split('-', 1)[1]}"), True).close()
            self._fs.delete(self._path(n), True)
        for f in gone:
            self._fs.delete(self._path(f"data/{f}"), False)

    def drop(self) -> None:
        self._fs.delete(self._path(""), True)


def remove_repeats(docs: DataFrame, size: int = SIZE, text_col: str = "text", index: FingerprintIndex | None = None, batch: str | None = None, batches: int = 1) -> DataFrame:
    """``docs`` with the text's kept words joined by one space, n_words and n_removed.

    A word goes if a window that covers it has a word sequence that starts anywhere else: in the same document, another one of ``docs``,
    or, with an index, an earlier batch of it. ``docs`` is then ``batch`` of that index; documents of earlier batches aren't changed. Without an index one is
    made for this call: ``docs`` enters it in ``batches`` batches, the index is compacted half-way, and documents of all batches are judged by all.
    Null text and texts shorter than a window: nothing is removed; null text gives an empty one. Repeated rows are documents of their own, so
    their windows repeat. Empty table: no rows. Columns n_words and n_removed of ``docs`` are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_removed")
    at = F.col("_metadata.row_index")
    alone = F.octet_length(F.col(text_col).cast("string")) >= LONG
    (blocked,) = free(docs, "__cf_block")
    rows = located(docs, {blocked: F.when(alone, F.xxhash64("_metadata.file_path", at, F.lit(True))).otherwise(F.xxhash64("_metadata.file_path", F.floor(at / ROWS)))})
    texts = rows.select(blocked, F.col(text_col).cast("string"))
    if index:
        if not batch:
            raise ValueError("a batch of an index has a name")
        answers = index.absorb(texts, size, batch)
    else:
        # a word and its space take four bytes or more, but for rare texts, whose slots are larger then
        windows = (texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // 4
        index = FingerprintIndex(spark, shared_path(spark, "fingerprints"), min(20, max(4, (windows // SLOT).bit_length())))
        answers = None
        for k in range(batches):
            own = texts.where(F.pmod(F.col(blocked), F.lit(batches)) == k) if batches > 1 else texts
            told = index.absorb(own, size, f"part{k}")
            answers = told if answers is None else answers.unionByName(told)
            if k + 1 == batches // 2:
                index.compact()
        index.drop()
    fields = [T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType) for f in docs.schema]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    left = rows.groupBy(blocked)
    return left.cogroup(answers.withColumnRenamed("block", blocked).groupBy(blocked)).applyInArrow(_cleaned(size, docs.columns, text_col), schema)


def repeats_report(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs.select("doc_id", "text"), batches=BATCHES)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
