"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

Radius 3 takes 15 tables. Bit i of a fingerprint has a vector m(i) of four bits, not zero; table v keeps the bits with odd
parity of m(i) & v. The vectors of any three bits are orthogonal to some v, so two fingerprints that differ in three bits or
fewer agree on all that some table keeps: no pair is missed.

Equal fingerprints are one node. A bucket gives a spanning forest of its links, never its pairs. A bucket of over
``most`` nodes goes to finer tables that cover it too, and what is still over ``most`` there to exact patterns with three
open bits, so no bucket is capped. Links become groups by alternating large-star and small-star steps on written tables.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_digest

from .shared import free, keep, values

RADIUS = 3
#: Links of one node that a task joins, and hot nodes up to which their table is broadcast: 16 MB.
HOT, _FEW = 1000, 1_000_000
_SHINGLES = 1 << 16  # counted at once


def simhash(text: bytes | None) -> int:
    """Unsigned fingerprint of the 3-word shingles of a text, A-Z lower-cased; 0 if there is no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < 3:
        return int.from_bytes(xxh64_digest(line, 42), "big")
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    n = len(words) - 2
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _SHINGLES):
        to = min(at + _SHINGLES, n)
        cuts = [line[s : e - 1] for s, e in zip(starts[at:to], starts[at + 3 : to + 3])]
        got = np.frombuffer(b"".join(map(xxh64_digest, cuts, repeat(42))), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(got, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches):
    for b in batches:
        made = np.array([simhash(t) for t in values(b.column(1))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.int64())], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long. One row per input row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def covering_masks(bits: int = 64, radius: int = RADIUS) -> list[int]:
    size = (1 << (radius + 1)) - 1
    vector = [i % size + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, size + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def finer_masks(mask: int) -> list[int]:
    """For pairs that agree on ``mask``: the open bits in six blocks, three of which at least agree too."""
    open_bits = [i for i in range(64) if not mask >> i & 1]
    blocks = [sum(1 << i for i in open_bits[k::6]) for k in range(6)]
    return [mask | a | b | c for a, b, c in combinations(blocks, 3)]


def _forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links (member, root) that join the nodes of a bucket as its pairs within the radius do. ``fps`` holds no repeats."""
    out, left = [], fps.view(np.uint64)
    while left.size > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and left.size:
            near = np.bitwise_count(left ^ front.pop()) <= RADIUS
            if near.any():
                hit = left[near]
                left = left[~near]
                out += [(h, root) for h in hit.view(np.int64).tolist()]
                front += list(hit)
    return [(h, int(np.uint64(r).astype(np.int64))) for h, r in out]


def _buckets(most: int):
    """Rows (mask, key, fp) ordered by mask and key -> rows (a, b, mask): links with mask 0, or members of too large buckets (a) with their mask."""

    def emit(rows):
        a, b, m = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, m)], ["a", "b", "mask"])

    def run(batches):
        held: list[np.ndarray] = []
        key, count, over = None, 0, False

        def end():
            if over or count < 2:
                return []
            return [(a, b, 0) for a, b in _forest(np.unique(np.concatenate(held)))]

        for batch in batches:
            mask, keys, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(fps):
                continue
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (keys[1:] != keys[:-1])) + 1
            edges = np.concatenate(([0], cut, [len(fps)]))
            rows: list[tuple[int, int, int]] = []
            # runs of one row inside the batch have no partner; only the first and the last may go on in another batch
            many = set(np.flatnonzero(np.diff(edges) > 1).tolist()) | {0, len(edges) - 2}
            for i in sorted(many):
                s, e = edges[i], edges[i + 1]
                here = (int(mask[s]), int(keys[s]))
                if here != key:
                    rows += end()
                    key, held, count, over = here, [], 0, False
                part = fps[s:e]
                count += e - s
                if over:
                    rows += [(f, f, here[0]) for f in part.tolist()]
                else:
                    held.append(part)
                    if count > most:
                        over = True
                        rows += [(f, f, here[0]) for p in held for f in p.tolist()]
                        held = []
                if len(rows) > 50_000:
                    yield emit(rows)
                    rows = []
            yield emit(rows)
        yield emit(end())

    return run


def _through(rows: DataFrame, most: int, name: str) -> DataFrame:
    """rows: (mask, key, fp)."""
    dealt = rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return keep(dealt.mapInArrow(_buckets(most), "a long, b long, mask long"), name)


def links(nodes: DataFrame, most: int = 4096) -> DataFrame:
    """nodes: (fp), each once. Returns links (a, b), enough of them to join all that pairs within the radius join."""
    spark = nodes.sparkSession
    masks = [_signed(m) for m in covering_masks()]
    first = nodes.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    found = _through(first, most, "links")
    out = found.where("mask = 0").select("a", "b")
    if found.where("mask != 0").limit(1).count():
        finer = spark.createDataFrame([(_signed(m), _signed(f)) for m in covering_masks() for f in finer_masks(m)], "mask long, finer long")
        second = found.where("mask != 0").select("mask", F.col("a").alias("fp")).join(F.broadcast(finer), "mask").select(F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("key"), "fp").distinct()
        found2 = _through(second, most, "links-finer")
        out = out.union(found2.where("mask = 0").select("a", "b"))
        if found2.where("mask != 0").limit(1).count():
            out = out.union(_open_patterns(found2.where("mask != 0").select("mask", F.col("a").alias("fp"))))
    return out


def _open_patterns(rows: DataFrame) -> DataFrame:
    """Two fingerprints that agree on ``mask`` are within the radius if and only if they share a pattern in which three of the other bits are open. Each links to the least of its pattern."""
    spark = rows.sparkSession
    ways = []
    for m in {f for m in covering_masks() for f in finer_masks(m)}:
        rest = [i for i in range(64) if not m >> i & 1]
        ways += [(_signed(m), _signed(((1 << 64) - 1) ^ (1 << i | 1 << j | 1 << k))) for i, j, k in combinations(rest, 3)]
    table = spark.createDataFrame(ways, "mask long, open long")
    shown = keep(rows.join(table, "mask").select("open", F.col("fp").bitwiseAND(F.col("open")).alias("pattern"), "fp").distinct(), "patterns")
    least = shown.groupBy("open", "pattern").agg(F.min("fp").alias("b"))
    return shown.join(least, ["open", "pattern"]).where("fp != b").select(F.col("fp").alias("a"), "b").distinct()


def _with_low(rows: DataFrame, lows: DataFrame, hot: int) -> DataFrame:
    """rows: (u, v), lows: (u, low, n), a written table. Adds low. A node of more than ``hot`` rows is dealt to several tasks: its rows by their other end, its low to each."""
    many = lows.where(F.col("n") > hot).select("u", F.ceil(F.col("n") / hot).alias("parts"))
    n = many.count()
    if not n:
        return rows.join(lows.select("u", "low"), "u")
    many = F.broadcast(many) if n <= _FEW else many
    parts = F.coalesce("parts", F.lit(1))
    rows = rows.join(many, "u", "left").withColumn("part", F.pmod(F.xxhash64("v"), parts)).drop("parts")
    each = lows.join(many, "u", "left").select("u", "low", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    return rows.join(each, ["u", "part"]).drop("part")


def groups(edges: DataFrame, hot: int = HOT) -> DataFrame:
    """(node, root) for every node that has a link; root is the least node that it reaches. Rounds grow with the logarithm of the longest chain."""
    sized = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    e = keep(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    was = sized(e)
    while was[0]:
        both = e.union(e.select("v", "u"))
        lows = keep(both.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n")).select("u", F.least("low", "u").alias("low"), "n"), "lows")
        # a node tells the larger ends of its links
        large = _with_low(e.select(F.col("v").alias("u"), F.col("u").alias("v")), lows, hot)
        large = keep(large.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct(), "large-star")
        lows = keep(large.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n")), "lows")
        small = _with_low(large, lows, hot).select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").union(lows.select("u", "low")).distinct()
        e = keep(small, "small-star")
        now = sized(e)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of each row, and (fp, root, component_id) of each fingerprint; root names the group."""
    prints = keep(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = keep(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = groups(links(nodes.select("fp"), most)).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, rooted.join(low, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 4096) -> DataFrame:
    """(id, fingerprint, component_id), one row per input row; component_id is the smallest id that links reach.

    Null and empty texts have fingerprint zero and are linked like any other. A null id is never the smallest unless a group has no other
    (then component_id is null). Repeated rows give repeated results. Empty table: no rows.
    """
    prints, of = _grouped(docs, id_col, text_col, most)
    return prints.join(of.drop("root"), "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 4096) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, one with the smallest id (ties: the least fingerprint, then any of the rows that share both).

    Ids that repeat, or are null, in different groups don't stand for each other: each group keeps its row."""
    prints, of = _grouped(docs, id_col, text_col, most)
    return keep_rows(docs, prints, of, lambda t: _signed(simhash(t)), id_col, text_col)


def keep_rows(docs: DataFrame, prints: DataFrame, of: DataFrame, own_print, id_col: str, text_col: str) -> DataFrame:
    """``keep_one`` for rows ``prints`` (id, fp), fingerprints ``of`` (fp, root, component_id), and the function from a text's bytes to its signed fp."""
    mine = prints.join(of, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    named, texted, made_col, told = free(docs, "__cf_id", "__cf_text", "__cf_own", "__cf_fp")
    chosen = keep(mine.groupBy("root").agg(F.min(F.struct("id", "fp")).alias("x")).select(F.col("x.id").alias(named), F.col("x.fp").alias(told)), "chosen")
    if not prints.groupBy("id").count().where("count > 1 or id is null").limit(1).count():
        # the ids are hashed and the texts streamed past them: no text is sorted
        return docs.join(chosen.select(named).hint("shuffle_hash"), docs[id_col] == F.col(named)).drop(named)
    # an id alone doesn't name a row: rows carry their fingerprints
    own = docs.withColumn(texted, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField(made_col, T.LongType())])

    def run(batches):
        for b in batches:
            made = np.array([own_print(t) for t in values(b.column(b.num_columns - 1))], np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, pa.int64())], [*b.schema.names[:-1], made_col])

    printed = own.mapInArrow(run, schema)
    once = printed.join(chosen.hint("shuffle_hash"), printed[id_col].eqNullSafe(F.col(named)) & (printed[made_col] == F.col(told))).drop(named, told)
    return once.dropDuplicates([id_col, made_col]).drop(made_col)
