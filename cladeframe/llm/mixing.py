"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is the expected number of copies of each of its documents: a whole part that all get, and a
fraction, the same for all, that is drawn. The cube method moves the vector of inclusion probabilities along the null space
of the balancing constraints (document count and token count), so that the totals hold exactly while every step settles a
document. Sources are cut into blocks; each block ends with two open documents at most; these are gathered and moved
again. In a source's last block a dozen documents of all sizes stay out of the flight; with the two that it leaves open
they are the landing problem, settled by the outcome whose totals are nearest to the expected ones.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, free, keep

#: Documents of one block. A block is one Arrow group of (id hash, size, probability).
BLOCK = 4_000
#: Documents of a source that are left for the landing problem.
RESERVE = 12
#: The weights of the query, by the sources' order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Times its size that a source, and so a document, is taken at most.
MOST = 3

_SMALL = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves ``p`` (probabilities) with p*x/p-balanced totals kept: sum(p) and sum(p * x) stay, and all but two end at 0 or 1."""
    p = p.copy()
    turn = iter(np.flatnonzero((p > _SMALL) & (p < 1 - _SMALL)).tolist())
    held: list[int] = []
    while True:
        for i in turn:
            held.append(i)
            if len(held) == 3:
                break
        if len(held) < 3:
            break
        a, b, c = held
        xa, xb, xc = x[a], x[b], x[c]
        # a vector orthogonal to (1,1,1) and (xa,xb,xc)
        u = (xc - xb, xa - xc, xb - xa)
        if not any(u):
            u = (1.0, -1.0, 0.0)
        ps = (p[a], p[b], p[c])
        up = min(((1 - q) / v if v > 0 else q / -v) for q, v in zip(ps, u) if v)
        down = min((q / v if v > 0 else (1 - q) / -v) for q, v in zip(ps, u) if v)
        step = up if rng.random() < down / (up + down) else -down
        for i, q, v in zip(held, ps, u):
            p[i] = min(1.0, max(0.0, q + step * v))
        held = [i for i in held if _SMALL < p[i] < 1 - _SMALL]
    p[p <= _SMALL] = 0.0
    p[p >= 1 - _SMALL] = 1.0
    return p


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Settles the few open documents: the outcome whose token total is nearest to the expected one, then whose count is; ties to the first."""
    p = p.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    if left.size:
        ways = np.arange(1 << left.size)[:, None] >> np.arange(left.size) & 1
        far = np.abs(ways @ x[left] - (p[left] * x[left]).sum())
        p[left] = ways[np.lexsort((np.abs(ways.sum(axis=1) - p[left].sum()), far))[0]]
    return p


def _moved(last: bool):
    def run(key, table):
        order = table.sort_by([("h", "ascending"), ("id", "ascending"), ("size", "ascending")])
        p, x = order["p"].to_numpy().copy(), order["size"].to_numpy().astype(float)
        seed = [int(np.uint64(v & (2**64 - 1))) for v in (key[0].as_py() or 0, key[1].as_py() or 0, order.num_rows)]
        kept_out = np.argsort(x, kind="stable")[np.unique(np.linspace(0, len(x) - 1, RESERVE).astype(int))] if last else np.empty(0, int)
        flies = np.setdiff1d(np.arange(len(x)), kept_out)
        p[flies] = flight(p[flies], x[flies], np.random.default_rng(seed))
        if last:
            p = land(p, x)
        return order.set_column(order.schema.get_field_index("p"), "p", pa.array(p))

    return run


def targets(totals: DataFrame, weights=WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """totals: (source, source_size). Adds target. Sources by code point, null last, weigh ``weights``, repeating, and share
    ``share`` of all sizes. A target stops at ``most`` times its source's size; the excess goes to the others by weight until none is above.

    That fixed point is min(most * size, level * weight) with one level for all. The level rises from the one that no stop would give; each round takes out the
    sources that stop below it, by one aggregation. Ranks come from a sort by ranges and the sizes of earlier ranges, so no task sees all sources.
    Null sizes count as 0; sources must not repeat. Empty table: no rows.
    """
    placed = totals.select("source", F.coalesce("source_size", F.lit(0)).alias("source_size")).orderBy(F.asc_nulls_last("source")).withColumn("at", F.monotonically_increasing_id())
    placed = keep(placed, "ordered-sources")
    part = F.shiftright("at", 33)
    before, seen = [], 0
    for p, n in sorted(map(tuple, placed.groupBy(part.alias("p")).count().collect())):  # a row for each range of sources
        before.append((p, seen - (p << 33)))
        seen += n
    first = placed.sparkSession.createDataFrame(before, "p long, shift long")
    t = placed.join(F.broadcast(first), part == F.col("p"))
    w = F.element_at(F.array(*[F.lit(float(v)) for v in weights]), ((F.col("at") + F.col("shift")) % len(weights) + 1).cast("int"))
    t = t.select("source", "source_size", w.alias("w"), (F.col("source_size") * float(most)).alias("cap"))
    stop = F.col("cap") / F.col("w")
    total, free = t.agg(F.sum("source_size") * share, F.sum("w")).first()
    level = total / free if free else 0.0
    while free:
        used, free = t.agg(F.sum(F.when(stop <= level, F.col("cap")).otherwise(0.0)), F.sum(F.when(stop > level, F.col("w")).otherwise(0.0))).first()
        higher = (total - used) / free if free else level
        if higher <= level:
            break
        level = higher
    return t.select("source", "source_size", F.least("cap", F.lit(float(level)) * F.col("w")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, share: float = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """(id, source, size, source_size, target, copies, row): one row per input row; copies is how often the mix takes it.

    size counts words (null text: 0). Null source: a source of its own, last. Repeated rows are drawn one by one. Sources of size 0: target 0, no copies.
    Empty table: no rows. Seeds come from the data, so reruns agree.
    """
    d = keep(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes")
    per = keep(d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    goal = targets(per, weights, most, share).join(per.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    goal = keep(goal.withColumn("e", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))), "goals")
    g = goal.select(F.col("source").alias("s"), "source_size", "target", "n", "e")
    rows = d.join(F.broadcast(g) if g.limit(10_001).count() <= 10_000 else g, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    whole = F.floor(F.col("e") + _SMALL)
    frac = F.greatest(F.col("e") - whole, F.lit(0.0))
    rows = rows.select(
        "id", "source", "size", "source_size", "target", whole.cast("int").alias("whole"), F.xxhash64("id", "size").alias("h"), F.xxhash64(F.lit(7), "source").alias("sh"),
        F.when(frac <= _SMALL, 0.0).otherwise(frac).alias("p"), F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("long").alias("blocks"),
    )
    settled = rows.where("p = 0").drop("blocks", "sh")
    open_ = rows.where("p > 0").withColumn("block", F.pmod(F.xxhash64("h", F.lit(0)), F.col("blocks")))
    done, turn = [settled], 0
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in open_.schema)
    while True:
        # a source of one block ends here; the open rows of others are two a block
        last = keep(open_.where("blocks = 1").groupBy("sh", "block").applyInArrow(_moved(True), schema).unionByName(open_.where("blocks > 1").groupBy("sh", "block").applyInArrow(_moved(False), schema)), "flight")
        done.append(last.where("p = 0 or p = 1").drop("blocks", "sh", "block"))
        still = last.where("p > 0 and p < 1")
        if not still.limit(1).count():
            break
        turn += 1
        open_ = still.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("blocks") * 2 / block)).cast("long")).withColumn("block", F.pmod(F.xxhash64("h", F.lit(turn)), F.col("blocks")))
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out.select("id", "source", "size", "source_size", "target", (F.col("whole") + F.col("p")).cast("int").alias("copies"), "h")


def mix_report(docs: DataFrame) -> DataFrame:
    m = mix(docs)
    return m.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source", "copies")


def mixed_documents(docs: DataFrame, out: str = "copies", **how) -> DataFrame:
    """The mix itself: ``docs`` with ``out``, without the documents that it leaves out; each is to be read so many times.

    A column named ``out`` is replaced, others pass through. Nulls, repeated rows, sizes and the empty table: see ``mix``."""
    id_col, text_col, source_col = how.get("id_col", "doc_id"), how.get("text_col", "text"), how.get("source_col", "source")
    m = mix(docs, **how).where("copies > 0")
    # rows that agree in id, source and size are interchangeable; where there are any, numbers on both sides give each its own draw
    hashed, sourced, numbered = free(docs, "__cf_h", "__cf_s", "__cf_n")
    keys = [hashed, sourced]
    drawn = m.select(F.col("h").alias(hashed), F.xxhash64(F.lit(7), "source").alias(sourced), F.col("copies").alias(out))
    own = docs.drop(out).withColumn(hashed, F.xxhash64(F.col(id_col), word_count(F.col(text_col)))).withColumn(sourced, F.xxhash64(F.lit(7), F.col(source_col)))
    if drawn.groupBy(*keys).count().where("count > 1").limit(1).count():
        drawn = drawn.withColumn(numbered, F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(out))))
        own = own.withColumn(numbered, F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(text_col))))
        keys = [*keys, numbered]
    return own.join(drawn.hint("shuffle_hash"), keys).drop(hashed, sourced, numbered)
