"""Interval-overlap joins by bins: both sides are dealt to the bins that they touch, joined by contig and bin, and a pair is kept in the first bin
that both touch, so nothing has to be made distinct. Rows of one bin are what meets; choose ``bin_size`` near the longer side's usual length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a bin in which ordered operators work.
BIN = 1 << 16


def range_join(left: DataFrame, right: DataFrame, l: tuple[str, str, str], r: tuple[str, str, str], bin_size: int | None = None, margin: int = 0, deep: int | None = None) -> DataFrame:  # noqa: E741
    """Inner join of rows whose closed intervals (contig, start, end) overlap by ``margin`` or less apart. Column names of the sides must differ.

    Without ``bin_size`` it is twice the right side's usual length, by one aggregation. With ``deep``, bins of more rows of the left side than that are dealt to several tasks, and
    the right side's rows to each of them; skewed bins are else left to adaptive execution.
    """
    (lt, ls, le), (rt, rs, re) = l, r
    if bin_size is None:
        usual = right.agg(F.percentile_approx(F.col(re) - F.col(rs) + 1, 0.9)).first()[0]
        bin_size = max(16, 2 * int(usual or 1))
    low = lambda c: F.floor(c / bin_size)
    a = left.withColumn("__b", F.explode(F.sequence(low(F.col(ls) - margin), low(F.col(le) + margin))))
    b = right.withColumn("__rb", F.explode(F.sequence(low(F.col(rs)), low(F.col(re)))))
    first = F.greatest(low(F.col(ls) - margin), low(F.col(rs)))
    on = (F.col(lt) == F.col(rt)) & (F.col("__b") == F.col("__rb")) & (F.col(ls) <= F.col(re) + margin) & (F.col(rs) <= F.col(le) + margin) & (F.col("__b") == first)
    if deep is None:
        return a.join(b, on).drop("__b", "__rb")
    parts = a.groupBy(F.col(lt).alias("__t"), F.col("__b").alias("__at")).agg(F.ceil(F.count("*") / deep).alias("__parts")).where("__parts > 1")
    of = F.coalesce("__parts", F.lit(1))
    a = a.join(parts, (F.col(lt) == F.col("__t")) & (F.col("__b") == F.col("__at")), "left").withColumn("__part", F.pmod(F.xxhash64(ls, le, F.monotonically_increasing_id()), of)).drop("__parts", "__t", "__at")
    b = b.join(parts, (F.col(rt) == F.col("__t")) & (F.col("__rb") == F.col("__at")), "left").withColumn("__rpart", F.explode(F.sequence(F.lit(0).cast("long"), of - 1))).drop("__parts", "__t", "__at")
    return a.join(b, on & (F.col("__part") == F.col("__rpart"))).drop("__b", "__rb", "__part", "__rpart")


def top_by(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")


def _bin(pos: Column, size: int) -> Column:
    return F.floor(pos / size)


def _reach(binned: DataFrame, contig: str, end: str) -> DataFrame:
    """(contig, __bin, __reach): the largest end in earlier bins, null for none. One row a bin passes the window."""
    w = Window.partitionBy(contig).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    return binned.groupBy(contig, "__bin").agg(F.max(end).alias("__most")).select(contig, "__bin", F.max("__most").over(w).alias("__reach"))


def merge_contiguous(df: DataFrame, contig: str, start: str, end: str, gap: int = 0, bin_size: int = BIN) -> DataFrame:
    """Overlapping or touching intervals (up to ``gap`` apart) become one: gaps and islands over the running maximum of ends.

    A contig is not one task's: islands are formed in each bin of starts, then joined where an earlier bin reaches them; only a row for each bin is ordered by contig.
    """
    w = Window.partitionBy(contig, "__bin").orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = df.select(contig, start, end).withColumn("__bin", _bin(F.col(start), bin_size))
    d = d.withColumn("__new", F.when(before.isNull() | (F.col(start) > before + 1 + gap), 1).otherwise(0)).withColumn("__i", F.sum("__new").over(w))
    d = d.groupBy(contig, "__bin", "__i").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("merged"))
    d = d.join(_reach(d, contig, end), [contig, "__bin"]).withColumn("__new", F.when(F.col("__reach").isNull() | (F.col(start) > F.col("__reach") + 1 + gap), 1).otherwise(0))
    bins = Window.partitionBy(contig).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    first = d.groupBy(contig, "__bin").agg(F.sum("__new").alias("__k")).select(contig, "__bin", F.coalesce(F.sum("__k").over(bins), F.lit(0)).alias("__first"))
    d = d.join(first, [contig, "__bin"]).withColumn("__island", F.col("__first") + F.sum("__new").over(Window.partitionBy(contig, "__bin").orderBy(start)))
    return d.groupBy(contig, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("merged").alias("merged")).drop("__island")


def run_lengths(df: DataFrame, keys: list[str], pos: str, state: Column, bin_size: int = BIN) -> DataFrame:
    """Runs of consecutive positions with one state: (keys, state, start, end, n).

    Runs are formed in each bin of positions; those that touch an edge of a bin, two of a bin at most, are then stitched in order.
    """

    def runs(d, parts, at, last):
        w = Window.partitionBy(*parts).orderBy(at)
        new = F.when(F.lag("state").over(w).eqNullSafe(F.col("state")) & (F.lag(last).over(w) == F.col(at) - 1), 0).otherwise(1)
        return d.withColumn("__new", new).withColumn("__run", F.sum("__new").over(w))

    d = df.withColumn("state", state).withColumn("__bin", _bin(F.col(pos), bin_size))
    d = runs(d, [*keys, "__bin"], pos, pos).groupBy(*keys, "__bin", "__run", "state").agg(F.min(pos).alias("start"), F.max(pos).alias("end"), F.count("*").alias("n"))
    edge = (F.pmod(F.col("start"), F.lit(bin_size)) == 0) | (F.pmod(F.col("end") + 1, F.lit(bin_size)) == 0)
    # runs inside a bin can't go on, and the stitching leaves them as they are
    d = d.drop("__run").withColumn("__part", F.when(edge, F.lit(None)).otherwise(F.col("__bin")))
    d = runs(d, [*keys, "__part"], "start", "end").groupBy(*keys, "__part", "__run", "state")
    return d.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("__part", "__run")


def covered_upstream(df: DataFrame, contig: str, pos: str, end: str, out: str, bin_size: int = BIN) -> DataFrame:
    """Adds ``out``: whether a row that starts earlier on the contig reaches the position. Ordered in bins; earlier bins count by their largest end."""
    d = df.withColumn("__bin", _bin(F.col(pos), bin_size))
    w = Window.partitionBy(contig, "__bin").orderBy(pos).rangeBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__own", F.max(end).over(w)).join(_reach(d, contig, end), [contig, "__bin"])
    return d.withColumn(out, F.coalesce(F.greatest("__own", "__reach") >= F.col(pos), F.lit(False))).drop("__bin", "__own", "__reach")
