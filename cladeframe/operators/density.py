"""Density clustering of variants by their depth features, with noise.

The space is cut into cells of side ``eps``, and variants are counted by cell before anything is compared, so that a crowded place is one row. Cells with ``least``
variants or more are dense; dense cells that touch, in all directions, are one group. Variants of other cells join the most crowded dense cell
that touches theirs; the rest is noise, -1.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..streaming.activity import shared_folder

#: Features up to which a cell's neighbours, 3 ** features, are listed.
MOST_FEATURES = 7


def _kept(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _near(cell: Column, features: int) -> Column:
    """The cells that touch a cell, itself among them."""
    steps = F.array(*[F.array(*[F.lit(x) for x in step]) for step in product((-1, 0, 1), repeat=features)])
    return F.transform(steps, lambda step: F.zip_with(cell, step, lambda c, x: c + x))


def components(edges: DataFrame) -> DataFrame:
    """edges: (a, b), in both directions, each node with itself too. (node, root): the least node that it reaches. Each round looks at the neighbours' roots, then at the root's root, on written tables."""
    roots = _kept(edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node"))
    while True:
        seen = edges.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = roots.join(seen, F.col("node") == F.col("a")).select("node", F.least("root", "near").alias("up"), F.col("root").alias("was"))
        jump = step.select(F.col("node").alias("up"), F.col("up").alias("top"))
        new = _kept(step.join(jump, "up").select("node", F.least("up", "top").alias("root"), "was"))
        if not new.where("root != was").limit(1).count():
            return new.select("node", "root")
        roots = new.select("node", "root")


def density_groups(points: DataFrame, eps: float, least: int) -> DataFrame:
    """points: (id, features array<double>, as many for each, null for none). (id, grp): groups are numbered by their least cell, from 0; -1 is noise, and so are rows without features."""
    size = points.agg(F.max(F.size("features"))).first()[0] or 0
    if size > MOST_FEATURES:
        raise ValueError(f"{size} features; project them to {MOST_FEATURES} or fewer")
    d = points.select("id", F.when(F.size("features") == size, F.transform("features", lambda x: F.floor(x / eps).cast("long"))).alias("cell"))
    cells = _kept(d.where("cell is not null").groupBy("cell").agg(F.count("*").alias("n")))
    dense = cells.where(F.col("n") >= least)
    pairs = dense.select(F.col("cell").alias("a"), F.explode(_near(F.col("cell"), size)).alias("b")).join(dense.select(F.col("cell").alias("b")), "b", "left_semi")
    roots = components(_kept(pairs.select("a", "b")))
    firsts = roots.select("root").distinct().select("root", (F.row_number().over(_by_root()) - 1).cast("int").alias("grp"))  # a row for each group
    of = roots.join(firsts, "root").select(F.col("node").alias("cell"), "grp").join(dense, "cell")
    border = cells.where(F.col("n") < least).select(F.col("cell").alias("own"), F.explode(_near(F.col("cell"), size)).alias("cell")).join(of, "cell")
    border = border.groupBy("own").agg(F.min(F.struct((-F.col("n")).alias("n"), "cell", "grp")).alias("x")).select(F.col("own").alias("cell"), F.col("x.grp").alias("grp"))
    return d.join(of.select("cell", "grp").unionByName(border), "cell", "left").select("id", F.coalesce("grp", F.lit(-1)).alias("grp"))


def _by_root():
    from pyspark.sql import Window

    return Window.orderBy("root")
