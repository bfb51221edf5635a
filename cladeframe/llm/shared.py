"""Storage that the driver and all executors see, and helpers that several operators use."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of characters other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset on a local master (tests), a temporary one that is set once. A cluster without one is an error: its executors don't share local disks."""
    sc = spark.sparkContext
    told = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not told:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cladeframe-"))
        told = sc.getCheckpointDir()
    return told.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: its lineage ends there, and a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def located(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds ``columns``, expressions of ``_metadata``: the same on each read, whatever the split sizes.

    A table that is not read straight from files is first written to the shared folder."""
    try:
        out = docs.select("*", *[c.alias(name) for name, c in columns.items()])
        out.schema  # noqa: B018  analysis fails here if there is no file behind a row
        return out
    except Exception as e:  # noqa: BLE001
        if "_metadata" not in str(e):
            raise
    return keep(docs, "rows").select("*", *[c.alias(name) for name, c in columns.items()])


def free(docs: DataFrame, *names: str) -> list[str]:
    """Each name, or with as many underscores after it as it takes to differ from all columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def values(column: pa.Array, rows: int = 128):
    """The bytes of a text or binary column, a few rows at a time, so that a batch isn't held twice; Arrow's freed memory is given back at its end."""
    raw = column.cast(pa.binary())
    for s in range(0, len(raw), rows):
        yield from raw.slice(s, rows).to_pylist()
    pa.default_memory_pool().release_unused()


class Memo(dict):
    """word -> value, computed once for each word and forgotten when ``most`` words are held."""

    def __init__(self, of, most: int = 1 << 16):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.of(word)
        return value
