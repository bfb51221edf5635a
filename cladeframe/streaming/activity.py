"""Ordered operators over streams: windowed means with a watermark, and activity islands that are held back until they are complete."""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """events: (ts, event_type, value). Count and sum by window and type; rows later than ``late`` are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def islands(states: DataFrame, threshold: float, gap: int = 1) -> DataFrame:
    """states: a stream of (tid, pos, prob), ordered within a contig up to the last batch. Emits (tid, start, end, n) of runs of active positions when a later position ends them.

    A row with a null prob ends its contig: the run that is held back is emitted, and the contig's state goes. Until then its last run is held back, as it may go on.
    Positions at or before the last one seen are out of order; they are left out, not fatal.
    """

    def run(key, pdfs, state):
        start, end, n, last = state.get if state.exists else (-1, -1, 0, -1)
        rows, closed = [], False
        for pdf in pdfs:
            closed |= bool(pdf.prob.isna().any())
            pdf = pdf[pdf.prob.notna()]
            for pos, prob in sorted(zip(pdf.pos.tolist(), pdf.prob.tolist())):
                if pos <= last:
                    continue
                if n and (pos - end > gap or prob <= threshold):
                    rows.append((key[0], start, end, n))
                    n = 0
                if prob > threshold:
                    start, end, n = (pos, pos, 1) if not n else (start, pos, n + 1)
                last = pos
        if closed:
            if n:
                rows.append((key[0], start, end, n))
            if state.exists:
                state.remove()
        else:
            state.update((start, end, n, last))
        yield pd.DataFrame(rows, columns=["tid", "start", "end", "n"])

    return states.groupBy("tid").applyInPandasWithState(run, "tid int, start long, end long, n long", "start long, end long, n long, last long", "append", "NoTimeout")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; on a local master without one a temporary folder."""
    told = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not told:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        told = tempfile.mkdtemp(prefix="cladeframe-stream-")
    return f"{told.rstrip('/')}/stream-{uuid.uuid4().hex}"


def finished(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Runs the stream in append mode over all that is there, into a table of the shared folder, and returns that. What the watermark still holds open isn't in it."""
    path = shared_folder(spark)
    q = df.writeStream.outputMode("append").format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


def closed(spark: SparkSession, events: DataFrame, last, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """events with a row so long after ``last`` (a timestamp) that a watermark of ``late`` closes all windows of ``events``. Its own window stays open, so it is in no result in append mode."""
    path = f"{shared_folder(spark)}/end"
    after = F.lit(last).cast("timestamp") + F.expr(f"interval {window}") * 2 + F.expr(f"interval {late}")
    nothing = [after.alias(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]
    spark.range(1).select(*nothing).write.parquet(path)
    return events.unionByName(spark.readStream.schema(events.schema).parquet(path))
