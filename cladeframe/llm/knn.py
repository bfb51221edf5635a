"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Features of a text are hashed words and hashed word shapes (letter case, digits and symbols), as dampened, normalised counts.
The labelled texts, at most ``MOST_LABELLED`` of them, give a truncated singular value decomposition; their vectors and the projection
are broadcast (under 2 MB). Each document's cosine with every labelled vector is computed exactly, in blocks, and its nearest
neighbours vote with their similarity.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh32_intdigest

from .shared import Memo, values

#: Bound of the sample of labelled rows that the classifier is fitted on: those with the smallest hash of their id.
MOST_LABELLED = 3000
WORDS, SHAPES, RANK = 1024, 256, 48
NEIGHBOURS, POWER = 25, 4.0
#: How much the shapes weigh beside the words.
SHAPE_WEIGHT = 2.0
#: Documents of one matrix product.
_BLOCK = 256

_RUNS = [(re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0")]


def _shape(word: str) -> str:
    def letters(m: re.Match) -> str:
        w = m[0]
        return "a" if w.islower() else "A" if w.isupper() and len(w) > 1 else "T"

    s = _RUNS[1][0].sub("0", _RUNS[0][0].sub(letters, word))
    return re.sub(r"(.)\1+", r"\1\1", s)[:12]


def _coded(word: bytes) -> int:
    text = word.decode("utf-8", "replace")
    return xxh32_intdigest(text.lower().encode()) % WORDS * SHAPES + 1 + xxh32_intdigest(_shape(text).encode(), 1) % (SHAPES - 1)


class Features:
    def __init__(self):
        self.code = Memo(_coded)

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").split()
        out = np.zeros(WORDS + SHAPES, np.float32)
        if words:
            codes = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
            shapes = codes % SHAPES
            shapes[1:][codes[1:] == codes[:-1]] = 0  # a word that repeats the one before it has a shape of its own
            w = np.log1p(np.bincount(codes // SHAPES, minlength=WORDS))
            s = np.sqrt(np.bincount(shapes, minlength=SHAPES) / len(words))
            out[:WORDS] = w / np.sqrt((w * w).sum())
            out[WORDS:] = SHAPE_WEIGHT * s / np.sqrt((s * s).sum())
        return out


@dataclass
class Model:
    projection: np.ndarray  # features x rank
    vectors: np.ndarray  # labelled x rank, of length 1
    labels: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(x), self.prior)
        z = x @ self.projection
        size = np.sqrt((z * z).sum(axis=1, keepdims=True))
        sim = (z / np.where(size > 0, size, 1)) @ self.vectors.T
        k = min(NEIGHBOURS, sim.shape[1])
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(sim, near, axis=1), 0.0).astype(np.float64) ** POWER
        total = w.sum(axis=1)
        vote = (w * self.labels[near]).sum(axis=1)
        return np.where(total > 0, np.minimum(vote / np.where(total > 0, total, 1), 1.0), self.prior)


def _featured(batches):
    features = Features()
    for b in batches:
        x = [features(t).tobytes() for t in values(b.column(1))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary()), b.column(2)], names=["id", "x", "label"])


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5. Null id: null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_LABELLED) -> Model:
    """Learns from rows of labels whose ``fold`` isn't 0. Rows without label or document don't count; of labels that contradict each other the mean does, rounded.

    One text counts for each id, of texts that share one the one with the least features, so ``most`` rows at most reach the driver, however often ids repeat. Null and empty texts have no features, but their label counts.
    No labels or no documents: every score is 0.5. Other columns of ``docs`` and ``labels``, whatever their names, aren't used."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != 0)).groupBy(id_col).agg(F.round(F.avg(label_col)).cast("double").alias("label"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(most).select(F.col(id_col).alias("__cf_id"), "label")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("__cf_id")).select("id", "text", "label")
    found = rows.mapInArrow(_featured, f"id {rows.schema['id'].dataType.simpleString()}, x binary, label double")
    if rows.groupBy("id").count().where("count > 1").limit(1).count():  # by ids alone; rows of features are ordered only where ids repeat
        found = found.groupBy("id").agg(F.min("x").alias("x"), F.min("label").alias("label"))
    got = sorted((r["id"], bytes(r["x"]), r["label"]) for r in found.collect())
    size = WORDS + SHAPES
    y = np.array([r[2] for r in got], np.float64)
    if not got:
        return Model(np.zeros((size, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5)
    x = np.stack([np.frombuffer(r[1], np.float32) for r in got])
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    basis = vectors[:, np.argsort(-values)[:RANK]].astype(np.float32)
    z = x @ basis
    length = np.sqrt((z * z).sum(axis=1, keepdims=True))
    return Model(basis, z / np.where(length > 0, length, 1), y, float(y.mean()))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1; a column named ``out`` is replaced. Null or empty texts get the labels' mean. Rows keep their place; nothing is shuffled."""
    rest = docs.drop(out)
    at = rest.columns.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        features = Features()
        for b in batches:
            for s in range(0, max(b.num_rows, 1), _BLOCK):
                part = b.slice(s, _BLOCK)
                if part.num_rows:
                    x = np.stack([features(t) for t in values(part.column(at))])
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held.value.scores(x), pa.float64())], names=[*part.schema.names, out])

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(out, T.DoubleType())]))


#: Score from which a document is predicted to be of quality 1.
ACCEPT = 0.3


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
