"""Audio fingerprints of media columns.

A recording (16-bit mono PCM in a WAV container) gives frames of twelve pitch classes. Haar-like filters over
stretches of frames, evaluated on an integral image, are cut into two bits each; sixteen of them make a packed integer for
each frame. Recordings with the same integers form one class. Query classes meet all classes by equal pairs of integers; their offsets are
the alignments to judge, and the least share of differing bits over the aligned frames decides. A query is printed at ``PHASES`` starts within a
hop, so that a copy cut between two frames meets it too.
"""

from __future__ import annotations

import io
import struct
import wave
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep, values

RATE = 4000
FRAME, HOP = 1024, 256
#: Share of differing bits up to which two aligned recordings match, and frames that they must share at least.
MOST_ERRORS, LEAST_FRAMES = 0.25, 32
#: Starts within a hop at which queries are printed: a copy cut anywhere is at most an eighth of a hop from one.
PHASES = 4
#: Recordings rendered or printed at once.
BATCH = 64
#: Runs of one key that a task joins.
HOT = 100_000
#: Values up to which the table of hot ones is broadcast: 16 MB. Frames transformed at once.
_FEW, _AT_ONCE = 1_000_000, 4096
_WIDTH = 16
_STEPS = (-0.35, 0.0, 0.35)


def _filters() -> list[tuple[list[tuple[int, int, int, int, int]], None]]:
    """Sixteen filters, each a list of signed rectangles (sign, from frame, to frame, from class, to class) in a stretch of _WIDTH frames."""
    half, out = _WIDTH // 2, []
    for low in range(0, 12, 3):  # one third against the rest of the octave
        out.append([(1, 0, _WIDTH, low, low + 3), (-1, 0, _WIDTH, (low + 6) % 12, (low + 6) % 12 + 3)])
    for low in range(0, 12, 2):  # later against earlier in two classes
        out.append([(1, half, _WIDTH, low, low + 2), (-1, 0, half, low, low + 2)])
    for low in range(0, 12, 4):  # diagonal
        out.append([(1, 0, half, low, low + 2), (1, half, _WIDTH, low + 2, low + 4), (-1, half, _WIDTH, low, low + 2), (-1, 0, half, low + 2, low + 4)])
    for low in (0, 4, 8):  # neighbouring classes
        out.append([(1, 0, _WIDTH, low, low + 2), (-1, 0, _WIDTH, low + 2, low + 4)])
    return out


_FILTERS = _filters()


@lru_cache
def _classes(rate: int) -> tuple[np.ndarray, np.ndarray]:
    """Window, and the matrix from spectrum bins to pitch classes, between 55 Hz and half the rate."""
    hz = np.fft.rfftfreq(FRAME, 1 / rate)
    to = np.zeros((len(hz), 12), np.float32)
    heard = np.flatnonzero((hz >= 55) & (hz < rate / 2))
    to[heard, np.round(12 * np.log2(hz[heard] / 440.0)).astype(int) % 12] = 1.0
    return np.hanning(FRAME).astype(np.float32), to


def pcm(data: bytes | None) -> tuple[np.ndarray, int]:
    """Samples in -1..1 (channels averaged) and rate; empty if there is no readable 16-bit WAV."""
    try:
        with wave.open(io.BytesIO(data or b"")) as w:
            if w.getsampwidth() != 2:
                return np.empty(0, np.float32), RATE
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768
            return x[: len(x) // w.getnchannels() * w.getnchannels()].reshape(-1, w.getnchannels()).mean(axis=1), w.getframerate()
    except (wave.Error, EOFError, struct.error):
        return np.empty(0, np.float32), RATE


def _power(samples: np.ndarray, n: int, rate: int) -> np.ndarray:
    """Pitch classes of the n frames, each of about unit length, zero where there is no sound."""
    window, to = _classes(rate)
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP][:n]
    out = np.empty((n, 12))
    for s in range(0, n, _AT_ONCE):
        power = np.abs(np.fft.rfft(frames[s : s + _AT_ONCE] * window, axis=1)).astype(np.float32) ** 2 @ to
        out[s : s + _AT_ONCE] = power / (np.sqrt((power**2).sum(axis=1, keepdims=True)) + 1e-6)
    return out


def fingerprint(samples: np.ndarray, rate: int) -> np.ndarray:
    """A uint32 for each frame that has a full stretch after it, 0 where that is silent; empty for recordings that are too short."""
    n = (len(samples) - FRAME) // HOP + 1
    if n < _WIDTH:
        return np.empty(0, np.uint32)
    image = np.zeros((n + 1, 13))
    np.cumsum(np.cumsum(_power(samples, n, rate), axis=0), axis=1, out=image[1:, 1:])
    m = n - _WIDTH + 1
    out = np.zeros(m, np.uint32)
    area = lambda a, b, c, d: image[b : b + m, d] - image[a : a + m, d] - image[b : b + m, c] + image[a : a + m, c]
    for rects in _FILTERS:
        plus = sum(area(a, b, c, d) for s, a, b, c, d in rects if s > 0)
        minus = sum(area(a, b, c, d) for s, a, b, c, d in rects if s < 0)
        level = np.searchsorted(_STEPS, np.log1p(np.maximum(plus, 0)) - np.log1p(np.maximum(minus, 0))).astype(np.uint32)
        out = out << np.uint32(2) | (level ^ level >> np.uint32(1))  # Gray code: neighbouring levels differ in one bit
    out[area(0, _WIDTH, 0, 12) < 1e-3] = 0
    return out


def align(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[int, int]:
    """Frames with sound that a and b share when frame i of a lies on frame i - offset of b, and their differing bits."""
    s, e = max(0, offset), min(len(a), len(b) + offset)
    if e <= s:
        return 0, 0
    x, y = a[s:e], b[s - offset : e - offset]
    heard = (x != 0) & (y != 0)
    return int(heard.sum()), int(np.bitwise_count((x ^ y)[heard]).sum())


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of two neighbouring integers (one alone is shared by chance too often), as runs: value, first frame and length. A held tone is one run. Silence gives none."""
    if len(prints) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    value = (prints[:-1].astype(np.uint64) << np.uint64(32) | prints[1:]).view(np.int64)
    heard = (prints[:-1] != 0) & (prints[1:] != 0)
    first = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (heard[1:] != heard[:-1]))))
    long = np.diff(np.append(first, len(value)))
    on = heard[first]
    return value[first][on], first[on].astype(np.int32), long[on].astype(np.int32)


def _listed(parts: list[list[tuple[np.ndarray, ...]] | None], names: list[str]) -> pa.Array:
    """A list of structs for each row, null for None; a row's parts are tuples of arrays of one length."""
    kinds = [np.int64] + [np.int32] * (len(names) - 1)
    flat = [np.concatenate([x[k] for row in parts for x in row or ()] or [np.empty(0, kind)]).astype(kind) for k, kind in enumerate(kinds)]
    ends = np.cumsum([0, *(sum(len(x[0]) for x in row or ()) for row in parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(f) for f in flat], names=names), mask=pa.array([row is None for row in parts]))


def _printed(batches):
    for b in (whole.slice(s, BATCH) for whole in batches for s in range(0, whole.num_rows, BATCH)):
        prints, index, asked = [], [], []
        for x, q in zip(values(b.column(1)), b.column(2).to_pylist()):
            samples, rate = pcm(x)
            own = fingerprint(samples, rate)
            prints.append(own.view(np.int32))
            index.append([keys(own)])
            later = [own] + [fingerprint(samples[k * HOP // PHASES :], rate) for k in range(1, PHASES)] if q else []
            asked.append([(*got, np.full(len(got[0]), k)) for k, p in enumerate(later) for got in [keys(p)]] if q else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.list_(pa.int32())), b.column(2), _listed(index, ["value", "at", "n"]), _listed(asked, ["value", "at", "n", "phase"])], names=["id", "print", "q", "keys", "asked"])


def audio_fingerprints(media: DataFrame, id_col: str, audio_col: str, is_query: Column) -> DataFrame:
    """(id, print, q, keys, asked): print is array<int>, empty where there is no readable audio; q is ``is_query``, false where that is null; keys are those of the
    print, asked those of a query from all starts within the first hop, null for other rows. One row per input row."""
    rows = media.select(F.col(id_col).cast("long").alias("id"), F.col(audio_col).alias("audio"), F.coalesce(is_query, F.lit(False)).alias("q"))
    return rows.mapInArrow(_printed, "id long, print array<int>, q boolean, keys array<struct<value:long,at:int,n:int>>, asked array<struct<value:long,at:int,n:int,phase:int>>")


def _aligned(batches):
    names = ["q", "c", "offset", "errors", "frames"]
    for b in (whole.slice(s, 1000) for whole in batches for s in range(0, whole.num_rows, 1000)):
        out = []
        for q, c, spans, x, y in zip(*(b.column(i).to_pylist() for i in range(5))):
            x, y, best = np.array(x, np.int32).view(np.uint32), np.array(y, np.int32).view(np.uint32), None
            for o in sorted({o for s in spans for o in range(s["low"], s["high"] + 1 + (s["phase"] > 0))}):
                n, bad = align(x, y, o)
                if n >= LEAST_FRAMES and bad <= MOST_ERRORS * 32 * n:
                    of = (bad / n, -n, abs(o), o, bad, n)
                    best = of if best is None else min(best, of)
            if best:
                out.append((q, c, *best[3:]))
        cols = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=names)


def _met(asked: DataFrame, index: DataFrame, most: int) -> DataFrame:
    """Joins both by value. A value that more than ``most`` runs of the index hold is dealt to several tasks: its runs by their class, the queries to each of them."""
    hot = keep(index.groupBy("value").agg(F.ceil(F.count("*") / most).alias("parts")).where("parts > 1"), "hot")
    hot = F.broadcast(hot) if hot.count() <= _FEW else hot
    parts = F.coalesce("parts", F.lit(1))
    index = index.join(hot, "value", "left").withColumn("part", F.pmod(F.xxhash64("c"), parts)).drop("parts")
    asked = asked.join(hot, "value", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    return asked.join(index, ["value", "part"])


def match_recordings(media: DataFrame, is_query: Column, id_col: str, audio_col: str, most: int = HOT) -> DataFrame:
    """(id, class_id, frames, is_query, matches), one row per input row.

    Recordings with equal fingerprints are one class, named by its smallest id. For rows with ``is_query`` matches is an
    array<struct<class_id, offset, errors, frames>> of all other classes that align with theirs, ordered by class_id; for other rows it is null.
    Offsets are in frames; a copy cut between two frames takes the frame with fewer errors; of tied offsets the one with more frames counts, then the one nearest to 0.
    Frames of silence match nothing. Null, unreadable or too short audio: no frames, class_id null, no matches. A null id counts only where a class has no other.
    Repeated rows repeat. Recordings of any length are printed whole. Empty table: no rows. Other columns are left out, whatever their names.
    """
    prints = keep(audio_fingerprints(media, id_col, audio_col, is_query), "prints")
    some = F.size("print") > 0
    heard = prints.where(some).withColumn("digest", F.sha2(F.array_join(F.transform("print", lambda x: x.cast("string")), ","), 256))
    classes = keep(heard.groupBy("digest").agg(F.min("id").alias("class_id"), F.max("q").alias("asks"), F.first("print").alias("print"), F.first("keys").alias("keys"), F.max("asked").alias("asked")).where("class_id is not null"), "classes")
    index = classes.select(F.col("class_id").alias("c"), F.inline("keys").alias("value", "c_at", "c_n"))
    asked = classes.where("asks").select(F.col("class_id").alias("q"), F.inline("asked").alias("value", "q_at", "q_n", "phase"))
    votes = _met(asked, index, most).where("q != c")
    # two runs of one key propose all offsets at which they touch; each is judged: held tones may outvote the true one
    span = F.struct((F.col("q_at") - F.col("c_at") - F.col("c_n") + 1).alias("low"), (F.col("q_at") - F.col("c_at") + F.col("q_n") - 1).alias("high"), "phase")
    best = votes.groupBy("q", "c").agg(F.collect_set(span).alias("offsets"))
    of = classes.select("class_id", "print")
    both = best.join(of.select(F.col("class_id").alias("q"), F.col("print").alias("x")), "q").join(of.select(F.col("class_id").alias("c"), F.col("print").alias("y")), "c")
    found = both.select("q", "c", "offsets", "x", "y").mapInArrow(_aligned, "q long, c long, offset int, errors int, frames int")
    lists = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct(F.col("c").alias("class_id"), "offset", "errors", "frames"))).alias("matches"))
    rows = prints.withColumn("digest", F.when(some, F.sha2(F.array_join(F.transform("print", lambda x: x.cast("string")), ","), 256)))
    rows = rows.join(classes.select("digest", "class_id"), "digest", "left").join(lists.withColumnRenamed("q", "class_id"), "class_id", "left")
    none = F.array().cast("array<struct<class_id:bigint,offset:int,errors:int,frames:int>>")
    return rows.select(F.col("id").alias(id_col), "class_id", F.size("print").alias("frames"), F.col("q").alias("is_query"), F.when(F.col("q"), F.coalesce("matches", none)).alias("matches"))


def melody(vector, rate: int = RATE, step: int = 512) -> bytes:
    """A WAV recording of a vector: for each number a chord of ``step`` samples, pitched by its value."""
    v = np.nan_to_num(np.asarray(vector if vector is not None else [], np.float32))
    pitch = np.clip(np.round(60 + 40 * v), 40, 90)
    t = np.arange(step, dtype=np.float32) / rate
    hz = 440.0 * 2 ** ((pitch - 69) / 12)
    sound = 0.6 * np.sin(2 * np.pi * hz[:, None] * t) + 0.3 * np.sin(2 * np.pi * 1.5 * hz[:, None] * t)
    data = (np.clip(sound.ravel(), -1, 1) * 30000).astype("<i2").tobytes()
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(data)
    return buf.getvalue()


def _rendered(batches):
    for b in batches:
        for s in range(0, b.num_rows, BATCH):
            part = b.slice(s, BATCH)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([melody(v) for v in part.column(1).to_pylist()], pa.binary())], names=["vec_id", "audio"])


def recordings(embeddings: DataFrame) -> DataFrame:
    """There is no table of audio: each embedding is rendered as a recording (vec_id, audio)."""
    return embeddings.select("vec_id", "embedding").mapInArrow(_rendered, "vec_id long, audio binary")
