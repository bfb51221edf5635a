import hashlib
import io
import random
import wave
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from cladeframe.llm import chroma as A
from cladeframe.llm import warc as W
from cladeframe.llm.shared import shared_path


def test_archives_round_trip(spark):
    big, other = "é" * 600, "x" * 999
    rows = [(1, "http://a/\r\nEvil: 1", big), (9, "http://b", big), (5, None, big), (9, "http://b", big), (2, "u", other), (3, "u", other), (4, "u", None), (-8, "u", ""), (None, "u", "\r\n\r\nWARC/1.1" * 200), (7, "long", "y" * 300000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = defaultdict(list)
    for r in W.archive_report(pages).collect():
        got[r.page_id].append(tuple(r)[1:])
    for i, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        revisit = len(data) >= 1000 and i != max(same, default=i)
        assert (len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None) in got[i]
    assert len(got[9]) == 2
    assert W.archive_report(pages.limit(0)).count() == 0


def test_index_selects_records(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * (i + 1)) for i in range(200)], "page_id long, url string, html string")
    folder = shared_path(spark, "warc-test")
    index = W.write_archives(pages, folder)
    some = {r.page_id: bytes(r.payload).decode() for r in W.read_records(index.where("page_id % 10 = 3"), folder).collect()}
    assert some == {i: f"page {i} " * (i + 1) for i in range(3, 200, 10)}
    assert index.where("length <= 0").count() == 0 and index.select("file", "offset").distinct().count() == 200


def test_ranges_join_neighbours():
    places = [("a", 0, 10), ("a", 10, 5), ("a", W.GAP + 100, 5), ("b", 0, 1)]
    assert list(W._ranges(places)) == [[0, 1], [2], [3]]


def test_record_ids():
    for i in (0, 1, -1, 2**62, None):
        assert W.page_of(W.record_id(i)) == i


def test_alignment_and_recall(spark):
    rng = np.random.default_rng(0)
    vectors = [rng.normal(0, 0.12, 64) for _ in range(60)]
    rows, planted = [], set()

    def wav(x):
        import io
        import wave

        buf = io.BytesIO()
        with wave.open(buf, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(A.RATE)
            w.writeframes((np.clip(x, -1, 1) * 30000).astype("<i2").tobytes())
        return buf.getvalue()

    for i, v in enumerate(vectors):
        audio = A.melody(v)
        rows.append((i * 20, audio))
        x, _ = A.pcm(audio)
        cut = int(rng.integers(0, 6000)) // 256 * 256
        rows.append((i * 20 + 1, wav(x[cut:] + rng.normal(0, 0.05, len(x) - cut))))
        rows.append((i * 20 + 2, audio))
    rows += [(5000, None), (5020, b"junk"), (5040, b""), (None, rows[0][1])]
    media = spark.createDataFrame([(i, bytearray(a) if a is not None else None, 1) for i, a in rows], "vec_id long, audio binary, print int")
    got = {r.vec_id: r for r in A.match_recordings(media, F.col("vec_id") % 20 == 0, "vec_id", "audio").collect()}
    assert len(got) == len(rows)
    prints = {i: A.fingerprint(*A.pcm(a)) for i, a in rows if i is not None}
    hits = total = 0
    for i in range(0, 1200, 20):
        assert got[i + 2].class_id == i and got[i + 2].matches is None
        found = {m.class_id: m for m in got[i].matches}
        n = len(prints[i])
        want = set()
        for j, p in prints.items():
            if j % 20 != 2 and j != i and len(p):
                for o in range(-n, n):
                    k, bad = A.align(prints[i], p, o)
                    if k >= A.LEAST_FRAMES and bad <= A.MOST_ERRORS * 32 * k:
                        want.add(j)
        total += len(want)
        hits += len(want & set(found))
        for c, m in found.items():
            assert A.align(prints[i], prints[c], m.offset) == (m.frames, m.errors)
        planted |= want
    assert total >= 50 and hits >= 0.9 * total
    assert got[5000].class_id is None and got[5020].matches == [] and got[None].class_id == 0
    assert A.match_recordings(media.limit(0), F.lit(True), "vec_id", "audio").count() == 0


def test_copies_cut_at_any_sample_are_found(spark):
    rng = np.random.default_rng(5)
    rows, cuts = [], {}
    for i in range(60):
        audio = A.melody(rng.normal(0, 0.12, 64))
        x, _ = A.pcm(audio)
        cut = int(rng.integers(0, 6000)) // 256 * 256 + (128, 100, 64, 37, 200)[i % 5]
        y = x[cut:] + rng.normal(0, 0.05, len(x) - cut)
        buf = io.BytesIO()
        with wave.open(buf, "wb") as w:
            w.setparams((1, 2, A.RATE, 0, "NONE", ""))
            w.writeframes((np.clip(y, -1, 1) * 30000).astype("<i2").tobytes())
        rows += [(i * 20, bytearray(audio)), (i * 20 + 1, bytearray(buf.getvalue()))]
        cuts[i * 20] = cut
    media = spark.createDataFrame(rows, "vec_id long, audio binary")
    got = {r.vec_id: r.matches for r in A.match_recordings(media, F.col("vec_id") % 20 == 0, "vec_id", "audio").collect()}
    found = sum(any(m.class_id == i + 1 and abs(m.offset - cut / A.HOP) < 1 for m in got[i]) for i, cut in cuts.items())
    assert found >= 0.95 * len(cuts)
    assert all(m.class_id == i + 1 for i in cuts for m in got[i])


def test_true_offset_is_found_beside_held_tones(spark):
    rng = np.random.default_rng(6)
    step = 512

    def wav(x):
        buf = io.BytesIO()
        with wave.open(buf, "wb") as w:
            w.setparams((1, 2, A.RATE, 0, "NONE", ""))
            w.writeframes((np.clip(x, -1, 1) * 30000).astype("<i2").tobytes())
        return bytearray(buf.getvalue())

    # a held tone that ends one query and starts the other recording outvotes the tune that both hold
    tune, other, more = (A.pcm(A.melody(rng.normal(0, 0.12, n)))[0] for n in (64, 40, 40))
    tone = 0.6 * np.sin(2 * np.pi * 440 * np.arange(150 * step) / A.RATE)
    a, b = np.concatenate([tune, tone, other]), np.concatenate([tone, more, tune + rng.normal(0, 0.2, len(tune))])
    media = spark.createDataFrame([(0, wav(a)), (1, wav(b))], "vec_id long, audio binary")
    p, q = (A.fingerprint(*A.pcm(bytes(wav(x)))) for x in (a, b))
    (m,) = next(r.matches for r in A.match_recordings(media, F.col("vec_id") == 0, "vec_id", "audio").collect() if r.vec_id == 0) or [None]
    every = [(bad / n, o) for o in range(-len(q), len(p)) for n, bad in [A.align(p, q, o)] if n >= A.LEAST_FRAMES]
    assert m.errors / m.frames == min(every)[0] and m.offset == min(every)[1]


def test_keys_are_runs():
    p = np.array([7, 7, 7, 0, 9, 9, 8, 8, 8], np.uint32)
    v, at, n = A.keys(p)
    pair = lambda a, b: a << 32 | b
    assert list(zip(v.tolist(), at.tolist(), n.tolist())) == [(pair(7, 7), 0, 2), (pair(9, 9), 4, 1), (pair(9, 8), 5, 1), (pair(8, 8), 6, 2)]
    assert all(len(x) == 0 for x in A.keys(p[:1])) and A.align(p, p, 0) == (8, 0)


def test_silence_held_tones_and_hot_keys(spark):
    rng = np.random.default_rng(9)

    def wav(x):
        buf = io.BytesIO()
        with wave.open(buf, "wb") as w:
            w.setparams((1, 2, A.RATE, 0, "NONE", ""))
            w.writeframes((np.clip(x, -1, 1) * 30000).astype("<i2").tobytes())
        return bytearray(buf.getvalue())

    quiet = np.zeros(60 * A.HOP, np.float32)
    tunes = [A.pcm(A.melody(rng.normal(0, 0.12, 40)))[0] for _ in range(12)]
    rows = [(i, wav(np.concatenate([quiet, x, quiet]))) for i, x in enumerate(tunes)]
    rows += [(100 + i, wav(np.concatenate([quiet, quiet, x[: 30 * 512]]))) for i, x in enumerate(tunes)]
    rows += [(200, wav(quiet)), (201, wav(np.concatenate([quiet, quiet])))]
    tone = 0.5 * np.sin(2 * np.pi * 440 * np.arange(200 * A.HOP) / A.RATE)
    rows += [(300 + i, wav(np.concatenate([tone, x]))) for i, x in enumerate(tunes[:4])]
    media = spark.createDataFrame([(i, a, "x", 0) for i, a in rows], "vec_id long, audio binary, q string, frames int")
    got = {r.vec_id: r for r in A.match_recordings(media, F.col("vec_id") < 400, "vec_id", "audio").collect()}
    salted = {r.vec_id: r for r in A.match_recordings(media, F.col("vec_id") < 400, "vec_id", "audio", most=3).collect()}
    assert salted == got
    for i in range(12):
        assert 100 + i in {m.class_id for m in got[i].matches} and not {m.class_id for m in got[i].matches} & {200, 201}
    assert got[200].matches == [] and got[201].matches == []
    # the held tone is common to these recordings: 32 frames and more, at some offset
    assert all({300 + j for j in range(4) if j != i} <= {m.class_id for m in got[300 + i].matches} for i in range(4))


def test_long_recordings_and_pages(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = A.pcm(A.melody(rng.normal(0, 0.12, 4000)))[0]
    whole = A.fingerprint(x, A.RATE)
    part = A.fingerprint(x[3000 * A.HOP :], A.RATE)
    n, bad = A.align(whole, part, 3000)
    assert n == len(part) > 4000 and bad == 0
    pages = spark.createDataFrame([(1, None, "x" * 3_000_000, 5), (2, "u" * 5000, "é" * 500, 6), (2, "u", "é" * 500, 7), (3, "u", "é" * 500, 8), (None, "v", None, 9)], "page_id long, url string, html string, offset int")
    index = W.write_archives(pages, str(tmp_path / "w"))
    got = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in W.read_records(index.unionByName(index.where("page_id = 1")), str(tmp_path / "w")).collect()), key=str)
    assert got == sorted([(1, 3_000_000, "response", None)] * 2 + [(2, 1000, "revisit", 3)] * 2 + [(3, 1000, "response", None), (0, 0, "response", None)], key=str)
    assert W.read_records(index.limit(0), str(tmp_path / "w")).count() == 0
