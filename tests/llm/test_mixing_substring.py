import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeframe.llm import mixing as M
from cladeframe.llm import substring as S


def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    x, p = rng.integers(1, 500, 300).astype(float), np.full(300, 0.37)
    got = M.flight(p, x, rng)
    assert ((got > 0) & (got < 1)).sum() <= 2
    assert abs(got.sum() - p.sum()) < 1e-6 and abs((got * x).sum() - (p * x).sum()) < 1e-5
    assert set(np.unique(M.land(got, x))) <= {0.0, 1.0}


def fill(sizes, weights, most):
    total, free, out = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while True:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        w = sum(weights[i] for i in free)
        over = [i for i in free if w and left * weights[i] / w > most * sizes[i] + 1e-9]
        if not over:
            return [left * weights[i] / w if i in free else out[i] for i in range(len(sizes))]
        for i in over:
            out[i] = most * sizes[i]
            free.discard(i)


def test_targets(spark):
    for sizes in ([10, 500, 30, 7, 0], [100], [5, 5, 1000], [0, 0]):
        rows = [(None if i == len(sizes) - 1 and len(sizes) > 2 else f"s{i}", s) for i, s in enumerate(sizes)]
        got = {r.source: r.target for r in M.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
        want = fill(sizes, [M.WEIGHTS[i % 3] for i in range(len(sizes))], 3) if sum(sizes) else [0.0] * len(sizes)
        assert all(abs(got[s] - w) < 1e-6 for (s, _), w in zip(rows, want)), (sizes, got, want)


def test_mix(spark):
    rng = random.Random(5)
    rows = [(i, None if i % 97 == 0 else " ".join("w" for _ in range(rng.choice([1, 5, 20, 300]))), None if i % 11 == 0 else ("hot" if i % 3 == 0 else f"s{i % 5}"), 1) for i in range(1500)] + [(7, "w w", "s2", 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = M.mix_report(docs).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=str) == sorted(map(tuple, M.mix_report(docs.repartition(7)).collect()), key=str)
    by = defaultdict(list)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by[r.source].append(r)
    for rs in by.values():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(30, 0.02 * rs[0].target) and rs[0].source_size == sum(r.size for r in rs)
    small = M.mix(docs, block=50)
    for r in small.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("k"), F.first("target").alias("t")).collect():
        assert abs(r.k - r.t) <= max(30, 0.02 * r.t)
    mixed = M.mixed_documents(docs)
    assert mixed.agg(F.sum("copies")).first()[0] == sum(r.copies for r in got) and mixed.columns == [*docs.columns, "copies"]
    assert M.mix_report(docs.limit(0)).count() == 0


def brute(texts, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    n = defaultdict(int)
    for w in words:
        for i in range(len(w) - size + 1):
            n[tuple(w[i : i + size])] += 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if n[tuple(w[i : i + size])] > 1:
                gone |= set(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def corpus():
    rng = random.Random(2)
    shared = [f"p{i}" for i in range(60)]
    texts = [None, "", "short", "a " * 500, "\x0b".join(shared), " ".join(shared[:34]), " ".join(shared[:35])]
    for _ in range(60):
        t = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(10, 150))]
        if rng.random() < 0.5:
            k = rng.randrange(len(t))
            t[k:k] = shared[rng.randrange(20) :]
        texts.append(" ".join(t))
    return texts + texts[10:13]


def test_substrings_match_brute_force(spark, tmp_path):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    want = brute(texts, 35)
    docs.repartition(5).write.parquet(str(tmp_path / "d"))
    for d in (docs, spark.read.parquet(str(tmp_path / "d"))):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.repeats_report(d).collect()}
        assert got == dict(enumerate(want))
    assert S.repeats_report(docs.limit(0)).count() == 0


def test_batches_meet_history(spark, tmp_path):
    texts = corpus()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(9).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    for batches in (1, 2, 5):
        got = {r.doc_id: r.n_removed for r in S.remove_repeats(docs, batches=batches).collect()}
        assert got == {i: w[1] for i, w in enumerate(brute(texts, 35))}


def test_parts_of_runs_round_trip():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (1000, 7), (5000, 70000)):
        h = np.sort(rng.integers(0, 1 << 63, n, np.uint64))
        g, who, blocks = rng.integers(0, 1 << 32, n, np.uint32), rng.integers(-1, m, n), rng.integers(-(1 << 62), 1 << 62, m)
        h2, g2, who2, blocks2 = S._unpack(S._pack(h, g, who, blocks))
        assert (h2 == h).all() and (g2 == g).all() and ((who2 == -1) == (who == -1)).all() and (blocks2[who2[who2 >= 0]] == blocks[who[who >= 0]]).all()


def part(new, *rows):
    """rows: (fingerprint, digest, block or None)."""
    blocks = sorted({b for *_, b in rows if b is not None})
    who = [blocks.index(b) if b is not None else -1 for *_, b in rows]
    return new, (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.uint32), np.array(who), np.array(blocks, np.int64))


def test_merge_verifies_and_tells_holders():
    parts = [part(False, (5, 1, 100), (6, 1, None), (7, 3, 100), (9, 6, 200)), part(False, (9, 6, 300)), part(True, (5, 2, 400), (6, 1, 400), (7, 3, 500), (8, 8, 400))]
    answers, (h, g, who, blocks) = S.merged(parts)
    told = {(r[4], *x) for r in answers for x in zip(np.frombuffer(r[5], np.uint64).tolist(), np.frombuffer(r[6], np.uint32).tolist())}
    # 5 is two windows of one fingerprint; 9 met among older runs, which was told then
    assert told == {(400, 6, 1), (100, 7, 3), (500, 7, 3)}
    assert list(zip(h.tolist(), g.tolist(), [None if w < 0 else int(blocks[w]) for w in who])) == [(5, 1, 100), (5, 2, 400), (6, 1, None), (7, 3, None), (8, 8, 400), (9, 6, None)]


def test_digests_decide_where_fingerprints_clash(tmp_path, monkeypatch):
    import pyarrow as pa

    class Few(S.Windows):
        """All windows share eight fingerprints."""

        def __call__(self, words, second=False):
            h, *g = super().__call__(words, second)
            return (h & np.uint64(7 << 61), *g)

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = taskAttemptId = staticmethod(lambda: 0)

    monkeypatch.setattr(S, "Windows", Few)
    monkeypatch.setattr(S, "TaskContext", Task)
    monkeypatch.setattr(S, "MEMTABLE", 700)
    texts = corpus()
    rows = [pa.RecordBatch.from_arrays([pa.array([i // 8 for i in range(len(texts))], pa.int64()), pa.array(texts)], ["block", "text"])]
    out = pa.Table.from_batches(list(S._spilled(str(tmp_path), 35, 4)(rows)))
    manifest, answers = out.filter(pa.compute.is_valid(out["file"])), out.filter(pa.compute.is_valid(out["block"]))
    manifest = manifest.select(["slot", "file", "offset", "length"]).append_column("new", pa.array([True] * len(manifest))).sort_by("slot")
    answers = pa.concat_tables([answers, pa.Table.from_batches(list(S._merge(str(tmp_path), False)(manifest.to_batches())))])
    got = []
    for k in range(0, len(texts), 8):
        mine = answers.filter(pa.compute.equal(answers["block"], k // 8))
        got += S._cleaned(35, ["text"], "text")(pa.table({"text": pa.array(texts[k : k + 8])}), mine)["n_removed"].to_pylist()
    assert len(set(manifest["file"].to_pylist())) > 3 and got == [w[1] for w in brute(texts, 35)]


def test_long_texts_are_blocks_of_their_own(spark, tmp_path):
    long = " ".join(f"x{i}" for i in range(30000))
    texts = ["a b c", long, "a b c", f"z {long}", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.n_removed for r in S.remove_repeats(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == {0: 0, 1: 30000, 2: 0, 3: 30000, 4: 0}


def test_incremental_index(spark, tmp_path):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = S.FingerprintIndex(spark, str(tmp_path / "index"))
    for k in range(4):
        batch = docs.where(F.col("doc_id") % 4 == k)
        seen = [t for i, t in enumerate(texts) if i % 4 < k]
        mine = [(i, t) for i, t in enumerate(texts) if i % 4 == k]
        want = {i: w[1] for (i, _), w in zip(mine, brute(seen + [t for _, t in mine], 35)[len(seen) :])}
        for _ in range(1 + (k == 3)):  # a batch that comes again replaces its runs
            got = {r.doc_id: r.n_removed for r in S.remove_repeats(batch, index=index, batch=f"b{k}").select("doc_id", "n_removed").collect()}
            assert got == want
        if k % 2:
            assert len(index.manifests()) == (2 if k == 1 else 3)
            index.compact()
            assert len(index.manifests()) == 1
    with pytest.raises(ValueError):
        S.remove_repeats(batch, index=index, batch="b3")
    index.drop()
    assert index.manifests() == []


def test_columns_pass_through(spark):
    d = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x")], "doc_id long, text string, n_removed string")
    out = S.remove_repeats(d, size=2)
    assert out.columns == ["doc_id", "text", "n_words", "n_removed"] and [r.n_removed for r in out.collect()] == [2, 2]
