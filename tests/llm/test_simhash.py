import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cladeframe.llm import simhash as S


def slow_print(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(items):
    root = {i: i for i, _ in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in items:
        for b, y in items:
            if (x ^ y).bit_count() <= 3:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i, _ in items}


def test_covering_masks_miss_no_pair():
    masks = S.covering_masks()
    assert len(masks) == 15
    from itertools import combinations

    for c in combinations(range(64), 3):
        bits = sum(1 << i for i in c)
        assert any(not m & bits for m in masks)
    for m in masks[:3]:
        for f in S.finer_masks(m)[:1]:
            assert f & m == m


def test_fingerprint_matches_spark_xxhash(spark):
    text = "The Quick\tbrown É fox\x0bjumps over"
    assert S.simhash(text.encode()) == slow_print(text)
    w = "the quick brown"
    assert spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(w.encode(), 42)


def test_groups_match_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t", "one", "one two", "ONE TWO", "x " * 20000]
    for _ in range(12):
        t = [rng.choice(words) for _ in range(120)]
        for k in range(6):
            u = list(t)
            for _ in range(k):
                u[rng.randrange(120)] = rng.choice(words)
            texts.append(" ".join(u))
    texts += texts[10:14]
    rows = [(i * 7 + 1, t, 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    want = slow_groups([(i, slow_print(t)) for i, t, _ in rows])
    for most in (4096, 2):
        got = S.near_duplicates(docs, most=most).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert {r.doc_id: int(r.fingerprint, 16) for r in got} == {i: slow_print(t) for i, t, _ in rows}
    kept = S.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs.columns


def test_large_buckets_go_to_finer_tables(spark):
    rng = np.random.default_rng(1)
    base = int(rng.integers(1 << 62))
    fps = {base}
    for _ in range(60):
        f = base
        for b in rng.choice(64, rng.integers(1, 8), replace=False):
            f ^= 1 << int(b)
        fps.add(f)
    fps = sorted(fps)
    signed = [S._signed(f) for f in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = slow_groups([(s, f) for s, f in zip(signed, fps)])
    for most in (1000, 3, 1):
        got = {r.node: r.root for r in S.groups(S.links(nodes, most)).collect()}
        assert {s: got.get(s, s) for s in signed} == {s: min(t for t in signed if want[t] == want[s]) for s in signed}


def test_null_ids_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "q r s t u")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in S.near_duplicates(docs).collect())
    assert got == [(-1, -1), (-1, 5), (5, 5), (5, 5)]
    assert len(S.keep_one(docs).collect()) == 2
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_repeated_and_null_ids_keep_a_row_of_each_group(spark):
    far = ["a b c d e f", "q r s t u v w", "one two three four five six", "x1 x2 x3 x4"]
    docs = spark.createDataFrame([(None, far[0], "p"), (None, far[1], "q"), (5, far[2], "r"), (5, far[3], "s"), (3, far[3], "t"), (5, far[2], "u"), (None, far[3], "v")], "doc_id long, text string, more string")
    got = S.keep_one(docs)
    assert got.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(rows, key=str) == sorted([(None, far[0]), (None, far[1]), (5, far[2]), (3, far[3])], key=str)


def test_groups_of_hubs_and_chains(spark):
    rng = random.Random(3)
    links = [(0, i) for i in range(1, 60)] + [(i, 500) for i in range(400, 460)] + [(i, i + 1) for i in range(700, 760)] + [(59, 430), (7, 7)] + [(rng.randrange(800, 900), rng.randrange(800, 900)) for _ in range(60)]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    want = {x: r for x, r in root.items() if any(x in pair and pair[0] != pair[1] for pair in links)}
    for hot in (5, 1000):
        got = {r.node: r.root for r in S.groups(spark.createDataFrame(links, "a long, b long"), hot).collect()}
        assert {x: got.get(x, x) for x in want} == want
    assert S.groups(spark.createDataFrame([], "a long, b long")).count() == 0
