import random
import re

import corpus_pipeline as P
from cladeframe.llm import knn
from cladeframe.llm import secrets as S

from test_text_quality import leaks


def brute_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    item = " ".join(rng.choice(words) for _ in range(25))
    for i in range(160):
        t = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        if i % 8 == 0:
            t = [f"{w}%%%" for w in t]
        if i % 10 == 3:
            t += item.split()
        if i % 9 == 4:
            t.append("token=abcdefghijklmnop")
        text = " ".join(t)
        rows.append((i, text, "en", None if i % 13 == 0 else f"s{i % 3}", len(text)))
        if i % 2 == 0:
            labels.append((i, int(i % 8 != 0), 0))
    rows += [(200 + k, rows[k][1], *rows[k][2:]) for k in (1, 2, 5, 15)] + [(210 + k, rows[k][1] + " more words", *rows[k][2:]) for k in (1, 7, 9)] + [(300, None, None, None, None), (301, "", "", "", 0)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model = knn.fit(docs, spark.read.parquet(f"{d}/labels.parquet"))
    left = {r[0]: r for r in rows if float(model.scores(knn.Features()((r[1] or "").encode())[None])[0]) >= knn.ACCEPT}
    assert not any(i % 8 == 0 for i in left if i < 160)
    first = docs
    seen = []
    for name, stage in P.STAGES[:4]:
        out = stage(spark, first, d)
        assert out.columns == docs.columns
        out.write.parquet(f"{d}/{name}")
        first = spark.read.parquet(f"{d}/{name}")
        seen.append({r.doc_id: tuple(r) for r in first.collect()})
        assert len(seen[-1]) == first.count()
    assert set(seen[0]) == set(left)
    grams = {i: brute_shingles(r[1]) for i, r in left.items()}
    root = {i: i for i in left}
    for a, x in grams.items():
        for b, y in grams.items():
            if (x == y or 5 * len(x & y) >= 4 * len(x | y)) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert set(seen[1]) == set(root.values()) and len(seen[1]) < len(left) - 4
    assert set(seen[2]) == {i for i in seen[1] if not leaks(item, left[i][1])} and len(seen[2]) < len(seen[1])
    assert set(seen[3]) == set(seen[2])
    for i, r in seen[3].items():
        assert r[1] == (None if left[i][1] is None else re.sub("token=abcdefghijklmnop", "[REDACTED]", left[i][1])) and (r[4] == len(r[1]) if r[1] is not None else True)
    mix = P.STAGES[4][1](spark, first, d).collect()
    sizes, took, wanted = {}, {}, {}
    n = lambda t: len((t or "").split())
    for r in seen[3].values():
        sizes[r[3]] = sizes.get(r[3], 0) + n(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    for r in mix:
        took[r.source] = took.get(r.source, 0) + n(r.text)
        assert 0 <= r.copy < 3
    wanted = {s: w / sum(weights.values()) * sum(sizes.values()) for s, w in weights.items() if sizes[s]}
    for s, w in wanted.items():
        if max(wanted[x] / sizes[x] for x in wanted) <= 3:
            assert abs(took.get(s, 0) - w) <= max(60, 0.1 * w)
    assert P.run(spark, d).count() == len(mix)
    assert S.BASE[0].kind == "assign"


def tables(spark, d, docs, labels=(), items=()):
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return spark.read.parquet(f"{d}/documents.parquet")


KIND = "doc_id long, text string, source string, quality_score string, secret_spans int, copies string, copy int, __cf_text string, label int, item_id string"


def test_nulls_repeats_and_clashing_names(spark, tmp_path):
    long = " ".join(f"v{i}" for i in range(30000))
    extra = ("q", 7, "c", 8, "t", 9, "i")
    rows = [(1, "a b c token=abcdefghijklmnop d", "s", *extra), (1, "a b c token=abcdefghijklmnop d", "s", *extra), (None, "e f g", None, *extra), (None, None, "s", *extra), (2, "", "t", *extra), (3, "  ", None, *extra), (4, long, "t", *extra), (5, f"{long} w", "s", *extra)]
    docs = tables(spark, str(tmp_path), spark.createDataFrame(rows, KIND), [(1, 1, 0), (None, 0, 0)], [(0, None), (1, "")])
    want = {"quality": 8, "near_duplicates": 4, "decontamination": 8, "secret_scan": 8}
    for name, stage in P.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.names == docs.schema.names and out.count() == want[name], name
        assert all(tuple(r)[3:] == extra for r in out.collect())
    texts = [r.text for r in P.secret_scan(spark, docs, str(tmp_path)).collect()]
    assert texts.count("a b c [REDACTED] d") == 2 and texts.count(None) == 1
    mix = P.mixing_to_weights(spark, docs, str(tmp_path))
    assert mix.columns == [*docs.columns, "copy_"] and mix.where("trim(coalesce(text, '')) = ''").where("source = 't'").count() <= 3
    assert P.run(spark, str(tmp_path)).columns == [*docs.columns, "copy_"]


def test_empty_tables(spark, tmp_path):
    docs = tables(spark, str(tmp_path), spark.createDataFrame([], KIND))
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and out.columns[: len(docs.columns)] == docs.columns, name
    assert P.run(spark, str(tmp_path)).count() == 0
