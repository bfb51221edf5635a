import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeframe.llm import decontam as D
from cladeframe.llm import knn as K

ITEM = "A farmer sells 12 apples to Maria for 3 dollars each and then buys 7 pears at the market. How much money is left after 2 days?"


def run(spark, texts, items):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return docs, bench, {(r.doc_id, r.item_id): r for r in D.contaminated(docs, bench).collect()}


def test_planted_leaks(spark):
    rng = random.Random(4)
    filler = lambda n: " ".join(f"word{rng.randrange(3000)}" for _ in range(n))
    changed = ITEM.replace("12", "40").replace("3 dollars", "5 dollars").replace("Maria", "Pedro").replace("7", "9").replace("2 days", "6 days")
    texts = [None, "", "a b c d", ITEM, f"{filler(300)} {ITEM.upper()} {filler(9000)}", f"{filler(50)} {changed} {filler(50)}", " | ".join(ITEM.split()), filler(2000), " ".join(ITEM.split()[:8]) + " " + filler(50)]
    docs, bench, got = run(spark, [*texts, ITEM], [ITEM, None, "too short", filler(40), ITEM])
    assert {k[0] for k in got} == {3, 4, 5, 6, 9} and {k[1] for k in got} == {0, 4}
    assert got[5, 0].bindings == "12=40,2=6,3=5,7=9,maria=pedro"
    clean = D.without_leaks(docs, bench)
    assert sorted(r.doc_id for r in clean.collect()) == [0, 1, 2, 7, 8] and clean.columns == docs.columns
    assert D.contaminated(docs.limit(0), bench).count() == 0 and D.contaminated(docs, bench.limit(0)).count() == 0


def test_inconsistent_slots_do_not_match(spark):
    item = "Add 5 plus 5 then take 5 from 5 and give 5 back to the 5 old kings of 5 lands"
    bad = "Add 1 plus 2 then take 3 from 4 and give 6 back to the 7 old kings of 8 lands"
    good = item.replace("5", "9")
    _, _, got = run(spark, [bad, good], [item])
    assert set(got) == {(1, 0)}


def test_slices_give_the_same(spark, monkeypatch):
    rng = random.Random(9)
    items = [" ".join(f"t{rng.randrange(500)}" for _ in range(30)) for _ in range(40)]
    texts = [items[i] + " x y z" for i in range(0, 40, 3)]
    whole = {k: tuple(v) for k, v in run(spark, texts, items)[2].items()}
    monkeypatch.setattr(D, "SLICE", 200)
    assert {k: tuple(v) for k, v in run(spark, texts, items)[2].items()} == whole and len(whole) == 14


def corpus(n=1200):
    rng = random.Random(1)
    words = ["the", "of", "and", *(f"th{rng.randrange(400)}er" for _ in range(600))]
    rows, labels = [], []
    for i in range(n):
        bad = i % 7 == 0
        t = [rng.choice(words) for _ in range(rng.choice([4, 60, 200]))]
        if bad:
            t = [[f"{w}$$$", w.upper() + "!!", f"{w} | {w}"][i % 3] for w in t]
        rows.append((i, " ".join(t), "x"))
        if i % 2 == 0 or bad:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def test_scores(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(90001, None, "x"), (90002, "", "x"), (90003, "the " * 60000, "x"), (None, "the of and", "x")], "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels + [(None, 1), (4, None), (777777, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in K.quality_report(docs, lab).collect()}
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None) and got[None].held_out is False
    held = [(got[i].predicted, q) for i, q in labels if got[i].held_out]
    assert np.mean([p == q for p, q in held]) > 0.95
    assert got[90001].score == got[90002].score
    # labels of held-out rows change nothing
    flipped = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels], "doc_id long, quality int")
    again = {r.doc_id: r.score for r in K.quality_report(docs, flipped).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in again)


def test_votes_match_brute_force(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    model = K.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    f = K.Features()
    for _, text, _ in rows[:20]:
        z = f(text.encode()) @ model.projection
        sim = model.vectors @ (z / np.linalg.norm(z))
        near = np.argsort(-sim)[: K.NEIGHBOURS]
        w = np.maximum(sim[near], 0).astype(float) ** K.POWER
        assert abs(model.scores(f(text.encode())[None])[0] - (w * model.labels[near]).sum() / w.sum()) < 1e-3


def test_ids_that_repeat_are_fitted_once(spark):
    rows, labels = corpus(60)
    docs = spark.createDataFrame([r for r in rows for _ in range(1 + 40 * (r[0] % 10 == 0))], "doc_id long, text string, x string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    model, once = K.fit(docs, lab), K.fit(spark.createDataFrame(rows, "doc_id long, text string, x string"), lab)
    assert len(model.labels) == len(once.labels) < len(labels) and np.allclose(np.abs(model.vectors @ model.vectors.T), np.abs(once.vectors @ once.vectors.T), atol=1e-4)


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in K.quality_report(docs, none).collect()] == [0.5, 0.5]
    assert K.quality_report(docs.limit(0), none).count() == 0
    assert K.fit(docs, none).prior == 0.5 and F is not None


DENSE = ["What is 12 + 35 * 7 - 4 / 2?", "Please reduce the list 12 35 7 4 2 88 31 54 17 63 29 to one sum", "3 14 15 92 65 35 89 79 32 38", "Anna met Ben Carl Dora Emil Fritz Gerd Hans and Ida in Rome"]


def exact_share(item, text):
    """The largest share of the item's five-word windows in a stretch of one and a half times its length, values unchanged."""
    a, b = ([w for w in (D._OUTER.sub("", x).lower() for x in t.split()) if w] for t in (item, text))
    of = [tuple(a[o : o + 5]) for o in range(len(a) - 4)]
    at = [(p, o) for p in range(len(b) - 4) for o, w in enumerate(of) if w == tuple(b[p : p + 5])]
    reach = len(a) + max(5, len(a) // 2)
    return max((len({o for q, o in at if p <= q <= p + reach}) / len(of) for p, _ in at), default=0)


def test_items_dense_in_numbers_and_names(spark):
    rng = random.Random(11)
    filler = lambda n: " ".join(f"word{rng.randrange(3000)}" for _ in range(n))
    texts = [f"{filler(30)} {x} {filler(30)}" for x in DENSE]
    for x in DENSE:
        w = x.split()
        for n in (5, len(w) - 3, len(w) - 1):
            texts.append(f"{filler(20)} {' '.join(w[:n])} {filler(20)}")
    texts.append(" ".join(str(rng.randrange(100)) for _ in range(3000)))
    _, _, got = run(spark, texts, DENSE)
    want = {(i, k) for i, t in enumerate(texts) for k, x in enumerate(DENSE) if exact_share(x, t) >= 0.8}
    assert {(k, k) for k in range(4)} <= want and set(got) == want
    # one phrase of a dense item is no leak; new values are one where there are words enough, and none where there are not
    changed = ["Please reduce the list 13 36 8 5 3 89 32 55 18 64 30 to one sum", "What is 13 + 36 * 8 - 5 / 3?", "4 15 16 93 66 36 90 80 33 39", "Please reduce the list 1 of things"]
    assert set(run(spark, changed, DENSE)[2]) == {(0, 1)}


def test_partial_variant_before_a_leak_does_not_hide_it(spark):
    rng = random.Random(13)
    filler = lambda n: " ".join(f"word{rng.randrange(3000)}" for _ in range(n))
    changed = ITEM.replace("12", "40").replace("3 dollars", "5 dollars").replace("Maria", "Pedro").replace("7", "9").replace("2 days", "6 days")
    other = ITEM.replace("12", "41").replace("3 dollars", "8 dollars").replace("Maria", "Luisa")
    wrong = ITEM.replace("12", "40", 1)
    texts = []
    for n in (6, 9, 12):  # a worked example cut off, with other values, then the item as it is or with new values
        for whole in (ITEM, changed, wrong):
            texts.append(f"{filler(20)} {' '.join(other.split()[:n])} {whole} {filler(20)}")
    twice = "Add 5 plus 5 then take 5 from 5 and give 5 back to the 5 old kings of 5 lands"
    texts += [twice.replace("5", "9").replace("Add 9", "Add 1", 1), f"{' '.join(twice.replace('5', '1').split()[:9])} {twice}", f"{filler(30)} {' '.join(other.split()[:12])} {filler(30)}"]
    _, _, got = run(spark, texts, [ITEM, twice])
    assert set(got) == {(i, 0) for i in range(9)} | {(9, 1), (10, 1)}
    assert [got[i, 0].bindings for i in (0, 3, 6)] == ["", "", ""] and all(got[i, 0].matched == got[i, 0].windows for i in range(9))


def told(text):
    """(template, plain, exact) words, without hashes or tables: what the docstring says."""
    out, ended, after = [], True, False
    for raw in (text or "").split():
        word = re.sub(r"^[\W_]+|[\W_]+$", "", raw)
        if not word:
            continue
        low = word.lower()
        number = bool(re.fullmatch(r"[+-]?\d[\d.,:/]*(st|nd|rd|th|[a-z]{1,3})?", low))
        name = not number and len(word) > 1 and word[0].isupper() and word[1:].islower() and not ended
        unit = not number and low in D.UNITS and after
        out.append(("<unit>" if unit else "<name>" if name else "<number>" if number else low, "<number>" if number else low, low))
        ended, after = bool(re.search(r"[.!?:][\"')\]»”]*$", raw)), number
    return out


def leaks(item, text, share=0.8):
    """By brute force: some stretch of one and a half items holds 0.8 of the item's windows under one binding of its values; every way to bind them is tried."""
    a, b = told(item), told(text)
    n = len(a) - 4
    if n < 1:
        whole = [w[2] for w in b]
        return len(a) > 2 and any(whole[p : p + len(a)] == [w[2] for w in a] for p in range(len(b))) or 0 < len(a) < 3 and whole == [w[2] for w in a]
    slots = ("<number>", "<name>", "<unit>")

    def meet(p, o):
        x, y = a[o : o + 5], b[p : p + 5]
        bare, numbers = all(w[0] in slots for w in x), all(w[1] == "<number>" for w in x)
        same = [all(u[k] == v[k] for u, v in zip(x, y)) for k in range(3)]
        return 2 if (same[0] and not bare) or (same[1] and not numbers) or (same[2] and numbers) else 1 if same[0] and bare else 0

    met = {(p, o): k for p in range(len(b) - 4) for o in range(n) if (k := meet(p, o))}
    lines = {p - o for (p, o), k in met.items() if k == 2}
    pairs = sorted(w for w, k in met.items() if k == 2 or w[0] - w[1] in lines)
    values = {(p, o): {(a[o + j][2], b[p + j][2]) for j in range(5) if a[o + j][0] in slots} for p, o in pairs}
    fits = lambda have, more: all((x == u) == (y == v) for x, y in have for u, v in more)
    reach = len(a) + max(5, len(a) // 2)

    def search(rest, have, offsets, literal):
        if len(offsets) >= share * n and (literal >= 3 or all(x == y for x, y in have)):
            return True
        if len(offsets | {o for _, o in rest}) < share * n:
            return False
        for i, w in enumerate(rest):
            if not fits(values[w], values[w]) or not fits(have, values[w]):
                continue
            more = offsets | {w[1]}
            held = len({o + j for o in more for j in range(5) if a[o + j][0] not in slots})
            if search(rest[i + 1 :], have | values[w], more, held):
                return True
            if all(fits(values[w], values[x]) for x in rest[i + 1 :]):
                return False
        return False

    return any(search([w for w in pairs if p <= w[0] <= p + reach], set(), set(), 0) for p in sorted({p for p, _ in pairs}))


def question(rng):
    words, names, out = [f"q{i}" for i in range(60)], ["Anna", "Ben", "Carla", "Dmitri", "Elena", "Farid"], ["Why"]
    for _ in range(rng.randrange(8, 26)):
        kind = rng.random()
        out += [str(rng.randrange(2, 60)), rng.choice(["km", "dollars", "apples", "hours"])] if kind < 0.15 else [rng.choice(names)] if kind < 0.25 else [rng.choice(words)]
    return " ".join(out) + "?"


def varied(item, rng, consistent=True):
    """New values for numbers and names, one for each old one; or one of them changed again where it occurs next."""
    new: dict[str, str] = {}
    fresh = iter(rng.sample(range(61, 999), 60))
    out = []
    for w in item.split():
        core = w.strip("?")
        if core.isdigit() or core in ("Anna", "Ben", "Carla", "Dmitri", "Elena", "Farid"):
            if core not in new or not consistent:
                new[core] = str(next(fresh)) if core.isdigit() else "N" + "".join(rng.choice("abcdefgh") for _ in range(6))
            w = w.replace(core, new[core])
        out.append(w)
    return " ".join(out)


def test_query_against_brute_force(spark, tmp_path):
    from cladeframe.llm import entry

    rng = random.Random(21)
    filler = lambda n: " ".join(f"word{rng.randrange(3000)}" for _ in range(n))
    items = [question(rng) for _ in range(40)] + ["What is photosynthesis?", "Name three noble gases", "Yes", None, "", "a b"]
    texts, planted = [None, "", "Yes", "yes and no", "so what is photosynthesis? it is", "what is a photosynthesis", "a b", "a b c"], []
    for k, x in enumerate(items[:40]):
        planted.append((len(texts), k))
        texts.append(f"{filler(40)} {varied(x, rng)} {filler(40)}")
        w = x.split()
        cut = rng.randrange(len(w) // 2, len(w))
        texts.append(f"{filler(10)} {' '.join(w[:cut])} {filler(10)}")
        texts.append(f"{filler(10)} {varied(' '.join(w[: cut + 1]), rng)} {varied(x, rng, consistent=False)}")
        texts.append(f"{filler(10)} {varied(' '.join(w[:6]), rng)} {x} {filler(3)} {varied(x, rng)}")
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in entry.op8_decontamination(spark, str(tmp_path)).collect()}
    want = {(i, k) for i, t in enumerate(texts) for k, x in enumerate(items) if leaks(x, t)}
    # nothing that brute force doesn't find; of what it finds the orders of binding that are tried may miss some
    assert got <= want and len(got) >= 0.98 * len(want)
    assert len(set(planted) & got) >= 0.9 * len(planted) and {(2, 42), (4, 40), (6, 45)} <= got and len(want) > 100


def test_windows_that_all_items_share(spark):
    rng = random.Random(2)
    items = [f"How much does it cost to send {rng.randrange(99)} parcels of kind{i} to town{i} and of sort{i} to place{i} in year{i}?" for i in range(300)]
    texts = [items[7], varied(items[9], rng), "How much does it cost to send 4 parcels of " * 200, f"{'How much does it cost to send 4 parcels of ' * 50} {items[11]}"]
    _, _, got = run(spark, texts, items)
    assert set(got) == {(0, 7), (1, 9), (3, 11)}


def test_clashing_names_and_string_ids(spark):
    docs = spark.createDataFrame([("a", ITEM, 1, "x"), (None, ITEM, 2, "y"), ("a", ITEM, 1, "x"), ("b", "nothing " * 30000, 3, None)], "doc_id string, text string, item_id int, matched string")
    bench = spark.createDataFrame([("q1", ITEM, 1), (None, ITEM, 2), ("q1", ITEM, 3)], "item_id string, text string, doc_id int")
    out = D.contaminated(docs, bench)
    assert sorted((r.doc_id or "", r.item_id or "") for r in out.collect()) == sorted([(d, i) for d in ("a", "", "a") for i in ("q1", "", "q1")])
    assert [tuple(r) for r in D.without_leaks(docs, bench).collect()] == [tuple(r) for r in docs.where("doc_id = 'b'").collect()]
    with pytest.raises(ValueError):
        D.contaminated(docs, bench, id_col="item_id")
