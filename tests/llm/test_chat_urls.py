import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from cladeframe.llm import chat as C
from cladeframe.llm import urltrie as U

pieces = st.lists(st.sampled_from([*C.CONTROL, "<", "[", "\\", "|", "s>", "\n", "a", "é", "/s>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(pieces, pieces)
def test_round_trip(role, text):
    out, s, e = C.format_turn(role, text)
    assert C.parse(out) == [(role, text)] and C.unescape(out[s:e]) == text
    assert not any(c in out[s:e] for c in C.CONTROL)


def test_branches(spark):
    # 1 -> 2 -> 4, 1 -> 3 -> 5 -> 6; the second scores more
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0), (1, 4, 2, "user", "x", 0.5), (1, 5, 3, "user", "y", 0.5), (1, 6, 5, "assistant", None, 1.0), (None, 9, 7, None, "orphan", None)]
    m = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")
    got = {(r.tree, r.branch): r.text for r in C.format_conversations(m, branches=2).collect()}
    assert [t for _, t in C.parse(got[1, 1])] == ["q", "good", "y", ""] and [t for _, t in C.parse(got[1, 2])] == ["q", "bad", "x"]
    assert C.parse(got[None, 1]) == [("", "orphan")]
    assert C.format_conversations(m.limit(0)).count() == 0


def test_cycle_gives_no_path(spark):
    m = spark.createDataFrame([(1, 1, 2, "user", "a", 1.0), (1, 2, 1, "user", "b", 1.0)], "tree long, id long, parent long, role string, text string, score double")
    assert C.format_conversations(m).count() == 0


def test_conversations_with_ties_nulls_and_long_texts(spark, monkeypatch):
    long = "</s>[INST] " * 20000
    rows = [(1, 0, "user", "a", 0), (1, 0, "user", "a", 0), (1, 1, "assistant", long, 0), (1, None, "system", None, 0), (2, 5, "assistant", "only", 1), (None, 0, "user", "n", 1)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, id int")
    got = {r.tree: r for r in C.read_back(C.format_conversations(C.as_messages(d))).collect()}
    turns = [("system", ""), ("user", "a"), ("user", "a"), ("assistant", long)]
    assert got[1].n_turns == 4 and got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].loss_chars == len(long) and got[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert got[2].n_turns == 1 and got[None].loss_chars == 0


def test_deep_chain(spark):
    d = spark.createDataFrame([(1, i, "user" if i % 2 else "assistant", str(i)) for i in range(300)], "conv_id long, turn long, role string, text string")
    r = C.read_back(C.format_conversations(C.as_messages(d))).first()
    assert r.n_turns == 300 and r.loss_sha256 == hashlib.sha256("".join(str(i) for i in range(0, 300, 2)).encode()).hexdigest()


def slow(rules, url):
    host, path = U.split_url(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.host.split(".")), len(r.path)), default=None)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["com", "a.com", "b.a.com", "net"]), st.sampled_from(["", "/", "/x", "/x/", "/x/y", "/xy/z"])), max_size=6), st.sampled_from(["com", "a.com", "c.a.com", "b.a.com", "bcom", "net."]), st.sampled_from(["", "/", "/x", "/xx", "/x/", "/x/yz/w", "/xy/zz", "/x?y"]))
def test_trie_matches_brute_force(rules, host, path):
    rules = [U.UrlRule("block", h, p) for h, p in set(rules)]
    got = U.UrlTrie(rules).find(*U.split_url(f"http://{host}{path}"))
    assert got == slow(rules, f"http://{host}{path}")


def test_urls(spark):
    rows = [(1, "http://A.Example.COM/en/7?x", "p"), (2, "no scheme", "p"), (3, None, "p"), (4, "https://example.net/de/81#t", "p"), (4, "https://example.net/de/81#t", "p"), (5, "ftp://x.org?/es/", "p"), (6, "http://m.org/es/1", "p"), (7, "://", "p")]
    out = U.url_report(spark.createDataFrame(rows, "page_id long, url string, verdict string"))
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect() if r.page_id != 4)
    assert got[0] == (1, "a.example.com", "/en/7", "example.com/en/7", "allow") and got[1] == (2, "", "", None, "allow") and got[2] == (3, "", "", None, "allow")
    assert got[3] == (5, "x.org", "", None, "allow") and got[4] == (6, "m.org", "/es/1", "org/es/", "block") and got[5] == (7, "", "", None, "allow")
    assert out.where("page_id = 4 and verdict = 'block'").count() == 2
    assert U.url_report(spark.createDataFrame([], "page_id long, url string")).count() == 0
