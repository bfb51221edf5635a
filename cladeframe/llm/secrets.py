"""Secret scans over a trigram inverted index, with DataFrame functions only.

1. The index posts every distinct trigram of every text: (gram, file, row), ordered by gram within each task's file. Nothing is shuffled, and
   a gram's postings are differences of a byte or two. It doesn't depend on the rules; one index serves any number of rule sets.
2. Each rule's regular expression is parsed and turned into a Boolean query of trigrams that every match must hold.
3. The postings of the trigrams that a query names are read, then intersected and united as it says. What is left is the rule's candidates.
4. Candidates are verified with the regular expression. A rule without mandatory trigrams scans every document.

A gram is 32 bits of a hash of three characters, A-Z lower-cased: two that clash can only add candidates. Candidates are joined to the texts by the
place of the row, (file, row); where they are small enough for ``spark.sql.autoBroadcastJoinThreshold`` (they are a written table) Spark broadcasts them.
"""

from __future__ import annotations

import re._constants as sc
import re._parser as sre
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free, keep, located


@dataclass(frozen=True)
class Rule:
    """``least`` is the smallest length of group ``group`` that a match must have to count."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


# The three base kinds in their listed order, then further kinds.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),  # the same matches as runs [0-9a-f]+ of which those under 16 are dropped
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

#: More alternatives than this are not followed in one literal.
_MOST = 64


def trigram_query(regex: str) -> frozenset[frozenset[str]] | None:
    """Lower-case trigrams in disjunctive form: a match's lower-cased text holds all trigrams of one of the sets. None: nothing is mandatory."""
    exact, terms = _walk(sre.parse(regex))
    if exact is not None:
        terms = _both(terms, _of_strings(exact))
    if terms is None:
        return None
    return frozenset(t for t in terms if not any(o < t for o in terms))  # absorption


def _low(c: str) -> str:
    """As the index lower-cases: A-Z only."""
    return c.lower() if c.isascii() else c


def _of_strings(strings: set[str]) -> set[frozenset[str]] | None:
    return {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings} if strings and all(len(s) >= 3 for s in strings) else None


def _both(a, b):
    if a is None or b is None:
        return b if a is None else a
    return {x | y for x in a for y in b} if len(a) * len(b) <= _MOST else a


def _walk(nodes) -> tuple[set[str] | None, set[frozenset[str]] | None]:
    """Of a sequence: its possible strings if they are few (else None), and its query so far."""
    strings: set[str] = {""}
    terms = None
    whole = True
    for op, arg in nodes:
        got, inner = _node(op, arg)
        terms = _both(terms, inner)
        if got is not None and len(strings) * len(got) <= _MOST:
            strings = {s + t for s in strings for t in got}
            continue
        whole = False
        terms = _both(terms, _of_strings(strings))
        strings = got if got is not None else {""}
    if whole:
        return strings, terms
    return None, _both(terms, _of_strings(strings))


def _node(op, arg):
    if op is sc.LITERAL:
        return {_low(chr(arg))}, None
    if op is sc.IN:
        if all(kind is sc.LITERAL for kind, _ in arg):
            return {_low(chr(x)) for _, x in arg}, None
        return None, None
    if op is sc.SUBPATTERN:
        return _walk(arg[3])
    if op is sc.BRANCH:
        ways = [_walk(x) for x in arg[1]]
        if all(w[0] is not None for w in ways):
            return set().union(*(w[0] for w in ways)), None
        each = [_both(t, _of_strings(s) if s is not None else None) for s, t in ways]
        return None, (None if any(e is None for e in each) else set().union(*each))
    if op in (sc.MAX_REPEAT, sc.MIN_REPEAT, sc.POSSESSIVE_REPEAT):
        low, high, inner = arg
        got, terms = _walk(inner)
        if (low, high) == (0, 1) and got is not None:
            return got | {""}, None
        if low == 0:
            return None, None
        if got is not None and len(got) == 1 and low == high and low <= 8:
            return {next(iter(got)) * low}, None
        return None, _both(terms, _of_strings(got) if got is not None else None)
    return ({""} if op is sc.AT else None), None


def _found(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, kind, end>> of a rule's matches, in code points. Splitting by the regex gives what lies between the matches, so lengths give the offsets."""
    regex = rule.regex
    parts = F.arrays_zip(
        F.split(text, regex, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(regex), F.lit(rule.group)).alias("value"),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.array(F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end")))
        return F.struct(F.coalesce(end, acc["at"]).alias("at"), F.when(x["hit"].isNotNull() & (F.length(x["value"]) >= rule.least), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])


#: Named trigrams up to which the index is asked by a list of them.
_FEW = 10_000


def _placed(docs: DataFrame, file: str, row: str) -> DataFrame:
    """Adds the place of each row. A table that is not read straight from files is first written to the shared folder."""
    return located(docs, {file: F.xxhash64("_metadata.file_path"), row: F.col("_metadata.row_index")})


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _gram(trigram: Column) -> Column:
    return F.hash(trigram)


def build_index(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The written postings (gram, file, row) of all trigrams of all whole texts of ``docs``, a table read from files. Null and shorter texts have none."""
    text = F.col(text_col).cast("string").alias("text")
    return _posted(_placed(docs, *(names := free(docs, "__cf_file", "__cf_row"))).select(text, *[F.col(n).alias(k) for n, k in zip(names, ("file", "row"))]))


def _posted(placed: DataFrame) -> DataFrame:
    """placed: (text, file, row)."""
    # a look-ahead gives the trigram at each place in one pass
    grams = F.array_distinct(F.regexp_extract_all(_lower(F.col("text")), F.lit("(?s)(?=(...))"), F.lit(1)))
    rows = placed.select(F.explode(grams).alias("t"), "file", "row").select(_gram(F.col("t")).alias("gram"), "file", "row")
    # version 2 of the format keeps ordered numbers as differences
    return keep(rows.sortWithinPartitions("gram", "row"), "postings", {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false"})


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(file, row, rules): the places of the rules whose query the row satisfies. Rules that scan everything are not in it."""
    queries = [trigram_query(r.regex) for r in rules]
    named = sorted({t for q in queries for term in (q or ()) for t in term})
    spark = index.sparkSession
    grams = [r[0] for r in spark.createDataFrame([(t,) for t in named], "t string").select(_gram(F.col("t"))).collect()] if named else []
    # words of 63 bits hold the trigrams, as many as the rules name
    words = [list(zip(named, grams))[i : i + 63] for i in range(0, len(named), 63)]
    place = {t: (w, i) for w, ts in enumerate(words) for i, (t, _) in enumerate(ts)}
    if len(named) <= _FEW:
        asked = index.where(F.col("gram").isin(grams))
    else:
        asked = index.join(F.broadcast(spark.createDataFrame([(g,) for g in sorted(set(grams))], "gram int")), "gram")
    bits = [F.bit_or(sum((F.when(F.col("gram") == g, F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, g) in enumerate(ts)), F.lit(0)).cast("long")).alias(f"w{w}") for w, ts in enumerate(words)]
    held = asked.groupBy("file", "row").agg(*bits) if bits else asked.select("file", "row").where("false")

    def has(term):
        masks = [0] * len(words)
        for t in term:
            w, i = place[t]
            masks[w] |= 1 << i
        out = F.lit(True)
        for w, m in enumerate(masks):
            if m:
                out = out & (F.col(f"w{w}").bitwiseAND(F.lit(m)) == F.lit(m))
        return out

    met = []
    for i, q in enumerate(queries):
        if q is not None:
            any_of = F.lit(False)
            for term in sorted(q, key=sorted):
                any_of = any_of | has(term)
            met.append(F.when(any_of, F.lit(i)))
    hit = F.filter(F.array(*met), lambda x: x.isNotNull()) if met else F.array().cast("array<int>")
    return held.select("file", "row", hit.alias("rules")).where(F.size("rules") > 0)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text_col: str = "text", out: str = "secret_spans", index: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``out``: array<struct<start, kind, end>> ordered by start, then the rule's place (kind); code points, end exclusive.

    ``index`` is what ``build_index`` gave for these very files; without it one is built. Null, empty and very long texts: none, none, all spans.
    Null or repeated ids: each row is judged by its own text. Empty table: no rows. Other columns pass through, whatever their names
    (a column named ``out`` is replaced). Spans of different rules may overlap; those of one rule don't. Any number of rules.
    """
    file, row, met = free(docs, "__cf_file", "__cf_row", "__cf_rules")
    placed = _placed(docs, file, row)
    index = _posted(placed.select(F.col(text_col).cast("string").alias("text"), F.col(file).alias("file"), F.col(row).alias("row"))) if index is None else index
    found = keep(candidates(index, rules), "candidates").select(F.col("file").alias(file), F.col("row").alias(row), F.col("rules").alias(met))
    joined = placed.join(found, [file, row], "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    each = []
    for i, r in enumerate(rules):
        spans = _found(text, r, i)
        each.append(spans if trigram_query(r.regex) is None else F.when(F.array_contains(met, i), spans).otherwise(none))
    return joined.withColumn(out, F.array_sort(F.concat(*each))).drop(file, row, met)


def redact(docs: DataFrame, spans: str = "secret_spans", text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """Replaces each span (overlapping ones together) with ``mark``. Null text stays null, a row without spans (or with null) as it is; other columns pass through."""
    text = F.col(text_col)

    def step(acc, s):
        cut = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), cut.alias("out"))

    done = F.aggregate(F.col(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return docs.withColumn(text_col, F.when(F.size(spans) > 0, done).otherwise(text))


def spans_text(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of the base kinds, a digest of the base spans and all spans."""
    rules = BASE + MORE
    found = scan_secrets(docs.select(id_col, text_col), rules, text_col, "__cf_spans")
    spans = F.col("__cf_spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))
    return found.select(
        F.col(id_col),
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(spans_text(base, rules), 256).alias("base_sha256"),
        spans_text(spans, rules).alias("spans"),
    )
