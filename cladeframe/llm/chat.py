"""Chat formatting of reply trees.

Messages (tree, id, parent, role, text, score) form trees. Self-joins that double their reach enumerate the root-to-leaf
paths; the branches of a tree are ranked by score, and each chosen path becomes one formatted conversation with the spans of
its loss mask. The formatted output is a table of parts, a part holding whole turns, so that memory is bounded by a turn
and a part however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import keep

# The template's own marks, and control strings of common chat templates that no text may smuggle in.
TURN, END = "<|turn|>", "<|end|>"
CONTROL = (TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")

_REST = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[])(\\*)({_REST})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_REST})")
_TURNS = re.compile(rf"{re.escape(TURN)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL)

#: Characters after which a part ends.
PART = 1 << 20


def escape(text: str) -> str:
    """Puts a backslash after the first character of each control string, and one more where there are some already. Reversible."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_back(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text lies in it."""
    head, body = f"{TURN}{_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn."""
    return [(_role_back(m[1]), unescape(m[2])) for m in _TURNS.finditer(formatted)]


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """messages: (tree, id, parent, score). Returns (tree, branch, step, id): of each tree the ``branches`` best root-to-leaf paths,
    by the sum of their messages' scores, ties to the smaller leaf id; step counts from the root.

    Null tree: a tree of its own. A null parent, or one that is not in the tree, makes a root. Repeated rows of one (tree, id): the first by parent and score counts.
    Null score: 0. Cycles have no root and give no path. Empty table: no rows.
    """
    m = keep(messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")).where("id is not null").groupBy("tree", "id").agg(F.min(F.struct("parent", "score")).alias("x")).select("tree", "id", "x.parent", "x.score"), "messages")
    child, up = m.alias("c"), m.alias("p")
    hop = child.join(up, F.col("c.tree").eqNullSafe(F.col("p.tree")) & (F.col("c.parent") == F.col("p.id"))).select(F.col("c.tree").alias("tree"), F.col("c.id").alias("id"), F.col("p.id").alias("top"))
    hop = keep(hop.where("id != top"), "hop")
    parents = hop.select(F.col("tree").alias("t"), F.col("top").alias("i")).distinct()
    leaves = m.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i")), "left_anti").select("tree", F.col("id").alias("leaf"))
    paths, reach = keep(leaves.select("tree", "leaf", F.col("leaf").alias("id"), F.lit(0).cast("long").alias("up")), "paths"), 1
    # hop leads 2^k messages up: paths grow to 2^(k+1) messages in each round; a cycle would never end, and ends when all rows of hop have gone round
    most = m.count()
    while hop.limit(1).count() and reach <= most:
        h = hop.select(F.col("tree").alias("t"), F.col("id").alias("i"), "top")
        longer = paths.join(h, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i"))).select("tree", "leaf", F.col("top").alias("id"), (F.col("up") + reach).alias("up"))
        paths = keep(paths.union(longer), "paths")
        far = hop.select("tree", "id", F.col("top").alias("mid"))
        hop = keep(far.join(h, F.col("tree").eqNullSafe(F.col("t")) & (F.col("mid") == F.col("i"))).select("tree", "id", "top"), "hop")
        reach *= 2
    scored = paths.alias("a").join(m.alias("b"), F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.id") == F.col("b.id"))).select("a.tree", "a.leaf", "a.id", "a.up", "b.score")
    totals = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("total"), F.max("up").alias("deep"))
    rank = Window.partitionBy("tree").orderBy(F.desc("total"), F.asc("leaf"))
    best = totals.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= branches).select(F.col("tree").alias("t"), F.col("leaf").alias("l"), "branch", "deep")
    return paths.join(best, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l"))).select("tree", "branch", (F.col("deep") - F.col("up")).alias("step"), "id")


def _kept_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "branch").sortWithinPartitions("tree", "branch", "step")


def _formatted(assistant: str):
    names = ["tree", "branch", "part", "text", "mask"]

    def run(batches):
        key, part, piece, mask, at = None, 0, [], [], 0
        kind = None
        out: list[tuple] = []

        def done():
            nonlocal part, piece, mask, at
            out.append((*key, part, "".join(piece), mask))
            part, piece, mask, at = part + 1, [], [], 0

        def emit():
            cols = list(zip(*out)) if out else [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.list_(pa.list_(pa.int32())))], names)

        for b in batches:
            kind = b.column(0).type
            for tree, branch, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (tree, branch) != key:
                    if piece:
                        done()
                    key, part = (tree, branch), 0
                elif at >= PART:
                    done()
                turn, s, e = format_turn(role or "", text or "")
                if role == assistant:
                    mask.append([at + s, at + e])
                piece.append(turn)
                at += len(turn)
            if out:
                yield emit()
        if piece:
            done()
        if out:
            yield emit()

    return run


def format_conversations(messages: DataFrame, branches: int = 1, assistant: str = "assistant") -> DataFrame:
    """messages: (tree, id, parent, role, text, score). Returns (tree, branch, part, text, mask): the formatted text of each chosen path in
    parts of whole turns, in order, and the spans of the assistant's texts in the part (code points, end exclusive).

    Null role or text: empty. See ``reply_paths`` for the rest; messages that repeat a (tree, id) use the first by parent, score, role and text.
    """
    paths = reply_paths(messages, branches).alias("p")
    first = messages.where("id is not null").groupBy("tree", "id").agg(F.min(F.struct("parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"), "role", "text")).alias("x")).select("tree", "id", "x.role", "x.text").alias("m")
    rows = paths.join(first, F.col("p.tree").eqNullSafe(F.col("m.tree")) & (F.col("p.id") == F.col("m.id"))).select("p.tree", "p.branch", "p.step", "m.role", "m.text")
    kind = messages.schema["tree"].dataType.simpleString()
    return _kept_order(rows).select("tree", "branch", "role", "text").mapInArrow(_formatted(assistant), f"tree {kind}, branch int, part int, text string, mask array<array<int>>")


def _read(batches):
    """Parts in order -> one row for each conversation, from the formatted text and its mask alone."""
    names = ["tree", "branch", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    key = kind = None
    n = chars = loss = 0
    turns = hashlib.sha256()
    learnt = hashlib.sha256()
    out: list[tuple] = []

    def emit():
        cols = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.int32()), *(pa.array(c) for c in cols[2:])], names)

    for b in batches:
        kind = b.column(0).type
        for tree, branch, text, mask in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4))):
            if (tree, branch) != key:
                if key is not None:
                    out.append((*key, n, turns.hexdigest(), loss, learnt.hexdigest(), chars))
                key, n, chars, loss, turns, learnt = (tree, branch), 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            for role, said in parse(text):
                n += 1
                turns.update(f"{role}\n{said}\n".encode())
            for s, e in mask:
                said = unescape(text[s:e])
                loss += len(said)
                learnt.update(said.encode())
            chars += len(text)
        if out:
            yield emit()
    if key is not None:
        out.append((*key, n, turns.hexdigest(), loss, learnt.hexdigest(), chars))
        yield emit()


def read_back(formatted: DataFrame) -> DataFrame:
    """Of ``format_conversations``: per conversation its turns, their digest, and what lies under the loss mask, all taken from the formatted text."""
    kind = formatted.schema["tree"].dataType.simpleString()
    return formatted.mapInArrow(_read, f"tree {kind}, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def as_messages(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as chains of replies: rows by turn (null first), then role and text, so that repeated rows are turns of their own."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("id", F.row_number().over(order).cast("long"))
    return rows.select(F.col("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))
