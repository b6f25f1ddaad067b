"""Reply trees to conversations.

Messages form trees by their parent links. Pointer doubling, an iterative self-join whose number of rounds is the
logarithm of the depth, gives every leaf the score of its path from the root; leaves are ranked in their tree, and a
second walk over the same jumps marks the messages of the chosen paths. Each path becomes one formatted conversation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import empty_if_null, materialise

# The strings that mark turns.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
OTHER_OPEN, OTHER_SPLIT, OTHER_CLOSE = "[ROLE]", "[SEP]", "[/ROLE]"
# End of the fixed values.

_TURN = re.compile(r"\[INST\](.*?)\[/INST\]|<s>(.*?)</s>|\[SYS\](.*?)\[/SYS\]|\[ROLE\](.*?)\[SEP\](.*?)\[/ROLE\]", re.DOTALL)
_ESCAPED = re.compile(r"([<\[\\])\\")


def escape(col: Column) -> Column:
    """A backslash behind each <, [ and backslash: no mark can then occur in a text."""
    return F.regexp_replace(col, r"([<\[\\])", r"$1\\")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns = []
    for m in _TURN.finditer(formatted):
        user, assistant, system, role, text = m.groups()
        own = [(r, unescape(t)) for r, t in (("user", user), ("assistant", assistant), ("system", system)) if t is not None]
        turns += own or [(unescape(role), unescape(text))]
    return turns


def best_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """Messages (tree, node, parent, score) of the best `per_tree` root-to-leaf paths of each tree.

    Returns tree, path (1: best), node, position from 0. A path's score is the sum of its messages' scores; ties go to
    the smaller leaf. (tree, node) must be unique. A message whose parent is null or missing is a root; messages on a
    cycle of parents have no root and are left out."""
    m = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    m = materialise(m, "messages")
    known = m.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    linked = m.join(known, (m.tree.eqNullSafe(known.t)) & (m.parent == known.p), "left")
    walk = materialise(linked.select("tree", "node", F.col("p").alias("up"), F.lit(0).cast("long").alias("depth"), "score", F.col("p").isNotNull().cast("long").alias("hops")), "walk")
    walk = walk.select("tree", "node", "up", F.col("hops").alias("depth"), "score")
    total, jumps = m.count(), []
    # depth and score cover the message and its ancestors below `up`; messages without an `up` left are at their root
    while True:
        if not walk.where("up is not null").limit(1).count() or 2 ** (len(jumps) - 1) > total:
            break
        jumps.append(walk.where("up is not null").select("tree", "node", F.col("up").alias("to")))
        above = walk.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("score").alias("s2"))
        moving = walk.where("up is not null")
        moved = moving.join(above, moving.tree.eqNullSafe(above.t) & (moving.up == above.n)).select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("score") + F.col("s2")).alias("score"))
        walk = materialise(walk.where("up is null").unionByName(moved), "walk")
    rooted = walk.where("up is null")
    parents = m.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = rooted.join(parents, rooted.tree.eqNullSafe(parents.t) & (rooted.node == parents.p), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "node"))
    marked = leaves.withColumn("path", rank).where(F.col("path") <= per_tree).select("tree", "path", "node")
    for jump in reversed(jumps):
        j = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "to")
        reached = marked.join(j, marked.tree.eqNullSafe(j.t) & (marked.node == j.n), "left")
        marked = reached.select("tree", "path", F.explode(F.array_compact(F.array("node", "to"))).alias("node")).distinct()
    at = rooted.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("depth").alias("position"))
    return marked.join(at, marked.tree.eqNullSafe(at.t) & (marked.node == at.n)).select("tree", "path", "node", "position")


def format_turn(role: Column, text: Column) -> Column:
    """One turn, marked; texts and unknown roles are escaped."""
    body = escape(empty_if_null(text))
    out = F.concat(F.lit(OTHER_OPEN), escape(empty_if_null(role)), F.lit(OTHER_SPLIT), body, F.lit(OTHER_CLOSE))
    for name, (before, after) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(before), body, F.lit(after))).otherwise(out)
    return out


def format_chats(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """tree, path, n_turns, formatted, loss_spans for the best `per_tree` paths of each tree of messages.

    messages: tree, node, parent, role, text, score. loss_spans: (start, end) of each assistant text in formatted, in
    characters. Null texts and roles are empty strings; a null score is 0. A conversation is one row of the result,
    so one conversation must fit a task; trees, hot or not, are never gathered whole. An empty table gives an empty
    result, and other columns are ignored."""
    paths = best_paths(messages, per_tree)
    body = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", format_turn(F.col("role"), F.col("text")).alias("turn"))
    turns = paths.join(body, paths.tree.eqNullSafe(body.t) & (paths.node == body.n))
    before, after = MARKS["assistant"]
    chats = turns.groupBy("tree", "path").agg(F.array_sort(F.collect_list(F.struct("position", "role", "turn"))).alias("turns"))
    ends = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc.at + F.length(x.turn)).cast("int").alias("at"),
            F.when(x.role == "assistant", F.concat(acc.spans, F.array(F.struct((acc.at + len(before)).cast("int").alias("start"), (acc.at + F.length(x.turn) - len(after)).cast("int").alias("end"))))).otherwise(acc.spans).alias("spans"),
        ),
        lambda acc: acc.spans,
    )
    return chats.select("tree", "path", F.size("turns").alias("n_turns"), F.array_join(F.transform("turns", lambda x: x.turn), "").alias("formatted"), ends.alias("loss_spans"))


def turn_messages(conversations: DataFrame) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as trees of one branch: each row replies to the row before it.

    Rows with the same turn are ordered by role and text; equal rows stay separate messages. Each message scores 1."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))
