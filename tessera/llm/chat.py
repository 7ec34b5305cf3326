"""Chat formatting from reply trees (operator 9).

Native: DataFrame functions only.

Replies point to their parents.  Iterative self-joins double each node's
ancestor pointer: after k rounds a node knows its 2^k-th ancestor and the score
on the way, so depth d takes log2(d) rounds and never a path array per node.
The leaves of a conversation are its branches; they are ranked by mean score
(deeper first, then smallest id on ties).  For the chosen ones the saved pointers
enumerate each path's nodes, again in log2(d) joins, and texts are joined once,
at the end.

Template: ``### ROLE\\n TEXT</turn>\\n`` for each turn (without the space).  In
roles and texts a backslash becomes two, ``###`` and ``</turn>`` get a
backslash inside, and a line break in a role becomes ``\\n``; unescaping restores them exactly.
The loss mask is a list of (start, length) in code points over assistant texts.

Cases: a null text or role is empty.  A parent that does not exist makes its node a root;
nodes on a cycle of parents have no root and belong to no path.  Of rows that repeat a
node id in a conversation, the smallest parent, the smallest score and the smallest (role, text) stand.  A null score is 0.  Rows with a null
node id are ignored; a null conversation is a conversation.  An empty table gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

LOSS_ROLE = "assistant"
_END = "</turn>\n"


def escape(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("###"), F.lit("#\\##")), F.lit("</turn>"), F.lit("<\\/turn>"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Inverse of escape(): a backslash is dropped, what follows it stands."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def unescape_role(role: Column) -> Column:
    # A doubled backslash is set aside first, so that \n is a line break only where its backslash is single.
    parts = F.transform(F.split(role, r"\\\\"), lambda p: unescape(F.replace(p, F.lit("\\n"), F.lit("\n"))))
    return F.array_join(parts, "\\")


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """nodes(conv, node, parent, score) to (conv, branch, rank, leaf, depth, node): the nodes of the best branches, depth 0 at the root."""
    nodes = materialize(nodes.where("node is not null").groupBy("conv", "node").agg(F.min("parent").alias("parent"), F.min("score").alias("score")), "chat-nodes")
    step = materialize(_linked(nodes).withColumn("far", F.lit(1).cast("long")), "chat-step")
    # Only nodes that have not reached their root go on; a table of ancestors is the written parts together.
    done, active, limit = [step.where("up is null")], step.where("up is not null"), nodes.count()
    lifts = [active]
    while active.limit(1).count() and (1 << len(lifts)) <= 2 * limit:
        known = reduce(DataFrame.union, [*done, active])
        a, b = active.alias("a"), known.alias("b")
        joined = a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.up") == F.col("b.node")))
        new = materialize(joined.select("a.conv", "a.node", F.col("b.up").alias("up"), (F.col("a.sum") + F.col("b.sum")).alias("sum"),
                                        (F.col("a.far") + F.col("b.far")).alias("far")), "chat-step")
        done.append(new.where("up is null"))
        active = new.where("up is not null")
        lifts.append(active)
    step = reduce(DataFrame.union, done)  # nodes on a cycle never get here
    parents = lifts[0].select("conv", F.col("up").alias("node")).distinct()
    p = parents.alias("p")
    s = step.alias("s")
    leaves = s.join(p, F.col("s.conv").eqNullSafe(F.col("p.conv")) & (F.col("s.node") == F.col("p.node")), "left_anti")
    order = Window.partitionBy("conv").orderBy(F.desc(F.col("sum") / F.col("far")), F.desc("far"), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    paths = materialize(leaves.select("conv", "rank", F.col("node").alias("leaf"), F.col("far").alias("n"), "node", F.lit(0).cast("long").alias("above")), "chat-paths")
    for k, lift in reversed(list(enumerate(lifts))):  # distances are sums of distinct powers of two
        a, b = paths.alias("a"), lift.alias("b")
        more = a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.node") == F.col("b.node"))).select(
            "a.conv", "a.rank", "a.leaf", "a.n", F.col("b.up").alias("node"), (F.col("a.above") + (1 << k)).alias("above"))
        paths = materialize(paths.union(more), "chat-paths")
    return paths.select("conv", "rank", "leaf", (F.col("n") - 1 - F.col("above")).alias("depth"), "node")


def _linked(nodes: DataFrame) -> DataFrame:
    """(conv, node, up, sum): up is the parent where it exists."""
    a, b = nodes.alias("a"), nodes.select("conv", "node").alias("b")
    return a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.parent") == F.col("b.node")), "left").select(
        "a.conv", "a.node", F.col("b.node").alias("up"), F.coalesce(F.col("a.score"), F.lit(0.0)).cast("double").alias("sum"))


def format_chats(nodes: DataFrame, *, branches: int = 1) -> DataFrame:
    """nodes(conv, node, parent, role, text, score) to one row per chosen path: conv, rank, leaf, n_turns, formatted, loss (array of start, length)."""
    paths = best_paths(nodes.select("conv", "node", "parent", "score"), branches)
    said = nodes.where("node is not null").groupBy("conv", "node").agg(F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("said"))
    a, b = paths.alias("a"), said.alias("b")
    turns = a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.node") == F.col("b.node"))).select(
        "a.conv", "a.rank", "a.leaf", "a.depth", F.col("b.said.role").alias("role"), F.col("b.said.text").alias("text"))
    # A turn is a head and a body; the mask needs the length of what lies before.
    parts = turns.withColumns({"head": F.concat(F.lit("### "), escape_role(F.col("role")), F.lit("\n")), "body": escape(F.col("text"))})
    before = Window.partitionBy("conv", "rank", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(_END)
    placed = parts.withColumn("start", (F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")).cast("int"))
    turn = F.struct("depth", "head", "body", (F.col("role") == LOSS_ROLE).alias("loss"), "start")
    chats = placed.groupBy("conv", "rank", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), F.length(t["body"]).alias("length")))
    return chats.select("conv", "rank", "leaf", F.size("turns").cast("long").alias("n_turns"),
                        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(_END))), "").alias("formatted"), spans.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    parts = F.filter(F.split(formatted, _END), lambda p, i: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(F.substr(p, F.lit(5)), "\n", 1)).alias("role"),
        unescape(_after_line(p)).alias("text")))


def _after_line(part: Column) -> Column:
    return F.substr(part, F.length(F.substring_index(part, "\n", 1)) + 2)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")


def linear(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns in a row as a tree without branches: each replies to the one before (by turn, then role and text)."""
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
