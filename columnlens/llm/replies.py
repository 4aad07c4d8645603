"""Reply trees to chat-formatted conversations, in DataFrame functions only.

Messages point at the message that they answer. Root-to-leaf paths are found by
self-joins over jump tables: level k knows for every message the one 2^k steps above
it, so a tree of depth d takes log2(d) joins, and a path of d messages is put together
from its leaf in as many. Only ids travel in these joins. Branches are ranked within
their tree by the sum of their scores, and each chosen branch becomes one conversation.

Defined results. Repeated rows of a message: one is kept (smallest parent, role, text).
Parent null, unknown or the message itself: a root. Messages on or below a cycle have no
root, so no path and no conversation. Null text or role: empty. Null score: 0. Equal
branch scores: the smaller leaf first. A null tree id is a tree. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import saved

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    """``text`` without any ``<|``: a backslash goes before the bar (reversible)."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """As a text, and without a line break, which ends the role."""
    role = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.regexp_replace(role, r"<\|", r"<\\p|")


def unescaped_role(role: Column) -> Column:
    role = F.regexp_replace(role, r"<\\p\|", "<|")
    # a backslash pair is a backslash; a lone backslash before n is a line break
    role = F.replace(role, F.lit("\\\\"), F.lit("\u0000"))
    return F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\u0000"), F.lit("\\"))


def turns_as_tree(df: DataFrame, tree="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """Flat conversations as trees of one branch: each turn answers the one before it.

    Equal turn numbers are ordered by role and text; a null turn comes first.
    """
    order = Window.partitionBy(tree).orderBy(turn, role, text)
    rows = df.select(
        F.col(tree).alias("tree"), F.row_number().over(order).cast("long").alias("node"),
        F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text")


def _same(left: DataFrame, node: str, right: DataFrame) -> Column:
    return left.tree.eqNullSafe(right["r_tree"]) & (left[node] == right["r_node"])


def _right(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"),
                     *[c.alias(k) for k, c in columns.items()])


def branches(messages: DataFrame, top: int | None = None) -> DataFrame:
    """Every node of the ``top`` best branches (None: of all) of each tree.

    ``messages``: tree, node, parent, score. Returns tree, branch (rank from 1), leaf,
    branch_score, position (0 at the root), node.
    """
    rows = messages.select(
        "tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = _right(rows.where("node is not null"))
    linked = rows.where(F.col("parent") != F.col("node"))
    up = linked.join(known, _same(linked, "parent", known), "left_semi")
    rows = rows.drop("parent").join(
        _right(up, up=F.col("parent")), (rows.tree.eqNullSafe(F.col("r_tree"))) & (rows.node == F.col("r_node")), "left")
    # steps: messages from this one up to, not including, the one it points at
    level = saved(rows.select("tree", "node", "up", "score", F.lit(1).cast("long").alias("steps")), "jumps")
    limit = level.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    levels = []
    while (1 << len(levels)) <= limit and level.where("up is not null").limit(1).count():
        moving = level.where("up is not null")
        levels.append(moving.select("tree", "node", "up"))
        above = _right(level, up2=F.col("up"), more=F.col("score"), far=F.col("steps"))
        joined = moving.join(above, _same(moving, "up", above)).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("more")).alias("score"),
            (F.col("steps") + F.col("far")).alias("steps"))
        level = saved(joined.union(level.where("up is null")), "jumps")
    rooted = level.where("up is null")
    parents = _right(up.select("tree", F.col("parent").alias("node")).distinct())
    leaves = rooted.join(parents, _same(rooted, "node", parents), "left_anti")
    rank = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    leaves = leaves.select(
        "tree", F.row_number().over(rank).alias("branch"), F.col("node").alias("leaf"),
        F.col("score").alias("branch_score"), (F.col("steps") - 1).alias("position"), "node")
    if top is not None:
        leaves = leaves.where(F.col("branch") <= top)
    path = leaves
    for k in reversed(range(len(levels))):
        hop = _right(levels[k], up=F.col("up"))
        path = path.union(
            path.join(hop, _same(path, "node", hop)).select(
                "tree", "branch", "leaf", "branch_score",
                (F.col("position") - (1 << k)).alias("position"), F.col("up").alias("node")))
        path = saved(path, "paths") if k % 4 == 0 and k else path
    return path


def formatted(messages: DataFrame, top: int | None = None, loss_role: str = "assistant") -> DataFrame:
    """One conversation per chosen branch: tree, branch, branch_score, formatted, loss_mask.

    ``messages``: tree, node, parent, score, role, text. ``loss_mask`` has one entry per
    turn: where its markup begins, where its text begins and ends, all in code points of
    ``formatted``; null for turns of other roles than ``loss_role``.
    """
    own = F.struct("parent", "score", "role", "text")
    rows = messages.groupBy("tree", "node").agg(F.min(own).alias("m")).select("tree", "node", "m.*")
    rows = saved(rows.where("node is not null"), "messages")
    path = branches(rows, top)
    texts = _right(rows, role=F.coalesce("role", F.lit("")), text=F.coalesce("text", F.lit("")))
    turns = path.join(texts, _same(path, "node", texts)).select(
        "tree", "branch", "branch_score", "position",
        F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")).alias("head"),
        escaped(F.col("text")).alias("body"), (F.col("role") == loss_role).alias("loss"))
    turns = turns.select(
        "*", F.concat("head", "body", F.lit(END)).alias("segment"),
        F.length("head").cast("long").alias("n_head"), F.length("body").cast("long").alias("n_body"))
    before = Window.partitionBy("tree", "branch").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("segment").cast("long")).over(before), F.lit(0).cast("long"))
    turns = turns.withColumn("begin", begin)
    span = F.struct(
        F.col("begin"), (F.col("begin") + F.col("n_head")).alias("start"),
        (F.col("begin") + F.col("n_head") + F.col("n_body")).alias("end"))
    turn = F.struct("position", "segment", F.when(F.col("loss"), span).alias("mask"))
    return (
        turns.groupBy("tree", "branch")
        .agg(F.first("branch_score").alias("branch_score"), F.sort_array(F.collect_list(turn)).alias("t"))
        .select("tree", "branch", "branch_score",
                F.array_join(F.transform("t", lambda t: t["segment"]), "").alias("formatted"),
                F.transform("t", lambda t: t["mask"]).alias("loss_mask"))
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_texts``, both read from the formatted string."""
    pieces = F.split(F.col("formatted"), r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    pairs = F.arrays_zip(pieces.alias("piece"), F.col("loss_mask").alias("mask"))

    def turn(p: Column) -> Column:
        head = F.substring_index(p["piece"], "\n", 1)
        body = F.substring(p["piece"], F.length(head) + 2, F.length(p["piece"]))
        role = F.substring(head, len(START) + 1, F.length(head))
        return F.struct(unescaped_role(role).alias("role"), unescaped(body).alias("text"))

    def masked(p: Column) -> Column:
        mask = p["mask"]
        at = (mask["start"] - mask["begin"] + 1).cast("int")
        return unescaped(F.substring(p["piece"], at, (mask["end"] - mask["start"]).cast("int")))

    return conversations.withColumn("_p", pairs).select(
        "*", F.transform("_p", turn).alias("turns"),
        F.transform(F.filter("_p", lambda p: p["mask"].isNotNull()), masked).alias("loss_texts"),
    ).drop("_p")
