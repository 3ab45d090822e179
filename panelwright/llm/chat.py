"""Reply trees as chat text, with DataFrame functions only.

Every message knows its parent. Self-joins double the length of jumps towards the root, so a tree of depth n takes about
log2(n) joins, and as many joins of the leaves with the jumps, longest first, give the branches message by message. Branches are ranked by their score within a tree and the chosen
ones are formatted, one conversation each.

A conversation is a row of turns ``<|role|>text</s>``. In texts and roles ``~``, ``<``, ``[`` and ``|`` are written ``~0``,
``~1``, ``~2`` and ``~3``, so no text can hold a control string, and the way back is unique: every tilde is followed by its
digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import stored

ASSISTANT = "assistant"
OPEN, SHUT, END = "<|", "|>", "</s>"
#: In the order of escaping; the tilde goes first and comes back last.
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), ("|", "~3"))


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def tree_of_turns(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages ``tree, node, parent, role, text, score`` of a table without branches: each turn answers the one before it.
    Rows that share a turn follow each other by role, then text; null role and text are empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    plain = rows.select(
        F.col(conversation).alias("tree"), F.col(turn).alias("turn"), role.alias("role"), text.alias("text")
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = plain.withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return numbered.select("tree", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables ``tree, node, above``: the k-th leads 2**k messages up and holds the messages that have so many above them.
    The last frame holds the messages whose way runs in a circle: they still jump further than their tree is large."""
    known = nodes.select("tree", F.col("node").alias("parent"))
    # trees may have a null key, so keys compare null-safe throughout
    first = nodes.alias("n").join(
        known.alias("k"), F.col("n.tree").eqNullSafe(F.col("k.tree")) & (F.col("n.parent") == F.col("k.parent"))
    )
    jumps = [stored(first.select("n.tree", "n.node", F.col("n.parent").alias("above")), "jumps")]
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    length = 1
    while length < largest and not jumps[-1].isEmpty():
        low, high = jumps[-1].alias("l"), jumps[-1].alias("h")
        joined = low.join(high, F.col("l.tree").eqNullSafe(F.col("h.tree")) & (F.col("l.above") == F.col("h.node")))
        jumps.append(stored(joined.select("l.tree", "l.node", "h.above"), "jumps"))
        length *= 2
    return jumps[:-1], jumps[-1]


def branches(messages: DataFrame) -> DataFrame:
    """``tree, leaf, node, up``: for every leaf the messages from it (``up`` 0) to the root, a row each. A message whose
    parent is missing is a root; leaves behind a circle have no root and no rows.

    The rows are as many as the branches are long together: a message at distance d is reached by the jumps that
    d consists of as a binary number, each row once, so one tree of any depth is spread over all tasks.
    """
    nodes = messages.select("tree", "node", "parent")
    jumps, endless = _jumps(nodes)

    def without(rows: DataFrame, others: DataFrame) -> DataFrame:
        same = F.col("w.tree").eqNullSafe(F.col("p.tree")) & (F.col("w.node") == F.col("p.node"))
        return rows.alias("w").join(others.alias("p"), same, "left_anti").select("tree", "node")

    parents = (jumps[0] if jumps else endless).select("tree", F.col("above").alias("node")).distinct()
    leaves = without(without(nodes, parents), endless)
    found = stored(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")), "branches")
    for k in reversed(range(len(jumps))):
        low, high = found.alias("l"), jumps[k].alias("h")
        joined = low.join(high, F.col("l.tree").eqNullSafe(F.col("h.tree")) & (F.col("l.node") == F.col("h.node")))
        further = joined.select("l.tree", "l.leaf", F.col("h.above").alias("node"), (F.col("l.up") + (1 << k)).alias("up"))
        found = found.unionByName(stored(further, "branches"))
    return found


def conversations(messages: DataFrame, best: int | None = None) -> DataFrame:
    """``tree, leaf, rank, score, formatted, loss`` of the branches of every tree, the ``best`` ones if given.

    ``messages`` has ``tree, node, parent, role, text, score`` with (tree, node) unique. A branch's score is the mean of its
    messages'; rank 1 is the highest, ties go to the smaller leaf. ``loss`` lists start and length, in code points of
    ``formatted``, of the assistant's texts. A parent that is not in the tree makes a root; messages on a cycle
    have no leaf and no branch; an empty table gives no rows; other columns are ignored.
    """
    steps = branches(messages).select("tree", "leaf", "node", (-F.col("up")).alias("step"))
    told = messages.select(
        F.col("tree").alias("_tree"),
        F.col("node").alias("_node"),
        escape(F.coalesce("role", F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    rows = steps.join(told, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("node") == F.col("_node")))
    whole = rows.groupBy("tree", "leaf").agg(
        F.avg("score").alias("score"), F.array_sort(F.collect_list(F.struct("step", "role", "text"))).alias("turns")
    )
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    whole = whole.withColumn("rank", rank)
    if best is not None:
        whole = whole.where(F.col("rank") <= best)
    texts = F.transform(
        "turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(SHUT), t["text"], F.lit(END))
    )
    # starts of the assistant's texts: the length of what stands before, and of the marks
    marks = len(OPEN) + len(SHUT)
    walked = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["role"]) + F.length(t["text"]) + marks + len(END)).alias("at"),
            F.when(
                t["role"] == ASSISTANT,
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["at"] + F.length(t["role"]) + marks).alias("start"), F.length(t["text"]).alias("length")
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return whole.select("tree", "leaf", "rank", "score", F.array_join(texts, "").alias("formatted"), walked.alias("loss"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text) from a formatted conversation."""
    parts = F.filter(F.split(formatted, END), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), SHUT, 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, SHUT) + len(SHUT))).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), ""
    )
