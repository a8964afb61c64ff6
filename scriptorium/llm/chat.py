"""Chat formatting of reply trees, and reading it back. Column expressions and joins only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: The template. A user's turn, an assistant's, and any other role's with the role named.
USER, USER_END = "[INST] ", " [/INST]"
ASSISTANT, ASSISTANT_END = "<s> ", " </s>"
OTHER, SAYS, OTHER_END = "[ROLE] ", " [SAYS] ", " [/ROLE]"
#: In texts and roles "<", "[" and "\" get a "\" behind them, so no control string (they begin with "<" or "[") is left.
ESCAPED = r"[<\[\\]"
UNESCAPED = r"([<\[\\])\\"
#: What stands between two control strings.
BODY = r"[^<\[]*+(?:[<\[]\\[^<\[]*+)*+"
TURN = rf"(?:\[INST\]|<s>|\[ROLE\]) {BODY}(?:\[SAYS\] {BODY})?(?:\[/INST\]|</s>|\[/ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPED, "$1")


def linear_replies(rows: DataFrame, tree: str = "conv_id", order: str = "turn") -> DataFrame:
    """A conversation in turns as a reply tree without branches: tree, node, parent, role, text, score.

    Rows of equal order follow by role and text; null roles and texts count as empty.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = rows.select(F.col(tree).alias("tree"), F.col(order).alias("at"), role.alias("role"), text.alias("text"))
    node = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("at").asc_nulls_first(), "role", "text")).cast("long")
    return rows.select("tree", node.alias("node"), "role", "text").withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def _nulls_equal(left: str, right: str, *columns: tuple[str, str]) -> Column:
    out = F.col(f"{left}.tree").eqNullSafe(F.col(f"{right}.tree"))
    for x, y in columns:
        out = out & (F.col(f"{left}.{x}") == F.col(f"{right}.{y}"))
    return out


def climbed(replies: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Every node with the way to its root: tree, node, total (sum of scores), length, is_leaf; and, by k, (tree, node, to): the ancestor 2**k steps up.

    Self-joins that double: a node knows its ancestor 2**k steps up with the score and length of the way there; joined with what that
    one knows, it knows the one twice as far up. So there are as many rounds as the logarithm of the depth, each over one row
    per node, whatever the number of leaves. Only ids and scores take part, never texts. A parent that isn't there makes a
    root. Nodes whose ancestors never end (a cycle) are left out.
    """
    nodes = replies.groupBy("tree", "node").agg(F.max("parent").alias("parent"), F.coalesce(F.max("score"), F.lit(0.0)).cast("double").alias("total"))
    nodes = staged(nodes, "chat-nodes")
    heads = nodes.select("tree", "node").alias("p")
    up = nodes.alias("c").join(heads, _nulls_equal("c", "p", ("parent", "node")), "left").select("c.tree", "c.node", F.col("p.node").alias("to"), "total", F.lit(1).cast("long").alias("length"))
    up = staged(up, "chat-up")
    used = up.filter(F.col("to").isNotNull()).select("tree", F.col("to").alias("node")).distinct().alias("u")
    leaves = nodes.select("tree", "node").alias("n").join(used, _nulls_equal("n", "u", ("node", "node")), "left_anti").select("tree", "node")
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    steps = []
    for _ in range(math.ceil(math.log2(most + 1))):
        open_ = up.filter(F.col("to").isNotNull())
        steps.append(open_.select("tree", "node", "to"))
        on = _nulls_equal("a", "b", ("to", "node"))
        further = open_.alias("a").join(up.alias("b"), on).select("a.tree", "a.node", "b.to", (F.col("a.total") + F.col("b.total")).alias("total"), (F.col("a.length") + F.col("b.length")).alias("length"))
        up = staged(up.filter(F.col("to").isNull()).unionByName(further), "chat-up")
    ended = up.filter(F.col("to").isNull()).drop("to").alias("e")
    marked = ended.join(leaves.withColumn("is_leaf", F.lit(True)).alias("l"), _nulls_equal("e", "l", ("node", "node")), "left")
    return marked.select("e.tree", "e.node", "total", "length", F.coalesce("is_leaf", F.lit(False)).alias("is_leaf")), steps


def paths(chosen: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """tree, leaf, node, depth of each node on the way from the chosen leaves (tree, leaf) to their roots; depth 0 is the leaf.

    One join per round: after k of them the nodes less than 2**k steps up are there.
    """
    reach = chosen.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("depth"))
    for k, step in enumerate(steps):
        more = reach.alias("r").join(step.alias("j"), _nulls_equal("r", "j", ("node", "node"))).select("r.tree", "leaf", F.col("j.to").alias("node"), (F.col("depth") + (1 << k)).alias("depth"))
        reach = staged(reach.unionByName(more), "chat-reach")
    return reach


def format_trees(replies: DataFrame, per_tree: int = 1) -> DataFrame:
    """tree, leaf, formatted, loss_spans: the per_tree best paths of each reply tree, each as one conversation.

    Branches rank by the sum of their nodes' scores (null is 0), then by length, longer first, then by leaf; ranks come before paths, so only
    chosen ones are spelled out. loss_spans are the places of the assistant's texts in formatted (code points, end exclusive). A
    conversation is one row, so its turns meet in one place; nothing larger does. Nodes are unique within a tree. A null
    tree is a tree of its own; null roles and texts count as empty. An empty table gives no rows; other columns are ignored.
    """
    ways, steps = climbed(replies.select("tree", "node", "parent", "score"))
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("length"), "node")
    ranked = ways.filter("is_leaf").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_tree)
    kept = paths(staged(ranked.select("tree", F.col("node").alias("leaf")), "chat-chosen"), steps).alias("k")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    said = replies.select("tree", "node", empty("role"), empty("text")).alias("s")
    turns = kept.join(said, _nulls_equal("k", "s", ("node", "node")))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    opening = F.when(user, USER).when(assistant, ASSISTANT).otherwise(F.concat(F.lit(OTHER), escape(F.col("role")), F.lit(SAYS)))
    closing = F.when(user, USER_END).when(assistant, ASSISTANT_END).otherwise(OTHER_END)
    turn = F.struct((-F.col("depth")).alias("at"), opening.alias("opening"), escape(F.col("text")).alias("body"), closing.alias("closing"), assistant.alias("loss"))
    rows = turns.groupBy("k.tree", "k.leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(state, t):
        start = state["upto"] + F.length(t["opening"])
        end = start + F.length(t["body"])
        span = F.array(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct((end + F.length(t["closing"])).cast("long").alias("upto"), F.when(t["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate("turns", F.struct(F.lit(0).cast("long").alias("upto"), none.alias("spans")), step, lambda s: s["spans"])
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["opening"], t["body"], t["closing"])), "")
    return rows.select("tree", "leaf", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """turns (array<struct<role, text>>) and loss_text as they stand in formatted conversations."""

    def of_turn(t):
        role = F.regexp_extract(t, rf"^\[ROLE\] ({BODY})\[SAYS\] ", 1)
        text = F.regexp_extract(t, rf"^(?:\[INST\] |<s> |\[ROLE\] {BODY}\[SAYS\] )({BODY})(?:\[/INST\]|</s>|\[/ROLE\])\z", 1)
        cut = lambda x: unescape(F.substring(x, F.lit(1), F.length(x) - 1))  # noqa: E731  without the template's space
        return F.struct(F.when(t.startswith("[INST]"), "user").when(t.startswith("<s>"), "assistant").otherwise(cut(role)).alias("role"), cut(text).alias("text"))

    turns = F.transform(F.regexp_extract_all(F.col("formatted"), F.lit(TURN), F.lit(0)), of_turn)
    under = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("*", turns.alias("turns"), F.array_join(under, "").alias("loss_text"))


def chat_digests(read: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
