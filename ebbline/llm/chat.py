"""Chat formatting of reply trees (operator 10).

Every message may answer another one.  Self-joins that double their reach find, for each
leaf, all messages up to its root; branches are ranked by the sum of their messages' scores
and each chosen path is written as one conversation, with the spans a loss is taken over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.session import freeze

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"
# A path of 2**MAX_DOUBLINGS messages is longer than any table.
MAX_DOUBLINGS = 62


def escape(text: Column) -> Column:
    """Put a backslash behind each backslash, ``<`` and ``[``.

    No marker of this or a bracketed template is left in the result, and every backslash
    in it follows one of the three, so that ``unescape`` is exact.
    """
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def escape_role(role: Column) -> Column:
    """As ``escape``; a line feed, which ends the role, becomes ``[n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("[n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("[n"), F.lit("\n")))


def branches(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, above) for every message of every root-to-leaf path.

    ``messages`` has tree, node, parent.  ``above`` is the number of messages between node
    and leaf, leaf included (0 for the leaf).  A message whose parent is null or missing is
    a root.  Rows with a null tree or node, and messages whose replies run in a circle, are
    on no path.
    """
    nodes = freeze(messages.select("tree", "node", "parent").filter("tree IS NOT NULL AND node IS NOT NULL"))
    present = nodes.select("tree", F.col("node").alias("parent")).distinct()
    jump = freeze(nodes.join(present, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("up")))
    answered = jump.select("tree", F.col("up").alias("node")).distinct()
    path = nodes.join(answered, ["tree", "node"], "left_anti").select(
        "tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above")
    )
    circles = jump.select("tree", "node").limit(0)
    reach, longest = 0, nodes.count()
    while reach < MAX_DOUBLINGS and not jump.isEmpty():
        if 1 << reach > longest:
            circles = jump.select("tree", "node")
            break
        step = jump.select("tree", "node", "up")
        further = path.join(step, ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("above") + (1 << reach)).alias("above")
        )
        path = freeze(path.union(further))
        second = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
        jump = freeze(jump.join(second, ["tree", "up"]).select("tree", "node", F.col("top").alias("up")))
        reach += 1
    return path.join(circles.select("tree", F.col("node").alias("leaf")), ["tree", "leaf"], "left_anti")


def conversations(messages: DataFrame, *, per_tree: int = 1) -> DataFrame:
    """(tree, leaf, rank, score, formatted, loss) for the best branches of each tree.

    ``messages`` has tree, node, parent, role, text, score; other columns are ignored.
    Branches are ranked within their tree by the sum of scores (null: 0), ties by the
    smaller leaf; ``per_tree`` are kept.  Null roles and texts are empty.  ``loss`` holds
    the spans (start, end; code points of ``formatted``) of the escaped assistant texts.
    Of messages with the same tree and node, the first by role and text counts.
    """
    first = Window.partitionBy("tree", "node").orderBy("role", "text", "parent", "score")
    messages = messages.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    path = branches(messages)
    score = messages.select("tree", "node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    best = (
        path.join(score, ["tree", "node"])
        .groupBy("tree", "leaf")
        .agg(F.sum("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= per_tree)
    )
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = messages.select(
        "tree",
        "node",
        (role == LEARNED_ROLE).alias("learned"),
        F.concat(F.lit(OPEN), escape_role(role), F.lit("\n")).alias("head"),
        escape(text).alias("body"),
    )
    sofar = Window.partitionBy("tree", "leaf").orderBy(F.desc("above")).rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(CLOSE)
    begin = F.coalesce(F.sum(size.cast("long")).over(sofar), F.lit(0)) + F.length("head")
    span = F.struct(begin.alias("start"), (begin + F.length("body")).alias("end"))
    return (
        path.join(best, ["tree", "leaf"])
        .join(told, ["tree", "node"])
        .select("tree", "leaf", "rank", "score", "above", F.concat("head", "body", F.lit(CLOSE)).alias("turn"), F.when(F.col("learned"), span).alias("span"))
        .groupBy("tree", "leaf", "rank", "score")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("above")).alias("at"), "turn", "span"))).alias("turns"))
        .select(
            "tree",
            "leaf",
            "rank",
            "score",
            F.array_join("turns.turn", "").alias("formatted"),
            F.filter("turns.span", lambda s: s.isNotNull()).alias("loss"),
        )
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) that a formatted conversation holds."""
    raw = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.transform(F.slice(raw, F.lit(1), F.size(raw) - 1), lambda t: F.substr(t, F.lit(len(OPEN) + 1)))
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
            unescape(F.substr(t, F.instr(t, F.lit("\n")) + 1)).alias("text"),
        ),
    )


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss spans, unescaped, in order."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), ""
    )


def linear(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as messages that answer the row before.

    Rows of equal turn are ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").alias("tree"),
        F.row_number().over(order).cast("long").alias("node"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
