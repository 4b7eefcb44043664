"""Chat formatting of reply trees, with DataFrame functions only.

Messages form trees by (tree, node, parent). Root-to-leaf paths are enumerated by joining the table of ancestors with
itself: after k joins it holds every pair of a leaf and an ancestor less than 2^k steps away, so a thread of n turns takes
log2(n) joins. Branches are ranked by the mean score of their messages, ties by the leaf's node; the `branches` best of
each tree become conversations.

Template: `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts `&` becomes `&amp;` and `<|` becomes `&lt;|`, so a
marker can only come from the template, and the way back is exact. The loss mask is a list of (start, length) in code
points over the escaped text of each assistant turn.

Edge cases: null text and null role are empty; messages without a tree or node belong to no conversation; a message whose
parent is missing is a root; of rows that repeat (tree, node) the least by (parent, role, text, score), nulls first, is the
message, and the others are no turns (`threads` numbers turns apart, so none repeats); replies that lead back to themselves
raise an error before any path is enumerated; an empty table gives none; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._state import shared_dir

START, END = "<|im_start|>", "<|im_end|>"
BLOCK = 1024  # code points


def escape(c: Column) -> Column:
    """Reversibly without any `<|`."""
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    """What escape() was given."""
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escaped_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def _role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&nl;"), F.lit("\n")))


def threads(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Linear conversations as trees: turns in order, ties by role and text, each the parent of the next."""
    w = Window.partitionBy(conv).orderBy(turn, "role", "text")
    rows = rows.filter(F.col(conv).isNotNull()).withColumn("_n", F.row_number().over(w).cast("long"))
    return rows.select(F.col(conv).alias("tree"), F.col("_n").alias("node"), F.when(F.col("_n") > 1, F.col("_n") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, depth from the root) for every leaf and every message on its path."""
    shared_dir(messages.sparkSession)
    nodes = messages.filter(F.col("tree").isNotNull() & F.col("node").isNotNull()).groupBy("tree", "node").agg(F.min("parent").alias("parent"))
    known = nodes.select("tree", F.col("node").alias("parent")).distinct()
    up = nodes.join(known, ["tree", "parent"], "left_semi").select("tree", "node", F.col("parent").alias("to")).distinct()
    heads = up.select("tree", F.col("to").alias("node")).distinct()
    found = nodes.join(heads, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height"))
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    step, jump, jumps = 1, up, []
    while True:  # a row for each message at most, and none after log2 of the longest thread
        jump = jump.checkpoint()
        if jump.isEmpty():
            break
        if step >= most:
            raise ValueError("the replies of a message lead back to it")
        jumps.append((step, jump))
        far = jump.select("tree", F.col("node").alias("to"), F.col("to").alias("beyond"))
        jump = jump.join(far, ["tree", "to"]).select("tree", "node", F.col("beyond").alias("to"))
        step *= 2
    for step, jump in jumps:
        more = found.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("to").alias("node"), (F.col("height") + step).alias("height"))
        found = found.unionByName(more).checkpoint()
    top = found.groupBy("tree", "leaf").agg(F.max("height").alias("_top"))
    return found.join(top, ["tree", "leaf"]).select("tree", "leaf", "node", (F.col("_top") - F.col("height")).alias("depth"))


def unique(messages: DataFrame) -> DataFrame:
    """One row for each (tree, node)."""
    own = messages.filter(F.col("tree").isNotNull() & F.col("node").isNotNull())
    least = own.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m"))
    return least.select("tree", "node", "m.parent", "m.role", "m.text", "m.score")


def format_chats(messages: DataFrame, branches: int = 1, numbered: bool = False) -> DataFrame:
    """(tree, leaf, rank, score, formatted, loss): one row for each of the best branches of each tree. numbered: no (tree,
    node) repeats, as threads() sees to."""
    messages = messages if numbered else unique(messages)
    full = paths(messages).join(messages.select("tree", "node", "role", "text", "score"), ["tree", "node"])
    role, text = _escaped_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    full = full.select("tree", "leaf", "depth", "score", role.alias("role"), text.alias("text"))
    before = F.sum(len(START) + len(END) + 2 + F.length("role") + F.length("text")).over(Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1))
    full = full.withColumn("at", F.coalesce(before, F.lit(0)).cast("int"))
    turns = full.groupBy("tree", "leaf").agg(F.avg("score").alias("score"), F.sort_array(F.collect_list(F.struct("depth", "role", "text", "at"))).alias("turns"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc_nulls_last("score"), "leaf"))
    best = turns.withColumn("rank", rank).filter(F.col("rank") <= branches)
    shown = F.transform("turns", lambda t: F.concat(F.lit(START), t.role, F.lit("\n"), t.text, F.lit(END + "\n")))
    begin = lambda t: (t["at"] + len(START) + 1 + F.length(t.role)).alias("start")
    mask = F.transform(F.filter("turns", lambda t: t.role == "assistant"), lambda t: F.struct(begin(t), F.length(t.text).alias("length")))
    return best.select("tree", "leaf", "rank", "score", F.array_join(shown, "").alias("formatted"), mask.alias("loss"))


def under_mask(text: Column, spans: Column) -> Column:
    """The parts of a text in some spans. The text is cut into blocks once, as Spark finds a place in it by counting from its
    beginning, and a span is cut out of its blocks."""

    def part(blocks: Column, x: Column) -> Column:
        first = x.start % BLOCK
        own = F.slice(blocks, F.floor(x.start / BLOCK).cast("int") + 1, F.floor((first + x.length) / BLOCK).cast("int") + 1)
        return F.substring(F.array_join(own, ""), first + 1, x.length)

    # a lambda's variable is evaluated once, a column within a lambda once for each element
    blocks = F.array(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    return F.element_at(F.transform(blocks, lambda b: F.transform(spans, lambda x: part(b, x))), 1)


def digest(chats: DataFrame) -> DataFrame:
    """What can be read back from the formatted conversations, as counts and digests."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")
    bodies = F.transform(pieces, lambda p: F.substring(p, len(START) + 1, 1 << 30))
    turns = F.transform(bodies, lambda p: F.concat(_role(F.substring_index(p, "\n", 1)), F.lit("\n"), unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))), F.lit("\n")))
    masked = F.array_join(F.transform(under_mask(F.col("formatted"), F.col("loss")), unescape), "")
    return chats.select(
        F.col("tree").alias("conv_id"),
        F.size(pieces).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"),
        F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
