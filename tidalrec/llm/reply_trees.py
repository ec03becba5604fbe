"""Reply trees: root-to-leaf paths, ranked and formatted as conversations.

Messages form trees through their parents.  Self-joins that double the reach of
every message's ancestor pointer give its root, depth and summed score in
log2(depth) rounds; leaves are ranked by the summed score of their path; the
chosen leaves are then walked back up with the same pointers, again doubling,
so a path of any length costs as many rows as it has messages.

A conversation is formatted with one template: ``<|im_start|>role\\n``, the text,
``<|im_end|>\\n`` per turn.  A control string inside a role or text gets one
backslash after its first character, one more if it has some already, so
removing one restores the text exactly and no text can open or close a turn.

Defined cases: null texts and roles are empty; a message whose parent is null
or missing is a root; of several rows with one message id each is kept and
ordered by (role, text); rows of a cycle have no root and are left out by
``paths``; a role is one line, a line break ends it; a null tree id is a tree of its own; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, load

START, END = "<|im_start|>", "<|im_end|>\n"
#: Rest of the control strings after their first character (fixed values of common chat templates).
CONTROL_TAILS = r"\||/?s>|</?SYS>|/?INST\]|/?SYS>>"
_CONTROL = rf"([<\[])(\\*)(?={CONTROL_TAILS})"
_ESCAPED = rf"([<\[])\\(\\*)(?={CONTROL_TAILS})"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def paths(messages: DataFrame, top: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """(tree, leaf, branch, depth, node): the messages of each tree's ``top`` best paths.

    ``messages`` has tree, node, parent, score; nodes are unique.  Branches are
    ranked by the path's summed score, then by the lesser leaf.
    """
    scratch = scratch or Scratch(messages.sparkSession, "reply-trees")
    answers = messages.where("parent is not null").select("tree", "node", "parent", "score").join(
        messages.select(F.col("node").alias("parent"), F.lit(True).alias("there")).distinct(), "parent", "left")
    roots = messages.where("parent is null").withColumn("there", F.lit(False))
    # pointers: the ancestor 2^k above (null beyond the root), messages passed and score gained on the way
    level = scratch.put(answers.unionByName(roots.select(answers.columns)).select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("steps"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("gain")))
    n = level.count()
    levels, done = [level.where("up is not null")], [level.where("up is null")]
    while 2 ** (len(levels) - 1) < n and not levels[-1].isEmpty():
        above = level.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"),
                             F.col("gain").alias("gain2"))
        # only messages that are not at their root yet go on; the others are what these look up
        moved = scratch.put(levels[-1].join(above, "up").select(
            "tree", "node", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"),
            (F.col("gain") + F.col("gain2")).alias("gain")))
        levels.append(moved.where("up is not null"))
        done.append(moved.where("up is null"))
        level = levels[-1]
        for d in done:
            level = level.unionByName(d)
    # a path has at most n messages, so what still points up after n steps hangs on a cycle

    leaves = level.where("up is null").join(
        messages.select(F.col("parent").alias("node")).where("node is not null").distinct(), "node", "left_anti")
    best = W.partitionBy("tree").orderBy(F.col("gain").desc(), F.col("node"))
    chosen = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= top)
    walk = chosen.select("tree", F.col("node").alias("leaf"), "branch", F.col("steps").alias("depth"), "node")
    for k in range(len(levels) - 1, -1, -1):  # nodes at multiples of 2^(k+1) above the leaf, then of 2^k
        jump = levels[k].select("node", F.col("up").alias("to"))
        more = walk.join(jump, "node").select(
            "tree", "leaf", "branch", (F.col("depth") - 2 ** k).alias("depth"), F.col("to").alias("node"))
        walk = scratch.put(walk.union(more))
    return walk


def format_paths(walk: DataFrame, messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per path: tree, leaf, branch, formatted, loss_turns, loss_spans.

    ``loss_turns`` has a boolean per turn; ``loss_spans`` the (start, length) in
    code points of the escaped texts under the loss mask, in ``formatted``.
    """
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit("\n"))
    turns = walk.join(messages.select("node", "role", "text"), "node").select(
        "tree", "leaf", "branch", "depth", "node", F.coalesce(F.col("role").isin(*loss_roles), F.lit(False)).alias("loss"),
        F.char_length(head).alias("skip"), F.char_length(escape(F.col("text"))).alias("size"),
        F.concat(head, escape(F.col("text")), F.lit(END)).alias("turn"))
    before = W.partitionBy("tree", "leaf", "branch").orderBy("depth", "node").rowsBetween(W.unboundedPreceding, -1)
    placed = turns.withColumn("at", F.coalesce(F.sum(F.char_length("turn")).over(before), F.lit(0)))
    whole = placed.groupBy("tree", "leaf", "branch").agg(F.sort_array(F.collect_list(F.struct(
        "depth", "node", "turn", "loss", (F.col("at") + F.col("skip")).alias("start"),
        F.col("size").cast("long").alias("length")))).alias("t"))
    return whole.select(
        "tree", "leaf", "branch", F.array_join("t.turn", "").alias("formatted"), F.col("t.loss").alias("loss_turns"),
        F.transform(F.filter("t", lambda x: x["loss"]),
                    lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation, unescaped."""
    def turn(t: Column) -> Column:
        body = F.substring(t, F.lit(len(START) + 1), F.char_length(t))
        cut = F.instr(body, "\n")
        return F.struct(unescape(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(body, cut + 1, F.char_length(body))).alias("text"))
    return F.transform(F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda t: t != ""), turn)


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Conversations by turn as reply trees of one branch: each turn answers the one before."""
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("i"))
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    node = lambda i: F.concat_ws("/", tree, F.lpad(i.cast("string"), 12, "0"))
    return rows.select(
        F.col("conv_id").alias("tree"), node(F.col("i")).alias("node"),
        F.when(F.col("i") > 1, node(F.col("i") - 1)).alias("parent"), "role", "text",
        F.char_length("text").cast("double").alias("score"))


def digest(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations gets back, as counts and digests."""
    turns = formatted.withColumn("turns", read_back(F.col("formatted")))
    loss = F.array_join(F.transform(F.filter("turns", lambda t, i: F.get("loss_turns", i)), lambda t: t["text"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = turns.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"), loss.alias("loss"), "formatted")
    return out.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def op3_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, formatted and read back."""
    rows = load(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    scratch = Scratch(spark, "reply-trees")
    messages = scratch.put(linear_messages(rows.union(extra)))
    return digest(format_paths(paths(messages, 1, scratch), messages))
