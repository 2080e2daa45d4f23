"""Chat formatting of reply trees.

Messages with a parent make trees. Iterative self-joins, doubling the distance each time, list the path from each leaf
to its root; paths are ranked by score, and each path that is kept becomes one conversation. The template puts each
message between marks that no message can contain: the two characters that marks are made of are escaped, reversibly.

    <turn ROLE>\\nTEXT\\n</turn>\\n

Defined results: a null text or role is empty; a parent that is missing or does not come before its reply counts as
none, so every message has a root; equal scores are ranked by the leaf's place; rows of a conversation without a
reply structure are one path in order of turn, then role and text; a null conversation id is a conversation; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from .common import written

PAIR_ID = -7
PAIR_TEXT = "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    """Without < and with every backslash followed by b or l."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\g"), F.lit(">")))


def linear_tree(rows: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as trees of one branch: tree, node, parent, role, text, score."""
    order = Window.partitionBy("tree").orderBy(F.asc_nulls_last("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text"))
    numbered = rows.select(F.col("conv_id").alias("tree"), "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long") - 1)
    return numbered.select("tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def leaf_paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): for each leaf of messages (tree, node, parent), every node up to its root, up steps away."""
    spark = messages.sparkSession
    nodes = messages.select("tree", "node", "parent")
    ids = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    checked = nodes.join(ids, nodes["tree"].eqNullSafe(ids["t"]) & (nodes["parent"] == ids["p"]) & (nodes["parent"] < nodes["node"]), "left")
    nodes = written(checked.select("tree", "node", F.col("p").alias("parent")), "chat-nodes")
    parents = nodes.filter("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = nodes.join(parents, nodes["tree"].eqNullSafe(parents["t"]) & (nodes["node"] == parents["p"]), "left_anti")
    paths = written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")), "chat-paths")
    jump, distance = nodes.filter("parent is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("parent").alias("to")), 1
    while True:
        # Each path is known up to distance - 1 steps; a jump goes distance steps up.
        further = paths.join(jump, paths["tree"].eqNullSafe(jump["t"]) & (paths["node"] == jump["n"]))
        further = written(further.select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + distance).alias("up")), "chat-further")
        if further.isEmpty():
            return paths
        paths = paths.unionByName(further)
        second = jump.select(F.col("t").alias("t2"), F.col("n").alias("n2"), F.col("to").alias("to2"))
        jump = jump.join(second, jump["t"].eqNullSafe(second["t2"]) & (jump["to"] == second["n2"])).select("t", "n", F.col("to2").alias("to"))
        jump, distance = written(jump, "chat-jump"), distance * 2


def best_paths(messages: DataFrame, paths: DataFrame, most: int | None = None) -> DataFrame:
    """paths with role and text, and rank: the leaf's place among the tree's leaves by the mean score on its path."""
    m = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text", "score")
    full = paths.join(m, paths["tree"].eqNullSafe(m["t"]) & (paths["node"] == m["n"])).drop("t", "n")
    scores = full.groupBy("tree", "leaf").agg(F.avg("score").alias("s"))
    by_score = Window.partitionBy("tree").orderBy(F.desc("s"), "leaf")
    ranked = scores.withColumn("rank", F.row_number().over(by_score)).select(F.col("tree").alias("t"), F.col("leaf").alias("l"), "rank")
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)
    return full.join(ranked, full["tree"].eqNullSafe(ranked["t"]) & (full["leaf"] == ranked["l"])).drop("t", "l")


def format_paths(chosen: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row for each (tree, leaf): formatted, and loss, the spans (start, length in characters) of what is learned."""
    role, text = _escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    turn = F.struct((-F.col("up")).alias("at"), role.alias("role"), text.alias("text"), (F.coalesce("role", F.lit("")) == learn_from).alias("learn"))
    turns = chosen.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.first("rank").alias("rank"))
    head = lambda t: F.concat(F.lit("<turn "), t["role"], F.lit(">\n"))
    tail = "\n</turn>\n"
    parts = turns.withColumn("formatted", F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(tail))), ""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin, size = state["at"] + F.char_length(head(t)), F.char_length(t["text"])
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size + len(tail)).alias("at"), F.when(t["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return parts.select("tree", "leaf", "rank", "formatted", F.aggregate("turns", start, step)["spans"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with turns (role, text) and loss_text, both told from the formatted text and its spans alone."""
    pieces = F.filter(F.split("formatted", "<"), lambda p: p.startswith("turn "))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, ">", 1)
        n = F.char_length(role)
        body = F.substring(piece, n + 3, F.char_length(piece) - n - 3)  # without >\n before and \n after
        return F.struct(_unescape_role(F.substring(role, 6, 1 << 30)).alias("role"), unescape(body).alias("text"))

    spans = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_text", F.array_join(spans, ""))


def format_trees(messages: DataFrame, most: int | None = None) -> DataFrame:
    """messages (tree, node, parent, role, text, score) as formatted conversations, one for each path that is kept."""
    return format_paths(best_paths(messages, leaf_paths(messages), most))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    own = spark.createDataFrame([(PAIR_ID, 0, "user", PAIR_TEXT), (PAIR_ID, 1, "assistant", PAIR_TEXT)], "conv_id long, turn long, role string, text string")
    trees = written(linear_tree(rows.unionByName(own)), "chat-trees")
    out = read_back(format_trees(trees, 1))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(digest, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
