"""Chat formatting: reply trees, their best branches, and one formatted conversation for each.

Branches are enumerated by self-joins that double: after round i each message knows its ancestor
2^i above it, and each leaf all its ancestors up to that height, so a branch of n messages takes
about log2(n) rounds. Only numbers move; roles and texts join the chosen branches in the end.
Branches are ranked by the mean score of their messages.

A turn is written as a start mark, its role, a line feed, its text, an end mark and a line feed.
In texts a backslash goes between ``<`` and ``|``, and one more where there are some already, so
no text holds a mark and the change can be undone. Roles are percent-encoded.

Nulls: a null text or role is empty; a null score is 0. Messages with a null conversation id make
one conversation. A message whose parent is null or missing begins a tree. Of messages that share
an id, replies go to the first; each is a message of its own. Messages that lead back to
themselves have no beginning and are on no branch. Equal scores: the branch that ends first.
Other columns are not read; an empty table gives no conversations.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from grabqc.llm.common import keep

# Marks of the template. Fixed values.
START, END = "<|im_start|>", "<|im_end|>"


def escaped(text):
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text):
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def linear(rows, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """Rows by turn as messages that each reply to the one before."""
    own = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return own.withColumn("node_id", F.row_number().over(order)).select(
        "conv_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def _ancestors(parents, ends, most):
    """(leaf, node, up) for each leaf and each message of its branch."""
    paths = keep(ends.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "branches")
    step, height = parents, 1
    while height <= most and not step.isEmpty():
        above = paths.join(step, "node").select("leaf", F.col("above").alias("node"), (F.col("up") + height).alias("up"))
        paths = keep(paths.unionByName(above), "branches")
        step = keep(step.join(step.select(F.col("node").alias("above"), F.col("above").alias("higher")), "above").select("node", F.col("higher").alias("above")), "ancestors")
        height *= 2
    if height > most:  # these lead back to themselves
        paths = paths.join(step.select(F.col("node").alias("leaf")).distinct(), "leaf", "left_anti")
    return paths


def branches(messages, best=1):
    """Messages of the ``best`` branches of each conversation: conv_id, branch, place, role, text.

    ``messages`` has conv_id, node_id, parent_id, role, text, score.
    """
    rows = keep(messages.select("conv_id", "node_id", "parent_id", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"),
                                F.monotonically_increasing_id().alias("node")), "messages")
    named = rows.where("node_id IS NOT NULL").groupBy("conv_id", "node_id").agg(F.min("node").alias("above"))
    replies = rows.where("parent_id IS NOT NULL").select("node", F.col("conv_id").alias("c"), "parent_id")
    parents = keep(replies.join(named, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("parent_id") == F.col("node_id"))).select("node", "above"), "parents")
    ends = rows.join(parents.select(F.col("above").alias("node")).distinct(), "node", "left_anti")
    paths = _ancestors(parents, ends, rows.count())
    scored = (paths.join(rows.select("node", "score"), "node").groupBy("leaf").agg(F.avg("score").alias("score"))
              .join(rows.select(F.col("node").alias("leaf"), "conv_id", F.struct("conv_id", "node_id", "node").alias("place")), "leaf"))
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "place"))
    chosen = scored.withColumn("branch", rank).where(F.col("branch") <= best).select("leaf", "branch")
    return paths.join(chosen, "leaf").join(rows.select("node", "conv_id", "role", "text"), "node").select(
        "conv_id", "branch", "up", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def format_conversations(messages, best=1, learnt=("assistant",)):
    """One row for each chosen branch: conv_id, branch, formatted, loss_spans.

    A loss span is a turn's number and, in code points of that turn, where it starts and its length.
    """
    turns = branches(messages, best).groupBy("conv_id", "branch").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("place"), F.url_encode("role").alias("role"), F.col("role").isin(*learnt).alias("loss"),
                                             escaped(F.col("text")).alias("text")))).alias("turns"))
    written = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), "")
    spans = F.transform("turns", lambda t, i: F.struct(
        i.alias("turn"), (F.char_length(t["role"]) + len(START) + 1).alias("start"), F.char_length(t["text"]).alias("length"), t["loss"].alias("loss")))
    return turns.select("conv_id", "branch", written.alias("formatted"),
                        F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: s.dropFields("loss")).alias("loss_spans"))


def read_turns(formatted):
    """Array of (role, text) of a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        F.url_decode(F.substring_index(p, "\n", 1)).alias("role"),
        unescaped(F.regexp_replace(F.regexp_replace(p, r"\A[^\n]*\n", ""), r"<\|im_end\|>\n\z", "")).alias("text")))


def read_loss(formatted, spans):
    """Array of the texts under the loss mask."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    return F.transform(spans, lambda s: unescaped(F.substring(F.concat(F.lit(START), F.get(parts, s["turn"])), s["start"] + 1, s["length"])))


def digests(formatted):
    """What is read back from formatted conversations."""
    read = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
