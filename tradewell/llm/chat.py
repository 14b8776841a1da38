"""Chat formatting of reply trees.

Messages form trees by their parents. Iterative self-joins double the distance that every message sees
upwards, so paths of any length take a logarithmic number of joins; each step carries the sum of the
scores passed. A message that has reached its root takes no part in later joins but as a target inside
its own tree, so short trees cost nothing while a long one goes on. Leaves are ranked by the mean score of their path, the best ones of each tree are
chosen, and the same jumps taken from far to near enumerate the messages of each chosen path. A path
becomes one text.

Template: ``<|role|>R<|text|>T<|end|>`` for each turn. Control strings inside R or T (the template's
and the usual ones of other templates) get a backslash after their first character, and one more if
they already have some, so the text is read back exactly.

Defined cases: null role or text count as empty; a missing parent makes a root; messages on a cycle
have no root and lie on no path; of rows with one id the first by score, role and text stays; equal
path scores go to the longer path, then to the smaller id; other columns are ignored. A conversation
of plain rows is the tree of its rows by turn, then role and text, each replying to the one before; a
null conversation id is a conversation of its own. The turns of one conversation meet in one task, as
its text is one value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewell.session import materialise

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
_CONTROL = r"\||/?s>|/?SYS>|</?SYS>>|/?INST\]"
_ESCAPE = rf"([<\[])(\\*)({_CONTROL})"
_ESCAPED = rf"([<\[])\\(\\*)({_CONTROL})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def messages_of(conversations: DataFrame) -> DataFrame:
    """tree, id, parent, score, role, text, conv_id: each row answers the row before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("id", F.row_number().over(order).cast("bigint"))
            .select(F.to_json(F.struct("conv_id")).alias("tree"), "id",
                    F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
                    F.lit(1.0).alias("score"), "role", "text", "conv_id"))


def best_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """tree, leaf, place (leaf 0, its parent 1, ...), id for the best ``per_tree`` paths of each tree."""
    first = Window.partitionBy("tree", "id").orderBy(F.desc("score"), "role", "text", "parent")
    nodes = (messages.withColumn("_n", F.row_number().over(first)).where("_n = 1")
             .select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    known = nodes.select("tree", F.col("id").alias("parent"), F.lit(True).alias("known"))
    first = materialise(nodes.join(known, ["tree", "parent"], "left")
                        .select("tree", "id", F.when(F.col("known"), F.col("parent")).alias("up"), "score",
                                F.lit(1).cast("bigint").alias("length")), "reply-jumps")
    jumps, settled = [first.where("up IS NOT NULL")], [first.where("up IS NULL")]
    count = nodes.count()
    while jumps[-1].limit(1).count() and 2 ** (len(jumps) - 1) <= count:
        here = jumps[-1]
        near = _union(settled).join(here.select("tree").distinct(), "tree", "left_semi")
        there = here.unionByName(near).select("tree", F.col("id").alias("up"), F.col("up").alias("next"),
                                              F.col("score").alias("more"), F.col("length").alias("further"))
        step = materialise(here.join(there, ["tree", "up"]).select(
            "tree", "id", F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score"),
            (F.col("length") + F.col("further")).alias("length")), "reply-jumps")
        jumps.append(step.where("up IS NOT NULL"))
        settled.append(step.where("up IS NULL"))
    parents = jumps[0].select("tree", F.col("up").alias("id")).distinct()
    rank = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("length")), F.desc("length"), "id")
    chosen = (_union(settled).join(parents, ["tree", "id"], "left_anti")
              .withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= per_tree)
              .select("tree", F.col("id").alias("leaf"), F.lit(0).cast("bigint").alias("place"), "id"))
    paths = [materialise(chosen, "reply-paths")]
    for k in range(len(jumps) - 2, -1, -1):  # what the last jumps hold, if anything, lies on or below a cycle
        paths.append(materialise(_union(paths).join(jumps[k], ["tree", "id"]).select(
            "tree", "leaf", (F.col("place") + 2 ** k).alias("place"), F.col("up").alias("id")), "reply-paths"))
    return _union(paths)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def format_paths(messages: DataFrame, paths: DataFrame, loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """tree, leaf, formatted, loss (stretches of the formatted text, begin and length in code points)."""
    first = Window.partitionBy("tree", "id").orderBy(F.desc("score"), "role", "text", "parent")
    said = (messages.withColumn("_n", F.row_number().over(first)).where("_n = 1")
            .select("tree", "id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    turns = (paths.join(said, ["tree", "id"])
             .withColumn("head", F.concat(F.lit(ROLE), escape(F.col("role")), F.lit(TEXT)))
             .withColumn("body", escape(F.col("text")))
             .withColumn("piece", F.concat("head", "body", F.lit(END))))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    turn = F.struct(F.col("at"), F.col("piece"), F.col("role").isin(*loss_roles).alias("trained"),
                    (F.col("at") + F.length("head")).alias("begin"), F.length("body").cast("bigint").alias("length"))
    whole = turns.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "tree", "leaf", F.concat_ws("", F.col("turns.piece")).alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: F.struct(t["begin"], t["length"])).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds the turns (role, text) that the formatted text holds, and the text under the loss mask."""
    pieces = F.split("formatted", r"<\|end\|>")
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescape(F.regexp_extract(p, r"(?s)^<\|role\|>(.*?)<\|text\|>", 1)).alias("role"),
        unescape(F.regexp_extract(p, r"(?s)<\|text\|>(.*)$", 1)).alias("text")))
    trained = F.transform("loss", lambda s: unescape(
        F.col("formatted").substr((s["begin"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumns({"turns": turns, "trained": F.concat_ws("", trained)})


def format_conversations(conversations: DataFrame, loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss: every conversation as one text."""
    messages = messages_of(conversations)
    names = messages.where("id = 1").select("tree", "conv_id")
    return format_paths(messages, best_paths(messages), loss_roles).join(names, "tree").select("conv_id", "formatted", "loss")


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted texts hold, as hashes."""
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
