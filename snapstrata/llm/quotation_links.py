"""Quotation linking: replies find the message they quote, and conversations come out in reply order.

Lines that begin with `>` are quoted, as often as they have that sign. A quoted passage is one such line; its
text, in lower case with white space made even, is hashed. The original of a passage is the first message of the
conversation that has it as a line of its own. A message's parent is the original of its least nested passage
that has one; of several, the latest. Conversations are trees of parents, read by root, depth and turn, in which
every message follows its parent; texts keep only their own lines.

All of it is DataFrame code. Originals are one row for each conversation and passage, so no passage is paired
with all its copies, and hot conversations are spread by passage or turn. Roots and depths come from pointer
doubling: as many joins as the depth has binary digits, of the messages that do not see their root yet, each stored
so that a lost executor costs one step.

Edge cases: null texts are empty; messages of null conversation or turn link to nothing; repeated rows of one
turn share its parent and each get a row; a passage quoted before it is written, or never written, links to
nothing; texts of quotes only come out empty; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import stored

MARKS = r"^(?:[ \t]?>)+[ \t]?"
KEY = ["conv_id", "turn"]


def _lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, passage (hash) of every line that is not blank."""
    rows = messages.select(*KEY, F.explode(F.split("text", r"\r?\n")).alias("line"))
    level = F.length(F.regexp_replace(F.regexp_extract("line", MARKS, 0), "[^>]", ""))
    even = F.lower(F.trim(F.regexp_replace(F.regexp_replace("line", MARKS, ""), r"\s+", " ")))
    return rows.select(*KEY, level.alias("level"), even.alias("even")).where("even <> ''").select(*KEY, "level", F.xxhash64("even", F.length("even")).alias("passage"))


def own_text(text: Column) -> Column:
    """The lines that are not quoted, without blank ones at either end."""
    kept = F.filter(F.split(text, r"\r?\n"), lambda x: ~x.rlike(MARKS))
    return F.regexp_replace(F.array_join(kept, "\n"), r"^\s+|\s+$", "")


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own_text, n_quotes (distinct passages), n_linked, parent_turn, root_turn, depth."""
    c = F.col
    messages = messages.select(*KEY, "role", F.coalesce("text", F.lit("")).alias("text"))
    lines = _lines(messages)
    first = lines.where("level = 0").groupBy("conv_id", "passage").agg(F.min("turn").alias("first"))
    quotes = lines.where("level > 0").groupBy(*KEY, "passage").agg(F.min("level").alias("level"))
    parents = (
        quotes.join(first, ["conv_id", "passage"], "left")
        .withColumn("first", F.when(c("first") < c("turn"), c("first")))
        .groupBy(*KEY)
        .agg(
            F.count("*").alias("n_quotes"), F.count("first").alias("n_linked"),
            F.min(F.when(c("first").isNotNull(), F.struct("level", -c("first")))).alias("best"),
        )
        .select(*KEY, "n_quotes", "n_linked", (-c("best.col2")).alias("parent_turn"))
    )
    nodes = messages.select(*KEY).where("conv_id is not null and turn is not null").distinct().join(parents, KEY, "left")
    nodes = stored(nodes, "parents")

    # Each step doubles how far a message sees; those that see their root are done and only looked up.
    sees = nodes.select(*KEY, F.coalesce("parent_turn", "turn").alias("root_turn"), c("parent_turn").isNotNull().cast("long").alias("depth"))
    steps = stored(sees.withColumn("done", c("depth") == 0), "steps")
    settled, going = steps.where("done"), steps.where("not done")
    while not going.isEmpty():
        far = settled.unionByName(going).select(
            "conv_id", c("turn").alias("root_turn"), c("root_turn").alias("further"), c("depth").alias("more"), c("done").alias("ends")
        )
        steps = stored(
            going.join(far, ["conv_id", "root_turn"])
            .select(*KEY, c("further").alias("root_turn"), (c("depth") + c("more")).alias("depth"), c("ends").alias("done")),
            "steps",
        )
        settled, going = settled.unionByName(steps.where("done")), steps.where("not done")
    steps = settled.drop("done")
    return (
        messages.join(nodes, KEY, "left").join(steps, KEY, "left")
        .select(
            *KEY, "role", own_text(c("text")).alias("own_text"),
            *(F.coalesce(x, F.lit(0)).alias(x) for x in ("n_quotes", "n_linked")),
            "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
        )
    )


def as_mail(messages: DataFrame) -> DataFrame:
    """Conversations as mail programs write them: a turn begins with the one it answers, quoted with the first
    line of what that one answers a level deeper. Each turn answers the one before, each fifth the one before that."""
    c = F.col
    messages = messages.select(*KEY, "role", F.coalesce("text", F.lit("")).alias("text"))
    answered = F.when(c("turn") % 5 == 4, c("turn") - 2).otherwise(c("turn") - 1)
    said = messages.groupBy(*KEY).agg(F.min("text").alias("said"))
    to = lambda name, n: said.select("conv_id", c("turn").alias(f"turn{n}"), c("said").alias(name))
    rows = messages.withColumn("turn1", answered).join(to("said1", 1), ["conv_id", "turn1"], "left")
    rows = rows.withColumn("turn2", F.when(c("turn1") % 5 == 4, c("turn1") - 2).otherwise(c("turn1") - 1)).join(to("said2", 2), ["conv_id", "turn2"], "left")
    quoted = lambda text, mark: F.regexp_replace(text, r"(?m)^", mark)
    return rows.select(
        *KEY, "role",
        F.concat_ws("\n", quoted(F.substring_index("said2", "\n", 1), ">> "), quoted(c("said1"), "> "), "text").alias("text"),
    )
