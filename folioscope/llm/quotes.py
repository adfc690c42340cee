"""Quotation linking: conversations in reply order, without the quotes.

Only DataFrame functions: quote levels are read with regular expressions, normalised quoted
passages are hashed and joined to the messages that first wrote them, and reply chains are
followed by doubling.  A passage is a line, as in mail without hard line breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.operators.ordering import number_rows

# Marks in front of a quoted line, with at most a blank before each.
_MARKS = r"^(?: ?>)+"
_QUOTED_LINE = r"(?m)^ ?>[^\n]*(?:\n|\z)"
# The line that announces a quote.
_ANNOUNCED = r"(?m)^On [^\n]{1,300} wrote:[ \t]*\n(?= ?>)"
_AROUND = r"\A[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+\z"
_WITHIN = r"[ \t\n\x0B\f\r]+"


def unquoted(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them; ends are trimmed."""
    bare = F.regexp_replace(F.regexp_replace(text, _ANNOUNCED, ""), _QUOTED_LINE, "")
    return F.regexp_replace(bare, _AROUND, "")


def normalised(line: Column) -> Column:
    """Lower case, single blanks, nothing around."""
    return F.trim(F.regexp_replace(F.lower(line), _WITHIN, " "))


def message_lines(messages: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``level`` (0: own words) and ``passage``, the hash of the line."""
    lines = messages.select(
        "conv", "turn", F.explode(F.split("text", "\n", -1)).alias("line")
    ).withColumn("marks", F.regexp_extract("line", _MARKS, 0))
    level = F.length(F.replace("marks", F.lit(" "), F.lit("")))
    body = normalised(F.expr("substring(line, length(marks) + 1)"))
    return (
        lines.select("conv", "turn", level.alias("level"), body.alias("body"))
        .where("body <> ''")
        .select("conv", "turn", "level", F.xxhash64("body").alias("passage"))
    )


def quote_links(lines: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``level``, ``origin`` and ``n``: quoted lines by who wrote them.

    The origin of a passage is the first turn of the conversation that has it in its own
    words, if that is an earlier one.  A passage that a message or many messages repeat is
    one row per task before it is shuffled.
    """
    written = lines.where("level = 0").groupBy("conv", "passage").agg(F.min("turn").alias("origin"))
    quoted = lines.where("level > 0").groupBy("conv", "turn", "level", "passage")
    counted = quoted.agg(F.count(F.lit(1)).alias("times"))
    return (
        counted.join(written, ["conv", "passage"])
        .where("origin < turn")
        .groupBy("conv", "turn", "level", "origin")
        .agg(F.sum("times").alias("n"))
    )


def reply_chains(parents: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``root`` and ``depth`` of the messages that have a parent.

    ``parents`` has ``conv``, ``turn`` and ``parent``, an earlier turn.  Each round doubles
    the length of the paths that have not reached a root, so there are as many rounds as the
    largest depth has binary digits, and paths that are complete are only looked up.  Every
    round is stored.
    """
    columns = ["conv", "turn", "root", "depth"]
    paths = parents.select(
        "conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("bigint").alias("depth")
    )
    growing = workspace.materialize(paths, "paths")
    done = growing.where("false")
    while True:
        upper = growing.unionByName(done).select(
            "conv", F.col("turn").alias("root"), F.col("root").alias("top"),
            F.col("depth").alias("more"),
        )
        longer = growing.join(upper, ["conv", "root"], "left").select(
            "conv",
            "turn",
            F.coalesce("top", "root").alias("root"),
            F.expr("depth + coalesce(more, 0)").alias("depth"),
            F.expr("top IS NOT NULL").alias("grew"),
        )
        longer = workspace.materialize(longer, "paths")
        done = done.unionByName(longer.where("NOT grew").select(*columns))
        growing = longer.where("grew").select(*columns)
        if not growing.limit(1).count():
            return done


def link_quotations(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per message: whom it answers, where it stands, and its text without quotes.

    ``reply_to`` is the turn that wrote most of the lines quoted at the first level (the
    later one of equals), ``root`` the first turn of its chain of replies and ``depth`` its
    distance from there; ``n_quoted`` and ``n_linked`` count the distinct quoted passages by
    turn and level, and those whose origin was found.  ``position`` numbers a conversation's
    messages from 0 by root and turn, so every message follows the one that it answers.

    A null text has no lines and stays null.  Rows with a null conversation or turn are
    linked to nothing.  Rows that share conversation and turn share their links and stand
    next to each other.  An empty table gives an empty result; other columns are ignored.
    """
    chosen = messages.select(
        messages[conv].alias("conv"),
        messages[turn].cast("bigint").alias("turn"),
        messages[role].alias("role"),
        messages[text].alias("text"),
    )
    lines = message_lines(chosen)
    links = workspace.materialize(quote_links(lines), "quotes")
    nearest = F.max_by("origin", F.struct("n", "origin"))
    parents = links.where("level = 1").groupBy("conv", "turn").agg(nearest.alias("parent"))
    parents = workspace.materialize(parents, "parents")
    chains = reply_chains(parents)
    quoted = (
        lines.where("level > 0").groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n_quoted"))
    )
    linked = links.groupBy("conv", "turn").agg(F.sum("n").alias("n_linked"))
    at = ["conv", "turn"]
    known = (
        chosen.join(parents, at, "left")
        .join(chains, at, "left")
        .join(quoted, at, "left")
        .join(linked, at, "left")
        .select(
            "conv",
            "turn",
            "role",
            unquoted(F.col("text")).alias("text"),
            F.col("parent").alias("reply_to"),
            F.coalesce("root", "turn").alias("root"),
            F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
            F.coalesce("n_quoted", F.lit(0)).cast("bigint").alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        )
    )
    numbered = workspace.materialize(
        number_rows(known, ["conv", "root", "turn", "role", "text"], "at"), "numbered"
    )
    first = numbered.groupBy("conv").agg(F.min("at").alias("first"))
    first = first.withColumnRenamed("conv", "of")
    return numbered.join(first, numbered["conv"].eqNullSafe(first["of"])).select(
        F.col("conv").alias(conv),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        F.col("text").alias(text),
        "reply_to",
        "root",
        "depth",
        "n_quoted",
        "n_linked",
        F.expr("at - first").alias("position"),
    )


def as_mail(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The messages as mail: each quotes the turn before it, and that turn's first line of
    the one before under two marks.  A turn that stands twice is quoted by its smaller text.

    A null text stays null, and a turn behind it quotes nothing.  Rows without a conversation
    or a turn quote nothing.  Other columns are left out; an empty table gives an empty one.
    """
    rows = messages.select(conv, turn, role, text)
    one = rows.groupBy(conv, turn).agg(F.min(text).alias("said"), F.min(role).alias("by"))
    before = one.select(conv, (F.col(turn) + 1).alias(turn), F.col("said"), "by")
    earlier = one.select(
        conv,
        (F.col(turn) + 2).alias(turn),
        F.substring_index("said", "\n", 1).alias("opening"),
    )
    quote = F.concat(
        F.lit("On turn "), F.col(turn) - 1, F.lit(", "), F.col("by"), F.lit(" wrote:\n"),
        F.coalesce(F.concat(F.lit(">> "), F.col("opening"), F.lit("\n")), F.lit("")),
        F.lit("> "), F.replace("said", F.lit("\n"), F.lit("\n> ")), F.lit("\n"),
    )
    joined = rows.join(before, [conv, turn], "left").join(earlier, [conv, turn], "left")
    mail = F.concat(F.coalesce(quote, F.lit("")), F.col(text))
    return joined.select(conv, turn, role, mail.alias(text))
