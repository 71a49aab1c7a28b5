"""Quotation linking: replies found by what they quote, and conversations in reply order.

Quoted lines are parsed by level.  The sentences of a level are normalised and hashed, and so
are the sentences of every message's own text; a quoted sentence leads to the latest earlier
message of the conversation that holds it.  A message answers the one that most of its least
nested quotes lead to, or else the one before it.  Conversations come out without quotes, each
message after the one it answers and before later answers to that (depth first).

Only column expressions are used.  Long conversations are counted in ranges, frequent
sentences in blocks of messages, so no task depends on the size of a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstride.llm.components import stored
from tabstride.operators.running import running_totals

# Messages whose quotes are looked up in one task at most.
BLOCK = 4096

_MARKS = r"^([ \t>]*>)"


def _level(line: Column) -> Column:
    """How deeply a line is quoted; 0 for a message's own line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def own_text(text: Column) -> Column:
    """The text without quoted lines and without the line that introduces a quote."""
    lines = F.split(F.coalesce(text, F.lit("")), "\r?\n", -1)

    def own(line: Column, i: Column) -> Column:
        introduces = line.rlike(r"wrote:\s*$") & (_level(F.coalesce(F.get(lines, i + 1), F.lit(""))) > 0)
        return (_level(line) == 0) & ~introduces

    return F.regexp_replace(F.array_join(F.filter(lines, own), "\n"), r"^\s+|\s+$", "")


def quoted_passages(text: Column) -> Column:
    """Array of ``level, text``: all lines of a level joined by blanks, least nested first."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\r?\n", -1), lambda x: _level(x) > 0)

    def passage(level: Column) -> Column:
        same = F.filter(lines, lambda x: _level(x) == level)
        bare = F.transform(same, lambda x: F.regexp_replace(x, _MARKS, ""))
        return F.struct(level.alias("level"), F.array_join(bare, " ").alias("text"))

    return F.transform(F.array_sort(F.array_distinct(F.transform(lines, _level))), passage)


def sentence_hashes(text: Column) -> Column:
    """Distinct hashes of the sentences, in lower case and with single blanks."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    sentences = F.filter(F.split(plain, r"(?<=[.!?])\s", -1), lambda s: s != "")
    return F.array_distinct(F.transform(sentences, lambda s: F.xxhash64(s)))


def _sources(messages: DataFrame) -> DataFrame:
    """``conv, pos, parent_pos``: the message that the quotes of a message lead to."""
    passages = messages.select("conv", "pos", F.explode(quoted_passages(F.col("text"))).alias("q"))
    quoted = stored(
        passages.select(
            "conv", "pos", F.col("q.level").alias("level"),
            F.explode(sentence_hashes(F.col("q.text"))).alias("h"),
        ),
        "quoted",
    )
    originals = messages.select("conv", "pos", F.explode(sentence_hashes(F.col("body"))).alias("h"))
    asked = quoted.select(F.col("conv").alias("_c"), F.col("h").alias("_h")).distinct()
    held = originals["conv"].eqNullSafe(asked["_c"]) & (originals["h"] == asked["_h"])
    originals = originals.join(asked, held, "left_semi")
    none = F.lit(None).cast("long")
    events = stored(
        quoted.select("conv", "h", "pos", "level", none.alias("source")).unionByName(
            originals.select("conv", "h", "pos", F.lit(None).cast("int").alias("level"), F.col("pos").alias("source"))
        ).withColumn("block", F.floor(F.col("pos") / BLOCK)),
        "quote_events",
    )
    earlier = Window.partitionBy("conv", "h", "block").orderBy("pos", F.col("source").isNotNull())
    within = events.withColumn(
        "near", F.last("source", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    )
    before = Window.partitionBy("conv", "h").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = events.groupBy("conv", "h", "block").agg(F.max("source").alias("top")).select(
        F.col("conv").alias("_c"), F.col("h").alias("_h"), F.col("block").alias("_b"),
        F.max("top").over(before).alias("far"),
    )
    found = (
        within.filter("source IS NULL")
        .join(blocks, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("h") == F.col("_h")) & (F.col("block") == F.col("_b")))
        .withColumn("parent", F.coalesce("near", "far")).filter("parent IS NOT NULL")
    )
    votes = found.groupBy("conv", "pos", "level", "parent").agg(F.count("*").alias("n"))
    best = F.max(F.struct(-F.col("level"), F.col("n"), F.col("parent")))
    return votes.groupBy("conv", "pos").agg(best["parent"].alias("parent_pos"))


def _offsets(runs: DataFrame) -> DataFrame:
    """``conv, run, offset``: messages before each run when the runs are read depth first.

    ``runs`` has ``conv, run, first, size, parent_run, parent_pos``.  The tour enters and leaves
    every run; what follows each step is summed by doubling the steps, in about log n rounds.
    """
    family = Window.partitionBy("conv", "parent_run").orderBy(F.desc("parent_pos"), "first")
    kin = runs.withColumn("sibling", F.lead("run").over(family))
    eldest = runs.filter("parent_run IS NOT NULL").groupBy("conv", "parent_run").agg(
        F.max(F.struct(F.col("parent_pos"), -F.col("first"), F.col("run")))["run"].alias("child")
    ).select(F.col("conv").alias("_c"), F.col("parent_run").alias("_p"), "child")
    kin = kin.join(eldest, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("run") == F.col("_p")), "left")
    enter, leave = F.col("run") * 2, F.col("run") * 2 + 1
    steps = kin.select(
        "conv", enter.alias("step"), F.col("size").alias("ahead"),
        F.coalesce(F.col("child") * 2, leave).alias("next"),
    ).unionByName(kin.select(
        "conv", leave.alias("step"), F.lit(0).cast("long").alias("ahead"),
        F.coalesce(F.col("sibling") * 2, F.col("parent_run") * 2 + 1).alias("next"),
    ))
    steps = stored(steps, "tour")
    while steps.filter("next IS NOT NULL").limit(1).count():
        then = steps.select(
            F.col("conv").alias("_c"), F.col("step").alias("_s"), F.col("ahead").alias("_a"), F.col("next").alias("_n")
        )
        same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("next") == F.col("_s"))
        steps = stored(steps.join(then, same, "left").select(
            "conv", "step", (F.col("ahead") + F.coalesce("_a", F.lit(0))).alias("ahead"), F.col("_n").alias("next")
        ), "tour")
    sizes = runs.groupBy("conv").agg(F.sum("size").alias("total")).withColumnRenamed("conv", "_c")
    return steps.filter("step % 2 = 0").join(sizes, F.col("conv").eqNullSafe(F.col("_c"))).select(
        "conv", F.expr("step div 2").alias("run"), (F.col("total") - F.col("ahead")).alias("offset")
    )


def link_replies(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per message the columns given, and how it stands in its conversation.

    Returns ``conv, turn, role, text`` (own text without quotes), ``reply_to`` (turn of the
    message answered, null for the first), ``by_quote`` (found by a quote), ``n_quotes`` (levels
    quoted) and ``reply_order`` (from 0, long).  Messages are ordered by turn, then role, then
    text, nulls first; rows that repeat a message as a whole are one message.  A null
    conversation id is an id like any other.  A null text is an empty one.
    """
    one = F.lit(1).cast("long")
    distinct = df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).distinct()
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    placed = running_totals(distinct.withColumn("one", one), order, ["one"], ["conv"]).select(
        "conv", "turn", "role", "text", F.col("cum_one").alias("pos")
    )
    messages = stored(placed.withColumn("body", own_text(F.col("text"))), "messages")
    sources = stored(_sources(messages), "quote_sources").select(
        F.col("conv").alias("_c"), F.col("pos").alias("_p"), "parent_pos"
    )
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("pos") == F.col("_p"))
    linked = messages.drop("text").join(sources, same, "left").select(
        "conv", "pos", "turn", "role", "body",
        F.col("parent_pos").isNotNull().alias("by_quote"),
        F.coalesce("parent_pos", F.when(F.col("pos") > 1, F.col("pos") - 1)).alias("parent_pos"),
    )
    # A run is a stretch of messages each of which answers the one before it.
    starts = F.when(F.col("parent_pos") == F.col("pos") - 1, 0).otherwise(1).cast("long")
    numbered = stored(
        running_totals(linked.withColumn("starts", starts), [F.col("pos").asc()], ["starts"], ["conv"])
        .withColumnRenamed("cum_starts", "run").drop("starts"),
        "replies",
    )
    answered = numbered.select(
        F.col("conv").alias("_c"), F.col("pos").alias("_p"), F.col("turn").alias("reply_to"), F.col("run").alias("_r")
    )
    runs = stored(
        numbered.groupBy("conv", "run").agg(
            F.min("pos").alias("first"), F.count("*").alias("size"),
            F.min_by("parent_pos", "pos").alias("parent_pos"),
        ).join(answered.drop("reply_to"), F.col("conv").eqNullSafe(F.col("_c")) & (F.col("parent_pos") == F.col("_p")), "left")
        .select("conv", "run", "first", "size", "parent_pos", F.col("_r").alias("parent_run")),
        "runs",
    )
    offsets = _offsets(runs).select(F.col("conv").alias("_oc"), F.col("run").alias("_or"), "offset")
    begin = runs.select(F.col("conv").alias("_bc"), F.col("run").alias("_br"), "first")
    quotes = messages.select(
        F.col("conv").alias("_mc"), F.col("pos").alias("_mp"),
        F.size(quoted_passages(F.col("text"))).cast("long").alias("n_quotes"),
    )
    eq = lambda c: F.col("conv").eqNullSafe(F.col(c))
    return (
        numbered.join(answered.drop("_r"), eq("_c") & (F.col("parent_pos") == F.col("_p")), "left")
        .join(begin, eq("_bc") & (F.col("run") == F.col("_br")))
        .join(offsets, eq("_oc") & (F.col("run") == F.col("_or")))
        .join(quotes, eq("_mc") & (F.col("pos") == F.col("_mp")))
        .select(
            F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
            F.col("body").alias(text_col), "reply_to", "by_quote", "n_quotes",
            (F.col("offset") + F.col("pos") - F.col("first")).alias("reply_order"),
        )
    )
