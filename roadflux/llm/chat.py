"""Quotation linking for conversations, in DataFrame operations only.

Lines that begin with ``>`` marks are quotations, the number of marks being
their level; neighbouring lines of one level form a passage.  Passages and their
lines are normalised (letters and digits in lower case) and hashed, and so are
every message's own lines and whole own text.  A reply's original is the
earliest message that has the passage: before it in the same conversation if
there is one, else the first anywhere.  The least level quoted decides, whole
passages before single lines.  Originals are reduced to one row per hash
before the join, so a passage that everybody quotes does not multiply rows.

Messages are then ordered by conversation, thread (the message that a chain of
replies starts from, found by pointer doubling) and turn; a reply always follows
its original.  A passage shorter than ``least_chars`` normalised characters is too
common to name a message elsewhere, so it is looked for in its own conversation only.

Defined cases: a null text reads as empty; conversations of any size are fine,
as nothing is gathered per conversation.  Messages without quotation, or whose
original is unknown, start threads of their own.  Repeated rows stay repeated.
Null conv_id or turn: never an original, never linked.  A passage without a letter
or digit links nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflux.storage import release

from .common import checkpointed, rekey

MARKS = r"^(?:[ \t]*>)+"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _lines(text: Column) -> Column:
    """array<struct<level, line>> of a text."""
    marks = lambda x: F.regexp_extract(x, MARKS, 0)
    return F.transform(
        F.split(text, "\n"),
        lambda x: F.struct((F.length(marks(x)) - F.length(F.replace(marks(x), F.lit(">"), F.lit("")))).alias("level"), F.regexp_replace(F.regexp_replace(x, MARKS, ""), "^ ", "").alias("line")),
    )


def parsed(messages: DataFrame) -> DataFrame:
    """messages(conv_id, turn, role, text) with reply, levels (deepest quotation) and passages array<struct<level, text>>.

    Passages are cut at the places where the level changes, so every line is copied once, however long the text.
    The lines of messages that quote are written first: an optimiser that inlined them
    into the lambdas below would split the text again for every line of it.
    """
    plain, quoting = _parted(messages)
    return plain.unionByName(quoting)


def _parted(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``parsed`` in two parts: the messages without a quotation, and those with one."""
    names, empty = ["conv_id", "turn", "role", "reply", "passages", "levels"], F.array().cast("array<struct<level: int, text: string>>")
    rows = messages.select("conv_id", "turn", "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    quoting = F.col("text").rlike(r"(?m)^[ \t]*>")
    plain = rows.where(~quoting).select("conv_id", "turn", "role", F.col("text").alias("reply"), empty.alias("passages"), F.lit(0).alias("levels"))
    lines = _lines(F.col("text"))
    out = checkpointed(rows.where(quoting).select("conv_id", "turn", "role", F.transform(lines, lambda x: x.level).alias("at_level"), F.transform(lines, lambda x: x.line).alias("line")))
    change = lambda i: (i == 1) | (F.element_at("at_level", i) != F.element_at("at_level", F.greatest(i - 1, F.lit(1))))
    out = out.withColumn("starts", F.filter(F.sequence(F.lit(1), F.size("line")), change))
    out = out.withColumn("ends", F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("line") + 1)))
    runs = F.transform(
        F.arrays_zip("starts", "ends"),
        lambda r: F.struct(F.element_at("at_level", r.starts).alias("level"), F.array_join(F.transform(F.sequence(r.starts, r.ends - 1), lambda i: F.element_at("line", i)), "\n").alias("text")),
    )
    own = F.array_join(F.filter("line", lambda x, i: F.element_at("at_level", i + 1) == 0), "\n")
    out = out.withColumns({"reply": F.regexp_replace(own, r"^\n+|\n+$", ""), "passages": F.filter(runs, lambda x: x.level > 0), "levels": F.array_max("at_level")})
    return plain, out.select(*names)


def _keys(text: Column, whole: Column) -> Column:
    """Normalised forms to match: the whole and each line, as struct<rank, form>."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(F.lit(1).alias("rank"), normal(x).alias("form")))
    return F.concat(F.array(F.struct(F.lit(0).alias("rank"), whole.alias("form"))), lines)


def linked(messages: DataFrame, least_chars: int = 8) -> DataFrame:
    """(conv_id, turn, role, reply, levels, n_quotes, parent_conv, parent_turn, thread_turn, depth), reply-ordered.

    messages is read for the quotations, for the originals and for the result; one that is costly to make should be materialised.
    """
    plain, quoting = _parted(messages)
    rows, both_known = plain.unionByName(quoting), "conv_id is not null and turn is not null"
    known = rows.where(both_known)
    form_ok = F.length("key.form") > 0
    quotes = quoting.where(both_known).select("conv_id", "turn", F.explode("passages").alias("p"))
    quotes = quotes.select("conv_id", "turn", "p.level", F.explode(_keys(F.col("p.text"), normal(F.col("p.text")))).alias("key")).where(form_ok)
    quotes = checkpointed(quotes.select("conv_id", "turn", "level", "key.rank", F.xxhash64("key.form").alias("hash"), F.length("key.form").alias("chars")).distinct())
    if quotes.isEmpty():
        return _ordered(_alone(rows))

    # only what is quoted somewhere is kept of the originals
    wanted = quotes.select("hash", "chars").distinct().select(rekey("hash"), "chars")
    index = known.select("conv_id", "turn", F.explode(_keys(F.col("reply"), normal(F.col("reply")))).alias("key")).where(form_ok)
    index = index.select("conv_id", "turn", F.xxhash64("key.form").alias("hash"), F.length("key.form").alias("chars")).join(wanted, ["hash", "chars"], "left_semi")
    index = checkpointed(index.groupBy("hash", "chars", "conv_id").agg(F.min("turn").alias("first")))
    # the two first conversations, as one of them may be the quoting one; the limit holds before the exchange too
    nth = F.row_number().over(Window.partitionBy("hash", "chars").orderBy("conv_id"))
    index, every = index.where(F.col("chars") >= least_chars), index
    ends = [f(F.struct("conv_id", "first")).alias(name) for f, name in ((F.min, "any"), (F.max, "next"))]
    anywhere = index.withColumn("nth", nth).where("nth <= 2").groupBy("hash", "chars").agg(*ends)
    same = quotes.join(every.select(rekey("hash"), "chars", "conv_id", "first"), ["hash", "chars", "conv_id"], "left")
    both = same.join(anywhere.select(rekey("hash"), "chars", "any", "next"), ["hash", "chars"], "left")
    here = F.col("first") < F.col("turn")
    both = both.withColumn("any", F.when(F.col("any.conv_id") != F.col("conv_id"), F.col("any")).otherwise(F.col("next")))
    elsewhere = (F.col("any.conv_id") != F.col("conv_id")) & (F.col("chars") >= least_chars)
    both = both.withColumn("to", F.when(here, F.struct(F.lit(0).alias("far"), F.col("conv_id").alias("c"), F.col("first").alias("t"))).when(elsewhere, F.struct(F.lit(1).alias("far"), F.col("any.conv_id").alias("c"), F.col("any.first").alias("t"))))
    best = both.where("to is not null").groupBy("conv_id", "turn").agg(F.min(F.struct("to.far", "level", "rank", "to.c", "to.t")).alias("b"))
    parents = checkpointed(best.select("conv_id", "turn", F.col("b.c").alias("parent_conv"), F.col("b.t").alias("parent_turn")))

    roots = threads(parents.where("parent_conv = conv_id").select("conv_id", "turn", "parent_turn"))
    facts = parents.join(roots, ["conv_id", "turn"], "left")
    # a message that quotes nothing has no link, unless it shares its turn with one that does; only then its text travels to the facts
    shared = checkpointed(facts.join(plain.select("conv_id", "turn"), ["conv_id", "turn"], "left_semi"))
    out = _alone(plain) if shared.isEmpty() else _with_facts(plain, shared)
    return _ordered(out.unionByName(_with_facts(quoting, facts)))


def _alone(rows: DataFrame) -> DataFrame:
    """rows as threads of their own."""
    blank = F.lit(None).cast("bigint")
    return rows.withColumns({"parent_conv": blank, "parent_turn": blank, "thread_turn": F.col("turn"), "depth": F.lit(0)})


def _with_facts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    return rows.join(facts, ["conv_id", "turn"], "left").withColumns({"thread_turn": F.coalesce("thread_turn", "turn"), "depth": F.coalesce("depth", F.lit(0))})


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn, depth) of replies by pointer doubling; parents are earlier turns, so no cycle."""
    state = checkpointed(parents.select("conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).alias("depth")))
    while True:
        far = state.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        step = state.drop("moved").join(far, ["conv_id", "up"], "left")
        before, state = state, checkpointed(step.select("conv_id", "turn", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")))
        release(before)
        if state.where("moved").isEmpty():
            return state.select("conv_id", "turn", F.col("up").alias("thread_turn"), "depth")


def _ordered(out: DataFrame) -> DataFrame:
    out = out.select("conv_id", "turn", "role", "reply", "levels", F.size("passages").alias("n_quotes"), "parent_conv", "parent_turn", "thread_turn", "depth")
    return out.orderBy("conv_id", "thread_turn", "turn", F.xxhash64("role", "reply"))
