"""Chat formatting into windows of bounded length, in DataFrame functions only.

A conversation's turns are put into a template and counted; prefix sums of the counts cut the turns into spans, each
the new part of one window. Every window begins with the conversation's system turn, repeats the last turns before its
span as far as the history budget goes, and carries a loss mask: assistant texts of the span are targets, repeated ones
are not. Over all windows each turn is new once, and each assistant text a target once.

Long conversations are not gathered for that: prefix sums are taken inside blocks of turns and over the block totals.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmgrid.session import written

# The marks of the template.
OPEN, MIDDLE, CLOSE = "<|start|>", "<|text|>", "<|end|>\n"
#: tokens of a window, and how many of them the system turn aside may repeat earlier turns
BUDGET, HISTORY = 1024, 256
#: turns that are summed together
BLOCK = 256
#: turns before a span that may be repeated, if the history budget has room for them
HISTORY_TURNS = 4

# Escapes, in the order of escaping. Control strings begin with < or [ (such as <|end|>, </s>, [INST]),
# so that none is left in an escaped text.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))


def escaped(text: Column) -> Column:
    for plain, mark in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    for plain, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def token_estimate(formatted: Column) -> Column:
    """A turn's length in tokens: its UTF-8 bytes by four, rounded up. Never 0, as the marks are part of the turn."""
    return F.ceil(F.octet_length(formatted) / 4).cast("long")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, idx, role, text, cost, before)``: place in the conversation from 0 and tokens before the turn."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    formatted = F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE), escaped(text), F.lit(CLOSE))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    # turns without a number come last, in a block of their own
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(2**62)).cast("long")
    rows = rows.withColumn("block", block).withColumn("cost", token_estimate(formatted))
    totals = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("tokens"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("conv_id").alias("of"),
        F.col("block").alias("of_block"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    local = rows.withColumn("place", F.row_number().over(inside) - 1)
    local = local.withColumn("sum", F.sum("cost").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))
    return local.join(offsets, same).select(
        "conv_id",
        (F.col("n_before") + F.col("place")).alias("idx"),
        "role",
        "text",
        "cost",
        (F.col("tokens_before") + F.col("sum") - F.col("cost")).alias("before"),
    )


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_turns: int = HISTORY_TURNS) -> DataFrame:
    """``(conv_id, window, text, tokens, spans)`` from turns ``(conv_id, turn, role, text)``.

    ``spans`` is an array of ``(idx, role_at, role_chars, text_at, text_chars, repeated, loss)``: where in ``text``
    (characters from 1) the escaped role and text of each turn lie, whether the turn is repeated from an earlier
    window, and whether its text is under the loss mask.

    The new turns of a window end in the same stretch of ``stride`` tokens, half of what system turn and history leave
    of the budget; a turn longer than a stride is a span of its own. So a window keeps to the budget unless the
    system turn or a single turn alone is longer than its share; such turns are kept whole.

    The system turn is the first turn, if its role is ``system``. Null roles and texts are empty. Turns are ordered by
    number, then role and text; turns without a number come last. Null conversations are one conversation. Repeated
    rows are repeated turns. An empty table gives an empty result. Other columns are not looked at.
    """
    numbered = written(numbered_turns(turns), "chat-turns")
    first = numbered.where("idx = 0 AND role = 'system'").select(F.col("conv_id").alias("of"), F.col("cost").alias("system"))
    room = F.greatest(F.lit(budget) - history - F.coalesce("system", F.lit(0)), F.lit(2))
    stride = F.greatest(F.floor(room / 2), F.lit(1))
    joined = numbered.join(first, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    spanned = joined.select(
        *[F.col(c) for c in numbered.columns],
        F.col("system").isNotNull().alias("has_system"),
        F.floor((F.col("before") + F.col("cost") - F.coalesce("system", F.lit(0)) - 1) / stride).alias("stretch"),
        (F.col("cost") > stride).alias("alone"),
    )
    # the system turn opens the first window, so it belongs to the span of the turn after it
    new = spanned.where("idx > 0 OR NOT has_system")
    ends = new.groupBy("conv_id", "has_system", "stretch", "alone").agg(
        F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.min("before").alias("opens")
    )
    only_system = spanned.groupBy("conv_id").agg(F.max("idx").alias("last"), F.max("has_system").alias("s")).where("last = 0 AND s")
    ends = ends.unionByName(
        only_system.select(
            "conv_id", F.lit(True).alias("has_system"), F.lit(0).cast("long").alias("stretch"), F.lit(False).alias("alone"),
            F.lit(1).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("opens"),
        )
    )
    start = F.when(F.col("has_system"), 1).otherwise(0)
    from_ = F.greatest(F.col("lo") - history_turns, start.cast("long"))
    wanted = F.when(F.col("hi") >= from_, F.sequence(from_, F.greatest("hi", from_))).otherwise(F.array().cast("array<long>"))
    wanted = F.concat(F.when(F.col("has_system"), F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>")), wanted)
    placed = ends.select(F.col("conv_id").alias("of"), F.col("lo").alias("window"), "lo", "opens", "has_system", F.explode(wanted).alias("of_idx"))
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("idx") == F.col("of_idx"))
    is_system = F.col("has_system") & (F.col("idx") == 0)
    is_new = (F.col("idx") >= F.col("lo")) | (is_system & (F.col("lo") == 1))
    in_history = F.col("before") >= F.col("opens") - history
    members = numbered.join(placed, same).where(is_system | is_new | in_history)
    turn = F.struct(
        "idx",
        escaped(F.col("role")).alias("role"),
        escaped(F.col("text")).alias("text"),
        "cost",
        (~is_new).alias("repeated"),
        (is_new & (F.col("role") == "assistant")).alias("loss"),
    )
    gathered = members.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return _laid_out(gathered)


def _laid_out(gathered: DataFrame) -> DataFrame:
    """The text of every window and where its turns lie in it."""
    text = F.array_join(
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), ""
    )
    marks = len(OPEN) + len(MIDDLE) + len(CLOSE)
    nothing = F.array().cast(
        "array<struct<idx:bigint,role_at:int,role_chars:int,text_at:int,text_chars:int,repeated:boolean,loss:boolean>>"
    )
    start = F.struct(F.lit(1).alias("at"), nothing.alias("spans"))

    def add(state: Column, t: Column) -> Column:
        role_at = state["at"] + len(OPEN)
        text_at = role_at + F.length(t["role"]) + len(MIDDLE)
        span = F.struct(
            t["idx"].alias("idx"), role_at.alias("role_at"), F.length(t["role"]).alias("role_chars"), text_at.alias("text_at"),
            F.length(t["text"]).alias("text_chars"), t["repeated"].alias("repeated"), t["loss"].alias("loss"),
        )
        at = state["at"] + marks + F.length(t["role"]) + F.length(t["text"])
        return F.struct(at.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    tokens = F.aggregate("turns", F.lit(0).cast("long"), lambda total, t: total + t["cost"])
    spans = F.aggregate("turns", start, add, lambda state: state["spans"])
    return gathered.select("conv_id", "window", text.alias("text"), tokens.alias("tokens"), spans.alias("spans"))


def written_windows(turns: DataFrame, **options) -> DataFrame:
    """The windows as a finished table, read back."""
    return written(windows(turns, **options), "chat-windows")


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, idx, role, text, loss)``: the turns, each once, cut out of the windows' texts and unescaped."""
    each = formatted.select("conv_id", "text", F.explode(F.filter("spans", lambda s: ~s["repeated"])).alias("s"))
    return each.select(
        "conv_id",
        F.col("s.idx").alias("idx"),
        unescaped(F.substr("text", F.col("s.role_at"), F.col("s.role_chars"))).alias("role"),
        unescaped(F.substr("text", F.col("s.text_at"), F.col("s.text_chars"))).alias("text"),
        F.col("s.loss").alias("loss"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` of each conversation, from its windows.

    A digest runs over a whole conversation, so this one step has each conversation's texts in one row.
    """
    turns = read_back(formatted)
    row = F.struct("idx", "role", "text", "loss")
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    sizes = formatted.groupBy(F.col("conv_id").alias("of")).agg(F.sum(F.length("text")).cast("long").alias("formatted_chars"))
    found = whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
    )
    return found.join(sizes, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def turn_rows(spark, rows: Iterable[tuple[int, int, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), "conv_id long, turn long, role string, text string")
