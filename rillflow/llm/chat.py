r"""Chat formatting into budgeted windows (DataFrame functions only).

A conversation becomes one or more windows of turns::

    ### role: text</turn>\n

* Prefix sums of turn tokens choose turn-aligned spans, and no turn is cut. Of the budget, the
  conversation's leading system turn and the history (``HISTORY_TOKENS``, or a quarter of what
  the system turn leaves, if that is less) are set aside; a span has the ``room`` that is left.
  A turn belongs to the half of a room that it begins in, and has a window of its own
  if it ends beyond that half's room; only the last turn of a half can. No fold over the
  conversation is needed.
* Each window holds the conversation's leading system turn, then up to
  ``HISTORY_TURNS`` turns before its span (as far as they fit into the history), then the
  span's turns. So it holds ``budget`` tokens at most, but for a turn that does not fit beside
  the system turn: that one has a window without history.
* The loss mask (``loss``: code-point ranges of the window's text) covers the
  assistant texts of the span. Repeated turns are masked: each assistant
  text is a target once.
* Control strings in a text or role are escaped: a backslash follows every ``\``,
  ``#`` and ``<`` (in a role also ``:``), so neither ``### `` nor ``</turn>`` can
  occur in an escaped text; ``unescape`` drops those backslashes.

Edge cases: a null text or role counts as empty; a null conversation id is a
conversation like any other; turns with an equal number are ordered by role, then
text (a null number comes first), and repeated rows are turns of their own; an empty
table gives an empty result; other columns of the input are ignored. A turn larger
than the room gets a window of its own, whole; a system turn that leaves no room is kept, and
each turn has a window with it. Windows are built by sorting, so a
conversation that holds a third of all turns is spilled, never gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: tokens of a window: the system turn, the history and new turns
BUDGET_TOKENS = 2048
HISTORY_TURNS, HISTORY_TOKENS = 2, 512

_SPECIAL = r"([\\#<])"
_SPECIAL_ROLE = r"([\\#<:])"
HEAD, SEP, END = "### ", ": ", "</turn>\n"
#: one turn of a window: role, text
_TURN = r"(?s)### ((?:[^:\\]|:\\|\\)*?): (.*?)</turn>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _SPECIAL, r"$1\\")


def escape_role(c: Column) -> Column:
    return F.regexp_replace(c, _SPECIAL_ROLE, r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _SPECIAL + r"\\", "$1")


def unescape_role(c: Column) -> Column:
    return F.regexp_replace(c, _SPECIAL_ROLE + r"\\", "$1")


def tokens(text: Column) -> Column:
    """Estimated tokens of a text: one for each four bytes, and the marks."""
    return F.ceil(F.octet_length(text) / 4).cast("bigint") + 4


def windows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text", budget: int = BUDGET_TOKENS,
            history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """(conv_id, window, text, n_repeated, loss): the windows of each conversation,
    by ``window``; ``n_repeated`` turns at the front repeat earlier ones."""
    t = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                     F.coalesce(role, F.lit("")).alias("role"),
                     F.coalesce(text, F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("nth", F.row_number().over(order)).withColumn("tok", tokens(F.col("text")))
    lead_system = (F.col("nth") == 1) & (F.lower("role") == "system")
    t = t.withColumn("lead", F.first(F.when(lead_system, F.col("tok")).otherwise(F.lit(0)))
                     .over(so_far)).withColumn("sum", F.sum("tok").over(so_far))
    left = F.greatest(F.lit(budget) - F.col("lead"), F.lit(0))
    t = t.withColumn("history", F.least(F.lit(history_tokens), F.floor(left / 4))) \
        .withColumn("room", left - F.col("history")) \
        .withColumn("half", F.greatest(F.floor(F.col("room") / 2), F.lit(1)))
    # tokens before the turn, beside the system turn's; that is no part of any room
    t = t.withColumn("at", F.greatest(F.col("sum") - F.col("tok") - F.col("lead"), F.lit(0)))
    part = F.floor(F.col("at") / F.col("half"))
    alone = ~lead_system & (F.col("at") + F.col("tok") > part * F.col("half") + F.col("room"))
    t = t.withColumn("span", part * 2 + alone.cast("bigint")) \
        .withColumn("large", F.col("tok") > F.col("room"))
    # the later spans that begin at one of the next turns, near enough in tokens
    nexts = [F.when((F.lead("span", k).over(order) != (
                        F.lead("span", k - 1).over(order) if k > 1 else F.col("span")))
                    & ~(F.lead("large", k).over(order))
                    & (F.lead("at", k).over(order) - F.col("at") <= F.col("history")),
                    F.lead("span", k).over(order)) for k in range(1, history_turns + 1)]
    later = F.array_compact(F.array(*nexts)) if nexts else F.array().cast("array<bigint>")
    t = t.withColumn("later", F.when(lead_system, F.array().cast("array<bigint>"))
                     .otherwise(later))
    span_starts = (F.col("nth") > 1) & (F.col("span") != F.lag("span", 1).over(order))
    system = F.first(F.when(lead_system, F.struct("role", "text"))).over(so_far)
    t = t.withColumn("system", F.when(span_starts, system))
    # kinds: 0 the system turn again, 1 history, 2 a turn of the span
    pieces = F.concat(
        F.when(F.col("system").isNotNull(), F.array(F.struct(
            F.col("span").alias("span"), F.lit(0).alias("kind"), F.lit(1).alias("nth"),
            F.col("system.role").alias("role"), F.col("system.text").alias("text"))))
        .otherwise(F.array().cast("array<struct<span:bigint,kind:int,nth:int,role:string,"
                                  "text:string>>")),
        F.transform("later", lambda s: F.struct(
            s.alias("span"), F.lit(1).alias("kind"), F.col("nth").alias("nth"),
            F.col("role").alias("role"), F.col("text").alias("text"))),
        F.array(F.struct(F.col("span").alias("span"), F.lit(2).alias("kind"),
                         F.col("nth").alias("nth"), F.col("role").alias("role"),
                         F.col("text").alias("text"))))
    parts = t.select("conv", F.inline(pieces))
    shown = parts.select("conv", "span", F.struct(
        "kind", "nth", F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(SEP)).alias("head"),
        escape(F.col("text")).alias("body"),
        ((F.col("kind") == 2) & (F.lower("role") == "assistant")).alias("target")).alias("p"))
    # a window's turns: bounded by the budget
    w = shown.groupBy("conv", "span").agg(F.array_sort(F.collect_list("p")).alias("p"))
    end = F.lit(END)

    def mask(acc, p):
        start = acc["at"] + F.length(p["head"])
        stop = start + F.length(p["body"])
        return F.struct(
            (stop + len(END)).alias("at"),
            F.when(p["target"], F.array_append(acc["out"], F.struct(
                start.alias("start"), stop.alias("end")))).otherwise(acc["out"]).alias("out"))

    none = F.struct(F.lit(0).alias("at"),
                    F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return w.select(
        F.col("conv").alias(conv), F.col("span").alias("window"),
        F.array_join(F.transform("p", lambda p: F.concat(p["head"], p["body"], end)), "")
        .alias("text"),
        F.size(F.filter("p", lambda p: p["kind"] < 2)).alias("n_repeated"),
        F.aggregate("p", none, mask, lambda acc: acc["out"]).alias("loss"))


def read_turns(text: Column, n_repeated: Column) -> Column:
    """The new turns of a window, read back from its text: array of (role, text)."""
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(_TURN), F.lit(1)).alias("role"),
                        F.regexp_extract_all(text, F.lit(_TURN), F.lit(2)).alias("text"))
    return F.transform(
        F.slice(both, n_repeated + 1, F.greatest(F.size(both), F.lit(1))),
        lambda t: F.struct(unescape_role(t["role"]).alias("role"),
                           unescape(t["text"]).alias("text")))


def read_loss(text: Column, loss: Column) -> Column:
    """The texts under a window's loss mask, unescaped."""
    return F.transform(loss, lambda s: unescape(
        F.substring(text, s["start"] + 1, s["end"] - s["start"])))
