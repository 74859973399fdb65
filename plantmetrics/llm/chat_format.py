"""Chat formatting in Spark expressions.

Turns of a conversation are put in order, adjacent turns of one role share one block, and the
blocks are concatenated::

    <|im_start|>role\\ntext<|im_sep|>next text of the same role<|im_end|>\\n

Control strings inside texts are escaped reversibly: a backslash is doubled and ``<|`` becomes
``<\\|``, so ``<|`` only ever stands in the template's own marks. ``loss`` lists the spans of
the formatted text (code points) that hold texts of the loss roles, and nothing else.

Defined cases: a null text or role is empty; rows of a null conversation form one
conversation; turns with one number are ordered by role, then text, and all stay; a newline in
a role becomes ``<|n|>``; an empty table gives an empty result; only the four columns named are read. One conversation is one row of the result, so
it is gathered in one task: that is the size of the string asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.common import chunks, let, running

START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|n|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def chat_format(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), conv: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, formatted, loss`` with loss: array<struct<start, size>> (start from 0)."""
    own = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                       F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    gathered = own.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    starts = F.expr("transform(turns, (t, i) -> i = 0 or t.role != turns[i - 1].role)")
    gathered = gathered.select("conv_id", "turns", starts.alias("opens"))

    def piece(t: Column, i: Column) -> Column:
        head = F.concat(F.lit(START), F.replace(escape(t["role"]), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"))
        last = (i + 1 == F.size("turns")) | F.coalesce(F.get("opens", i + 1), F.lit(False))
        return F.struct(F.when(F.get("opens", i), head).otherwise(SEP).alias("head"), escape(t["text"]).alias("body"),
                        F.when(last, END).otherwise("").alias("tail"), t["role"].isin(*loss_roles).alias("counts"))

    pieces = gathered.select("conv_id", F.transform("turns", piece).alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    spans = F.expr(running(
        "pieces", "length(x.head) + length(x.body) + length(x.tail)", "x.counts",
        "named_struct('start', {at} + length(x.head), 'size', cast(length(x.body) as bigint))", "struct<start: bigint, size: bigint>"))
    return pieces.select("conv_id", formatted.alias("formatted"), spans.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array<struct<role, text>>) parsed from the formatted text, ``loss_text``
    read under the loss mask, and ``formatted_chars``."""
    blocks = F.expr(f"slice(split(formatted, '\\\\Q{START}\\\\E', -1), 2, 1000000000)")
    own = formatted.select("conv_id", "formatted", "loss", blocks.alias("blocks"))

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substr(block, F.length(role) + 2, F.length(block) - F.length(role) - 1 - len(END))
        role = unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))
        return F.transform(F.split(body, r"\Q" + SEP + r"\E", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    # finding a code point walks the text, so spans are cut from slices of it
    stop = "element_at(c, -1).start + element_at(c, -1).size"
    near = let("__l", "loss", f"transform({chunks('__l')}, c -> named_struct('at', c[0].start, 'of', c, "
               f"'t', substr(formatted, cast(c[0].start + 1 as int), cast({stop} - c[0].start as int))))")
    parts = F.expr(f"flatten(transform({near}, c -> transform(c.of, s -> substr(c.t, cast(s.start - c.at + 1 as int), cast(s.size as int)))))")
    loss = F.array_join(F.transform(parts, unescape), "")
    return own.select("conv_id", F.flatten(F.transform("blocks", turns)).alias("turns"), loss.alias("loss_text"),
                      F.length("formatted").cast("long").alias("formatted_chars"))
