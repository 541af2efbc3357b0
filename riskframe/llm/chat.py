"""Chat formatting by prefix-target expansion.

A conversation's turns are put in order and written with marks; every assistant turn becomes an
example of its own, with all preceding turns as context and only its reply under the loss mask. If
turns follow the last reply, a last row without mask holds the whole conversation, so that no turn is
lost. Control strings inside roles and texts are broken by a backslash (and backslashes doubled), which
is undone exactly.

Rows are grouped by conversation once; a context is a slice of the conversation's written turns, so
that texts are not joined with themselves. The output is quadratic in the turns of a conversation by
its nature; nothing else is.

Defined results: null roles and texts are empty; turns are ordered by turn (null first), role and text,
so ties and repeated rows have a fixed order; rows without conversation identifier form one
conversation; an empty table gives an empty table; extra columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of a turn, and further strings that chat templates treat as control.
START, BETWEEN, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, BETWEEN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

ASSISTANT = "assistant"


def _quoted(text: str) -> str:
    return "".join(f"\\{c}" if c in "\\[]|.*+?(){}^$" else c for c in text)


_BREAK = "([<\\[])(?=" + "|".join(_quoted(c[1:]) for c in CONTROL) + ")"


def escape(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, "\\\\", "\\\\\\\\"), _BREAK, "$1\\\\")


def unescape(col: Column) -> Column:
    return F.regexp_replace(col, "(?s)\\\\(.)", "$1")


def _empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def examples(conversations: DataFrame) -> DataFrame:
    """One row per assistant turn: ``conv_id``, ``example`` of ``examples``, ``formatted``, mask.

    ``mask_start`` and ``mask_end`` delimit the trainable reply in code points of ``formatted``; both are
    null in a last row that only holds turns after the last reply.
    """
    turns = conversations.select(
        "conv_id", F.struct("turn", _empty("role").alias("role"), _empty("text").alias("text")).alias("t")
    )
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    written = ordered.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.concat(
                F.lit(START), escape(t["role"]), F.lit(BETWEEN), escape(t["text"]), F.lit(END)
            ),
        ).alias("parts"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("lengths"),
        F.filter(
            F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i + 1)), lambda i: i.isNotNull()
        ).alias("replies"),
    )
    n = F.size("parts")
    rest = F.size("replies") == 0
    rest = rest | (F.element_at("replies", -1) < n)
    cut = written.withColumn(
        "cuts",
        F.concat(
            F.transform("replies", lambda i: F.struct(i.alias("upto"), F.lit(True).alias("reply"))),
            F.when(rest, F.array(F.struct(n.alias("upto"), F.lit(False).alias("reply")))).otherwise(
                F.expr("array()").cast("array<struct<upto:int,reply:boolean>>")
            ),
        ),
    )
    each = cut.select(
        "conv_id", "parts", "lengths", F.size("cuts").alias("examples"), F.posexplode("cuts").alias("at", "cut")
    )
    formatted = F.array_join(F.slice("parts", F.lit(1), F.col("cut.upto")), "")
    end = F.length("formatted") - len(END)
    start = end - F.element_at("lengths", F.col("cut.upto"))
    return each.withColumn("formatted", formatted).select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        "examples",
        "formatted",
        F.when(F.col("cut.reply"), start).alias("mask_start"),
        F.when(F.col("cut.reply"), end).alias("mask_end"),
    )


def parsed_turns(formatted: Column) -> Column:
    """The turns (role, text) written in a formatted text."""
    pieces = F.filter(F.split(formatted, _quoted(END)), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.element_at(F.split(F.substr(p, F.lit(len(START) + 1)), _quoted(BETWEEN)), 1)).alias("role"),
            unescape(F.element_at(F.split(F.substr(p, F.lit(len(START) + 1)), _quoted(BETWEEN)), 2)).alias("text"),
        ),
    )


def digest(expanded: DataFrame) -> DataFrame:
    """Per conversation, what its examples say: turns, trainable text, formatted length."""
    masked = unescape(
        F.substring("formatted", F.col("mask_start") + 1, F.col("mask_end") - F.col("mask_start"))
    )
    small = expanded.select(
        "conv_id",
        "example",
        F.when(F.col("example") == F.col("examples"), F.col("formatted")).alias("whole"),
        F.length("formatted").cast("long").alias("chars"),
        masked.alias("reply"),
    )
    grouped = small.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("example", "reply"))).alias("replies"),
    )
    turns = parsed_turns(F.col("whole"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("replies", lambda r: F.coalesce(r["reply"], F.lit(""))), "")
    return grouped.withColumn("turns", turns).withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
