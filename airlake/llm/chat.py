"""Chat conversations as training windows of bounded length.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside texts are escaped reversibly: a ``<``, any
backslashes and a ``|`` get one more backslash, so no text or role can hold ``<|``; a line break inside a role becomes ``<|nl|>``.

Windows are turn-aligned. With the running sum of turn tokens, a turn belongs to the cell ``floor(tokens before it / s)``,
``s`` being half of what the budget leaves after the system turn and the history. Turns of at most ``s`` tokens
in one cell never exceed ``2 s``; a longer turn always ends its cell and gets a window of its own. So every window keeps the budget,
except one whose single new turn alone is too long, which is marked. No turn is ever cut. Every later window opens
with the conversation's system turn and the newest earlier turns that fit the history; both are carried, and only
assistant texts that are new to a window are targets of the loss.

All in DataFrame functions with a single shuffle by conversation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
TOKENS = r"[\p{L}\p{N}]+|[^ \x09-\x0D\p{L}\p{N}]"
MARK_TOKENS = 4  # start, role, line break, end


@dataclass(frozen=True)
class Budget:
    tokens: int = 512
    history: int = 128


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(BREAK))


def chat_windows(turns: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row per window: conv_id, window (its order), first_turn, carried, new_turns, tokens, over_budget, formatted, loss_spans.

    ``loss_spans`` holds (start, length) in code points of ``formatted``. Rows (conv_id, turn, role, text) may come in any
    order; equal turn numbers are ordered by role and text, null numbers come first. Null roles and texts count as empty;
    rows with a null conv_id form one conversation. Repeated rows are repeated turns. An empty table has no windows. Other
    columns are ignored.
    """
    said = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("tokens", (F.regexp_count("text", F.lit(TOKENS)) + MARK_TOKENS).cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = said.withColumns(
        {
            "at": F.row_number().over(order),
            "ends": F.sum("tokens").over(so_far),
            "opening": F.first(F.when(F.col("role") == "system", F.struct("role", "text", "tokens"))).over(so_far),
        }
    )
    kept = F.coalesce(F.col("opening.tokens"), F.lit(0))
    half = F.greatest(F.lit(1), F.floor((budget.tokens - budget.history - kept) / 2))
    starts = F.col("ends") - F.col("tokens")
    # the system turn comes first anyway and is paid for by ``kept``: cells are measured behind it
    behind = F.greatest(F.lit(0), starts - kept)
    placed = placed.withColumns(
        {"starts": starts, "cell": F.floor(behind / half), "long": F.col("tokens") > half, "kept": kept}
    )
    # windows in order: a new one where the cell or the kind of turn changes
    previous = F.lag(F.struct("cell", "long")).over(order)
    opens = F.coalesce(previous != F.struct("cell", "long"), F.lit(True)) & ~(
        (F.lag("at").over(order) == 1) & F.lag(F.col("opening").isNotNull()).over(order)
    )
    placed = placed.withColumn("opens", F.coalesce(opens, F.lit(True)).cast("int"))
    placed = placed.withColumn("window", F.sum("opens").over(so_far) - 1)
    own = Window.partitionBy("conv_id", "window")
    whole = Window.partitionBy("conv_id")
    placed = placed.withColumns({"window_ends": F.max("ends").over(own), "last": F.max("window").over(whole)})
    is_opening = (F.col("at") == 1) & F.col("opening").isNotNull()
    recent = (
        (F.col("window") < F.col("last")) & (F.col("window_ends") - F.col("starts") <= budget.history) & ~is_opening
    )
    uses = F.filter(
        F.array(
            F.struct(F.col("window").alias("window"), F.lit(False).alias("carried")),
            F.when(recent, F.struct((F.col("window") + 1).alias("window"), F.lit(True).alias("carried"))),
        ),
        lambda x: x.isNotNull(),
    )
    rows = placed.select("conv_id", "at", "role", "text", "tokens", "opening", F.inline(uses))
    turn = F.struct("at", "carried", "role", "text", "tokens")
    windows = rows.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.max("opening").alias("opening")
    )
    with_system = F.when(
        F.col("opening").isNotNull() & (F.col("window") > 0),
        F.array_prepend(
            F.col("turns"),
            F.struct(
                F.lit(1).alias("at"), F.lit(True).alias("carried"), F.col("opening.role").alias("role"),
                F.col("opening.text").alias("text"), F.col("opening.tokens").alias("tokens"),
            ),
        ),
    ).otherwise(F.col("turns"))
    windows = windows.withColumn("turns", with_system)

    def pieces(t: Column) -> Column:
        return F.struct(
            F.concat(F.lit(START), _role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
            ((t["role"] == "assistant") & ~t["carried"]).alias("target"),
        )

    windows = windows.withColumn("pieces", F.transform("turns", pieces))
    foot = F.lit(END + "\n")

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["head"])
        span = F.struct(start.alias("start"), F.char_length(p["body"]).alias("length"))
        return F.struct(
            (start + F.char_length(p["body"]) + len(END) + 1).alias("at"),
            F.when(p["target"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    none = F.array().cast("array<struct<start:int,length:int>>")
    spans = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda acc: acc["spans"])
    carried = F.size(F.filter("turns", lambda t: t["carried"]))
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda acc, t: acc + t["tokens"])
    return windows.select(
        "conv_id", "window",
        F.get("turns", carried)["at"].alias("first_turn"),
        carried.alias("carried"), (F.size("turns") - carried).alias("new_turns"), total.alias("tokens"),
        (total > budget.tokens).alias("over_budget"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], foot)), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted window, unescaped."""
    shape = F.lit(r"(?s)<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n")
    roles, texts = F.regexp_extract_all(formatted, shape, F.lit(1)), F.regexp_extract_all(formatted, shape, F.lit(2))
    plain_role = lambda r: unescape(F.replace(r, F.lit(BREAK), F.lit("\n")))
    return F.zip_with(
        roles, texts, lambda r, t: F.struct(plain_role(r).alias("role"), unescape(t).alias("text"))
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation: its turns and its target texts in order, read from the formatted windows alone."""
    turns = read_turns(F.col("formatted"))
    targets = F.transform(
        "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
    )
    per_window = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.slice(turns, F.col("carried") + 1, F.greatest(F.col("new_turns"), F.lit(0))).alias("turns"),
            targets.alias("targets"),
            F.char_length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    sorted_windows = F.sort_array(F.collect_list("w"))
    return (
        per_window.groupBy("conv_id")
        .agg(sorted_windows.alias("w"))
        .select(
            "conv_id",
            F.flatten("w.turns").alias("turns"),
            F.flatten("w.targets").alias("targets"),
            F.aggregate("w", F.lit(0).cast("long"), lambda acc, w: acc + w["chars"]).alias("formatted_chars"),
        )
    )
