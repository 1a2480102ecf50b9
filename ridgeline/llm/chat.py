"""Chat formatting in budgeted windows, and reading the formatted text back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ridgeline.llm.common import text_or_empty

START, END = "<|im_start|>", "<|im_end|>\n"
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def escape(text: Column) -> Column:
    """No control string is left: each backslash is doubled, and one stands between < and |."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tokens(text: Column) -> Column:
    """Words, numbers and marks, and four for the marks of a turn."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long") + 4


def windows(turns: DataFrame, budget: int = 1024, history: int = 256, conv: str = "conv_id", turn: str = "turn",
            role: str = "role", text: str = "text") -> DataFrame:
    """One row per window: conv_id, window, repeated, roles, formatted, loss.

    The running sum of turn tokens chooses the windows: cells of ``budget - history`` tokens,
    a turn that crosses a cell's end being a window of its own. So new turns of a window stay
    within that many tokens unless a single turn is longer, and no turn is ever cut. A system
    turn at the start is set before every window, and before the new turns come as many of
    the last earlier turns as ``history`` tokens hold. ``repeated`` counts the turns that
    earlier windows already hold; ``loss`` lists (start, length), in characters from 0, of the
    new assistant texts. Repeated assistant turns are not in it, so each is learned once.

    Roles are written URL-encoded, texts escaped, so the marks cannot occur in either. Null text
    and null role count as empty. Turns with the same number go by role, then text; null numbers
    come first; repeated rows are turns of their own. Rows with a null conv_id form one
    conversation. Other columns are not read. An empty table gives no window.
    """
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                     text_or_empty(role).alias("role"), text_or_empty(text).alias("text"))
    order = [F.col("turn"), F.col("role"), F.col("text")]
    by_turn = W.partitionBy("conv_id").orderBy(*order)
    piece = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"), escape(F.col("text")), F.lit(END))
    t = (t.withColumn("nth", F.row_number().over(by_turn))
         .withColumn("system", (F.col("nth") == 1) & (F.col("role") == "system"))
         .withColumn("piece", piece)
         .withColumn("n", F.when(F.col("system"), 0).otherwise(tokens(F.col("text")))))

    # From here on, order is the running sum: n is at least 4 for all but the system turn.
    by_nth = W.partitionBy("conv_id").orderBy("nth")
    cell = max(budget - history, 1)
    t = t.withColumn("before", F.sum("n").over(by_nth.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n"))
    t = t.withColumn("at", F.floor(F.col("before") / cell)).withColumn(
        "crosses", (F.col("n") > 0) & (F.floor((F.col("before") + F.col("n") - 1) / cell) > F.col("at")))
    t = t.withColumn("same", F.lag(F.struct("at", "crosses")).over(by_nth) == F.struct("at", "crosses"))
    # The system turn opens the first window together with the first turn.
    after_system = F.coalesce(F.lag("system").over(by_nth), F.lit(False))
    t = t.withColumn("opens", F.coalesce(~F.col("same") & ~after_system, F.col("nth") == 1))
    t = t.withColumn("window", F.sum(F.col("opens").cast("long")).over(
        by_nth.rowsBetween(W.unboundedPreceding, W.currentRow)) - 1)
    # Without history the frame is one that no turn is in.
    past = W.partitionBy("conv_id").orderBy("before").rangeBetween(-max(history, 1), -1)
    held = F.collect_list(F.when(~F.col("system") & F.lit(history > 0), F.struct("nth", "piece"))).over(past)
    first = F.max(F.when(F.col("system"), F.struct("nth", "piece"))).over(W.partitionBy("conv_id"))
    t = t.withColumn("lead", F.when(F.col("opens") & (F.col("window") > 0), F.concat(
        F.array_compact(F.array(first)), held)))

    fresh = F.sort_array(F.collect_list(F.struct("nth", "piece", "role", "text")))
    w = t.groupBy("conv_id", "window").agg(
        fresh.alias("fresh"), F.coalesce(F.first("lead", ignorenulls=True),
                                         F.array().cast("array<struct<nth:int,piece:string>>")).alias("lead"))
    old = F.array_join(F.transform("lead", lambda x: x["piece"]), "")
    w = w.withColumn("old", old).withColumn("repeated", F.size("lead"))
    marked = F.aggregate(
        "fresh",
        F.struct(F.length("old").cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["piece"])).alias("at"),
            F.when(x["role"] == "assistant", F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(x["piece"]) - len(END) - F.length(escape(x["text"]))).alias("start"),
                F.length(escape(x["text"])).cast("long").alias("length"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return w.select("conv_id", "window", "repeated",
                    F.concat("old", F.array_join(F.transform("fresh", lambda x: x["piece"]), "")).alias("formatted"),
                    marked.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: its turns, and what lies under the loss mask.

    conv_id, n_turns, turns (array of role and text), loss_text (unescaped), formatted_chars.
    """
    # The text starts with a mark, so what stands before the first one is empty.
    parts = F.filter(F.split("formatted", r"<\|im_start\|>", -1), lambda p, i: i > F.col("repeated"))
    turns = F.transform(parts, lambda p: F.struct(
        F.url_decode(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END))).alias("text")))
    learned = F.array_join(F.transform("loss", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    one = formatted.select("conv_id", "window", turns.alias("turns"), learned.alias("learned"),
                           F.length("formatted").cast("long").alias("chars"))
    whole = one.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "turns", "learned"))).alias("w"),
                                       F.sum("chars").alias("formatted_chars"))
    return whole.select(
        "conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
        F.array_join(F.transform("w", lambda x: x["learned"]), "").alias("loss_text"), "formatted_chars",
    ).withColumn("n_turns", F.size("turns").cast("long"))
