"""Chat formatting: conversations as windows of at most a token budget.

A turn is rendered as ``### role: text</turn>`` and a line feed. The control strings and
the escape sign get a backslash inside texts and roles, so the format can be read back.

Budgeted windows: prefix sums of the turns' tokens place each turn in a cell of the
token line; the turns of a cell are one span, always whole turns. A window is the
system turn, then the latest turns before the span that fit the history budget, then the
span. Loss lies on the assistant texts of the span alone: what a window repeats is masked.

The prefix sums are built per range of turns and then carried over, so a conversation
of any length is spread over tasks; a window holds a bounded number of tokens.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.common import arrow_map, text_or_empty, written
from quarrylake.llm.packing import tokenizer

BUDGET = 2048
HISTORY = 256
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|(?!</turn>)[^\\])*)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(column: str, also: tuple[str, ...] = ()) -> Column:
    """The text with a backslash before each backslash and control string."""
    out = F.col(column)
    for sign in ("\\", "### ", "</turn>", *also):
        out = F.replace(out, F.lit(sign), F.lit("\\" + sign))
    return out


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"not a turn at {at}")
        turns.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return turns


def _counted(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """The turns with their rendered text and its tokens."""

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        coder = tokenizer(tokenizer_path)
        return texts.map(lambda t: len(coder.encode(t)) // 4)

    head = F.concat(F.lit("### "), escaped("role", (":",)), F.lit(": "))
    body = escaped("text")
    rendered = F.concat(head, body, F.lit("</turn>\n"))
    return turns.select(
        "*", rendered.alias("rendered"), F.char_length(head).alias("skip"), F.char_length(body).alias("chars")
    ).withColumn("tokens", tokens("rendered"))


def windows(
    conversations: DataFrame,
    tokenizer_path: str,
    budget: int = BUDGET,
    history: int = HISTORY,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(conv_id, window, formatted, loss_spans, repeated, tokens), windows in the order of their numbers.

    ``loss_spans`` are (start, end) in code points of ``formatted``; ``repeated`` is the
    number of leading turns that an earlier window has shown. Turns go by turn number, nulls
    first, ties by role and text; rows that repeat are turns of their own. A null id is one
    conversation of its own; null roles and texts are empty. A turn longer than half the
    room has a window of its own; one that is longer than the whole room makes its window
    exceed the budget, and stands there without history. Other columns are not read.
    """
    rows = conversations.select(
        conversations[id_column].alias("conv_id"),
        conversations[turn_column].alias("turn"),
        text_or_empty(role_column).alias("role"),
        text_or_empty(text_column).alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    order = ("turn", "role", "text", "row")
    ranged = _counted(rows, tokenizer_path).repartitionByRange(*("key", *order))
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "chat-turns")

    # where each turn stands in its conversation: within its range, then before its range
    inside = Window.partitionBy("key", "part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = ranged.groupBy("key", "part").agg(
        F.sum("tokens").alias("part_tokens"),
        F.count("*").alias("part_turns"),
        F.min_by(F.struct("role", "tokens"), F.struct(*order)).alias("first"),
    )
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opener = F.first("first").over(whole)
    parts = parts.select(
        "key",
        "part",
        F.coalesce(F.sum("part_tokens").over(earlier), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("part_turns").over(earlier), F.lit(0)).alias("turns_before"),
        F.when(opener["role"] == "system", opener["tokens"]).otherwise(0).alias("system_tokens"),
        (opener["role"] == "system").alias("has_system"),
    )
    turns = (
        ranged.withColumn("upto", F.sum("tokens").over(upto))
        .withColumn("at", F.row_number().over(inside))
        .join(parts, ["key", "part"])
        .withColumn("at", F.col("at") + F.col("turns_before"))
        .withColumn("start", F.col("upto") + F.col("tokens_before") - F.col("tokens") - F.col("system_tokens"))
        .withColumn("room", F.greatest(F.lit(budget // 4), F.lit(budget - history) - F.col("system_tokens")))
        .withColumn("step", F.expr("greatest(1, room div 2)"))
        .withColumn("cell", F.expr("start div step"))
        .withColumn("alone", (F.col("tokens") > F.col("step")).cast("int"))
        .withColumn("system", F.col("has_system") & (F.col("at") == 1))
        .select("key", "conv_id", "at", "role", "rendered", "skip", "chars", "tokens", "start", "room", "step", "cell", "alone", "system")
    )
    turns = written(turns, "chat-placed")
    ordinary = turns.where(~F.col("system"))
    spans = ordinary.groupBy("key", "cell", "alone").agg(
        F.min("start").alias("span_start"), F.max("tokens").alias("longest"), F.first("room").alias("room")
    )
    # the window in which the system turn is new: the first one, or one of its own
    opening = (
        turns.where("system")
        .join(spans.groupBy("key").agg(F.min(F.struct("cell", "alone")).alias("opens")), "key", "left")
        .withColumn("opens", F.coalesce("opens", F.struct(F.lit(0).cast("long").alias("cell"), F.lit(0).alias("alone"))))
    )
    shown = F.struct("at", "role", "rendered", "skip", "chars", "tokens", F.col("seen"))
    target = ordinary.withColumn("seen", F.lit(False)).select("key", "conv_id", "cell", "alone", shown.alias("turn"))
    system = opening.join(spans.select("key", F.col("cell").alias("to_cell"), F.col("alone").alias("to_alone")), "key", "left").select(
        "key",
        "conv_id",
        F.coalesce("to_cell", F.col("opens.cell")).alias("cell"),
        F.coalesce("to_alone", F.col("opens.alone")).alias("alone"),
        F.struct(
            "at", "role", "rendered", "skip", "chars", "tokens",
            F.coalesce((F.col("to_cell") != F.col("opens.cell")) | (F.col("to_alone") != F.col("opens.alone")), F.lit(False)).alias("seen"),
        ).alias("turn"),
    )
    reached = ordinary.withColumn(
        "to_cell", F.explode(F.sequence(F.col("cell"), F.expr(f"(start + {history}) div step")))
    ).withColumn("to_alone", F.explode(F.array(F.lit(0), F.lit(1))))
    before = (
        reached.join(
            spans.select("key", F.col("cell").alias("to_cell"), F.col("alone").alias("to_alone"), "span_start", F.col("longest"), F.col("room").alias("span_room")),
            ["key", "to_cell", "to_alone"],
        )
        .where((F.col("start") < F.col("span_start")) & (F.col("span_start") - F.col("start") <= history))
        .where(F.col("longest") <= F.col("span_room"))
        .withColumn("seen", F.lit(True))
        .select("key", "conv_id", F.col("to_cell").alias("cell"), F.col("to_alone").alias("alone"), shown.alias("turn"))
    )
    shown_turns = target.unionByName(system).unionByName(before)
    grouped = shown_turns.groupBy("key", "cell", "alone").agg(
        F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list("turn")).alias("turns")
    )
    begin = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, turn):
        start = acc["at"] + turn["skip"]
        span = F.struct(start.alias("start"), (start + turn["chars"]).alias("end"))
        counts = (turn["role"] == "assistant") & ~turn["seen"] & (turn["chars"] > 0)
        return F.struct(
            (acc["at"] + F.char_length(turn["rendered"])).alias("at"),
            F.when(counts, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    return grouped.select(
        "conv_id",
        (F.col("cell") * 2 + F.col("alone")).alias("window"),
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
        F.aggregate("turns", begin, step, lambda acc: acc["spans"]).alias("loss_spans"),
        F.size(F.filter("turns", lambda t: t["seen"])).alias("repeated"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda acc, t: acc + t["tokens"]).alias("tokens"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation say, read back from them in order.

    The windows pass through one at a time, so memory does not grow with a conversation.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def run(batches):
        conv = state = None
        done: list[tuple] = []

        def close():
            if state:
                turns, loss, n_turns, loss_chars, chars = state
                done.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conv:
                    close()
                    conv, state = row["conv_id"], [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                text = row["formatted"]
                for role, said in read_back(text)[row["repeated"] :]:
                    state[0].update(f"{role}\n{said}\n".encode())
                    state[2] += 1
                for span in row["loss_spans"]:
                    said = unescaped(text[span["start"] : span["end"]])
                    state[1].update(said.encode())
                    state[3] += len(said)
                state[4] += len(text)
            if done:
                yield dict(zip(names, map(list, zip(*done))))
                done.clear()
        close()
        if done:
            yield dict(zip(names, map(list, zip(*done))))

    ordered = formatted.select("conv_id", "window", "formatted", "loss_spans", "repeated")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return arrow_map(
        ordered,
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
