"""Prompts and conversations rendered as text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from qloom.functions.text import fill, rstrip, split_once, strip

# The texts a model was trained with, which must agree to the letter.
SYSTEM = (
    "You are an expert SQL assistant. Given the database schema and a natural "
    "language question, write the correct SQL query. Output only the SQL — no "
    "explanation, no markdown fences."
)
BEGIN = "<|begin_of_text|>"
HEADER = "<|start_header_id|>{role}<|end_header_id|>"
END_OF_TURN = "<|eot_id|>"
ASSISTANT_MARK = HEADER.format(role="assistant")
CHAT = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n"
    "{system}<|eot_id|><|start_header_id|>user<|end_header_id|>\n"
    "\n"
    "### Database Schema:\n"
    "{ddl}\n"
    "\n"
    "### Question:\n"
    "{question}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n"
    "{answer}<|eot_id|>"
)
ALPACA = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n"
    "\n"
    "### Instruction:\n"
    "{system}\n"
    "\n"
    "### Database Schema (Input):\n"
    "{ddl}\n"
    "\n"
    "### Question:\n"
    "{question}\n"
    "\n"
    "### Response (SQL):\n"
    "{answer}"
)
CUTOFF_LINE = "Cutting Knowledge Date: December 2023\n"
DATE_LINE = "Today Date: {date}\n\n"
DATE = "26 Jul 2024"
# End of fixed values.


def _stripped(*names: str) -> dict[str, Column]:
    return {n: strip(F.col(n)) for n in names}


def chat_prompt(df: DataFrame, template: str = CHAT, system: str = SYSTEM) -> DataFrame:
    """Training text in the chat layout; the source columns go, the layout is noted."""
    values = _stripped("ddl", "question", "answer")
    text = fill(template, {**values, "system": F.lit(system)})
    return df.select(
        *[c for c in df.columns if c not in ("ddl", "question", "answer")],
        F.lit("chat").alias("layout"),
        text.alias("text"),
    )


def alpaca_prompt(df: DataFrame, eos: str, template: str = ALPACA, system: str = SYSTEM) -> DataFrame:
    """Training text in the instruction layout, closed by ``eos``; the source columns stay."""
    values = _stripped("ddl", "question", "answer")
    text = F.concat(fill(template, {**values, "system": F.lit(system)}), F.lit(eos))
    return df.withColumns({"layout": F.lit("alpaca"), "text": text})


def inference_prompt(df: DataFrame, template: str = CHAT, system: str = SYSTEM) -> DataFrame:
    """The chat layout up to and with the assistant header, for a model to go on from."""
    open_end = template[: template.index("{answer}")]
    text = fill(open_end, {**_stripped("ddl", "question"), "system": F.lit(system)})
    return df.withColumns({"layout": F.lit("chat"), "prompt": text})


def prompt_and_response(df: DataFrame, col: str = "text", mark: str = ASSISTANT_MARK) -> DataFrame:
    """Split rendered text at the first assistant header.

    ``prompt`` ends with the header and a line break, ``response`` is the rest without end-of-turn
    marks. Rows without the header get nulls; they are to be counted apart, not scored.
    """
    before, after = split_once(F.col(col), mark)
    return df.withColumns(
        {
            "prompt": F.when(after.isNotNull(), F.concat(before, F.lit(mark + "\n"))),
            "response": strip(F.replace(after, F.lit(END_OF_TURN), F.lit(""))),
        }
    )


def message(role: Column, text: Column) -> Column:
    """One rendered chat message."""
    return F.concat(fill(HEADER + "\n\n", {"role": role}), strip(text), F.lit(END_OF_TURN))


def render_conversations(
    turns: DataFrame,
    generation_prompt: bool = False,
    date: str = DATE,
    part_turns: int = 1_000,
) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as rendered text, one row (conv_id, text) each.

    A system message at the first turn moves into the opening header; where several messages share a turn, a system
    message comes first, then the order of their texts. Missing roles and texts count as empty. Messages are joined
    per range of ``part_turns`` turn numbers first, so that only finished texts meet in one place, never
    lists of single messages; the number changes nothing in the result.
    """
    said = turns.select(
        "conv_id",
        "turn",
        (F.coalesce("role", F.lit("")) != "system").alias("later"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("role", F.lit("")).alias("role"),
    )
    messages = F.array_sort(F.collect_list(F.struct("turn", "later", "text", "role")))
    parts = said.groupBy("conv_id", F.floor(F.col("turn") / part_turns).alias("part")).agg(messages.alias("m"))
    body = lambda m: message(m["role"], m["text"])
    parts = parts.select(
        "conv_id",
        "part",
        (~F.col("m")[0]["later"]).alias("leads"),
        F.col("m")[0]["text"].alias("rules"),
        body(F.col("m")[0]).alias("first"),
        F.array_join(F.transform(F.slice("m", 2, 2**31 - 2), body), "").alias("rest"),
    )
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "leads", "rules", "first", "rest"))).alias("p"))
    head = F.col("p")[0]
    text = F.concat(
        F.lit(BEGIN + HEADER.format(role="system") + "\n\n" + CUTOFF_LINE + DATE_LINE.format(date=date)),
        F.when(head["leads"], strip(head["rules"])).otherwise(""),
        F.lit(END_OF_TURN),
        F.when(head["leads"], "").otherwise(head["first"]),
        head["rest"],
        F.array_join(F.transform(F.slice("p", 2, 2**31 - 2), lambda p: F.concat(p["first"], p["rest"])), ""),
        F.lit(ASSISTANT_MARK + "\n\n" if generation_prompt else ""),
    )
    return whole.select("conv_id", text.alias("text"))


def evaluation_prompt(df: DataFrame, template: str = CHAT, system: str = SYSTEM) -> DataFrame:
    """The chat layout with an empty answer, cut after its last character that is not blank."""
    values = {"ddl": F.col("ddl"), "question": F.col("question"), "answer": F.lit(""), "system": F.lit(system)}
    return df.withColumns({"layout": F.lit("chat"), "prompt": rstrip(fill(template, values))})
