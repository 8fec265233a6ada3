"""Training-corpus preparation over question and answer turns, and text lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.operators import lengths, prompts, selection
from qloom.plans.registry import query
from qloom.session import work_folder
from qloom.sources.corpus import pairs_of_conversations, read_corpus
from qloom.sources.tables import scan

DDL = "  CREATE TABLE turns (conv_id BIGINT, turn INT, said TEXT);\n"
CAP = 100

PAIRS = f"""
    pairs AS (
      SELECT a.conv_id * 4294967296 + a.turn AS row_id, '{DDL}' AS ddl, a.text AS question, b.text AS answer
      FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
      WHERE a.role = 'user' AND b.role = 'assistant')
"""
RANKED = PAIRS + """,
    ranked AS (
      SELECT row_id, row_number() OVER (ORDER BY md5('42:' || row_id), row_id) AS place,
             ceil((SELECT count(*) FROM pairs) * (1 - CAST(0.95 AS DOUBLE))) AS held
      FROM pairs)
"""


def sql_strip(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_fill(template: str, **values: str) -> str:
    """The template as one SQL concatenation."""
    out = sql_text(template.replace("{system}", prompts.SYSTEM))
    for name, expr in values.items():
        out = f"replace({out}, '{{{name}}}', {expr})"
    return out


FIELDS = {c: sql_strip(c) for c in ("ddl", "question", "answer")}


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    found = pairs_of_conversations(scan(spark, sf, "conversations"), DDL)
    # the tables' conversation ids are small numbers
    return found.withColumn("row_id", F.col("row_id").cast("long"))


@query("corpus_scan", f"WITH {PAIRS} SELECT row_id, ddl, question, answer FROM pairs")
def corpus_scan(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).select("row_id", "ddl", "question", "answer")


@query("corpus_file", f"WITH {PAIRS} SELECT row_id, ddl, question, answer FROM pairs")
def corpus_file(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus written to the shared folder and loaded with its fixed layout."""
    path = f"{work_folder(spark, 'corpus')}/corpus"
    corpus_scan(spark, sf).write.parquet(path)
    return read_corpus(spark, path)


@query("corpus_cap", f"WITH {PAIRS} SELECT row_id, question FROM pairs ORDER BY row_id LIMIT {CAP}")
def corpus_cap(spark: SparkSession, sf: str) -> DataFrame:
    return selection.first_n(pairs(spark, sf).select("row_id", "question"), "row_id", CAP)


@query(
    "train_test_split",
    f"WITH {RANKED} SELECT row_id, CASE WHEN place <= held THEN 'test' ELSE 'train' END AS split FROM ranked",
)
def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    return selection.split(pairs(spark, sf).select("row_id"), "row_id")


@query(
    "split_counts",
    f"""
    WITH {RANKED} SELECT CASE WHEN place <= held THEN 'test' ELSE 'train' END AS split,
           CAST(count(*) AS BIGINT) AS n_samples
    FROM ranked GROUP BY 1
    """,
)
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return train_test_split(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n_samples"))


@query(
    "seeded_sample",
    f"WITH {PAIRS} SELECT row_id, question FROM pairs ORDER BY md5('42:' || row_id), row_id LIMIT {CAP}",
)
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return selection.sample(pairs(spark, sf).select("row_id", "question"), "row_id", CAP)


@query(
    "held_out_sample",
    f"""
    WITH {RANKED} SELECT row_id, question FROM ranked JOIN pairs USING (row_id)
    WHERE place <= held AND place <= 10
    """,
)
def held_out_sample(spark: SparkSession, sf: str) -> DataFrame:
    return selection.held_out_sample(pairs(spark, sf).select("row_id", "question"), "row_id", 10)


@query(
    "format_chat_prompt",
    f"WITH {PAIRS} SELECT row_id, 'chat' AS layout, {sql_fill(prompts.CHAT, **FIELDS)} AS text FROM pairs",
)
def format_chat_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.chat_prompt(pairs(spark, sf))


EOS = "<|end_of_text|>"


@query(
    "format_alpaca_prompt",
    f"""
    WITH {PAIRS} SELECT row_id, ddl, question, answer, 'alpaca' AS layout,
           {sql_fill(prompts.ALPACA, **FIELDS)} || '{EOS}' AS text
    FROM pairs
    """,
)
def format_alpaca_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.alpaca_prompt(pairs(spark, sf), EOS)


OPEN_CHAT = prompts.CHAT[: prompts.CHAT.index("{answer}")]


@query(
    "format_inference_prompt",
    f"""
    WITH {PAIRS} SELECT row_id, 'chat' AS layout,
           {sql_fill(OPEN_CHAT, ddl=FIELDS["ddl"], question=FIELDS["question"])} AS prompt
    FROM pairs
    """,
)
def format_inference_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.inference_prompt(pairs(spark, sf)).select("row_id", "layout", "prompt")


@query(
    "prompt_response_split",
    f"""
    WITH {PAIRS} SELECT row_id,
           {sql_fill(OPEN_CHAT, ddl=FIELDS["ddl"], question=FIELDS["question"])} AS prompt,
           {FIELDS["answer"]} AS response
    FROM pairs
    """,
)
def prompt_response_split(spark: SparkSession, sf: str) -> DataFrame:
    rendered = prompts.chat_prompt(pairs(spark, sf))
    return prompts.prompt_and_response(rendered).select("row_id", "prompt", "response")


OPENING = (
    prompts.BEGIN
    + prompts.HEADER.format(role="system")
    + "\n\n"
    + prompts.CUTOFF_LINE
    + prompts.DATE_LINE.format(date=prompts.DATE)
)


@query(
    "render_conversations",
    f"""
    WITH firsts AS (SELECT conv_id, min(turn) AS t0 FROM conversations GROUP BY conv_id),
    messages AS (
      SELECT c.conv_id, c.turn, c.turn = t0 AND role = 'system' AS leads,
             CASE WHEN c.turn = t0 AND role = 'system' THEN ''
                  ELSE '<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10)
                       || {sql_strip("text")} || '<|eot_id|>' END AS body,
             {sql_strip("text")} AS said
      FROM conversations c JOIN firsts f ON c.conv_id = f.conv_id)
    SELECT conv_id,
           {sql_text(OPENING)} || coalesce(max(said) FILTER (WHERE leads), '') || '<|eot_id|>'
             || string_agg(body, '' ORDER BY turn)
             || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) AS text
    FROM messages GROUP BY conv_id
    """,
)
def render_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.render_conversations(scan(spark, sf, "conversations"), generation_prompt=True)


SQL_WORDS = r"len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''))"


@query("token_count", f"SELECT doc_id, CAST({SQL_WORDS} AS BIGINT) AS n_tokens FROM documents")
def token_count(spark: SparkSession, sf: str) -> DataFrame:
    return lengths.token_count(scan(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@query(
    "length_profile",
    f"""
    WITH counted AS (SELECT lang, CAST({SQL_WORDS} AS BIGINT) AS n FROM documents)
    SELECT lang, CAST(floor(n / 256) * 256 AS BIGINT) AS from_tokens, CAST(count(*) AS BIGINT) AS n_texts,
           CAST(count(*) FILTER (WHERE n > 900) AS BIGINT) AS over_900,
           CAST(count(*) FILTER (WHERE n > 1024) AS BIGINT) AS over_1024,
           CAST(count(*) FILTER (WHERE n > 2048) AS BIGINT) AS over_2048
    FROM counted GROUP BY 1, 2
    """,
)
def length_profile(spark: SparkSession, sf: str) -> DataFrame:
    return lengths.length_profile(scan(spark, sf, "documents"), "text", ["lang"])
