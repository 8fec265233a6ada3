"""Rendered prompts and conversations."""

from qloom.operators import lengths, prompts
from qloom.sources.corpus import pairs_of_conversations, read_corpus

ROW = [(1, "  CREATE TABLE t (a INT);\n", " how many? ", "\tSELECT 1\n")]
SCHEMA = "row_id long, ddl string, question string, answer string"


def test_chat_prompt(spark):
    row = prompts.chat_prompt(spark.createDataFrame(ROW, SCHEMA)).first()
    assert row.asDict().keys() == {"row_id", "layout", "text"}
    assert row.text.startswith("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\nYou are an expert")
    assert "### Database Schema:\nCREATE TABLE t (a INT);\n\n### Question:\nhow many?<|eot_id|>" in row.text
    assert row.text.endswith("<|start_header_id|>assistant<|end_header_id|>\nSELECT 1<|eot_id|>")


def test_alpaca_prompt(spark):
    row = prompts.alpaca_prompt(spark.createDataFrame(ROW, SCHEMA), "</s>").first()
    assert row.question == " how many? " and row.layout == "alpaca"
    assert row.text.endswith("### Question:\nhow many?\n\n### Response (SQL):\nSELECT 1</s>")


def test_inference_and_evaluation_prompts(spark):
    df = spark.createDataFrame(ROW, SCHEMA)
    ask = prompts.inference_prompt(df).first().prompt
    assert ask.endswith("how many?<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n")
    assert prompts.evaluation_prompt(df).first().prompt.endswith("<|end_header_id|>\n<|eot_id|>")


def test_template_is_a_parameter(spark):
    df = spark.createDataFrame(ROW, SCHEMA)
    row = prompts.chat_prompt(df, template="{question}|{system}|{answer}", system="S").first()
    assert row.text == "how many?|S|SELECT 1"


def test_split_at_the_first_mark(spark):
    mark = prompts.ASSISTANT_MARK
    df = spark.createDataFrame([(f"ask{mark}\n x {mark} y<|eot_id|>",), ("no mark",)], "text string")
    one, two = prompts.prompt_and_response(df).collect()
    assert one.prompt == f"ask{mark}\n" and one.response == f"x {mark} y"
    assert two.prompt is None and two.response is None


TURNS = [
    (1, 0, "system", " rules "), (1, 1, "user", "hi\n"), (1, 2, "assistant", "yes"), (1, 3, "system", "late"),
    (2, 4, "user", "only"),
]


def render(spark, **options):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").repartition(3)
    out = {}
    for r in prompts.render_conversations(df, **options).collect():
        out.setdefault(r.conv_id, []).append(r.text)
    return out


def test_render_conversations(spark):
    got = render(spark, date="1 Jan 2020")
    head = "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nCutting Knowledge Date: December 2023\nToday Date: 1 Jan 2020\n\n"
    said = lambda role, text: f"<|start_header_id|>{role}<|end_header_id|>\n\n{text}<|eot_id|>"
    assert got[1] == [head + "rules<|eot_id|>" + said("user", "hi") + said("assistant", "yes") + said("system", "late")]
    assert got[2] == [head + "<|eot_id|>" + said("user", "only")]


def test_parts_do_not_show(spark):
    whole = render(spark, generation_prompt=True)
    assert render(spark, generation_prompt=True, part_turns=2) == whole
    assert whole[2][0].endswith("<|start_header_id|>assistant<|end_header_id|>\n\n")


def test_long_conversations_are_one_row(spark):
    df = spark.range(25_000).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "cast(id AS string) AS text")
    (row,) = prompts.render_conversations(df.repartition(5)).collect()
    said = "".join(f"<|start_header_id|>user<|end_header_id|>\n\n{i}<|eot_id|>" for i in range(25_000))
    assert row.text.endswith(said)


def test_shared_turns_and_missing_texts(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "system", "rules"), (1, 0, "user", "a"), (1, 1, "user", None), (1, 2, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = prompts.render_conversations(df).collect()
    said = lambda role, text: f"<|start_header_id|>{role}<|end_header_id|>\n\n{text}<|eot_id|>"
    assert row.text.endswith("rules<|eot_id|>" + said("user", "a") + said("user", "b") + said("user", "") + said("", "x"))


def test_pairs_of_conversations(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in pairs_of_conversations(df, "D").collect()] == [((1 << 32) + 1, "D", "hi\n", "yes")]


def test_conversation_ids_of_any_size(spark):
    ids = [2**31, -(2**63), 2**63 - 1, 5]
    rows = [(i, t, ("user", "assistant")[t % 2], f"{t}") for i in ids for t in (0, 1, 2, 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(int(r.row_id) for r in pairs_of_conversations(df, "D").collect())
    assert got == sorted(i * 2**32 + t for i in ids for t in (0, 2))


def test_lengths(spark):
    df = spark.createDataFrame([("a", "x  y\tz"), ("a", ""), ("a", "w " * 300), ("b", None)], "g string, t string")
    counts = [r.n_tokens for r in lengths.token_count(df, "t").collect()]
    assert counts == [3, 0, 300, None]
    got = {(r.g, r.from_tokens): (r.n_texts, r.over_2) for r in lengths.length_profile(df, "t", ["g"], limits=[2]).where("g = 'a'").collect()}
    assert got == {("a", 0): (2, 1), ("a", 256): (1, 1)}


def test_read_corpus(spark, tmp_path):
    path = str(tmp_path / "corpus")
    spark.createDataFrame(ROW, SCHEMA).write.json(path)
    assert [tuple(r) for r in read_corpus(spark, path, "json").collect()] == ROW
