"""Evaluation of predictions, derived from question and answer turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.operators import evaluation, resolve
from qloom.operators.bleu import bleu4
from qloom.plans.part_corpus import PARTS, SETTINGS, part_corpus, sql_case, sql_template
from qloom.plans.prompts import PAIRS, SQL_WORDS, pairs
from qloom.plans.registry import query
from qloom.session import work_folder
from qloom.sources.logs import write_report
from qloom.sources.tables import scan

PREDICTIONS = PAIRS + r""",
    predictions AS (
      SELECT row_id, 'tuned' AS label, lower(replace(answer, ' ', '  ')) AS generated, answer AS reference,
             CAST(length(answer) + row_id % 7 AS DOUBLE) / 2 AS latency_ms FROM pairs
      UNION ALL
      SELECT row_id, 'base', CASE WHEN row_id % 3 = 0
               THEN array_to_string(string_split(answer, ' ')[1:(len(string_split(answer, ' ')) // 2)], ' ')
               ELSE answer END, answer,
             CAST(length(answer) * 3 + row_id % 11 AS DOUBLE) / 2 FROM pairs)
"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Two labels: answers in another case and spacing, and answers of which every third is cut."""
    answers = pairs(spark, sf).select("row_id", F.col("answer").alias("reference"))
    said = F.col("reference")
    parts = F.split(said, " ")
    half = F.array_join(F.slice(parts, F.lit(1), F.floor(F.size(parts) / 2).cast("int")), " ")
    labelled = F.array(
        F.struct(
            F.lit("tuned").alias("label"),
            F.lower(F.replace(said, F.lit(" "), F.lit("  "))).alias("generated"),
            ((F.length(said) + F.col("row_id") % 7) / 2).alias("latency_ms"),
        ),
        F.struct(
            F.lit("base").alias("label"),
            F.when(F.col("row_id") % 3 == 0, half).otherwise(said).alias("generated"),
            ((F.length(said) * 3 + F.col("row_id") % 11) / 2).alias("latency_ms"),
        ),
    )
    return answers.select("row_id", "reference", F.inline(labelled))


def sql_words(col: str) -> str:
    return SQL_WORDS.replace("text", f"lower({col})")


EXACT = f"""
    exact AS (
      SELECT label, CAST(count(*) AS BIGINT) AS n_samples,
             count(*) FILTER (WHERE list_filter(string_split_regex(lower(generated), '\\s+'), lambda w: w <> '')
                                  = list_filter(string_split_regex(lower(reference), '\\s+'), lambda w: w <> ''))
               / CAST(count(*) AS DOUBLE) AS exact_match_accuracy
      FROM predictions GROUP BY label)
"""


def sql_tokens(col: str) -> str:
    """The tokenisation rules once more, for the checking engine."""
    text = rf"regexp_replace({col}, '\s+$', '')"
    for old, new in (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = f"replace({text}, '{old}', '{new}')"
    text = f"(' ' || {text} || ' ')"
    for pattern, new in (
        (r"([!-&(-+:-@/\[-`{-~])", r" \1 "),
        (r"([^0-9])([.,])", r"\1 \2 "),
        (r"([.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return rf"list_filter(string_split_regex({text}, '\s+'), lambda w: w <> '')"


BLEU = f"""
    split AS (
      SELECT row_id, label, {sql_tokens("generated")} AS hyp, {sql_tokens("reference")} AS ref FROM predictions),
    starts AS (
      SELECT row_id, label, n, hyp, ref, unnest(range(1, greatest(len(hyp), len(ref)) + 1)) AS i
      FROM split, (SELECT unnest([1, 2, 3, 4]) AS n)),
    grams AS (
      SELECT row_id, label, n, array_to_string(hyp[i:i + n - 1], chr(1)) AS gram, 1 AS h, 0 AS r
      FROM starts WHERE i + n - 1 <= len(hyp)
      UNION ALL
      SELECT row_id, label, n, array_to_string(ref[i:i + n - 1], chr(1)), 0, 1
      FROM starts WHERE i + n - 1 <= len(ref)),
    counted AS (SELECT label, n, gram, sum(h) AS h, sum(r) AS r FROM grams GROUP BY row_id, label, n, gram),
    orders_ AS (
      SELECT label, n, sum(least(h, r)) AS m, sum(h) AS t, sum(r) AS tr FROM counted GROUP BY label, n),
    smooth AS (
      SELECT label, n, m, t, tr, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY n) AS z
      FROM orders_ WHERE t > 0),
    bleu AS (
      SELECT label, CASE WHEN sum(m) = 0 THEN 0.0 ELSE
               exp(sum(ln(100 * CASE WHEN m > 0 THEN CAST(m AS DOUBLE) ELSE 1 / pow(2, z) END / t)) / count(*))
               * CASE WHEN max(t) FILTER (WHERE n = 1) < max(tr) FILTER (WHERE n = 1)
                      THEN exp(1 - max(tr) FILTER (WHERE n = 1) / CAST(max(t) FILTER (WHERE n = 1) AS DOUBLE))
                      ELSE 1.0 END END AS bleu4
      FROM smooth GROUP BY label)
"""
LATENCY = """
    placed AS (
      SELECT label, latency_ms, row_number() OVER (PARTITION BY label ORDER BY latency_ms) - 1 AS place,
             count(*) OVER (PARTITION BY label) AS n FROM predictions),
    latency AS (
      SELECT label, CAST(sum(CAST(latency_ms AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_latency_ms,
             max(latency_ms) FILTER (WHERE place = floor(n * 0.5)) AS p50_latency_ms,
             max(latency_ms) FILTER (WHERE place = floor(n * CAST(0.95 AS DOUBLE))) AS p95_latency_ms
      FROM placed GROUP BY label)
"""
REPORT = """
    report AS (
      SELECT label, n_samples, CAST(0 AS BIGINT) AS n_skipped, exact_match_accuracy, round(bleu4, 6) AS bleu4, avg_latency_ms, p50_latency_ms, p95_latency_ms
      FROM exact JOIN bleu USING (label) JOIN latency USING (label))
"""


@query("exact_match", f"WITH {PREDICTIONS}, {EXACT} SELECT label, n_samples, CAST(0 AS BIGINT) AS n_skipped, exact_match_accuracy FROM exact")
def exact_match(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.exact_match(predictions(spark, sf))


@query("bleu4", f"WITH {PREDICTIONS}, {BLEU} SELECT label, round(bleu4, 6) AS bleu4 FROM bleu")
def bleu4_query(spark: SparkSession, sf: str) -> DataFrame:
    return bleu4(predictions(spark, sf)).withColumn("bleu4", F.round("bleu4", 6))


@query("eval_report", f"WITH {PREDICTIONS}, {EXACT}, {BLEU}, {LATENCY}, {REPORT} SELECT * FROM report")
def eval_report(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.report(predictions(spark, sf)).withColumn("bleu4", F.round("bleu4", 6))


@query("report_file", f"WITH {PREDICTIONS}, {EXACT}, {BLEU}, {LATENCY}, {REPORT} SELECT * FROM report")
def report_file(spark: SparkSession, sf: str) -> DataFrame:
    """The report written as JSON lines to the shared folder and read back."""
    path = f"{work_folder(spark, 'report')}/report"
    scores = eval_report(spark, sf)
    write_report(scores, path)
    return spark.read.schema(scores.schema).json(path)


GAPS = PREDICTIONS.replace("predictions AS", "complete AS") + """,
    gaps AS (
      SELECT row_id, CASE WHEN row_id % 5 = 0 THEN '(none)' WHEN row_id % 7 = 0 THEN 'unscored' ELSE label END AS label,
             CASE WHEN row_id % 11 = 0 THEN '' ELSE generated END AS generated,
             CASE WHEN row_id % 5 > 0 AND row_id % 7 = 0 OR row_id % 13 = 0 THEN NULL ELSE reference END AS reference,
             latency_ms
      FROM complete),
    predictions AS (SELECT * REPLACE (row_number() OVER () AS row_id) FROM gaps WHERE reference IS NOT NULL)
"""


@query(
    "eval_report_gaps",
    f"""
    WITH {GAPS}, {EXACT}, {BLEU}, {LATENCY.replace("FROM predictions", "FROM gaps")}
    SELECT nullif(latency.label, '(none)') AS label, coalesce(n_samples, 0) AS n_samples, n - coalesce(n_samples, 0) AS n_skipped,
           exact_match_accuracy, round(bleu4, 6) AS bleu4, avg_latency_ms, p50_latency_ms, p95_latency_ms
    FROM latency JOIN (SELECT label, count(*) AS n FROM gaps GROUP BY label) USING (label)
         LEFT JOIN exact USING (label) LEFT JOIN bleu USING (label)
    """,
)
def eval_report_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The report over rows some of which lack a label, a reference or an answer."""
    row = F.col("row_id")
    gaps = predictions(spark, sf).withColumns(
        {
            "label": F.when(row % 5 == 0, F.lit(None)).when(row % 7 == 0, "unscored").otherwise(F.col("label")),
            "generated": F.when(row % 11 > 0, F.col("generated")),
            "reference": F.when(~(((row % 5 > 0) & (row % 7 == 0)) | (row % 13 == 0)), F.col("reference")),
        }
    )
    return evaluation.report(gaps).withColumn("bleu4", F.round("bleu4", 6))


@query(
    "eval_delta",
    f"""
    WITH {PREDICTIONS}, {EXACT}, {BLEU}
    SELECT round(max(exact_match_accuracy) FILTER (WHERE label = 'tuned')
                 - max(exact_match_accuracy) FILTER (WHERE label = 'base'), 9) AS delta_exact_match_accuracy,
           round(max(bleu4) FILTER (WHERE label = 'tuned') - max(bleu4) FILTER (WHERE label = 'base'), 6) AS delta_bleu4
    FROM exact JOIN bleu USING (label)
    """,
)
def eval_delta(spark: SparkSession, sf: str) -> DataFrame:
    scores = evaluation.report(predictions(spark, sf))
    return evaluation.delta(scores, "tuned", "base").select(
        F.round("delta_exact_match_accuracy", 9).alias("delta_exact_match_accuracy"),
        F.round("delta_bleu4", 6).alias("delta_bleu4"),
    )


STATEMENTS = PARTS + f""",
    answered AS (
      SELECT row_id, {sql_case({k: sql_template(v.draft) for k, v in SETTINGS.items()})} AS reference FROM parts),
    wrong AS (
      SELECT row_id, reference, CASE WHEN row_id % 7 = 0 THEN regexp_replace(reference, '^SELECT ', 'SELECT ghost, ')
                                     ELSE reference END AS said FROM answered),
    predictions AS (
      SELECT row_id, 'tuned' AS label, replace(reference, ', ', ' ,  ') AS generated, reference,
             CAST(length(reference) AS DOUBLE) / 4 AS latency_ms FROM answered
      UNION ALL
      SELECT row_id, 'base', CASE WHEN row_id % 11 = 0 THEN regexp_replace(said, '^(.*?) FROM (\\w+)', '\\1 FROM phantom_\\2')
                                  ELSE said END, reference, CAST(length(reference) AS DOUBLE) / 2 FROM wrong),
    resolved AS (
      SELECT label, count(*) FILTER (WHERE label = 'tuned' OR (row_id % 7 <> 0 AND row_id % 11 <> 0))
                      / CAST(count(*) AS DOUBLE) AS resolvability_rate
      FROM predictions GROUP BY label)
"""


def statements(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted statements: the right ones in another spacing, and some with an unknown column or table."""
    rows = part_corpus(spark, sf).select("row_id", "ddl", F.col("answer").alias("reference"))
    said = F.col("reference")
    wrong = F.when(F.col("row_id") % 7 == 0, F.regexp_replace(said, "^SELECT ", "SELECT ghost, ")).otherwise(said)
    wrong = F.when(
        F.col("row_id") % 11 == 0, F.regexp_replace(wrong, r"^(.*?) FROM (\w+)", "$1 FROM phantom_$2")
    ).otherwise(wrong)
    labelled = F.array(
        F.struct(
            F.lit("tuned").alias("label"),
            F.replace(said, F.lit(", "), F.lit(" ,  ")).alias("generated"),
            (F.length(said) / 4).alias("latency_ms"),
        ),
        F.struct(
            F.lit("base").alias("label"), wrong.alias("generated"), (F.length(said) / 2).alias("latency_ms")
        ),
    )
    return rows.select("row_id", "ddl", "reference", F.inline(labelled))


def statement_scores(spark: SparkSession, sf: str) -> DataFrame:
    preds = statements(spark, sf)
    return evaluation.report(preds, resolve.resolvability(preds).drop("n_statements"))


@query(
    "eval_report_statements",
    f"""
    WITH {STATEMENTS}, {EXACT}, {BLEU}, {LATENCY}
    SELECT label, n_samples, CAST(0 AS BIGINT) AS n_skipped, exact_match_accuracy, resolvability_rate, round(bleu4, 6) AS bleu4, avg_latency_ms,
           p50_latency_ms, p95_latency_ms
    FROM exact JOIN bleu USING (label) JOIN latency USING (label) JOIN resolved USING (label)
    """,
)
def eval_report_statements(spark: SparkSession, sf: str) -> DataFrame:
    return statement_scores(spark, sf).withColumn("bleu4", F.round("bleu4", 6))


@query(
    "eval_delta_statements",
    f"""
    WITH {STATEMENTS}, {EXACT}, {BLEU}, scores AS (
      SELECT * FROM exact JOIN bleu USING (label) JOIN resolved USING (label))
    SELECT round(max(exact_match_accuracy) FILTER (WHERE label = 'tuned')
                 - max(exact_match_accuracy) FILTER (WHERE label = 'base'), 9) AS delta_exact_match_accuracy,
           round(max(resolvability_rate) FILTER (WHERE label = 'tuned')
                 - max(resolvability_rate) FILTER (WHERE label = 'base'), 9) AS delta_resolvability_rate,
           round(max(bleu4) FILTER (WHERE label = 'tuned') - max(bleu4) FILTER (WHERE label = 'base'), 6) AS delta_bleu4
    FROM scores
    """,
)
def eval_delta_statements(spark: SparkSession, sf: str) -> DataFrame:
    change = evaluation.delta(statement_scores(spark, sf), "tuned", "base")
    return change.select(
        *[F.round(c, 6 if c == "delta_bleu4" else 9).alias(c) for c in change.columns]
    )


@query(
    "latency_percentiles",
    """
    WITH placed AS (
      SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS place,
             count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_type, CAST(count(*) AS BIGINT) AS n_samples,
           CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_latency_ms,
           max(value) FILTER (WHERE place = floor(n * 0.5)) AS p50_latency_ms,
           max(value) FILTER (WHERE place = floor(n * CAST(0.95 AS DOUBLE))) AS p95_latency_ms
    FROM placed GROUP BY event_type
    """,
)
def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.latency(scan(spark, sf, "events").select("event_type", "value"), ["event_type"], "value")


WANTED, UNWANTED = ("EN", "r"), ("@", "http")
CHECKS = """
    checks AS (
      SELECT doc_id, source, contains(lower(text), 'en') AND contains(lower(text), 'r') AS has_all,
             contains(text, '@') OR contains(text, 'http') AS has_unwanted FROM documents)
"""


def checked_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = scan(spark, sf, "documents").select("doc_id", "source", "text")
    return evaluation.token_checks(docs, "text", WANTED, UNWANTED).drop("text")


@query(
    "token_checks",
    f"WITH {CHECKS} SELECT doc_id, source, has_all, has_unwanted, has_all AND NOT has_unwanted AS passed FROM checks",
)
def token_checks(spark: SparkSession, sf: str) -> DataFrame:
    return checked_documents(spark, sf)


@query(
    "suite_summary",
    f"""
    WITH {CHECKS}, counted AS (
      SELECT source, CAST(count(*) FILTER (WHERE has_all AND NOT has_unwanted) AS BIGINT) AS n_passed,
             CAST(count(*) FILTER (WHERE NOT has_all OR has_unwanted) AS BIGINT) AS n_failed FROM checks GROUP BY source)
    SELECT source, n_passed, n_failed, n_passed / CAST(n_passed + n_failed AS DOUBLE) * 100 AS percent,
           CASE WHEN n_passed / CAST(n_passed + n_failed AS DOUBLE) * 100 >= 95 THEN 'good'
                WHEN n_passed / CAST(n_passed + n_failed AS DOUBLE) * 100 >= 80 THEN 'fair' ELSE 'poor' END AS tier
    FROM counted
    """,
)
def suite_summary(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.suite_summary(checked_documents(spark, sf), ["source"])
