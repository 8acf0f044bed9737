"""Views over the test tables that several plans use, in both dialects."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.session import table


def qa(spark, sf_dir):
    """qa_pairs flat, repeats of a row once."""
    c = F.col
    return table(spark, sf_dir, "qa_pairs").select(
        "pair_id", "source", c("question.title").alias("title"), c("question.body").alias("body"), c("question.text").alias("q_text"), c("question.tags").alias("tags"), c("question.score").alias("q_score"), c("question.id").alias("q_id"),
        c("answer.text").alias("a_text"), c("answer.body_markdown").alias("a_md"), c("answer.score").alias("a_score"), c("answer.author").alias("author"), c("reddit_metadata.op_confirmed").alias("op_confirmed"), c("reddit_metadata.solution_type").alias("solution_type"),
        c("reddit_metadata.total_comments").alias("total_comments"), c("quality_metrics.overall_score").alias("overall"), "collected_at",
    ).dropDuplicates(["pair_id"])


QA = """qa AS (SELECT pair_id, any_value(source) AS source, any_value(question.title) AS title, any_value(question.body) AS body, any_value(question.text) AS q_text, any_value(question.tags) AS tags, any_value(question.score) AS q_score, any_value(question.id) AS q_id,
 any_value(answer.text) AS a_text, any_value(answer.body_markdown) AS a_md, any_value(answer.score) AS a_score, any_value(answer.author) AS author, any_value(reddit_metadata.op_confirmed) AS op_confirmed, any_value(reddit_metadata.solution_type) AS solution_type,
 any_value(reddit_metadata.total_comments) AS total_comments, any_value(quality_metrics.overall_score) AS overall, any_value(collected_at) AS collected_at FROM qa_pairs GROUP BY pair_id)"""


def usage(spark, sf_dir):
    """usage_records, repeats once, with the instant of the stamp."""
    from gridwright.functions.instants import instant

    return table(spark, sf_dir, "usage_records").dropDuplicates(["id"]).withColumn("happened", instant(F.col("timestamp")))


USAGE = r"""u0 AS (SELECT id, any_value("timestamp") AS stamp, any_value(provider) AS provider, any_value(model) AS model, any_value(usage_type) AS usage_type, any_value(tokens) AS tokens, any_value(cost_usd) AS cost_usd, any_value(source) AS source, any_value(operation) AS operation FROM usage_records GROUP BY id),
u AS (SELECT *, CASE WHEN regexp_matches(stamp, '^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?\s*(Z|[+-]\d{2}:?\d{2})?\s*$')
  THEN TRY_CAST(substr(trim(stamp), 1, 19) AS TIMESTAMP) - CASE WHEN regexp_matches(stamp, '[+-]\d{2}:\d{2}\s*$') THEN
    (CASE WHEN regexp_extract(stamp, '([+-])\d{2}:\d{2}\s*$', 1) = '-' THEN -1 ELSE 1 END) * (CAST(regexp_extract(stamp, '[+-](\d{2}):\d{2}\s*$', 1) AS INTEGER) * INTERVAL 1 HOUR + CAST(regexp_extract(stamp, '[+-]\d{2}:(\d{2})\s*$', 1) AS INTEGER) * INTERVAL 1 MINUTE) ELSE INTERVAL 0 HOUR END END AS happened FROM u0)"""
