"""Bot detection: the rule layer over answers and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.functions import bot_rules
from gridwright.functions.dialects import DUCK, SPARK
from gridwright.plans.common import QA, qa
from gridwright.session import table

c = F.col

BOT = bot_rules.BOT
_BODY = "coalesce(a_text, '')"


def rules_layer():
    """The greatest of an answer's sub-checks that reach 0.7 (columns a_text, author)."""
    return F.expr(bot_rules.rules_risk(SPARK, _BODY, "author"))


def c41_username(spark, sf):
    return qa(spark, sf).filter("author is not null").select("author", F.expr(bot_rules.username_risk(SPARK)).alias("risk")).distinct()


def c42_content(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.expr(bot_rules.content_risk(SPARK, "coalesce(text, '')")).alias("risk"))


def c40_rules(spark, sf):
    risk = rules_layer()
    return qa(spark, sf).select("pair_id", risk.alias("confidence"), (risk >= BOT).alias("is_bot"))


def f19_bot_gate(spark, sf):
    return c40_rules(spark, sf).filter("is_bot and confidence >= 0.7").select("pair_id")


def a23_rates(spark, sf):
    return c40_rules(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_bot").alias("bots"), F.round(F.avg(c("is_bot").cast("int")), 6).alias("rate"))


_H = lambda t, ws: "(" + " + ".join("CAST(contains(lower({}), '{}') AS INTEGER)".format(t, w.replace("'", "''")) for w in ws) + ")"
_RULES = bot_rules.rules_risk(DUCK, _BODY, "author")
_CONTENT = bot_rules.content_risk(DUCK, "coalesce(text, '')")
_W = "WITH " + QA
QUERIES = {f.__name__: f for f in (c40_rules, c41_username, c42_content, f19_bot_gate, a23_rates)}
ORACLES = {
    "c41_username": f"{_W} SELECT DISTINCT author, {bot_rules.username_risk(DUCK)} AS risk FROM qa WHERE author IS NOT NULL",
    "c42_content": f"SELECT doc_id, {_CONTENT} AS risk FROM documents",
    "c40_rules": f"{_W} SELECT pair_id, {_RULES} AS confidence, {_RULES} >= 0.7 AS is_bot FROM qa",
    "f19_bot_gate": f"{_W} SELECT pair_id FROM qa WHERE {_RULES} >= 0.7",
    "a23_rates": f"{_W} SELECT count(*) AS n, count(*) FILTER (WHERE {_RULES} >= 0.7) AS bots, round(avg(CAST({_RULES} >= 0.7 AS INTEGER)), 6) AS rate FROM qa",
}

