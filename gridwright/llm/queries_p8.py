"""Queries of problem 8."""

from __future__ import annotations

from gridwright.llm.reading import reading_levels, university_prose
from gridwright.session import spread, table


def p8_levels(spark, sf_dir):
    return reading_levels(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "reading_labels"))


def p8_found(spark, sf_dir):
    return university_prose(p8_levels(spark, sf_dir))


QUERIES = {"p8_found": p8_found, "p8_levels": p8_levels}
ORACLES: dict = {}
