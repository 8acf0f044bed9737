"""Queries of problem 4."""

from __future__ import annotations

from gridwright.llm.pairs import broken_pairs, pair_texts, truncation_split
from gridwright.session import spread, table


def p4_found(spark, sf_dir):
    return broken_pairs(spread(pair_texts(table(spark, sf_dir, "qa_pairs"))))


def p4_truncation(spark, sf_dir):
    """How the truncated pairs show that they are: by form, by a neighbour, by a limit."""
    return truncation_split(spread(pair_texts(table(spark, sf_dir, "qa_pairs"))))


QUERIES = {"p4_found": p4_found, "p4_truncation": p4_truncation}
ORACLES: dict = {}
