"""Queries of problem 6."""

from __future__ import annotations

from gridwright.llm.bpe import encode_texts
from gridwright.session import spread, table


def p6_ids(spark, sf_dir):
    return encode_texts(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"p6_ids": p6_ids}
ORACLES: dict = {}
