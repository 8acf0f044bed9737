"""Queries of problem 7."""

from __future__ import annotations

from gridwright.llm.mixing import ALL, mix
from gridwright.session import spread, table


def _run(spark, sf_dir, total=None):
    return mix(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")), table(spark, sf_dir, "mix_targets"), total)


def p7_mix(spark, sf_dir):
    """The mixture as large as all documents once: sources too small for that are clamped at
    their caps, and the excess of their weights goes to the others."""
    return _run(spark, sf_dir, ALL)[0]


def p7_shares(spark, sf_dir):
    """Planned and actual shares of p7_mix."""
    return _run(spark, sf_dir, ALL)[1]


def p7_mix_exact(spark, sf_dir):
    """The largest mixture in which every source with documents has its share within its cap."""
    return _run(spark, sf_dir)[0]


def p7_shares_exact(spark, sf_dir):
    return _run(spark, sf_dir)[1]


QUERIES = {"p7_mix": p7_mix, "p7_shares": p7_shares, "p7_mix_exact": p7_mix_exact, "p7_shares_exact": p7_shares_exact}
ORACLES: dict = {}
