"""Queries of problem 1."""

from __future__ import annotations

from gridwright.llm.cutoffs import keep_fraction, latest_scores
from gridwright.session import table

#: Where each source's records and scores are.
SOURCES = {"oppadu": ("oppadu_posts", "post_id"), "stackoverflow": ("stackoverflow_collected", "question_id"), "reddit": ("reddit_collected", "submission_id")}


def _run(spark, sf_dir):
    """Each community's records are a batch of the tree."""
    batches = {source: latest_scores(table(spark, sf_dir, name), source, key) for source, (name, key) in SOURCES.items()}
    return keep_fraction(batches, table(spark, sf_dir, "keep_targets"))


def p1_found(spark, sf_dir):
    return _run(spark, sf_dir)[0].select("source", "record_id")


def p1_cutoffs(spark, sf_dir):
    return _run(spark, sf_dir)[1]


_SCORED = "WITH " + ", ".join(
    f"{source} AS (SELECT '{source}' AS source, CAST({key} AS VARCHAR) AS record_id, "
    f"max(struct_pack(a := coalesce(collected_at, -1e300), s := coalesce(CASE WHEN NOT isnan(quality_score) THEN quality_score END, -1e300))).s AS score FROM {name} WHERE {key} IS NOT NULL GROUP BY 2)"
    for source, (name, key) in SOURCES.items()
) + """, scored AS (SELECT source, record_id, score FROM (SELECT source, record_id, score FROM oppadu UNION ALL SELECT source, record_id, score FROM stackoverflow UNION ALL SELECT source, record_id, score FROM reddit) WHERE score BETWEEN 0 AND 10),
total AS (SELECT source, count(*) AS n FROM scored GROUP BY source),
steps AS (SELECT s.source, s.score, n, target_percent, count(*) AS here FROM scored s JOIN total t ON s.source = t.source JOIN keep_targets k ON k.source = s.source GROUP BY s.source, s.score, n, target_percent),
sums AS (SELECT *, sum(here) OVER (PARTITION BY source ORDER BY score DESC) AS through FROM steps),
cut AS (SELECT source, any_value(target_percent) AS target_percent, any_value(n) AS n, max(score) AS cutoff, min(through) AS kept FROM sums WHERE through * 100 >= target_percent * n GROUP BY source)
"""
QUERIES = {"p1_found": p1_found, "p1_cutoffs": p1_cutoffs}
ORACLES = {
    "p1_found": _SCORED + "SELECT s.source, s.record_id FROM scored s JOIN cut c ON s.source = c.source AND s.score >= c.cutoff",
    "p1_cutoffs": _SCORED + "SELECT source, CAST(target_percent AS DOUBLE) AS target_percent, n AS scored, cutoff, CAST(kept AS BIGINT) AS kept, CAST(kept AS DOUBLE) * 100.0 / n AS kept_percent FROM cut",
}
