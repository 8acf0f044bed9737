"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.llm.residue import ResidueModel, answer_text, find_residue, natural_counts
from gridwright.session import spread, table


def residue_records(spark, sf_dir):
    """record_table, record_id, residue, cover, placeholders of every answer and title."""
    answers = table(spark, sf_dir, "qa_pairs").select(F.lit("qa_pairs").alias("record_table"), F.col("pair_id").cast("string").alias("record_id"), answer_text().alias("text"))
    titles = table(spark, sf_dir, "oppadu_posts").select(F.lit("oppadu_posts").alias("record_table"), F.col("post_id").cast("string").alias("record_id"), F.col("title").alias("text"))
    records = spread(answers).unionByName(spread(titles))
    return find_residue(records, ResidueModel(natural_counts(records.select("text"))))


def p3_found(spark, sf_dir):
    return residue_records(spark, sf_dir).filter("residue and record_id is not null").select("record_table", "record_id").distinct()


def p3_clean(spark, sf_dir):
    """What stays: records of which no row is residue, with their share of residue windows."""
    judged = residue_records(spark, sf_dir).groupBy("record_table", "record_id").agg(F.bool_or("residue").alias("residue"), F.round(F.max("cover"), 6).alias("cover"))
    return judged.filter("not residue").select("record_table", "record_id", "cover")


QUERIES = {"p3_found": p3_found, "p3_clean": p3_clean}
ORACLES: dict = {}
