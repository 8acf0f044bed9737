"""Copies of one text, as many as a third of all rows, change no result."""

import pytest
from pyspark.sql import functions as F

from gridwright.llm.queries_p3 import p3_found
from gridwright.llm.queries_p4 import p4_found

DATA = "/root/testdata/sf0.001"


def with_copies(spark, folder, text):
    """The test data's pairs, and half as many more rows whose answer is ``text``."""
    pairs = spark.read.parquet(f"{DATA}/qa_pairs.parquet")
    more = pairs.limit(pairs.count() // 2).withColumn("pair_id", F.monotonically_increasing_id() + 10**12).withColumn("answer", F.col("answer").withField("text", F.lit(text)).withField("body_markdown", F.lit(None).cast("string")))
    pairs.unionByName(more).write.parquet(f"{folder}/qa_pairs.parquet")
    spark.read.parquet(f"{DATA}/oppadu_posts.parquet").limit(20).write.parquet(f"{folder}/oppadu_posts.parquet")
    return more.count()


@pytest.mark.parametrize("text", ["<html><head><title>502 Bad Gateway</title></head><body><hr>web/1.2</body></html>", "502 Bad Gateway"])
def test_copies_of_residue_are_found(spark, tmp_path, text):
    copies = with_copies(spark, tmp_path, text)
    found = p3_found(spark, str(tmp_path)).filter("record_table = 'qa_pairs' and cast(record_id as bigint) >= 1000000000000").count()
    assert copies > 50 and found == copies


def test_copies_of_a_refusal_are_found(spark, tmp_path):
    copies = with_copies(spark, tmp_path, "I'm sorry, but I can't help with this request. Thank you for understanding.")
    assert p4_found(spark, str(tmp_path)).filter("pair_id >= 1000000000000 and defect = 'refusal'").count() == copies
