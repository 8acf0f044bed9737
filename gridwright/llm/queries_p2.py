"""Queries of problem 2."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from gridwright.llm.history import HistoryIndex, record_key
from gridwright.session import table

HISTORY = {"stackoverflow": ("stackoverflow_collected", "question_id"), "reddit": ("reddit_collected", "submission_id"), "oppadu": ("oppadu_collected", "post_id")}


def accepted(spark, sf_dir):
    """source, key, title of everything accepted so far."""
    parts = []
    for source, (name, key) in HISTORY.items():
        origin = F.lit(source)
        parts.append(table(spark, sf_dir, name).select(origin.alias("source"), record_key(origin, F.col(key)).alias("key"), "title"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def incoming(spark, sf_dir):
    items = table(spark, sf_dir, "incoming_items")
    source = F.lower(F.trim("source"))
    return items.select(source.alias("source"), F.col("item_id").alias("ord"), record_key(source, F.col("external_id")).alias("key"), "title")


def p2_found(spark, sf_dir):
    """All batches of incoming items at once: each item is compared with history and with all
    items of smaller id, which is what checking batch after batch compares it with."""
    index = HistoryIndex(spark).build(accepted(spark, sf_dir))
    return index.check(incoming(spark, sf_dir), "incoming").select(F.col("ord").alias("item_id"))


def _in_batches(spark, sf_dir, count=3):
    """Items of each of ``count`` runs of batches, in order, checked and appended one after the
    other to the stored index, which each run opens anew; (run, index, items, repeats)."""
    items = table(spark, sf_dir, "incoming_items")
    ends = items.agg(F.min("item_id"), F.max("item_id")).first()
    path = HistoryIndex(spark).build(accepted(spark, sf_dir)).path
    rows = incoming(spark, sf_dir)
    if ends[0] is None:
        return [(0, HistoryIndex.open(spark, path), rows, rows.select("ord"))]
    step = -(-(ends[1] - ends[0] + 1) // count)
    out = []
    for run in range(count):
        first = ends[0] + run * step
        part = rows.filter(F.col("ord").between(first, first + step - 1))
        index = HistoryIndex.open(spark, path)
        out.append((run, index, part, index.check(part, f"run{run}")))
    return out


def p2_batches(spark, sf_dir):
    """The rows of p2_found from three runs of batches against the stored and growing index."""
    found = [found.select(F.col("ord").alias("item_id")) for *_, found in _in_batches(spark, sf_dir)]
    return reduce(lambda a, b: a.unionByName(b), found)


def p2_batch_reads(spark, sf_dir):
    """Of each run: items, repeats, folders of the index, those read, and rows taken from them."""
    rows = []
    for run, index, part, found in _in_batches(spark, sf_dir):
        read = index.read
        rows.append((run, part.count(), found.count(), index.buckets, *(read.get(name, (0, 0))[k] for name in ("keys", "cells", "titles") for k in (0, 1))))
    return spark.createDataFrame(rows, "run int, items bigint, repeats bigint, folders int, key_folders int, key_rows bigint, cell_folders int, cell_rows bigint, title_folders int, title_rows bigint")


QUERIES = {"p2_found": p2_found, "p2_batches": p2_batches, "p2_batch_reads": p2_batch_reads}
ORACLES: dict = {}
