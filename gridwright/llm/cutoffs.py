"""Score cutoffs that keep a target fraction of each source (problem 1).

A persistent dyadic count tree over integer-coded scores (:mod:`gridwright.llm.dyadic`) gives
each source's cutoff: a batch adds the node counts and the leaves' distinct scores of its
records, the tree is walked to the target rank, and the leaf found there is refined to its
distinct scores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.dyadic import BITS, TreeStore, select_rank
from gridwright.session import scratch_path, written

LOWEST, HIGHEST = 0.0, 10.0


def latest_scores(table: DataFrame, source: str, key: str) -> DataFrame:
    """(source, record_id, score) of the latest row of each key, if that row is scored.

    A key's latest row has the greatest ``collected_at``; null and NaN stamps come before
    all others, and of rows with the same stamp the one with the greatest score counts (one
    without a score last).  A record is scored if its score is a number from 0 to 10.  Rows
    without a key are no records.  Repeated rows and an empty table need no special case;
    other columns are ignored, whatever their names.
    """
    at, score = F.col("collected_at").cast("double"), F.col("quality_score").cast("double")
    real = lambda c: F.when(~F.isnan(c), c)
    rows = table.select(F.col(key).cast("string").alias("record_id"), real(at).alias("at"), real(score).alias("score")).filter("record_id is not null")
    last = rows.groupBy("record_id").agg(F.max(F.struct("at", "score")).alias("last"))
    scored = last.select(F.lit(source).alias("source"), "record_id", (F.col("last.score") + F.lit(0.0)).alias("score"))
    return scored.filter(F.col("score").between(LOWEST, HIGHEST))


def score_code(stage: int) -> Column:
    """BITS bits of the score's place between 0 and 10, the stage-th group of them."""
    place = F.col("value") / F.lit(HIGHEST)
    for _ in range(stage + 1):
        scaled = place * F.lit(float(1 << BITS))
        digit = F.least(F.floor(scaled), F.lit((1 << BITS) - 1))
        place = scaled - digit
    return digit.cast("int")


class CutoffTree:
    """The count tree of all sources, kept in ``path`` and fed batch by batch."""

    def __init__(self, spark, path: str | None = None):
        self.store = TreeStore(spark, path or scratch_path(spark, "cutoff-tree"))

    def add(self, batch: str, scored: DataFrame, replaced: DataFrame | None = None) -> None:
        """Add a batch's scored records; ``replaced`` are earlier ones that they supersede."""
        rows = _values(scored)
        if replaced is not None:
            rows = rows.unionByName(_values(replaced).withColumn("weight", -F.col("weight")))
        self.store.add(batch, rows, score_code(0))

    def cutoffs(self, targets: DataFrame) -> DataFrame:
        """source, target_percent, scored, cutoff, kept, kept_percent, from the tree alone.

        A source with no scored record, a null or non-positive target has no cutoff and gives no row; a target above
        100 keeps all.  Of repeated targets of a source the greatest counts.
        """
        wanted = targets.select(F.col("source").alias("grp"), F.col("target_percent").cast("decimal(18,6)").alias("percent")).filter("grp is not null and percent > 0").groupBy("grp").agg(F.max("percent").alias("percent"))
        total = self.store.nodes().filter("level = 0").select("grp", F.col("weight").cast("bigint").alias("n"))
        ranks = written(wanted.join(total, "grp").select("grp", "percent", "n", F.least(F.ceil(F.col("percent") * F.col("n") / 100), F.col("n")).cast("double").alias("rank")), "cutoff-ranks")
        found = select_rank(self.store, ranks, score_code)
        kept = F.col("through").cast("bigint")
        return ranks.drop("rank").join(found, "grp").select(F.col("grp").alias("source"), F.col("percent").cast("double").alias("target_percent"), F.col("n").alias("scored"), F.col("value").alias("cutoff"), kept.alias("kept"), (kept * 100.0 / F.col("n")).alias("kept_percent"))


def _values(scored: DataFrame) -> DataFrame:
    return scored.select(F.col("source").alias("grp"), F.col("score").alias("value"), F.lit(1.0).alias("weight"))


def keep_fraction(batches: dict[str, DataFrame], targets: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept records, cutoff report) of the scored records of several batches, which are added
    to the tree in ``path`` one after the other."""
    parts, tree = [], None
    for name, batch in batches.items():
        tree = tree or CutoffTree(batch.sparkSession, path)
        parts.append(written(batch, "scored"))
        tree.add(name, parts[-1])
    report = written(tree.cutoffs(targets), "cutoffs")
    scored = reduce(lambda a, b: a.unionByName(b), parts)
    kept = scored.join(report.select("source", "cutoff"), "source").filter(F.col("score") >= F.col("cutoff"))
    return kept.select("source", "record_id", "score"), report
