"""Weighted ranks over whole tables by descending a tree of dyadic counts.

Values get an integer code of ``BITS`` bits per stage.  A node of level l is a prefix of l
bits and holds the weight of all values below it; a group's tree has at most
2 ** (BITS + 1) nodes, whatever the table's size, so one task can walk it.  Trees are sums:
a batch adds its node weights (negative ones take replaced rows back), and any rank of any
group can then be found from the nodes alone.  A batch also adds the distinct values of its
leaves with their weights, so of the one leaf that holds a rank only these are looked at - by
a further stage of codes if it still holds more than ``LEAF_VALUES`` of them.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridwright.session import written

BITS = 12
#: Stages of codes; 5 * 12 bits tell any two doubles or hashes apart but for the last bits.
STAGES = 5
#: Most distinct values of a leaf that are ranked in one task.
LEAF_VALUES = 1 << 14

NODE_SCHEMA = "grp string, level int, node int, weight double"


def node_weights(values: DataFrame, code: Column) -> DataFrame:
    """Weights of all nodes, root to leaves, of rows (grp, weight) with a code.

    Rows are added up per leaf before anything is exchanged, so a hot group or a hot value
    sends one row per task; the levels are spread out only after that.
    """
    leaves = values.groupBy("grp", code.cast("int").alias("leaf")).agg(F.sum("weight").cast("double").alias("weight"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(BITS))).alias("level")
    spread = leaves.select("grp", "leaf", "weight", levels)
    return spread.groupBy("grp", "level", F.expr(f"shiftright(leaf, {BITS} - level)").alias("node")).agg(F.sum("weight").alias("weight"))


class TreeStore:
    """A tree kept as Parquet: ``nodes``, and the distinct ``values`` of the leaves, each with a
    folder per batch; adding a batch again replaces it.  Values are any one ordered type."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, batch: str, values: DataFrame, code: Column) -> None:
        """Add the rows (grp, value, weight) of a batch, coded by the first stage's ``code``."""
        leaves = values.groupBy("grp", code.cast("int").alias("leaf"), "value").agg(F.sum("weight").cast("double").alias("weight"))
        leaves.sortWithinPartitions("grp", "leaf").write.mode("overwrite").parquet(f"{self.path}/values/batch={batch}")
        kept = self.spark.read.parquet(f"{self.path}/values/batch={batch}")
        node_weights(kept, F.col("leaf")).select("grp", "level", "node", "weight").write.mode("overwrite").parquet(f"{self.path}/nodes/batch={batch}")

    def nodes(self) -> DataFrame:
        stored = self.spark.read.schema(NODE_SCHEMA + ", batch string").parquet(f"{self.path}/nodes")
        return stored.groupBy("grp", "level", "node").agg(F.sum("weight").alias("weight"))

    def values(self) -> DataFrame:
        """(grp, leaf, value, weight) of all batches; weights that were taken back leave zeros."""
        return self.spark.read.parquet(f"{self.path}/values").drop("batch")

    def compacted(self, path: str) -> TreeStore:
        """The same tree as one batch in a new folder; this one stays as it is."""
        self.nodes().filter("weight <> 0").write.parquet(f"{path}/nodes/batch=all")
        sums = self.values().groupBy("grp", "leaf", "value").agg(F.sum("weight").alias("weight")).filter("weight <> 0")
        sums.sortWithinPartitions("grp", "leaf").write.parquet(f"{path}/values/batch=all")
        return TreeStore(self.spark, path)


def _walk(nodes: pd.DataFrame, ranks: pd.DataFrame) -> pd.DataFrame:
    """The leaf of each rank, counted from the top, and the weight above that leaf."""
    found = []
    if len(nodes):
        weight = {(level, node): w for level, node, w in zip(nodes["level"], nodes["node"], nodes["weight"], strict=True)}
        for group, rank in zip(ranks["grp"], ranks["rank"], strict=True):
            if not 0 < rank <= weight.get((0, 0), 0.0):
                continue
            node, above = 0, 0.0
            for level in range(1, BITS + 1):
                upper = weight.get((level, 2 * node + 1), 0.0)
                if rank - above <= upper:
                    node = 2 * node + 1
                else:
                    node, above = 2 * node, above + upper
            found.append((group, rank, node, above))
    return pd.DataFrame(found, columns=["grp", "rank", "leaf", "above"])


def descend(nodes: DataFrame, ranks: DataFrame) -> DataFrame:
    """(grp, rank, leaf, above) of each group's rank; ranks outside a tree give no row."""
    left = nodes.select("grp", "level", "node", "weight").groupBy("grp")
    right = ranks.select("grp", F.col("rank").cast("double").alias("rank")).groupBy("grp")
    return left.cogroup(right).applyInPandas(_walk, "grp string, rank double, leaf int, above double")


def select_rank(values: DataFrame | TreeStore, ranks: DataFrame, code: Callable[[int], Column]) -> DataFrame:
    """The value at a weighted rank from the top of each group.

    ``values``: rows grp STRING, value, weight, or a stored tree, of which only the nodes and the
    leaves of the ranks are read.  ``ranks``: grp, rank (at most one a group).
    ``code(stage)``: the value's bits of that stage as an int, monotone in the value.
    Result: grp, rank, value, above (weight of greater values), through (above plus the value's).
    """
    stored = isinstance(values, TreeStore)
    frame, nodes = (values.values(), values.nodes()) if stored else (values, node_weights(values, code(0)))
    base = F.lit(0.0)
    for stage in range(STAGES):
        place = written(descend(nodes, ranks).withColumnRenamed("rank", "_r"), f"dyadic-place{stage}")
        if stored and not stage:
            inside = frame.join(place.select("grp", "leaf"), ["grp", "leaf"], "left_semi")
        else:
            inside = frame.join(place.select("grp", "leaf"), "grp").filter(code(stage) == F.col("leaf"))
        distinct = inside.groupBy("grp", "value").agg(F.sum("weight").cast("double").alias("weight")).filter("weight <> 0")
        frame = written(distinct, f"dyadic-leaf{stage}")
        ranks_in = place.select("grp", (F.col("_r") - F.col("above")).alias("rank"), F.col("above").alias("_above"))
        if stage:
            ranks_in = ranks_in.join(outer, "grp").select("grp", "rank", (F.col("_above") + F.col("_outer")).alias("_above"))  # noqa: F821
        outer = written(ranks_in, f"dyadic-rank{stage}").select("grp", F.col("rank").alias("_in"), F.col("_above").alias("_outer"))
        largest = frame.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
        if largest <= LEAF_VALUES:
            break
        ranks, nodes = outer.select("grp", F.col("_in").alias("rank")), node_weights(frame, code(stage + 1))
    down = W.partitionBy("grp").orderBy(F.desc("value")).rowsBetween(W.unboundedPreceding, 0)
    ranked = frame.withColumn("_through", F.sum("weight").over(down)).join(outer, "grp")
    hit = ranked.filter((F.col("_through") >= F.col("_in")) & (F.col("_through") - F.col("weight") < F.col("_in")))
    above = base + F.col("_outer") + F.col("_through") - F.col("weight")
    return hit.select("grp", (F.col("_outer") + F.col("_in")).alias("rank"), "value", above.alias("above"), (F.col("_outer") + F.col("_through")).alias("through"))
