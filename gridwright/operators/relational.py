"""Relational operators shared by the plans: latest row, best of group, known keys, paging."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Upsert by primary key: the greatest row of each key in the order given (null first).

    One aggregation with map-side combine; no window, so a hot key sends one row a task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def best_of_group(df: DataFrame, group: Sequence[str], score: str, tie: str) -> DataFrame:
    """Keep each group's row of the greatest score, the least ``tie`` among equals."""
    rest = [c for c in df.columns if c not in group]
    key = F.struct(F.col(score).isNotNull(), F.col(score), -F.col(tie).cast("double"))
    return df.groupBy(*group).agg(F.max_by(F.struct(*rest), key).alias("_row")).select(*group, *[F.col(f"_row.{c}").alias(c) for c in rest])


def previous_in_group(df: DataFrame, group: str, key: str, name: str, block: int = 65536) -> DataFrame:
    """``name``: the greatest lesser ``key`` (integers, unique) of each row's group; null for the first.

    Windows are over ``block`` consecutive keys of a group, so a hot group is spread over many
    tasks; a block's first row gets the last key of the block before, of which a group has one
    row a block.
    """
    rows = df.withColumn("_block", F.floor(F.col(key) / block))
    last = rows.groupBy(group, "_block").agg(F.max(key).alias("_last"))
    last = last.select(group, "_block", F.lag("_last").over(W.partitionBy(group).orderBy("_block")).alias("_before"))
    inside = F.lag(key).over(W.partitionBy(group, "_block").orderBy(key))
    return rows.withColumn(name, inside).join(last, [group, "_block"]).select(*df.columns, F.coalesce(name, "_before").alias(name))


def over_last_rows(df: DataFrame, group: str, order: str, n: int, named: dict[str, Callable[[WindowSpec], Column]], block: int = 65536) -> DataFrame:
    """``df`` with columns over each row and its ``n`` - 1 predecessors in the group, by ``order``
    (integers, unique in the group).

    Rows get their place in the group from counts of blocks of ``order``, a row a block; windows
    are then over ``block`` consecutive places, each block's last n - 1 rows going along to
    the next one.  So a group of any size is spread over many tasks.
    """
    size = max(block, n)
    rows = df.withColumn("_block", F.floor(F.col(order) / block))
    counts = rows.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(group, "_block", (F.sum("_n").over(W.partitionBy(group).orderBy("_block")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(W.partitionBy(group, "_block").orderBy(order)) - 1
    same = F.col(f"r.{group}").eqNullSafe(F.col(f"c.{group}")) & (F.col("r._block") == F.col("c._block"))
    placed = rows.withColumn("_place", place).alias("r").join(counts.alias("c"), same).select("r.*", (F.col("c._before") + F.col("r._place")).alias("_at"))
    home = F.floor(F.col("_at") / size)
    dealt = placed.withColumn("_home", home).withColumn("_part", F.explode(F.when(F.col("_at") % size > size - n, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
    last = W.partitionBy(group, "_part").orderBy("_at").rowsBetween(-(n - 1), 0)
    return dealt.withColumns({name: make(last) for name, make in named.items()}).filter("_part = _home").select(*df.columns, *named)


def not_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not collected yet; rows without a key are skipped, as by lookup."""
    return df.filter(F.col(key).isNotNull()).join(known.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def keyset_page(df: DataFrame, key: str, after: int, size: int) -> DataFrame:
    """The next page after a key: a pushed filter and a TakeOrdered, whatever the offset."""
    return df.filter(F.col(key) > after).orderBy(key).limit(size)


def min_max(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``<c>_norm`` in [0, 1] per batch; all-equal columns and batches of one row give 1.

    The batch's extremes are aggregated and joined back (few rows), instead of a window that
    would gather a whole batch in one task.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        aggs += [F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}")]
    ends = df.groupBy(*by).agg(*aggs)
    joined = df.join(ends, list(by))
    norm = {f"{c}_norm": F.when((F.col("_n") <= 1) | (F.col(f"_hi_{c}") == F.col(f"_lo_{c}")), F.lit(1.0)).otherwise((F.col(c) - F.col(f"_lo_{c}")) / (F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))) for c in columns}
    return joined.withColumns(norm).select(*df.columns, *norm)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def describe(column: str, prefix: str = "") -> list[Column]:
    """n, mean, median, min, max and population deviation of a column."""
    c = F.col(column)
    return [F.count(c).alias(prefix + "n"), F.round(F.avg(c), 6).alias(prefix + "mean"), F.round(F.percentile(c, F.lit(0.5)), 6).alias(prefix + "median"), F.min(c).alias(prefix + "least"), F.max(c).alias(prefix + "most"), F.round(F.stddev_pop(c), 6).alias(prefix + "deviation")]


def exact_quantile(df: DataFrame, by: Sequence[str], value: str, quantiles: dict[str, tuple[int, int]]) -> DataFrame:
    """Quantiles by the exclusive method (p * (n + 1), straight between neighbours, clamped).

    ``quantiles``: name -> (numerator, denominator).  Groups of one value give that value.
    Equal values are counted before they are ranked, so only distinct values are sorted.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    down = W.partitionBy(*by).orderBy("_v")
    ranked = counts.withColumn("_hi", F.sum("_c").over(down.rowsBetween(W.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(W.partitionBy(*by)))
    aggs = []
    for name, (a, b) in quantiles.items():
        j = F.greatest(F.lit(1), F.least(F.floor(F.col("_n") * a / F.lit(b) + F.lit(a) / F.lit(b)), F.col("_n") - 1))
        holds = lambda k: (F.col("_hi") >= k) & (F.col("_hi") - F.col("_c") < k)
        low, high = F.max(F.when(holds(j), F.col("_v"))), F.max(F.when(holds(j + 1), F.col("_v")))
        delta = F.max((F.col("_n") + 1) * a / F.lit(b) - j)
        aggs.append(F.coalesce(low + (high - low) * delta, low, F.max("_v")).alias(name))
    return ranked.groupBy(*by).agg(*aggs)


def nearest_rank(df: DataFrame, by: Sequence[str], value: str, percent: dict[str, float]) -> DataFrame:
    """sorted[min(int(p / 100 * n), n - 1)] of each group, from counts of distinct values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranked = counts.withColumn("_hi", F.sum("_c").over(W.partitionBy(*by).orderBy("_v").rowsBetween(W.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(W.partitionBy(*by)))
    aggs = []
    for name, p in percent.items():
        k = F.least(F.floor(F.col("_n") * (p / 100.0)), F.col("_n") - 1) + 1
        aggs.append(F.max(F.when((F.col("_hi") >= k) & (F.col("_hi") - F.col("_c") < k), F.col("_v"))).alias(name))
    return ranked.groupBy(*by).agg(*aggs)


def bounded_history(by: Sequence[str], order: Sequence[str], size: int) -> W:
    """The last ``size`` events of an entity up to the current one."""
    return W.partitionBy(*by).orderBy(*order).rowsBetween(-(size - 1), 0)
