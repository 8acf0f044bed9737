"""Rolling totals and averages over trailing periods, by binary doubling.

Daily totals of each entity are laid on a calendar without gaps.  From them come blocks of
2, 4, 8, 16, ... days, each the sum of the block half as long and of that same block shifted
back by its length.  Any window is then a sum of disjoint blocks, one for each bit of its
length: 7 = 4 + 2 + 1 and 30 = 16 + 8 + 4 + 2.  All shifts run over one partitioning and one
order, so the whole chain costs one exchange and one sort, and every row is touched
O(log window) times, whatever the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridwright.functions.instants import instant, utc_day

#: Measures are added as decimals of 12 places.
EXACT, TOTAL = "decimal(28,12)", "decimal(38,12)"


def distinct_records(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the least in the order of the other columns, so the choice is
    defined where repeats differ.  Rows without a key can't be matched and all stay."""
    rest = [c for c in df.columns if c != key]
    one = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(*[F.col("_r")[c].alias(c) for c in rest])
    return one.unionByName(df.filter(F.col(key).isNull()).select(*rest))


def daily_totals(rows: DataFrame, measures: int) -> DataFrame:
    """Entity, day, records, and of each measure the sum and the number of values.

    Sums are decimal, so they don't depend on the order of the rows and cancel exactly.  Null,
    NaN and infinite values count neither in a sum nor in a number.  The aggregation is
    partial before the exchange, so a hot entity sends at most one row per day and task.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for k in range(measures):
        aggs += [F.coalesce(F.sum(f"_m{k}"), F.lit(0).cast(EXACT)).cast(TOTAL).alias(f"_s{k}"), F.count(f"_m{k}").alias(f"_c{k}")]
    return rows.groupBy("_entity", "_day").agg(*aggs)


def on_calendar(daily: DataFrame) -> DataFrame:
    """Every day from an entity's first to its last, with zeros where it has no record.

    Each row knows the entity's next day with a record, so a gap is spread out in place:
    no second scan and no join with a calendar table.
    """
    order = W.partitionBy("_entity").orderBy("_day")
    nxt = F.coalesce(F.lead("_day").over(order), F.date_add("_day", 1))
    filled = daily.withColumn("_next", nxt).withColumn("_on", F.explode(F.sequence("_day", F.date_sub("_next", 1))))
    real = F.col("_on") == F.col("_day")
    numbers = [c for c in daily.columns if c not in ("_entity", "_day")]
    zero = lambda c: F.when(real, F.col(c)).otherwise(F.lit(0).cast(daily.schema[c].dataType)).alias(c)
    return filled.select("_entity", F.col("_on").alias("_day"), *[zero(c) for c in numbers])


def block_sums(calendar: DataFrame, columns: Sequence[str], window: int) -> DataFrame:
    """Columns ``<c>_b<k>``: sums over the 2**k days that end at the row's day."""
    order = W.partitionBy("_entity").orderBy("_day")
    out, size, k = calendar.withColumns({f"{c}_b0": F.col(c) for c in columns}), 1, 0
    while size * 2 <= window:
        shifted = {f"{c}_b{k + 1}": (F.col(f"{c}_b{k}") + F.coalesce(F.lag(f"{c}_b{k}", size).over(order), F.lit(0))).cast(calendar.schema[c].dataType) for c in columns}
        out, size, k = out.withColumns(shifted), size * 2, k + 1
    return out


def window_sum(column: str, window: int) -> Column:
    """The sum over a window from its blocks, largest first, each shifted past the last."""
    order, total, back = W.partitionBy("_entity").orderBy("_day"), None, 0
    for k in reversed(range(window.bit_length())):
        if window >> k & 1:
            block = F.col(f"{column}_b{k}") if not back else F.coalesce(F.lag(f"{column}_b{k}", back).over(order), F.lit(0))
            total, back = block if total is None else total + block, back + (1 << k)
    return total.cast("double") if column.startswith("_s") else total


def rolling_totals(df: DataFrame, entity: str, day: Column, measures: Sequence[str], windows: Sequence[int] = (7, 30), key: str | None = None) -> DataFrame:
    """Trailing totals and averages for each entity and each day of its calendar.

    Result: ``entity``, ``usage_day`` (DATE), ``records`` of the day, and for each measure m
    and window w ``m_total_w``, ``m_avg_w`` (per record with a value; null if there is none)
    and ``m_daily_w`` (total / w).  Days before an entity's first record count as zero.

    Nulls: a row without entity, without a day, counts nowhere; a null measure is left out of
    that measure.  Repeated rows of one ``key`` count once.  An empty table gives no rows.
    Extra columns are ignored, whatever their names.
    """
    parts = [F.col(entity).alias("_entity"), day.alias("_day"), *[F.col(m).try_cast(EXACT).alias(f"_m{k}") for k, m in enumerate(measures)]]
    # projected before the exchange by key, which then moves a day instead of a stamp's text
    rows = df.select(*parts, *([F.col(key).alias("_key")] if key else []))
    rows = distinct_records(rows, "_key") if key else rows
    calendar = on_calendar(daily_totals(rows.filter("_entity is not null and _day is not null"), len(measures)))
    numbers = [f"{p}{k}" for k, _ in enumerate(measures) for p in ("_s", "_c")]
    blocks = block_sums(calendar, numbers, max(windows))
    # every window's shifts at once, so that they share the one sort
    sums = blocks.withColumns({f"{c}_w{w}": window_sum(c, w) for w in windows for c in numbers})
    out = [F.col("_entity").alias(entity), F.col("_day").alias("usage_day"), F.col("_n").alias("records")]
    for w in windows:
        for k, m in enumerate(measures):
            total, count = F.col(f"_s{k}_w{w}"), F.col(f"_c{k}_w{w}")
            out += [total.alias(f"{m}_total_{w}"), F.when(count > 0, total / count).alias(f"{m}_avg_{w}"), (total / w).alias(f"{m}_daily_{w}")]
    return sums.select(*out)


def usage_rolling(usage: DataFrame, windows: Sequence[int] = (7, 30)) -> DataFrame:
    """:func:`rolling_totals` of usage records per model and UTC day."""
    return rolling_totals(usage, "model", utc_day(instant(F.col("timestamp"))), ["cost_usd", "tokens"], windows, key="id")
