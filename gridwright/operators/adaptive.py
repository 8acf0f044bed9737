"""Ordered folds and keyed state with expiry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def adaptive_threshold(df: DataFrame, by: str, order: str, success: Column, start: float = 0.7, window: int = 10) -> DataFrame:
    """Threshold after each event: down by .05 (to .5) while the last ten succeed less than half
    the time, up by .02 (to .95) while they do so more than four times in five.

    The rate is a window; the clamped steps are then folded in order.  A step maps a threshold t
    to min(hi, max(lo, t + d)), and such maps compose to one of the same form.  So the events of
    BLOCK consecutive places of ``order`` (an integer, unique per entity) become one map, and an
    entity's few maps are applied in order: no entity's events are ever gathered in one place.
    """
    last = W.partitionBy(by).orderBy(order).rowsBetween(-(window - 1), 0)
    rate = F.when(F.count(F.lit(1)).over(last) >= window, F.avg(success.cast("int")).over(last))
    step = F.when(rate < 0.5, -0.05).when(rate > 0.8, 0.02).otherwise(0.0)
    events = df.select(by, F.col(order).alias("k"), step.alias("d")).select(by, F.floor(F.col("k") / BLOCK).alias("block"), F.struct("k", "d", F.when(F.col("d") < 0, 0.5).otherwise(-FAR).alias("lo"), F.when(F.col("d") > 0, 0.95).otherwise(FAR).alias("hi")).alias("e"))
    blocks = events.groupBy(by, "block").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("e")).alias("es"))
    maps = blocks.select(by, "n", _compose("es").alias("m"), "block").select(by, "n", F.struct(F.col("block").alias("k"), "m.d", "m.lo", "m.hi").alias("e"))
    whole = maps.groupBy(by).agg(F.sum("n").alias("events"), F.array_sort(F.collect_list("e")).alias("es")).select(by, "events", _compose("es").alias("m"))
    return whole.select(by, "events", F.round(_clamp(F.lit(start) + F.col("m.d"), F.col("m.lo"), F.col("m.hi")), 6).alias("threshold"))


#: Places of an order that are folded together, and a bound beyond any threshold.
BLOCK, FAR = 4096, 1e9


def _clamp(t: Column, lo: Column, hi: Column) -> Column:
    return F.least(hi, F.greatest(lo, t))


def _compose(steps: str) -> Column:
    """One map for an array of maps (d, lo, hi), applied in order."""
    same = F.struct(F.lit(0.0).alias("d"), F.lit(-FAR).alias("lo"), F.lit(FAR).alias("hi"))
    return F.aggregate(steps, same, lambda m, e: F.struct((m["d"] + e["d"]).alias("d"), _clamp(m["lo"] + e["d"], e["lo"], e["hi"]).alias("lo"), _clamp(m["hi"] + e["d"], e["lo"], e["hi"]).alias("hi")))


def expiring_counts(stream: DataFrame, key: str, at: str, ttl: str, ttl_ms: int) -> DataFrame:
    """Events of each key since its last silence of ``ttl``: keyed state that expires by event
    time, so a run over what is there ends, and a replay gives the same."""

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, last = state.get if state.exists else (0, 0)
        for batch in batches:
            n += len(batch)
            last = max(last, int(batch[at].max().timestamp() * 1000))
        state.update((n, last))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + ttl_ms)
        yield pd.DataFrame({"key": [k[0]], "n": [n]})

    kind = stream.schema[key].dataType.simpleString()
    rows = stream.withWatermark(at, ttl).groupBy(key)
    return rows.applyInPandasWithState(run, f"key {kind}, n bigint", "n bigint, last bigint", "update", GroupStateTimeout.EventTimeTimeout)
