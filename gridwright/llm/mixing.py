"""Mixing sources to target weights (problem 7).

Capped water-filling: each source gets its weight's share of the total; sources that would
need more than their most repetitions are clamped there and their excess goes to the others
in proportion to the weights, until nothing exceeds its cap.  A source is then taken whole
as often as fits, and of its remaining fraction the documents with the greatest seeded
hashes, up to the document that fills it: found by descending a dyadic tree of token counts
over the hashes, so a source of any size is cut to within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.bpe import BYTE_BPE, count_tokens
from gridwright.llm.dyadic import BITS, select_rank
from gridwright.session import written

#: Targets are a table of settings; more sources than this is an error, not a truncation.
MOST_SOURCES = 100_000
SEED = 20310701
#: As ``total_tokens``: the tokens of the targets' documents, each taken once.
ALL = "all"


def water_fill(weights: dict[str, float], sizes: dict[str, float], repeats: dict[str, float], total: float) -> dict[str, float]:
    """Tokens of each source: proportional to the weights, at most repeats * size.

    The total is met if the caps allow it; else every source is at its cap.
    """
    caps = {s: max(0.0, repeats[s]) * sizes.get(s, 0.0) for s in weights}
    share, active, left = dict.fromkeys(weights, 0.0), {s for s, w in weights.items() if w > 0 and caps[s] > 0}, total
    while active:
        whole = sum(weights[s] for s in active)
        over = {s for s in active if left * weights[s] / whole >= caps[s]}
        if not over:
            share |= {s: left * weights[s] / whole for s in active}
            break
        share |= {s: caps[s] for s in over}
        left -= sum(caps[s] for s in over)
        active -= over
    return share


def largest_total(weights: dict[str, float], sizes: dict[str, float], repeats: dict[str, float]) -> float:
    """The largest total at which every source that has documents gets its weight's share.

    Weights of sources without documents (or with a cap below one repetition's worth of
    anything) go to the others in proportion, as nothing else can fill them.
    """
    able = [s for s, w in weights.items() if w > 0 and repeats[s] > 0 and sizes.get(s, 0.0) > 0]
    whole = sum(weights[s] for s in able)
    return min((repeats[s] * sizes[s] * whole / weights[s] for s in able), default=0.0)


def hash_code(stage: int) -> Column:
    """BITS bits of a non-negative 63-bit hash, the stage-th group of them."""
    return F.shiftright(F.col("value"), 63 - BITS * (stage + 1)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def mix(docs: DataFrame, targets: DataFrame, total_tokens: float | str | None = None, seed: int = SEED, path: str = BYTE_BPE) -> tuple[DataFrame, DataFrame]:
    """(rows doc_id, source, n_tokens, copies; report by source) of a mixture.

    ``docs``: doc_id, source, text.  ``targets``: source, target_percent, max_repeats.
    ``total_tokens``: size of the mixture; by default the largest at which every source with
    documents has its target share.  Beyond it, capped water-filling decides (``ALL`` stands for
    the tokens of all documents once: small sources are then at their caps).
    Documents without tokens (null, empty) can't add to a share and are left out, as are those
    of sources without a target.  A null weight or cap counts as 0, weights needn't add up to
    100, and of repeated targets of one source the first in order of its columns counts.
    Repeated rows of a document are rows of their own.  Empty tables give empty results.
    Report: source, target_percent, max_repeats, docs, source_tokens, planned_tokens,
    actual_tokens, actual_percent, mean_repeats - sources without documents included.
    """
    sized = count_tokens(docs.select("doc_id", "source", "text").filter(F.col("source").isNotNull()).join(targets.select("source").distinct(), "source", "left_semi"), path=path)
    value = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 1).alias("value")
    sized = written(sized.filter("n_tokens > 0").select("doc_id", "source", "n_tokens", value), "mix-sized")
    sizes = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    wanted = targets.groupBy("source").agg(F.min(F.struct(F.coalesce(F.col("target_percent").cast("double"), F.lit(0.0)).alias("w"), F.coalesce(F.col("max_repeats").cast("double"), F.lit(0.0)).alias("m"))).alias("t"))
    rows = wanted.filter("source is not null").join(sizes, "source", "left").select("source", "t.w", "t.m", F.coalesce("tokens", F.lit(0)), F.coalesce("docs", F.lit(0))).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    size = {r[0]: float(r[3]) for r in rows}
    weights, caps = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    total = largest_total(weights, size, caps) if total_tokens is None else sum(size.values()) if total_tokens == ALL else total_tokens
    share = water_fill(weights, size, caps, total)
    plan, whole = [], {}
    for source, weight, cap, tokens, docs_n in rows:
        whole[source] = int(share[source] // tokens) if tokens else 0
        plan.append((source, weight, cap, docs_n, tokens, share[source], whole[source], share[source] - whole[source] * tokens if tokens else 0.0))
    spark = docs.sparkSession
    plan_df = spark.createDataFrame(plan, "source string, target_percent double, max_repeats double, docs bigint, source_tokens bigint, planned_tokens double, whole bigint, rest double")
    values = sized.select(F.col("source").alias("grp"), "value", F.col("n_tokens").cast("double").alias("weight"))
    cut = select_rank(values, plan_df.filter("rest > 0").select(F.col("source").alias("grp"), F.col("rest").alias("rank")), hash_code)
    # the document that crosses the mark is taken if that ends nearer to it
    cut = cut.select(F.col("grp").alias("source"), F.col("value").alias("mark"), (F.col("through") - F.col("rank") <= F.col("rank") - F.col("above")).alias("take"))
    steps = written(plan_df.join(cut, "source", "left"), "mix-plan")
    more = F.when(F.col("mark").isNull(), 0).when(F.col("value") > F.col("mark"), 1).when((F.col("value") == F.col("mark")) & F.col("take"), 1).otherwise(0)
    rows_out = sized.join(steps.select("source", "whole", "mark", "take"), "source").select("doc_id", "source", "n_tokens", (F.col("whole") + more).cast("int").alias("copies")).filter("copies > 0")
    actual = rows_out.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("actual_tokens"))
    report = steps.join(actual, "source", "left").withColumn("actual_tokens", F.coalesce("actual_tokens", F.lit(0)))
    everything = report.agg(F.sum("actual_tokens").alias("_all"))
    percent, repeats = F.expr("try_divide(100.0D * actual_tokens, _all)"), F.expr("try_divide(actual_tokens, source_tokens)")
    report = report.join(everything).select("source", "target_percent", "max_repeats", "docs", "source_tokens", "planned_tokens", "actual_tokens", percent.alias("actual_percent"), repeats.alias("mean_repeats"))
    return rows_out, report
