"""Usage accounting: roll-ups, percentiles, sliding rates, retention, exports."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridwright.operators.relational import bounded_history, describe, exact_quantile, latest_by_key, nearest_rank, over_last_rows, previous_in_group, ratio
from gridwright.plans.common import USAGE, usage
from gridwright.session import table

U = "WITH " + USAGE
MONEY = "decimal(28,12)"
COST_SQL = "CAST(coalesce(sum(CAST(cost_usd AS DECIMAL(28,12))), 0) AS DOUBLE)"


def cost():
    """Exact sum of costs, as a double."""
    return F.coalesce(F.sum(F.col("cost_usd").cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")


def totals():
    return [F.count(F.lit(1)).alias("records"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), cost().alias("cost")]


TOTALS_SQL = f"count(*) AS records, CAST(coalesce(sum(tokens), 0) AS BIGINT) AS tokens, {COST_SQL} AS cost"


def a13_usage_daily(spark, sf):
    """Totals of each day."""
    return usage(spark, sf).filter("happened is not null").groupBy(F.date_format("happened", "yyyy-MM-dd").alias("day")).agg(*totals())


def a13_usage_by_model(spark, sf):
    return usage(spark, sf).groupBy("model").agg(*totals())


def a13_usage_by_source(spark, sf):
    return usage(spark, sf).groupBy("source").agg(*totals())


def a13_usage_by_hour(spark, sf):
    return usage(spark, sf).filter("happened is not null").groupBy(F.hour("happened").alias("hour")).agg(*totals())


def a13_usage_grouping_sets(spark, sf):
    """By model, by source and in total in one pass over the facts."""
    usage(spark, sf).createOrReplaceTempView("gw_usage")
    return spark.sql(f"""SELECT model, source, grouping(model) AS all_models, grouping(source) AS all_sources, count(*) AS records, coalesce(sum(tokens), 0) AS tokens, CAST(coalesce(sum(CAST(cost_usd AS {MONEY})), 0) AS DOUBLE) AS cost
        FROM gw_usage GROUP BY GROUPING SETS ((model), (source), ())""")


def a14_usage_monthly(spark, sf):
    """Days of a month and the month's total (day null)."""
    rows = usage(spark, sf).filter("happened is not null").withColumns({"month": F.date_format("happened", "yyyy-MM"), "day": F.date_format("happened", "yyyy-MM-dd")})
    return rows.rollup("month", "day").agg(*totals()).filter("month is not null")


def a15_cost_projection(spark, sf):
    """Average, least and most of the daily sums, and the projection to 30 days."""
    daily = usage(spark, sf).filter("happened is not null").groupBy(F.date_format("happened", "yyyy-MM-dd").alias("day")).agg(F.sum(F.col("cost_usd").cast(MONEY)).alias("c"))
    mean = F.coalesce(F.avg(F.col("c").cast("double")), F.lit(0.0))
    return daily.agg(F.count("c").alias("days"), F.round(mean, 6).alias("mean"), F.coalesce(F.min("c").cast("double"), F.lit(0.0)).alias("least"), F.coalesce(F.max("c").cast("double"), F.lit(0.0)).alias("most"), F.round(mean * 30, 4).alias("projected_30"))


def s21_usage_export(spark, sf):
    """Records of a range of days, in the columns of the export; the filter is on the instant."""
    rows = usage(spark, sf).filter((F.col("happened") >= F.lit("2031-03-01").cast("timestamp")) & (F.col("happened") < F.lit("2031-03-08").cast("timestamp")))
    return rows.select("id", F.date_format("happened", "yyyy-MM-dd HH:mm:ss").alias("happened"), "provider", "model", "usage_type", "tokens", "cost_usd", "source", "operation")


def s22_metrics_export(spark, sf):
    """timestamp, metric, value: the wide metrics of a day as rows."""
    return a13_usage_daily(spark, sf).select("day", F.col("records").cast("double"), F.col("tokens").cast("double"), "cost").unpivot("day", ["records", "tokens", "cost"], "metric", "value")


def m6_cost_per_1k(spark, sf):
    """Cost per thousand tokens by model, null where there are no tokens."""
    rows = usage(spark, sf).filter("cost_usd is not null and tokens is not null and model is not null")
    return rows.groupBy("model").agg(F.round(F.try_divide(cost() * 1000, F.sum("tokens")), 8).alias("per_1k"))


def a19_token_latency_stats(spark, sf):
    """Per operation: mean, sample deviation, exclusive p95 and p99 of tokens."""
    rows = usage(spark, sf).filter("tokens is not null")
    stats = rows.groupBy("operation").agg(F.count("tokens").alias("n"), F.round(F.avg("tokens"), 6).alias("mean"), F.round(F.stddev_samp("tokens"), 4).alias("deviation"))
    q = exact_quantile(rows, ["operation"], "tokens", {"p95": (19, 20), "p99": (99, 100)}).withColumnRenamed("operation", "op")
    return stats.join(q, F.col("operation").eqNullSafe(F.col("op"))).select("operation", "n", "mean", "deviation", F.round("p95", 4).alias("p95"), F.round("p99", 4).alias("p99"))


def a21_nearest_rank(spark, sf):
    return nearest_rank(usage(spark, sf), ["provider"], "tokens", {"p50": 50, "p95": 95, "p99": 99})


def a20_metrics_summary(spark, sf):
    """Current (latest), mean, least, most and count of each operation's cost."""
    rows = usage(spark, sf).filter("happened is not null and cost_usd is not null")
    return rows.groupBy("operation").agg(F.max_by("cost_usd", F.struct("happened", "id")).alias("current"), F.round(F.avg("cost_usd"), 8).alias("mean"), F.min("cost_usd").alias("least"), F.max("cost_usd").alias("most"), F.count(F.lit(1)).alias("n"))


def a18_running_totals(spark, sf):
    """Cumulative records and tokens by day: daily sums first, so the window is one row a day."""
    daily = usage(spark, sf).filter("happened is not null").groupBy(F.date_format("happened", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"))
    upto = W.partitionBy(F.lit(1)).orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return daily.select("day", F.sum("n").over(upto).alias("records"), F.sum("t").over(upto).alias("tokens"))


def w04_error_rate(spark, sf):
    """Share of errors over a user's last 10 events, once 10 have been seen."""
    last = bounded_history(["user_id"], ["event_id"], 10)
    failed = (F.col("event_type") == "error").cast("int")
    rows = table(spark, sf, "events").select("event_id", "user_id", F.count(F.lit(1)).over(last).alias("seen"), F.round(F.avg(failed).over(last), 6).alias("error_rate"))
    return rows.filter("seen = 10").drop("seen")


def w05_bounded_history(spark, sf):
    """Mean of the last 1000 values of each event type."""
    e = table(spark, sf, "events").select("event_id", "event_type", F.col("value").cast("decimal(18,4)").alias("v"))
    return over_last_rows(e, "event_type", "event_id", 1000, {"mean_1000": lambda w: F.sum("v").over(w).cast("double") / F.count("v").over(w)}).drop("v")


def w06_last10_success(spark, sf):
    """Share of successes over the last ten events of each type, from three events on."""
    e = table(spark, sf, "events").select("event_id", "event_type", (F.col("value") > 50).cast("int").alias("ok"))
    rate = lambda w: F.when(F.count(F.lit(1)).over(w) >= 3, F.round(F.avg("ok").over(w), 6))
    return over_last_rows(e, "event_type", "event_id", 10, {"success_rate": rate}).drop("ok")


def w08_running_mean(spark, sf):
    upto = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, sf, "events").select("event_id", "user_id", (F.sum(F.col("value").cast("decimal(18,4)")).over(upto).cast("double") / F.count("value").over(upto)).alias("mean"))


def w03_gap_regularity(spark, sf):
    """Inter-arrival gaps of each user: sample deviation over mean, in buckets."""
    order = W.partitionBy("user_id").orderBy("ts", "event_id")
    stamp = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    gaps = table(spark, sf, "events").select("user_id", (stamp - F.lag(stamp).over(order)).alias("gap"))
    stats = gaps.groupBy("user_id").agg(F.count("gap").alias("gaps"), F.avg("gap").alias("m"), F.stddev_samp("gap").alias("s"))
    cv = F.try_divide("s", "m")
    risk = F.when(F.col("gaps") < 2, 0.0).when(F.col("m") == 0, 1.0).when(cv < 0.1, 0.9).when(cv < 0.3, 0.7).when(cv < 0.5, 0.4).otherwise(0.1)
    return stats.select("user_id", "gaps", F.round(cv, 4).alias("variation"), risk.alias("risk"))


def w07_previous_gap(spark, sf):
    """Records within five seconds of the model's previous one, by blocks of a day."""
    r = usage(spark, sf).filter("model is not null and happened is not null").select("model", F.unix_seconds(F.col("happened").cast("timestamp")).alias("second"))
    return previous_in_group(r, "model", "second", "before", 86_400).select("model", "second", (F.col("second") - F.col("before")).alias("gap_s")).filter("gap_s < 5")


def w11_posts_per_hour(spark, sf):
    hours = table(spark, sf, "events").groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    most, mean = F.max("n"), F.avg("n")
    risk = F.when(most > 20, 0.9).when(most > 10, 0.7).when(mean > 5, 0.6).otherwise(0.1)
    return hours.groupBy("user_id").agg(most.alias("most"), F.round(mean, 6).alias("mean"), risk.alias("risk"))


def r07_minute_counts(spark, sf):
    """Events per minute: the batch form of the tumbling counter."""
    return table(spark, sf, "events").groupBy(F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd HH:mm").alias("minute")).agg(F.count(F.lit(1)).alias("n"))


def r08_rate_limit(spark, sf):
    """Minutes in which a client exceeds its limit, and how far."""
    counts = table(spark, sf, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1").withColumn("over", F.col("n") - 1)


def a22_detector_metrics(spark, sf):
    rows = table(spark, sf, "events")
    base = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(ratio(F.count_if(F.col("value") > 100), F.count(F.lit(1))), 6).alias("hit_rate"))
    ranks = nearest_rank(rows, ["event_type"], "value", {"p95": 95, "p99": 99})
    return base.join(ranks, "event_type")


def a36_health(spark, sf):
    """Status from the error share of the last 10 events of each type of user."""
    rows = table(spark, sf, "events").withColumn("grp", F.col("user_id") % 20)
    back = W.partitionBy("grp").orderBy(F.desc("event_id"))
    last = rows.withColumn("k", F.row_number().over(back)).filter("k <= 10")
    rate = F.avg((F.col("event_type") == "error").cast("int"))
    return last.groupBy("grp").agg(F.round(rate, 6).alias("error_rate"), F.when(rate > 0.5, "critical").when(rate > 0.2, "warning").otherwise("healthy").alias("status"))


def x05_retention(spark, sf):
    """What a retention DELETE leaves: records no older than 30 days before the last one."""
    rows = usage(spark, sf).filter("happened is not null")
    last = rows.agg(F.max("happened").alias("_last"))
    return rows.join(last).filter(F.col("happened") >= F.col("_last") - F.expr("INTERVAL 30 DAYS")).select("id", "model", "source")


def x01_upsert(spark, sf):
    """INSERT OR REPLACE by key: the row collected last wins.  A score that is no number is none."""
    score = F.nanvl("quality_score", F.lit(None).cast("double")).alias("quality_score")
    rows = table(spark, sf, "stackoverflow_collected").select("question_id", "title", "collected_at", score)
    return latest_by_key(rows, ["question_id"], ["collected_at"])


def a08_tracker_stats(spark, sf):
    """Count, mean, least and most score of each source since a day."""
    parts = [table(spark, sf, f"{s}_collected").select(F.lit(s).alias("source"), "collected_at", "quality_score") for s in ("stackoverflow", "reddit", "oppadu")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).filter((F.col("collected_at") >= 1930000000) & F.col("quality_score").isNotNull() & ~F.isnan("quality_score"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("quality_score").cast("decimal(18,4)")).cast("double"), 4).alias("mean"), F.min("quality_score").alias("least"), F.max("quality_score").alias("most"))


def a01_score_stats(spark, sf):
    rows = table(spark, sf, "reddit_collected").filter("quality_score between 0 and 10").withColumn("s", F.col("quality_score"))
    return rows.agg(*describe("s"), F.count_if(F.col("s") >= 5).alias("passed"), F.round(100 * ratio(F.count_if(F.col("s") >= 5), F.count("s")), 4).alias("passed_percent"), F.count_if(F.col("s") >= 9).alias("excellent"), F.count_if((F.col("s") >= 7) & (F.col("s") < 9)).alias("good"), F.count_if((F.col("s") >= 5) & (F.col("s") < 7)).alias("fair"))


def rolling_types(spark, sf):
    """a43: share of each event type of the total, none for null."""
    counts = table(spark, sf, "usage_records").groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("source", "n", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))), 6).alias("percent"))


_EVENTS_LAST = "OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
_TYPE_LAST = "OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


def _exclusive(a: int, b: int) -> str:
    j = f"greatest(1, least(CAST(floor(n * {a} / {b}::DOUBLE + {a} / {b}::DOUBLE) AS BIGINT), n - 1))"
    return f"(CASE WHEN n = 1 THEN v[1] ELSE v[{j}] + (v[{j} + 1] - v[{j}]) * ((n + 1) * {a} / {b}::DOUBLE - {j}) END)"


QUERIES = {
    "a13_usage_daily": a13_usage_daily, "a13_usage_by_model": a13_usage_by_model, "a13_usage_by_source": a13_usage_by_source, "a13_usage_by_hour": a13_usage_by_hour, "a13_usage_grouping_sets": a13_usage_grouping_sets, "a14_usage_monthly": a14_usage_monthly, "a15_cost_projection": a15_cost_projection,
    "s21_usage_export": s21_usage_export, "s22_metrics_export": s22_metrics_export, "m6_cost_per_1k": m6_cost_per_1k, "a19_token_latency_stats": a19_token_latency_stats, "a21_nearest_rank": a21_nearest_rank, "a20_metrics_summary": a20_metrics_summary, "a18_running_totals": a18_running_totals,
    "w03_gap_regularity": w03_gap_regularity, "w04_error_rate": w04_error_rate, "w05_bounded_history": w05_bounded_history, "w06_last10_success": w06_last10_success, "w07_previous_gap": w07_previous_gap, "w08_running_mean": w08_running_mean, "w11_posts_per_hour": w11_posts_per_hour,
    "r07_minute_counts": r07_minute_counts, "r08_rate_limit": r08_rate_limit, "a22_detector_metrics": a22_detector_metrics, "a36_health": a36_health, "x05_retention": x05_retention, "x01_upsert": x01_upsert, "a08_tracker_stats": a08_tracker_stats, "a01_score_stats": a01_score_stats, "a43_share_of_total": rolling_types,
}
_DAILY = f"daily AS (SELECT strftime(happened, '%Y-%m-%d') AS day, {TOTALS_SQL} FROM u WHERE happened IS NOT NULL GROUP BY 1)"
ORACLES = {
    "a13_usage_daily": f"{U}, {_DAILY} SELECT * FROM daily",
    "a13_usage_by_model": f"{U} SELECT model, {TOTALS_SQL} FROM u GROUP BY model",
    "a13_usage_by_source": f"{U} SELECT source, {TOTALS_SQL} FROM u GROUP BY source",
    "a13_usage_by_hour": f"{U} SELECT CAST(hour(happened) AS INTEGER) AS hour, {TOTALS_SQL} FROM u WHERE happened IS NOT NULL GROUP BY 1",
    "a13_usage_grouping_sets": f"{U} SELECT model, source, CAST(grouping(model) AS INTEGER) AS all_models, CAST(grouping(source) AS INTEGER) AS all_sources, {TOTALS_SQL} FROM u GROUP BY GROUPING SETS ((model), (source), ())",
    "a14_usage_monthly": f"{U} SELECT strftime(happened, '%Y-%m') AS month, strftime(happened, '%Y-%m-%d') AS day, {TOTALS_SQL} FROM u WHERE happened IS NOT NULL GROUP BY ROLLUP (1, 2) HAVING month IS NOT NULL",
    "a15_cost_projection": f"{U}, d AS (SELECT CAST(happened AS DATE) AS day, sum(CAST(cost_usd AS DECIMAL(28,12))) AS c FROM u WHERE happened IS NOT NULL GROUP BY 1) SELECT count(c) AS days, round(avg(CAST(c AS DOUBLE)), 6) AS mean, CAST(min(c) AS DOUBLE) AS least, CAST(max(c) AS DOUBLE) AS most, round(avg(CAST(c AS DOUBLE)) * 30, 4) AS projected_30 FROM d",
    "s21_usage_export": f"{U} SELECT id, strftime(happened, '%Y-%m-%d %H:%M:%S') AS happened, provider, model, usage_type, tokens, cost_usd, source, operation FROM u WHERE happened >= TIMESTAMP '2031-03-01' AND happened < TIMESTAMP '2031-03-08'",
    "s22_metrics_export": f"{U}, {_DAILY} SELECT day, 'records' AS metric, CAST(records AS DOUBLE) AS value FROM daily UNION ALL SELECT day, 'tokens', CAST(tokens AS DOUBLE) FROM daily UNION ALL SELECT day, 'cost', cost FROM daily",
    "m6_cost_per_1k": f"{U} SELECT model, CASE WHEN sum(tokens) <> 0 THEN round({COST_SQL} * 1000 / sum(tokens), 8) END AS per_1k FROM u WHERE cost_usd IS NOT NULL AND tokens IS NOT NULL AND model IS NOT NULL GROUP BY model",
    "a19_token_latency_stats": f"{U}, g AS (SELECT operation, count(*) AS n, avg(tokens) AS mean, stddev_samp(tokens) AS dev, list(CAST(tokens AS DOUBLE) ORDER BY tokens) AS v FROM u WHERE tokens IS NOT NULL GROUP BY operation) SELECT operation, n, round(mean, 6) AS mean, round(dev, 4) AS deviation, round({_exclusive(19, 20)}, 4) AS p95, round({_exclusive(99, 100)}, 4) AS p99 FROM g",
    "a21_nearest_rank": f"{U}, g AS (SELECT provider, count(*) AS n, list(tokens ORDER BY tokens) AS v FROM u WHERE tokens IS NOT NULL GROUP BY provider) SELECT provider, " + ", ".join(f"v[least(CAST(floor(n * {p / 100.0}) AS BIGINT), n - 1) + 1] AS p{p}" for p in (50, 95, 99)) + " FROM g",
    "a20_metrics_summary": f"{U} SELECT operation, arg_max(cost_usd, struct_pack(a := happened, b := id)) AS current, round(avg(cost_usd), 8) AS mean, min(cost_usd) AS least, max(cost_usd) AS most, count(*) AS n FROM (SELECT u.* REPLACE (CASE WHEN stamp LIKE '%.%' THEN happened + CAST(rpad(regexp_extract(stamp, '\\.(\\d+)', 1), 6, '0') AS INTEGER) * INTERVAL 1 MICROSECOND ELSE happened END AS happened) FROM u) WHERE happened IS NOT NULL AND cost_usd IS NOT NULL GROUP BY operation",
    "a18_running_totals": f"{U}, {_DAILY} SELECT day, CAST(sum(records) OVER (ORDER BY day) AS BIGINT) AS records, CAST(sum(tokens) OVER (ORDER BY day) AS BIGINT) AS tokens FROM daily",
    "w03_gap_regularity": "WITH g AS (SELECT user_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events), s AS (SELECT user_id, count(gap) AS gaps, avg(gap) AS m, stddev_samp(gap) AS s FROM g GROUP BY user_id) SELECT user_id, gaps, round(s / nullif(m, 0), 4) AS variation, CAST(CASE WHEN gaps < 2 THEN 0.0 WHEN m = 0 THEN 1.0 WHEN s / m < 0.1 THEN 0.9 WHEN s / m < 0.3 THEN 0.7 WHEN s / m < 0.5 THEN 0.4 ELSE 0.1 END AS DOUBLE) AS risk FROM s",
    "w04_error_rate": f"SELECT event_id, user_id, error_rate FROM (SELECT event_id, user_id, count(*) {_EVENTS_LAST} AS seen, round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) {_EVENTS_LAST}, 6) AS error_rate FROM events) WHERE seen = 10",
    "w05_bounded_history": "SELECT event_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,4))) OVER w AS DOUBLE) / count(value) OVER w AS mean_1000 FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)",
    "w06_last10_success": f"SELECT event_id, event_type, CASE WHEN count(*) {_TYPE_LAST} >= 3 THEN round(avg(CASE WHEN value > 50 THEN 1 ELSE 0 END) {_TYPE_LAST}, 6) END AS success_rate FROM events",
    "w07_previous_gap": f"WITH {USAGE}, g AS (SELECT model, CAST(floor(epoch(happened)) AS BIGINT) AS second, CAST(floor(epoch(happened)) AS BIGINT) - lag(CAST(floor(epoch(happened)) AS BIGINT)) OVER (PARTITION BY model ORDER BY happened) AS gap_s FROM u WHERE model IS NOT NULL AND happened IS NOT NULL) SELECT * FROM g WHERE gap_s < 5",
    "w08_running_mean": "SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(18,4))) OVER w AS DOUBLE) / count(value) OVER w AS mean FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    "w11_posts_per_hour": "WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, max(n) AS most, round(avg(n), 6) AS mean, CAST(CASE WHEN max(n) > 20 THEN 0.9 WHEN max(n) > 10 THEN 0.7 WHEN avg(n) > 5 THEN 0.6 ELSE 0.1 END AS DOUBLE) AS risk FROM h GROUP BY user_id",
    "r07_minute_counts": "SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS n FROM events GROUP BY 1",
    "r08_rate_limit": "SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS n, count(*) - 1 AS over FROM events GROUP BY 1, 2 HAVING count(*) > 1",
    "a22_detector_metrics": "WITH g AS (SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 100) AS h, list(value ORDER BY value) FILTER (WHERE value IS NOT NULL) AS v FROM events GROUP BY 1) SELECT event_type, n, round(h / n::DOUBLE, 6) AS hit_rate, v[least(CAST(floor(len(v) * 0.95) AS BIGINT), len(v) - 1) + 1] AS p95, v[least(CAST(floor(len(v) * 0.99) AS BIGINT), len(v) - 1) + 1] AS p99 FROM g",
    "a36_health": "WITH l AS (SELECT user_id % 20 AS grp, event_type, row_number() OVER (PARTITION BY user_id % 20 ORDER BY event_id DESC) AS k FROM events) SELECT grp, round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 6) AS error_rate, CASE WHEN avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0.5 THEN 'critical' WHEN avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0.2 THEN 'warning' ELSE 'healthy' END AS status FROM l WHERE k <= 10 GROUP BY grp",
    "x05_retention": f"{U}, f AS (SELECT *, CASE WHEN stamp LIKE '%.%' THEN happened + CAST(rpad(regexp_extract(stamp, '\\.(\\d+)', 1), 6, '0') AS INTEGER) * INTERVAL 1 MICROSECOND ELSE happened END AS exact FROM u WHERE happened IS NOT NULL) SELECT id, model, source FROM f WHERE exact >= (SELECT max(exact) FROM f) - INTERVAL 30 DAY",
    "x01_upsert": "SELECT question_id, title, collected_at, CASE WHEN NOT isnan(quality_score) THEN quality_score END AS quality_score FROM stackoverflow_collected QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY collected_at DESC) = 1",
    "a08_tracker_stats": "WITH r AS (SELECT 'stackoverflow' AS source, collected_at, quality_score FROM stackoverflow_collected UNION ALL SELECT 'reddit', collected_at, quality_score FROM reddit_collected UNION ALL SELECT 'oppadu', collected_at, quality_score FROM oppadu_collected) SELECT source, count(*) AS n, round(CAST(sum(CAST(quality_score AS DECIMAL(18,4))) AS DOUBLE) / count(quality_score), 4) AS mean, min(quality_score) AS least, max(quality_score) AS most FROM r WHERE collected_at >= 1930000000 AND NOT isnan(quality_score) GROUP BY source",
    "a01_score_stats": "SELECT count(s) AS n, round(avg(s), 6) AS mean, round(quantile_cont(s, 0.5), 6) AS median, min(s) AS least, max(s) AS most, round(stddev_pop(s), 6) AS deviation, count(*) FILTER (WHERE s >= 5) AS passed, round(100.0 * (count(*) FILTER (WHERE s >= 5)) / count(s), 4) AS passed_percent, count(*) FILTER (WHERE s >= 9) AS excellent, count(*) FILTER (WHERE s >= 7 AND s < 9) AS good, count(*) FILTER (WHERE s >= 5 AND s < 7) AS fair FROM (SELECT quality_score AS s FROM reddit_collected WHERE quality_score BETWEEN 0 AND 10)",
    "a43_share_of_total": "SELECT coalesce(source, 'none') AS source, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM usage_records GROUP BY 1",
}
