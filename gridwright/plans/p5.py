"""Problem 5: rolling totals over trailing periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.operators.rolling import usage_rolling
from gridwright.session import table, written


def p5_rolling(spark, sf_dir):
    wide = usage_rolling(table(spark, sf_dir, "usage_records"))
    keep = ["model", F.date_format("usage_day", "yyyy-MM-dd").alias("usage_day"), "records"]
    for w in (7, 30):
        keep += [F.col(f"cost_usd_total_{w}").alias(f"cost_total_{w}"), F.col(f"cost_usd_avg_{w}").alias(f"cost_avg_{w}"), F.col(f"tokens_total_{w}").cast("bigint").alias(f"tokens_total_{w}"), f"tokens_avg_{w}", F.col(f"cost_usd_daily_{w}").alias(f"cost_daily_{w}"), f"tokens_daily_{w}"]
    return wide.select(*keep)


def p5_found(spark, sf_dir):
    """Days without a record inside a model's span.  The rolling table is written once, as for
    any report, so all windows are computed; the days are read from it."""
    return written(p5_rolling(spark, sf_dir), "rolling").filter("records = 0").select("model", "usage_day")


_DAYS = r"""
WITH u AS (SELECT id, any_value(model) AS model, any_value("timestamp") AS stamp, any_value(cost_usd) AS cost_usd, any_value(tokens) AS tokens FROM usage_records GROUP BY id),
d AS (SELECT model, cost_usd, tokens,
        CASE WHEN regexp_matches(stamp, '^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?\s*(Z|[+-]\d{2}:?\d{2})?\s*$')
             THEN CAST(TRY_CAST(substr(trim(stamp), 1, 19) AS TIMESTAMP)
                  - CASE WHEN regexp_matches(stamp, '[+-]\d{2}:\d{2}\s*$') THEN
                      (CASE WHEN regexp_extract(stamp, '([+-])\d{2}:\d{2}\s*$', 1) = '-' THEN -1 ELSE 1 END)
                      * (CAST(regexp_extract(stamp, '[+-](\d{2}):\d{2}\s*$', 1) AS INTEGER) * INTERVAL 1 HOUR + CAST(regexp_extract(stamp, '[+-]\d{2}:(\d{2})\s*$', 1) AS INTEGER) * INTERVAL 1 MINUTE)
                    ELSE INTERVAL 0 HOUR END AS DATE) END AS day
      FROM u),
daily AS (SELECT model, day, count(*) AS n, coalesce(sum(CAST(cost_usd AS DECIMAL(28,12))), 0) AS s0, count(cost_usd) AS c0, coalesce(sum(tokens), 0) AS s1, count(tokens) AS c1
          FROM d WHERE model IS NOT NULL AND day IS NOT NULL GROUP BY model, day),
span AS (SELECT model, min(day) AS lo, max(day) AS hi FROM daily GROUP BY model),
cal AS (SELECT model, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM span),
full_days AS (SELECT cal.model, cal.day, coalesce(n, 0) AS n, coalesce(s0, 0) AS s0, coalesce(c0, 0) AS c0, coalesce(s1, 0) AS s1, coalesce(c1, 0) AS c1
              FROM cal LEFT JOIN daily ON cal.model = daily.model AND cal.day = daily.day)
"""


def _sums(w: int) -> str:
    over = f"OVER (PARTITION BY model ORDER BY day ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return f"""CAST(sum(s0) {over} AS DOUBLE) AS cost_total_{w},
        CASE WHEN sum(c0) {over} > 0 THEN CAST(sum(s0) {over} AS DOUBLE) / sum(c0) {over} END AS cost_avg_{w},
        CAST(sum(s1) {over} AS BIGINT) AS tokens_total_{w},
        CASE WHEN sum(c1) {over} > 0 THEN CAST(sum(s1) {over} AS DOUBLE) / sum(c1) {over} END AS tokens_avg_{w},
        CAST(sum(s0) {over} AS DOUBLE) / {w} AS cost_daily_{w}, CAST(sum(s1) {over} AS DOUBLE) / {w} AS tokens_daily_{w}"""


QUERIES = {"p5_found": p5_found, "p5_rolling": p5_rolling}
ORACLES = {
    "p5_found": _DAYS + "SELECT model, strftime(day, '%Y-%m-%d') AS usage_day FROM full_days WHERE n = 0",
    "p5_rolling": _DAYS + f"SELECT model, strftime(day, '%Y-%m-%d') AS usage_day, n AS records, {_sums(7)}, {_sums(30)} FROM full_days",
}
