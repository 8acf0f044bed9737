from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridwright.functions.instants import instant
from gridwright.operators.rolling import rolling_totals, usage_rolling

USAGE = "id bigint, timestamp string, model string, cost_usd double, tokens bigint, _entity string, source string"


def brute(rows, windows):
    days, out = {}, {}
    for e, d, v in rows:
        days.setdefault(e, {}).setdefault(d, []).append(v)
    for e, by in days.items():
        d = min(by)
        while d <= max(by):
            for w in windows:
                vals = [v for k in range(w) for v in by.get(d - timedelta(days=k), []) if v is not None]
                out[e, d, w] = (sum(vals), len(vals))
            d += timedelta(days=1)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40), st.integers(1, 37))
def test_any_window_equals_brute_force(spark, data, window):
    rows = [(e, date(2031, 1, 1) + timedelta(days=d), v) for e, d, v in data]
    df = spark.createDataFrame(rows, "e string, d date, v bigint")
    got = {(r["e"], r["usage_day"]): (r[f"v_total_{window}"], r[f"v_avg_{window}"]) for r in rolling_totals(df, "e", F.col("d"), ["v"], [window]).collect()}
    want = brute(rows, [window])
    assert set(got) == {(e, d) for e, d, _ in want}
    for (e, d, _), (total, n) in want.items():
        assert got[e, d][0] == total
        assert got[e, d][1] == (total / n if n else None)


def test_stamps(spark):
    texts = ["2031-02-01T13:02:28.833246+09:00", " 2031-02-01 04:02:28 ", "2031-02-30T00:00:00", "2031-02-01T24:00:00", "", None, "unknown", "2031-02-01T04:02:28Z", "2031-02-01T04:02:28-05:00"]
    got = [r[0] and r[0].isoformat() for r in spark.createDataFrame([(t,) for t in texts], "t string").select(instant(F.col("t"))).collect()]
    assert got == ["2031-02-01T04:02:28.833246", "2031-02-01T04:02:28", None, None, None, None, None, "2031-02-01T04:02:28", "2031-02-01T09:02:28"]


def test_repeats_nulls_empty_and_clashing_columns(spark):
    rows = [(1, "2031-01-01T00:00:00", "m", 1.0, 2, "x", "s"), (1, "2031-01-01T00:00:00", "m", 1.0, 2, "x", "s"), (2, "2031-01-03T00:00:00", "m", None, None, "x", "s"), (3, None, "m", 9.0, 9, "x", "s"), (4, "2031-01-01T00:00:00", None, 9.0, 9, "x", "s"), (None, "2031-01-03T00:00:00", "m", float("nan"), 5, "x", "s"), (None, "2031-01-03T00:00:00", "m", 2.0, 5, "x", "s")]
    got = sorted((str(r["usage_day"]), r["records"], r["cost_usd_total_7"], r["tokens_total_7"]) for r in usage_rolling(spark.createDataFrame(rows, USAGE)).collect())
    assert got == [("2031-01-01", 1, 1.0, 2.0), ("2031-01-02", 0, 1.0, 2.0), ("2031-01-03", 3, 3.0, 12.0)]
    assert usage_rolling(spark.createDataFrame([], USAGE)).count() == 0
