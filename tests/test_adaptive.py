import random

from pyspark.sql import functions as F

from gridwright.operators import adaptive


def brute(outcomes):
    t = 0.7
    for k in range(len(outcomes)):
        if k >= 9:
            rate = sum(outcomes[k - 9 : k + 1]) / 10
            t = max(0.5, t - 0.05) if rate < 0.5 else min(0.95, t + 0.02) if rate > 0.8 else t
    return t


def test_fold_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(adaptive, "BLOCK", 7)
    rng = random.Random(9)
    data = {u: [rng.random() < p for _ in range(n)] for u, (p, n) in enumerate([(0.9, 200), (0.2, 90), (0.6, 300), (1.0, 9), (0.5, 1), (0.85, 151)])}
    rows = [(u, k, ok) for u, oks in data.items() for k, ok in enumerate(oks)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "u bigint, k bigint, ok boolean")
    got = {r["u"]: (r["events"], r["threshold"]) for r in adaptive.adaptive_threshold(df, "u", "k", F.col("ok")).collect()}
    assert set(got) == set(data)
    for u, oks in data.items():
        assert got[u][0] == len(oks) and abs(got[u][1] - brute(oks)) < 1e-6
    assert adaptive.adaptive_threshold(df.filter("false"), "u", "k", F.col("ok")).count() == 0
