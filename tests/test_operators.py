import random
import statistics

from pyspark.sql import functions as F

from gridwright.functions import markup, text
from gridwright.operators.graph import components, nearest, similar_pairs
from gridwright.operators.relational import best_of_group, exact_quantile, latest_by_key, min_max, nearest_rank, not_known, over_last_rows


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    for n, m in ((30, 20), (60, 90), (50, 49)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != 49 else [(k, k + 1) for k in range(49)]
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
        got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        assert got == {x: find(x) for x in {v for e in edges for v in e}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_of_a_long_path(spark):
    order = list(range(1 << 14))
    random.Random(9).shuffle(order)
    edges = spark.createDataFrame([(k, k + 1) for k in order], "a bigint, b bigint").repartition(16)
    got = components(edges).groupBy("component").count().collect()
    assert [tuple(r) for r in got] == [(0, (1 << 14) + 1)]


def test_similar_pairs_of_clusters_and_odd_vectors(spark):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    vecs = [[x + rng.gauss(0, 0.05) for x in centres[min(k % 9, 4)]] for k in range(150)]
    rows = [(k, v) for k, v in enumerate(vecs)] + [(900, []), (901, [None] * 6), (902, [float("nan")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>").repartition(3)
    unit = [[x / sum(y * y for y in v) ** 0.5 for x in v] for v in vecs]
    for least in (0.99, 0.2):
        want = {(a, b) for a in range(150) for b in range(a + 1, 150) if sum(x * y for x, y in zip(unit[a], unit[b])) >= least}
        got = [(r["a"], r["b"]) for r in similar_pairs(df, "id", "v", least, block=20).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert similar_pairs(df.limit(0), "id", "v", 0.5).count() == 0


def test_similar_pairs_lose_nothing(spark):
    rng = random.Random(5)
    vecs = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(60)] + [[1.0, 0.0, 0.0, 0.0]] * 3 + [[0.0] * 4, None]
    df = spark.createDataFrame(list(enumerate(vecs)), "id bigint, v array<double>")
    unit = [None if not v or not any(v) else [x / sum(y * y for y in v) ** 0.5 for x in v] for v in vecs]
    want = {(a, b) for a in range(63) for b in range(a + 1, 63) if sum(x * y for x, y in zip(unit[a], unit[b])) >= 0.8}
    pairs = {(r["a"], r["b"]) for r in similar_pairs(df, "id", "v", 0.8, block=16).collect()}
    assert pairs <= want
    # copies come as links to their first: together they connect what the pairs connect
    first = {62: 60, 61: 60}
    assert {(min(first.get(a, a), first.get(b, b)), max(first.get(a, a), first.get(b, b))) for a, b in want} <= {(min(first.get(a, a), first.get(b, b)), max(first.get(a, a), first.get(b, b))) for a, b in pairs} | {(60, 60)}
    top = nearest(df, df.filter("id = 0"), "id", "v", 2).collect()
    best = sorted((-sum(x * y for x, y in zip(unit[0], unit[k])), k) for k in range(1, 63))[:2]
    assert [r["id"] for r in sorted(top, key=lambda r: r["rank"])] == [k for _, k in best]


def test_over_last_rows_equals_one_window(spark):
    rng = random.Random(11)
    rows = [("hot", k, rng.choice([None, *range(9)])) for k in rng.sample(range(-500, 3000), 700)] + [(None, k, k) for k in range(5)] + [("one", 7, 1)]
    df = spark.createDataFrame(rows, "g string, k bigint, v bigint")
    for n, block in ((1, 8), (10, 16), (10, 4), (400, 64)):
        got = {(r["g"], r["k"]): (r["s"], r["c"]) for r in over_last_rows(df, "g", "k", n, {"s": lambda w: F.sum("v").over(w), "c": lambda w: F.count(F.lit(1)).over(w)}, block=block).collect()}
        want = {}
        for g in {r[0] for r in rows}:
            mine = sorted(((k, v) for h, k, v in rows if h == g), key=lambda x: x[0])
            for at, (k, _) in enumerate(mine):
                last = [v for _, v in mine[max(0, at - n + 1) : at + 1]]
                want[g, k] = (sum(v for v in last if v is not None) if any(v is not None for v in last) else None, len(last))
        assert got == want


def test_latest_best_known(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (1, 6.0, "b"), (2, None, "c"), (None, 1.0, "d")], "k bigint, t double, v string")
    assert {(r["k"], r["v"]) for r in latest_by_key(df, ["k"], ["t"]).collect()} == {(1, "b"), (2, "c"), (None, "d")}
    ties = spark.createDataFrame([(1, 2, 7.0), (1, 1, 7.0), (1, 3, None), (2, 4, None)], "g bigint, id bigint, s double")
    assert {(r["g"], r["id"]) for r in best_of_group(ties, ["g"], "s", "id").collect()} == {(1, 1), (2, 4)}
    known = spark.createDataFrame([(1,), (None,)], "k bigint")
    assert [r["k"] for r in not_known(df, known, "k").collect()] == [2]


def test_min_max_stays_in_range(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", 5.0), ("c", 4.0), ("c", 4.0)], "b string, x double")
    got = sorted((r["b"], r["x_norm"]) for r in min_max(df, ["x"], ["b"]).collect())
    assert got == [("a", 0.0), ("a", 0.5), ("a", 1.0), ("b", 1.0), ("c", 1.0), ("c", 1.0)]


def test_quantiles(spark):
    rng = random.Random(1)
    values = [rng.randrange(40) for _ in range(237)]
    df = spark.createDataFrame([(0, v) for v in values] + [(1, 9)], "g bigint, v bigint")
    got = {r["g"]: (r["p95"], r["p99"]) for r in exact_quantile(df, ["g"], "v", {"p95": (19, 20), "p99": (99, 100)}).collect()}
    cuts = statistics.quantiles(values, n=100)
    assert abs(got[0][0] - cuts[94]) < 1e-9 and abs(got[0][1] - cuts[98]) < 1e-9 and got[1] == (9, 9)
    ranks = {r["g"]: r["p95"] for r in nearest_rank(df, ["g"], "v", {"p95": 95}).collect()}
    assert ranks == {0: sorted(values)[min(int(95 / 100 * 237), 236)], 1: 9}


def test_text_edges(spark):
    df = spark.createDataFrame([("  a \n b  ",), ("",), (None,), ("=IF(A1, SUM(B1:B2), 0) x",)], "t string")
    assert [r[0] for r in df.select(text.collapse(F.col("t"))).collect()] == ["a b", "", None, "=IF(A1, SUM(B1:B2), 0) x"]
    assert df.select(text.formulas(F.col("t"))).collect()[3][0] == ["=IF(A1, SUM(B1:B2), 0)"]
    assert [r[0] for r in df.select(F.size(text.char_grams(F.col("t")))).collect()][:2] == [7, 0]


def test_markup(spark):
    df = spark.createDataFrame([("<p>a &amp; b</p><pre>=X(1)</pre><script>no</script> c",), (None,), ("see =IF(A1>0, SUM((B1)), \")\") end",), ("=SUM(A1",)], "t string")
    got = df.select(markup.html_text("t"), markup.html_code("t"), markup.first_formula("t")).collect()
    assert got[0][0] == "a & b c" and got[0][1] == ["=X(1)"] and got[1][0] is None
    assert got[2][2] == '=IF(A1>0, SUM((B1)), ")")' and got[3][2] is None
