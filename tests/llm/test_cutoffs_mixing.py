import random

from pyspark.sql import functions as F

from gridwright.llm.bpe import BYTE_BPE, ByteBpe, count_tokens, encode_texts
from gridwright.llm.cutoffs import CutoffTree, keep_fraction, latest_scores
from gridwright.llm.dyadic import select_rank
from gridwright.llm.mixing import ALL, hash_code, largest_total, mix, water_fill

COLLECTED = "id string, collected_at double, quality_score double, grp string, value string"
TARGETS = "source string, target_percent bigint"


def brute(scores, percent):
    n = len(scores)
    return max(s for s in scores if sum(x >= s for x in scores) * 100 >= percent * n)


def test_cutoffs_equal_brute_force(spark):
    rng = random.Random(2)
    data = {"a": [rng.choice([5.0, 7.5, 0.0, 10.0, round(rng.random() * 10, 2)]) for _ in range(400)], "b": [3.3] * 50, "c": [rng.random() * 1e-7 for _ in range(300)]}
    scored = spark.createDataFrame([(s, f"{s}{k}", v) for s, vs in data.items() for k, v in enumerate(vs)], "source string, record_id string, score double")
    for percent in (1, 37, 60, 100):
        kept, report = keep_fraction({"all": scored}, spark.createDataFrame([(s, percent) for s in data], TARGETS))
        got = {r["source"]: (r["cutoff"], r["kept"]) for r in report.collect()}
        want = {s: brute(vs, percent) for s, vs in data.items()}
        assert got == {s: (c, sum(v >= c for v in data[s])) for s, c in want.items()}
        assert kept.count() == sum(k for _, k in got.values())


def test_leaf_with_many_distinct_scores_is_refined(spark, monkeypatch):
    monkeypatch.setattr("gridwright.llm.dyadic.LEAF_VALUES", 4)
    values = [5 + k * 1e-9 for k in range(500)]
    scored = spark.createDataFrame([("a", str(k), v) for k, v in enumerate(values)], "source string, record_id string, score double")
    _, report = keep_fraction({"all": scored}, spark.createDataFrame([("a", 30)], TARGETS))
    assert report.first()["cutoff"] == brute(values, 30)


def test_latest_row_and_dirty_scores(spark):
    rows = [("1", 1.0, 9.0, "x", "x"), ("1", 2.0, None, "x", "x"), ("2", 1.0, 11.0, "x", "x"), ("3", None, 4.0, "x", "x"), ("3", 5.0, 6.0, "x", "x"), ("4", 1.0, float("nan"), "x", "x"), ("5", 1.0, -0.0, "x", "x"), (None, 1.0, 5.0, "x", "x"), ("6", 1.0, 3.0, "x", "x"), ("6", 1.0, 8.0, "x", "x")]
    got = {(r["record_id"], r["score"]) for r in latest_scores(spark.createDataFrame(rows, COLLECTED), "s", "id").collect()}
    assert got == {("3", 6.0), ("5", 0.0), ("6", 8.0)}
    empty = latest_scores(spark.createDataFrame([], COLLECTED), "s", "id")
    kept, report = keep_fraction({"all": empty}, spark.createDataFrame([("s", 50), (None, 3)], TARGETS))
    assert kept.count() == report.count() == 0


def test_tree_of_batches_with_replaced_rows(spark, tmp_path):
    schema = "source string, record_id string, score double"
    first = spark.createDataFrame([("a", str(k), float(k)) for k in range(10)], schema)
    second = spark.createDataFrame([("a", "0", 9.5), ("a", "x", 2.5)], schema)
    tree = CutoffTree(spark, str(tmp_path / "tree"))
    tree.add("1", first)
    tree.add("2", second, replaced=first.filter("record_id = '0'"))
    tree.add("2", second, replaced=first.filter("record_id = '0'"))  # a batch added again counts once
    now = first.filter("record_id <> '0'").unionByName(second)
    targets, scores = spark.createDataFrame([("a", 50)], TARGETS), [r["score"] for r in now.collect()]
    got = tree.cutoffs(targets).first()
    assert (got["cutoff"], got["scored"]) == (brute(scores, 50), 11)
    # opened anew, and as one folder, the tree says the same; a further batch goes on from there
    again = CutoffTree(spark, tree.store.compacted(str(tmp_path / "one")).path)
    assert again.cutoffs(targets).collect() == CutoffTree(spark, str(tmp_path / "tree")).cutoffs(targets).collect() == [got]
    again.add("3", spark.createDataFrame([("a", f"y{k}", 9.9) for k in range(30)], schema))
    assert again.cutoffs(targets).first()["cutoff"] == 9.9


def test_batches_give_what_all_rows_give(spark):
    rng = random.Random(7)
    rows = [("a" if k % 3 else "b", str(k), round(rng.random() * 10, 3)) for k in range(600)]
    schema = "source string, record_id string, score double"
    parts = {str(n): spark.createDataFrame(rows[n::4], schema) for n in range(4)}
    kept, report = keep_fraction(parts, spark.createDataFrame([("a", 35), ("b", 80)], TARGETS))
    whole, expected = keep_fraction({"all": spark.createDataFrame(rows, schema)}, spark.createDataFrame([("a", 35), ("b", 80)], TARGETS))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, expected.collect()))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, whole.collect()))


def test_weighted_rank(spark):
    values = spark.createDataFrame([("g", k * 0x0123456789ABCDE % (1 << 63), float(k % 7 + 1)) for k in range(1, 200)], "grp string, value bigint, weight double")
    rows = sorted([(r["value"], r["weight"]) for r in values.collect()], reverse=True)
    total, rank = 0.0, 333.0
    for value, weight in rows:
        if total + weight >= rank:
            break
        total += weight
    got = select_rank(values, spark.createDataFrame([("g", rank), ("none", 5.0)], "grp string, rank double"), hash_code).collect()
    assert [(r["value"], r["above"], r["through"]) for r in got] == [(value, total, total + weight)]


def test_water_fill():
    share = water_fill({"a": 50, "b": 30, "c": 20, "d": 5}, {"a": 100, "b": 1000, "c": 1000}, {"a": 2, "b": 1, "c": 1, "d": 9}, 1000)
    assert share["a"] == 200 and share["d"] == 0 and abs(share["b"] - 480) < 1e-9 and abs(share["c"] - 320) < 1e-9
    assert water_fill({"a": 1, "b": 1}, {"a": 1, "b": 2}, {"a": 1, "b": 1}, 100) == {"a": 1, "b": 2}
    assert water_fill({}, {}, {}, 5) == {} and largest_total({"a": 1}, {}, {"a": 3}) == 0
    assert largest_total({"a": 50, "b": 50, "none": 7}, {"a": 10, "b": 100}, {"a": 3, "b": 1, "none": 1}) == 60


def test_mix_reaches_shares_and_caps(spark):
    rng = random.Random(4)
    docs = [(k, s, " ".join("word" for _ in range(rng.randrange(1, 9)))) for s, n in (("a", 300), ("b", 100), ("c", 4)) for k in [f"{s}{i}" for i in range(n)]]
    docs += [("n1", "a", None), ("n2", "a", ""), ("n3", None, "x"), ("n4", "other", "x"), ("a1", "a", "word")]
    df = spark.createDataFrame(docs, "doc_id string, source string, text string").withColumn("value", F.lit("clash"))
    targets = spark.createDataFrame([("a", 40, 1), ("b", 40, 2), ("c", 20, 5), ("empty", 10, 3), (None, 9, 9)], "source string, target_percent bigint, max_repeats bigint")
    rows, report = mix(df, targets)
    assert rows.filter("copies > 5 or (source = 'a' and copies > 1) or source = 'other'").count() == 0
    got = {r["source"]: r for r in report.collect()}
    assert abs(got["a"]["actual_tokens"] - got["a"]["planned_tokens"]) <= 9 and abs(got["b"]["actual_tokens"] - got["b"]["planned_tokens"]) <= 9
    assert got["c"]["actual_tokens"] == 5 * got["c"]["source_tokens"] and got["empty"]["actual_tokens"] == 0
    again = {tuple(r) for r in mix(df, targets)[0].collect()}
    assert again == {tuple(r) for r in rows.collect()}
    full = {r["source"]: r["mean_repeats"] for r in mix(df, targets, ALL)[1].collect()}
    assert full["c"] == 5.0 and full["a"] <= 1.0 and full["b"] <= 2.0
    none = df.filter("false")
    assert mix(none, targets)[0].count() == 0 and mix(df, targets.filter("false"))[0].count() == 0


def test_bpe_equals_the_public_library(spark):
    from tokenizers import Tokenizer

    texts = ["", "a", "aaaaaaa", "  two  blanks \n\n x", "don't I'LL we've", "한국어 텍스트 ㅂㄱㄷ", "😀" * 9, "<|endoftext|> is text", "=IF(A1>0, SUM(B1:B2), \"\")", " ​\t", "x" * 5000, "ab" * 4000 + "é" * 999, "1234567890 12.5", "Ã©tÃ©"]
    rng = random.Random(6)
    texts += ["".join(rng.choice("abc é한\n'1.=") for _ in range(rng.randrange(60))) for _ in range(300)]
    public = Tokenizer.from_file(BYTE_BPE)
    public.encode_special_tokens = True
    want = [e.ids for e in public.encode_batch(texts, add_special_tokens=False)]
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)] + [(None, None, "clash"), (-1, None, None)], "doc_id bigint, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in encode_texts(df).collect()}
    assert [got[k] for k in range(len(texts))] == want and got[-1] == [] and got[None] == []
    sizes = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df).collect()}
    assert [sizes[k] for k in range(len(texts))] == [len(w) for w in want] and sizes[-1] == 0
    assert encode_texts(df.filter("false")).count() == 0


def test_bpe_forgets_without_changing_results(monkeypatch):
    bpe = ByteBpe()
    texts = [f"word{k} other{k * 7}" for k in range(200)]
    whole = bpe.encode(texts)[0].tolist()
    monkeypatch.setattr("gridwright.llm.bpe.MOST_WORDS", 3)
    parts = [i for t in texts for i in bpe.encode([t])[0].tolist()]
    assert parts == whole
