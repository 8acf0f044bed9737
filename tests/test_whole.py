"""Queries against SQL without a cut: every group is in it, the hot one too."""

import os
import random
from itertools import combinations

import pytest

from gridwright.functions.dialects import DUCK, SPARK
from gridwright.operators.relational import previous_in_group
from gridwright.operators.user_texts import trigrams, user_similarity
from gridwright.plans.common import QA
from gridwright.plans.registry import collect
from gridwright.plans.rule_plans import decision
from tests.oracle import compare, connect

DATA = os.environ.get("GRIDWRIGHT_TEST_DATA", "/root/testdata/sf0.001")
QUERIES, _ = collect()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_j08_has_the_pinned_thread(spark, con):
    compare(QUERIES["j08_parent"](spark, DATA), con, "SELECT * FROM (SELECT doc_id, lag(doc_id) OVER (PARTITION BY thread_id ORDER BY doc_id) AS parent_id FROM documents WHERE thread_id IS NOT NULL) WHERE parent_id IS NOT NULL")


def test_previous_in_group_crosses_blocks(spark):
    rows = [("hot", k) for k in range(-7, 40) if k not in range(9, 22)] + [("b", 3), ("b", 30), ("one", 5)]
    want, last = {}, {}
    for g, k in sorted(rows):
        want[g, k], last[g] = last.get(g), k
    got = previous_in_group(spark.createDataFrame(rows, "g string, k bigint"), "g", "k", "p", block=4).collect()
    assert {(r["g"], r["k"]): r["p"] for r in got} == want and len(got) == len(rows)


def test_w10_has_every_question(spark, con):
    compare(QUERIES["w10_best_answer"](spark, DATA), con, f"WITH {QA} SELECT source, q_id, pair_id FROM qa WHERE q_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, q_id ORDER BY CAST(coalesce(op_confirmed, false) AS INTEGER) DESC, a_score DESC NULLS LAST, pair_id) = 1")


def test_f10_excludes_no_author(spark, con):
    compare(QUERIES["f10_comment_gate"](spark, DATA), con, f"WITH {QA} SELECT pair_id FROM qa WHERE length(a_text) BETWEEN 50 AND 5000 AND a_score >= 0")


def test_j10_compares_all_texts_of_a_user(spark):
    rng = random.Random(5)
    words = ["pivot", "sum it up", "Ärger!", "함수 값", "a-b", "the column"]
    rows = [("hot", " ".join(rng.choices(words, k=rng.randrange(1, 5)))) for _ in range(90)] + [("two", "same text here"), ("two", "same text here"), ("one", "alone it is"), ("short", "!!"), ("short", "!!"), ("none", "abcd"), ("none", "xyzw")]
    want = {}
    for user in {u for u, _ in rows}:
        pairs = list(combinations([trigrams(t) for u, t in rows if u == user], 2))
        if pairs:
            each = [len(a & b) / len(a | b) if a and b else 0.0 for a, b in pairs]
            want[user] = (round(sum(each) / len(each), 9), round(max(each), 9))
    df = spark.createDataFrame(rows, "user string, text string")
    for block in (7, 1024):
        got = {r["user"]: (round(r["mean"], 9), round(r["most"], 9)) for r in user_similarity(df, block).collect()}
        assert got == want


def test_j10_has_the_hot_author(spark, con):
    want = con.execute(f"WITH {QA} SELECT author FROM qa WHERE author IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (WHERE length(trim(a_text)) > 20) > 1").fetchall()
    got = {r["author"]: r for r in QUERIES["j10_user_similarity"](spark, DATA).collect()}
    assert {a for (a,) in want} <= set(got) and "sheet_helper_bot" in got


def test_c48_is_of_authors(spark, con):
    compare(QUERIES["c48_response_pattern"](spark, DATA), con, f"WITH {QA} SELECT author, count(*) AS n, round(stddev_samp(length(a_text)) / avg(length(a_text)), 4) AS variation FROM qa WHERE a_text <> '' AND author IS NOT NULL GROUP BY 1 HAVING count(*) >= 3")


def test_consensus_is_rounded_as_its_sql_does(spark, tmp_path):
    # confidences of six places, whose weighted means often end in a five at the seventh
    rng = random.Random(59)
    part = lambda: rng.choice([None, rng.randrange(10**6) / 10**6, rng.randrange(10**6) / 10**6])
    rows = [(k, rng.choice([0.0, 0.7, 0.8, 0.9, 0.95]), part(), part()) for k in range(4000)]
    layers = spark.createDataFrame(rows, "id bigint, l1 double, l2 double, l3 double")
    layers.write.parquet(str(tmp_path / "l.parquet"))
    got = spark.sql(decision(SPARK, "SELECT * FROM {rows}"), rows=layers)
    compare(got, connect(str(tmp_path)), decision(DUCK, "SELECT * FROM l"))
    # what is rounded before that: doubles that are nearly a five at the seventh place
    fives = [(k, s * (10 * k + 5) / 10**7) for k in range(0, 200_000, 37) for s in (1, -1)] + [(-1, None), (-2, float("nan")), (-3, 0.0)]
    spark.createDataFrame(fives, "id bigint, x double").write.parquet(str(tmp_path / "fives.parquet"))
    got = spark.read.parquet(str(tmp_path / "fives.parquet")).selectExpr("id", f"{SPARK.round('x')} AS x")
    compare(got, connect(str(tmp_path)), f"SELECT id, {DUCK.round('x')} AS x FROM fives")
