import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridwright.llm import titles as titles_module
from gridwright.llm.history import TITLES, HistoryIndex, record_key, with_tokens
from gridwright.llm.titles import normal, same_question, tokens

TITLE = "Macro to merge 41000 dated machines from Norlis40 into K241:P4807 past midnight"
OTHER = "Macro to merge 41000 dated machines from Kunfri-Vormab into A17:C5210 past midnight"


def test_keys(spark):
    forms = [("stackoverflow", f) for f in ("60012527", " 60012527 ", "0060012527", "60012527.0", "so-60012527", "q:60012527", "/q/60012527?tab=votes", "/questions/60012527/a-b-12")]
    forms += [("reddit", f) for f in ("1xfinwd", "1XFINWD", "t3_1xfinwd", " T3_1XFINWD", "/comments/1xfinwd?sort=top", "/r/sheets/comments/1xfinwd/quiiva/")]
    forms += [("oppadu", f) for f in ("521404", "0521404", "521404_answer", "oppadu_521404", "?uid=521404", "/community/question/?uid=521404", "OPD-521404")]
    forms += [("reddit", None), ("oppadu", " "), (None, "x")]
    got = [r[0] for r in spark.createDataFrame(forms, "s string, e string").select(record_key(F.col("s"), F.col("e"))).collect()]
    assert got == ["60012527"] * 8 + ["1xfinwd"] * 6 + ["521404"] * 7 + [None, None, "x"]


def test_titles():
    a = normal(TITLE)
    for same in ("(Solved) " + TITLE, TITLE.upper() + " ???", TITLE.replace("merge", "mereg"), "past midnight " + TITLE[: -len("past midnight")], TITLE.replace(" ", "  ") + "&nbsp;", TITLE.replace("K241:P4807", "K241 : P4807"), "".join(chr(ord(c) + 0xFEE0) if c.isalnum() else c for c in TITLE), TITLE.replace("Norlis40", "Norlsi40")):
        assert same_question(a, normal(same)), same
    for other in (OTHER, TITLE.split(" from")[0] + " from Zurkal77 into B9:D100 by weekday", "Macro to sort names from Norlis40 into K241:P4807 with one formula and a chart"):
        assert not same_question(a, normal(other)), other
    assert normal(None) == normal(" \n") == normal("???") == "" and not same_question("매크로 질문", "매크로 질문")


def mutate(rng, title):
    words = title.split(" ")
    k = rng.randrange(len(words) - 1)
    kind = rng.randrange(4)
    if kind == 0:
        words[k], words[k + 1] = words[k + 1], words[k]
    elif kind == 1:
        del words[rng.choice([0, 1, 2])]
    elif kind == 2:
        words[k] = words[k][:1] + words[k]
    return " ".join(words).upper() if kind == 3 else " ".join(words)


def test_index_equals_comparing_all_pairs(spark, tmp_path):
    rng = random.Random(8)
    syl = ["kun", "fri", "mab", "zur", "tel", "gim", "yor", "pra", "los", "vex"]
    name = lambda: "".join(rng.sample(syl, 3)).capitalize() + str(rng.randrange(10, 99))
    fresh = lambda: f"{rng.choice(['Macro to', 'How do I', 'Need to'])} {rng.choice(['merge', 'sort', 'count'])} {rng.randrange(10**3, 10**5)} {rng.choice(['dated', 'late', 'hidden'])} {rng.choice(['machines', 'orders', 'routes'])} from {name()} into {rng.choice('ABCD')}{rng.randrange(1, 700)}:{rng.choice('PQRS')}{rng.randrange(800, 5000)} {rng.choice(['past midnight', 'per week', 'by color'])}"
    history = [("so", str(k), fresh()) for k in range(150)] + [("so", "h", "VBA question"), ("so", None, None)]
    items = []
    for k in range(1, 121):
        roll = rng.random()
        title = mutate(rng, rng.choice(history[:150])[2]) if roll < 0.3 else mutate(rng, rng.choice(items)[3]) if roll < 0.45 and items else fresh()
        items.append(("so", k, f"n{k}" if rng.random() > 0.1 else str(rng.randrange(150)), title))
    items += [("so", 200, None, None), ("re", 201, "5", history[0][2]), ("so", 202, None, "VBA question"), ("so", 203, "n5", "x"), ("so", 204, None, TITLE), ("so", 205, None, TITLE)]
    want, seen, keys = set(), [("so", t) for _, _, t in history if t], {(s, k) for s, k, _ in history if k}
    for s, k, key, title in items:
        text = normal(title)
        if (s, key) in keys and key or text and any(s == s2 and same_question(text, normal(t)) for s2, t in seen):
            want.add(k)
        keys.add((s, key))
        seen.append((s, title)) if title else None
    hist = spark.createDataFrame(history, "source string, key string, title string")
    batch = spark.createDataFrame(items, "source string, ord bigint, key string, title string").withColumn("vid", F.lit("clash"))
    found = {r["ord"] for r in HistoryIndex(spark).build(hist).check(batch, append=False).collect()}
    assert found <= want and len(found) >= 0.97 * len(want)
    # batch after batch, from a stored index, gives the same
    path = str(tmp_path / "index")
    HistoryIndex(spark, path).build(hist)
    parts = set()
    for n, (lo, hi) in enumerate(((0, 60), (60, 130), (130, 300))):
        index = HistoryIndex.open(spark, path)
        parts |= {r["ord"] for r in index.check(batch.filter(f"ord > {lo} and ord <= {hi}"), f"b{n}").collect()}
    assert parts == found
    assert HistoryIndex(spark).build(hist.filter("false")).check(batch.filter("false")).count() == 0


def test_many_near_copies_of_one_question(spark):
    rng = random.Random(12)

    def typo(title):
        words = title.split(" ")
        for _ in range(rng.randrange(1, 3)):
            k = rng.choice([j for j, w in enumerate(words) if w.isalpha() and len(w) > 3])
            at = rng.randrange(1, len(words[k]))
            words[k] = words[k][:at] + rng.choice("abcdefghij") + words[k][at:]
        return " ".join(words)

    history = [("so", str(k), typo(TITLE)) for k in range(150)] + [("so", f"x{k}", f"Need to sort {k * 977 + 1000} late routes from Zur{'abcdefghij'[k % 10]}tel{k % 90 + 10} into B{k + 1}:T{k * 13 + 900} by color") for k in range(150)]
    items = [("so", k, None, typo(TITLE)) for k in range(1, 100)] + [("so", 200, None, OTHER), ("so", 201, None, TITLE.split(" from")[0] + " from Norlis40 with a chart of the monthly budget")]
    index = HistoryIndex(spark).build(spark.createDataFrame(history, "source string, key string, title string"))
    assert "b:norlis40" in index.weights.square["so"]
    found = {r["ord"] for r in index.check(spark.createDataFrame(items, "source string, ord bigint, key string, title string"), append=False).collect()}
    assert found == set(range(1, 100))


def test_tokens():
    found, names = tokens(normal(TITLE))
    assert {"b:norlis40", "r:k241p4807", "c:p4807", "n:41000"} <= found and names
    assert not tokens("vba question")[1]


def test_batches_find_what_one_pass_finds(spark):
    from gridwright.llm.queries import QUERIES

    data = "/root/testdata/sf0.001"
    whole = {r["item_id"] for r in QUERIES["p2_found"](spark, data).collect()}
    parts = [r["item_id"] for r in QUERIES["p2_batches"](spark, data).collect()]
    assert len(parts) == len(set(parts)) and set(parts) == whole


def test_a_crowded_cell_loses_nothing(spark):
    # near copies of one question fill its cells; another question about the same range is in them too
    near = [("reddit", None, f"sum of late invoices {'x' * (k % 3)}in D11:F{900 + k % 2} of Norlis{40 + k} by month") for k in range(80)]
    hist = spark.createDataFrame(near, "source string, key string, title string")
    items = [("reddit", 1, None, "sum of late invoices in D11:F900 of Norlis77 by month"), ("reddit", 2, None, "sum of late invoices in D11:F900 of Zzgrat99 by month"), ("reddit", 3, None, "how to draw a map of harbours from D11:F900 with colours"), ("reddit", 4, None, "how to draw a map of harbours from D11:F900 with colour")]
    found = HistoryIndex(spark).build(hist).check(spark.createDataFrame(items, "source string, ord bigint, key string, title string"))
    assert {r["ord"] for r in found.collect()} == {1, 2, 4}


def test_a_batch_reads_its_own_folders_only(spark):
    hist = spark.createDataFrame([("stackoverflow", str(k), f"count rows of Kelgus{k} in B{k}:F{k + 900} by group {k}") for k in range(3000)], "source string, key string, title string")
    index = HistoryIndex(spark).build(hist)
    found = index.check(spark.createDataFrame([("stackoverflow", 1, "77", "count rows of Kelgus55 in B55:F955 by group 55")], "source string, ord bigint, key string, title string"))
    assert [r["ord"] for r in found.collect()] == [1]
    assert index.read["keys"] == (1, 1) and index.read["cells"][0] <= 8 < index.buckets and index.read["cells"][1] < 60


def test_weights_are_counted_over_every_title(spark):
    # one task that writes its counts out more than once, and three small ones
    ids = spark.range(0, 110_000, 1, 1).unionByName(spark.range(110_000, 120_000, 1, 3))
    # in 15 of 120,000 titles, or 5 of 40,000, a word is frequent; "rarely" is in 24, "seldom" in 15, "never" in 14
    word = "CASE WHEN id % 5000 = 7 THEN ' rarely' WHEN id % 8000 = 8 THEN ' seldom' WHEN id % 8000 = 9 AND id > 9 THEN ' never' ELSE '' END"
    titles = ids.selectExpr("'so' AS source", "CAST(id AS STRING) AS key", f"concat('sum of rows from A', id + 1, ':C', id + 1, {word}) AS title")
    few = spark.createDataFrame([("re", str(k), "sum of names" if k else None) for k in range(8)], "source string, key string, title string")
    index = HistoryIndex(spark).build(titles.unionByName(few))
    so = {"sum": 0.0, "of": 0.0, "rows": 0.0, "from": 0.0, "rarely": math.log(120_000 / 24) ** 6, "seldom": math.log(120_000 / 15) ** 6}
    assert index.weights.square == {"so": pytest.approx(so), "re": {"sum": 0.0, "of": 0.0, "names": 0.0}}
    assert index.weights.most == pytest.approx(math.log(40_000) ** 6)
    found = index.check(spark.createDataFrame([("so", 1, None, "sum of rows from A8:C8 rarely"), ("so", 2, None, "count of names in Norlis40")], "source string, ord bigint, key string, title string"))
    assert [r["ord"] for r in found.collect()] == [1]


def test_a_task_packs_its_counts(spark):
    rows = [("so", str(k), f"sum of rows from A{k + 1}:C{k + 1} in Norlis{k % 50 + 10}") for k in range(3000)] + [("re", "x", None), (None, "y", "sum of names")]
    frame = spark.createDataFrame(rows, "source string, key string, title string").coalesce(2)
    counts = with_tokens(frame).filter("n is not null").collect()
    assert len(counts) < 200  # each task met some 3,000 tokens and more
    got, want = Counter(), Counter()
    for r in counts:
        for t in r["token"].split(" "):
            got[r["source"], t] += r["n"]
    for source, _, title in rows:
        if title:
            want.update((source, t) for t in [TITLES, *tokens(normal(title))[0]])
    assert got == want


def test_a_plain_title_needs_no_pattern_for_decoration(monkeypatch):
    plain = ["sum of rows from A1:C9 in Norlis40", "can a formula merge rows (A1:C9)", "a question about helpers", "[draft] 매크로 질문"]
    decorated = ["Re: sum", "fwd :sum", "q! sum", "질문: 합계", "급해요!: sum", "sum (Solved) of", "[해결] sum", "sum - help", "sum plz", "sum please", "sum thanks", "sum thanks!", "합계 급합니다", "sum ??", "sum…", "sum.", "sum!", "sum?"]
    want = [" ".join(titles_module.DECORATION.sub(" ", " ".join(t.replace("…", "...").lower().split())).split()) for t in decorated]
    assert [normal(t) for t in decorated] == want and all(a != b.lower() for a, b in zip(want, decorated, strict=True))
    monkeypatch.setattr(titles_module, "DECORATION", None)
    assert [normal(t) for t in plain] == [t.lower() for t in plain]
