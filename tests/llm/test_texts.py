import math
import random
import re

import numpy as np

from gridwright.llm import reading
from gridwright.llm.pairs import broken_pairs, copies, cut_sentences, judged_pairs, pair_texts, stops_short
from gridwright.llm.queries_p3 import residue_records
from gridwright.llm.residue import ResidueModel, coverage, find_residue, flat_codes, natural_counts

SOUND = [
    "Put the formula in J29 and fill it down to the last row. Make sure that both columns start on the same row.",
    "Error 404 in your macro only means that the web address in F49 is wrong. Lock the range with dollar signs.",
    "The {0} in that format call gets replaced by the value in B2, so leave it alone. Have a nice day",
    "In the office script, write `range ${row}` with a backtick, then the name is filled in. Works for me",
    "Your add-in needs JavaScript switched on in the Trust Center, then SUM loads again. Check the last column of the list.",
    "Unfortunately there is no built-in way to do that by color, so a helper column it is. Sort by that column afterwards.",
    "날짜가 텍스트로 저장되어 있으니 먼저 변환해 주세요. 두 열이 같은 행에서 시작하는지 꼭 확인하시기 바랍니다.",
    "메일 병합의 «이름» 표시는 미리 보기를 누르면 실제 값으로 바뀝니다. 먼저 자료를 표로 바꾸면 범위가 늘어납니다.",
    "=IFERROR(INDEX(A2:A9, MATCH(1, B2:B9, 0)), \"\")",
    "Yes",
]
RESIDUE = ["Lorem ipsum dolor sit amet nisi urna.", "404 Not Found", "Try this: <steps>", "<div class=\"x\">$ANSWER$</div>", "<html><head><title>502 Bad Gateway</title></head><body><hr>web/1.2</body></html>", "Please enable JavaScript to view this page.", "이 페이지를 보려면 JavaScript 사용이 필요합니다", "{{answer}}", "Try this: [paste formula here]", "Dear #{name},\n\n[[content]]\n\nBest wishes", "hgjfkd lskdjf ghfjdk slaskdj", "여기에 텍스트를 넣으세요", "XX_FORMULA_XX"]
QA = "pair_id bigint, source string, question struct<title string, body string, text string, body_markdown string, id string>, answer struct<text string, body_markdown string>, text string, defect string"


def test_residue_and_sound_texts(spark):
    rows = [(k, t) for k, t in enumerate(SOUND * 30)] + [(1000 + k, t) for k, t in enumerate(RESIDUE)] + [(-1, None), (-2, ""), (-3, " ​"), (-4, "n/a")]
    df = spark.createDataFrame(rows, "id bigint, text string").withColumnRenamed("id", "residue_id")
    model = ResidueModel(natural_counts(df.select("text")))
    got = {r["residue_id"]: r["residue"] for r in find_residue(df, model).collect()}
    assert [t for k, t in rows if k >= 1000 and not got[k]] == []
    assert {t for k, t in rows if k < 1000 and got[k]} == set()
    assert find_residue(df.filter("false"), model).count() == 0
    long = "Put the formula in J29 and fill it down. " * 5000
    assert model.judge([long, "Lorem ipsum dolor sit amet " * 5000])[0] == [False, True]


def qa(spark, rows):
    return spark.createDataFrame([(k, "s", (q, b, f"{q}\n{b}", None, "1"), a, "x", "x") for k, q, b, a in rows], QA)


def test_defects(spark):
    q, b = "How do I sum the orders in A1:B9 of Book_2020.xlsx?", "I already looked at MATCH and it only gives me zero. The file has about 900 rows, so doing it by hand is not an option."
    full = "Put the formula in J29 and fill it down to the last row."
    rows = [(k, q, b, (s, s)) for k, s in enumerate([s for s in SOUND if s.isascii()] * 20)]
    rows += [(900 + k, q, b, (f"{full} {full}", None)) for k in range(30)]
    bad = {
        1001: ("empty", (None, None)), 1002: ("empty", ("&nbsp;", "<p></p>")), 1003: ("empty", ("n/a", "")), 1004: ("truncated", (f"{full} Put the formula in J2 and fill it do", None)), 1005: ("truncated", (f"{full} =IFERROR(SUM(A1:A9), ", None)),
        1006: ("truncated", (f"{full} Make sure … (read more)", None)), 1007: ("truncated", ("Formula below:\nSub Foo()\n  Dim i As Long", None)), 1008: ("refusal", ("I'm sorry, but I can't help with this request. Thank you for understanding.", None)), 1009: ("refusal", ("죄송하지만 이 요청은 도와드릴 수 없습니다. 양해 부탁드립니다.", None)),
        1010: ("copies_question", (f"> {q}\n> {b}", None)), 1011: ("copies_question", ("You asked: " + b.lower(), None)), 1012: ("other_language", ("Die letzte Zeile muss in der Tabelle stehen, denn sonst findet die Formel nicht den richtigen Wert.", None)), 1013: ("empty", (" ", " ​")),
    }
    rows += [(k, q, b, a) for k, (_, a) in bad.items()] + [(1001, q, b, (None, None)), (2000, None, None, (full, None)), (2001, q, b, ("Lorem ipsum dolor sit amet nisi", None)), (2002, q, b, (f"> {b}\nPut the formula in J29 and fill it down to the last row. Make sure that both columns start on the same row.", None)), (None, q, b, (None, None))]
    pairs = pair_texts(qa(spark, rows))
    got = {r["pair_id"]: r["defect"] for r in broken_pairs(pairs).collect()}
    assert got == {k: d for k, (d, _) in bad.items()}
    none = pair_texts(qa(spark, rows).filter("false"))
    assert broken_pairs(none).count() == 0


def test_cut_sentences_equal_brute_force(spark):
    whole = {f"{w} {x} the sheet {y}.": n for w in ("take", "open the menu and take") for x, y, n in (("now", "again", 9), ("a", "b", 3))}
    ends = {s[:k]: 1 for s in whole for k in (3, 5, 11, 12, 14, 20)} | {"yes": 40, "take now the sheet again": 2, "done and tested": 7}
    counts = [(s, n, 0) for s, n in whole.items()] + [(s, 0, n) for s, n in ends.items()]
    df = spark.createDataFrame(counts, "sentence string, inner bigint, ends bigint")
    whole |= {e: n // 4 for e, n in ends.items() if n // 4}
    want = {e for e, n in ends.items() if any(s.startswith(e) and s != e and any(c.isalpha() for c in s[len(e) :]) and sum(c.isalpha() for c in s[len(e) :]) >= 2 and m >= 3 * n for s, m in whole.items())}
    assert {r["tail"] for r in cut_sentences(df).collect()} == want


def test_cut_sentences_across_ranges(spark):
    rng = random.Random(4)
    words = ["take", "the", "sheet", "now", "of", "a", "row"]
    counts = {" ".join(rng.choices(words, k=rng.randrange(1, 7)))[: rng.randrange(3, 40)]: (rng.choice([0, 0, 1, 4, 30]), rng.choice([0, 1, 2, 9])) for _ in range(1500)}
    df = spark.createDataFrame([(s, a, b) for s, (a, b) in counts.items()], "sentence string, inner bigint, ends bigint").repartition(5)
    whole = {s: max(a, b // 4) for s, (a, b) in counts.items()}
    want = {e for e, (_, n) in counts.items() if n and any(s != e and s.startswith(e) and m >= 3 * n and re.search("[a-z]{2,}", s[len(e) :]) for s, m in whole.items())}
    got = [r["tail"] for r in cut_sentences(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 30


def test_a_planted_length_limit_is_found(spark):
    rng = random.Random(6)
    words = "sort group list match filter convert copy total rank column sheet table range value formula pivot chart macro cell".split()
    said = lambda n: (" ".join(rng.choices(words, k=80)))[:n]
    rows = [(k, "q", "b", (said(200), None)) for k in range(60)] + [(1000 + k, "q", "b", (said(100 + k), None)) for k in range(300)] + [(5000 + k, "q", "b", (said(rng.randrange(30, 90)) + ".", None)) for k in range(50)]
    got = {r["pair_id"] for r in judged_pairs(pair_texts(qa(spark, rows))).filter("limit").collect()}
    assert got == set(range(60)) | {1100}


def test_flat_codes_equal_one_text_at_a_time():
    texts = ["", "a", "use sum.", "가나다라 마바사", "x" * 40, "lorem ipsum dolor sit amet", "", "1 2"]
    flat = flat_codes(texts)
    model = np.random.default_rng(3).integers(-4096, 4096, 1 << 19).astype(np.int32)
    together = coverage(model, flat, 0.0)
    for k, t in enumerate(texts):
        alone = flat_codes([t])
        assert (alone[0] == flat[0][flat[2][k] : flat[2][k] + flat[3][k]]).all() and coverage(model, alone, 0.0)[0] == together[k]


def test_endings():
    assert not stops_short("Use =SUM(A1:A9)") and not stops_short("=IF(A1>1, SUM(B2), 0)") and not stops_short("1. one\n2. two")
    assert stops_short("Formula below:") and stops_short("=SUM(A1:A") and stops_short("one. 2. two. 3.") and stops_short("text … (계속)")
    assert copies("I have a sheet with orders in it", "I have a sheet with orders in it and more")
    assert not copies("Yes", "Yes it is")


def test_queries_run_over_the_test_tables(spark):
    assert residue_records(spark, "/root/testdata/sf0.001").filter("residue").count() > 0


def test_reading_levels(spark):
    easy = "The cat sat on the mat. It is a good cat. I like the cat. We go to the shop. You can see the dog. " * 2
    hard = "Contemporary institutional methodologies presuppose comprehensive documentation of the computational specifications, notwithstanding considerable epistemological disagreement concerning the interpretation of quantitative representations. " * 3
    table = "| a | b |\n|---|---|\n" + "| x | 1 |\n" * 30
    code = "```\n" + "for institutional in methodologies: presuppose(comprehensive)\n" * 9 + "```"
    german = "Die Nachvollziehbarkeit der Berechnungen setzt voraus, dass die Ergebnisse einschließlich ihrer Voraussetzungen dokumentiert und unabhängig überprüfbar sind. " * 3
    listed = "\n".join("- " + s.strip().rstrip(".") for s in hard.split(". ") if s)
    rows = [(1, easy), (2, hard), (3, table), (4, code), (5, german), (6, listed), (7, None), (8, " "), (9, easy + table), (10, hard + "\n=IFERROR(SUM(A1:A9), 0)\n" + code), (11, hard * 300), (12, "한국어 문서를 읽고 있습니다. " * 12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (2, "a", 18), (None, "a", 5), (9, "a", 3)], "doc_id bigint, rater string, grade bigint")
    got = {r["doc_id"]: r for r in reading.reading_levels(df, labels).collect()}
    found = {r["doc_id"] for r in reading.university_prose(reading.reading_levels(df, labels)).collect()}
    assert found == {2, 6, 10, 11}
    assert got[3]["level"] is None and got[4]["level"] is None and got[7]["level"] is None and got[5]["prose_lang"] == "de" and got[12]["prose_lang"] == "ko"
    assert reading.reading_levels(df.filter("false"), labels).count() == 0
    assert reading.rising_curve([1, 1, 2, 3], [2, 4, 3, 9]) == ([4 / 3, 3.0], [3.0, 9.0])
    assert all(reading.syllables(w) == n for w, n in {"the": 1, "table": 2, "contemporary": 5, "institutional": 5, "make": 1, "wanted": 2, "jumped": 1, "idea": 3, "people": 2, "create": 2, "heterogeneous": 6, "social": 2, "various": 3}.items())
    assert not math.isnan(got[2]["level"])


def test_counts_do_not_depend_on_the_batch():
    texts = ["The cat sat on the mat.\nE.g. a cat, i.e. one cat. Z. B. nothing else here to see.", None, "", "Sub Foo()\n  Dim i\nEnd Sub\n1, 2, 3\nSums of A1:B9 are shown in the last column of the table.", "- one item of the list is here\n- The SUMIFS function adds what it is told to add\n\n| a | b |\n", "한국어 문서를 읽고 있습니다. 표는 보지 않습니다.", "Die Tabelle ist nicht leer, und der Wert ist hier."] * 3
    together = reading.WordCounter().counts(texts)
    assert together == [reading.WordCounter().counts([t])[0] for t in texts]
    assert together[0] == {"lang": "en", "words": 21, "sentences": 3, "letters": together[0]["letters"], "syllables": together[0]["syllables"], "long": together[0]["long"], "hard": together[0]["hard"]} and together[5]["lang"] == "ko" and together[6]["lang"] == "de" and together[1]["words"] == 0


def test_held_out_levels_tell_university_prose(spark):
    """Each labelled document is left out of the fit that judges it."""
    data = "/root/testdata/sf0.1"
    labels = [tuple(r) for r in spark.read.parquet(f"{data}/reading_labels.parquet").select("doc_id", "grade").collect()]
    grades = {d: sorted(g for e, g in labels if e == d) for d, _ in labels}
    docs = spark.read.parquet(f"{data}/documents.parquet").join(spark.createDataFrame([(d,) for d in grades], "doc_id bigint"), "doc_id", "left_semi")
    raw = {r["doc_id"]: r["raw_level"] for r in reading.levels(docs).filter("raw_level is not null").collect()}
    wrong = 0
    for left in raw:
        x, y = reading.rising_curve(*zip(*[(raw[d], sum(grades[d]) / len(grades[d])) for d in raw if d != left]))
        wrong += (np.interp(raw[left], x, y) >= reading.UNIVERSITY) != (sum(grades[left]) / len(grades[left]) >= 15.5)
    assert len(raw) > 30 and wrong <= 1
