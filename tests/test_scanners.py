"""Scanners that SQL can't state, over whole tables against brute force."""

import os
import re

from gridwright.functions import markup
from gridwright.plans.registry import collect

DATA = os.environ.get("GRIDWRIGHT_TEST_DATA", "/root/testdata/sf0.001")
QUERIES, _ = collect()


def first_formula(text):
    """Tries every end for the first start: quotes closed and as many closing as opening parentheses."""
    start = re.search(r"=[A-Za-z][A-Za-z0-9.]*\(", text)
    for stop in range(start.end() + 1, len(text) + 1) if start else ():
        part = text[start.start() : stop]
        bare = "".join(part.split('"')[::2])
        if part.endswith(")") and part.count('"') % 2 == 0 and bare.count("(") == bare.count(")"):
            return part
    return None


def test_first_formulas_of_all_documents(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").filter("text is not null").select("doc_id", "text").collect()
    want = {r["doc_id"]: first_formula(r["text"]) for r in rows}
    got = {r["doc_id"]: r["formula"] for r in QUERIES["t28_first_formula"](spark, DATA).collect()}
    assert got == {k: v for k, v in want.items() if v is not None} and got
    assert first_formula('=IF(A1=")", SUM(B1:B2), 0) and =X(') == markup._balanced('=IF(A1=")", SUM(B1:B2), 0) and =X(') == '=IF(A1=")", SUM(B1:B2), 0)'


def test_entities(spark):
    df = spark.createDataFrame([("&amp;lt;b&amp;gt; &#39;x&#x27; &eacute;&hellip; &notanentity;",), ("a & b",), (None,)], "t string")
    assert [r[0] for r in df.select(markup.unescape_all("t")).collect()] == ["<b> 'x' é… &notanentity;".replace("&not", "¬"), "a & b", None]
