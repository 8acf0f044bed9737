"""Copies of one cut answer change no result."""

from gridwright.llm.pairs import broken_pairs, pair_texts
from tests.llm.test_texts import SOUND, qa


def test_copies_of_a_cut_answer_are_found(spark):
    q, b, end = "How do I sum the orders in A1:B9?", "I already looked at MATCH and it only gives me zero.", "Make sure that both columns start on the same row."
    rows = [(k, q, b, (f"{s} {end}", None)) for k, s in enumerate(s for s in SOUND if s.isascii() and s.endswith("."))]
    rows += [(100 + k, q, b, (f"Step {w} is to sort the list by date. {end}", None)) for k, w in enumerate(("one", "two", "three", "four"))]
    rows += [(1000 + k, q, b, ("Put the formula in J29 and fill it down to the last row. Make sure that both columns start on the sa", None)) for k in range(40)]
    pairs = pair_texts(qa(spark, rows))
    got = {r["pair_id"]: r["defect"] for r in broken_pairs(pairs).collect()}
    assert got == {1000 + k: "truncated" for k in range(40)}
