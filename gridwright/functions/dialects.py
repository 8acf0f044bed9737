"""SQL expressions that two engines read: Spark runs a rule, DuckDB checks it.

A rule is written once over a :class:`Dialect`; the dialect spells what the engines name
differently (regular expressions, lists, literals).  Numbers are doubles in both.
"""

from __future__ import annotations

from collections.abc import Sequence

#: What separates words, as ``str.split`` has it.
BLANKS = r"\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def num(x: float) -> str:
    """A double literal."""
    return f"{x!r}e0" if "e" not in repr(x) else repr(x)


def capped(x: str, most: float) -> str:
    return f"least(CAST({x} AS DOUBLE), {num(most)})"


def best(*scores: str) -> str:
    return "greatest(" + ", ".join(scores) + ")"


def when(*pairs: tuple[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {a} THEN {b}" for a, b in pairs) + f" ELSE {other} END"


class Dialect:
    def __init__(self, spark: bool):
        self.spark = spark

    def text(self, s: str) -> str:
        if self.spark:
            return 'r"' + s + '"'
        return "'" + s.replace("'", "''") + "'"

    def has(self, col: str, word: str) -> str:
        return f"contains({col}, {self.text(word)})"

    def any(self, col: str, words: Sequence[str]) -> str:
        return "(" + " OR ".join(self.has(col, w) for w in words) + ")"

    def count(self, col: str, words: Sequence[str]) -> str:
        """How many of the words the text has."""
        return "(" + " + ".join(f"CAST({self.has(col, w)} AS INT)" for w in words) + ")"

    def like(self, col: str, pattern: str) -> str:
        return f"{'regexp_like' if self.spark else 'regexp_matches'}({col}, {self.text(pattern)})"

    def any_like(self, col: str, patterns: Sequence[str]) -> str:
        return "(" + " OR ".join(self.like(col, p) for p in patterns) + ")"

    def count_like(self, col: str, patterns: Sequence[str]) -> str:
        return "(" + " + ".join(f"CAST({self.like(col, p)} AS INT)" for p in patterns) + ")"

    def times(self, col: str, pattern: str) -> str:
        """How often a pattern occurs."""
        return f"regexp_count({col}, {self.text(pattern)})" if self.spark else f"len(regexp_extract_all({col}, {self.text(pattern)}))"

    def words(self, col: str) -> str:
        return self.times(col, f"[^{BLANKS}]+")

    def parts(self, col: str, pattern: str) -> str:
        return f"split({col}, {self.text(pattern)}, -1)" if self.spark else f"regexp_split_to_array({col}, {self.text(pattern)})"

    def size(self, items: str) -> str:
        return f"size({items})" if self.spark else f"len({items})"

    def round(self, x: str) -> str:
        """A double to six places: the nearest whole number of millionths, as DuckDB rounds.

        Spark's ``round(x, 6)`` rounds the shortest decimal that reads as ``x`` instead, so the
        two part where that ends in a five.
        """
        return f"round(({x}) * {num(1e6)}) / {num(1e6)}" if self.spark else f"round({x}, 6)"

    def distinct(self, items: str) -> str:
        """Different items, blanks at their ends and case aside, empty ones left out."""
        ends = f"^[{BLANKS}]+|[{BLANKS}]+$"
        if self.spark:
            return f"array_distinct(filter(transform({items}, x -> lower(regexp_replace(x, {self.text(ends)}, ''))), x -> x <> ''))"
        return f"list_distinct(list_filter(list_transform({items}, lambda x: lower(regexp_replace(x, {self.text(ends)}, '', 'g'))), lambda x: x <> ''))"


SPARK, DUCK = Dialect(True), Dialect(False)
