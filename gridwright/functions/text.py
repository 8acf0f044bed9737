"""Text functions as Column expressions: they run inside generated code, without Python.

Patterns avoid classes whose meaning differs between regex dialects; white space is spelt out.
Null in gives null out unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[ \t\n\r\f\x0B]+"
FORMULA = r"=[A-Z][A-Z0-9.]*\([^()]*(?:\([^()]*\)[^()]*)*\)"
URL = r"https?://[A-Za-z0-9./?=&%#:_~+-]+"
#: fixed values: spreadsheet functions that mentions are looked up in
FUNCTIONS = ("SUM", "AVERAGE", "COUNT", "IF", "VLOOKUP", "HLOOKUP", "XLOOKUP", "INDEX", "MATCH", "SUMIF", "SUMIFS", "COUNTIF", "COUNTIFS", "AVERAGEIFS", "IFERROR", "LEFT", "MID", "RIGHT", "TRIM", "ROUND", "FILTER", "SORT", "UNIQUE", "OFFSET", "INDIRECT", "TEXTJOIN", "SUBSTITUTE")


def collapse(text: Column) -> Column:
    """White space collapsed to single blanks, ends trimmed."""
    return F.trim(F.regexp_replace(text, BLANK, " "))


def shorten(text: Column, most: int, mark: str = "...") -> Column:
    """Collapsed text of at most ``most`` characters, with a mark where it was cut."""
    one = collapse(text)
    return F.when(F.length(one) > most, F.concat(F.substring(one, 1, most), F.lit(mark))).otherwise(one)


def strip_markup(text: Column) -> Column:
    """Tags and entities to blanks, collapsed."""
    return collapse(F.regexp_replace(F.regexp_replace(text, "<[^<>]+>", " "), "&[A-Za-z0-9#]+;", " "))


def triage_text(text: Column) -> Column:
    """Tags and markdown images to blanks, then URLs to a mark; tags go first, as they hold URLs."""
    bare = F.regexp_replace(F.regexp_replace(text, "<[^<>]+>", " "), r"!\[[^\[\]]*\]\([^()]*\)", " ")
    return collapse(F.regexp_replace(bare, URL, "[URL]"))


def unescape(text: Column) -> Column:
    """The named entities of text, doubly escaped ones first."""
    for entity, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def has_code(text: Column) -> Column:
    """Fenced or inline code, a code tag, or a formula."""
    return text.rlike(r"(?s)```.*```|`[^`\n]+`|<code>|<pre>|=[A-Z]+\(")


def formulas(text: Column) -> Column:
    """Distinct formulas in order of their first place."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(FORMULA), F.lit(0)))


def called_functions(text: Column, known: Sequence[str] = FUNCTIONS) -> Column:
    """Known functions that are called, with repeats, in order."""
    calls = F.regexp_extract_all(F.upper(text), F.lit(r"([A-Z][A-Z0-9_]*) ?\("), F.lit(1))
    return F.filter(calls, lambda x: x.isin(list(known)))


def mentions(text: Column, words: Sequence[str]) -> Column:
    """Words that occur as substrings, whatever their case."""
    low = F.lower(text)
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, F.lower(w)))


def count_mentions(text: Column, words: Sequence[str]) -> Column:
    low = F.lower(text)
    return sum((F.contains(low, F.lit(w.lower())).cast("int") for w in words[1:]), F.contains(low, F.lit(words[0].lower())).cast("int"))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, BLANK), lambda w: w != ""))


def char_grams(text: Column, n: int = 3) -> Column:
    """Distinct character n-grams; none of shorter texts."""
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Intersection over union of two sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def language_of_code(text: Column) -> Column:
    """vba, excel, sql, python, javascript or unknown, by the first that shows."""
    return (
        F.when(text.rlike(r"(?i)\b(sub|function) [a-z_0-9]+\(|\bdim [a-z]+ as\b|end sub"), "vba").when(text.rlike(FORMULA), "excel").when(text.rlike(r"(?i)\bselect\b[^;]*\bfrom\b"), "sql")
        .when(text.rlike(r"\bdef [a-z_]+\(|\bimport [a-z_]+\b"), "python").when(text.rlike(r"\bconst [a-z]|\bfunction *\(|=>"), "javascript").otherwise("unknown")
    )


def title_key(title: Column) -> Column:
    """Title as it is compared: no tags, one exclamation, single blanks, no reply prefix."""
    one = F.regexp_replace(F.regexp_replace(title, "<[^<>]+>", ""), "[!?]{2,}", "!")
    bare = collapse(F.regexp_replace(collapse(one), r"^(?:(?:[Rr][Ee]|[Ff][Ww][Dd]|[Qq]) ?: ?)+", ""))
    return F.when(bare == "", F.lit("no title")).otherwise(F.coalesce(bare, F.lit("no title")))
