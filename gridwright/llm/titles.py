"""Titles as vectors of weighted tokens, and the exact comparison of two titles.

A title's vector has a coordinate for each word and for each thing it names: workbook, cell
range, the range's far corner, number of rows.  Weights are powers of inverse document
frequencies, so what few titles share carries nearly the whole length of the vector.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from functools import lru_cache


#: What a title names, in a part between blanks that isn't a plain word: cell range, workbook,
#: number, or words after all.
PARTS = re.compile(
    r"(?<![a-z0-9])(?:(?P<range>\$?[a-z]{1,3}\$?\d{1,7}:?\$?[a-z]{1,3}\$?\d{1,7}(?![a-z0-9]))"
    r"|(?P<book>(?:tbl[a-z]{3,}|[a-z]{4,}(?:-[a-z]{4,})?_?\d{2,4}(?:\.?xl[a-z]{1,2})?|[a-z]{4,}-[a-z]{4,}|[a-z_0-9-]{3,}\.xl[a-z]{1,2}|[a-z]{4,}_[a-z0-9_]{2,})(?![a-z0-9]))"
    r"|(?P<number>\d{3,8}(?![a-z0-9])))|(?P<word>[가-힣]+|[^\W\d_]{2,})"
)
COLON = re.compile(r"\s*:\s*")
EXTENSION = re.compile(r"\.?xl[a-z]{1,2}$")
DECORATION = re.compile(r"^(?:\s*(?:re|fwd|q|질문|help|urgent|급해요!?)\s*[:!])+|[\[(](?:solved|again|excel|질문|help|closed|duplicate|해결)[\])]|(?:\s[-–]?\s*(?:help|plz|please|thanks!?|급합니다|\?{2,}))+\s*$|[.…?!]+\s*$")
#: What a title with DECORATION begins with, holds or ends with; few do, and need the pattern.
TAGS = re.compile(r"[\[(](?:solved|again|excel|질문|help|closed|duplicate|해결)[\])]")
STARTS = ("re", "fwd", "q", "질문", "help", "urgent", "급해요")
ENDS = ("help", "plz", "please", "thanks", "급합니다", ".", "…", "?", "!")


def normal(title: str | None) -> str:
    """Title without layout: entities resolved, compatibility forms folded, small letters,
    single blanks, no decoration at its ends.  '' if it has no letter or digit."""
    if not title:
        return ""
    text = title
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = " ".join(text.lower().split())
    if text.endswith(ENDS) or text.startswith(STARTS) or (("(" in text or "[" in text) and TAGS.search(text)):
        text = " ".join(DECORATION.sub(" ", text).split())
    return text if text[:1].isalnum() or any(c.isalnum() for c in text) else ""


def named(text: str) -> tuple[list[str], list[str], list[str], list[str]]:
    """Workbooks, ranges (as a1b2), numbers and words of a normal title."""
    books, ranges, numbers, words, rest = [], [], [], [], []
    for piece in COLON.sub(":", text).split() if " :" in text or ": " in text else text.split():
        if not piece.isalpha():
            rest.append(piece)
        elif len(piece) > 5 and piece.startswith("tbl"):
            books.append(piece)
        elif len(piece) > 1:
            words.append(piece)
    # no match of the pattern holds a blank, so all other parts are searched at once
    for corners, book, number, word in PARTS.findall(" ".join(rest)):
        if corners:
            ranges.append(corners.replace(":", "").replace("$", ""))
        elif book:
            books.append(EXTENSION.sub("", book).replace("-", "").replace("_", "").replace(".", ""))
        elif number:
            numbers.append(number)
        else:
            words.append(word)
    return books, ranges, numbers, words


CORNER = re.compile(r"[a-z]{1,3}\d+$")


def tokens(text: str) -> tuple[set[str], bool]:
    """Coordinates of a normal title - b: workbook, r: range, c: far corner, n: number, words -
    and whether it names a workbook, range or number."""
    books, ranges, numbers, words = named(text)
    out = set(words)
    for mark, those in (("b:", books), ("r:", ranges), ("n:", numbers)):
        for name in those:
            out.add(mark + name)
    for r in ranges:
        out.add("c:" + CORNER.search(r).group())
    return out, bool(books or ranges or numbers)


class Weights:
    """Token weights, by source, from document frequencies of all titles.

    The weight is the inverse document frequency to the power POWER; a token that isn't frequent
    has the greatest weight, that of one in RARE titles (or in all, if they are fewer).
    """

    POWER, RARE = 3, 40_000

    def __init__(self, titles: dict[str, int], frequent: dict[tuple[str, str], int]):
        size = {s: max(n, 2) for s, n in titles.items()}
        self.most = math.log(min(self.RARE, max(size.values(), default=2))) ** (2 * self.POWER)
        #: squared weights by source
        self.square: dict[str, dict[str, float]] = {}
        for (s, t), n in frequent.items():
            self.square.setdefault(s, {})[t] = math.log(size.get(s, 2) / min(n, size.get(s, 2))) ** (2 * self.POWER)
        #: of the sources met so far, the frequent tokens' squared lengths, negative
        self._ready: dict[str, dict[str, float]] = {}

    def _length(self, token: str, square: float) -> float:
        """Squared length of a frequent token's coordinate."""
        if token[:2] not in NAMES:
            return square
        return max(square, (self.most * CORNER_SHARE if token[:2] == "c:" else self.most) * NAME_SHARE)

    def probes(self, source: str, found: set[str], bound: float) -> tuple[list[str], list[float]]:
        """The longest coordinates, until what is left of the vector is shorter than ``bound``,
        and the unit vector's coordinates there.

        Two vectors of cosine ``bound`` or more share a coordinate among their probes: tokens
        are ordered the same way everywhere, and a vector's other coordinates together are
        too short for that cosine.  A range's corner is shorter than what it belongs to, and
        what a title names never gets shorter than NAME_SHARE of its squared length, however
        frequent: many copies of one question still lie near one another.
        """
        known = self._ready.get(source)
        if known is None:
            known = self._ready[source] = {t: -self._length(t, w) for t, w in self.square.get(source, {}).items()}
        rare, corner = -self.most, -(self.most * CORNER_SHARE)
        ranked = sorted([(known[t] if t in known else corner if t[:2] == "c:" else rare, t) for t in found])
        whole = left = -sum([w for w, _ in ranked])
        least = bound * bound * whole
        out, parts = [], []
        for w, t in ranked:
            if left < least or not w:
                break
            out.append(t)
            parts.append(math.sqrt(-w / whole))
            left += w
        return out, parts


#: Squared length of a corner's coordinate against that of the range.
CORNER_SHARE = 0.45
#: Least squared length of a frequent name against that of a rare one, and the names' marks.
NAME_SHARE, NAMES = 0.3, ("b:", "r:", "n:", "c:")


@lru_cache(1 << 10)
def word_grams(text: str) -> frozenset[str]:
    """Letter trigrams of a title's words, whatever their order.

    A title is compared with several others in a row, and words come again in many titles.
    """
    return frozenset().union(*map(grams_of, WORD.findall(text)))


@lru_cache(1 << 13)
def grams_of(word: str) -> frozenset[str]:
    padded = f"^{word}$"
    return frozenset([padded[k : k + 3] for k in range(len(padded) - 2)])


WORD = re.compile(r"[^\W_]+")


def dice(a: frozenset[str], b: frozenset[str]) -> float:
    return 2 * len(a & b) / max(1, len(a) + len(b))


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        new = [i]
        for j, cb in enumerate(b, 1):
            cost = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (ca != cb))
            if before and i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == cb:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


def agree(a: list[str], b: list[str], most: int) -> bool:
    return any(x == y for x in a for y in b) or any(edits(x, y, most) <= most for x in a for y in b)


#: Share of word trigrams that two titles of one question have in common at least.
SAME = 0.76


def same_question(a: str, b: str) -> bool:
    """Whether two normal titles are one question: the same words but for small edits (shared
    trigrams), and the same workbook or the same range (or number of rows, where a title names
    no range), small edits aside.  It implies no cosine: see the README for what cells lose."""
    if a == b:
        return tokens(a)[1]
    if dice(word_grams(a), word_grams(b)) < SAME:
        return False
    books_a, ranges_a, numbers_a, _ = named(a)
    books_b, ranges_b, numbers_b, _ = named(b)
    return agree(books_a, books_b, 2) or agree(ranges_a, ranges_b, 1) or agree(numbers_a, numbers_b, 1)
