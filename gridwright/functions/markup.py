"""HTML and scanner functions that built-in expressions can't state, as Arrow-batched UDFs."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

SKIP = frozenset(("script", "style", "pre", "code", "img"))
BLOCKS = frozenset(("p", "br", "div", "li", "tr", "h1", "h2", "h3", "h4", "ul", "ol", "table", "blockquote"))


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.open, self.code, self.links = [], [], [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("pre", "code") and not any(t in ("pre", "code") for t in self.open):
            self.code.append("")
        if tag in SKIP and tag != "img":
            self.open.append(tag)
        if tag in BLOCKS:
            self.out.append(" ")
        if tag == "a":
            self.links.extend(v for k, v in attrs if k == "href" and v)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass
        if tag in BLOCKS:
            self.out.append(" ")

    def handle_data(self, data):
        if not self.open:
            self.out.append(data)
        elif self.open[-1] in ("pre", "code"):
            self.code[-1] += data


def _parse(text: str | None) -> _Text:
    parser = _Text()
    parser.feed(text or "")
    parser.close()
    return parser


@pandas_udf(StringType())
def html_text(texts: pd.Series) -> pd.Series:
    """Text without code, scripts and tags; entities resolved, white space single; null stays."""
    return texts.map(lambda t: None if t is None else " ".join("".join(_parse(t).out).split()))


@pandas_udf(ArrayType(StringType()))
def html_code(texts: pd.Series) -> pd.Series:
    """Distinct non-empty code blocks in order, normalised by white space."""
    return texts.map(lambda t: list(dict.fromkeys(" ".join(c.split()) for c in _parse(t).code if c.strip())))


@pandas_udf(ArrayType(StringType()))
def html_links(texts: pd.Series) -> pd.Series:
    """Distinct link targets in order."""
    return texts.map(lambda t: list(dict.fromkeys(_parse(t).links)))


def absolute_urls(base: str):
    @pandas_udf(StringType())
    def resolve(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: None if u is None else urljoin(base, u))

    return resolve


def _balanced(text: str | None) -> str | None:
    start = re.search(r"=[A-Za-z][A-Za-z0-9.]*\(", text or "")
    if not start:
        return None
    level, quoted = 0, False
    for k in range(start.end() - 1, len(text)):
        ch = text[k]
        quoted ^= ch == '"'
        if not quoted:
            level += (ch == "(") - (ch == ")")
            if level == 0:
                return text[start.start() : k + 1]
    return None


@pandas_udf(StringType())
def first_formula(texts: pd.Series) -> pd.Series:
    """The first formula with balanced parentheses, whatever its depth; null if there is none."""
    return texts.map(_balanced)


@pandas_udf(StringType())
def unescape_all(texts: pd.Series) -> pd.Series:
    """All entities, numeric ones and doubly escaped ones too."""
    return texts.map(lambda t: None if t is None else html.unescape(html.unescape(t)))
