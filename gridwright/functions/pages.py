"""Pages of a question community read into fields, as an Arrow-batched UDF."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import unquote, urljoin

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, LongType, MapType, StringType, StructField, StructType

# fixed values: class names that mark the parts of a page
QUESTION, ANSWER, BADGE, LABEL, VALUE, PAGES, PAGE, TAG = "post-content", "answer-content", "selected-answer-badge", "option-label", "option-value", "oppadu-pagination", "page-number", "post-tag"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
APART = frozenset(("p", "div", "li", "pre", "br", "h1"))
PAGE_FIELDS = StructType([StructField("title", StringType()), StructField("options", MapType(StringType(), StringType())), StructField("question", StringType()), StructField("answer", StringType()), StructField("votes", LongType()), StructField("views", LongType()), StructField("tags", ArrayType(StringType())), StructField("pages", ArrayType(StringType())), StructField("accepted", BooleanType())])


class _Page(HTMLParser):
    """Collects the text below marked elements; elements left open close with what holds them."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.stack, self.found, self.pages, self.views = base, [], [], [], None

    def handle_starttag(self, tag, attrs):
        if tag in APART:
            self.handle_data(" ")
        given = dict(attrs)
        kinds = set((given.get("class") or "").split())
        kinds.add("h1") if tag == "h1" else None
        if given.get("itemprop"):
            kinds.add(given["itemprop"])
        if "views" in kinds or (given.get("title") or "").startswith("Viewed"):
            kinds.add("views")
        if PAGE in kinds and given.get("href") and any(PAGES in k for _, k in self.stack):
            self.pages.append(urljoin(self.base, given["href"]))
        for kind in kinds & {QUESTION, ANSWER, BADGE, LABEL, VALUE, TAG, "h1", "upvoteCount", "views"}:
            self.found.append([kind, "", len(self.stack)])
        if tag not in VOID:
            self.stack.append((tag, kinds))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass
        for part in self.found:
            if part[2] is not None and part[2] >= len(self.stack):
                part[2] = None
        if tag in APART:
            self.handle_data(" ")

    def handle_data(self, data):
        if any(t in ("script", "style") for t, _ in self.stack):
            return
        for part in self.found:
            if part[2] is not None and part[2] < len(self.stack):
                part[1] += data

    def fields(self) -> dict:
        text = lambda s: " ".join(s.split())
        of = lambda kind: [text(p[1]) for p in self.found if p[0] == kind]
        number = lambda kind: next((int(d) for d in ("".join(c for c in t if c.isdigit() or c == "-") for t in of(kind)) if d.lstrip("-").isdigit()), None)
        first = lambda kind: next(iter(of(kind)), None)
        accepted = bool(of(BADGE))
        return {"title": first("h1"), "options": dict(zip(of(LABEL), of(VALUE))), "question": first(QUESTION), "answer": first(ANSWER) if accepted else None, "votes": number("upvoteCount"), "views": number("views"), "tags": list(dict.fromkeys(of(TAG))), "pages": list(dict.fromkeys(self.pages)), "accepted": accepted}


def read_page(base: str):
    """Fields of each page; relative links are resolved against ``base``.  Null gives null."""

    @pandas_udf(PAGE_FIELDS)
    def read(pages: pd.Series) -> pd.DataFrame:
        out = []
        for page in pages:
            parser = _Page(base)
            parser.feed(page or "")
            parser.close()
            out.append(parser.fields() if page is not None else dict.fromkeys(PAGE_FIELDS.names))
        return pd.DataFrame(out, columns=PAGE_FIELDS.names)

    return read


@pandas_udf(StringType())
def repaired_url(urls: pd.Series) -> pd.Series:
    """Percent codes resolved until none is left, HTML's ampersand and blanks mended, a scheme
    in front of a bare host; null where nothing is left."""

    def repair(url: str | None) -> str | None:
        text = (url or "").strip().replace("&amp;", "&")
        for _ in range(len(text)):
            plain = unquote(text)
            if plain == text:
                break
            text = plain
        text = text.replace(" ", "%20")
        return None if not text else "https:" + text if text.startswith("//") else text if "://" in text else "https://" + text

    return urls.map(repair)
