"""Pages, links and stored records: fixed cases with their expected rows, and whole-table chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.functions import pages
from gridwright.functions import text as T
from gridwright.functions.dialects import DUCK, SPARK, Dialect, num, when
from gridwright.operators.relational import latest_by_key
from gridwright.plans.common import QA, qa
from gridwright.session import scratch_path, table

c = F.col
BASE = "https://community.example/board/"

# -- pages --------------------------------------------------------------------------------
PAGES = {
    "selected": """<html><head><title>x</title><script>var h1 = '<h1>no</h1>';</script></head><body><h1>Sum of two <em>sheets</em> &amp; a total</h1>
<div class="post-options-display"><div class="options-container"><div class="option-item"><span class="option-label">Excel</span><span class="option-value">M365</span></div>
<div class="option-item"><span class="option-label">OS</span> <span class="option-value">Win&nbsp;11</span></div></div></div>
<div class="post-content wide"><p>The total is <b>wrong</b>.</p><p>=SUM(A1:A9)<br>on two sheets</p></div>
<div class="answer-section"><div class="selected-answer-badge">accepted</div><div class="answer-content"><p>Use &lt;=&gt; and</p><ul><li>one<li>two</ul></div></div></body></html>""",
    "open": """<body><h1> No answer yet </h1><div class="post-content">Which function?</div><div class="answer-section"><div class="answer-content">maybe this</div></div></body>""",
    "list": """<div class="oppadu-pagination"><a class="page-number" href="?page=1">1</a><a class="page-number current" href="/board/?page=2">2</a><a class="page-number" href="?page=1">1</a><a href="?page=9">next</a></div><a class="page-number" href="?page=7">out</a>""",
    "question": """<h1 itemprop="name"><a href="/q/55/pivot">Pivot &gt; table</a></h1><div itemprop="upvoteCount" data-value="12">12</div><div class="flex" title="Viewed 1,234 times">Viewed 1,234 times</div><a class="post-tag" href="#">pivot</a><a class="post-tag">excel</a><a class="post-tag">pivot</a><div itemprop="text" class="post-content"><pre>a  b</pre>end""",
    "empty": "",
    "broken": """<h1>Half<div class="post-content">text <b>bold""",
}


def _pages(spark):
    rows = spark.createDataFrame(list(PAGES.items()), "name string, page string")
    return rows.select("name", pages.read_page(BASE)("page").alias("p"))


def s08_post_detail(spark, sf):
    """Title, version options, question and selected answer of a page."""
    return _pages(spark).select("name", "p.title", c("p.options")["Excel"].alias("excel"), c("p.options")["OS"].alias("os"), "p.question", "p.answer", "p.accepted")


def s09_pagination(spark, sf):
    """Links of a page bar, resolved, each once, in order."""
    return _pages(spark).select("name", F.posexplode("p.pages").alias("place", "link"))


def s10_question_page(spark, sf):
    """Votes, views and tags of a question page, and the id in its address."""
    ids = F.regexp_extract(F.lit("https://community.example/q/55/pivot"), r"/q/(\d+)", 1)
    return _pages(spark).filter("name = 'question'").select("name", ids.alias("id"), "p.votes", "p.views", F.array_join("p.tags", ",").alias("tags"), "p.question")


# -- links --------------------------------------------------------------------------------
IMAGE_TEXTS = (
    (1, "see ![shot](https://i.example/a.png) and ![](data:image/png;base64,AAAA)", "https://i.example/a.png"),
    (2, '<p><img alt="x" src="https://i.example/b.jpg?w=3"/> <img src=\'/rel/c.gif\'></p>', "https://i.example/b.jpg?w=3"),
    (3, "plain https://i.example/d.webp, and https://x.example/page", "https://i.example/d.webp"),
    (4, "twice https://i.example/e.PNG ![e](https://i.example/e.PNG)", "https://i.example/e.PNG"),
    (5, "nothing to see", ""), (6, None, None),
)
URLS = ((1, "https%3A%2F%2Fi.example%2Fa%20b.png", "https://i.example/a%20b.png"), (2, "https%253A%252F%252Fi.example%252Fc", "https://i.example/c"), (3, "//i.example/d?x=1&amp;y=2", "https://i.example/d?x=1&y=2"), (4, " i.example/e ", "https://i.example/e"), (5, "https://i.example/f", "https://i.example/f"), (6, "", None), (7, None, None))


def t07_image_urls(spark, sf):
    """Image links by three forms - markdown, tag, bare - that name an image, in order, each once."""
    rows = spark.createDataFrame([r[:2] for r in IMAGE_TEXTS], "id bigint, text string")
    forms = [F.regexp_extract_all("text", F.lit(p), F.lit(1)) for p in (r"!\[[^\]]*\]\((https?://[^()\s]+)\)", r"""(?i)<img[^>]+src=["'](https?://[^"']+)["']""", r"(https?://[A-Za-z0-9./?=&%_~-]+)")]
    urls = F.filter(F.array_distinct(F.concat(*forms)), lambda u: u.rlike(r"(?i)\.(?:png|jpe?g|gif|webp)(?:$|\?)"))
    return rows.select("id", F.array_join(urls, " ").alias("urls"))


def t33_decode(spark, sf):
    return spark.createDataFrame([r[:2] for r in URLS], "id bigint, url string").select("id", pages.repaired_url("url").alias("url"))


# -- records ------------------------------------------------------------------------------
RESULTS = ((1, '{"complexity": "high", "steps": ["ocr", "code"], "score": 0.5, "extra": 1}', '{"complexity":"high","steps":["ocr","code"],"score":0.5}'), (2, '{"complexity": "low"}', '{"complexity":"low","steps":[],"score":0.0}'), (3, "not json", '{"complexity":"unknown","steps":[],"score":0.0}'), (4, None, '{"complexity":"unknown","steps":[],"score":0.0}'), (5, '{"score": 2, "steps": null}', '{"complexity":"unknown","steps":[],"score":2.0}'))


def pr13_round_trip(spark, sf):
    """An analysis result read from JSON with its defaults and written again."""
    rows = spark.createDataFrame([r[:2] for r in RESULTS], "id bigint, raw string")
    s = F.from_json("raw", "complexity string, steps array<string>, score double")
    whole = F.struct(F.coalesce(s["complexity"], F.lit("unknown")).alias("complexity"), F.coalesce(s["steps"], F.array().cast("array<string>")).alias("steps"), F.coalesce(s["score"], F.lit(0.0)).alias("score"))
    return rows.select("id", F.to_json(whole).alias("written"))


def pr14_merge(spark, sf):
    """Metadata with an update laid over it: the right side wins."""
    left = F.coalesce(F.from_json("metadata", "map<string,string>"), F.create_map().cast("map<string,string>"))
    right = F.create_map(F.lit("lang"), F.lit("xx"), F.lit("reviewed"), F.lit("yes"))
    merged = F.map_concat(F.map_filter(left, lambda k, v: ~F.array_contains(F.map_keys(right), k)), right)
    rows = table(spark, sf, "oppadu_collected").select("post_id", "collected_at", merged.alias("m"))
    return rows.select("post_id", "collected_at", c("m")["lang"].alias("lang"), c("m")["author"].alias("author"), c("m")["reviewed"].alias("reviewed"))


def j13_score_zip(spark, sf):
    """Two lists of one row side by side, by position."""
    lists = qa(spark, sf).filter("tags is not null").select("pair_id", "tags", F.transform("tags", lambda t: F.length(t)).alias("sizes"))
    return lists.select("pair_id", F.posexplode(F.arrays_zip("tags", "sizes")).alias("place", "z")).select("pair_id", "place", "z.tags", "z.sizes")


def x02_append(spark, sf):
    """A log of batches to which runs are appended one after the other, and what it holds then."""
    path = scratch_path(spark, "log")
    items = table(spark, sf, "incoming_items").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("fetched_at").alias("last"))
    ends = items.agg(F.min("batch_id"), F.max("batch_id")).first()
    for run in range(2):
        half = ((ends[0] or 0) + (ends[1] or 0)) // 2
        items.filter(c("batch_id") <= half if run == 0 else c("batch_id") > half).withColumn("run", F.lit(run)).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("run").agg(F.count(F.lit(1)).alias("batches"), F.sum("n").alias("items"))


def x06_reset(spark, sf):
    """The trackers' tables before and after all of them are reset; their columns stay."""
    rows = []
    for source in ("stackoverflow", "reddit", "oppadu"):
        path = scratch_path(spark, f"tracker-{source}")
        table(spark, sf, f"{source}_collected").write.parquet(path)
        stored = spark.read.parquet(path)
        before, schema = stored.count(), stored.schema
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        left = spark.read.schema(schema).parquet(path)
        rows.append((source, before, left.count(), len(left.columns)))
    return spark.createDataFrame(rows, "source string, before bigint, after bigint, columns int")


# fixed values: hours that a community's page stays in the cache
HOURS = {"stackoverflow": 24, "reddit": 24, "oppadu": 6}


def s31_page_cache(spark, sf):
    """A cache of pages by source and key: the latest entry of a key, kept while it is younger than
    its source's hours at the time of the newest entry."""
    parts = [table(spark, sf, f"{s}_collected").select(F.lit(s).alias("source"), c(k).cast("string").alias("key"), "collected_at", F.lit(h * 3600).alias("ttl")) for (s, h), k in zip(HOURS.items(), ("question_id", "submission_id", "post_id"), strict=True)]
    entries = parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("collected_at is not null and not isnan(collected_at)")
    last = latest_by_key(entries, ["source", "key"], ["collected_at"])
    now = entries.groupBy("source").agg(F.max("collected_at").alias("now"))
    return last.join(now, "source").groupBy("source").agg(F.count(F.lit(1)).alias("entries"), F.count_if(c("now") - c("collected_at") <= c("ttl")).alias("alive"))


def j14_model_lookup(spark, sf):
    """Records with what is known of their model, a default for models that aren't known; what is
    known are a model's first provider and its records, a row a model."""
    u = table(spark, sf, "usage_records")
    known = u.filter("model is not null and provider is not null").groupBy("model").agg(F.min("provider").alias("owner"), F.count(F.lit(1)).alias("seen"))
    return u.select("id", "model").distinct().join(known, "model", "left").groupBy(F.coalesce("owner", F.lit("unknown")).alias("owner")).agg(F.count(F.lit(1)).alias("records"), F.max("seen").alias("seen"))


# -- cleaning chains ----------------------------------------------------------------------
ADVANCED, INTERMEDIATE = ("MMULT", "SUMPRODUCT", "LAMBDA", "LET", "GROUPBY", "PIVOTBY", "XLOOKUP", "FILTER"), ("SUMIFS", "COUNTIFS", "INDEX", "MATCH", "VLOOKUP", "INDIRECT", "TRANSPOSE")


def _complexity(d: Dialect) -> str:
    """difficulty, score and number of functions from ``all_``, an answer's formulas in capitals one a line,
    and ``deepest``, the most opening parentheses of one of them."""
    advanced, middle, deep = d.any("all_", ADVANCED), d.any("all_", INTERMEDIATE), "deepest > 3"
    level = when((advanced, "'advanced'"), (f"{middle} OR {deep}", "'intermediate'"), other="'beginner'")
    score = when((advanced, num(3.0)), (deep, num(2.5)), (middle, num(2.0)), other=num(1.0))
    return f"{level} AS difficulty, {score} AS complexity_score"


def _formula_rows(spark, sf, where):
    f = T.formulas(F.coalesce("a_text", F.lit("")))
    opens = F.coalesce(F.array_max(F.transform(f, lambda x: F.regexp_count(x, F.lit(r"\(")))), F.lit(0))
    return qa(spark, sf).filter(where).withColumns({"all_": F.upper(F.array_join(f, "\n")), "deepest": opens, "formula_count": F.size(f).cast("bigint")})


def c18_formula_level(spark, sf):
    """Difficulty and complexity score of each answer's formulas."""
    return _formula_rows(spark, sf, "true").selectExpr("pair_id", _complexity(SPARK).split(" AS difficulty, ")[0] + " AS difficulty", _complexity(SPARK).split(" AS difficulty, ")[1])


def t19_dataset(spark, sf):
    """A dataset's answers cleaned, with their formulas and the metadata that say so."""
    t = c("a_text")
    return qa(spark, sf).filter("a_text is not null").select("pair_id", T.strip_markup(t).alias("response"), F.array_join(T.formulas(t), "\n").alias("code_blocks"), T.has_code(t).alias("has_code"), F.size(T.formulas(t)).cast("bigint").alias("code_count"))


def _final(longest, bare):
    """The longest formula, then the explanation where it says something of its own."""
    says = T.word_count(bare) >= 3
    return F.when((longest != "") & says, F.concat(longest, F.lit("\n\n"), bare)).when(longest != "", longest).otherwise(bare)


def t20_korean_response(spark, sf):
    """Markup out, formulas, explanation, final response, entities once more."""
    f = T.formulas(c("a_text"))
    longest = F.element_at(F.concat(F.array_sort(f, lambda a, b: F.length(b) - F.length(a)), F.array(F.lit(""))), 1)
    bare = T.collapse(F.regexp_replace(T.strip_markup(c("a_text")), T.FORMULA, " "))
    return qa(spark, sf).filter("source = 'oppadu' and a_text is not null").select("pair_id", F.length(T.unescape(_final(longest, bare))).cast("bigint").alias("length"), T.unescape(bare).alias("explanation"), (F.size(f) > 0).alias("has_excel"))


def c19_korean_record(spark, sf):
    """The whole record of a Korean answer: cleaned, its code, difficulty and metadata."""
    rows = _formula_rows(spark, sf, "source = 'oppadu' and a_text is not null")
    level, score = _complexity(SPARK).split(" AS difficulty, ")
    out = rows.withColumn("difficulty", F.expr(level)).withColumn("complexity_score", F.expr(score.removesuffix(" AS complexity_score")))
    functions = F.array_sort(F.array_distinct(F.regexp_extract_all("all_", F.lit(r"([A-Z][A-Z0-9]*)\s*\("), F.lit(1))))
    return out.select("pair_id", "difficulty", "complexity_score", F.array_join(functions, ",").alias("functions"), (c("formula_count") > 0).alias("has_excel_formulas"), "formula_count", (c("difficulty") == "advanced").alias("uses_advanced_functions"))


def _rows(names: str, rows) -> str:
    cell = lambda x: "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS v({names})"


_W = "WITH " + QA
_F = r"=[A-Z][A-Z0-9.]*\([^()]*(?:\([^()]*\)[^()]*)*\)"
_STRIP = lambda t: rf"trim(regexp_replace(regexp_replace(regexp_replace({t}, '<[^<>]+>', ' ', 'g'), '&[A-Za-z0-9#]+;', ' ', 'g'), '{T.BLANK}', ' ', 'g'), ' ')"
_UNESCAPE = lambda t: "replace(replace(replace(replace(replace(replace({}, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' ')".format(t)
_ONCE = lambda x: f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"
_CODE = r"regexp_matches(a_text, '(?s)```.*```|`[^`\n]+`|<code>|<pre>|=[A-Z]+\(')"
_ALL = lambda where: rf"f AS (SELECT pair_id, {_ONCE('g')} AS g FROM (SELECT pair_id, regexp_extract_all(coalesce(a_text, ''), '{_F}') AS g FROM qa WHERE {where}) o), l AS (SELECT pair_id, upper(array_to_string(g, chr(10))) AS all_, coalesce(list_max(list_transform(g, lambda x: len(regexp_extract_all(x, '\(')))), 0) AS deepest, len(g) AS formula_count FROM f)"
_BARE = rf"trim(regexp_replace(regexp_replace({_STRIP('a_text')}, '{_F}', ' ', 'g'), '{T.BLANK}', ' ', 'g'), ' ')"
_TRACKED = " UNION ALL ".join(f"SELECT '{s}' AS source, CAST({k} AS VARCHAR) AS key, collected_at, {h * 3600} AS ttl FROM {s}_collected WHERE collected_at IS NOT NULL AND NOT isnan(collected_at)" for (s, h), k in zip(HOURS.items(), ("question_id", "submission_id", "post_id"), strict=True))
QUERIES = {f.__name__: f for f in (s08_post_detail, s09_pagination, s10_question_page, s31_page_cache, t07_image_urls, t33_decode, pr13_round_trip, pr14_merge, j13_score_zip, j14_model_lookup, x02_append, x06_reset, c18_formula_level, c19_korean_record, t19_dataset, t20_korean_response)}
ORACLES = {
    "s08_post_detail": _rows("name, title, excel, os, question, answer, accepted", [
        ("selected", "Sum of two sheets & a total", "M365", "Win 11", "The total is wrong. =SUM(A1:A9) on two sheets", "Use <=> and one two", True), ("open", "No answer yet", None, None, "Which function?", None, False), ("list", None, None, None, None, None, False),
        ("question", "Pivot > table", None, None, "a b end", None, False), ("empty", None, None, None, None, None, False), ("broken", "Half text bold", None, None, "text bold", None, False)]),
    "s09_pagination": _rows("name, place, link", [("list", 0, BASE + "?page=1"), ("list", 1, "https://community.example/board/?page=2")]),
    "s10_question_page": _rows("name, id, votes, views, tags, question", [("question", "55", 12, 1234, "pivot,excel", "a b end")]),
    "s31_page_cache": f"WITH e AS ({_TRACKED}), l AS (SELECT source, key, max(collected_at) AS taken, any_value(ttl) AS ttl FROM e GROUP BY 1, 2), n AS (SELECT source, max(collected_at) AS now FROM e GROUP BY 1) SELECT source, count(*) AS entries, count(*) FILTER (WHERE now - taken <= ttl) AS alive FROM l JOIN n USING (source) GROUP BY 1",
    "t07_image_urls": _rows("id, urls", [(a, u) for a, _, u in IMAGE_TEXTS]),
    "t33_decode": _rows("id, url", [(a, u) for a, _, u in URLS]),
    "pr13_round_trip": _rows("id, written", [(a, u) for a, _, u in RESULTS]),
    "pr14_merge": "SELECT post_id, collected_at, 'xx' AS lang, CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.author') END AS author, 'yes' AS reviewed FROM oppadu_collected",
    "j13_score_zip": f"{_W} SELECT pair_id, i - 1 AS place, tags[i] AS tags, length(tags[i]) AS sizes FROM (SELECT pair_id, tags, unnest(range(1, len(tags) + 1)) AS i FROM qa WHERE tags IS NOT NULL)",
    "j14_model_lookup": "WITH k AS (SELECT model, min(provider) AS owner, count(*) AS seen FROM usage_records WHERE model IS NOT NULL AND provider IS NOT NULL GROUP BY 1), u AS (SELECT DISTINCT id, model FROM usage_records) SELECT coalesce(owner, 'unknown') AS owner, count(*) AS records, max(seen) AS seen FROM u LEFT JOIN k ON u.model = k.model GROUP BY 1",
    "x02_append": "WITH b AS (SELECT batch_id, count(*) AS n FROM incoming_items GROUP BY 1), e AS (SELECT (min(batch_id) + max(batch_id)) // 2 AS half FROM b) SELECT CAST(batch_id > half AS INTEGER) AS run, count(*) AS batches, CAST(sum(n) AS BIGINT) AS items FROM b, e GROUP BY 1",
    "x06_reset": " UNION ALL ".join(f"SELECT '{s}' AS source, count(*) AS before, 0 AS after, 5 AS columns FROM {s}_collected" for s in HOURS),
    "c18_formula_level": f"{_W}, {_ALL('true')} SELECT pair_id, {_complexity(DUCK)} FROM l",
    "c19_korean_record": rf"{_W}, {_ALL(chr(115) + 'ource = ' + chr(39) + 'oppadu' + chr(39) + ' AND a_text IS NOT NULL')}, m AS (SELECT *, {_complexity(DUCK)} FROM l) SELECT pair_id, difficulty, complexity_score, array_to_string(list_sort(list_distinct(regexp_extract_all(all_, '([A-Z][A-Z0-9]*)\s*\(', 1))), ',') AS functions, formula_count > 0 AS has_excel_formulas, formula_count, difficulty = 'advanced' AS uses_advanced_functions FROM m",
    "t19_dataset": f"{_W}, f AS (SELECT pair_id, a_text, {_ONCE('g')} AS g FROM (SELECT pair_id, a_text, regexp_extract_all(a_text, '{_F}') AS g FROM qa WHERE a_text IS NOT NULL) o) SELECT pair_id, {_STRIP('a_text')} AS response, array_to_string(g, chr(10)) AS code_blocks, {_CODE} AS has_code, len(g) AS code_count FROM f",
    "t20_korean_response": f"{_W}, f AS (SELECT pair_id, {_BARE} AS bare, regexp_extract_all(a_text, '{_F}') AS g FROM qa WHERE source = 'oppadu' AND a_text IS NOT NULL), k AS (SELECT pair_id, bare, g, coalesce(list_reduce(list_prepend('', g), lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END), '') AS longest, len(list_filter(regexp_split_to_array(bare, '{T.BLANK}'), lambda w: w <> '')) >= 3 AS says FROM f) SELECT pair_id, length({_UNESCAPE('CASE WHEN longest <> ' + chr(39) * 2 + ' AND says THEN longest || chr(10) || chr(10) || bare WHEN longest <> ' + chr(39) * 2 + ' THEN longest ELSE bare END')}) AS length, {_UNESCAPE('bare')} AS explanation, len(g) > 0 AS has_excel FROM k",
}
