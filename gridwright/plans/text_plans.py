"""Scalar functions over whole texts: strings, patterns, arrays, JSON, hashes, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.functions import text as T
from gridwright.operators.graph import dot
from gridwright.operators.relational import ratio
from gridwright.plans.common import QA, qa
from gridwright.session import table

c = F.col


def docs(spark, sf):
    return table(spark, sf, "documents").filter("text is not null")


def t01_collapse(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.collapse(c("text"))).alias("h"), F.length(T.collapse(c("text"))).alias("n"))


def t02_shorten(spark, sf):
    return docs(spark, sf).select("doc_id", T.shorten(c("text"), 200).alias("short"))


def t03_truncate(spark, sf):
    return qa(spark, sf).select("pair_id", F.when(F.length("title") > 50, F.concat(F.substring("title", 1, 47), F.lit("..."))).otherwise(c("title")).alias("short"))


def t05_strip_markup(spark, sf):
    return qa(spark, sf).filter("a_text is not null").select("pair_id", T.strip_markup(c("a_text")).alias("bare"))


def t06_triage_text(spark, sf):
    return qa(spark, sf).filter("a_md is not null").select("pair_id", T.triage_text(c("a_md")).alias("bare"))


def t08_has_code(spark, sf):
    return docs(spark, sf).select("doc_id", T.has_code(c("text")).alias("code"))


def t16_formulas(spark, sf):
    return docs(spark, sf).select("doc_id", T.formulas(c("text")).alias("formulas")).filter("size(formulas) > 0")


def t04_code_blocks(spark, sf):
    """Fenced and inline code and formulas, as a sorted set."""
    blocks = lambda p, g: F.regexp_extract_all(c("text"), F.lit(p), F.lit(g))
    every = F.concat(blocks(r"```([^`]+)```", 1), blocks(r"`([^`\n]+)`", 1), blocks(r"=[A-Za-z]+\([^)]*\)", 0))
    return docs(spark, sf).select("doc_id", F.array_sort(F.array_distinct(every)).alias("blocks")).filter("size(blocks) > 0")


def t10_code_language(spark, sf):
    return qa(spark, sf).filter("a_text is not null").groupBy(T.language_of_code(c("a_text")).alias("language")).agg(F.count(F.lit(1)).alias("n"))


def t12_function_mentions(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_sort(T.mentions(c("text"), T.FUNCTIONS)).alias("functions"))


def t13_vba(spark, sf):
    hits = T.count_mentions(c("text"), ("sub ", "dim ", "end sub", "for each", "msgbox", "cells(", "worksheets("))
    return docs(spark, sf).select("doc_id", (hits >= 2).alias("vba"))


def t17_is_formula(spark, sf):
    first = F.trim(F.coalesce("a_text", F.lit("")))
    return qa(spark, sf).select("pair_id", (first.startswith("=") | first.rlike("[A-Z]+[0-9]+")).alias("formula_like"))


def t22_unescape(spark, sf):
    return qa(spark, sf).filter("a_text is not null").select("pair_id", T.unescape(c("a_text")).alias("plain"))


def t23_formulas_min3(spark, sf):
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.filter(T.formulas(c("a_text")), lambda x: F.length(x) >= 3).alias("formulas")).filter("size(formulas) > 0")


def t31_urls(spark, sf):
    return table(spark, sf, "oppadu_posts").select("post_id", F.regexp_extract_all("url", F.lit(T.URL), F.lit(0)).alias("urls")).distinct()


def t35_post_id(spark, sf):
    """The post's id from its URL: digits after uid=, else the last number of the path."""
    uid = F.regexp_extract("url", r"uid=([0-9]+)", 1)
    return table(spark, sf, "oppadu_posts").select("post_id", F.when(uid != "", uid).otherwise(F.regexp_extract("url", r"([0-9]+)[^0-9]*$", 1)).alias("from_url")).distinct()


def t37_called(spark, sf):
    return docs(spark, sf).select("doc_id", T.called_functions(c("text")).alias("called")).filter("size(called) > 0")


def t38_called_set(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_sort(F.array_distinct(T.called_functions(c("text")))).alias("called")).filter("size(called) > 0")


def t40_formula_spaces(spark, sf):
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.transform(T.formulas(c("a_text")), lambda x: F.replace(x, F.lit(" "), F.lit(""))).alias("formulas")).filter("size(formulas) > 0")


def t41_title_key(spark, sf):
    return qa(spark, sf).select("pair_id", T.title_key(c("title")).alias("title_key"))


def t42_title_fallback(spark, sf):
    """The title, or the first sentence of the body, at most 100 characters."""
    first = F.substring(F.split(F.coalesce("body", F.lit("")), r"\.")[0], 1, 100)
    return qa(spark, sf).select("pair_id", F.coalesce(F.nullif(F.trim("title"), F.lit("")), first).alias("title"))


def t43_table_markdown(spark, sf):
    """A small table as markdown: rows of the keep targets."""
    rows = table(spark, sf, "keep_targets").select("source", F.concat(F.lit("| "), F.concat_ws(" | ", "source", c("target_percent").cast("string")), F.lit(" |")).alias("line"))
    return rows.groupBy().agg(F.concat_ws("\n", F.array_sort(F.collect_list("line"))).alias("markdown"))


def t46_word_count(spark, sf):
    return docs(spark, sf).select("doc_id", T.word_count(c("text")).cast("bigint").alias("words"), F.length("text").cast("bigint").alias("chars"))


def ar1_char_trigrams(spark, sf):
    return table(spark, sf, "reddit_collected").filter("title is not null").select("submission_id", F.size(T.char_grams(F.regexp_replace(F.lower("title"), "[^a-z0-9 ]", ""))).cast("bigint").alias("trigrams")).distinct()


def ar2_first_n(spark, sf):
    return qa(spark, sf).filter("tags is not null").select("pair_id", F.slice("tags", 1, 2).alias("first_tags"))


def ar3_ordered_distinct(spark, sf):
    return qa(spark, sf).filter("tags is not null").select("pair_id", F.array_sort(F.array_distinct("tags")).alias("tags"), F.size("tags").cast("bigint").alias("n"))


def ar4_keywords(spark, sf):
    words = ("error", "macro", "pivot", "table", "formula")
    return docs(spark, sf).select("doc_id", T.count_mentions(c("text"), words).alias("hits"))


def ar5_sentences(spark, sf):
    return docs(spark, sf).select("doc_id", F.size(F.filter(F.split("text", r"[.!?]+"), lambda x: F.trim(x) != "")).cast("bigint").alias("sentences"))


_META = "lang string, answers bigint, author string, run bigint"


def js1_metadata(spark, sf):
    """The JSON of a record's metadata; broken and missing JSON give nulls."""
    meta = F.from_json("metadata", _META)
    return table(spark, sf, "reddit_collected").select("submission_id", "collected_at", meta["lang"].alias("lang"), meta["answers"].alias("answers"), meta["run"].alias("run"))


def js2_serialise(spark, sf):
    return table(spark, sf, "oppadu_posts").select("post_id", F.to_json(F.struct("post_id", "view_count", "comment_count")).alias("json")).distinct()


def h1_text_md5(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5("text").alias("md5"), F.substring(F.md5("text"), 1, 16).alias("short"))


def h2_short_id(spark, sf):
    return qa(spark, sf).select("pair_id", F.concat(F.lit("qa_"), F.substring(F.md5(c("pair_id").cast("string")), 1, 8)).alias("id"))


def d2_hour_bucket(spark, sf):
    hour = F.date_trunc("hour", F.timestamp_seconds("created_utc"))
    return table(spark, sf, "documents").filter("created_utc is not null").groupBy(F.date_format(hour, "yyyy-MM-dd HH:mm").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def d3_calendar(spark, sf):
    at = F.timestamp_seconds("created_utc")
    return table(spark, sf, "documents").filter("created_utc is not null").select("doc_id", F.year(at).alias("year"), F.month(at).alias("month"), F.hour(at).alias("hour"), F.date_format(at, "yyyy-MM-dd").alias("day"))


def d4_age_days(spark, sf):
    """Whole days before a stated instant, which is a parameter and never the clock."""
    return qa(spark, sf).select("pair_id", F.floor((F.lit(1940000000.0) - c("collected_at")) / 86400).alias("age_days"))


def m1_log_score(spark, sf):
    return table(spark, sf, "oppadu_posts").filter("view_count >= 0").select("post_id", "view_count", F.round(F.log10(c("view_count") + 1), 6).alias("score")).distinct()


def m2_clamp(spark, sf):
    return qa(spark, sf).filter("overall is not null and not isnan(overall)").select("pair_id", F.greatest(F.lit(0.0), F.least(F.lit(10.0), c("overall"))).alias("clamped"))


def m4_cosine_to_label_mean(spark, sf):
    """Cosine of each vector with the first vector of its label."""
    e = table(spark, sf, "embeddings")
    first = e.groupBy("label").agg(F.min("vec_id").alias("first"))
    heads = first.join(e.select(c("vec_id").alias("first"), c("embedding").alias("head")), "first").select("label", "head")
    sim = dot(c("embedding"), c("head")) / F.sqrt(dot(c("embedding"), c("embedding")) * dot(c("head"), c("head")))
    return e.join(heads, "label").select("vec_id", F.round(sim, 5).alias("similarity"))


def m7_variance(spark, sf):
    lengths = docs(spark, sf).withColumn("n", F.length("text"))
    return lengths.groupBy("lang").agg(F.round(F.var_pop("n"), 3).alias("variance"), F.round(F.stddev_samp("n"), 4).alias("deviation"), F.percentile("n", F.lit(0.5)).alias("median"))


def c05_simple_score(spark, sf):
    """Simple forum scores: base 5, length steps, question and answer marks, 0 to 10; 40:60.

    A quirk is kept: the short-text penalty of an answer holds whenever the steps above don't.
    """
    q, a = F.trim(F.coalesce("q_text", F.lit(""))), F.trim(F.coalesce("a_text", F.lit("")))
    steps = lambda t, short: F.when(F.length(t) >= 200, 2.0).when(F.length(t) >= 100, 1.0).when(short, -2.0).otherwise(0.0)
    sheet = lambda t: F.when(t.contains("=") | F.upper(t).contains("VLOOKUP") | F.upper(t).contains("SUMIF"), 1.0).otherwise(0.0)
    asks = F.when(T.count_mentions(q, ("how", "what", "why", "help", "error", "issue")) > 0, 0.5).otherwise(0.0)
    solves = F.when(T.count_mentions(a, ("=", "formula", "try", "use", "solution")) > 0, 1.0).otherwise(0.0)
    qs = 5.0 + steps(q, F.length(q) < 10) + F.when(q.contains("?"), 1.0).otherwise(0.0) + asks + sheet(q)
    as_ = 5.0 + steps(a, F.lit(True)) + solves + F.when(F.length(a) > 50, 0.5).otherwise(0.0) + sheet(a)
    clamp = lambda s, t: F.when(t == "", 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(10.0), s)))
    return qa(spark, sf).select("pair_id", F.round(clamp(qs, q), 4).alias("question"), F.round(clamp(as_, a), 4).alias("answer"), F.round(clamp(qs, q) * 0.4 + clamp(as_, a) * 0.6, 4).alias("overall"))


def c43_structure(spark, sf):
    """Bold marks, links, bullets and repeated sentences of an answer."""
    t = F.coalesce("a_md", F.lit(""))
    sentences = F.filter(F.transform(F.split(t, r"[.!?]+"), lambda x: F.trim(x)), lambda x: x != "")
    return qa(spark, sf).select("pair_id", F.regexp_count(t, F.lit(r"\*\*")).cast("bigint").alias("bold"), F.regexp_count(t, F.lit("https?://")).cast("bigint").alias("links"), (F.size(sentences) - F.size(F.array_distinct(sentences))).cast("bigint").alias("repeated"))


_DOC = "FROM documents WHERE text IS NOT NULL"
_B = r"[ \t\n\r\f\x0B]+"
_COLL = rf"trim(regexp_replace(text, '{_B}', ' ', 'g'), ' ')"
_FORM = r"=[A-Z][A-Z0-9.]*\([^()]*(?:\([^()]*\)[^()]*)*\)"
_URL = r"https?://[A-Za-z0-9./?=&%#:_~+-]+"
_W = "WITH " + QA
_FUN = "[" + ", ".join(f"'{f}'" for f in T.FUNCTIONS) + "]"


def _ordered_distinct(x: str) -> str:
    return f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"


def _hits(text: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains(lower({text}), '{w.lower()}') AS INTEGER)" for w in words) + ")"


_FA = f"regexp_extract_all(text, '{_FORM}')"
_FQ = f"regexp_extract_all(a_text, '{_FORM}')"
_CALLED = f"list_filter(regexp_extract_all(upper(text), '([A-Z][A-Z0-9_]*) ?\\(', 1), lambda v: list_contains({_FUN}, v))"
_STRIP = rf"trim(regexp_replace(regexp_replace(regexp_replace(a_text, '<[^<>]+>', ' ', 'g'), '&[A-Za-z0-9#]+;', ' ', 'g'), '{_B}', ' ', 'g'), ' ')"
_ESC = "a_text"
for _e, _ch in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " ")):
    _ESC = f"replace({_ESC}, '{_e}', '{_ch}')"
_JSON = "CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.{}') END"
_STEP = "CASE WHEN length({t}) >= 200 THEN 2.0 WHEN length({t}) >= 100 THEN 1.0 WHEN {s} THEN -2.0 ELSE 0.0 END"
_SHEET = "CASE WHEN contains({t}, '=') OR contains(upper({t}), 'VLOOKUP') OR contains(upper({t}), 'SUMIF') THEN 1.0 ELSE 0.0 END"

QUERIES = {f.__name__: f for f in (t01_collapse, t02_shorten, t03_truncate, t04_code_blocks, t05_strip_markup, t06_triage_text, t08_has_code, t10_code_language, t12_function_mentions, t13_vba, t16_formulas, t17_is_formula, t22_unescape, t23_formulas_min3, t31_urls, t35_post_id, t37_called, t38_called_set, t40_formula_spaces, t41_title_key, t42_title_fallback, t43_table_markdown, t46_word_count, ar1_char_trigrams, ar2_first_n, ar3_ordered_distinct, ar4_keywords, ar5_sentences, js1_metadata, js2_serialise, h1_text_md5, h2_short_id, d2_hour_bucket, d3_calendar, d4_age_days, m1_log_score, m2_clamp, m4_cosine_to_label_mean, m7_variance, c05_simple_score, c43_structure)}
ORACLES = {
    "t01_collapse": f"SELECT doc_id, md5({_COLL}) AS h, length({_COLL}) AS n {_DOC}",
    "t02_shorten": f"SELECT doc_id, CASE WHEN length({_COLL}) > 200 THEN concat(substr({_COLL}, 1, 200), '...') ELSE {_COLL} END AS short {_DOC}",
    "t03_truncate": f"{_W} SELECT pair_id, CASE WHEN length(title) > 50 THEN substr(title, 1, 47) || '...' ELSE title END AS short FROM qa",
    "t04_code_blocks": rf"SELECT * FROM (SELECT doc_id, list_sort(list_distinct(list_concat(list_concat(regexp_extract_all(text, '```([^`]+)```', 1), regexp_extract_all(text, '`([^`\n]+)`', 1)), regexp_extract_all(text, '=[A-Za-z]+\([^)]*\)')))) AS blocks {_DOC}) WHERE len(blocks) > 0",
    "t05_strip_markup": f"{_W} SELECT pair_id, {_STRIP} AS bare FROM qa WHERE a_text IS NOT NULL",
    "t06_triage_text": rf"{_W} SELECT pair_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(a_md, '<[^<>]+>', ' ', 'g'), '!\[[^\[\]]*\]\([^()]*\)', ' ', 'g'), '{_URL}', '[URL]', 'g'), '{_B}', ' ', 'g'), ' ') AS bare FROM qa WHERE a_md IS NOT NULL",
    "t08_has_code": rf"SELECT doc_id, regexp_matches(text, '(?s)```.*```|`[^`\n]+`|<code>|<pre>|=[A-Z]+\(') AS code {_DOC}",
    "t10_code_language": rf"{_W} SELECT CASE WHEN regexp_matches(a_text, '(?i)\b(sub|function) [a-z_0-9]+\(|\bdim [a-z]+ as\b|end sub') THEN 'vba' WHEN regexp_matches(a_text, '{_FORM}') THEN 'excel' WHEN regexp_matches(a_text, '(?i)\bselect\b[^;]*\bfrom\b') THEN 'sql' WHEN regexp_matches(a_text, '\bdef [a-z_]+\(|\bimport [a-z_]+\b') THEN 'python' WHEN regexp_matches(a_text, '\bconst [a-z]|\bfunction *\(|=>') THEN 'javascript' ELSE 'unknown' END AS language, count(*) AS n FROM qa WHERE a_text IS NOT NULL GROUP BY 1",
    "t12_function_mentions": f"SELECT doc_id, list_sort(list_filter({_FUN}, lambda f: contains(lower(text), lower(f)))) AS functions {_DOC}",
    "t13_vba": f"SELECT doc_id, {_hits('text', ('sub ', 'dim ', 'end sub', 'for each', 'msgbox', 'cells(', 'worksheets('))} >= 2 AS vba {_DOC}",
    "t16_formulas": f"SELECT * FROM (SELECT doc_id, {_ordered_distinct(_FA)} AS formulas {_DOC}) WHERE len(formulas) > 0",
    "t17_is_formula": f"{_W} SELECT pair_id, starts_with(trim(coalesce(a_text, ''), ' '), '=') OR regexp_matches(trim(coalesce(a_text, ''), ' '), '[A-Z]+[0-9]+') AS formula_like FROM qa",
    "t22_unescape": f"{_W} SELECT pair_id, {_ESC} AS plain FROM qa WHERE a_text IS NOT NULL",
    "t23_formulas_min3": f"{_W} SELECT * FROM (SELECT pair_id, list_filter({_ordered_distinct(_FQ)}, lambda v: length(v) >= 3) AS formulas FROM qa WHERE a_text IS NOT NULL) WHERE len(formulas) > 0",
    "t31_urls": f"SELECT DISTINCT post_id, regexp_extract_all(url, '{_URL}') AS urls FROM oppadu_posts",
    "t35_post_id": "SELECT DISTINCT post_id, CASE WHEN regexp_extract(url, 'uid=([0-9]+)', 1) <> '' THEN regexp_extract(url, 'uid=([0-9]+)', 1) ELSE regexp_extract(url, '([0-9]+)[^0-9]*$', 1) END AS from_url FROM oppadu_posts",
    "t37_called": f"SELECT * FROM (SELECT doc_id, {_CALLED} AS called {_DOC}) WHERE len(called) > 0",
    "t38_called_set": f"SELECT * FROM (SELECT doc_id, list_sort(list_distinct({_CALLED})) AS called {_DOC}) WHERE len(called) > 0",
    "t40_formula_spaces": f"{_W} SELECT * FROM (SELECT pair_id, list_transform({_ordered_distinct(_FQ)}, lambda v: replace(v, ' ', '')) AS formulas FROM qa WHERE a_text IS NOT NULL) WHERE len(formulas) > 0",
    "t41_title_key": rf"{_W}, k AS (SELECT pair_id, trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(title, '<[^<>]+>', '', 'g'), '[!?]{{2,}}', '!', 'g'), '{_B}', ' ', 'g'), ' '), '^(?:(?:[Rr][Ee]|[Ff][Ww][Dd]|[Qq]) ?: ?)+', ''), '{_B}', ' ', 'g'), ' ') AS k FROM qa) SELECT pair_id, coalesce(nullif(k, ''), 'no title') AS title_key FROM k",
    "t42_title_fallback": f"{_W} SELECT pair_id, coalesce(nullif(trim(title, ' '), ''), substr(split_part(coalesce(body, ''), '.', 1), 1, 100)) AS title FROM qa",
    "t43_table_markdown": r"SELECT string_agg('| ' || source || ' | ' || target_percent || ' |', chr(10) ORDER BY '| ' || source || ' | ' || target_percent || ' |') AS markdown FROM keep_targets",
    "t46_word_count": f"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '{_B}'), lambda w: w <> '')) AS words, length(text) AS chars {_DOC}",
    "ar1_char_trigrams": "WITH t AS (SELECT submission_id, regexp_replace(lower(title), '[^a-z0-9 ]', '', 'g') AS s FROM reddit_collected WHERE title IS NOT NULL) SELECT DISTINCT submission_id, CASE WHEN length(s) >= 3 THEN len(list_distinct(list_transform(generate_series(1, length(s) - 2), lambda i: substr(s, i, 3)))) ELSE 0 END AS trigrams FROM t",
    "ar2_first_n": f"{_W} SELECT pair_id, tags[1:2] AS first_tags FROM qa WHERE tags IS NOT NULL",
    "ar3_ordered_distinct": f"{_W} SELECT pair_id, list_sort(list_distinct(tags)) AS tags, len(tags) AS n FROM qa WHERE tags IS NOT NULL",
    "ar4_keywords": f"SELECT doc_id, {_hits('text', ('error', 'macro', 'pivot', 'table', 'formula'))} AS hits {_DOC}",
    "ar5_sentences": f"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: trim(x, ' ') <> '')) AS sentences {_DOC}",
    "js1_metadata": f"SELECT submission_id, collected_at, {_JSON.format('lang')} AS lang, CAST({_JSON.format('answers')} AS BIGINT) AS answers, CAST({_JSON.format('run')} AS BIGINT) AS run FROM reddit_collected",
    "js2_serialise": "SELECT DISTINCT post_id, '{\"post_id\":\"' || post_id || '\"' || coalesce(',\"view_count\":' || view_count, '') || coalesce(',\"comment_count\":' || comment_count, '') || '}' AS json FROM oppadu_posts",
    "h1_text_md5": f"SELECT doc_id, md5(text) AS md5, substr(md5(text), 1, 16) AS short {_DOC}",
    "h2_short_id": f"{_W} SELECT pair_id, 'qa_' || substr(md5(CAST(pair_id AS VARCHAR)), 1, 8) AS id FROM qa",
    "d2_hour_bucket": "SELECT strftime(date_trunc('hour', make_timestamp(created_utc * 1000000)), '%Y-%m-%d %H:%M') AS hour, count(*) AS n FROM documents WHERE created_utc IS NOT NULL GROUP BY 1",
    "d3_calendar": "SELECT doc_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(hour(d) AS INTEGER) AS hour, strftime(d, '%Y-%m-%d') AS day FROM (SELECT doc_id, make_timestamp(created_utc * 1000000) AS d FROM documents WHERE created_utc IS NOT NULL)",
    "d4_age_days": f"{_W} SELECT pair_id, CAST(floor((1940000000.0::DOUBLE - collected_at) / 86400) AS BIGINT) AS age_days FROM qa",
    "m1_log_score": "SELECT DISTINCT post_id, view_count, round(log10(view_count + 1), 6) AS score FROM oppadu_posts WHERE view_count >= 0",
    "m2_clamp": f"{_W} SELECT pair_id, greatest(0.0::DOUBLE, least(10.0::DOUBLE, overall)) AS clamped FROM qa WHERE overall IS NOT NULL AND NOT isnan(overall)",
    "m4_cosine_to_label_mean": "WITH f AS (SELECT label, min(vec_id) AS first FROM embeddings GROUP BY label), h AS (SELECT f.label, e.embedding::DOUBLE[] AS head FROM f JOIN embeddings e ON e.vec_id = f.first) SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], head) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(head, head)), 5) AS similarity FROM embeddings JOIN h USING (label)",
    "m7_variance": f"SELECT lang, round(var_pop(length(text)), 3) AS variance, round(stddev_samp(length(text)), 4) AS deviation, quantile_cont(length(text), 0.5) AS median {_DOC} GROUP BY lang",
    "c05_simple_score": f"{_W}, s AS (SELECT pair_id, trim(coalesce(q_text, ''), ' ') AS q, trim(coalesce(a_text, ''), ' ') AS a FROM qa), r AS (SELECT pair_id, CASE WHEN q = '' THEN 0.0 ELSE greatest(0.0, least(10.0, 5.0 + {_STEP.format(t='q', s='length(q) < 10')} + CASE WHEN contains(q, '?') THEN 1.0 ELSE 0.0 END + CASE WHEN {_hits('q', ('how', 'what', 'why', 'help', 'error', 'issue'))} > 0 THEN 0.5 ELSE 0.0 END + {_SHEET.format(t='q')})) END::DOUBLE AS q, CASE WHEN a = '' THEN 0.0 ELSE greatest(0.0, least(10.0, 5.0 + {_STEP.format(t='a', s='true')} + CASE WHEN {_hits('a', ('=', 'formula', 'try', 'use', 'solution'))} > 0 THEN 1.0 ELSE 0.0 END + CASE WHEN length(a) > 50 THEN 0.5 ELSE 0.0 END + {_SHEET.format(t='a')})) END::DOUBLE AS a FROM s) SELECT pair_id, round(q, 4) AS question, round(a, 4) AS answer, round(q * 0.4::DOUBLE + a * 0.6::DOUBLE, 4) AS overall FROM r",
    "c43_structure": rf"{_W}, s AS (SELECT pair_id, coalesce(a_md, '') AS t, list_filter(list_transform(regexp_split_to_array(coalesce(a_md, ''), '[.!?]+'), lambda x: trim(x, ' ')), lambda x: x <> '') AS ss FROM qa) SELECT pair_id, len(regexp_extract_all(t, '\*\*')) AS bold, len(regexp_extract_all(t, 'https?://')) AS links, len(ss) - len(list_distinct(ss)) AS repeated FROM s",
}
