"""Further record, tracker, validation and reporting operators."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridwright.functions import text as T
from gridwright.operators.relational import latest_by_key, min_max, previous_in_group, ratio
from gridwright.plans.common import QA, qa
from gridwright.session import table

c = F.col


def pr04_standard_pair(spark, sf):
    """Forum pair in the standard shape: selected answers are accepted, scores stand for reputation."""
    r = qa(spark, sf).filter("source = 'reddit'")
    return r.select("pair_id", F.lit(True).alias("is_accepted"), c("a_score").alias("reputation"), c("total_comments").alias("views"))


def pr07_sync_payload(spark, sf):
    """Payload rows: parsed metadata, prefixed source, defaults."""
    meta = F.from_json("metadata", "lang string, answers bigint")
    return table(spark, sf, "oppadu_collected").select("post_id", "collected_at", F.concat(F.lit("sync_"), F.lit("oppadu")).alias("source"), F.coalesce(meta["lang"], F.lit("ko")).alias("lang"), F.coalesce(meta["answers"], F.lit(0)).alias("answers"))


def pr10_entry(spark, sf):
    """Flat training entry with a quality gate."""
    return qa(spark, sf).filter((c("overall") >= 6) & (c("overall") <= 10)).select(F.concat("source", F.lit("_"), c("pair_id").cast("string")).alias("id"), c("title").alias("user_question"), F.length("a_text").cast("bigint").alias("answer_length"))


def pr12_question_with_context(spark, sf):
    return qa(spark, sf).select("pair_id", F.concat_ws("\n", F.concat(F.lit("Q: "), "title"), F.concat(F.lit("Tags: "), F.array_join(F.slice("tags", 1, 5), ", "))).alias("prompt"))


def pr17_features(spark, sf):
    return qa(spark, sf).select("pair_id", F.length("title").cast("bigint").alias("title_length"), F.coalesce(F.when(c("tags").isNotNull(), F.size("tags")), F.lit(0)).cast("bigint").alias("tags"), c("q_text").contains("?").alias("asks"), T.has_code(F.coalesce("a_text", F.lit(""))).alias("code"))


def f03_threshold(spark, sf):
    return table(spark, sf, "oppadu_posts").filter((c("quality_score") >= 5.5) & (c("quality_score") <= 10)).select("post_id").distinct()


def f06_solved(spark, sf):
    """New forum items marked as solved, in any case, that were not collected before."""
    new = table(spark, sf, "incoming_items").filter((F.lower("source") == "reddit") & F.lower("title").contains("solved") & c("external_id").isNotNull())
    known = table(spark, sf, "reddit_collected").select(c("submission_id").alias("external_id")).distinct()
    return new.join(known, "external_id", "left_anti").select("item_id")


def f11_required_words(spark, sf):
    """Titles with a required word and none of the excluded ones."""
    return table(spark, sf, "oppadu_posts").filter(c("title").contains("함수") & ~c("title").rlike("광고|홍보|오류")).select("post_id").distinct()


def f13_good_after(spark, sf):
    return table(spark, sf, "stackoverflow_collected").filter((c("quality_score") >= 7) & (c("quality_score") <= 10) & (c("question_id") > 60001000)).select("question_id").distinct()


def f14_required_fields(spark, sf):
    ok = lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""
    return qa(spark, sf).filter(ok(c("title")) & ok(c("a_text")) & ok(c("author"))).select("pair_id")


def f17_similarity_floor(spark, sf):
    from gridwright.plans.qa_plans import j09_similar_pairs

    return j09_similar_pairs(spark, sf).filter("similarity >= 0.47").select("a", "b")


def f20_image_urls(spark, sf):
    return table(spark, sf, "oppadu_posts").select("post_id", F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")).alias("host"), c("url").rlike(r"(?i)\.(png|jpe?g|gif|webp)($|\?)").alias("image")).distinct()


def f21_date_range(spark, sf):
    return table(spark, sf, "oppadu_posts").filter(c("collected_at").between(1930000000, 1935000000)).groupBy().agg(F.count(F.lit(1)).alias("n"))


def f24_empty_is_bot(spark, sf):
    """Text gate: a missing text counts as a bot's."""
    return qa(spark, sf).select("pair_id", F.coalesce(F.trim("a_text") == "", F.lit(True)).alias("gated"))


def j02_accepted_or_best(spark, sf):
    """Confirmed pairs of each question, else its best one of score 1 or more."""
    r = qa(spark, sf).filter("q_id is not null").select("q_id", "pair_id", F.coalesce("op_confirmed", F.lit(False)).alias("ok"), "a_score")
    best = r.filter("ok or a_score >= 1").withColumn("k", F.row_number().over(W.partitionBy("q_id").orderBy(F.desc(c("ok").cast("int")), F.desc_nulls_last("a_score"), "pair_id")))
    return best.filter("k = 1").select("q_id", "pair_id")


def j04_top_two(spark, sf):
    """Two best answers of each source."""
    r = qa(spark, sf).filter("a_score is not null")
    return r.withColumn("k", F.row_number().over(W.partitionBy("source").orderBy(F.desc("a_score"), "pair_id"))).filter("k <= 2").select("source", "pair_id", "k")


def j08_parent(spark, sf):
    """Documents with the document written before theirs in the thread, by blocks of ids."""
    d = table(spark, sf, "documents").filter("thread_id is not null").select("doc_id", "thread_id")
    return previous_in_group(d, "thread_id", "doc_id", "parent_id").filter("parent_id is not null").select("doc_id", "parent_id")


def a02_simple_stats(spark, sf):
    from gridwright.plans.text_plans import c05_simple_score

    s = c05_simple_score(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_if(c("overall") >= 3).alias("passed"), F.round(100 * ratio(F.count_if(c("overall") >= 3), F.count(F.lit(1))), 4).alias("percent"), F.min("overall").alias("least"), F.max("overall").alias("most"))


def a05_triage_stats(spark, sf):
    r = qa(spark, sf).select(T.has_code(F.coalesce("a_text", F.lit(""))).alias("code"))
    return r.groupBy(F.when(c("code"), "code").otherwise("text").alias("path")).agg(F.count(F.lit(1)).alias("n"))


def a07_similarity_spread(spark, sf):
    from gridwright.plans.qa_plans import j09_similar_pairs

    return j09_similar_pairs(spark, sf).agg(F.count(F.lit(1)).alias("pairs"), F.round(F.min("similarity"), 3).alias("least"), F.round(F.max("similarity"), 3).alias("most"))


def a09_tracker(spark, sf):
    p = table(spark, sf, "oppadu_posts")
    return p.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("view_count"), 6).alias("views"), F.round(F.avg("comment_count"), 6).alias("comments"), F.count_if("has_answer").alias("answered"))


def a11_posts_with_answers(spark, sf):
    p = latest_by_key(table(spark, sf, "oppadu_posts").select("post_id", "collected_at", "has_answer", "view_count"), ["post_id"], ["collected_at"])
    return p.groupBy("has_answer").agg(F.count(F.lit(1)).alias("n"), F.sum("view_count").alias("views"))


def a16_key_sizes(spark, sf):
    k = table(spark, sf, "reddit_collected")
    return k.agg(F.count(F.lit(1)).alias("n"), F.count_if(c("collected_at") < 1930000000).alias("expired"), F.sum(F.length("submission_id") + F.length(F.coalesce("metadata", F.lit("")))).alias("size"))


def a24_fingerprints(spark, sf):
    """Per source: rows, distinct authors, and an order-free fingerprint of its ids."""
    r = qa(spark, sf)
    return r.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("author").alias("authors"), F.bit_xor(F.conv(F.substring(F.md5(c("pair_id").cast("string")), 1, 8), 16, 10).cast("bigint")).alias("fingerprint"))


def a28_floor_allocation(spark, sf):
    """Items of each source to tiers by floors, the remainder to the last."""
    n = table(spark, sf, "qa_pairs").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    top, good = F.floor(c("n") * 55 / 100), F.floor(c("n") * 33 / 100)
    return n.select("source", top.alias("excellent"), good.alias("good"), (c("n") - top - good).alias("fair"))


def a37_batch_stats(spark, sf):
    r = table(spark, sf, "incoming_items")
    return r.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("external_id").isNull()).alias("keyless"), F.min("item_id").alias("first"), F.max("item_id").alias("last"))


def a44_valid_share(spark, sf):
    ok = c("title").isNotNull() & c("url").startswith("https://")
    return table(spark, sf, "oppadu_posts").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("valid"), F.round(ratio(F.count_if(ok), F.count(F.lit(1))), 6).alias("share"))


def w09_first_occurrence(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null and source is not null")
    return d.groupBy("source", F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id")).select("source", "doc_id")


def o06_composite_sort(spark, sf):
    t = table(spark, sf, "mix_targets")
    return t.orderBy(F.desc(F.when(c("target_percent") >= 15, 1).otherwise(0)), "max_repeats", "source").select("source", F.when(c("target_percent") >= 15, 1).otherwise(0).alias("popular"), "max_repeats")


def o07_newest(spark, sf):
    return table(spark, sf, "documents").filter("created_utc is not null").orderBy(F.desc("created_utc"), "doc_id").limit(10).select("doc_id", "created_utc")


def u06_split(spark, sf):
    """Branches by predicate, counted again as one table."""
    r = qa(spark, sf)
    with_code = r.filter(T.has_code(F.coalesce("a_text", F.lit("")))).select(F.lit("code").alias("branch"))
    without = r.filter(~T.has_code(F.coalesce("a_text", F.lit("")))).select(F.lit("text").alias("branch"))
    return with_code.unionByName(without).groupBy("branch").agg(F.count(F.lit(1)).alias("n"))


def t15_leading_equals(spark, sf):
    """Formula-like code gets its equals sign."""
    f = F.regexp_extract("a_text", r"([A-Z]+\([^()]*\))", 1)
    return qa(spark, sf).filter(F.regexp_extract("a_text", r"([A-Z]+\([^()]*\))", 1) != "").select("pair_id", F.concat(F.lit("="), f).alias("formula"))


def t24_explanation(spark, sf):
    """The text without its formulas; a stock phrase where fewer than three words are left."""
    bare = T.collapse(F.regexp_replace("a_text", T.FORMULA, " "))
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.when(T.word_count(bare) < 3, F.lit("see formula")).otherwise(bare).alias("explanation"))


def t39_routing_mentions(spark, sf):
    return qa(spark, sf).filter("q_text is not null").select("pair_id", F.array_sort(T.mentions(c("q_text"), ("vlookup", "xlookup", "index", "match", "sumproduct", "filter", "pivot"))).alias("mentions"))


def d1_iso_parse(spark, sf):
    from gridwright.functions.instants import instant

    return table(spark, sf, "usage_records").select("id", instant(c("timestamp")).isNull().alias("unreadable")).distinct().groupBy("unreadable").agg(F.count(F.lit(1)).alias("n"))


def d5_since(spark, sf):
    """Rows of the last 30 days before a stated day."""
    stop = F.lit("2031-06-01").cast("timestamp_ntz")
    return table(spark, sf, "usage_records").filter((c("created_at").cast("timestamp_ntz") >= stop - F.expr("INTERVAL 30 DAYS")) & (c("created_at").cast("timestamp_ntz") < stop)).agg(F.count_distinct("id").alias("n"))


def m5_distance(spark, sf):
    from gridwright.plans.qa_plans import j09_similar_pairs

    return j09_similar_pairs(spark, sf).select("a", "b", F.round(1 - c("similarity"), 4).alias("distance"))


def _raw_scores():
    """Question and answer scores and the completion bonus of a pair; comments stand for views and
    everyone's reputation is 1."""
    question = F.log10(F.coalesce("total_comments", F.lit(0)) + 1) + 2 * F.coalesce("q_score", F.lit(0)) + F.log10(F.lit(2.0))
    answer = 2 * F.coalesce("a_score", F.lit(0)) + F.when(c("op_confirmed"), 5).otherwise(0) + F.log10(F.lit(2.0))
    bonus = F.lit(1) + F.when(F.size(T.formulas(F.coalesce("a_text", F.lit("")))) > 0, 2).otherwise(0)
    return F.round(question, 6), F.when(F.trim(F.coalesce("a_text", F.lit(""))) == "", 0.0).otherwise(F.round(answer, 6)), bonus


def c01_question_raw(spark, sf):
    return qa(spark, sf).select("pair_id", _raw_scores()[0].alias("raw"))


def c02_answer_raw(spark, sf):
    return qa(spark, sf).select("pair_id", _raw_scores()[1].alias("raw"))


def c03_completion(spark, sf):
    return qa(spark, sf).select("pair_id", _raw_scores()[2].alias("bonus"))


def c04_final_score(spark, sf):
    """10 * (0.4 q + 0.5 a + 0.1 c) on batch-normalised parts of one projection, with tiers."""
    q, a, b = _raw_scores()
    n = min_max(qa(spark, sf).select("pair_id", "source", q.alias("q"), a.alias("a"), b.cast("double").alias("b")), ["q", "a", "b"], ["source"])
    score = F.round(10 * (0.4 * c("q_norm") + 0.5 * c("a_norm") + 0.1 * c("b_norm")), 4)
    return n.select("pair_id", score.alias("score"), F.when(score >= 9, "excellent").when(score >= 7, "good").when(score >= 5, "fair").otherwise("poor").alias("tier"))


def c18_formula_complexity(spark, sf):
    """Deepest nesting and distinct functions of each answer's formulas."""
    f = T.formulas(F.coalesce("a_text", F.lit("")))
    opens = F.transform(f, lambda x: F.regexp_count(x, F.lit(r"\(")))
    return qa(spark, sf).select("pair_id", F.coalesce(F.array_max(opens), F.lit(0)).cast("bigint").alias("calls"), F.size(F.array_distinct(F.flatten(F.transform(f, lambda x: F.regexp_extract_all(x, F.lit("[A-Z]+(?=[(])"), F.lit(0)))))).cast("bigint").alias("functions"))


def c21_formula_syntax(spark, sf):
    """Balanced parentheses and known functions, for each formula-only answer."""
    t = F.trim("a_text")
    rows = qa(spark, sf).filter(F.trim("a_text").startswith("="))
    balanced = F.regexp_count(t, F.lit(r"\(")) == F.regexp_count(t, F.lit(r"\)"))
    return rows.select("pair_id", balanced.alias("balanced"))


def e06_exact_ids(spark, sf):
    """Incoming keys, as they are, that were collected already."""
    i = table(spark, sf, "incoming_items").filter("source = 'reddit' and external_id is not null")
    k = table(spark, sf, "reddit_collected").select(c("submission_id").alias("external_id")).distinct()
    return i.join(k, "external_id", "left_semi").select("item_id")


_W = "WITH " + QA
_F = r"=[A-Z][A-Z0-9.]*\([^()]*(?:\([^()]*\)[^()]*)*\)"
_CODE = r"regexp_matches(coalesce(a_text, ''), '(?s)```.*```|`[^`\n]+`|<code>|<pre>|=[A-Z]+\(')"
_E = "e AS (SELECT vec_id, list_transform(embedding, lambda z: z::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v FROM embeddings), s AS (SELECT x.vec_id AS a, y.vec_id AS b, round(list_dot_product(x.v, y.v), 4) AS similarity FROM e x JOIN e y ON x.vec_id < y.vec_id WHERE list_dot_product(x.v, y.v) >= 0.45)"
_RAWS = "r AS (SELECT pair_id, source, round(log10(coalesce(total_comments, 0) + 1) + 2 * coalesce(q_score, 0) + log10(2.0::DOUBLE), 6) + 0.0::DOUBLE AS q, CASE WHEN trim(coalesce(a_text, ''), ' ') = '' THEN 0.0::DOUBLE ELSE round(2 * coalesce(a_score, 0) + CASE WHEN op_confirmed THEN 5 ELSE 0 END + log10(2.0::DOUBLE), 6) END AS a, 1 + CASE WHEN len(regexp_extract_all(coalesce(a_text, ''), '" + _F + "')) > 0 THEN 2 ELSE 0 END AS b FROM qa)"


def _norm(x: str) -> str:
    return f"CASE WHEN count(*) OVER w <= 1 OR max({x}) OVER w = min({x}) OVER w THEN 1.0 ELSE ({x} - min({x}) OVER w)::DOUBLE / (max({x}) OVER w - min({x}) OVER w) END::DOUBLE"


QUERIES = {f.__name__: f for f in (pr04_standard_pair, pr07_sync_payload, pr10_entry, pr12_question_with_context, pr17_features, f03_threshold, f06_solved, f11_required_words, f13_good_after, f14_required_fields, f17_similarity_floor, f20_image_urls, f21_date_range, f24_empty_is_bot, j02_accepted_or_best, j04_top_two, j08_parent, a02_simple_stats, a05_triage_stats, a07_similarity_spread, a09_tracker, a11_posts_with_answers, a16_key_sizes, a24_fingerprints, a28_floor_allocation, a37_batch_stats, a44_valid_share, w09_first_occurrence, o06_composite_sort, o07_newest, u06_split, t15_leading_equals, t24_explanation, t39_routing_mentions, d1_iso_parse, d5_since, m5_distance, c01_question_raw, c02_answer_raw, c03_completion, c04_final_score, c18_formula_complexity, c21_formula_syntax, e06_exact_ids)}
from gridwright.plans.common import USAGE  # noqa: E402
from gridwright.plans.text_plans import ORACLES as _TEXT  # noqa: E402

ORACLES = {
    "pr04_standard_pair": f"{_W} SELECT pair_id, true AS is_accepted, a_score AS reputation, total_comments AS views FROM qa WHERE source = 'reddit'",
    "pr07_sync_payload": "SELECT post_id, collected_at, 'sync_oppadu' AS source, coalesce(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.lang') END, 'ko') AS lang, coalesce(CAST(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.answers') END AS BIGINT), 0) AS answers FROM oppadu_collected",
    "pr10_entry": f"{_W} SELECT source || '_' || pair_id AS id, title AS user_question, length(a_text) AS answer_length FROM qa WHERE overall >= 6 AND overall <= 10",
    "pr12_question_with_context": f"{_W} SELECT pair_id, concat_ws(chr(10), 'Q: ' || title, 'Tags: ' || array_to_string(tags[1:5], ', ')) AS prompt FROM qa",
    "pr17_features": f"{_W} SELECT pair_id, length(title) AS title_length, coalesce(len(tags), 0) AS tags, contains(q_text, '?') AS asks, {_CODE} AS code FROM qa",
    "f03_threshold": "SELECT DISTINCT post_id FROM oppadu_posts WHERE quality_score >= 5.5 AND quality_score <= 10",
    "f06_solved": "SELECT item_id FROM incoming_items WHERE lower(source) = 'reddit' AND contains(lower(title), 'solved') AND external_id NOT IN (SELECT submission_id FROM reddit_collected WHERE submission_id IS NOT NULL)",
    "f11_required_words": "SELECT DISTINCT post_id FROM oppadu_posts WHERE contains(title, '함수') AND NOT regexp_matches(title, '광고|홍보|오류')",
    "f13_good_after": "SELECT DISTINCT question_id FROM stackoverflow_collected WHERE quality_score >= 7 AND quality_score <= 10 AND question_id > 60001000",
    "f14_required_fields": f"{_W} SELECT pair_id FROM qa WHERE trim(coalesce(title, ''), ' ') <> '' AND trim(coalesce(a_text, ''), ' ') <> '' AND trim(coalesce(author, ''), ' ') <> ''",
    "f17_similarity_floor": f"WITH {_E} SELECT a, b FROM s WHERE similarity >= 0.47",
    "f20_image_urls": r"SELECT DISTINCT post_id, coalesce(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host, regexp_matches(url, '(?i)\.(png|jpe?g|gif|webp)($|\?)') AS image FROM oppadu_posts",
    "f21_date_range": "SELECT count(*) AS n FROM oppadu_posts WHERE collected_at BETWEEN 1930000000 AND 1935000000",
    "f24_empty_is_bot": f"{_W} SELECT pair_id, coalesce(trim(a_text, ' ') = '', true) AS gated FROM qa",
    "j02_accepted_or_best": f"{_W} SELECT q_id, pair_id FROM qa WHERE q_id IS NOT NULL AND (coalesce(op_confirmed, false) OR a_score >= 1) QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY CAST(coalesce(op_confirmed, false) AS INTEGER) DESC, a_score DESC NULLS LAST, pair_id) = 1",
    "j04_top_two": f"{_W} SELECT source, pair_id, row_number() OVER (PARTITION BY source ORDER BY a_score DESC, pair_id) AS k FROM qa WHERE a_score IS NOT NULL QUALIFY k <= 2",
    "j08_parent": "SELECT * FROM (SELECT doc_id, lag(doc_id) OVER (PARTITION BY thread_id ORDER BY doc_id) AS parent_id FROM documents WHERE thread_id IS NOT NULL) WHERE parent_id IS NOT NULL",
    "a02_simple_stats": f"SELECT count(*) AS n, count(*) FILTER (WHERE overall >= 3) AS passed, round(100.0 * count(*) FILTER (WHERE overall >= 3) / count(*), 4) AS percent, min(overall) AS least, max(overall) AS most FROM ({_TEXT['c05_simple_score']})",
    "a05_triage_stats": f"{_W} SELECT CASE WHEN {_CODE} THEN 'code' ELSE 'text' END AS path, count(*) AS n FROM qa GROUP BY 1",
    "a07_similarity_spread": f"WITH {_E} SELECT count(*) AS pairs, round(min(similarity), 3) AS least, round(max(similarity), 3) AS most FROM s",
    "a09_tracker": "SELECT count(*) AS n, round(avg(view_count), 6) AS views, round(avg(comment_count), 6) AS comments, count(*) FILTER (WHERE has_answer) AS answered FROM oppadu_posts",
    "a11_posts_with_answers": "SELECT has_answer, count(*) AS n, CAST(sum(view_count) AS BIGINT) AS views FROM (SELECT * FROM oppadu_posts QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY collected_at DESC) = 1) GROUP BY 1",
    "a16_key_sizes": "SELECT count(*) AS n, count(*) FILTER (WHERE collected_at < 1930000000) AS expired, CAST(sum(length(submission_id) + length(coalesce(metadata, ''))) AS BIGINT) AS size FROM reddit_collected",
    "a24_fingerprints": f"{_W} SELECT source, count(*) AS n, count(DISTINCT author) AS authors, bit_xor(CAST('0x' || substr(md5(CAST(pair_id AS VARCHAR)), 1, 8) AS BIGINT)) AS fingerprint FROM qa GROUP BY source",
    "a28_floor_allocation": "SELECT source, CAST(floor(n * 55 / 100) AS BIGINT) AS excellent, CAST(floor(n * 33 / 100) AS BIGINT) AS good, n - CAST(floor(n * 55 / 100) AS BIGINT) - CAST(floor(n * 33 / 100) AS BIGINT) AS fair FROM (SELECT source, count(*) AS n FROM qa_pairs GROUP BY 1)",
    "a37_batch_stats": "SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE external_id IS NULL) AS keyless, min(item_id) AS first, max(item_id) AS last FROM incoming_items GROUP BY 1",
    "a44_valid_share": "SELECT count(*) AS n, count(*) FILTER (WHERE title IS NOT NULL AND starts_with(url, 'https://')) AS valid, round(count(*) FILTER (WHERE title IS NOT NULL AND starts_with(url, 'https://')) / count(*)::DOUBLE, 6) AS share FROM oppadu_posts",
    "w09_first_occurrence": "SELECT source, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL AND source IS NOT NULL GROUP BY source, text",
    "o06_composite_sort": "SELECT source, CASE WHEN target_percent >= 15 THEN 1 ELSE 0 END AS popular, max_repeats FROM mix_targets ORDER BY popular DESC, max_repeats, source",
    "o07_newest": "SELECT doc_id, created_utc FROM documents WHERE created_utc IS NOT NULL ORDER BY created_utc DESC, doc_id LIMIT 10",
    "u06_split": f"{_W} SELECT CASE WHEN {_CODE} THEN 'code' ELSE 'text' END AS branch, count(*) AS n FROM qa GROUP BY 1",
    "t15_leading_equals": rf"{_W} SELECT pair_id, '=' || regexp_extract(a_text, '([A-Z]+\([^()]*\))', 1) AS formula FROM qa WHERE regexp_extract(a_text, '([A-Z]+\([^()]*\))', 1) <> ''",
    "t24_explanation": f"{_W}, b AS (SELECT pair_id, trim(regexp_replace(regexp_replace(a_text, '{_F}', ' ', 'g'), '{T.BLANK}', ' ', 'g'), ' ') AS t FROM qa WHERE a_text IS NOT NULL) SELECT pair_id, CASE WHEN len(list_filter(regexp_split_to_array(t, '{T.BLANK}'), lambda w: w <> '')) < 3 THEN 'see formula' ELSE t END AS explanation FROM b",
    "t39_routing_mentions": f"{_W} SELECT pair_id, list_sort(list_filter(['vlookup', 'xlookup', 'index', 'match', 'sumproduct', 'filter', 'pivot'], lambda w: contains(lower(q_text), w))) AS mentions FROM qa WHERE q_text IS NOT NULL",
    "d1_iso_parse": f"WITH {USAGE} SELECT happened IS NULL AS unreadable, count(*) AS n FROM u GROUP BY 1",
    "d5_since": "SELECT count(DISTINCT id) AS n FROM usage_records WHERE created_at >= TIMESTAMP '2031-05-02' AND created_at < TIMESTAMP '2031-06-01'",
    "m5_distance": f"WITH {_E} SELECT a, b, round(1 - similarity, 4) AS distance FROM s",
    "c01_question_raw": f"{_W}, {_RAWS} SELECT pair_id, q AS raw FROM r",
    "c02_answer_raw": f"{_W}, {_RAWS} SELECT pair_id, a AS raw FROM r",
    "c03_completion": f"{_W}, {_RAWS} SELECT pair_id, b AS bonus FROM r",
    "c04_final_score": f"{_W}, {_RAWS}, n AS (SELECT pair_id, round(10 * (0.4::DOUBLE * {_norm('q')} + 0.5::DOUBLE * {_norm('a')} + 0.1::DOUBLE * {_norm('b')}), 4) AS score FROM r WINDOW w AS (PARTITION BY source)) SELECT pair_id, score, CASE WHEN score >= 9 THEN 'excellent' WHEN score >= 7 THEN 'good' WHEN score >= 5 THEN 'fair' ELSE 'poor' END AS tier FROM n",
    "c18_formula_complexity": f"{_W}, f AS (SELECT pair_id, list_distinct(regexp_extract_all(coalesce(a_text, ''), '{_F}')) AS f FROM qa) SELECT pair_id, coalesce(list_max(list_transform(f, lambda x: len(regexp_extract_all(x, '\\(')))), 0) AS calls, len(list_distinct(flatten(list_transform(f, lambda x: regexp_extract_all(x, '([A-Z]+)\\(', 1))))) AS functions FROM f",
    "c21_formula_syntax": r"WITH " + QA + r" SELECT pair_id, len(regexp_extract_all(a_text, '\(')) = len(regexp_extract_all(a_text, '\)')) AS balanced FROM qa WHERE starts_with(trim(a_text, ' '), '=')",
    "e06_exact_ids": "SELECT item_id FROM incoming_items WHERE source = 'reddit' AND external_id IN (SELECT submission_id FROM reddit_collected)",
}
