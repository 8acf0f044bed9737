"""Remaining operators: layouts, cleaning chains, behaviour metrics, folds, keyed state."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.functions import markup
from gridwright.functions import text as T
from gridwright.operators.adaptive import adaptive_threshold, expiring_counts
from gridwright.operators.graph import components, similar_pairs
from gridwright.operators.relational import best_of_group, ratio
from gridwright.plans.common import QA, qa
from gridwright.session import scratch_path, table
from gridwright.streaming import flows

c = F.col


def s19_dataset(spark, sf):
    """The final dataset, one folder a source, validated by reading it back."""
    path = scratch_path(spark, "dataset")
    record = F.struct(F.struct("title", "body").alias("question"), F.struct(c("a_text").alias("text")).alias("answer"))
    qa(spark, sf).filter("title is not null and a_text is not null").select("pair_id", record.alias("content"), c("source").alias("dataset")).write.partitionBy("dataset").json(path)
    return spark.read.json(path).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("content.answer.text").isNotNull()).alias("answered"))


def f09_submission_gate(spark, sf):
    return qa(spark, sf).filter((c("source") == "reddit") & F.length("title").between(10, 200) & (c("q_score") >= 5) & (c("total_comments") >= 3)).select("pair_id")


def f10_comment_gate(spark, sf):
    """Answers of 50 to 5000 characters (a deleted body is shorter) and score 0 or more, whoever wrote them."""
    return qa(spark, sf).filter(F.length("a_text").between(50, 5000) & (c("a_score") >= 0)).select("pair_id")


def f12_answered(spark, sf):
    return table(spark, sf, "oppadu_posts").filter(c("has_answer") & c("title").isNotNull()).select("post_id").distinct()


def f15_after_cleaning(spark, sf):
    return qa(spark, sf).filter((F.length(T.strip_markup(c("q_text"))) >= 10) & (F.length(T.strip_markup(c("a_text"))) >= 20)).select("pair_id")


def f23_log_filter(spark, sf):
    return table(spark, sf, "events").filter(c("props").contains('"k": 7')).select("event_id")


def f26_confirmed(spark, sf):
    return qa(spark, sf).filter(c("op_confirmed") | c("solution_type").isin("verified", "op_confirmed")).select("pair_id")


def a04_korean_stats(spark, sf):
    r = qa(spark, sf).filter("source = 'oppadu'")
    return r.agg(F.count(F.lit(1)).alias("n"), F.count_if(c("title").rlike("매출|재고|급여|예산")).alias("business"), F.count_if(c("title").rlike("배열|매크로|피벗")).alias("advanced"))


def a10_forum_tracker(spark, sf):
    r = qa(spark, sf).filter("source = 'reddit'")
    return r.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("q_score"), 6).alias("q_mean"), F.round(F.avg("a_score"), 6).alias("a_mean"), F.count_distinct("author").alias("authors"))


def a35_formula_ratio(spark, sf):
    """Share of an answer's formulas whose parentheses are balanced."""
    f = F.regexp_extract_all("a_text", F.lit(r"=[A-Z]+\([^ \n]*"), F.lit(0))
    ok = F.filter(f, lambda x: F.regexp_count(x, F.lit(r"\(")) == F.regexp_count(x, F.lit(r"\)")))
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.size(f).cast("bigint").alias("n"), F.round(ratio(F.size(ok), F.size(f)), 6).alias("share")).filter("n > 0")


def a40_text_summary(spark, sf):
    r = qa(spark, sf).filter("a_text is not null").select(T.language_of_code(c("a_text")).alias("l"), F.size(T.formulas(c("a_text"))).alias("f"))
    return r.agg(F.count(F.lit(1)).alias("n"), F.count_if(c("f") > 0).alias("with_formula"), F.count_distinct("l").alias("languages"))


def u04_ordered_union(spark, sf):
    lists = F.array_distinct(F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.array(F.lit("excel"), F.lit("qa"))))
    return qa(spark, sf).select("pair_id", lists.alias("tags"))


#: Fenced blocks and inline spans.
_SPANS = r"```[\s\S]*?```|`[^`\n]+`"


def t14_keep_code(spark, sf):
    """Markup removed from a whole answer but for its code: text is split at every span, cleaned,
    and the spans are put back between."""
    t = F.coalesce("a_md", "a_text")
    rows = qa(spark, sf).select("pair_id", t.alias("t")).filter("t is not null").select("pair_id", F.split("t", _SPANS, -1).alias("parts"), F.regexp_extract_all("t", F.lit(_SPANS), F.lit(0)).alias("spans"))
    kept = F.transform("parts", lambda p, i: F.concat(T.strip_markup(p), F.lit(" "), F.coalesce(F.get(F.col("spans"), i), F.lit(""))))
    return rows.select("pair_id", F.trim(F.array_join(kept, " ")).alias("text"), F.size("spans").cast("bigint").alias("spans"))


def t18_clean_response(spark, sf):
    t = c("a_text")
    return qa(spark, sf).filter("a_text is not null").select("pair_id", T.strip_markup(t).alias("text"), F.size(T.formulas(t)).cast("bigint").alias("formulas"), T.has_code(t).alias("code"))


def t26_final_response(spark, sf):
    """The longest formula, and the explanation where it says more than the formula."""
    f = T.formulas(c("a_text"))
    longest = F.element_at(F.concat(F.array_sort(f, lambda a, b: F.length(b) - F.length(a)), F.array(F.lit(""))), 1)
    bare = T.collapse(F.regexp_replace("a_text", T.FORMULA, " "))
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.length(longest).cast("bigint").alias("formula_length"), F.when(T.word_count(bare) >= 3, bare).alias("explanation"))


def t29_prefixes(spark, sf):
    """Greetings and forms of address at the start of a text."""
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.regexp_replace("a_text", r"^(?:안녕하세요[^\n]{0,20}[.!]? |답변이 늦어서 죄송합니다[.] |Sorry for the late reply, I only saw this today[.][ \n])", "").alias("text"))


def t36_versions(spark, sf):
    years = F.regexp_extract("title", r"_(20[0-9]{2})\.xlsx", 1)
    return table(spark, sf, "oppadu_posts").filter("title is not null").select("post_id", F.when(years != "", years).alias("version")).distinct()


def t45_json_in_text(spark, sf):
    """The JSON object inside a text, greedy, with a fallback."""
    wrapped = F.concat(F.lit("result: "), F.coalesce("metadata", F.lit("none")), F.lit(" end"))
    found = F.regexp_extract(wrapped, r"(?s)(\{.*\})", 1)
    return table(spark, sf, "reddit_collected").select("submission_id", "collected_at", F.coalesce(F.get_json_object(F.when(found != "", found), "$.author"), F.lit("unknown")).alias("author"))


def m3_half_even(spark, sf):
    return table(spark, sf, "keep_targets").select("source", F.bround(c("target_percent") / 8, 2).alias("eighth"))


def c07_forum_parts(spark, sf):
    bonus = F.when(c("solution_type") == "verified", 10).when(c("solution_type") == "op_confirmed", 5).when(c("solution_type") == "inferred", 2).otherwise(0)
    return qa(spark, sf).filter("source = 'reddit'").select("pair_id", F.coalesce("q_score", F.lit(0)).alias("q"), F.coalesce("a_score", F.lit(0)).alias("a"), bonus.alias("bonus"))


def c09_context(spark, sf):
    """The first domain whose words a title has."""
    t = c("title")
    domain = F.when(t.rlike("매출|예산|원가|견적"), "finance").when(t.rlike("급여|수당|근무표|휴가"), "staff").when(t.rlike("재고|창고|물량|부품"), "stock").otherwise("general")
    return table(spark, sf, "oppadu_posts").filter("title is not null").select("post_id", domain.alias("domain")).distinct()


def c14_triage(spark, sf):
    weight = lambda t: F.when(t.isin("xlookup", "sortby", "filter"), 3).when(t == "excel", 1).otherwise(2)
    tags = F.aggregate(F.coalesce("tags", F.array().cast("array<string>")), F.lit(0), lambda s, t: s + weight(t))
    size = F.length(F.coalesce("q_text", F.lit("")))
    total = tags + F.when(size > 500, 2).when(size > 200, 1).otherwise(0)
    return qa(spark, sf).select("pair_id", total.alias("weight"), F.when(total >= 6, "complex").when(total >= 3, "moderate").otherwise("simple").alias("complexity"))


def c20_solution(spark, sf):
    """Best pair of each reddit question: verified, confirmed, then by score."""
    rank = F.when(c("solution_type") == "verified", 3).when(c("solution_type") == "op_confirmed", 2).otherwise(1)
    r = qa(spark, sf).filter("source = 'reddit' and q_id is not null").select("q_id", "pair_id", (rank * 100000 + F.coalesce("a_score", F.lit(0))).alias("rank"))
    return best_of_group(r, ["q_id"], "rank", "pair_id").select("q_id", "pair_id")


def c44_off_topic(spark, sf):
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", (T.count_mentions(c("text"), ("formula", "cell", "column", "row", "sheet", "workbook", "table", "range", "macro", "pivot")) == 0).alias("off_topic"))


def c48_response_pattern(spark, sf):
    """Variation of the length of each author's answers, of three or more."""
    r = qa(spark, sf).filter("a_text <> '' and author is not null")
    g = r.groupBy("author").agg(F.count(F.lit(1)).alias("n"), F.avg(F.length("a_text")).alias("m"), F.stddev_samp(F.length("a_text")).alias("s"))
    return g.filter("n >= 3").select("author", "n", F.round(F.try_divide("s", "m"), 4).alias("variation"))


def e01_semantic_dedup(spark, sf):
    """Vectors kept after groups of similar ones are reduced to their first."""
    e = table(spark, sf, "embeddings")
    groups = components(similar_pairs(e, "vec_id", "embedding", 0.42).select("a", "b"))
    return e.join(groups.withColumnRenamed("id", "vec_id"), "vec_id", "left").filter(c("component").isNull() | (c("component") == c("vec_id"))).select("vec_id")


def e02_edges(spark, sf):
    """Pairs of cosine .95 among the vectors and a noisy copy of each."""
    e = table(spark, sf, "embeddings").select(c("vec_id").cast("bigint").alias("vec_id"), c("embedding").cast("array<double>").alias("v"))
    noisy = e.select((c("vec_id") + 1_000_000_000).alias("vec_id"), F.concat(F.transform(F.slice("v", 1, 1), lambda x: x * 1.25), F.slice("v", 2, 1 << 20)).alias("v"))
    return similar_pairs(e.unionByName(noisy), "vec_id", "v", 0.95).select("a", "b")


def e07_code_blocks(spark, sf):
    blocks = F.transform(T.formulas(c("a_text")), lambda x: F.lower(F.regexp_replace(x, "[ \t\n]+", "")))
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.size(F.array_distinct(blocks)).cast("bigint").alias("n"))


def r02_incremental(spark, sf):
    """Rows of the last 24 hours before the newest one."""
    d = table(spark, sf, "documents").filter("created_utc is not null")
    return d.join(d.agg(F.max("created_utc").alias("_last"))).filter(c("created_utc") > c("_last") - 86400).select("doc_id")


def r09_expiring_counts(spark, sf):
    """Keyed state with a timeout, run to the end of its input: the last count of each key."""
    events = table(spark, sf, "events").withColumn("ts", c("ts").cast("timestamp"))
    folder, out, mark = (scratch_path(spark, n) for n in ("stream", "state", "mark"))
    events = events.select("event_id", "event_type", "ts")
    events.write.parquet(folder)
    counts = expiring_counts(flows.file_stream(spark, folder, events.schema), "event_type", "ts", "1 hour", 3_600_000)
    counts.writeStream.outputMode("update").option("checkpointLocation", mark).trigger(availableNow=True).foreachBatch(lambda b, k: b.write.mode("append").parquet(out)).start().awaitTermination()
    return spark.read.parquet(out).groupBy("key").agg(F.max("n").alias("n"))


def r10_adaptive(spark, sf):
    return adaptive_threshold(table(spark, sf, "events"), "user_id", "event_id", c("event_type") != "error")


def r12_alerts(spark, sf):
    e = table(spark, sf, "events")
    level = F.when(c("value") > 300, "critical").when(c("value") > 150, "warning")
    return e.select("event_id", level.alias("level")).filter("level is not null")


def x03_status_log(spark, sf):
    """Status of each key from an append-only log: the latest entry wins."""
    log = table(spark, sf, "events").select((c("user_id") % 50).alias("batch"), "event_id", c("event_type").alias("status"))
    return log.groupBy("batch").agg(F.max_by("status", "event_id").alias("status"))


_W = "WITH " + QA
_F = r"=[A-Z][A-Z0-9.]*\([^()]*(?:\([^()]*\)[^()]*)*\)"
_B = T.BLANK
_STRIP = lambda t: rf"trim(regexp_replace(regexp_replace(regexp_replace({t}, '<[^<>]+>', ' ', 'g'), '&[A-Za-z0-9#]+;', ' ', 'g'), '{_B}', ' ', 'g'), ' ')"
_CODE = lambda t: rf"regexp_matches({t}, '(?s)```.*```|`[^`\n]+`|<code>|<pre>|=[A-Z]+\(')"
_OD = lambda x: f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"
_EXPL = f"trim(regexp_replace(regexp_replace(a_text, '{_F}', ' ', 'g'), '{_B}', ' ', 'g'), ' ')"
_E = "e AS (SELECT vec_id, list_transform(embedding, lambda z: z::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v FROM embeddings)"

QUERIES = {f.__name__: f for f in (s19_dataset, f09_submission_gate, f10_comment_gate, f12_answered, f15_after_cleaning, f23_log_filter, f26_confirmed, a04_korean_stats, a10_forum_tracker, a35_formula_ratio, a40_text_summary, u04_ordered_union, t14_keep_code, t18_clean_response, t26_final_response, t29_prefixes, t36_versions, t45_json_in_text, m3_half_even, c07_forum_parts, c09_context, c14_triage, c20_solution, c44_off_topic, c48_response_pattern, e01_semantic_dedup, e02_edges, e07_code_blocks, r02_incremental, r09_expiring_counts, r10_adaptive, r12_alerts, x03_status_log)}
ORACLES = {
    "r10_adaptive": "WITH RECURSIVE e AS (SELECT user_id, row_number() OVER w AS k, avg(CAST(event_type <> 'error' AS INTEGER)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS r FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), f(user_id, k, t) AS (SELECT DISTINCT user_id, 0::BIGINT, 0.7::DOUBLE FROM events UNION ALL SELECT f.user_id, e.k, CASE WHEN e.k >= 10 AND r < 0.5 THEN greatest(0.5::DOUBLE, t - 0.05::DOUBLE) WHEN e.k >= 10 AND r > 0.8 THEN least(0.95::DOUBLE, t + 0.02::DOUBLE) ELSE t END FROM f JOIN e ON e.user_id = f.user_id AND e.k = f.k + 1) SELECT user_id, max(k) AS events, round(arg_max(t, k), 6) AS threshold FROM f GROUP BY user_id",
    "s19_dataset": f"{_W} SELECT source AS dataset, count(*) AS n, count(a_text) AS answered FROM qa WHERE title IS NOT NULL AND a_text IS NOT NULL GROUP BY 1",
    "f09_submission_gate": f"{_W} SELECT pair_id FROM qa WHERE source = 'reddit' AND length(title) BETWEEN 10 AND 200 AND q_score >= 5 AND total_comments >= 3",
    "f10_comment_gate": f"{_W} SELECT pair_id FROM qa WHERE length(a_text) BETWEEN 50 AND 5000 AND a_score >= 0",
    "f12_answered": "SELECT DISTINCT post_id FROM oppadu_posts WHERE has_answer AND title IS NOT NULL",
    "f15_after_cleaning": f"{_W} SELECT pair_id FROM qa WHERE length({_STRIP('q_text')}) >= 10 AND length({_STRIP('a_text')}) >= 20",
    "f23_log_filter": "SELECT event_id FROM events WHERE contains(props, '\"k\": 7')",
    "f26_confirmed": f"{_W} SELECT pair_id FROM qa WHERE op_confirmed OR solution_type IN ('verified', 'op_confirmed')",
    "a04_korean_stats": f"{_W} SELECT count(*) AS n, count(*) FILTER (WHERE regexp_matches(title, '매출|재고|급여|예산')) AS business, count(*) FILTER (WHERE regexp_matches(title, '배열|매크로|피벗')) AS advanced FROM qa WHERE source = 'oppadu'",
    "a10_forum_tracker": f"{_W} SELECT count(*) AS n, round(avg(q_score), 6) AS q_mean, round(avg(a_score), 6) AS a_mean, count(DISTINCT author) AS authors FROM qa WHERE source = 'reddit'",
    "a35_formula_ratio": rf"{_W}, f AS (SELECT pair_id, regexp_extract_all(a_text, '=[A-Z]+\([^ \n]*') AS f FROM qa WHERE a_text IS NOT NULL) SELECT pair_id, len(f) AS n, round(len(list_filter(f, lambda x: len(regexp_extract_all(x, '\(')) = len(regexp_extract_all(x, '\)')))) / len(f)::DOUBLE, 6) AS share FROM f WHERE len(f) > 0",
    "a40_text_summary": rf"{_W}, f AS (SELECT CASE WHEN regexp_matches(a_text, '(?i)\b(sub|function) [a-z_0-9]+\(|\bdim [a-z]+ as\b|end sub') THEN 'vba' WHEN regexp_matches(a_text, '{_F}') THEN 'excel' WHEN regexp_matches(a_text, '(?i)\bselect\b[^;]*\bfrom\b') THEN 'sql' WHEN regexp_matches(a_text, '\bdef [a-z_]+\(|\bimport [a-z_]+\b') THEN 'python' WHEN regexp_matches(a_text, '\bconst [a-z]|\bfunction *\(|=>') THEN 'javascript' ELSE 'unknown' END AS l, len(regexp_extract_all(a_text, '{_F}')) AS f FROM qa WHERE a_text IS NOT NULL) SELECT count(*) AS n, count(*) FILTER (WHERE f > 0) AS with_formula, count(DISTINCT l) AS languages FROM f",
    "u04_ordered_union": f"{_W}, u AS (SELECT pair_id, list_concat(coalesce(tags, []), ['excel', 'qa']) AS t FROM qa) SELECT pair_id, {_OD('t')} AS tags FROM u",
    "t14_keep_code": f"{_W}, k AS (SELECT pair_id, regexp_split_to_array(t, '{_SPANS}') AS parts, regexp_extract_all(t, '{_SPANS}') AS spans FROM (SELECT pair_id, coalesce(a_md, a_text) AS t FROM qa) x WHERE t IS NOT NULL) SELECT pair_id, trim(array_to_string(list_transform(parts, lambda p, i: concat({_STRIP('p')}, ' ', coalesce(spans[i], ''))), ' '), ' ') AS text, len(spans) AS spans FROM k",
    "t18_clean_response": f"{_W} SELECT pair_id, {_STRIP('a_text')} AS text, len(list_distinct(regexp_extract_all(a_text, '{_F}'))) AS formulas, {_CODE('a_text')} AS code FROM qa WHERE a_text IS NOT NULL",
    "t26_final_response": f"{_W}, b AS (SELECT pair_id, coalesce(list_max(list_transform(regexp_extract_all(a_text, '{_F}'), lambda f: length(f))), 0) AS formula_length, {_EXPL} AS t FROM qa WHERE a_text IS NOT NULL) SELECT pair_id, formula_length, CASE WHEN len(list_filter(regexp_split_to_array(t, '{_B}'), lambda w: w <> '')) >= 3 THEN t END AS explanation FROM b",
    "t29_prefixes": rf"{_W} SELECT pair_id, regexp_replace(a_text, '^(?:안녕하세요[^\n]{{0,20}}[.!]? |답변이 늦어서 죄송합니다[.] |Sorry for the late reply, I only saw this today[.][ \n])', '') AS text FROM qa WHERE a_text IS NOT NULL",
    "t36_versions": r"SELECT DISTINCT post_id, nullif(regexp_extract(title, '_(20[0-9]{2})\.xlsx', 1), '') AS version FROM oppadu_posts WHERE title IS NOT NULL",
    "t45_json_in_text": "SELECT submission_id, collected_at, coalesce(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.author') END, 'unknown') AS author FROM reddit_collected",
    "m3_half_even": "SELECT source, round_even(target_percent / 8.0, 2)::DOUBLE AS eighth FROM keep_targets",
    "c07_forum_parts": f"{_W} SELECT pair_id, coalesce(q_score, 0) AS q, coalesce(a_score, 0) AS a, CASE solution_type WHEN 'verified' THEN 10 WHEN 'op_confirmed' THEN 5 WHEN 'inferred' THEN 2 ELSE 0 END AS bonus FROM qa WHERE source = 'reddit'",
    "c09_context": "SELECT DISTINCT post_id, CASE WHEN regexp_matches(title, '매출|예산|원가|견적') THEN 'finance' WHEN regexp_matches(title, '급여|수당|근무표|휴가') THEN 'staff' WHEN regexp_matches(title, '재고|창고|물량|부품') THEN 'stock' ELSE 'general' END AS domain FROM oppadu_posts WHERE title IS NOT NULL",
    "c14_triage": f"{_W}, w AS (SELECT pair_id, CAST(coalesce(list_sum(list_transform(tags, lambda t: CASE WHEN t IN ('xlookup', 'sortby', 'filter') THEN 3 WHEN t = 'excel' THEN 1 ELSE 2 END)), 0) AS INTEGER) + CASE WHEN length(coalesce(q_text, '')) > 500 THEN 2 WHEN length(coalesce(q_text, '')) > 200 THEN 1 ELSE 0 END AS weight FROM qa) SELECT pair_id, weight, CASE WHEN weight >= 6 THEN 'complex' WHEN weight >= 3 THEN 'moderate' ELSE 'simple' END AS complexity FROM w",
    "c20_solution": f"{_W} SELECT q_id, pair_id FROM qa WHERE source = 'reddit' AND q_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY CASE solution_type WHEN 'verified' THEN 3 WHEN 'op_confirmed' THEN 2 ELSE 1 END * 100000 + coalesce(a_score, 0) DESC, pair_id) = 1",
    "c44_off_topic": "SELECT doc_id, NOT (" + " OR ".join(f"contains(lower(text), '{w}')" for w in ("formula", "cell", "column", "row", "sheet", "workbook", "table", "range", "macro", "pivot")) + ") AS off_topic FROM documents WHERE text IS NOT NULL",
    "c48_response_pattern": f"{_W} SELECT author, count(*) AS n, round(stddev_samp(length(a_text)) / avg(length(a_text)), 4) AS variation FROM qa WHERE a_text <> '' AND author IS NOT NULL GROUP BY 1 HAVING count(*) >= 3",
    "e01_semantic_dedup": f"WITH RECURSIVE {_E}, p AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id < y.vec_id WHERE list_dot_product(x.v, y.v) >= 0.42), l AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r(id, seen) AS (SELECT a, a FROM l UNION SELECT r.id, l.b FROM r JOIN l ON r.seen = l.a), k AS (SELECT id, min(seen) AS component FROM r GROUP BY id) SELECT vec_id FROM embeddings LEFT JOIN k ON k.id = vec_id WHERE component IS NULL OR component = vec_id",
    "e02_edges": "WITH o AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), u AS (SELECT * FROM o UNION ALL SELECT vec_id + 1000000000, list_concat([v[1] * 1.25], v[2:]) FROM o), e AS (SELECT vec_id, list_transform(v, lambda z: z / sqrt(list_dot_product(v, v))) AS v FROM u) SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id < y.vec_id WHERE list_dot_product(x.v, y.v) >= 0.95",
    "e07_code_blocks": rf"{_W} SELECT pair_id, len(list_distinct(list_transform(regexp_extract_all(a_text, '{_F}'), lambda x: lower(regexp_replace(x, '[ \t\n]+', '', 'g'))))) AS n FROM qa WHERE a_text IS NOT NULL",
    "r02_incremental": "SELECT doc_id FROM documents WHERE created_utc > (SELECT max(created_utc) FROM documents) - 86400",
    "r09_expiring_counts": "SELECT event_type AS key, count(*) AS n FROM events GROUP BY 1",
    "r12_alerts": "SELECT event_id, CASE WHEN value > 300 THEN 'critical' ELSE 'warning' END AS level FROM events WHERE value > 150",
    "x03_status_log": "SELECT user_id % 50 AS batch, arg_max(event_type, event_id) AS status FROM events GROUP BY 1",
}
