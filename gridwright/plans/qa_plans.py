"""Record shaping, filters, joins, set operations, sorts and statistics over Q&A records."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridwright.functions import text as T
from gridwright.functions.dialects import SPARK
from gridwright.operators.graph import components, nearest, similar_pairs
from gridwright.operators.relational import best_of_group, keyset_page, min_max, not_known, ratio
from gridwright.operators.user_texts import user_similarity
from gridwright.plans.common import QA, qa
from gridwright.session import table

c = F.col


# -- sources and shaping ------------------------------------------------------------------
def s15_scan(spark, sf):
    """A pruned, filtered scan: both reach the Parquet reader."""
    return table(spark, sf, "stackoverflow_collected").filter((c("quality_score") >= 8) & ~F.isnan("quality_score")).select("question_id", "quality_score").distinct()


def s16_prefix_scan(spark, sf):
    """Key-value scan by prefix, its JSON flattened."""
    rows = table(spark, sf, "reddit_collected").filter(c("submission_id").startswith("1a"))
    return rows.select("submission_id", "collected_at", F.from_json("metadata", "author string, answers bigint").alias("m")).select("submission_id", "collected_at", "m.author", "m.answers")


def s20_batch_export(spark, sf):
    """Flat export rows: arrays joined to text."""
    return qa(spark, sf).select("pair_id", "source", "title", F.array_join("tags", ", ").alias("tags"), "q_score")


def s27_insert_new(spark, sf):
    """Vectors that are not in the store yet."""
    e = table(spark, sf, "embeddings")
    return not_known(e.select("vec_id", "label"), e.filter("vec_id % 3 = 0").select("vec_id"), "vec_id")


def s28_delete(spark, sf):
    """What a delete of one label's vectors leaves."""
    e = table(spark, sf, "embeddings")
    return e.join(e.filter("label = 3").select("vec_id"), "vec_id", "left_anti").select("vec_id", "label")


def s29_image_sources(spark, sf):
    """Kinds of image sources, and the size of data URIs."""
    rows = table(spark, sf, "oppadu_posts").select("post_id", F.when(c("post_id") % 3 == 0, F.concat(F.lit("data:image/png;base64,"), F.md5("title"))).when(c("post_id") % 3 == 1, c("url")).otherwise(F.concat(F.lit("/img/"), "post_id", F.lit(".png"))).alias("src")).distinct()
    kind = F.when(c("src").startswith("data:image/"), "data").when(c("src").rlike("^https?://"), "url").when(c("src").rlike(r"\.(png|jpg|jpeg|gif)$"), "file").otherwise("invalid")
    return rows.select("post_id", "src", kind.alias("kind"), F.when(kind == "data", F.floor(F.length(F.regexp_extract("src", "base64,(.*)$", 1)) * 0.75)).alias("size"))


def pr01_canonical(spark, sf):
    """Canonical text: title and body, ids as text."""
    return qa(spark, sf).select(c("pair_id").cast("string").alias("id"), F.trim(F.concat_ws("\n", "title", "body")).alias("text"))


def pr02_body_if_any(spark, sf):
    return qa(spark, sf).select("pair_id", F.when(F.coalesce("body", F.lit("")) != "", F.concat_ws("\n", "title", "body")).otherwise(c("title")).alias("text"), F.lit("excel").alias("tag"))


def pr03_answer_id(spark, sf):
    return table(spark, sf, "oppadu_posts").select("post_id", F.concat("post_id", F.lit("_answer")).alias("answer_id"), F.lit("KR").alias("country")).distinct()


def pr05_tags(spark, sf):
    """Tags from a title's words, distinct and sorted."""
    words = ("pivot", "macro", "formula", "chart", "table", "vlookup", "filter", "date")
    return qa(spark, sf).filter("title is not null").select("pair_id", F.array_sort(F.array_distinct(F.concat(F.array(F.lit("excel")), T.mentions(c("title"), words)))).alias("tags"))


def pr06_vector_document(spark, sf):
    return qa(spark, sf).select("pair_id", F.concat_ws(" ", "title", "body").alias("embedding_text"), F.length(F.coalesce("a_text", F.lit(""))).cast("bigint").alias("answer_length"), F.coalesce(F.when(c("tags").isNotNull(), F.size("tags")), F.lit(0)).cast("bigint").alias("tag_count"))


def pr08_clean_row(spark, sf):
    """Trimmed question and answer, at most two tags, defaults; too short ones out."""
    rows = qa(spark, sf).select("pair_id", T.collapse(F.coalesce("q_text", F.lit(""))).alias("q"), T.collapse(F.coalesce("a_text", F.lit(""))).alias("a"), F.slice(F.coalesce("tags", F.array().cast("array<string>")), 1, 2).alias("tags"))
    return rows.filter((F.length("q") >= 10) & (F.length("a") >= 20))


def pr09_defaults(spark, sf):
    return qa(spark, sf).select("pair_id", F.coalesce("author", F.lit("[deleted]")).alias("author"), F.coalesce("a_score", F.lit(0)).alias("score"))


def pr11_context(spark, sf):
    """Ranked context lines of a source's best rated pairs."""
    rows = qa(spark, sf).filter("overall between 0 and 10 and title is not null")
    top = rows.withColumn("rank", F.row_number().over(W.partitionBy("source").orderBy(F.desc("overall"), "pair_id"))).filter("rank <= 5")
    line = F.concat(c("rank").cast("string"), F.lit(". "), F.substring("title", 1, 60))
    return top.groupBy("source").agg(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"])).alias("context"))


# -- filters ------------------------------------------------------------------------------
def f01_by_quality(spark, sf):
    return qa(spark, sf).filter((c("overall") >= 5) & ~F.isnan("overall")).select("pair_id", "overall")


def f02_text_gate(spark, sf):
    q, a = F.trim(F.coalesce("q_text", F.lit(""))), F.trim(F.coalesce("a_text", F.lit("")))
    return qa(spark, sf).filter((F.length(q) >= 10) & (F.length(a) >= 10) & (c("overall") >= 3) & ~F.isnan("overall")).select("pair_id")


def f05_two_of_three(spark, sf):
    """At least two of: tagged, a keyword in the title, a high score."""
    votes = F.coalesce(F.array_contains("tags", "xlookup"), F.lit(False)).cast("int") + T.count_mentions(F.coalesce("title", F.lit("")), ("formula", "pivot")).cast("boolean").cast("int") + (F.coalesce("q_score", F.lit(0)) >= 10).cast("int")
    return qa(spark, sf).filter(votes >= 2).select("pair_id")


def f08_answer_gate(spark, sf):
    return qa(spark, sf).filter(F.length("a_text").between(100, 10000) & (c("a_score") >= 0)).select("pair_id")


def f16_validators(spark, sf):
    return table(spark, sf, "oppadu_posts").select("post_id", c("url").rlike(r"^https?://[A-Za-z0-9.-]+(/[^ ]*)?$").alias("url_ok"), F.concat("post_id", F.lit("@mail.example")).rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$").alias("mail_ok")).distinct()


def f18_predicate_tree(spark, sf):
    """(tag in list OR source in list) AND score"""
    either = F.arrays_overlap("tags", F.array(F.lit("xlookup"), F.lit("sortby"))) | c("source").isin("oppadu")
    return qa(spark, sf).filter(either & (c("q_score") >= 5)).select("pair_id", "source")


def f22_contains(spark, sf):
    return qa(spark, sf).filter(F.lower("title").contains("macro") | F.lower("body").contains("macro")).select("pair_id")


# -- joins --------------------------------------------------------------------------------
def j01_question_to_post(spark, sf):
    """Pairs with the collected row of their question: a hash join on the key."""
    posts = table(spark, sf, "stackoverflow_collected").groupBy(c("question_id").cast("string").alias("q_id")).agg(F.count(F.lit(1)).alias("copies"))
    return qa(spark, sf).filter("source = 'stackoverflow'").join(posts, "q_id").select("pair_id", "q_id", "copies")


def j03_left_newest(spark, sf):
    """Posts with their accepted copy, newest first."""
    p = table(spark, sf, "oppadu_posts").groupBy("post_id").agg(F.max("collected_at").alias("at"))
    k = table(spark, sf, "oppadu_collected").groupBy("post_id").agg(F.max("quality_score").alias("score"))
    return p.join(k, "post_id", "left").orderBy(F.desc("at"), "post_id").limit(100)


def j05_not_in(spark, sf):
    """Documents of no thread that holds a null author."""
    d = table(spark, sf, "documents")
    bad = d.filter("author is null and thread_id is not null").select("thread_id").distinct()
    return d.filter("thread_id is not null").join(bad, "thread_id", "left_anti").select("doc_id")


def j06_not_collected(spark, sf):
    p = table(spark, sf, "oppadu_posts").select("post_id").distinct()
    return not_known(p, table(spark, sf, "oppadu_collected"), "post_id")


def j07_semi(spark, sf):
    k = table(spark, sf, "oppadu_collected").filter("quality_score >= 9 and not isnan(quality_score)").select("post_id")
    return table(spark, sf, "oppadu_posts").join(k, "post_id", "left_semi").select("post_id", "view_count").distinct()


def j12_dimension(spark, sf):
    """A literal map with a default instead of a join."""
    names = F.create_map(F.lit("stackoverflow"), F.lit("SO"), F.lit("reddit"), F.lit("RD"))
    return qa(spark, sf).groupBy(F.coalesce(names[c("source")], F.lit("other")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


def j09_similar_pairs(spark, sf):
    return similar_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", 0.45).select("a", "b", F.round("similarity", 4).alias("similarity"))


def j11_nearest(spark, sf):
    """Three nearest vectors of every vector whose id is divisible by 100."""
    e = table(spark, sf, "embeddings")
    return nearest(e, e.filter("vec_id % 100 = 0"), "vec_id", "embedding", 3).select("query", "id", "rank")


def j10_title_jaccard(spark, sf):
    """Trigram Jaccard of titles within a thread of collected copies of one key."""
    r = table(spark, sf, "reddit_collected").filter("title is not null").select("submission_id", "collected_at", T.char_grams(F.lower("title")).alias("g"))
    pairs = r.alias("x").join(r.alias("y"), (c("x.submission_id") == c("y.submission_id")) & (c("x.collected_at") < c("y.collected_at")))
    return pairs.select(c("x.submission_id").alias("id"), c("x.collected_at").alias("first"), F.round(T.jaccard(c("x.g"), c("y.g")), 6).alias("jaccard"))


def j10_user_similarity(spark, sf):
    """Mean and greatest trigram Jaccard over all pairs of an author's answers, and their weighted score."""
    said = F.lower(F.regexp_replace(F.when(c("a_text").rlike(r"(?U)\S"), c("a_text")).otherwise(c("a_md")), r"(?U)^\s+|\s+$", ""))
    rows = qa(spark, sf).select(c("author").alias("user"), said.alias("text")).filter(F.length("text") > 10)
    s = user_similarity(rows)
    return s.select(c("user").alias("author"), "n", F.round("mean", 6).alias("mean"), F.round("most", 6).alias("most"), F.expr(SPARK.round("0.6e0 * mean + 0.4e0 * most")).alias("score"))


# -- groups, windows, sorts ---------------------------------------------------------------
def e03_components(spark, sf):
    pairs = similar_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", 0.42)
    return components(pairs.select("a", "b"))


def e04_keep_best(spark, sf):
    """Best document of each group of equal texts, the longest thread wins, ties by id."""
    d = table(spark, sf, "documents").filter("text is not null").select(F.md5("text").alias("group"), "doc_id", F.coalesce("n_chars", F.lit(-1)).alias("n"))
    return best_of_group(d, ["group"], "n", "doc_id").select("group", "doc_id")


def e05_group_size(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null").groupBy(F.md5("text").alias("group")).agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("first"))
    return d.filter("size > 1").withColumn("was_duplicate", F.lit(True))


def e08_first_wins(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null")
    return d.groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


def a06_dedup_stats(spark, sf):
    g = table(spark, sf, "documents").filter("text is not null").groupBy(F.md5("text").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    dup = g.filter("n > 1")
    return dup.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(c("n") - 1), F.lit(0)).alias("removed"), F.round(F.avg("n"), 6).alias("mean_size"), F.max("n").alias("largest"))


def w01_min_max(spark, sf):
    rows = qa(spark, sf).filter("q_score is not null and a_score is not null").select("pair_id", "source", c("q_score").cast("double").alias("q"), c("a_score").cast("double").alias("a"))
    return min_max(rows, ["q", "a"], ["source"]).select("pair_id", F.round("q_norm", 6).alias("q_norm"), F.round("a_norm", 6).alias("a_norm"))


def w02_best_of_group(spark, sf):
    rows = qa(spark, sf).filter("q_id is not null").select("q_id", "pair_id", "a_score")
    return best_of_group(rows, ["q_id"], "a_score", "pair_id").select("q_id", "pair_id")


def w10_best_answer(spark, sf):
    """Of each question: confirmed first, then by score, then the first; whoever wrote it."""
    rank = F.struct(F.coalesce("op_confirmed", F.lit(False)).alias("ok"), "a_score")
    rows = qa(spark, sf).filter("q_id is not null").select("source", "q_id", "pair_id", rank.alias("rank"))
    return best_of_group(rows, ["source", "q_id"], "rank", "pair_id").select("source", "q_id", "pair_id")


def a25_tag_frequency(spark, sf):
    return qa(spark, sf).select(F.explode("tags").alias("tag")).groupBy("tag").count().withColumnRenamed("count", "n").orderBy(F.desc("n"), "tag").limit(10)


def a26_keyword_shares(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null")
    words = ("pivot", "macro", "formula", "sort", "column")
    counts = d.agg(F.count(F.lit(1)).alias("docs"), *[F.count_if(F.lower("text").contains(w)).alias(w) for w in words])
    return counts.unpivot("docs", list(words), "word", "n").select("word", "n", F.round(ratio(c("n"), c("docs")), 6).alias("share"))


def a27_score_range(spark, sf):
    return qa(spark, sf).groupBy("source").agg(F.min("a_score").alias("least"), F.max("a_score").alias("most"), F.round(F.avg("a_score"), 6).alias("mean"), F.count("a_score").alias("n"))


def a03_forum_stats(spark, sf):
    r = qa(spark, sf).filter("source = 'reddit'")
    return r.groupBy("solution_type").agg(F.count(F.lit(1)).alias("n"), F.round(100 * ratio(F.count_if("op_confirmed"), F.count(F.lit(1))), 4).alias("confirmed_percent"))


def a42_by_source(spark, sf):
    return table(spark, sf, "qa_pairs").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def a12_pivot(spark, sf):
    """Counts by source and kind of solution as columns."""
    r = qa(spark, sf).groupBy("source").pivot("solution_type", ["inferred", "verified", "op_confirmed"]).agg(F.count(F.lit(1)))
    return r.select("source", *[F.coalesce(k, F.lit(0)).alias(k) for k in ("inferred", "verified", "op_confirmed")])


def a17_funnel(spark, sf):
    r = qa(spark, sf).agg(F.count(F.lit(1)).alias("collected"), F.count_if(F.length("a_text") >= 20).alias("long_enough"), F.count_if((F.length("a_text") >= 20) & (c("overall") >= 5) & ~F.isnan("overall")).alias("passed"))
    return r.select("*", F.round(ratio(c("passed"), c("collected")), 6).alias("pass_rate"))


def o01_top(spark, sf):
    return qa(spark, sf).filter("overall between 0 and 10").orderBy(F.desc("overall"), "pair_id").select("pair_id", "overall").limit(50)


def o02_keyset(spark, sf):
    return keyset_page(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 500, 100)


def o03_offset(spark, sf):
    return table(spark, sf, "documents").select("doc_id").orderBy("doc_id").offset(200).limit(50)


def o04_top_authors(spark, sf):
    return qa(spark, sf).filter("author is not null").groupBy("author").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "author").limit(10)


def o08_longest_formula(spark, sf):
    f = T.formulas(c("a_text"))
    longest = F.array_max(F.transform(f, lambda x: F.struct(F.length(x).alias("n"), x.alias("f"))))
    return qa(spark, sf).filter("a_text is not null").select("pair_id", longest["n"].cast("bigint").alias("n")).filter("n is not null")


def u01_union(spark, sf):
    """Sources of different shapes as one table; missing columns are null."""
    a = table(spark, sf, "oppadu_posts").select("post_id", "title", "view_count")
    b = table(spark, sf, "reddit_collected").select(c("submission_id").alias("post_id"), "title", "quality_score")
    return a.unionByName(b, allowMissingColumns=True).groupBy(c("view_count").isNull().alias("no_views")).agg(F.count(F.lit(1)).alias("n"), F.count("quality_score").alias("scored"))


def u02_difference(spark, sf):
    p = table(spark, sf, "oppadu_posts").select("post_id").distinct()
    return p.exceptAll(table(spark, sf, "oppadu_collected").select("post_id").distinct())


def u03_jaccard(spark, sf):
    """Jaccard of the tags of a pair and of its source's common tags."""
    common = F.array(F.lit("excel"), F.lit("xlookup"), F.lit("pivot"))
    return qa(spark, sf).filter("tags is not null").select("pair_id", F.round(T.jaccard(F.array_distinct("tags"), common), 6).alias("jaccard"))


def u05_top_up(spark, sf):
    """Filtered hits first, topped up with others, no repeats."""
    rows = qa(spark, sf).filter("overall between 0 and 10").select("pair_id", "overall", F.coalesce(F.array_contains("tags", "sortby"), F.lit(False)).cast("int").alias("hit"))
    return rows.orderBy(F.desc("hit"), F.desc("overall"), "pair_id").limit(30)


_W = "WITH " + QA
_GOOD = "overall BETWEEN 0 AND 10"
_N = "list_dot_product(x.v, y.v)"
_E = "e AS (SELECT vec_id, list_transform(embedding, lambda z: z::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v, label FROM embeddings)"
_FORM = r"=[A-Z][A-Z0-9.]*\([^()]*(?:\([^()]*\)[^()]*)*\)"
_B = r"[ \t\n\r\f\x0B]+"
_HITS = lambda t, ws: "(" + " + ".join(f"CAST(contains(lower({t}), '{w}') AS INTEGER)" for w in ws) + ")"
_CODE = r"regexp_matches({}, '(?s)```.*```|`[^`\n]+`|<code>|<pre>|=[A-Z]+\(')"
_GRAMS = "CASE WHEN length(lower({t})) >= 3 THEN list_distinct(list_transform(generate_series(1, length(lower({t})) - 2), lambda i: substr(lower({t}), i, 3))) ELSE [] END"

QUERIES = {f.__name__: f for f in (s15_scan, s16_prefix_scan, s20_batch_export, s27_insert_new, s28_delete, s29_image_sources, pr01_canonical, pr02_body_if_any, pr03_answer_id, pr05_tags, pr06_vector_document, pr08_clean_row, pr09_defaults, pr11_context, f01_by_quality, f02_text_gate, f05_two_of_three, f08_answer_gate, f16_validators, f18_predicate_tree, f22_contains, j01_question_to_post, j03_left_newest, j05_not_in, j06_not_collected, j07_semi, j09_similar_pairs, j10_title_jaccard, j10_user_similarity, j11_nearest, j12_dimension, e03_components, e04_keep_best, e05_group_size, e08_first_wins, a03_forum_stats, a06_dedup_stats, a12_pivot, a17_funnel, a25_tag_frequency, a26_keyword_shares, a27_score_range, a42_by_source, w01_min_max, w02_best_of_group, w10_best_answer, o01_top, o02_keyset, o03_offset, o04_top_authors, o08_longest_formula, u01_union, u02_difference, u03_jaccard, u05_top_up)}
ORACLES = {
    "s15_scan": "SELECT DISTINCT question_id, quality_score FROM stackoverflow_collected WHERE quality_score >= 8 AND NOT isnan(quality_score)",
    "s16_prefix_scan": "SELECT submission_id, collected_at, CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.author') END AS author, CAST(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.answers') END AS BIGINT) AS answers FROM reddit_collected WHERE starts_with(submission_id, '1a')",
    "s20_batch_export": f"{_W} SELECT pair_id, source, title, array_to_string(tags, ', ') AS tags, q_score FROM qa",
    "s27_insert_new": "SELECT vec_id, label FROM embeddings WHERE vec_id % 3 <> 0",
    "s28_delete": "SELECT vec_id, label FROM embeddings WHERE label <> 3",
    "s29_image_sources": r"WITH s AS (SELECT DISTINCT post_id, CASE WHEN CAST(post_id AS BIGINT) % 3 = 0 THEN 'data:image/png;base64,' || md5(title) WHEN CAST(post_id AS BIGINT) % 3 = 1 THEN url ELSE '/img/' || post_id || '.png' END AS src FROM oppadu_posts) SELECT *, CASE WHEN kind = 'data' THEN CAST(floor(length(regexp_extract(src, 'base64,(.*)$', 1)) * 0.75) AS BIGINT) END AS size FROM (SELECT *, CASE WHEN starts_with(src, 'data:image/') THEN 'data' WHEN regexp_matches(src, '^https?://') THEN 'url' WHEN regexp_matches(src, '\.(png|jpg|jpeg|gif)$') THEN 'file' ELSE 'invalid' END AS kind FROM s)",
    "pr01_canonical": f"{_W} SELECT CAST(pair_id AS VARCHAR) AS id, trim(concat_ws(chr(10), title, body), ' ') AS text FROM qa",
    "pr02_body_if_any": f"{_W} SELECT pair_id, CASE WHEN coalesce(body, '') <> '' THEN concat_ws(chr(10), title, body) ELSE title END AS text, 'excel' AS tag FROM qa",
    "pr03_answer_id": "SELECT DISTINCT post_id, post_id || '_answer' AS answer_id, 'KR' AS country FROM oppadu_posts",
    "pr05_tags": f"{_W} SELECT pair_id, list_sort(list_distinct(list_concat(['excel'], list_filter(['pivot', 'macro', 'formula', 'chart', 'table', 'vlookup', 'filter', 'date'], lambda w: contains(lower(title), w))))) AS tags FROM qa WHERE title IS NOT NULL",
    "pr06_vector_document": f"{_W} SELECT pair_id, concat_ws(' ', title, body) AS embedding_text, length(coalesce(a_text, '')) AS answer_length, coalesce(len(tags), 0) AS tag_count FROM qa",
    "pr08_clean_row": f"{_W}, r AS (SELECT pair_id, trim(regexp_replace(coalesce(q_text, ''), '{_B}', ' ', 'g'), ' ') AS q, trim(regexp_replace(coalesce(a_text, ''), '{_B}', ' ', 'g'), ' ') AS a, coalesce(tags[1:2], []) AS tags FROM qa) SELECT * FROM r WHERE length(q) >= 10 AND length(a) >= 20",
    "pr09_defaults": f"{_W} SELECT pair_id, coalesce(author, '[deleted]') AS author, coalesce(a_score, 0) AS score FROM qa",
    "pr11_context": f"{_W}, t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY overall DESC, pair_id) AS rank FROM qa WHERE {_GOOD} AND title IS NOT NULL) SELECT source, string_agg(rank || '. ' || substr(title, 1, 60), chr(10) ORDER BY rank) AS context FROM t WHERE rank <= 5 GROUP BY source",
    "f01_by_quality": f"{_W} SELECT pair_id, overall FROM qa WHERE overall >= 5 AND NOT isnan(overall)",
    "f02_text_gate": f"{_W} SELECT pair_id FROM qa WHERE length(trim(coalesce(q_text, ''), ' ')) >= 10 AND length(trim(coalesce(a_text, ''), ' ')) >= 10 AND overall >= 3 AND NOT isnan(overall)",
    "f05_two_of_three": f"{_W} SELECT pair_id FROM qa WHERE CAST(coalesce(list_contains(tags, 'xlookup'), false) AS INTEGER) + CAST({_HITS(chr(99) + 'oalesce(title, ' + chr(39) * 2 + ')', ('formula', 'pivot'))} > 0 AS INTEGER) + CAST(coalesce(q_score, 0) >= 10 AS INTEGER) >= 2",
    "f08_answer_gate": f"{_W} SELECT pair_id FROM qa WHERE length(a_text) BETWEEN 100 AND 10000 AND a_score >= 0",
    "f16_validators": r"SELECT DISTINCT post_id, regexp_matches(url, '^https?://[A-Za-z0-9.-]+(/[^ ]*)?$') AS url_ok, regexp_matches(post_id || '@mail.example', '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') AS mail_ok FROM oppadu_posts",
    "f18_predicate_tree": f"{_W} SELECT pair_id, source FROM qa WHERE (list_has_any(tags, ['xlookup', 'sortby']) OR source IN ('oppadu')) AND q_score >= 5",
    "f22_contains": f"{_W} SELECT pair_id FROM qa WHERE contains(lower(title), 'macro') OR contains(lower(body), 'macro')",
    "j01_question_to_post": f"{_W} SELECT pair_id, q_id, copies FROM qa JOIN (SELECT CAST(question_id AS VARCHAR) AS k, count(*) AS copies FROM stackoverflow_collected GROUP BY 1) ON q_id = k WHERE source = 'stackoverflow'",
    "j03_left_newest": "SELECT * FROM (SELECT p.post_id, p.\"at\" AS \"at\", k.score FROM (SELECT post_id, max(collected_at) AS \"at\" FROM oppadu_posts GROUP BY 1) p LEFT JOIN (SELECT post_id, max(quality_score) AS score FROM oppadu_collected GROUP BY 1) k ON p.post_id = k.post_id) ORDER BY \"at\" DESC, post_id LIMIT 100",
    "j05_not_in": "SELECT doc_id FROM documents WHERE thread_id IS NOT NULL AND thread_id NOT IN (SELECT thread_id FROM documents WHERE author IS NULL AND thread_id IS NOT NULL)",
    "j06_not_collected": "SELECT DISTINCT post_id FROM oppadu_posts WHERE post_id NOT IN (SELECT post_id FROM oppadu_collected WHERE post_id IS NOT NULL)",
    "j07_semi": "SELECT DISTINCT post_id, view_count FROM oppadu_posts WHERE post_id IN (SELECT post_id FROM oppadu_collected WHERE quality_score >= 9 AND NOT isnan(quality_score))",
    "j09_similar_pairs": f"WITH {_E} SELECT x.vec_id AS a, y.vec_id AS b, round({_N}, 4) AS similarity FROM e x JOIN e y ON x.vec_id < y.vec_id WHERE {_N} >= 0.45",
    "j10_title_jaccard": f"WITH r AS (SELECT submission_id, collected_at, {_GRAMS.format(t='title')} AS g FROM reddit_collected WHERE title IS NOT NULL) SELECT x.submission_id AS id, x.collected_at AS first, round(CASE WHEN len(list_distinct(list_concat(x.g, y.g))) > 0 THEN len(list_intersect(x.g, y.g)) / len(list_distinct(list_concat(x.g, y.g)))::DOUBLE ELSE 0 END, 6) AS jaccard FROM r x JOIN r y ON x.submission_id = y.submission_id AND x.collected_at < y.collected_at",
    "j11_nearest": f"WITH {_E} SELECT query, id, rank FROM (SELECT y.vec_id AS query, x.vec_id AS id, row_number() OVER (PARTITION BY y.vec_id ORDER BY {_N} DESC, x.vec_id) AS rank FROM e x JOIN e y ON x.vec_id <> y.vec_id WHERE y.vec_id % 100 = 0) WHERE rank <= 3",
    "j12_dimension": f"{_W} SELECT CASE source WHEN 'stackoverflow' THEN 'SO' WHEN 'reddit' THEN 'RD' ELSE 'other' END AS code, count(*) AS n FROM qa GROUP BY 1",
    "e03_components": f"WITH RECURSIVE {_E}, p AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id < y.vec_id WHERE {_N} >= 0.42), l AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r(id, seen) AS (SELECT a, a FROM l UNION SELECT r.id, l.b FROM r JOIN l ON r.seen = l.a) SELECT id, min(seen) AS component FROM r GROUP BY id",
    "e04_keep_best": "SELECT md5(text) AS \"group\", doc_id FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY coalesce(n_chars, -1) DESC, doc_id) = 1",
    "e05_group_size": "SELECT md5(text) AS \"group\", count(*) AS size, min(doc_id) AS first, true AS was_duplicate FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "e08_first_wins": "SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text",
    "a03_forum_stats": f"{_W} SELECT solution_type, count(*) AS n, round(100.0 * count(*) FILTER (WHERE op_confirmed) / count(*), 4) AS confirmed_percent FROM qa WHERE source = 'reddit' GROUP BY 1",
    "a06_dedup_stats": "WITH g AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text) SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS removed, round(avg(n), 6) AS mean_size, max(n) AS largest FROM g WHERE n > 1",
    "a12_pivot": f"{_W} SELECT source, count(*) FILTER (WHERE solution_type = 'inferred') AS inferred, count(*) FILTER (WHERE solution_type = 'verified') AS verified, count(*) FILTER (WHERE solution_type = 'op_confirmed') AS op_confirmed FROM qa GROUP BY source",
    "a17_funnel": f"{_W}, f AS (SELECT count(*) AS collected, count(*) FILTER (WHERE length(a_text) >= 20) AS long_enough, count(*) FILTER (WHERE length(a_text) >= 20 AND overall >= 5 AND NOT isnan(overall)) AS passed FROM qa) SELECT *, round(passed / collected::DOUBLE, 6) AS pass_rate FROM f",
    "a25_tag_frequency": f"{_W} SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM qa) GROUP BY tag ORDER BY n DESC, tag LIMIT 10",
    "a26_keyword_shares": "WITH d AS (SELECT lower(text) AS t FROM documents WHERE text IS NOT NULL) SELECT word, count(*) FILTER (WHERE contains(t, word)) AS n, round(count(*) FILTER (WHERE contains(t, word)) / count(*)::DOUBLE, 6) AS share FROM d, (SELECT unnest(['pivot', 'macro', 'formula', 'sort', 'column']) AS word) GROUP BY word",
    "a27_score_range": f"{_W} SELECT source, min(a_score) AS least, max(a_score) AS most, round(avg(a_score), 6) AS mean, count(a_score) AS n FROM qa GROUP BY source",
    "a42_by_source": "SELECT source, count(*) AS n FROM qa_pairs GROUP BY source",
    "w01_min_max": f"{_W}, r AS (SELECT pair_id, q_score::DOUBLE AS q, a_score::DOUBLE AS a, count(*) OVER s AS n, min(q_score) OVER s AS ql, max(q_score) OVER s AS qh, min(a_score) OVER s AS al, max(a_score) OVER s AS ah FROM qa WHERE q_score IS NOT NULL AND a_score IS NOT NULL WINDOW s AS (PARTITION BY source)) SELECT pair_id, round(CASE WHEN n <= 1 OR qh = ql THEN 1.0 ELSE (q - ql) / (qh - ql) END::DOUBLE, 6) AS q_norm, round(CASE WHEN n <= 1 OR ah = al THEN 1.0 ELSE (a - al) / (ah - al) END::DOUBLE, 6) AS a_norm FROM r",
    "w02_best_of_group": f"{_W} SELECT q_id, pair_id FROM qa WHERE q_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY a_score DESC NULLS LAST, pair_id) = 1",
    "w10_best_answer": f"{_W} SELECT source, q_id, pair_id FROM qa WHERE q_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, q_id ORDER BY CAST(coalesce(op_confirmed, false) AS INTEGER) DESC, a_score DESC NULLS LAST, pair_id) = 1",
    "o01_top": f"{_W} SELECT pair_id, overall FROM qa WHERE {_GOOD} ORDER BY overall DESC, pair_id LIMIT 50",
    "o02_keyset": "SELECT doc_id, source FROM documents WHERE doc_id > 500 ORDER BY doc_id LIMIT 100",
    "o03_offset": "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50 OFFSET 200",
    "o04_top_authors": f"{_W} SELECT author, count(*) AS n FROM qa WHERE author IS NOT NULL GROUP BY author ORDER BY n DESC, author LIMIT 10",
    "o08_longest_formula": f"{_W} SELECT * FROM (SELECT pair_id, list_max(list_transform(regexp_extract_all(a_text, '{_FORM}'), lambda f: length(f))) AS n FROM qa WHERE a_text IS NOT NULL) WHERE n IS NOT NULL",
    "u01_union": "SELECT view_count IS NULL AS no_views, count(*) AS n, count(quality_score) AS scored FROM (SELECT post_id, title, view_count, NULL::DOUBLE AS quality_score FROM oppadu_posts UNION ALL SELECT submission_id, title, NULL, quality_score FROM reddit_collected) GROUP BY 1",
    "u02_difference": "SELECT DISTINCT post_id FROM oppadu_posts EXCEPT SELECT post_id FROM oppadu_collected",
    "u03_jaccard": f"{_W} SELECT pair_id, round(len(list_intersect(list_distinct(tags), ['excel', 'xlookup', 'pivot'])) / len(list_distinct(list_concat(tags, ['excel', 'xlookup', 'pivot'])))::DOUBLE, 6) AS jaccard FROM qa WHERE tags IS NOT NULL",
    "u05_top_up": f"{_W} SELECT pair_id, overall, CAST(coalesce(list_contains(tags, 'sortby'), false) AS INTEGER) AS hit FROM qa WHERE {_GOOD} ORDER BY hit DESC, overall DESC, pair_id LIMIT 30",
}
