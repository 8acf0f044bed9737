"""Page parsing, chains of cleaning steps, style and behaviour classes, loops as streams."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridwright.functions import text as T
from gridwright.plans.common import QA, qa
from gridwright.session import scratch_path, table, written
from gridwright.streaming import flows

c = F.col


def s30_embedding_cache(spark, sf):
    """Keys of the embedding cache: the hash of a title's first 50 characters; hits by key."""
    q = qa(spark, sf).filter("title is not null").select("pair_id", F.md5(F.substring("title", 1, 50)).alias("key"))
    return q.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def f04_forum_threshold(spark, sf):
    return qa(spark, sf).filter((c("source") == "reddit") & (c("overall") >= 1) & ~F.isnan("overall")).select("pair_id")


def a29_entries(spark, sf):
    return table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("source").alias("sources"))


def a39_methods(spark, sf):
    r = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("value") > 0).alias("ok"))
    return r.select("event_type", "n", F.round(100.0 * c("ok") / c("n"), 4).alias("percent"))


def o09_early_stop(spark, sf):
    """At most so many items of each source, the first by key."""
    k = W.partitionBy("source").orderBy("item_id")
    return table(spark, sf, "incoming_items").withColumn("k", F.row_number().over(k)).filter("k <= 20").select("source", "item_id")


def t21_noise(spark, sf):
    """Interface words and markup out, code kept."""
    bare = T.strip_markup(F.regexp_replace("a_text", r"\((?:read more|edited|계속)\)|\[(?:continued|more)\]", ""))
    return qa(spark, sf).filter("a_text is not null").select("pair_id", bare.alias("text"))


def t25_author_level(spark, sf):
    """Name and number of an author's handle."""
    return qa(spark, sf).filter("author is not null").select("author", F.regexp_extract("author", "^([a-z]+)_", 1).alias("name"), F.regexp_extract("author", "([0-9]+)$", 1).alias("level")).distinct()


def t27_blocks_by_length(spark, sf):
    """Formulas, the longest first, ties in text order."""
    f = T.formulas(c("a_text"))
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.array_sort(f, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)).alias("blocks")).filter("size(blocks) > 0")


def t32_rewrite_hosts(spark, sf):
    return table(spark, sf, "oppadu_posts").select("post_id", F.replace("url", F.lit("https://oppadu.example"), F.lit("https://cdn.oppadu.example")).alias("url")).distinct()


def t44_ocr_clean(spark, sf):
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", F.md5(T.collapse(F.regexp_replace("text", r"[|_~^]+", " "))).alias("h"))


def c13_crawler_score(spark, sf):
    """Words, keywords and code of a Korean pair."""
    n = T.word_count(F.coalesce("a_text", F.lit("")))
    words = T.count_mentions(F.coalesce("a_text", F.lit("")), ("함수", "수식", "범위", "피벗", "매크로"))
    score = F.least(F.lit(4.0), n / 10.0) + words * 0.2 + F.when(T.has_code(F.coalesce("a_text", F.lit(""))), 2.0).otherwise(0.0)
    return qa(spark, sf).filter("source = 'oppadu'").select("pair_id", F.round(score, 4).alias("score"))


def c15_recommendations(spark, sf):
    """Processing steps that a record asks for."""
    t = F.coalesce("a_text", F.lit(""))
    steps = F.array_compact(F.array(F.when(T.has_code(t), "extract_code"), F.when(t.contains("<"), "strip_markup"), F.when(F.length(t) > 500, "summarise")))
    return qa(spark, sf).select("pair_id", steps.alias("steps"))


def r01_micro_batches(spark, sf):
    """A continuous run, a few files a micro-batch: items and batches that were processed."""
    d = table(spark, sf, "documents").select("doc_id", "source")
    folder, out = scratch_path(spark, "stream"), scratch_path(spark, "batches")
    d.repartition(6, "doc_id").write.parquet(folder)
    stream = flows.file_stream(spark, folder, d.schema, per_batch=2)
    flows.sync(stream, lambda b, k: b.withColumn("batch", F.lit(k)).write.mode("append").parquet(out), scratch_path(spark, "mark")).awaitTermination()
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("items"), F.count_distinct("doc_id").alias("ids"))


def r04_two_targets(spark, sf):
    """Two targets, a query and a checkpoint each: both have every row once."""
    d = table(spark, sf, "documents").select("doc_id", "source")
    folder = scratch_path(spark, "stream")
    d.write.parquet(folder)
    outs = []
    for name in ("first", "second"):
        out = scratch_path(spark, name)
        flows.sync(flows.file_stream(spark, folder, d.schema), lambda b, k, out=out: b.write.mode("append").parquet(out), scratch_path(spark, "mark")).awaitTermination()
        outs.append(spark.read.parquet(out).select(F.lit(name).alias("target"), "doc_id"))
    return outs[0].unionByName(outs[1]).groupBy("target").agg(F.count_distinct("doc_id").alias("ids"), F.count(F.lit(1)).alias("rows"))


def r05_retries(spark, sf):
    """A target that fails twice receives each batch in the end, once."""
    d = table(spark, sf, "mix_targets").select("source")
    folder, out, fails = scratch_path(spark, "stream"), scratch_path(spark, "retried"), [2]
    d.write.parquet(folder)

    def send(batch, number):
        if fails[0]:
            fails[0] -= 1
            raise OSError("unreachable")
        batch.write.mode("append").parquet(out)

    flows.sync(flows.file_stream(spark, folder, d.schema), flows.with_retries(send), scratch_path(spark, "mark")).awaitTermination()
    return spark.read.parquet(out)


def r11_online_metrics(spark, sf):
    """Share of high values per event type after its last event: a mean is kept as sum and count,
    which add up over tasks."""
    r = table(spark, sf, "events").groupBy("event_type").agg(F.sum((c("value") > 50).cast("int")).alias("s"), F.count("value").alias("n"))
    return r.select("event_type", F.round(F.try_divide("s", "n"), 6).alias("rate"))


def x08_compaction(spark, sf):
    """A table of many small files written anew in few: the same rows."""
    small = scratch_path(spark, "small")
    table(spark, sf, "reddit_collected").select("submission_id", "collected_at").repartition(12).write.parquet(small)
    return written(spark.read.parquet(small).coalesce(2), "compact")


_W = "WITH " + QA
_B = T.BLANK
_F = r"=[A-Z][A-Z0-9.]*\([^()]*(?:\([^()]*\)[^()]*)*\)"
_CODE = lambda t: rf"regexp_matches({t}, '(?s)```.*```|`[^`\n]+`|<code>|<pre>|=[A-Z]+\(')"
_A = "coalesce(a_text, '')"
_N = lambda t: f"len(list_filter(regexp_split_to_array({t}, '{_B}'), lambda w: w <> ''))"
QUERIES = {f.__name__: f for f in (s30_embedding_cache, f04_forum_threshold, a29_entries, a39_methods, o09_early_stop, t21_noise, t25_author_level, t27_blocks_by_length, t32_rewrite_hosts, t44_ocr_clean, c13_crawler_score, c15_recommendations, r01_micro_batches, r04_two_targets, r05_retries, r11_online_metrics, x08_compaction)}
ORACLES = {
    "s30_embedding_cache": f"{_W} SELECT md5(substr(title, 1, 50)) AS key, count(*) AS n FROM qa WHERE title IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "f04_forum_threshold": f"{_W} SELECT pair_id FROM qa WHERE source = 'reddit' AND overall >= 1 AND NOT isnan(overall)",
    "a29_entries": "SELECT count(*) AS entries, count(DISTINCT source) AS sources FROM documents",
    "a39_methods": "SELECT event_type, count(*) AS n, round(100.0::DOUBLE * count(*) FILTER (WHERE value > 0) / count(*), 4) AS percent FROM events GROUP BY 1",
    "o09_early_stop": "SELECT source, item_id FROM incoming_items QUALIFY row_number() OVER (PARTITION BY source ORDER BY item_id) <= 20",
    "t21_noise": rf"{_W} SELECT pair_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(a_text, '\((?:read more|edited|계속)\)|\[(?:continued|more)\]', '', 'g'), '<[^<>]+>', ' ', 'g'), '&[A-Za-z0-9#]+;', ' ', 'g'), '{_B}', ' ', 'g'), ' ') AS text FROM qa WHERE a_text IS NOT NULL",
    "t25_author_level": f"{_W} SELECT DISTINCT author, regexp_extract(author, '^([a-z]+)_', 1) AS name, regexp_extract(author, '([0-9]+)$', 1) AS level FROM qa WHERE author IS NOT NULL",
    "t27_blocks_by_length": f"{_W}, f AS (SELECT pair_id, list_distinct(regexp_extract_all(a_text, '{_F}')) AS f FROM qa WHERE a_text IS NOT NULL) SELECT pair_id, list_transform(list_sort(list_transform(f, lambda x: struct_pack(n := -length(x), x := x))), lambda s: s.x) AS blocks FROM f WHERE len(f) > 0",
    "t32_rewrite_hosts": "SELECT DISTINCT post_id, replace(url, 'https://oppadu.example', 'https://cdn.oppadu.example') AS url FROM oppadu_posts",
    "t44_ocr_clean": f"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[|_~^]+', ' ', 'g'), '{_B}', ' ', 'g'), ' ')) AS h FROM documents WHERE text IS NOT NULL",
    "c13_crawler_score": f"{_W} SELECT pair_id, round(least(4.0::DOUBLE, {_N(_A)} / 10.0::DOUBLE) + (" + " + ".join(f"CAST(contains(lower({_A}), '{w}') AS INTEGER)" for w in ("함수", "수식", "범위", "피벗", "매크로")) + f") * 0.2::DOUBLE + CASE WHEN {_CODE(_A)} THEN 2.0 ELSE 0.0 END::DOUBLE, 4) AS score FROM qa WHERE source = 'oppadu'",
    "c15_recommendations": f"{_W} SELECT pair_id, list_filter([CASE WHEN {_CODE(_A)} THEN 'extract_code' END, CASE WHEN contains({_A}, '<') THEN 'strip_markup' END, CASE WHEN length({_A}) > 500 THEN 'summarise' END], lambda x: x IS NOT NULL) AS steps FROM qa",
    "r01_micro_batches": "SELECT count(*) AS items, count(DISTINCT doc_id) AS ids FROM documents",
    "r04_two_targets": "SELECT unnest(['first', 'second']) AS target, count(DISTINCT doc_id) AS ids, count(*) AS rows FROM documents",
    "r05_retries": "SELECT source FROM mix_targets",
    "r11_online_metrics": "SELECT event_type, round(avg(CAST(value > 50 AS INTEGER)), 6) AS rate FROM events GROUP BY 1",
    "x08_compaction": "SELECT submission_id, collected_at FROM reddit_collected",
}
