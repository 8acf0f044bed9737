"""Round trips of sources and sinks, HTML functions, and streams run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from gridwright.functions import markup
from gridwright.plans.common import QA, qa
from gridwright.session import scratch_path, table
from gridwright.sources import io
from gridwright.streaming import flows

c = F.col
POST = StructType([StructField("post_id", StringType()), StructField("title", StringType()), StructField("view_count", LongType()), StructField("collected_at", DoubleType())])


def _posts(spark, sf):
    return table(spark, sf, "oppadu_posts").select(*POST.fieldNames()).dropDuplicates(["post_id", "collected_at"])


def s12_jsonl_lenient(spark, sf):
    """Written as JSON lines with broken ones between, read back without these."""
    path = scratch_path(spark, "jsonl")
    lines = _posts(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    lines.unionByName(spark.createDataFrame([("{broken",), ("",), ("[1,",)], "value string")).write.text(path)
    return io.read_jsonl(spark, path, POST)


def s13_jsonl_strict(spark, sf):
    path = scratch_path(spark, "jsonl")
    io.write_jsonl(_posts(spark, sf), path)
    return io.read_jsonl(spark, path, POST, strict=True)


def s14_documents(spark, sf):
    """Documents with a samples array, one a source, exploded again."""
    path = scratch_path(spark, "docs")
    rows = _posts(spark, sf)
    # about 200 samples a document, however many rows there are
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("post_id"), F.lit(max(1, rows.count() // 200))))
    documents = rows.groupBy("bucket").agg(F.collect_list(F.struct(*POST.fieldNames())).alias("samples")).select("bucket", F.to_json(F.struct("samples")).alias("value"))
    documents.write.partitionBy("bucket").text(path)
    return io.read_documents(spark, f"{path}/bucket=*", POST)


def s18_date_partitions(spark, sf):
    """Rows of each date folder that a partitioned write made."""
    path = scratch_path(spark, "dated")
    io.write_by_date(_posts(spark, sf), path, "collected_at")
    back = spark.read.schema(StructType([*POST.fields, *[StructField(p, StringType()) for p in ("year", "month", "day")]])).json(path)
    return back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


def s24_dead_letters(spark, sf):
    """Records with a bad score, as the dead-letter sink gets them."""
    score = c("quality_score")
    problem = F.when(score.isNull(), "missing").when(F.isnan(score), "not_a_number").when((score < 0) | (score > 10), "out_of_range")
    rows = table(spark, sf, "reddit_collected").select("submission_id", "collected_at", problem.alias("problem"))
    return io.dead_letters(rows, "problem", "score").groupBy("error_type", "stage").agg(F.count(F.lit(1)).alias("n"), F.count("payload").alias("payloads"))


def s24_rejected_lines(spark, sf):
    path = scratch_path(spark, "jsonl")
    table(spark, sf, "reddit_collected").filter("metadata is not null").select(c("metadata").alias("value")).write.text(path)
    good, bad = io.read_with_rejects(spark, path, StructType([StructField("lang", StringType()), StructField("answers", LongType())]))
    return good.agg(F.count(F.lit(1)).alias("good")).join(bad.agg(F.count(F.lit(1)).alias("bad")))


def s25_append(spark, sf):
    """Two appends to one dataset, counted by the append."""
    path = scratch_path(spark, "append")
    for part in (0, 1):
        _posts(spark, sf).filter(F.pmod(c("post_id").cast("bigint"), F.lit(2)) == part).withColumn("part", F.lit(part)).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def s26_file_counts(spark, sf):
    return io.file_counts(table(spark, sf, "documents")).agg(F.sum("rows").alias("rows"))


def t11_html_text(spark, sf):
    return qa(spark, sf).filter("a_text is not null").select("pair_id", markup.html_text("a_text").alias("text"))


def t09_html_code(spark, sf):
    page = F.concat(F.lit("<div><pre><code>"), F.coalesce(F.regexp_extract("a_text", r"=[A-Z]+\([^()]*\)", 0), F.lit("")), F.lit("</code></pre><p>x</p></div>"))
    return qa(spark, sf).filter("a_text is not null").select("pair_id", F.element_at(F.concat(markup.html_code(page), F.array(F.lit(""))), 1).alias("code"))


def s07_links(spark, sf):
    """Links of list pages built from posts, one row a link."""
    page = F.concat(F.lit('<ul><li><a href="'), "url", F.lit('">'), F.coalesce("title", F.lit("")), F.lit("</a></li></ul>"))
    return table(spark, sf, "oppadu_posts").select("post_id", F.explode(markup.html_links(page)).alias("link")).distinct()


def t34_absolute(spark, sf):
    relative = F.regexp_replace("url", "^https?://[^/]+", "")
    return table(spark, sf, "oppadu_posts").select("post_id", markup.absolute_urls("https://oppadu.example/")(relative).alias("url")).distinct()


def t28_first_formula(spark, sf):
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", markup.first_formula("text").alias("formula")).filter("formula is not null")


def t22_unescape_all(spark, sf):
    return qa(spark, sf).filter("a_text is not null").select("pair_id", markup.unescape_all("a_text").alias("plain"))


def r06_idempotent_ingest(spark, sf):
    """Usage records streamed twice into one table: every id is there once."""
    source = table(spark, sf, "usage_records")
    folder, out, mark = (scratch_path(spark, n) for n in ("stream", "ingested", "mark"))
    source.write.parquet(folder)
    for _ in range(2):
        flows.ingest_once(flows.file_stream(spark, folder, source.schema), "id", out, mark).awaitTermination()
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


def _events(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", c("ts").cast("timestamp"))
    folder = scratch_path(spark, "stream")
    events.write.parquet(folder)
    return flows.file_stream(spark, folder, events.schema)


def r07_tumbling_stream(spark, sf):
    """Events per hour and type, as a stream run to its end."""
    out = scratch_path(spark, "counts")
    counts = flows.tumbling_counts(_events(spark, sf), "ts", "1 hour", "1 hour", ["event_type"])
    flows.run_to_table(counts, out, scratch_path(spark, "mark")).awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("hours"), F.sum("n").alias("n"))


def r07_sessions_stream(spark, sf):
    out = scratch_path(spark, "sessions")
    flows.run_to_table(flows.session_counts(_events(spark, sf), "ts", "30 minutes", "1 hour", ["user_id"]), out, scratch_path(spark, "mark")).awaitTermination()
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("n"))


def r03_sync(spark, sf):
    """Rows that a target received over two runs: each once."""
    out = scratch_path(spark, "target")
    send = flows.with_retries(lambda batch, number: batch.select("event_id").write.mode("append").parquet(out))
    stream, mark = _events(spark, sf), scratch_path(spark, "mark")
    for _ in range(2):
        flows.sync(stream, send, mark).awaitTermination()
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("ids"))


_P = "p AS (SELECT DISTINCT ON (post_id, collected_at) post_id, title, view_count, collected_at FROM oppadu_posts)"
#: The entities that the test tables hold, the ampersand last; and a text's tags, code with its content.
_ENTITIES = lambda t: "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&nbsp;', chr(160)), '&amp;', '&')".format(t)
_TAGS = r"regexp_replace(regexp_replace(regexp_replace(a_text, '(?is)<pre\b.*?</pre>|<code\b.*?</code>|<script\b.*?</script>|<style\b.*?</style>', '', 'g'), '(?i)</?(?:p|br|div|li|tr|h[1-4]|ul|ol|table|blockquote)\b[^<>]*>', ' ', 'g'), '</?[A-Za-z][^<>]*>', '', 'g')"
QUERIES = {f.__name__: f for f in (s07_links, s12_jsonl_lenient, s13_jsonl_strict, s14_documents, s18_date_partitions, s24_dead_letters, s24_rejected_lines, s25_append, s26_file_counts, t09_html_code, t11_html_text, t22_unescape_all, t28_first_formula, t34_absolute, r03_sync, r06_idempotent_ingest, r07_tumbling_stream, r07_sessions_stream)}
ORACLES = {
    "t11_html_text": f"WITH {QA} SELECT pair_id, trim(regexp_replace({_ENTITIES(_TAGS)}, '[\\s\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{3000}}]+', ' ', 'g'), ' ') AS text FROM qa WHERE a_text IS NOT NULL",
    "t22_unescape_all": f"WITH {QA} SELECT pair_id, {_ENTITIES(_ENTITIES('a_text'))} AS plain FROM qa WHERE a_text IS NOT NULL",
    "s07_links": "SELECT DISTINCT post_id, url AS link FROM oppadu_posts WHERE url IS NOT NULL",
    "s12_jsonl_lenient": f"WITH {_P} SELECT * FROM p",
    "s13_jsonl_strict": f"WITH {_P} SELECT * FROM p",
    "s14_documents": f"WITH {_P} SELECT * FROM p",
    "s18_date_partitions": f"WITH {_P} SELECT strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day, count(*) AS n FROM (SELECT make_timestamp(CAST(floor(collected_at) AS BIGINT) * 1000000) AS d FROM p) GROUP BY 1, 2, 3",
    "s24_dead_letters": "SELECT CASE WHEN quality_score IS NULL THEN 'missing' WHEN isnan(quality_score) THEN 'not_a_number' ELSE 'out_of_range' END AS error_type, 'score' AS stage, count(*) AS n, count(*) AS payloads FROM reddit_collected WHERE quality_score IS NULL OR isnan(quality_score) OR quality_score < 0 OR quality_score > 10 GROUP BY 1",
    "s24_rejected_lines": "SELECT count(*) FILTER (WHERE json_valid(metadata)) AS good, count(*) FILTER (WHERE NOT json_valid(metadata)) AS bad FROM reddit_collected WHERE metadata IS NOT NULL AND trim(metadata) <> ''",
    "s25_append": f"WITH {_P} SELECT CAST(CAST(post_id AS BIGINT) % 2 AS INTEGER) AS part, count(*) AS n FROM p GROUP BY 1",
    "s26_file_counts": "SELECT count(*) AS rows FROM documents",
    "t09_html_code": f"WITH {QA} SELECT pair_id, regexp_extract(a_text, '=[A-Z]+\\([^()]*\\)') AS code FROM qa WHERE a_text IS NOT NULL",
    "t34_absolute": "SELECT DISTINCT post_id, 'https://oppadu.example' || regexp_replace(url, '^https?://[^/]+', '') AS url FROM oppadu_posts",
    "r06_idempotent_ingest": "SELECT count(DISTINCT id) AS rows, count(DISTINCT id) AS ids FROM usage_records",
    "r07_tumbling_stream": "WITH h AS (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1, 2), w AS (SELECT max(ts) - INTERVAL 1 HOUR AS w FROM events) SELECT event_type, count(*) AS hours, CAST(sum(n) AS BIGINT) AS n FROM h, w WHERE h + INTERVAL 1 HOUR <= w GROUP BY 1",
    "r07_sessions_stream": "WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS fresh FROM events), s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g), t AS (SELECT user_id, k, count(*) AS n, max(ts) + INTERVAL 30 MINUTE AS e FROM s GROUP BY 1, 2) SELECT count(*) AS sessions, CAST(sum(n) AS BIGINT) AS n FROM t WHERE e <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)",
    "r03_sync": "SELECT count(*) AS rows, count(DISTINCT event_id) AS ids FROM events",
}
