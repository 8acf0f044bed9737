"""Behaviour and style layers of bot detection at their full constants, fusion and decision.

Each rule is stated once (:mod:`gridwright.functions.dialects`) and run by both engines; gaps
between a user's answers and the similarity of all pairs of them are operators of their own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.functions.bot_rules import BOT, rules_risk
from gridwright.functions.dialects import BLANKS, DUCK, SPARK, Dialect, capped, num, when
from gridwright.operators.relational import previous_in_group
from gridwright.plans.common import QA, qa
from gridwright.plans.rule_plans import decision
from gridwright.session import table, written

c = F.col

# -- style --------------------------------------------------------------------------------
# fixed values: phrases of the style layer
HEDGING = ("perhaps", "maybe", "possibly", "might", "could", "would suggest", "it appears", "it seems", "one might", "you might consider")
FORMAL = ("however", "furthermore", "nevertheless", "therefore", "consequently", "additionally", "specifically", "particularly", "essentially")
ORDERLY = ("first", "second", "third", "finally", "in conclusion", "to summarize", "in summary", "let me explain", "here's how")
COURTESY = ("i hope this helps", "let me know if", "feel free to", "don't hesitate", "i'm here to help", "happy to assist", "please let me know")
MODEL = ("as an ai", "i am an ai", "i'm an ai", "artificial intelligence", "i don't have personal", "i cannot", "i'm not able to", "i don't have the ability", "i cannot access", "i'm not capable")
TEMPLATE = ("thank you for your question", "i'd be happy to help", "here's what i would recommend", "i hope this information helps", "let me provide you with", "based on your description")
STRUCTURED = ("first, let's", "next, we should", "finally, you can", "step 1:", "step 2:", "step 3:", "to begin with", "in summary", "to conclude", "in conclusion")
HEDGED = ("it appears that", "it seems like", "you might want to", "you could try", "perhaps you could", "one option would be", "another approach", "alternatively", "you might consider")
HUMAN = ("i had the same problem", "i've been struggling with", "this happened to me", "i remember when", "i think i", "if i recall correctly", "from my experience", "i usually", "damn", "wow", "oh no", "ugh", "lol", "haha", "omg")
TERMS = ("excel", "formula", "cell", "sheet", "workbook", "vlookup", "pivot")


def _where(d: Dialect, items: str, test: str) -> str:
    """How many items ``x`` of a list pass a test."""
    return f"size(filter({items}, x -> {test}))" if d.spark else f"len(list_filter({items}, lambda x: {test}))"


def style_parts(d: Dialect, text: str) -> dict[str, str]:
    """Marks of a text: keyword score, structure, consistency, signatures, human turns, list items."""
    low, gain = f"lower({text})", lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"
    sentences, words = d.parts(text, "[.!?]+"), d.words(text)
    marks = f"({d.count(low, HEDGING)} * {num(0.3)} + {d.count(low, FORMAL)} * {num(0.2)} + {d.count(low, ORDERLY)} * {num(0.3)} + {d.count(low, COURTESY)} * {num(0.2)}) / {words} * {num(100.0)}"
    capitals = _where(d, sentences, d.like("x", f"^[{BLANKS}]*" + r"\p{Lu}"))
    neat = gain(f"{d.size(sentences)} >= 2 AND {capitals} > {num(0.8)} * {d.size(sentences)}", 0.2)
    listed = gain(d.times(text, r"(?m)^[ \t]*(?:[0-9]+\.|[-*][ \t]+\S|[A-Za-z0-9_]+:[ \t]+\S)") + " >= 3", 0.15)
    said = _where(d, sentences, d.like("x", f"[^{BLANKS}]"))
    length = f"{_where(d, d.parts(text, f'[.!?{BLANKS}]+'), chr(120) + ' <> ' + chr(39) * 2)} > 20 * {said}"
    items = f"({d.times(text, r'(?m)^[ \t]*[-*•][ \t]')} + {d.times(text, r'(?m)^[ \t]*[0-9]+\.[ \t]')})"
    density = f"{d.times(text, '[*]')} > {num(0.1)} * greatest(length({text}), 1)"
    tokens = f"regexp_extract_all({low}, {d.text(r'[\p{L}\p{N}_]+')}{', 0' if d.spark else ''})"
    known = _where(d, tokens, "x IN (" + ", ".join(f"'{t}'" for t in TERMS) + ")")
    unique = d.size(f"array_distinct({tokens})" if d.spark else f"list_distinct({tokens})")
    return {
        "keywords": f"CASE WHEN {words} = 0 THEN {num(0.0)} ELSE least({num(1.0)}, {marks} + {neat} + {listed}) END",
        "structure": f"{gain(length, 0.2)} + {gain(items + ' > 2', 0.2)} + {gain(density, 0.1)}",
        "consistency": f"CASE WHEN {d.size(tokens)} < 10 THEN {num(0.5)} ELSE ({unique} + {known}) / CAST({d.size(tokens)} AS DOUBLE) / {num(2.0)} END",
        "model": d.count(low, MODEL), "template": d.count(low, TEMPLATE), "structured": d.count(low, STRUCTURED), "hedged": d.count(low, HEDGED), "human": d.count(low, HUMAN), "items": items,
    }


def style(d: Dialect, rows: str) -> str:
    """id, keywords, structure, consistency, probability and kind of rows (id, body not null)."""
    named = ", ".join(f"{x} AS {n}" for n, x in style_parts(d, "body").items())
    short = f"length(regexp_replace(body, {d.text(f'^[{BLANKS}]+|[{BLANKS}]+$')}, ''{'' if d.spark else ', ' + chr(39) + 'g' + chr(39)})) < 10"
    signatures = "model + template + structured + hedged"
    score = f"keywords * {num(0.4)} + structure * {num(0.2)} + {capped(f'({signatures}) * {num(0.15)}', 0.6)} * {num(0.2)} + consistency * {num(0.03)} - {capped(f'human * {num(0.2)}', 0.4)} * {num(0.1)}"
    probability = f"CASE WHEN {short} THEN {num(0.0)} ELSE greatest({num(0.0)}, least({num(1.0)}, {score})) END"
    kind = when((f"probability < {num(0.5)}", "'human_authored'"), ("model > 0", "'gpt_generated'"), ("template > 0", "'template_ai'"), ("structured > 0 AND items > 2", "'sophisticated_ai'"), other="'hybrid_ai'")
    inner = f"SELECT *, {probability} AS probability FROM (SELECT id, body, {named} FROM ({rows}) r) p"
    return f"SELECT id, {d.round('keywords')} AS keywords, {d.round('structure')} AS structure, {d.round('consistency')} AS consistency, {d.round('probability')} AS probability, {kind} AS kind FROM ({inner}) s"


# -- behaviour ----------------------------------------------------------------------------
WEIGHTS = {"quality": 0.20, "timing": 0.18, "similarity": 0.15, "frequency": 0.12, "response": 0.12, "engagement": 0.10, "complexity": 0.08, "age": 0.05}
PUNCTUATION = tuple(".,!?;:()[]{}-")
_USERS = "SELECT author, pair_id, coalesce(a_text, '') AS body, CAST(coalesce(a_score, 0) AS DOUBLE) AS score, CAST(floor(collected_at) AS BIGINT) AS at_ FROM {rows} WHERE author IS NOT NULL"


def behaviour(d: Dialect, rows: str, gaps: str, alike: str) -> str:
    """The eight metrics of each author, from answers, gaps between them (author, gap) and the
    similarity of all pairs of them (author, similarity).

    A contributor quality that isn't known is medium; an account is as old as the author's
    first answer is at the newest answer of all.
    """
    gain = lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"
    each = "explode" if d.spark else "unnest"
    users = _USERS.format(rows=rows)
    trim = f"regexp_replace(body, {d.text(f'^[{BLANKS}]+|[{BLANKS}]+$')}, ''{'' if d.spark else ', ' + chr(39) + 'g' + chr(39)})"
    quotes = d.has("body", '"') if not d.spark else "contains(body, '\"')"
    kinds = " + ".join([f"max(CAST({d.has('body', p)} AS INT))" for p in PUNCTUATION] + [f"max(CAST({quotes} AS INT))"])
    texts = f"SELECT author, {trim} AS body FROM ({users}) u"
    long = f"SELECT author, body FROM ({texts}) x WHERE length(body) > 10"
    tidy = f"regexp_replace(lower(w), {d.text(r'[^\p{L}\p{N}_]')}, ''{'' if d.spark else ', ' + chr(39) + 'g' + chr(39)})"
    split = lambda pattern: d.parts("body", pattern)
    words = f"SELECT author, {tidy} AS w FROM (SELECT author, {each}({split(f'[{BLANKS}]+')}) AS w FROM ({long}) l1) e1"
    parts = f"SELECT author, {d.words('s')} AS n FROM (SELECT author, {each}({split('[.!?]+')}) AS s FROM ({long}) l2) e2"
    tables = {
        "base": f"SELECT author, count(*) AS n, count(at_) AS stamps, min(at_) AS first_, avg(score) AS mean_score, count(CASE WHEN body <> '' THEN 1 END) AS texts, avg(CASE WHEN body <> '' THEN length(body) END) AS size_mean, stddev_samp(CASE WHEN body <> '' THEN length(body) END) AS size_sd FROM ({users}) u GROUP BY author",
        "newest": f"SELECT max(at_) AS last_ FROM ({users}) u",
        "gap": f"SELECT author, count(gap) AS gaps, avg(gap) AS gap_mean, stddev_samp(gap) AS gap_sd FROM {gaps} GROUP BY author",
        "hour": f"SELECT author, max(k) AS busiest, avg(k) AS usual FROM (SELECT author, floor(at_ / 3600e0) AS h, count(*) AS k FROM ({users}) u WHERE at_ IS NOT NULL GROUP BY author, floor(at_ / 3600e0)) g GROUP BY author",
        "word": f"SELECT author, count(DISTINCT CASE WHEN w <> '' THEN w END) AS vocabulary FROM ({words}) w GROUP BY author",
        "sentence": f"SELECT author, stddev_samp(n) AS variety FROM ({parts}) p WHERE n > 0 GROUP BY author",
        "mark": f"SELECT author, sum(length(body)) AS letters, sum({d.words('body')}) AS words_, {kinds} AS marks FROM ({long}) l GROUP BY author",
    }
    joined = "base" + "".join(f" LEFT JOIN {t} USING (author)" for t in ("gap", "hour", "word", "sentence", "mark")) + f" LEFT JOIN {alike} al USING (author)"
    timing = when(("n < 3 OR coalesce(gaps, 0) < 2", num(0.0)), ("gap_mean = 0", num(1.0)), (f"gap_sd / gap_mean < {num(0.1)}", num(0.9)), (f"gap_sd / gap_mean < {num(0.3)}", num(0.7)), (f"gap_sd / gap_mean < {num(0.5)}", num(0.4)), other=num(0.1))
    frequency = when(("n < 2 OR busiest IS NULL", num(0.0)), ("busiest > 20", num(0.9)), ("busiest > 10", num(0.7)), ("usual > 5", num(0.6)), other=num(0.1))
    sizes = when((f"size_sd / size_mean < {num(0.2)}", num(0.4)), (f"size_sd / size_mean < {num(0.5)}", num(0.2)), other=num(0.0))
    response = f"CASE WHEN n < 3 OR texts = 0 THEN {num(0.0)} ELSE least({num(1.0)}, {sizes} + {gain('texts > 1', 0.5)}) END"
    engagement = f"CASE WHEN n < 2 THEN {num(0.0)} ELSE {gain('mean_score < 1 AND n > 5', 0.3)} + {num(0.3)} END"
    rate = f"CAST(vocabulary AS DOUBLE) / words_"
    complexity = f"CASE WHEN n < 2 OR coalesce(words_, 0) = 0 THEN {num(0.0)} ELSE {gain(f'CAST(letters AS DOUBLE) / words_ < {num(3.5)} OR CAST(letters AS DOUBLE) / words_ > {num(7.5)}', 0.2)} + {gain(f'{rate} < {num(0.4)} OR {rate} > {num(0.9)}', 0.3)} + {gain('marks < 2 OR marks > 10', 0.2)} + {gain('coalesce(variety, 0) < 2 OR variety > 30', 0.3)} END"
    days = "floor(((SELECT last_ FROM newest) - first_) / 86400e0)"
    age = when((f"coalesce({days}, 0) < 1", num(0.8)), (f"{days} < 7", num(0.6)), (f"{days} < 30", num(0.3)), other=num(0.1))
    metrics = {"quality": num(0.4), "timing": timing, "similarity": f"coalesce(al.similarity, {num(0.0)})", "frequency": frequency, "response": response, "engagement": engagement, "complexity": complexity, "age": age}
    total = " + ".join(f"{n} * {num(w)}" for n, w in WEIGHTS.items())
    kind = when((f"timing > {num(0.8)}", "'scheduled_bot'"), (f"similarity > {num(0.8)}", "'content_scraper_bot'"), (f"frequency > {num(0.8)}", "'spam_farm_bot'"), (f"engagement > {num(0.7)}", "'engagement_bot'"), (f"complexity > {num(0.7)}", "'sophisticated_ai_bot'"), other="'human'")
    ctes = ", ".join(f"{n} AS ({q})" for n, q in tables.items())
    inner = f"WITH {ctes} SELECT author, n, {', '.join(f'{d.round(x)} AS {m}' for m, x in metrics.items())} FROM {joined}"
    return f"SELECT author, n, {', '.join(metrics)}, {d.round(total)} AS confidence, {total} >= {num(BOT)} AS is_bot, {kind} AS kind FROM ({inner}) m"


def _behaviour(spark, sf):
    from gridwright.plans.qa_plans import j10_user_similarity

    rows = qa(spark, sf)
    stamps = rows.filter("author is not null and collected_at is not null").select("author", F.floor("collected_at").cast("bigint").alias("at_"))
    # by blocks of thirty days, so that the gaps of an author with a tenth of all answers are found in many tasks
    gaps = previous_in_group(stamps, "author", "at_", "before", 2_592_000).select("author", (c("at_") - c("before")).alias("gap"))
    alike = j10_user_similarity(spark, sf).select("author", c("score").alias("similarity"))
    text = behaviour(SPARK, "\0", "\1", "\2").replace("{", "{{").replace("}", "}}").replace("\0", "{rows}").replace("\1", "{gaps}").replace("\2", "{alike}")
    return written(spark.sql(text, rows=rows, gaps=gaps, alike=alike), "behaviour")


# -- queries ------------------------------------------------------------------------------
def c46_behaviour(spark, sf):
    """The weighted sum of the eight metrics, and the verdict."""
    return _behaviour(spark, sf).select("author", "n", "confidence", "is_bot")


def c47_age_risk(spark, sf):
    return _behaviour(spark, sf).select("author", "quality", "age")


def c48_response_risk(spark, sf):
    return _behaviour(spark, sf).select("author", "timing", "frequency", "response")


def c49_engagement(spark, sf):
    return _behaviour(spark, sf).select("author", "engagement")


def c50_language_complexity(spark, sf):
    return _behaviour(spark, sf).select("author", "complexity", "similarity")


def c51_behaviour_kind(spark, sf):
    """The first metric that is high names the kind."""
    return _behaviour(spark, sf).select("author", "kind")


def _styled(spark, sf):
    return spark.sql(style(SPARK, "\0").replace("{", "{{").replace("}", "}}").replace("\0", "SELECT doc_id AS id, coalesce(text, '') AS body FROM {rows}"), rows=table(spark, sf, "documents"))


def c52_keywords(spark, sf):
    return _styled(spark, sf).select("id", "keywords")


def c53_consistency(spark, sf):
    return _styled(spark, sf).select("id", "structure", "consistency")


def c54_style(spark, sf):
    return _styled(spark, sf).select("id", "probability", (c("probability") >= 0.5).alias("generated"))


def c55_types(spark, sf):
    return _styled(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def _layers(spark, sf):
    rows = qa(spark, sf)
    body = "coalesce(a_text, '')"
    rules = rows.select(c("pair_id").alias("id"), "author", F.expr(rules_risk(SPARK, body, "author")).alias("l1"))
    styles = spark.sql(style(SPARK, "\0").replace("{", "{{").replace("}", "}}").replace("\0", "SELECT pair_id AS id, a_text AS body FROM {rows} WHERE length(a_text) > 50"), rows=rows).select("id", c("probability").alias("l3"))
    users = _behaviour(spark, sf).filter("n >= 2").select("author", c("confidence").alias("l2"))
    # an author's behaviour is one row; the join's hot author is split by AQE
    return rules.join(users, "author", "left").join(styles, "id", "left").select("id", "l1", "l2", "l3")


def _fused(d: Dialect, layers: str) -> str:
    """Rules and behaviour: .6 and .4, .8 and .2 where the rules are sure, .4 and .6 where behaviour is."""
    score = when(("l2 IS NULL", "l1"), (f"l1 > {num(0.9)}", f"{num(0.8)} * l1 + {num(0.2)} * l2"), (f"l2 > {num(0.9)}", f"{num(0.4)} * l1 + {num(0.6)} * l2"), other=f"{num(0.6)} * l1 + {num(0.4)} * l2")
    return f"SELECT id, round({score}, 6) AS score, round({score}, 6) >= {num(BOT)} AS is_bot FROM ({layers}) f"


def _decided(spark, sf, statement):
    return spark.sql(statement(SPARK, "SELECT * FROM \0").replace("{", "{{").replace("}", "}}").replace("\0", "{rows}"), rows=_layers(spark, sf))


def c56_fusion(spark, sf):
    return _decided(spark, sf, _fused)


def c58_layers(spark, sf):
    """Layers that an answer's text and its author's history allow."""
    return _layers(spark, sf).select("id", F.array_join(F.array_compact(F.array(F.lit("rules"), F.when(c("l2").isNotNull(), "behaviour"), F.when(c("l3").isNotNull(), "style"))), ",").alias("layers"))


def c59_consensus(spark, sf):
    """Weighted mean over the layers that are there."""
    return _decided(spark, sf, decision).select("id", "consensus", "primary_layer")


def c60_decision(spark, sf):
    return _decided(spark, sf, decision).select("id", "is_bot", "detection")


def c61_decision(spark, sf):
    return _decided(spark, sf, decision).select("id", "risk", "recommendation")


QUERIES = {f.__name__: f for f in (c46_behaviour, c47_age_risk, c48_response_risk, c49_engagement, c50_language_complexity, c51_behaviour_kind, c52_keywords, c53_consistency, c54_style, c55_types, c56_fusion, c58_layers, c59_consensus, c60_decision, c61_decision)}

_GAPS = "gaps AS (SELECT author, at_ - lag(at_) OVER (PARTITION BY author ORDER BY at_) AS gap FROM (SELECT author, CAST(floor(collected_at) AS BIGINT) AS at_ FROM qa WHERE author IS NOT NULL AND collected_at IS NOT NULL))"
_SAID = r"lower(regexp_replace(CASE WHEN regexp_matches(a_text, '[^\s\x{a0}\x{3000}]') THEN a_text ELSE a_md END, '^[\s\x{a0}\x{2000}-\x{200a}\x{3000}]+|[\s\x{a0}\x{2000}-\x{200a}\x{3000}]+$', '', 'g'))"
_ALIKE = rf"""tri AS (SELECT author, pair_id, list_distinct(list_transform(range(1, greatest(length(s) - 1, 1)), lambda i: substr(s, i, 3))) AS g FROM (SELECT author, pair_id, regexp_replace(t, '[^\p{{L}}\p{{N}}_\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}]', '', 'g') AS s FROM (SELECT author, pair_id, {_SAID} AS t FROM qa WHERE author IS NOT NULL) WHERE length(t) > 10)),
alike AS (SELECT author, round(0.6e0 * avg(j) + 0.4e0 * max(j), 6) AS similarity FROM (SELECT x.author, CASE WHEN len(x.g) = 0 OR len(y.g) = 0 THEN 0e0 ELSE len(list_intersect(x.g, y.g)) / CAST(len(list_distinct(list_concat(x.g, y.g))) AS DOUBLE) END AS j FROM tri x JOIN tri y ON x.author = y.author AND x.pair_id < y.pair_id) GROUP BY author)"""
_W = "WITH " + QA
_B = f"{_W}, {_GAPS}, {_ALIKE}, b AS ({behaviour(DUCK, 'qa', 'gaps', 'alike')})"
_S = style(DUCK, "SELECT doc_id AS id, coalesce(text, '') AS body FROM documents")
_L = f"{_B}, y AS ({style(DUCK, 'SELECT pair_id AS id, a_text AS body FROM qa WHERE length(a_text) > 50')}), l AS (SELECT pair_id AS id, {rules_risk(DUCK, 'coalesce(a_text, ' + chr(39) * 2 + ')', 'author')} AS l1, CASE WHEN b.n >= 2 THEN b.confidence END AS l2, y.probability AS l3 FROM qa LEFT JOIN b USING (author) LEFT JOIN y ON y.id = pair_id)"
_D = decision(DUCK, "SELECT * FROM l")
ORACLES = {
    "c46_behaviour": f"{_B} SELECT author, n, confidence, is_bot FROM b",
    "c47_age_risk": f"{_B} SELECT author, quality, age FROM b",
    "c48_response_risk": f"{_B} SELECT author, timing, frequency, response FROM b",
    "c49_engagement": f"{_B} SELECT author, engagement FROM b",
    "c50_language_complexity": f"{_B} SELECT author, complexity, similarity FROM b",
    "c51_behaviour_kind": f"{_B} SELECT author, kind FROM b",
    "c52_keywords": f"SELECT id, keywords FROM ({_S})",
    "c53_consistency": f"SELECT id, structure, consistency FROM ({_S})",
    "c54_style": f"SELECT id, probability, probability >= 0.5 AS generated FROM ({_S})",
    "c55_types": f"SELECT kind, count(*) AS n FROM ({_S}) GROUP BY 1",
    "c56_fusion": f"{_L} {_fused(DUCK, 'SELECT * FROM l')}",
    "c58_layers": f"{_L} SELECT id, concat_ws(',', 'rules', CASE WHEN l2 IS NOT NULL THEN 'behaviour' END, CASE WHEN l3 IS NOT NULL THEN 'style' END) AS layers FROM l",
    "c59_consensus": f"{_L} SELECT id, consensus, primary_layer FROM ({_D})",
    "c60_decision": f"{_L} SELECT id, is_bot, detection FROM ({_D})",
    "c61_decision": f"{_L} SELECT id, risk, recommendation FROM ({_D})",
}
