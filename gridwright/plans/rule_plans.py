"""Quality scores and the rule layer of bot detection, at their full constants.

Each rule is stated once (:mod:`gridwright.functions.dialects`) and run by both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from gridwright.functions.bot_rules import AUTOMATIC, BOT, GENERIC, MODERATOR, SPAM, TEMPLATES, content_risk, context_risk, structure_risk, username_risk
from gridwright.functions.dialects import DUCK, SPARK, Dialect, best, capped, num, when
from gridwright.operators.relational import min_max
from gridwright.plans.common import QA, qa
from gridwright.session import table

c = F.col

# -- Korean posts -------------------------------------------------------------------------
# fixed values: vocabularies of the Korean score
FUNCTIONS = ("합계", "SUM", "평균", "AVERAGE", "개수", "COUNT", "최대값", "MAX", "최소값", "MIN", "조건부합계", "SUMIF", "조건부개수", "COUNTIF", "검색", "VLOOKUP", "HLOOKUP", "만약", "IF", "그리고", "AND", "또는", "OR", "아니면", "NOT", "찾기", "FIND", "바꾸기", "SUBSTITUTE", "연결", "CONCATENATE", "날짜", "DATE", "오늘", "TODAY", "지금", "NOW", "년", "YEAR", "월", "MONTH", "일", "DAY", "반올림", "ROUND", "올림", "ROUNDUP", "내림", "ROUNDDOWN", "절대값", "ABS", "제곱근", "SQRT", "거듭제곱", "POWER")
BUSINESS = ("세무", "세금", "부가세", "VAT", "소득세", "법인세", "원천세", "회계", "장부", "분개", "대차대조표", "손익계산서", "현금흐름표", "급여", "인사", "근태", "연차", "퇴직금", "4대보험", "매출", "매입", "재고", "자산", "부채", "자본", "예산", "결산", "감가상각", "대손충당금", "사업자등록번호", "주민등록번호", "법인번호")
FEATURES = ("한글정렬", "음성정렬", "초성검색", "한자변환", "원화표시", "천단위구분", "음수표시", "한글숫자", "한자숫자", "대소문자변환", "공휴일", "영업일", "근무일")
DETAIL = ("예를 들어", "구체적으로", "단계별로", "방법은", "순서는")
FORMATS = ("원", "₩", "yyyy-mm-dd", "yyyy.mm.dd", "yy/mm/dd")
VERSIONS = ("한국어", "한글", "KOR", "2016", "2019", "2021", "365")
ADVANCED = ("피벗테이블", "피벗", "매크로", "VBA", "파워쿼리", "파워피벗", "조건부서식", "데이터유효성", "시나리오", "목표값찾기")
FORMULAS = (r"(?i)=\w+\(.*\)", r"(?i)IF\s*\(", r"(?i)VLOOKUP\s*\(", r"(?i)INDEX\s*\(.*MATCH")
PRACTICAL = ("업무", "회사", "직장", "실무", "현업", "보고서", "양식", "템플릿", "자동화", "효율", "단축키", "빠르게")
STEPS = ("1단계", "2단계", "첫째", "둘째", "먼저", "다음에", "마지막으로")
ALTERNATIVES = ("또는", "다른방법", "대신", "아니면", "방법1", "방법2")
GRATITUDE = ("감사", "고맙", "도움", "해결", "완료")
DOMAINS = {"accounting": ("회계", "장부", "분개", "결산", "세무"), "hr": ("인사", "급여", "근태", "연차", "퇴직"), "sales": ("매출", "영업", "고객", "거래"), "finance": ("재무", "자금", "투자", "예산", "현금"), "inventory": ("재고", "창고", "입출고", "물류")}
KOREAN_WEIGHTS = {"content": 0.25, "korean": 0.20, "expertise": 0.25, "practical": 0.20, "complete": 0.10}


def korean_parts(d: Dialect) -> dict[str, str]:
    """The five parts of a Korean post's score from columns q, a (texts, not null), both (the two
    joined by a blank), version, code and image."""
    steps = lambda col, marks, gain: " + ".join(f"CASE WHEN {d.words(col)} >= {m} THEN {num(gain)} ELSE {num(0.0)} END" for m in marks)
    gain = lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"
    share = lambda words, each, most: capped(f"{d.count('both_', words)} * {num(each)}", most)
    base = num(5.0)
    return {
        "content": capped(f"{base} + {steps('q', (8, 15), 0.5)} + {steps('a', (10, 25), 1.0)} + {d.count('both_', DETAIL)} * {num(0.3)}", 10),
        "korean": capped(f"{base} + {share(BUSINESS, 0.5, 2.0)} + {share(FEATURES, 0.7, 2.0)} + {gain(d.any('version', VERSIONS), 0.5)} + {share(FORMATS, 0.3, 1.0)}", 10),
        "expertise": capped(f"{base} + {share(FUNCTIONS, 0.4, 3.0)} + {gain('code', 1.5)} + {share(ADVANCED, 0.8, 2.0)} + {capped(d.count_like('both_', FORMULAS) + ' * ' + num(0.6), 2.0)}", 10),
        "practical": capped(f"{base} + {share(PRACTICAL, 0.4, 2.0)} + {gain('image', 1.5)} + {share(STEPS, 0.3, 1.5)} + {share(ALTERNATIVES, 0.4, 1.0)}", 10),
        "complete": capped(f"{base} + {steps('q', (10,), 1.0)} + {steps('a', (15,), 1.5)} + {gain(version_known(), 0.5)} + {gain(d.any('both_', GRATITUDE), 0.5)}", 10),
    }


def version_known() -> str:
    return "version <> ''"


def korean_context(d: Dialect) -> dict[str, str]:
    """Flags, business domain (the first in order) and level of a Korean post."""
    advanced = d.any_like("both_", (r"(?i)INDEX\s*\(.*MATCH", "(?i)SUMPRODUCT", "(?i)ARRAY", "피벗테이블", "매크로", "(?i)VBA", "파워쿼리"))
    return {
        "business_terms": d.any("both_", BUSINESS), "functions": d.any("both_", FUNCTIONS), "formats": d.any("both_", ("원", "₩", "yyyy-mm-dd")),
        "domain": when(*[(d.any("both_", words), f"'{name}'") for name, words in DOMAINS.items()], other="'general'"),
        "level": when((advanced, "'advanced'"), (d.any("both_", ("VLOOKUP", "HLOOKUP", "IF", "SUMIF", "COUNTIF")), "'intermediate'"), other="'beginner'"),
    }


#: The post's texts: title and body as question, workbook year as version, code and images by form.
_KOREAN = (
    "SELECT pair_id, coalesce(q_text, '') AS q, coalesce(a_text, '') AS a, concat(coalesce(q_text, ''), ' ', coalesce(a_text, '')) AS both_, coalesce({version}, '') AS version, "
    "{code} AS code, {image} AS image FROM {rows} WHERE source = 'oppadu'"
)
CODE_FORMS, IMAGE_FORMS = (r"```", r"`[^`\n]+`", r"(?i)<code>|<pre>", r"=[A-Z]+\("), (r"!\[[^\]]*\]\(", r"(?i)<img\b")


def korean_rows(d: Dialect, rows: str) -> str:
    version = 'regexp_extract(title, r"_(20[0-9][0-9])[.]xlsx", 1)' if d.spark else "regexp_extract(title, '_(20[0-9][0-9])[.]xlsx', 1)"
    return _KOREAN.format(version=version, code=d.any_like("coalesce(a_text, '')", CODE_FORMS), image=d.any_like("coalesce(a_md, '')", IMAGE_FORMS), rows=rows)


def korean_score(d: Dialect, rows: str) -> str:
    parts = korean_parts(d)
    named = ", ".join(f"{x} AS {name}" for name, x in parts.items())
    overall = " + ".join(f"{name} * {num(w)}" for name, w in KOREAN_WEIGHTS.items())
    tier = when(("overall >= 8.5", "'excellent'"), ("overall >= 7.0", "'good'"), ("overall >= 5.5", "'medium'"), other="'low'")
    scored = f"SELECT *, {overall} AS overall FROM (SELECT pair_id, {named} FROM ({korean_rows(d, rows)}) k) p"
    return f"SELECT pair_id, {', '.join(f'round({n}, 6) AS {n}' for n in parts)}, round(overall, 4) AS overall, {tier} AS tier FROM ({scored}) s"


def korean_contexts(d: Dialect, rows: str) -> str:
    return f"SELECT pair_id, {', '.join(f'{x} AS {name}' for name, x in korean_context(d).items())} FROM ({korean_rows(d, rows)}) k"


# -- forum pairs --------------------------------------------------------------------------
QUESTION_WORDS, ANSWER_WORDS = ("how", "what", "why", "help", "error", "issue"), ("=", "formula", "try", "use", "solution")


def simple_forum(d: Dialect, rows: str) -> str:
    """The simple forum score with its threshold and reason, from texts trimmed at both ends."""
    trim = lambda x: f"regexp_replace(coalesce({x}, ''), {d.text(r'^\\s+|\\s+$')}, ''{'' if d.spark else ', ' + chr(39) + 'g' + chr(39)})"
    gain = lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"

    def score(x: str, extra: str) -> str:
        size = when((f"length({x}) >= 200", num(2.0)), (f"length({x}) >= 100", num(1.0)), (f"length({x}) < 10", num(-2.0)), other=num(0.0))
        sheet = gain(f"{d.has(x, '=')} OR {d.has(f'upper({x})', 'VLOOKUP')} OR {d.has(f'upper({x})', 'SUMIF')}", 1.0)
        return f"CASE WHEN {x} = '' THEN {num(0.0)} ELSE greatest({num(0.0)}, least({num(10.0)}, {num(5.0)} + {size} + {extra} + {sheet})) END"

    question = score("q", f"{gain(d.has('q', '?'), 1.0)} + {gain(d.any('lower(q)', QUESTION_WORDS), 0.5)}")
    answer = score("a", f"{gain(d.any('lower(a)', ANSWER_WORDS), 1.0)} + {gain('length(a) > 50', 0.5)}")
    scored = f"SELECT pair_id, q, a, {question} AS qs, {answer} AS ans FROM (SELECT pair_id, {trim('q_text')} AS q, {trim('a_text')} AS a FROM {rows}) t"
    reason = when(("q = ''", "'empty question'"), ("a = ''", "'empty answer'"), ("length(q) < 10", "'question too short'"), ("length(a) < 10", "'answer too short'"), ("overall >= 7", "'high quality'"), ("overall >= 5", "'sound'"), ("overall >= 3", "'basic quality'"), other="'below the threshold'")
    return f"SELECT pair_id, overall, length(q) >= 10 AND length(a) >= 10 AND overall >= 3 AS meets, {reason} AS reason FROM (SELECT pair_id, q, a, round(qs * {num(0.4)} + ans * {num(0.6)}, 6) AS overall FROM ({scored}) s) o"


def forum_raw(d: Dialect, rows: str) -> str:
    """Submission, answer and bonus scores of forum pairs: a submission's score counts at the ratio
    of .5 that stands for an unknown one; confirmed 10, marked solved 5, code 3, image 2."""
    gain = lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"
    bonus = f"{gain('op_confirmed', 10.0)} + {gain(d.has('lower(title)', 'solved'), 5.0)} + {gain(d.any_like(chr(99) + 'oalesce(a_text, ' + chr(39) * 2 + ')', CODE_FORMS), 3.0)} + {gain(d.any_like('coalesce(a_md, ' + chr(39) * 2 + ')', IMAGE_FORMS), 2.0)}"
    return f"SELECT pair_id, source, coalesce(q_score, 0) * {num(0.5)} AS s, CAST(coalesce(a_score, 0) AS DOUBLE) AS a, {bonus} AS b FROM {rows} WHERE source = 'reddit'"


_FORUM_TIER = when(("score >= 9", "'excellent'"), ("score >= 7.5", "'good'"), ("score >= 6.5", "'fair'"), other="'poor'")

# -- the rule layer of bot detection ------------------------------------------------------
LAYER_WEIGHTS = {"layer1": 0.35, "layer2": 0.25, "layer3": 0.20, "layer4": 0.20}
def rule_layer(d: Dialect, rows: str) -> str:
    """name columns of ``rows`` (id, author, body not null), each sub-check's risk, the layer's
    confidence (the greatest sub-check of .7 or more), verdict and type."""
    checks = {"username": username_risk(d), "content": content_risk(d), "structure": structure_risk(d), "context": context_risk(d)}
    over = best(*[f"CASE WHEN {n} >= {BOT} THEN {n} ELSE {num(0.0)} END" for n in checks])
    low = "lower(body)"
    moderator = f"content >= {BOT} AND ({d.any(low, [w.lower() for w in MODERATOR])} OR {d.has(low, 'thank you for your submission')}) OR username >= {BOT} AND {d.has('lower(author)', 'moderator')}"
    spam = f"content >= {BOT} AND {d.any_like('body', SPAM)}"
    automatic = f"content >= {BOT} AND ({d.any(low, [w.lower() for w in AUTOMATIC])} OR {d.any_like('body', TEMPLATES)}) OR context >= {BOT} AND {d.count(low, GENERIC)} > 2 OR username >= {BOT} AND {d.like('lower(author)', '^(user|reddit|anonymous)[0-9]+$')}"
    kind = when((f"confidence < {BOT}", "'human'"), (moderator, "'moderator_bot'"), (spam, "'spam_bot'"), (automatic, "'auto_response_bot'"), other="'sophisticated_bot'")
    inner = f"SELECT *, {over} AS confidence FROM (SELECT id, author, body, {', '.join(f'{x} AS {n}' for n, x in checks.items())} FROM ({rows}) r) c"
    return f"SELECT id, {', '.join(checks)}, confidence, confidence >= {BOT} AS is_bot, {kind} AS kind FROM ({inner}) l"


_ANSWERS = "SELECT pair_id AS id, author, coalesce(a_text, '') AS body FROM {rows}"

# fixed values: comments with the verdict that a detector must give, and the kind of bot
CASES = (
    ("moderator", "AutoModerator", "Your post was submitted successfully. Please follow the submission rules. I am a bot, and this action was performed automatically.", True, "moderator_bot"),
    ("automatic", "someone", "Thank you for reading. This is an automated response. If you need further assistance, refer to the manual.", True, "auto_response_bot"),
    ("spam", "dealer", "Click here for a special offer on spreadsheets, limited time only", True, "spam_bot"),
    ("assistant", "quiet", "I hope this helps. I'd be happy to help with the formula. I'm here to help with any cell.", True, "sophisticated_bot"),
    ("numbered", "Zed48213", "Use a pivot table on the second sheet, that is quicker.", True, "sophisticated_bot"),
    ("human", "carla", "I had the same thing, the range in my formula was one row short.", False, "human"),
    ("expert", "ExcelHelp", "Try =SUMIF(A:A, B1, C:C), then copy it down the column.", False, "human"),
    ("deleted", "[deleted]", "Works with INDEX and MATCH, thanks!", False, "human"),
)


def _values(d: Dialect) -> str:
    rows = ", ".join(f"({d.text(n)}, {d.text(a)}, {d.text(b)})" for n, a, b, _, _ in CASES)
    return f"SELECT id, author, body FROM (VALUES {rows}) AS v(id, author, body)"


def decision(d: Dialect, layers: str) -> str:
    """Strategy, weighted consensus, verdict, risk and recommendation from rows id, l1, l2, l3 (a
    layer's confidence; null where the strategy leaves it out); a layer votes at its threshold."""
    names = {"l1": (LAYER_WEIGHTS["layer1"], BOT), "l2": (LAYER_WEIGHTS["layer2"], 0.6), "l3": (LAYER_WEIGHTS["layer3"], 0.5)}
    weight = " + ".join(f"CASE WHEN {n} IS NOT NULL THEN {num(w)} ELSE {num(0.0)} END" for n, (w, _) in names.items())
    total = " + ".join(f"coalesce({n}, {num(0.0)}) * {num(w)}" for n, (w, _) in names.items())
    votes = " + ".join(f"CASE WHEN {n} >= {num(t)} THEN {num(w)} ELSE {num(0.0)} END" for n, (w, t) in names.items())
    first = when(*[(f"coalesce({n}, {num(0.0)}) >= {num(0.95)}", f"'{n}'") for n in names], other="'consensus'")
    inner = f"SELECT id, l1, l2, l3, {d.round(f'({total}) / ({weight})')} AS consensus, {votes} AS bots, {weight} AS whole, {first} AS primary_layer FROM ({layers}) l"
    confidence = when(("primary_layer = 'l1'", "l1"), ("primary_layer = 'l2'", "l2"), ("primary_layer = 'l3'", "l3"), other="consensus")
    middle = f"SELECT *, {confidence} AS confidence, primary_layer <> 'consensus' OR bots > whole - bots AS is_bot FROM ({inner}) i"
    kind = when(("primary_layer <> 'consensus'", "'instant_block'"), ("consensus >= 0.85 AND is_bot", "'consensus_block'"), ("consensus >= 0.85", "'human_verified'"), ("consensus >= 0.7 AND is_bot", "'behavioral_block'"), ("consensus >= 0.7", "'human_likely'"), other="'uncertain'")
    risk = when(("primary_layer <> 'consensus'", "'critical'"), ("confidence >= 0.9", "'high'"), ("confidence >= 0.7", "'medium'"), ("confidence >= 0.5", "'low'"), other="'minimal'")
    advice = when(("is_bot AND confidence >= 0.9", "'block'"), ("is_bot AND confidence >= 0.7", "'review'"), ("is_bot", "'monitor'"), other="'allow'")
    return f"SELECT id, consensus, primary_layer, is_bot, {kind} AS detection, {risk} AS risk, {advice} AS recommendation FROM ({middle}) m"


# -- queries ------------------------------------------------------------------------------
def _on(spark, df, statement: Callable[[Dialect, str], str]):
    """Run a statement over a table, given to it as an argument of the query, not as a view."""
    text = statement(SPARK, "\0").replace("{", "{{").replace("}", "}}").replace("\0", "{rows}")
    return spark.sql(text, rows=df)


def c08_korean_score(spark, sf):
    return _on(spark, qa(spark, sf), korean_score)


def c09_korean_context(spark, sf):
    return _on(spark, qa(spark, sf), korean_contexts)


def c05_forum_simple(spark, sf):
    return _on(spark, qa(spark, sf), simple_forum)


def c06_reason(spark, sf):
    """Why a pair passes the simple forum threshold or doesn't."""
    return c05_forum_simple(spark, sf).select("pair_id", "reason")


def c07_forum_score(spark, sf):
    """Weights .3, .4 and .3 on parts normalised over the batch."""
    n = min_max(_on(spark, qa(spark, sf), forum_raw), ["s", "a", "b"], ["source"])
    scored = n.select("pair_id", F.round(10 * (0.3 * c("s_norm") + 0.4 * c("a_norm") + 0.3 * c("b_norm")), 6).alias("score"))
    return scored.select("pair_id", "score", (c("score") >= 1.0).alias("meets"), F.expr(_FORUM_TIER).alias("tier"))


def c40_rule_layer(spark, sf):
    return _on(spark, qa(spark, sf), lambda d, rows: rule_layer(d, _ANSWERS.format(rows=rows)))


def c45_cases(spark, sf):
    """Verdict and kind of the fixed cases."""
    return spark.sql(rule_layer(SPARK, _values(SPARK))).select("id", "is_bot", "kind")


def _priority(d: Dialect, rows: str) -> str:
    """Which layers a pair's text and history call for, and how urgent it is."""
    low = "lower(coalesce(a_text, ''))"
    urgent = when((d.any(low, ("automoderator", "i am a bot", "performed automatically")), "'critical'"), ("length(a_text) > 500", "'high'"), ("length(coalesce(a_text, '')) < 50", "'low'"), other="'medium'")
    return f"SELECT pair_id, {urgent} AS priority, coalesce(length(a_text) > 50, false) AS style_layer FROM {rows}"


def c57_priority(spark, sf):
    return _on(spark, qa(spark, sf), _priority)


_W = "WITH " + QA
QUERIES = {f.__name__: f for f in (c05_forum_simple, c06_reason, c07_forum_score, c08_korean_score, c09_korean_context, c40_rule_layer, c45_cases, c57_priority)}


def _oracles() -> dict[str, str]:
    norm = lambda x: f"CASE WHEN count(*) OVER () <= 1 OR max({x}) OVER () = min({x}) OVER () THEN 1.0e0 ELSE ({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) END"
    cases = " UNION ALL ".join(f"SELECT '{n}' AS id, {str(v).lower()} AS is_bot, '{k}' AS kind" for n, _, _, v, k in CASES)
    return {
        "c05_forum_simple": f"{_W} {simple_forum(DUCK, 'qa')}",
        "c06_reason": f"{_W} SELECT pair_id, reason FROM ({simple_forum(DUCK, 'qa')})",
        "c07_forum_score": f"{_W}, n AS (SELECT pair_id, round(10 * (0.3e0 * {norm('s')} + 0.4e0 * {norm('a')} + 0.3e0 * {norm('b')}), 6) AS score FROM ({forum_raw(DUCK, 'qa')}) f) SELECT pair_id, score, score >= 1.0 AS meets, {_FORUM_TIER} AS tier FROM n",
        "c08_korean_score": f"{_W} {korean_score(DUCK, 'qa')}",
        "c09_korean_context": f"{_W} {korean_contexts(DUCK, 'qa')}",
        "c40_rule_layer": f"{_W} {rule_layer(DUCK, _ANSWERS.format(rows='qa'))}",
        "c45_cases": cases,
        "c57_priority": f"{_W} {_priority(DUCK, 'qa')}",
    }


ORACLES = _oracles()
