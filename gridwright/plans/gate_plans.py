"""Gates and community scores of collected pairs, at their full constants, for both engines."""

from __future__ import annotations

from gridwright.functions.bot_rules import BOT, rules_risk
from gridwright.functions.dialects import DUCK, SPARK, Dialect, num, when
from gridwright.plans.common import QA, qa

# fixed values: words of the gates and scores
CALLS, SHEET_WORDS = ("VLOOKUP", "INDEX", "MATCH"), ("formula", "cell", "column", "row", "sheet", "pivot", "vlookup", "index", "match")
HARD_WORDS = ("vba", "macro", "array", "regex", "pivot", "sql", "power query")
LEVELS = {"beginner": "easy", "basic": "easy", "simple": "easy", "intermediate": "medium", "normal": "medium", "standard": "medium", "advanced": "hard", "complex": "hard", "expert": "expert", "master": "expert"}
SHEET_MARKS = ("=", "SUM", "IF", "VLOOKUP", "INDEX", "MATCH", "합계", "평균", "개수", "조건", "찾기", "수식", "함수", "셀", "워크시트", "엑셀", "피벗")
CODE = (r"(?s)```.*```", r"`[^`\n]+`", r"(?i)<code>|<pre>", r"=[A-Z]+\(")
KOREAN_WEIGHT = 1.5


def _gain(test: str, x: float) -> str:
    return f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"


def question_gate(d: Dialect, rows: str) -> str:
    """Title 15 to 250, body 100 or more, score 5 or more, an answer, tagged excel and with none
    of the excluded tags; views and age aren't in the table."""
    tags = f"array_contains(tags, 'excel') AND NOT array_contains(tags, 'sharepoint') AND NOT array_contains(tags, 'power-bi')"
    return f"SELECT pair_id FROM {rows} WHERE length(title) BETWEEN 15 AND 250 AND length(coalesce(body, '')) >= 100 AND q_score >= 5 AND (a_text IS NOT NULL OR a_md IS NOT NULL) AND {tags}"


def quality_answer(d: Dialect, rows: str) -> str:
    """No bot, and two of: code, more than 100 characters, more than two lines, a sheet's word."""
    code = f"({d.has('t', '```')} OR {d.like('t', r'(?m)^[ \t]*=')} OR {d.any('upper(t)', CALLS)})"
    votes = f"CAST({code} AS INT) + CAST(length(trim(t)) > 100 AS INT) + CAST(length(t) - length(replace(t, chr(10), '')) >= 2 AS INT) + CAST({d.any('lower(t)', SHEET_WORDS)} AS INT)"
    inner = f"SELECT pair_id, {votes} AS votes, {rules_risk(d, 't', 'author')} AS risk FROM (SELECT pair_id, author, coalesce(a_text, '') AS t FROM {rows}) x WHERE t <> ''"
    return f"SELECT pair_id, votes FROM ({inner}) v WHERE votes >= 2 AND risk < {BOT}"


def generic_score(d: Dialect, rows: str) -> str:
    """Base 5, words, code, solved, upvotes to 2; negative upvotes don't count."""
    words = when((f"{d.words('t')} >= 50", num(1.0)), (f"{d.words('t')} >= 20", num(0.5)), other=num(0.0))
    votes = f"CASE WHEN up > 0 THEN least({num(2.0)}, up / {num(10.0)}) ELSE {num(0.0)} END"
    score = f"least({num(10.0)}, {num(5.0)} + {words} + {_gain(d.any_like('t', CODE), 1.0)} + {_gain('solved', 1.0)} + {votes})"
    return f"SELECT pair_id, round({score}, 6) AS score FROM (SELECT pair_id, coalesce(a_text, '') AS t, coalesce(op_confirmed, false) AS solved, coalesce(a_score, 0) AS up FROM {rows}) x"


def community_score(d: Dialect, rows: str) -> str:
    """Base 5, question's and answer's scores, accepted 2, long answer .5, at most 10; views, which
    pairs don't have, are taken as the thread's comments."""
    score = f"{num(5.0)} + least({num(2.0)}, coalesce(q_score, 0) / {num(10.0)}) + least({num(3.0)}, coalesce(a_score, 0) / {num(5.0)}) + {_gain('op_confirmed', 2.0)} + least({num(1.0)}, coalesce(total_comments, 0) / {num(1000.0)}) + {_gain('length(a_text) > 500', 0.5)}"
    return f"SELECT pair_id, round(least({num(10.0)}, {score}), 6) AS score FROM {rows}"


def collector_score(d: Dialect, rows: str) -> str:
    """Base 5 and length bonuses, times the Korean weight, a point for a sheet's content, at most 10."""
    question = when(("length(q) >= 100", num(1.0)), ("length(q) >= 50", num(0.5)), other=num(0.0))
    answer = when(("length(a) >= 100", num(1.5)), ("length(a) >= 50", num(1.0)), other=num(0.0))
    marks = d.any("upper(concat(q, ' ', a))", SHEET_MARKS)
    score = f"least({num(10.0)}, ({num(5.0)} + {_gain('length(title) >= 20', 0.5)} + {question} + {answer}) * {num(KOREAN_WEIGHT)} + {_gain(marks, 1.0)})"
    return f"SELECT pair_id, round({score}, 6) AS score FROM (SELECT pair_id, coalesce(title, '') AS title, coalesce(body, '') AS q, coalesce(a_text, '') AS a FROM {rows} WHERE source = 'oppadu') x"


def difficulty(d: Dialect, rows: str) -> str:
    """Level by how many advanced words question and context hold, and the level's normal name."""
    n = d.count("lower(concat(coalesce(q_text, ''), ' ', coalesce(a_text, '')))", HARD_WORDS)
    level = when(("n >= 2", "'advanced'"), ("n = 1", "'intermediate'"), other="'beginner'")
    normal = when(*[(f"level = '{k}'", f"'{v}'") for k, v in LEVELS.items()], other="'medium'")
    return f"SELECT pair_id, level, {normal} AS normal FROM (SELECT pair_id, {level} AS level FROM (SELECT pair_id, {n} AS n FROM {rows}) x) y"


RULES = {"f07_question_gate": question_gate, "f25_two_of_four": quality_answer, "c10_generic_score": generic_score, "c11_community_score": community_score, "c12_collector_score": collector_score, "c16_difficulty": lambda d, rows: f"SELECT pair_id, level FROM ({difficulty(d, rows)}) z", "c17_difficulty_map": lambda d, rows: f"SELECT pair_id, normal FROM ({difficulty(d, rows)}) z"}


def _query(rule):
    def run(spark, sf):
        return spark.sql(rule(SPARK, "\0").replace("{", "{{").replace("}", "}}").replace("\0", "{rows}"), rows=qa(spark, sf))

    return run


QUERIES = {name: _query(rule) for name, rule in RULES.items()}
ORACLES = {name: f"WITH {QA} {rule(DUCK, 'qa')}" for name, rule in RULES.items()}
