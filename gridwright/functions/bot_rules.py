"""Sub-checks of the rule layer of bot detection, as expressions of either dialect."""

from __future__ import annotations

from gridwright.functions.dialects import Dialect, best, num, when

# fixed values: names, phrases and patterns of the rule layer
KNOWN_BOTS = ("AutoModerator", "BotDefense", "RepostSleuthBot", "RemindMeBot", "FriendlyBotDetector", "anti-bot-bot", "ExcelHelperBot", "FormulaBot", "SpreadsheetBot", "bot", "auto", "mod", "helper", "assist")
MODERATOR = ("Your post was submitted successfully", "I am a bot", "contact the moderators", "/r/excel) if you have any questions", "This action was performed automatically", "reply to the **answer(s)** saying `Solution Verified`", "Follow the **[submission rules]", "Include your **[Excel version", "Failing to follow these steps may result", "Please [contact the moderators", "automatically. Please [contact", "I am a bot, and this action", "performed automatically", "moderators of this subreddit", "submission rules", "Excel version and all other", "relevant information", "post being removed without warning", "submission was submitted successfully", "close the thread", "action_reason:", "removed for rule violation", "please read the rules", "This comment was automatically generated")
AUTOMATIC = ("Thank you for your submission", "This is an automated response", "If you need further assistance", "Please refer to the documentation", "This response was generated automatically", "For more information, please visit", "If this helped you, please consider", "This is a common question", "You can find more information at", "This action cannot be undone", "Please confirm your request", "This feature is not available", "Error: Invalid input", "Success: Operation completed", "Warning: Please check", "Info: Additional details")
TEMPLATES = (r"\{\{.*\}\}", r"\[.*\]\(.*\)", r"(?m)^---$", r"(?im)^\s*\[.*\]:\s*http", r"(?m)^\s*\*\s*\*\s*\*\s*$", r"(?m)^\s*\d+\.\s*$", r"(?:\A|\n)[ \t\r\f]*\n[ \t\r\f]*(?:\n|\z)")
SPAM = (r"(?i)\b(free|discount|limited time|special offer|click here|sign up now)\b", r"(?i)\b(buy now|order today|exclusive deal|save \d+%)", r"(?i)\b(earn money|make money|work from home|business opportunity)\b", r"(?i)\b(viagra|casino|poker|lottery|winner)\b", r"(?i)\b(download now|install now|register now|join now)\b")
ASSISTANT = ("I hope this helps", "Let me know if you need further assistance", "Please don't hesitate to ask", "I'd be happy to help", "Here's what I would suggest", "You might want to consider", "One approach would be to", "Another option is to", "I hope this clarifies", "Feel free to reach out", "I'm here to help", "If you have any questions")
EXCEL_TERMS = ("formula", "cell", "column", "row", "sheet", "workbook", "vlookup", "hlookup", "index", "match", "sumif", "countif", "pivot", "table", "chart", "graph", "macro", "vba", "xlookup", "filter", "sort", "conditional", "formatting", "range", "reference", "absolute", "relative", "named", "function", "array", "dynamic", "spill", "lambda")
GENERIC = ("i hope this helps", "let me know if you need help", "please try this", "this should work", "you can do this", "try this solution")
OFF_TOPIC = ("politics", "sports", "weather", "cooking", "music", "movies")

BOT = 0.7


def username_risk(d: Dialect, author: str = "author") -> str:
    low = f"lower({author})"
    plain = [b.lower() for b in KNOWN_BOTS if b != "helper"]
    known = f"{author} IN ({', '.join(d.text(b) for b in KNOWN_BOTS)})"
    helper = f"CASE WHEN {d.has(low, 'helper')} THEN CASE WHEN {d.any(low, ('excel', 'vba', 'formula', 'expert'))} THEN {num(0.3)} ELSE {num(0.9)} END ELSE {num(0.0)} END"
    gain = lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"
    risk = best(gain(known, 1.0), gain(d.any(low, plain), 0.9), helper, gain(d.like(author, r"^[A-Za-z]+\d{4,}$"), 0.8), gain(d.like(author, r"^[A-Za-z]+_[A-Za-z]+\d+$"), 0.7), gain(d.like(low, r"^(user|reddit|anonymous)\d+$"), 0.6))
    return f"CASE WHEN coalesce({author}, '') IN ('', '[deleted]') THEN {num(0.0)} ELSE {risk} END"


def content_risk(d: Dialect, text: str = "body") -> str:
    low, gain = f"lower({text})", lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"
    said = d.count(low, [w.lower() for w in ASSISTANT])
    assistant = when((f"{said} >= 3", num(0.8)), (f"{said} >= 2", num(0.6)), other=num(0.0))
    return best(gain(d.any(low, [w.lower() for w in MODERATOR]), 0.95), gain(d.any(low, [w.lower() for w in AUTOMATIC]), 0.85), gain(d.any_like(text, TEMPLATES), 0.8), gain(d.any_like(text, SPAM), 0.9), assistant)


def structure_risk(d: Dialect, text: str = "body") -> str:
    gain = lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"
    flat = f"length(trim(replace({text}, chr(10), '')))"
    sentences = d.parts(text, "[.!?]+")
    repeated = f"{d.size(sentences)} > 3 AND {d.size(d.distinct(sentences))} < {d.size(sentences)} * {num(0.7)}"
    return best(gain(f"{d.times(text, r'[*][*]')} > 6", 0.6), gain(f"{d.times(text, r'\[.*\]\(.*\)')} > 3 AND {flat} < 100", 0.7), gain(f"{d.times(text, r'(?m)^[ \t]*(?:-|[*]|[0-9]+[.])[ \t]*$')} > 2", 0.6), gain(f"{d.times(text, '\n\n')} > 5", 0.5), gain(repeated, 0.7))


def context_risk(d: Dialect, text: str = "body") -> str:
    low, gain = f"lower({text})", lambda test, x: f"CASE WHEN {test} THEN {num(x)} ELSE {num(0.0)} END"
    return best(gain(f"{d.words(text)} > 20 AND NOT {d.any(low, EXCEL_TERMS)}", 0.5), gain(f"{d.count(low, GENERIC)} > 2", 0.6), gain(f"{d.words(text)} > 50 AND {d.any(low, OFF_TOPIC)}", 0.7))


def rules_risk(d: Dialect, text: str, author: str) -> str:
    """The greatest sub-check that reaches BOT, else 0."""
    checks = (username_risk(d, author), content_risk(d, text), structure_risk(d, text), context_risk(d, text))
    return best(*[f"CASE WHEN {x} >= {BOT} THEN {x} ELSE {num(0.0)} END" for x in checks])
