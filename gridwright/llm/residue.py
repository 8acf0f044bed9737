"""Template residue, filler, error pages and script notices in place of content (problem 3).

Character n-gram models are fitted to filler, error notices and script notices (from example
texts of general knowledge) and to natural prose (from all distinct texts of the corpus).
Windows in which a residue model is more likely than natural prose localise residue; a record
is excluded if residue covers most of its text.
Placeholders left unfilled are told by their form; a sentence that speaks about placeholders
keeps them.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.refusal_seeds import COMPANIONS, PROSE, SHORT_ANSWERS, refusal_texts
from gridwright.llm.residue_seeds import seeds

N = 4
BINS_LOG2 = 19
BINS = 1 << BINS_LOG2
#: n-grams of a window, its mean log likelihood ratio from which it is residue, and the share
#: of a text's letters that residue must cover.
WINDOW, RATIO, COVER = 14, 0.5, 0.55
CLIP = 4.0
#: Texts without this many letters and digits have no prose to judge.
LEAST = 3

# -- text ---------------------------------------------------------------------------------
FENCE = regex.compile(r"```.*?(?:```|\Z)", regex.S)
INLINE = regex.compile(r"`[^`\n]+`")
TAG = regex.compile(r"<!--.*?-->|</?[a-zA-Z!][^<>]*>", regex.S)
FORMULA = regex.compile(r"\{?=\s?[A-Za-z.]+(\((?:[^()]|(?1))*\)?)(?:\s?[-+*/&^<>]\s?(?:[A-Za-z.]+(?1)|[\w.$:]+))*\}?")
MACRO = regex.compile(r"\bSub \w+\(\).*?(?:End Sub|\Z)", regex.S)


def plain(text: str) -> str:
    """Text as read: entities resolved, compatibility forms folded."""
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKC", text)
    # jamo of keyboard mash are folded to conjoining ones; back to the ones on the keys
    return text.translate(_JAMO) if _CONJOINING.search(text) else text


_CONJOINING = regex.compile("[ᄀ-ᄒ]")
_JAMO = {0x1100 + k: ord(c) for k, c in enumerate("ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ")}


#: Reference numbers that servers put beside their messages, and a site's name at a title's end.
REFERENCE = regex.compile(r"[(\[#]* ?\b(?:ref(?:erence)?|request[ -]id|incident|trace)?[: ]{0,2}(?=[0-9a-f]*\d)[0-9a-f]{2,}\b ?[)\]]|#(?=[0-9a-f]*\d)[0-9a-f]{4,}\b|\(\p{Lu}\p{Ll}+-\d+\)")
SITE = regex.compile(r"\s*(?:\||::)\s*[^|:]{1,30}$|\s[-–—]\s[^\s\-–—]{2,12}\s*$")


def without_code(text: str, gap: str = " ") -> str:
    """Text without fenced and inline code, macros and formulas."""
    if "`" in text:
        text = INLINE.sub(" ", FENCE.sub(gap, text))
    if "Sub " in text:
        text = MACRO.sub(gap, text)
    return FORMULA.sub(gap, text) if "=" in text else text


def modelled(text: str) -> str:
    """What the n-gram models read: visible prose in small letters, a run of digits as one 0."""
    text = plain(without_code(text))
    if "<" in text:
        text = TAG.sub(" ", text)
    if "(" in text or "[" in text or "#" in text:
        text = REFERENCE.sub(" ", text)
    return " ".join(DIGITS.sub("0", SITE.sub("", text).lower()).split())


DIGITS = regex.compile(r"\d+")


def flat_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts in a row: bin of the n-gram at each character, whether the character is a
    letter or digit, the place of each text's first character, and each text's length."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join([f" {t}   " for t in texts]).encode("utf-32-le"), dtype=np.uint32)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(len(texts), np.int64), sizes
    wide = points.astype(np.uint64)
    h = np.zeros(len(points) - N + 1, dtype=np.uint64)
    for k in range(N):
        h = (h ^ wide[k : len(points) - N + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    padded = np.cumsum(sizes + 4) - sizes - 4
    starts = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(padded - starts, sizes)
    shown = points[at + 1]
    letters = _LETTER[np.minimum(shown, 128)] & ~((shown >= 0x2000) & (shown < 0x2070)) & ~((shown >= 0x3000) & (shown < 0x3020))
    return (h[at] >> np.uint64(64 - BINS_LOG2)).astype(np.int64), letters, starts, sizes


_LETTER = np.array([chr(k).isalnum() for k in range(128)] + [True])


# -- placeholders -------------------------------------------------------------------------
# fixed values: names of the fields that page and mail templates fill in
FIELDS = "title|subject|body|content|contents|text|answer|question|message|comment|category|board|topic|product|author|agent|date|name|user|user_name|username|first_name|last_name|nickname|post_title|post|link|url|steps|range|formula|code|image|file|email|company|price|description"
_NAME = r"[A-Za-z가-힣][\w.]*(?: [A-Za-z가-힣][\w.]*){0,2}"
DOUBLE = rf"\{{\{{[^{{}}\n]{{1,40}}\}}\}}|\{{%[^{{}}%\n]{{1,40}}%\}}|<%=?[^<>%\n]{{1,40}}%>|#\{{ ?{_NAME} ?\}}|%%{_NAME}%%|@@{_NAME}@@|\[\[ ?{_NAME} ?\]\]|(?<!\w)__[A-Za-z][A-Za-z_0-9]*?__(?!\w)|\$\{{ ?{_NAME} ?\}}|\$[A-Za-z][A-Za-z_]{{2,}}\$"
SINGLE = rf"\$(?:{FIELDS})\$|<(?:{FIELDS})>|\{{ ?(?:{FIELDS}) ?\}}|\[(?:{FIELDS})\]"
ASKING = r"[\[<{(]{1,2} ?(?:please )?(?:insert|enter|paste|add|type|put|your|write|fill in|to be)\b[^\[\]<>{}()\n]{0,60}[\]>})]{1,2}|\[[^\[\]\n]{0,30}(?:입력|입력하세요|넣으세요|작성하세요|채우기|들어갈 자리)\]|\bXX+_\w+_XX+\b|(?<!\w)TODO\b(?::| \w)|\[(?:to be completed|tbd|todo|placeholder|hier einfügen|insérer ici|insertar aquí)\]"
PLACEHOLDER = regex.compile(f"{DOUBLE}|{ASKING}|(?i:{SINGLE})", regex.I)
PRINTF = regex.compile(r"%[sd](?!\w)|\{\d\}")
#: Words of sentences that speak about placeholders, scripts or templates.
ABOUT = regex.compile(r"placeholder|mail merge|merge field|field shows|format call|format string|format code|template|office script|backtick|preview|script(?:ing)? language|variable|메일 병합|필드|서식|스크립트에서|변수|템플릿|미리 보기|\] ?칸|Platzhalter|Vorlage|Serienbrief|modèle|publipostage|plantilla|combinación", regex.I)
#: No placeholder is without one of these.
HINT = regex.compile(r"[\[{<%@#$]|__|XX|TODO|todo")


def placeholders(text: str) -> list[tuple[int, int]]:
    """Places of unfilled placeholders in a text whose code is blanked out."""
    out: list[tuple[int, int]] = []
    if not HINT.search(text):
        return out
    whole_page = regex.search(r"<html|</", text, regex.I)
    for m in PLACEHOLDER.finditer(text):
        if whole_page and m.group().lower() in ("<title>", "<body>", "<link>", "<code>", "<image>"):
            continue
        begin = max(text.rfind(c, 0, m.start()) for c in "\n!?。") + 1
        stop = regex.search(r"[.!?](?:\s|$)|\n|$", text, pos=m.end()).end()
        dot = [x.end() for x in regex.finditer(r"[.]\s", text, pos=begin, endpos=m.start())]
        around = text[dot[-1] if dot else begin : m.start()] + " " + text[m.end() : stop]
        if not ABOUT.search(around) and not regex.match(r" ?칸", text[m.end() :]):
            out.append(m.span())
    marks = list(PRINTF.finditer(text))
    if len(marks) > 1 and not ABOUT.search(text):
        out += [m.span() for m in marks]
    return out


def _blank(m) -> str:
    return " " * len(m.group())


def blank_code(text: str) -> str:
    if "`" in text:
        text = INLINE.sub(_blank, FENCE.sub(_blank, text))
    if "Sub " in text:
        text = MACRO.sub(_blank, text)
    # a formula's braces are no placeholder
    return regex.sub(r"\{=[^{}]*\}", _blank, text) if "{=" in text else text


def example_logs(texts: list[str]) -> np.ndarray:
    """Log frequency of each bin in example texts; minus infinity where they have none."""
    hits = np.bincount(flat_codes([modelled(t) for t in texts])[0], minlength=BINS)
    with np.errstate(divide="ignore"):
        return np.log(hits / hits.sum())


MARKUP = regex.compile(r"[\s\p{P}\p{S}\p{Cf}\p{Z}]+")
#: Whole texts that are too short for windows: nothing but loose consonants (and numbers), or
#: a single word struck on one row of keys, without vowels.
MASHED = regex.compile(r"(?=[^ㄱ-ㅎ]*[ㄱ-ㅎ]\s?[ㄱ-ㅎ])[ㄱ-ㅎ\s\d]+|\s*(?:[sdfghjkl]{2,}|[qwrtp]{2,})\s*")
NOTHING = {"", "na", "null", "none", "nil", "nan", "없음"}


def bare(text: str | None) -> bool:
    """No content: nothing but white space, marks, markup, or a word that means nothing."""
    return not text or MARKUP.sub("", TAG.sub("", plain(text))).lower() in NOTHING


# -- models -------------------------------------------------------------------------------
#: Share of natural prose that is left to n-grams not seen in the corpus, alike at every size.
UNSEEN = 0.02
#: Weight of the everyday prose among the natural models.
PROSE_SHARE = .3


def natural_logs(counts: np.ndarray) -> np.ndarray:
    """Log frequency of each bin in the corpus, smoothed.  One occurrence is that of the text
    which is judged, and a text is no evidence that it is itself natural: it is taken off."""
    others = np.maximum(counts - 1, 0)
    total = max(float(others.sum()), 1.0)
    return np.log(((1 - UNSEEN) * others + UNSEEN * total / BINS) / total)


def natural_base(counts: np.ndarray) -> np.ndarray:
    """Log frequency of each bin in natural prose: the corpus's, and everyday prose at PROSE_SHARE."""
    return np.maximum(natural_logs(counts), example_logs(PROSE) + np.log(PROSE_SHARE))


#: Log ratios are kept in whole steps of 1 / STEP, so that sums over windows are exact.
STEP = 1024


def ratios(best: np.ndarray, base: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(np.where(np.isinf(best), -CLIP * 0.6, best - base), -CLIP, CLIP) * STEP).astype(np.int32)


def coverage(ratio: np.ndarray, flat: tuple, least: float) -> np.ndarray:
    """Share of each text's letters that lie in windows whose mean ratio exceeds ``least``;
    0 where a text has fewer than LEAST letters."""
    at, letters, starts, sizes = flat
    if not len(at):
        return np.zeros(len(sizes))
    total = np.append(0, np.cumsum(ratio[at], dtype=np.int64))
    width = np.minimum(sizes, WINDOW)
    windows = sizes - width + (sizes > 0)
    first = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    wide = np.repeat(width, windows)
    hot = total[first + wide] - total[first] > least * STEP * wide
    edge = np.bincount(first[hot], minlength=len(at) + 1) - np.bincount((first + wide)[hot], minlength=len(at) + 1)
    inside = np.append(0, np.cumsum(letters & (np.cumsum(edge)[:-1] > 0)))
    every = np.append(0, np.cumsum(letters))
    held, whole = inside[starts + sizes] - inside[starts], every[starts + sizes] - every[starts]
    return np.where(whole >= LEAST, held / np.maximum(whole, 1), 0.0)


class ResidueModel:
    """Log likelihood ratios of n-gram bins: the best residue model against natural prose.

    Natural is what the corpus holds, and the short answers and refusals that any such
    corpus holds: a refusal is a defect of another kind, not leftover text.
    """

    def __init__(self, natural: np.ndarray):
        base = natural_base(natural)
        for texts in (refusal_texts(), COMPANIONS, SHORT_ANSWERS):
            base = np.maximum(base, example_logs(texts))
        best = np.full(BINS, -np.inf)
        for texts in seeds().values():
            best = np.maximum(best, example_logs(texts))
        self.ratio = ratios(best, base)

    def cover(self, flat: tuple) -> np.ndarray:
        return coverage(self.ratio, flat, RATIO)

    def judge(self, texts: list[str | None], flat: tuple | None = None) -> tuple[list[bool], np.ndarray, list[int]]:
        """(is residue, share covered, unfilled placeholders) of each text; ``flat``: the flat
        n-grams of the modelled texts, if known."""
        flat = flat or flat_codes([modelled(t or "") for t in texts])
        cover, out, spots = self.cover(flat), [], []
        for k, text in enumerate(texts):
            if not text or not text.strip():
                cover[k] = 0.0
                out.append(False)
                spots.append(0)
                continue
            shown = plain(text)
            spots.append(len(placeholders(blank_code(shown))))
            if not spots[-1] and bare(text):
                cover[k] = 0.0
            elif MASHED.fullmatch(shown):
                cover[k] = 1.0
            out.append(bool(spots[-1] or cover[k] >= COVER))
        return out, cover, spots


def distinct_texts(texts: DataFrame) -> DataFrame:
    """Each text (one column) once, so that copies weigh in no count; nulls are left out."""
    name = texts.columns[0]
    return texts.filter(F.col(name).isNotNull()).groupBy(F.md5(name).alias("_hash")).agg(F.first(name).alias(name)).select(name)


def natural_counts(texts: DataFrame) -> np.ndarray:
    """n-gram counts of all different texts (one column), as an array of fixed size.

    Each task adds its texts up in one array of ``BINS`` numbers; the sum over tasks is
    BINS rows at most, whatever the corpus, and only these come to the driver.
    """
    return prose_counts(distinct_texts(texts), modelled)


def prose_counts(texts: DataFrame, read: Callable[[str], str] = str) -> np.ndarray:
    """n-gram counts of what ``read`` makes of each text (one column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            total += np.bincount(flat_codes([read(t) for t in batch.column(0).to_pylist() if t])[0], minlength=BINS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bin", "n"])

    rows = texts.mapInArrow(run, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BINS)
    counts[rows["bin"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
    return counts


def find_residue(records: DataFrame, model: ResidueModel) -> DataFrame:
    """All columns but ``text``, and residue BOOLEAN, cover DOUBLE, placeholders INT.

    Null, empty and blank texts are no residue (they have no text at all); texts are read
    whole, repeated rows are judged alike, and an empty table gives an empty result.
    """
    rest = [c for c in records.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema if f.name != "text") + ", residue boolean, cover double, placeholders int"
    shared = records.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value.judge
        for batch in batches:
            found = judge(batch.column(len(rest)).to_pylist())
            cols = [pa.array(f, kind) for f, kind in zip(found, (pa.bool_(), pa.float64(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *cols], [*rest, "residue", "cover", "placeholders"])

    return records.select(*rest, "text").mapInArrow(run, schema)


def answer_text(answer: str = "answer") -> Column:
    """answer.text, or answer.body_markdown where text is null or blank."""
    text, markdown = F.col(f"{answer}.text"), F.col(f"{answer}.body_markdown")
    return F.when(text.rlike(r"(?U)\S"), text).otherwise(markdown)
