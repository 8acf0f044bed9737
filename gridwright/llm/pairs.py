"""Broken prompt and response pairs (problem 4).

Sorted by text, an answer's last sentence that was cut off stands right before a longer
sentence that begins with it: neighbours' common prefixes find shortened versions, and the
lengths at which suspiciously many answers stop count as limits.  An open formula, macro or
list shows a cut by itself.  Copies of the question, refusals (by n-gram models as in
:mod:`gridwright.llm.residue`) and answers in another language are told by rules on the pair
itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridwright.llm.reading import WORD, language
from gridwright.llm.refusal_seeds import COMPANIONS, SHORT_ANSWERS, refusal_texts
from gridwright.llm.residue import FORMULA, RATIO, STEP, TAG, WINDOW, ResidueModel, bare, blank_code, coverage, distinct_texts, example_logs, flat_codes, modelled, natural_base, placeholders, plain, prose_counts, ratios, without_code
from gridwright.session import written

DEFECTS = ("empty", "truncated", "refusal", "copies_question", "other_language")
#: Share of an answer's n-grams in the question that makes it a copy, and its fewest words.
COPY, COPY_WORDS = 0.8, 5
#: Share of the letters that refusal must cover, and the mean log ratio of its best window.
REFUSED, CORE = 0.6, 0.8
#: A cut sentence's full version is at least so many times as frequent as the cut one as an end.
OFTEN = 3
#: Ends without a mark count a WHOLE-th as whole sentences.
WHOLE = 4
#: A length is a limit if it has so many times the answers of the lengths around it.
SPIKE, AROUND = 8.0, 10

CUT_MARK = regex.compile(r"(?:…|\.\.\.|\.\. ?\.)\s*[\[(]?\s*(?:read more|continued|more|mehr|weiter|suite|lire la suite|seguir leyendo|continúa|계속|더 ?보기|이하 생략)?\s*[\])]?\s*$|[\[(]\s*(?:read more|continued|more|truncated|cut off|계속|더 ?보기|…|\.\.\.)\s*[\])]\s*$", regex.I)
END_MARK = regex.compile(r"[.!?。！？…]['\")\]»”`*_~]*$|[:;]?[-^~ㅎㅋ)(]{1,3}[)^D(]?$|\^\^$")
QUOTE = regex.compile(r"^\s*>+\s?", regex.M)
LEAD = regex.compile(r"^\s*(?:you asked|you wrote|your question|the question|question|q|re|quote|asked|질문|문의|문의 내용|질문 내용|du fragtest|deine frage|frage|tu as demandé|question posée|votre question|preguntaste|tu pregunta|pregunta)\s*[:：]\s*", regex.I)
SPLIT = regex.compile(r"(?<=[.!?:。])\s+|\n+")
MASKS = (
    (regex.compile(r"\$?\b[A-Z]{1,3}\$?\d+(?: ?: ?\$?[A-Z]{1,3}\$?\d+)?\b"), "c"),
    (regex.compile(r"\b(?:\p{Lu}\p{Ll}+(?:[-_]\p{Lu}?\p{Ll}+)*[-_]?\d+(?:\.\w+)?|tbl\w+|\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)+|\w+\.xlsx)\b"), "n"),
    (regex.compile(r"\b\p{Lu}{2,}\d*\b"), "f"),
    (regex.compile(r"(?<=\S )\p{Lu}\p{Ll}*\b"), "n"),
    (regex.compile(r"^\p{Lu}\p{Ll}+(?= ?[가-힣])"), "n"),
    (regex.compile(r"\d+"), "0"),
)
HALF_FORMULA = regex.compile(r"(?:^|[\s`:])\{?=\s?[A-Za-z][\w.]*(?P<rest>[^\n]*)$")
MACRO_HEAD = regex.compile(r"\b(?:Sub|Function) \w+\s*\(")
MACRO_END = regex.compile(r"\bEnd (?:Sub|Function)\b")
SPEECH = regex.compile(r"[\p{L}]{2,}")


def prose(text: str) -> str:
    """Plain text without code and formulas, one sentence a line where code was."""
    return without_code(TAG.sub("\n", text) if "<" in text else text, "\n")


def mask(part: str) -> str:
    for pattern, sub in MASKS:
        part = pattern.sub(sub, part)
    return part.lower()


def parts(text: str) -> list[str]:
    """Sentences of a text, without quote and list marks, white space single."""
    out = []
    for part in SPLIT.split(text):
        part = " ".join((QUOTE.sub("", part) if ">" in part else part).split()).strip(" *_-")
        if part:
            out.append(part)
    return out


def masked(text: str) -> list[str]:
    """Sentences with names, functions, cells and numbers masked, in small letters."""
    return [mask(part) for part in parts(text)]


def stops_short(shown: str) -> bool:
    """Forms that show by themselves that a text goes on: an ellipsis with 'more', an open
    formula, macro or list, a colon or comma at the end."""
    end = shown.rstrip()
    if CUT_MARK.search(end, pos=max(0, len(end) - 40)):
        return True
    if MACRO_HEAD.search(end) and not MACRO_END.search(end):
        return True
    if end.count("```") % 2:
        return True
    if open_formula(end):
        return True
    return bool(GOES_ON.search(end))


def open_formula(end: str) -> str | None:
    """The formula that a text breaks off in, if it does."""
    end = end.rstrip().rstrip("`")
    half = HALF_FORMULA.search(end) if "=" in end else None
    if not half:
        return None
    rest, level = STRING.sub("", half.group("rest")), 0
    for k, ch in enumerate(rest):
        level += (ch == "(") - (ch == ")")
        if ch == ")" and level == 0 and k + 1 < len(rest) and AFTER.match(rest, pos=k + 1):
            return None  # prose after the formula
    return end[end.index("=", half.start()) :] if level > 0 or not rest.strip() or OPEN_END.search(rest) else None


def formulas(text: str) -> list[str]:
    """Whole formulas of a text, masked: sentences of their own."""
    if "=" not in text:
        return []
    found = (m.group() for m in FORMULA.finditer(text))
    return [" ".join(mask(f).split()) for f in found if "(" in f and f.count("(") == f.count(")")]


STRING, AFTER = regex.compile(r'"[^"]*"'), regex.compile(r"\}?\s+[^\s\-+*/&^<>=]")
OPEN_END = regex.compile(r"[-+*/&^(,]\s*(?:[A-Za-z]+)?$")
GOES_ON = regex.compile(r"[:,]$|(?:^|\n|[.!?:]\s)\d{1,2}[.)]$|\s[-*•]$")


NOT_WORD = regex.compile(r"[\W_]+")


def grams(text: str) -> set[str]:
    flat = NOT_WORD.sub(" ", text.lower()).strip()
    return {flat[k : k + 3] for k in range(len(flat) - 2)}


def copies(answer: str, question: str) -> bool:
    """The answer says what the question says and hardly anything else."""
    heard = set(question.lower().split())
    told = answer.lower().split()
    if 3 * sum(w in heard for w in told) < len(told):
        return False
    said = answer
    for _ in range(2):
        said = LEAD.sub("", QUOTE.sub("", said).strip())
    if len(set(SPEECH.findall(said.lower()))) < COPY_WORDS:
        return False
    words, asked = Counter(SPEECH.findall(said.lower())), set(SPEECH.findall(question.lower()))
    if sum(n for w, n in words.items() if w in asked) < 0.5 * sum(words.values()):
        return False
    mine = grams(said)
    return len(mine & grams(question)) >= COPY * len(mine)


class RefusalModel:
    """Log likelihood ratios of refusal against the corpus's prose and short sound answers."""

    def __init__(self, natural: np.ndarray):
        base = np.maximum(natural_base(natural), example_logs(SHORT_ANSWERS))
        core = example_logs(refusal_texts())
        self.core, self.ratio = ratios(core, base), ratios(np.maximum(core, example_logs(COMPANIONS)), base)

    def judge(self, flat: tuple) -> np.ndarray:
        """Which texts are refusals: covered by refusal and its companions, a refusal proper among them."""
        out = coverage(self.ratio, flat, RATIO) >= REFUSED
        at, _, starts, sizes = flat
        for k in np.flatnonzero(out):
            total = np.append(0, np.cumsum(self.core[at[starts[k] : starts[k] + sizes[k]]], dtype=np.int64))
            width = min(WINDOW, sizes[k])
            out[k] = (total[width:] - total[:-width]).max() > CORE * STEP * width
        return out


class PairJudge:
    """Judges pairs as far as each pair alone shows it."""

    def __init__(self, natural: np.ndarray):
        self.residue, self.refusal = ResidueModel(natural), RefusalModel(natural)

    def judge(self, pairs: list[tuple]) -> list[tuple[str, str | None, bool]]:
        """(defect or '' or 'residue', masked last sentence if it has no end mark, whether the
        form alone shows a cut) of pairs (text, markdown, title, body)."""
        said: list[str | None] = []
        for text, markdown, _, _ in pairs:
            if bare(text) and not (text and placeholders(blank_code(plain(text)))):
                text = None if bare(markdown) else markdown
            said.append(text)
        flat = flat_codes([modelled(t) if t else "" for t in said])
        residue, refusal = self.residue.judge(said, flat)[0], self.refusal.judge(flat)
        return [("empty", None, False) if text is None else ("residue", None, False) if left else self._rest(text, title, body, declines) for text, left, declines, (_, _, title, body) in zip(said, residue, refusal, pairs, strict=True)]

    def _rest(self, text: str, title: str | None, body: str | None, declines: bool) -> tuple[str, str | None, bool]:
        shown = plain(text).strip()
        question = plain(f"{title or ''}\n{body or ''}")
        untagged = TAG.sub(" ", shown) if "<" in shown else shown
        if copies(untagged, question):
            return "copies_question", None, False
        said = prose(shown)
        words = WORD.findall(said.lower())
        if declines and words and not ("=" in shown and FORMULA.search(shown) or MACRO_HEAD.search(shown)):
            return "refusal", None, False
        tail, flat = None, untagged.rstrip(" *_>")
        half = open_formula(shown)
        if half:
            tail = " ".join(mask(half).split())
        elif flat and flat[-1] not in ")]`}\"" and not END_MARK.search(flat, pos=max(0, len(flat) - 12)):
            last = parts(said)
            end = mask(last[-1]) if last else ""
            tail = end if SPEECH.search(end) else None
        if stops_short(shown):
            return "", tail, True
        if len(words) >= 4:
            told = language(words)
            asked = question_language(question) if told else ""
            if asked and asked != told:
                return "other_language", None, False
        return "", tail, False


def question_language(question: str) -> str:
    return language(WORD.findall(without_code(question).lower()))


def read_answers(pairs: DataFrame) -> DataFrame:
    """(prose, sentences, whole) of each different answer, written once: what the models read,
    the masked formulas and sentences, and whether the last one ends with a mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proses, every, ended = [], [], []
            for text in batch.column(0).to_pylist():
                shown = plain(text).strip()
                flat = (TAG.sub(" ", shown) if "<" in shown else shown).rstrip(" *_>")
                proses.append(modelled(text))
                half, said = open_formula(shown), masked(prose(shown))
                last = [" ".join(mask(half).split())] if half else []
                every.append([*formulas(shown), *said, *last])
                ended.append(not half and (not said or END_MARK.search(flat, pos=max(0, len(flat) - 12)) is not None))
            yield pa.RecordBatch.from_arrays([pa.array(proses, pa.string()), pa.array(every, pa.list_(pa.string())), pa.array(ended)], ["prose", "sentences", "whole"])

    return written(distinct_texts(pairs.select("said")).mapInArrow(run, "prose string, sentences array<string>, whole boolean"), "answers-read")


def sentence_counts(read: DataFrame) -> DataFrame:
    """sentence, inner (times as a whole sentence), ends (times as an end without a mark).

    Different answers are counted: copies of one are one.
    """
    each = read.select(F.posexplode("sentences").alias("at", "sentence"), F.size("sentences").alias("n"), "whole")
    whole = F.col("whole") | (F.col("at") < F.col("n") - 1)
    return each.groupBy("sentence").agg(F.count_if(whole).alias("inner"), F.count_if(~whole).alias("ends"))


def cut_sentences(counts: DataFrame) -> DataFrame:
    """Ends that are the beginning of a more frequent whole sentence (column ``tail``).

    An end without a mark is itself a whole sentence if it is frequent by far (a closing):
    a WHOLE-th of its number counts then.

    In text order, the sentences that begin with an end follow it directly.  Each task sorts
    a range of the sentences, reads it as a stream and holds only the chain of prefixes of the
    current sentence.  A run may go on in the next ranges: a task gives the ends still open at
    its last sentence, and for each prefix of its first sentence the most frequent sentence of
    its own that goes on with that prefix; the two are joined.
    """
    counts = counts.withColumn("inner", F.greatest("inner", F.floor(F.col("ends") / WHOLE)))
    order = counts.select("sentence", "inner", "ends").repartitionByRange("sentence").sortWithinPartitions("sentence")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: list[list] = []  # [sentence, ends, largest count of a continuation]
        first, heads, common = None, {}, 0
        for batch in batches:
            out = []
            for sentence, inner, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                while chain and not sentence.startswith(chain[-1][0]):
                    done = chain.pop()
                    if done[1]:
                        out.append(done)
                # what goes on must hold a word; of a formula, any two characters
                speech = (len(sentence) if sentence[0] == "=" else max((m.end() for m in SPEECH.finditer(sentence)), default=0)) - 2
                for one in chain:
                    if inner > one[2] and len(one[0]) <= speech:
                        one[2] = inner
                if first is None:
                    first, common = sentence, len(sentence)
                if common:
                    common = _common(first, sentence, common)
                    at = min(common, speech)
                    if at > 0 and inner > heads.get(at, 0):
                        heads[at] = inner
                chain.append([sentence, ends, 0])
            yield _rows([c for c in out if c[2] >= OFTEN * c[1]], False)
        yield _rows([c for c in chain if c[1]], True)
        most, rows = 0, []
        for at in range(len(first or ""), 0, -1):
            most = max(most, heads.get(at, 0))
            if most:
                rows.append([first[:at], 0, most])
        yield _rows(rows, True)

    found = written(order.mapInArrow(run, "tail string, ends bigint, most bigint, open boolean"), "tails")
    joined = found.filter("open").groupBy("tail").agg(F.max("ends").alias("ends"), F.max("most").alias("most"))
    return found.filter("not open").select("tail").unionByName(joined.filter((F.col("ends") > 0) & (F.col("most") >= OFTEN * F.col("ends"))).select("tail"))


def _rows(found: list[list], unfinished: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()), pa.array([unfinished] * len(found), pa.bool_())], ["tail", "ends", "most", "open"])


def _common(a: str, b: str, most: int) -> int:
    """Length of the common prefix, ``most`` at most."""
    if a[:most] == b[:most]:
        return most
    return next(k for k in range(most) if a[k : k + 1] != b[k : k + 1])


def length_limits(judged: DataFrame) -> DataFrame:
    """Lengths at which answers stop in far more ways, without an end mark, than at those around.

    Different ends are counted, not answers: copies of one answer, or a common closing, are one.
    """
    lengths = judged.filter("tail is not null").select("size", "tail").distinct().groupBy("size").count()
    near = W.orderBy("size").rangeBetween(-AROUND, AROUND)
    # one row a length: as many as the longest answer has characters, whatever the corpus
    mean = (F.sum("count").over(near) - F.col("count")) / (2 * AROUND)
    return lengths.withColumn("mean", mean).filter((F.col("size") >= 40) & (F.col("count") >= SPIKE * F.greatest("mean", F.lit(1.0)))).select("size")


def judge_pairs(pairs: DataFrame, natural: np.ndarray) -> DataFrame:
    """pair_id, defect, tail, form, size of each row (``text, markdown, title, body`` judged alone)."""
    shared = pairs.sparkSession.sparkContext.broadcast(PairJudge(natural))
    kind = pairs.schema["pair_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value.judge
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True))
            found = judge(rows)
            cols = [pa.array([f[k] for f in found], kind_) for k, kind_ in enumerate((pa.string(), pa.string(), pa.bool_()))]
            sizes = pa.array([len(t or m or "") for t, m, _, _ in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, sizes], ["pair_id", "defect", "tail", "form", "size"])

    return pairs.select("pair_id", "text", "markdown", "title", "body").mapInArrow(run, f"pair_id {kind}, defect string, tail string, form boolean, size int")


def pair_texts(qa: DataFrame) -> DataFrame:
    """pair_id, text, markdown, title, body, said (the answer's text as TESTDATA defines it)."""
    return qa.select("pair_id", F.col("answer.text").alias("text"), F.col("answer.body_markdown").alias("markdown"), F.col("question.title").alias("title"), F.coalesce("question.body", "question.text", "question.body_markdown").alias("body"), said().alias("said"))


def said() -> Column:
    text, markdown = F.col("answer.text"), F.col("answer.body_markdown")
    return F.when(text.rlike(r"(?U)\S"), text).otherwise(markdown)


def judged_pairs(pairs: DataFrame) -> DataFrame:
    """pair_id, defect ('' if none by the pair alone), and how a cut shows: ``form``, ``cut`` (a
    neighbour in text order goes on where the answer ends), ``limit`` (of length)."""
    read = read_answers(pairs)
    judged = written(judge_pairs(pairs, prose_counts(read.select("prose"))), "pairs-judged")
    cut = cut_sentences(sentence_counts(read)).distinct().withColumn("cut", F.lit(True))
    limits = length_limits(judged).withColumn("limit", F.lit(True))
    # the distinct cut sentences and limits are few; a closing that a tenth of all pairs have is
    # a hot key on the left only, which an adaptive join splits
    both = judged.join(cut, "tail", "left").join(limits, "size", "left")
    told = lambda c: F.coalesce(F.col(c), F.lit(False)) & F.col("tail").isNotNull()
    return both.select("pair_id", "defect", "form", told("cut").alias("cut"), told("limit").alias("limit"))


def broken_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, defect) of each defective pair, once.

    ``pairs`` as of :func:`pair_texts`.  A pair has the first defect that holds, in the order
    empty, copies_question, refusal, truncated by form, other_language, truncated; leftover text
    (problem 3) is none.  Null answers count as empty, null questions can't be copied and have
    no language.  Of repeated rows that differ the first defect in alphabetical order counts;
    rows without a key are left out.  Texts are read whole; an empty table gives an empty result.
    """
    judged = judged_pairs(pairs)
    short = F.when(F.col("form") | F.col("cut") | F.col("limit"), "truncated")
    defect = F.when(F.col("defect").isin(*DEFECTS), F.col("defect")).when(F.col("defect") == "", short)
    return judged.select("pair_id", defect.alias("defect")).filter("pair_id is not null and defect is not null").groupBy("pair_id").agg(F.min("defect").alias("defect"))


def truncation_split(pairs: DataFrame) -> DataFrame:
    """How the truncated pairs show: form, cut, limit and the number of such pairs."""
    own = judged_pairs(pairs).filter("pair_id is not null and defect = '' and (form or cut or limit)")
    return own.groupBy("form", "cut", "limit").agg(F.count_distinct("pair_id").alias("n"))
