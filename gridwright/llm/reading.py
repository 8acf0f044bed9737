"""Reading level of documents (problem 8).

Prose is separated from code, formulas and tables; words, sentences, letters and syllables
are counted, syllables by hyphenation-style rules, once for each different word of a task; the
median of several grade formulas is the raw level.  A rising curve fitted to people's labels
maps it to school years.
"""

from __future__ import annotations

import math
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from statistics import median

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fewest words and sentences of prose that a level is given for.
LEAST_WORDS, LEAST_SENTENCES = 20, 1
#: Labels that the curve is fitted to; more are an error (people's labels are a small table).
MOST_LABELS = 100_000
#: School years from which a text counts as university prose: 16, where grades are whole years.
UNIVERSITY = 15.5

LANGUAGES = ("en", "de", "es", "fr", "ko")
#: Frequent words that tell the languages apart (fixed values).
STOPWORDS = {
    "en": "the of and to is in that it for you was with on are this be have not which from by or an as at but they we your can will if i do my when how use one all there been has their its these those than then so into any more such only other should could would what who does did no each every after before because since while where between about them up out now put them his her our me he she",
    "de": "der die das und ist nicht ich zu den mit von ein eine einen einer dem des im auf für sich auch es wie wird dann oder wenn aus bei noch nach als an aber nur so du sie wir hat hier bitte diese dieser zum zur denn damit",
    "es": "el la los las de del que y en un una para por con no es se lo su al como más pero si ya hay cuando este esta aquí muy también mi tu me te porque puedes sin desde hasta sobre entre",
    "fr": "le la les de des du et est un une pour dans que qui ne pas sur avec ce cette il elle je tu vous nous se son sa ses au aux mais ou où si plus car par en même aussi puis mon ton votre c'est d'un j'ai l'on",
}
_SETS = {lang: frozenset(STOPWORDS[lang].split()) for lang in STOPWORDS}

FENCE = regex.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)", regex.S)
INLINE = regex.compile(r"`[^`\n]*`")
TAGS = regex.compile(r"</?(?:p|br|div|span|b|i|em|strong|code|pre|table|tr|td|th|ul|ol|li|a|h[1-6]|hr|blockquote)\b[^<>]*>", regex.I)
FORMULA = regex.compile(r"(?<![\w=<>])\{?=\s*[A-Z][A-Z0-9.]*(\((?:[^()]|(?1))*\)?)(?:\s?[-+*/&^<>=]\s?(?:[A-Z][A-Z0-9.]*(?1)|[\w.$:]+))*\}?")
CODE_LINE = regex.compile(
    r"^\s*(?:=|\{=|Sub\s+\w+\s*\(|End (?:Sub|If|Function|With)|Dim\s+\w+|Set\s+\w+\s*=|For\s+(?:Each\s+)?\w+\s*(?:=|In\b)|Next(?:\s+\w{1,3})?\s*$|If\s+.*\bThen\b\s*$|Else\s*$|ElseIf\b|Do (?:While|Until)\b|Loop\b|With\s+\w+\.|Cells\(|Range\(|\w+\s*=\s*\w+\(.*\)\s*;?\s*$|def\s+\w+\(|return\b.*[;)]\s*$|import\s+\w+|#include|SELECT\b.*\bFROM\b|[\w.]+\([^)]*\)\s*;?\s*$|[{}]\s*;?\s*$|(?=.*\d)[\w.\"$:-]*(?: [\w.-]+){0,2}(?:[,;] ?[\w.\"$:-]*(?: [\w.-]+){0,2}){2,}\s*$)"
)
TABLE_LINE = regex.compile(r"^\s*\||\|.*\|.*\||^\s*[-+|: ]{3,}$|^[^\t\n]*(?:\t[^\t\n]*){2,}$")
BULLET = regex.compile(r"^\s*(?:[-*•·‣◦–—]|\(?\d{1,3}[.)]|\(?[a-z][.)]|#{1,6}|>+)\s+")
#: Dots of abbreviations, which end no sentence; looked for at dots only.
ABBREVIATION = regex.compile(r"\.(?:(?<=\b(?:e\.\s?g|i\.\s?e|approx|etc|cf|vs|fig|no|resp|incl|ca|dr|mr|mrs|ms|prof|z\.\s?b|d\.\s?h|bzw|usw|p\.\s?ej|sr|sra|par ex|al|eq|sec|ch|vol|pp)\.)|(?<=\be\.)(?=\s?g\.)|(?<=\bi\.)(?=\s?e\.)|(?<=\bz\.)(?=\s?b\.)|(?<=\bd\.)(?=\s?h\.)|(?<=\bp\.)(?=\s?ej\.))", regex.I)
ENDED = regex.compile(r"[.!?:;…]\s*$")
END = regex.compile(r"(?<=[.!?…。])[\"')\]»”]*\s+|;\s*\n|\n")
WORD = regex.compile(r"[\p{L}\p{M}]+(?:['’\-][\p{L}\p{M}]+)*")
CELL = regex.compile(r"\$?\b[A-Z]{1,3}\$?\d+(?::\$?[A-Z]{1,3}\$?\d+)?\b")


#: No line of code begins otherwise, unless it has one of =(){} or a list of numbers.
CODE_HEADS = ("Sub", "End ", "Dim", "Set", "For", "Next", "If", "Else", "Do ", "Loop", "With", "def", "return", "import", "#include", "SELECT")
NUMBER, ASCII_WORD = re.compile("[0-9]"), re.compile("[A-Za-z]+(?:['-][A-Za-z]+)*")
RULED = frozenset("-+|: \t\r\f\v")


def _no_prose(line: str) -> bool:
    """A line of a table or of code; the patterns are tried only where their marks are."""
    if ("|" in line or "\t" in line or line[0] in RULED and set(line) <= RULED or not line.isascii() and not line[0].isalnum()) and TABLE_LINE.search(line):
        return True
    if not line.isascii() or "=" in line or "(" in line or "{" in line or "}" in line or ("," in line or ";" in line) and NUMBER.search(line) or line.lstrip().startswith(CODE_HEADS):
        return CODE_LINE.match(line) is not None
    return False


def _unbulleted(line: str) -> str:
    bare = line.lstrip()
    head = bare[0]
    if head.isalpha() and bare[1:2] not in (".", ")"):
        return line
    return BULLET.sub("", line)


def prose_sentences(text: str) -> list[str]:
    """Sentences of a text's prose: no code, formulas or tables; a list item ends a sentence."""
    text = (text if text.isascii() else unicodedata.normalize("NFKC", text)).replace("\r\n", "\n").replace("\r", "\n")
    text = FENCE.sub("\n\n", text) if "```" in text or "~~~" in text else text
    text = TAGS.sub("\n", text) if "<" in text else text
    text = INLINE.sub(" ", text) if "`" in text else text
    lines: list[str] = []
    for line in text.split("\n"):
        if not line or line.isspace():
            lines.append("")
        elif not _no_prose(line):
            bare = _unbulleted(line)
            # a wrapped line goes on with a small letter; a list item or a new line doesn't
            if lines and lines[-1] and bare == line and bare.lstrip()[:1].islower() and not ENDED.search(lines[-1]):
                lines[-1] += " " + bare.strip()
            else:
                lines.append(bare.strip())
    joined = "\n".join(lines)
    joined = FORMULA.sub(" ", joined) if "=" in text else joined
    return [s for s in END.split(ABBREVIATION.sub("․", joined)) if s]


def words_of(sentence: str) -> list[str]:
    """Words without cell names, which are no words."""
    if NUMBER.search(sentence) or not sentence.isascii():
        sentence = CELL.sub(" ", sentence)
    return ASCII_WORD.findall(sentence) if sentence.isascii() else WORD.findall(sentence)


def language(words: list[str]) -> str:
    """The language of most words: Hangul by script, the others by their frequent words."""
    if not words:
        return ""
    times = Counter(words)
    if sum(n for w, n in times.items() if "가" <= w[0] <= "힣") * 3 > len(words):
        return "ko"
    votes = {lang: sum(times[w] for w in times.keys() & known) for lang, known in _SETS.items()}
    best = max(votes, key=votes.get)
    return best if votes[best] >= max(1, 0.06 * len(words)) else ""


VOWEL_RUN = regex.compile(r"[aeiouyàâäáãåèéêëìíîïòóôöõùúûüœæÿ]+")
@lru_cache(maxsize=1 << 17)
def syllables(word: str, lang: str = "en") -> int:
    """Syllables of a lower-case word: runs of vowels, corrected at the places where
    English hyphenation splits a run or keeps a written vowel silent."""
    if lang == "ko":
        return max(1, sum(1 for c in word if "가" <= c <= "힣"))
    runs = VOWEL_RUN.findall(word)
    if lang != "en":
        count = len(runs)
        if lang == "fr" and count > 1 and regex.search(r"[^aeiouéèêy](?:e|es|ent)$", word):
            count -= 1
        if lang == "es":
            count += sum(1 for r in runs if regex.search(r"[aeoáéó][aeoáéó]|[íú][aeo]|[aeo][íú]", r))
        return max(1, count)
    count = len(runs)
    if regex.search(r"[^aeiouyl]e$|[aeiouy]le$", word) or regex.search(r"[^aeiouytd]ed$|[^aeioucsgzxy]es$", word) and not regex.search(r"[^aeiouyrwl]les$", word):
        count -= 1
    if regex.search(r"[^aeiouy]e(?:ly|ment|ments|ful|less|ness)$", word):
        count -= 1
    count += len(regex.findall(r"ia(?!l|n$|ns$|nce|nt|ble)|(?<![ctgsx])ia(?=l|n|b)|io(?!us|n)|(?<![ctgsx])io(?=us|n)|iu|[^gq]ua|(?<!p)eo(?!u)|(?<![cgt])eou|(?<=[aeiouy].{0,9})[^aeiouy]ea$|^(?:re)?creat|[aeou]ing|uou|y[aio]|sm$|sms$", word))
    return max(1, count)


APOSTROPHE, SUFFIX = regex.compile(r"['’\-]"), regex.compile(r"(?:ed|es|ing)$")


@lru_cache(maxsize=1 << 17)
def weigh(word: str, lang: str) -> tuple[int, int, bool, bool]:
    """Letters, syllables, whether a word is long, and whether it is hard (three syllables or
    more, not counting an ending, and not compound)."""
    if word.isupper() and len(word) > 1:  # a function's name is read as a short word
        return 5, 2, False, False
    low = word.lower()
    parts = [p for p in APOSTROPHE.split(low) if p]
    each = sum(syllables(p, lang) for p in parts)
    return len(word), each, len(word) > 6, each >= 3 and "-" not in word and not (each == 3 and bool(SUFFIX.search(low)))


class _Words(dict):
    """word -> its number; asking for a new word numbers it."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


#: A task forgets its words when it holds so many; this bounds memory, not the result.
MOST_WORDS = 400_000
#: Texts that are counted together.
ROWS = 1024


class WordCounter:
    """Counts of many texts at once: each different word is looked at once, and the rest is
    adding up arrays of word numbers."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.words = _Words()
        #: of each word: votes for each language but Korean, Hangul, a capital in front
        self.kinds = np.zeros((0, 6), dtype=bool)
        #: by language, of each word: letters, syllables, long, hard; -1 where not yet weighed
        self.weights: dict[str, np.ndarray] = {}

    def _learn(self) -> None:
        new = list(self.words)[len(self.kinds) :]
        if new:
            rows = [[*(w.lower() in _SETS[lang] for lang in _SETS), "가" <= w[0] <= "힣", w[0].isupper()] for w in new]
            self.kinds = np.concatenate([self.kinds, np.array(rows, dtype=bool)])

    def _weights(self, lang: str, numbers: np.ndarray) -> np.ndarray:
        known = self.weights.get(lang, np.zeros((0, 4), dtype=np.int32))
        if len(known) < len(self.kinds):
            known = np.concatenate([known, np.full((len(self.kinds) - len(known), 4), -1, dtype=np.int32)])
        new = np.unique(numbers[known[numbers, 0] < 0])
        if len(new):
            if not hasattr(self, "_names") or len(self._names) != len(self.words):
                self._names = list(self.words)
            known[new] = [weigh(self._names[k], lang) for k in new.tolist()]
        self.weights[lang] = known
        return known

    def counts(self, texts: list[str | None]) -> list[dict]:
        """Words, sentences, letters, syllables, hard words, and the language of each text's prose."""
        if len(self.words) > MOST_WORDS:
            self.forget()
        flat, sizes, owner = array("l"), [], []
        number = self.words.__getitem__
        for k, text in enumerate(texts):
            for sentence in prose_sentences(text) if text else ():
                found = words_of(sentence)
                if found:
                    flat.extend(map(number, found))
                    sizes.append(len(found))
                    owner.append(k)
        self._learn()
        n = len(texts)
        word = np.frombuffer(flat, dtype=np.int64) if len(flat) else np.zeros(0, np.int64)
        size, owner_ = np.array(sizes, dtype=np.int64), np.array(owner, dtype=np.int64)
        doc = np.repeat(owner_, size)
        every = np.bincount(doc, minlength=n)
        add = lambda values, at: np.bincount(at, weights=values, minlength=n).astype(np.int64)
        kinds = self.kinds[word]
        votes = np.stack([add(kinds[:, k], doc) for k in range(4)])
        best = votes.argmax(axis=0)
        told = votes.max(axis=0) >= np.maximum(1, 0.06 * every)
        korean = add(kinds[:, 4], doc) * 3 > every
        # headings, greetings and labels are no sentences
        real = size >= np.where(korean[owner_], 2, 3) if len(size) else np.zeros(0, bool)
        inside, first = np.repeat(real, size), np.zeros(len(word), bool)
        first[np.cumsum(size) - size] = True
        names = list(_SETS)
        langs = ["ko" if ko else names[b] if t and e else "" for ko, b, t, e in zip(korean, best, told, every, strict=True)]
        out = np.zeros((4, n), dtype=np.int64)
        kind = np.array([(*LANGUAGES, "").index(lang) for lang in langs], dtype=np.int64)
        for k, lang in enumerate((*LANGUAGES, "")):
            mine = np.flatnonzero(inside & (kind[doc] == k)) if len(doc) else np.zeros(0, np.int64)
            if len(mine):
                w = self._weights(lang, word[mine])[word[mine]]
                hard = w[:, 3] * (first[mine] | ~kinds[mine, 5])
                for row, values in enumerate((w[:, 0], w[:, 1], w[:, 2], hard)):
                    out[row] += add(values, doc[mine])
        read = np.bincount(doc[inside], minlength=n)
        said = np.bincount(owner_[real], minlength=n)
        return [{"lang": langs[k], "words": int(read[k]), "sentences": int(said[k]), "letters": int(out[0, k]), "syllables": int(out[1, k]), "long": int(out[2, k]), "hard": int(out[3, k])} for k in range(n)]


def grades(c: dict) -> dict[str, float]:
    """Grade estimates of a language's classic formulas, in school years."""
    n, s = c["words"], c["sentences"]
    if not n or not s:
        return {}
    per_sentence, per_word, letters = n / s, c["syllables"] / n, c["letters"] / n
    ease_to_grade = lambda e: (100 - e) / 5.0
    if c["lang"] == "de":
        return {"amstad": ease_to_grade(180 - per_sentence - 58.5 * per_word), "wiener": 0.2656 * per_sentence + 0.2744 * 100 * c["hard"] / n - 1.693, "lix": (per_sentence + 100 * c["long"] / n) / 4 - 2}
    if c["lang"] == "es":
        return {"huerta": ease_to_grade(206.84 - 60 * per_word - 1.02 * per_sentence), "szigriszt": ease_to_grade(206.835 - 62.3 * per_word - per_sentence), "lix": (per_sentence + 100 * c["long"] / n) / 4 - 2}
    if c["lang"] == "fr":
        return {"kandel": ease_to_grade(207 - 1.015 * per_sentence - 73.6 * per_word), "lix": (per_sentence + 100 * c["long"] / n) / 4 - 2}
    if c["lang"] == "ko":
        return {"length": 0.9 * per_sentence + 1.1, "syllables": 2.2 * per_word + 0.35 * per_sentence}
    return {
        "kincaid": 0.39 * per_sentence + 11.8 * per_word - 15.59,
        "fog": 0.4 * (per_sentence + 100 * c["hard"] / n),
        "smog": 1.043 * math.sqrt(30 * c["hard"] / s) + 3.1291,
        "coleman_liau": 5.88 * letters - 29.6 * s / n - 15.8,
        "ari": 4.71 * letters + 0.5 * per_sentence - 21.43,
    }


def levels(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, prose_lang, words, sentences, raw_level (median of the grades) of each row.

    A text with hardly any prose (null, blank, code only) has a null level and the words it
    has; a language that can't be told is ''.  Rows map one to one, nothing is exchanged,
    texts are read whole, and other columns are ignored, whatever their names.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = WordCounter()
        for batch in batches:
            out, texts = [], list(batch["t"])
            for c in (c for at in range(0, len(texts), ROWS) for c in counter.counts(texts[at : at + ROWS])):
                enough = c["words"] >= LEAST_WORDS and c["sentences"] >= LEAST_SENTENCES
                g = grades(c) if enough else {}
                out.append((c["lang"], c["words"], c["sentences"], median(g.values()) if g else None))
            frame = pd.DataFrame(out, columns=["prose_lang", "words", "sentences", "raw_level"]).astype({"raw_level": "float64"})
            frame.insert(0, "k", batch["k"].values)
            yield frame

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInPandas(run, f"k {kind}, prose_lang string, words bigint, sentences bigint, raw_level double").withColumnRenamed("k", key)


def rising_curve(x: list[float], y: list[float]) -> tuple[list[float], list[float]]:
    """Knots of the best rising curve (least squares, pooling neighbours that fall)."""
    blocks: list[list[float]] = []
    for a, b in sorted(zip(x, y, strict=True)):
        blocks.append([a, b, 1.0])
        while len(blocks) > 1 and (blocks[-2][1] >= blocks[-1][1] or blocks[-2][0] >= blocks[-1][0]):
            a2, b2, n2 = blocks.pop()
            a1, b1, n1 = blocks.pop()
            n = n1 + n2
            blocks.append([(a1 * n1 + a2 * n2) / n, (b1 * n1 + b2 * n2) / n, n])
    return [b[0] for b in blocks], [b[1] for b in blocks]


def fit_people(measured: DataFrame, labels: DataFrame, key: str = "doc_id") -> tuple[list[float], list[float]]:
    """Knots from raw levels to people's grades; a document's grade is the median of its
    raters.  Without two labelled documents of different level there are no knots, and the
    raw level itself is used."""
    people = labels.filter(f"{key} is not null and grade is not null").groupBy(key).agg(F.percentile("grade", F.lit(0.5)).alias("grade"))
    both = measured.filter("raw_level is not null and prose_lang = 'en'").join(people, key).limit(MOST_LABELS + 1).select("raw_level", "grade").toPandas()
    if len(both) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labelled documents")
    knots = rising_curve(list(both["raw_level"]), list(both["grade"]))
    return knots if len(knots[0]) > 1 else ([], [])


def reading_levels(df: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """:func:`levels` with ``level``, the school years that the text asks for.

    Only the labelled documents are measured for the fit, so the corpus is read once for
    the keys of it and once for the result.  Between the knots the curve is straight, beyond
    them level with the last one.  Labels are English; other languages' formulas give
    school years of their own and stay as they are.
    """
    x: list[float] = []
    y: list[float] = []
    if labels is not None:
        labelled = df.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
        x, y = fit_people(levels(labelled), labels)
    raw = F.col("raw_level")
    fitted = raw if not x else F.lit(y[-1])
    for k in reversed(range(1, len(x))):
        fitted = F.when(raw < x[k], F.lit(y[k - 1]) + (raw - x[k - 1]) * ((y[k] - y[k - 1]) / (x[k] - x[k - 1]))).otherwise(fitted)
    fitted = F.when(raw <= x[0], F.lit(y[0])).otherwise(fitted) if x else fitted
    level = F.when(raw.isNull(), None).when(F.col("prose_lang") == "en", fitted).otherwise(raw)
    return levels(df).withColumn("level", F.round(level, 2))


def university_prose(read: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys of the English documents whose prose asks for university reading."""
    return read.filter((F.col("prose_lang") == "en") & (F.col("level") >= UNIVERSITY)).select(key)
