"""Encoding of a whole corpus with a public byte-level BPE vocabulary (problem 6).

Texts are split by the vocabulary's pattern; each distinct word is encoded once per worker.
All new words of a batch lie in one flat array of symbols.  A merge round looks up every
adjacent pair by binary search over the sorted pair keys, takes each word's lowest rank and
merges all its occurrences at once; words without a mergeable pair leave the array.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Vocabulary file on the driver; public, see its README.  Never copied into this repository.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
#: The pattern that splits text before the merges (fixed value of the vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A worker forgets its words when it holds so many; this bounds memory, not the result.
MOST_WORDS = 400_000
#: Rows that are encoded together.
ROWS = 1024
NEVER = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Words(dict):
    """word -> its number; asking for a new word numbers it."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class ByteBpe:
    """The vocabulary as arrays, and the words that were encoded so far."""

    def __init__(self, path: str = BYTE_BPE):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        self.first = np.array([vocab[s] for s in byte_symbols()], dtype=np.int64)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.split = regex.compile(PATTERN).findall
        self.forget()

    def forget(self) -> None:
        self.words, self.known = _Words(), 0
        self.ids, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        raw = [w.encode("utf-8") for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.first[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            last = np.append(word[1:] != word[:-1], True)
            pair = symbols * self.size
            pair[:-1] += symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[at] == pair) & ~last, self.ranks[at], NEVER)
            start = np.flatnonzero(np.append(True, last[:-1]))
            least = np.minimum.reduceat(rank, start)
            best = np.repeat(least, np.diff(np.append(start, len(symbols))))
            ended = best == NEVER
            if ended.any():
                done_symbols.append(symbols[ended])
                done_words.append(word[ended])
                symbols, word, rank, best = symbols[~ended], word[~ended], rank[~ended], best[~ended]
                if not len(symbols):
                    break
            hit = rank == best
            if (hit[1:] & hit[:-1]).any():  # a run like aaa: from the left, every other one
                place = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, -1))
                hit &= (place - begin) % 2 == 0
            where = np.flatnonzero(hit)
            symbols[where] = self.merged[rank[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            symbols, word = symbols[keep], word[keep]
        symbols, word = np.concatenate(done_symbols or [symbols]), np.concatenate(done_words or [word])
        order = np.argsort(word, kind="stable")
        return symbols[order].astype(np.int32), np.bincount(word, minlength=len(raw))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has; null and empty texts have none."""
        if len(self.words) > MOST_WORDS:
            self.forget()
        pieces, counts, number = array("l"), [], self.words.__getitem__
        for text in texts:
            before = len(pieces)
            if text:
                pieces.extend(map(number, self.split(text)))
            counts.append(len(pieces) - before)
        if len(self.words) > self.known:
            new = list(self.words)[self.known :]
            ids, lengths = self.merge(new)
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths) - lengths)
            self.ids, self.lengths, self.known = np.append(self.ids, ids), np.append(self.lengths, lengths), len(self.words)
        piece = np.frombuffer(pieces, dtype=np.int64) if len(pieces) else np.zeros(0, np.int64)
        size = self.lengths[piece]
        ends = np.cumsum(size)
        flat = self.ids[np.repeat(self.starts[piece] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.append(0, ends)[np.append(0, np.cumsum(counts)).astype(np.int64)]
        return flat, np.diff(upto)


_LOADED: dict[str, ByteBpe] = {}


def vocabulary(name: str) -> ByteBpe:
    """The vocabulary of a shipped file, loaded once per process."""
    if name not in _LOADED:
        _LOADED[name] = ByteBpe(SparkFiles.get(name))
    return _LOADED[name]


def shipped(spark: SparkSession, path: str) -> str:
    """Send the vocabulary's file along with the job, so that only the driver needs the folder;
    the name by which :func:`vocabulary` finds it on any machine."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = BYTE_BPE) -> DataFrame:
    """``key`` and ``ids`` (ARRAY<INT>) of each row, without special tokens.

    Null and empty texts have the empty list.  Text that looks like a special token is
    ordinary text.  Rows map one to one - repeated and null keys too - and nothing is
    exchanged.  Other columns are ignored, whatever their names.
    """
    kind, name = df.schema[key].dataType.simpleString(), shipped(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(name)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                flat, counts = bpe.encode(part.column(1).to_pylist())
                offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat))], ["k", "ids"])

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(run, f"k {kind}, ids array<int>").select(F.col("k").alias(key), "ids")


def count_tokens(df: DataFrame, text: str = "text", path: str = BYTE_BPE, name: str = "n_tokens") -> DataFrame:
    """All columns of ``df`` but the text, and the text's number of ids (0 if null or empty)."""
    rest, file = df.drop(text), shipped(df.sparkSession, path)
    names = [*rest.columns, name]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema) + f", `{name}` bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(file)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                counts = bpe.encode(part.column(part.num_columns - 1).to_pylist())[1]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(counts.astype(np.int64))], names)

    return df.select(*[F.col(f"`{c}`") for c in rest.columns], F.col(text)).mapInArrow(run, schema)
