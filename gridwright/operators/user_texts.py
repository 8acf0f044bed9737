"""Similarity of all pairs of one user's texts, by blocks of distinct texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PUNCTUATION = re.compile(r"[^\w\s]")
#: Distinct texts of a user in a block, on average; a task holds two blocks at a time.
BLOCK = 1024
#: Pairs of rows above which a trigram is counted by a matrix product, and pairs listed at once.
DENSE, LISTED = 16_384, 2_000_000


def trigrams(text: str) -> set[str]:
    """Trigrams of a text without its punctuation."""
    text = PUNCTUATION.sub("", text)
    return {text[k : k + 3] for k in range(len(text) - 2)}


def _incidence(sets: list[set], number: dict) -> tuple[np.ndarray, np.ndarray]:
    at = np.fromiter((number[g] for s in sets for g in s if g in number), np.int64)
    row = np.repeat(np.arange(len(sets)), [sum(g in number for g in s) for s in sets])
    order = np.argsort(at, kind="stable")
    return at[order], row[order]


def shared_counts(left: list[set], right: list[set]) -> np.ndarray:
    """Common elements of each set of ``left`` with each of ``right``, exactly.

    Frequent elements are counted by a product of 0/1 matrices, rare ones by listing the pairs.
    """
    number = {g: k for k, g in enumerate(set().union(*left) & set().union(*right))}
    found = np.zeros(len(left) * len(right), dtype=np.int64)
    if not number:
        return found.reshape(len(left), len(right))
    (lat, lrow), (rat, rrow) = _incidence(left, number), _incidence(right, number)
    ln, rn = np.bincount(lat, minlength=len(number)), np.bincount(rat, minlength=len(number))
    start = np.cumsum(rn) - rn
    many = ln * rn > DENSE
    dense = np.flatnonzero(many)
    for part in np.array_split(dense, len(dense) // 2048 + 1):
        place = np.full(len(number), -1)
        place[part] = np.arange(len(part))
        x, y = np.zeros((len(left), len(part)), np.float32), np.zeros((len(right), len(part)), np.float32)
        for at, row, m in ((lat, lrow, x), (rat, rrow, y)):
            m[row[place[at] >= 0], place[at][place[at] >= 0]] = 1
        found += (x @ y.T).astype(np.int64).ravel()
    keep = ~many[lat]
    lat, lrow = lat[keep], lrow[keep]
    size = rn[lat]
    chunk = np.cumsum(size) // LISTED
    for begin, end in zip(*(np.searchsorted(chunk, np.unique(chunk), side) for side in ("left", "right")), strict=True):
        n = size[begin:end]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found += np.bincount(np.repeat(lrow[begin:end], n) * len(right) + rrow[np.repeat(start[lat[begin:end]], n) + inside], minlength=len(found))
    return found.reshape(len(left), len(right))


def block_sums(left: list[tuple[str, int]], right: list[tuple[str, int]] | None) -> tuple[float, float]:
    """Sum and greatest Jaccard over pairs of (text, copies) of two blocks, or within one."""
    a = [trigrams(t) for t, _ in left]
    b = a if right is None else [trigrams(t) for t, _ in right]
    na = np.array([n for _, n in left], dtype=np.float64)
    nb = na if right is None else np.array([n for _, n in right], dtype=np.float64)
    common = shared_counts(a, b)
    whole = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - common
    ratio = common / np.maximum(whole, 1)
    times = na[:, None] * nb[None, :]
    if right is None:
        times = np.triu(times, 1) + np.diag(na * (na - 1) / 2)
    return float((ratio * times).sum()), float(np.where(times > 0, ratio, 0).max())


def user_similarity(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """user, n, mean, most: trigram Jaccard over all pairs of a user's ``n`` texts (n > 1).

    Equal texts are one row with a count.  A user's distinct texts are dealt to blocks by hash,
    and each pair of blocks is one unit of work, so a hot user is spread over many tasks.
    Every pair is compared: the work grows with the square of a user's distinct texts.
    """
    texts = rows.filter("user is not null and text is not null").groupBy("user", "text").agg(F.count(F.lit(1)).alias("copies"))
    users = texts.groupBy("user").agg(F.sum("copies").alias("n"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).filter("n > 1")
    dealt = texts.join(users.select("user", "blocks"), "user").withColumn("own", F.pmod(F.xxhash64("text"), F.col("blocks")).cast("int"))
    both = dealt.select("user", "text", "copies", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    units = both.select("user", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "text", "copies").repartition("user", "i", "j").sortWithinPartitions("user", "i", "j", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out = []
        for (user, i, j), unit in groupby(stream(), key=lambda r: r[:3]):
            sides: tuple[list, list] = ([], [])
            for r in unit:
                sides[r[3] != i].append((r[4], r[5]))
            if i == j or (sides[0] and sides[1]):
                out.append((user, *block_sums(sides[0], None if i == j else sides[1])))
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    found = units.mapInArrow(run, "user string, total double, most double").groupBy("user").agg(F.sum("total").alias("total"), F.max("most").alias("most"))
    return users.join(found, "user").select("user", "n", (F.col("total") / (F.col("n") * (F.col("n") - 1) / 2)).alias("mean"), "most")


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["user", "total", "most"])
