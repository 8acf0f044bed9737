"""Deduplicating new batches against all history (problem 2).

An index on disk holds what was accepted: record keys, distinct titles, and an inverted file
of cells.  A title's vector (:mod:`gridwright.llm.titles`) lies in the cells of its longest
coordinates; a query probes its own longest coordinates until the rest of its vector is too
short for any title of cosine ``BOUND`` or more, so a title in no probed cell can't be nearer
than that.  What shares enough of the probed cells is compared as text.

Keys, titles and cells are each dealt to folders by hash, so a batch reads only the folders
of its own keys and cells, and of the titles that these cells leave to compare.  A batch is
checked against the index and itself, then appended as folders of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridwright.llm.titles import Weights, normal, same_question, tokens
from gridwright.session import scratch_path, written

#: Cosine of token vectors below which two titles are not compared.
BOUND = 0.3
#: Most that coordinates outside the probed ones add to a cosine: each side's rest is shorter
#: than BOUND, so their product is below BOUND squared.
REST = BOUND * BOUND
#: A token is frequent, with a weight of its own, if it is in so many titles of its source and
#: in so many of Weights.RARE; so the frequent ones of a source are some 100,000 at most.
FREQUENT = 5
#: Different tokens that a task counts before it writes the counts out.
COUNTED = 200_000
#: Tokens of one count that share a row of a task's counts at most.
PACKED = 500
#: Titles of a cell that are compared first, where a cell holds more than so many.
FIRSTS = 24
#: About so many rows of the start share a folder of the index, of which there are at most
#: MOST_BUCKETS: their numbers are all that a check collects.
BUCKET_ROWS, MOST_BUCKETS = 100_000, 1 << 15
#: Rows of ids that are sent to every task rather than exchanged; each has 16 bytes or less.
SENT_ROWS = 500_000
#: What a source's titles are counted under, among its tokens.
TITLES = "\0"
#: Place of history in the order of records: before every item.
BEFORE = -(1 << 62)


def record_key(source: Column, raw: Column) -> Column:
    """The community's key, however a collector wrote it; null if there is none.

    stackoverflow and oppadu: a number, in a path or query, with a prefix or suffix, with
    leading zeros or a decimal point.  reddit: a base-36 id in any case, bare, in a path or
    with its kind in front.  Other sources: the text itself, trimmed, in small letters.
    """
    text = F.trim(F.regexp_replace(F.lower(raw.cast("string")), r"^\s+|\s+$", ""))
    path_number = F.regexp_extract(text, r"(?:/(?:questions|q|a|question|answers?)/|uid=|[?&]id=)(\d+)", 1)
    number = F.when(path_number != "", path_number).otherwise(F.regexp_extract(F.regexp_replace(text, r"\.0+$", ""), r"(\d+)(?!.*\d)", 1))
    digits = F.regexp_replace(number, r"^0+(?=\d)", "")
    path_id = F.regexp_extract(text, r"(?:/comments/|redd\.it/)([0-9a-z]+)", 1)
    reddit = F.when(path_id != "", path_id).otherwise(F.regexp_extract(text, r"^(?:t[1-6]_|reddit[_:-])?([0-9a-z]+)$", 1))
    key = F.when(source.isin("stackoverflow", "oppadu"), digits).when(source == "reddit", reddit).otherwise(text)
    # most keys are written plainly, and then none of the patterns above is tried
    plainly = F.when(source.isin("stackoverflow", "oppadu"), raw.cast("string").rlike("^[1-9][0-9]*$")).when(source == "reddit", raw.cast("string").rlike("^[0-9a-z]+$"))
    return F.when(plainly, raw.cast("string")).when(key != "", key)


def _values(batch: pa.RecordBatch, *columns: int) -> Iterator[tuple]:
    """Rows of some columns without null numbers; several times faster than to_pylist."""
    return zip(*(batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in columns), strict=True)


def with_vectors(rows: DataFrame, weights: Weights) -> DataFrame:
    """source, ord, key of rows (source, ord, key, title), and of a title that names a workbook,
    range or number ``norm``, the normal title, ``vid``, its id, and ``cells``, its cells.

    Other titles, and missing ones, have nulls: they can't be a question about the same
    workbook and range.
    """
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = shared.value.probes
        for batch in batches:
            norms, cells, parts = [], [], []
            for source, title in _values(batch, 0, 3):
                text = normal(title)
                found, names = tokens(text) if text else ((), False)
                norms.append(text if names else None)
                names_, lengths = probes(source, found, BOUND) if names else (None, None)
                cells.append(names_)
                parts.append(lengths)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(norms, pa.string()), pa.array(cells, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float32()))], ["source", "ord", "key", "norm", "cells", "parts"])

    out = rows.select("source", "ord", "key", "title").mapInArrow(run, "source string, ord bigint, key string, norm string, cells array<string>, parts array<float>")
    return out.select("source", "ord", "key", "norm", F.when(F.col("norm").isNotNull(), title_id()).alias("vid"), hashed_cells().alias("cells"), "parts")


def title_id() -> Column:
    return F.xxhash64("source", "norm")


def hashed_cells() -> Column:
    return F.transform("cells", lambda c: F.xxhash64("source", c))


def with_tokens(rows: DataFrame) -> DataFrame:
    """source, key of rows (source, key, title), and of a title that names a workbook, range or
    number ``norm``, the normal title, and ``found``, its tokens between blanks; besides rows
    (source, token, n): tokens between blanks that a task met in n of the source's titles each.

    A task gives a key and a title that it has met before as nulls, so what many rows share is
    not sent on many times.  It counts the tokens of every title; most are met once or twice, so
    up to PACKED tokens of the same count make a row.
    """
    names = ["source", "key", "norm", "found", "token", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = set(), {}

        def counted() -> pa.RecordBatch:
            flat = []
            for source, known in counts.items():
                flat.append((source, TITLES, known.pop(TITLES)))
                alike: dict[int, list[str]] = {}
                for t, n in known.items():
                    alike.setdefault(n, []).append(t)
                flat += [(source, " ".join(ts[k : k + PACKED]), n) for n, ts in alike.items() for k in range(0, len(ts), PACKED)]
            counts.clear()
            source, token, n = zip(*flat, strict=True) if flat else ((), (), ())
            none = pa.nulls(len(flat), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(source, pa.string()), none, none, none, pa.array(token, pa.string()), pa.array(n, pa.int64())], names)

        for batch in batches:
            if len(seen) > 1_000_000:  # bounds memory; what comes again is only sent again
                seen.clear()
            keys, norms, words, met = [], [], [], {}
            for source, key, title in _values(batch, 0, 1, 2):
                text = normal(title)
                found, named = tokens(text) if text else ((), False)
                if title is not None:
                    met.setdefault(source, []).append(found)
                mine, theirs = hash((source, 0, key)), hash((source, 1, text))
                keys.append(None if mine in seen else key)
                named = named and theirs not in seen
                seen.update((mine, theirs))
                norms.append(text if named else None)
                words.append(" ".join(found) if named else None)
            for source, sets in met.items():
                known = counts.setdefault(source, Counter())
                known.update(chain.from_iterable(sets))
                known[TITLES] += len(sets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.string()), pa.array(norms, pa.string()), pa.array(words, pa.string()), pa.nulls(len(keys), pa.string()), pa.nulls(len(keys), pa.int64())], names)
            if sum(map(len, counts.values())) > COUNTED:
                yield counted()
        yield counted()

    return rows.select("source", "key", "title").mapInArrow(run, "source string, key string, norm string, found string, token string, n bigint")


def with_cells(rows: DataFrame, weights: Weights) -> DataFrame:
    """vid, cells, parts of titles (source, norm, found)."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = shared.value.probes
        for batch in batches:
            both = [probes(source, found.split(" "), BOUND) for source, found in _values(batch, 0, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c for c, _ in both], pa.list_(pa.string())), pa.array([p for _, p in both], pa.list_(pa.float32()))], ["source", "vid", "cells", "parts"])

    out = rows.select("source", title_id().alias("vid"), "found").mapInArrow(run, "source string, vid bigint, cells array<string>, parts array<float>")
    return out.select("vid", hashed_cells().alias("cells"), "parts")


def in_cells(titles: DataFrame, *rest: str) -> DataFrame:
    """(cell, part, vid) for each cell of each title; part is the unit vector's coordinate there."""
    both = titles.select(F.explode(F.arrays_zip("cells", "parts")).alias("_c"), "vid", *rest)
    return both.select(F.col("_c.cells").alias("cell"), F.col("_c.parts").alias("part"), "vid", *rest)


def fit_weights(counts: DataFrame) -> tuple[Weights, int]:
    """Weights from the tasks' counts (source, tokens, n) of all titles, and the number of titles.

    A token that is in ``least`` of a source's titles is in ``least / parts`` of those of one of
    its ``parts`` counts at least.  Only tokens for which that holds somewhere are added up, from
    all counts: the sums are exact, and the many rare tokens are not exchanged.
    """
    sizes = counts.filter(F.col("token") == TITLES).groupBy("source").agg(F.sum("n").alias("titles"), F.count(F.lit(1)).alias("parts")).collect()
    titles = {r["source"]: r["titles"] for r in sizes}
    least = {s: max(FREQUENT, -(-FREQUENT * n // Weights.RARE)) for s, n in titles.items()}
    if not titles:
        return Weights({}, {}), 0

    def by_source(values: dict[str, int]) -> Column:
        return F.coalesce(*[F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(v)) for s, v in values.items()])

    def single(packed: DataFrame) -> DataFrame:
        return packed.select("source", F.explode(F.split("token", " ")).alias("token"), "n")

    tokens_ = counts.filter(F.col("token") != TITLES)
    maybe = single(tokens_.filter(F.col("n") >= by_source({r["source"]: -(-least[r["source"]] // r["parts"]) for r in sizes})))
    counted = Observation()
    maybe = maybe.select(F.col("source").alias("s"), F.col("token").alias("t")).distinct()
    maybe = written(maybe.observe(counted, F.count(F.lit(1)).alias("n")), "maybe-frequent")
    # a token is longer than an id: a tenth of the rows is sent at most
    sums = single(tokens_).join(_sent(maybe, 10 * counted.get.get("n", 0)), F.expr("source <=> s and token = t"), "left_semi").groupBy("source", "token").agg(F.sum("n").alias("n"))
    found = sums.filter(F.col("n") >= by_source(least)).collect()
    return Weights(titles, {(r["source"], r["token"]): r["n"] for r in found}), sum(titles.values())


SCHEMAS = {"keys": "source string, key string", "titles": "vid bigint, norm string", "cells": "cell bigint, part float, vid bigint"}


def _sent(ids: DataFrame, rows: int) -> DataFrame:
    """Ids that are sent to every task if they are SENT_ROWS at most, else exchanged."""
    return F.broadcast(ids) if rows <= SENT_ROWS else ids


class HistoryIndex:
    """The index in a folder: ``keys``, ``titles`` and ``cells``, each in folders batch / bucket
    and only ever appended to, and the weights and number of buckets, which stay as built."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.weights, self.buckets = spark, path or scratch_path(spark, "history"), None, 0
        #: of the last check: buckets read and rows taken from them, by table
        self.read: dict[str, tuple[int, int]] = {}

    def _bucket(self, name: str) -> Column:
        hashed = {"keys": F.xxhash64("source", "key"), "titles": F.col("vid"), "cells": F.col("cell")}[name]
        return F.pmod(hashed, F.lit(self.buckets)).cast("int")

    def _append(self, name: str, batch: str, rows: DataFrame) -> None:
        # a folder a batch: adding a batch again, after a failure, replaces what it left behind;
        # rebalanced, not hashed: a folder that holds a third of all rows is split over tasks
        rows = rows.withColumn("bucket", self._bucket(name)).hint("rebalance", "bucket").sortWithinPartitions("bucket", *rows.columns[:1])
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/batch={batch}")

    def _take(self, name: str, asked: DataFrame, on: list[str]) -> DataFrame:
        """Rows of a table that match one of the asked ids, from the folders of these ids only.

        A row that was stored twice comes twice; it makes a pair or a match again, no other.
        """
        asked = written(asked.select(*on).distinct(), f"asked-{name}")
        found = asked.groupBy(self._bucket(name).alias("b")).count().collect()
        stored = self.spark.read.schema(SCHEMAS[name] + ", batch string, bucket int").parquet(f"{self.path}/{name}")
        stored = stored.filter(F.col("bucket").isin([r["b"] for r in found])).drop("batch", "bucket")
        many, seen = sum(r["count"] for r in found), Observation()
        taken = stored.join(_sent(asked, many), on, "left_semi").observe(seen, F.count(F.lit(1)).alias("n"))
        taken = written(taken, f"taken-{name}")
        self.read[name] = (len(found), seen.get.get("n", 0))
        return taken

    def _write_settings(self) -> None:
        w = self.weights
        rows = [(s, t, x) for s, known in w.square.items() for t, x in known.items()] + [(None, None, w.most), (None, "buckets", float(self.buckets))]
        self.spark.createDataFrame(rows, "source string, token string, square double").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/settings")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> HistoryIndex:
        """An index that was built earlier; its weights are as many as its sources have frequent tokens."""
        index = cls(spark, path)
        index.weights = Weights({}, {})
        for source, token, square in spark.read.parquet(f"{path}/settings").collect():
            if source is not None:
                index.weights.square.setdefault(source, {})[token] = square
            elif token is None:
                index.weights.most = square
            else:
                index.buckets = int(square)
        return index

    def build(self, history: DataFrame) -> HistoryIndex:
        """Start from the rows (source, key, title) of what was accepted so far."""
        path, rows = scratch_path(self.spark, "history"), with_tokens(history)
        rows.write.option("compression", "zstd").parquet(path)  # titles and their tokens are most of what is written
        rows = self.spark.read.schema(rows.schema).parquet(path)
        self.weights, many = fit_weights(rows.filter("n is not null").select("source", "token", "n"))
        self.buckets = min(MOST_BUCKETS, max(16, -(-many // BUCKET_ROWS)))
        self._write_settings()
        titled = rows.filter("norm is not null")
        self._append("keys", "start", rows.filter("key is not null").select("source", "key"))
        self._append("titles", "start", titled.select(title_id().alias("vid"), "norm"))
        self._append("cells", "start", in_cells(with_cells(titled, self.weights)))
        return self

    def check(self, items: DataFrame, batch: str = "batch", append: bool = True) -> DataFrame:
        """Ids of the items (source, ord, key, title) that repeat history or an item of smaller ord.

        ``ord`` must be unique and ascend with the batches.  Items without key or title are
        compared by what they have; an item with neither repeats nothing.  With ``append``
        the batch is added to the index, repeats too: a later item that means the same
        record or question is a repeat whichever of them it is compared with.
        """
        rows = written(with_vectors(items, self.weights), "items")
        keyed = rows.filter("key is not null").select("source", "key", "ord")
        by_history = keyed.join(self._take("keys", keyed, ["source", "key"]), ["source", "key"], "left_semi").select("ord")
        firsts = keyed.groupBy("source", "key").agg(F.min("ord").alias("first"))
        by_batch = keyed.join(firsts, ["source", "key"]).filter("ord > first").select("ord")
        # distinct titles of the batch; copies within it are settled by their first
        titled = rows.filter("vid is not null")
        titles = titled.groupBy("vid").agg(F.min("ord").alias("ord"), F.first("norm").alias("norm"), F.first("cells").alias("cells"), F.first("parts").alias("parts"))
        counted = Observation()
        titles = written(titles.observe(counted, F.count(F.lit(1)).alias("n")), "batch-titles")
        seen = counted.get.get("n", 0)
        mine = in_cells(titles, "ord")
        held = self._take("cells", mine, ["cell"])
        # a title that is stored lies in the very cells that its copy probes
        known = held.join(_sent(titles.select("vid"), seen), "vid", "left_semi").select("vid").distinct().withColumn("old", F.lit(True))
        titles = titles.join(known, "vid", "left")
        same = titled.select("vid", "ord").join(titles.select("vid", F.col("ord").alias("first"), "old"), "vid").filter("old or ord > first").select("ord")
        new = written(titles.filter("old is null").drop("old"), "new-titles")
        near = self._near(new, held)
        found = by_history.unionByName(by_batch).unionByName(same).unionByName(near).distinct()
        if append:
            found = written(found, "found")
            self._append("keys", batch, keyed.select("source", "key").distinct())
            self._append("titles", batch, new.select("vid", "norm"))
            self._append("cells", batch, in_cells(new))
        return found

    def _near(self, new: DataFrame, held: DataFrame) -> DataFrame:
        """``ord`` of the new titles that an earlier title matches.

        A cell may hold many near copies of one question, a third of all titles.  There a
        title meets the cell's FIRSTS earliest ones first, and only titles that match none of
        them meet the others, so copies don't meet in pairs; no match is lost.
        """
        mine = in_cells(new, "ord")
        every = held.withColumn("ord", F.lit(BEFORE)).unionByName(mine)
        probe = mine.select("cell", F.col("part").alias("q_part"), F.col("vid").alias("q"), F.col("ord").alias("q_ord"))
        # cells are counted by task before anything is exchanged; crowded ones are few
        counted = Observation()
        crowded = every.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FIRSTS).select("cell")
        crowded = written(crowded.observe(counted, F.count(F.lit(1)).alias("n")), "crowded")
        n = counted.get.get("n", 0)
        rest, settled = probe, None
        if n:
            inside = every.join(_sent(crowded, n), "cell", "left_semi")
            firsts = inside.groupBy("cell", F.pmod("vid", F.lit(FIRSTS)).alias("_salt")).agg(F.min(F.struct("ord", "vid")).alias("f")).select("cell", "f.ord", "f.vid")
            meet = firsts.join(probe, "cell").filter("ord < q_ord and vid <> q").select("q", F.col("vid").alias("o")).distinct()
            counted = Observation()
            settled = written(self._matching(meet, new).distinct().observe(counted, F.count(F.lit(1)).alias("n")), "settled")
            rest = probe.join(_sent(settled.withColumnRenamed("ord", "q_ord"), counted.get.get("n", 0)), "q_ord", "left_anti")
        met = every.join(rest, "cell").filter("ord < q_ord and vid <> q").select("q", F.col("vid").alias("o"), (F.col("part") * F.col("q_part")).alias("dot"))
        # what lies outside the probed coordinates adds less than the bound leaves
        pairs = met.groupBy("q", "o").agg(F.sum("dot").alias("dot")).filter(F.col("dot") >= BOUND - REST).select("q", "o")
        found = self._matching(pairs, new)
        return found if settled is None else settled.unionByName(found)

    def _matching(self, pairs: DataFrame, new: DataFrame) -> DataFrame:
        """``ord`` of each q of the pairs (q, o) of title ids whose titles are the same question."""
        pairs = written(pairs, "pairs")
        stored = self._take("titles", pairs.select(F.col("o").alias("vid")).join(new.select("vid"), "vid", "left_anti"), ["vid"])
        texts = stored.unionByName(new.select("vid", "norm"))
        sides = pairs.join(new.select(F.col("vid").alias("q"), F.col("ord").alias("q_ord"), F.col("norm").alias("a")), "q").select("o", "q_ord", "a")
        sides = sides.join(texts.select(F.col("vid").alias("o"), F.col("norm").alias("b")), "o").select("q_ord", "a", "b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = {o for o, x, y in _values(batch, 0, 1, 2) if same_question(x, y)}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(hits), pa.int64())], ["ord"])

        return sides.mapInArrow(run, "ord bigint")
