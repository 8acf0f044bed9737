"""Similarity joins, nearest neighbours and duplicate groups."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridwright.session import written


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(vector: Column) -> Column:
    """The vector at length 1; null, empty and zero vectors give null."""
    # the norm goes in as a field, so that it isn't computed again for each of the numbers
    with_norm = F.transform(F.array(F.struct(vector.alias("v"), F.sqrt(dot(vector, vector)).alias("n"))), lambda s: F.when(s["n"] > 0, F.transform(s["v"], lambda x: x.cast("double") / s["n"])))
    return F.element_at(with_norm, 1)


#: Vectors of a block, compared with another block in one matrix product: 2048 x 2048 numbers
#: of 8 bytes are all that a task holds beside the two blocks.
BLOCK = 2048


def _unit_bytes(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and the vector at length 1 as bytes; null, empty and zero vectors and null keys are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            start = np.append(0, np.cumsum(sizes))[:-1]
            norms = np.sqrt(np.add.reduceat(np.append(flat * flat, 0.0), start)) if len(sizes) else np.zeros(0)
            keep = np.flatnonzero((sizes > 0) & (norms > 0))
            packed = [(flat[start[k] : start[k] + sizes[k]] / norms[k]).tobytes() for k in keep]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(packed, pa.binary())], ["id", "v"])

    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id is not null and v is not null and not exists(v, x -> x is null or isnan(x))")
    return rows.mapInArrow(run, f"id {df.schema[key].dataType.simpleString()}, v binary")


def _placed(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """id, v, the nearest centre and the distance from it."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = shared.value
        for batch in batches:
            near = _matrix(batch.column(1).to_pylist(), middle.shape[1]) @ middle.T
            cell = near.argmax(axis=1)
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * near[np.arange(len(cell)), cell]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)], ["id", "v", "cell", "far"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, v binary, cell int, far double")


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows; one of another length than ``width`` is an error."""
    return np.frombuffer(b"".join(vectors), dtype=np.float64).reshape(len(vectors), width)


def similar_pairs(df: DataFrame, key: str, vector: str, least: float, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity): every pair a < b of different vectors of cosine ``least`` or more,
    exactly, and each copy of a vector with the first of its copies (similarity 1).

    Vectors lie in blocks of about ``block`` around their nearest centre.  Two blocks are
    compared, by one matrix product, unless their centres are so far apart that no vector of
    one can be near a vector of the other; pairs of single rows are never formed.  Centres
    are a ``block``-th of the vectors, drawn by the hash of their ids.
    Null, empty and zero vectors and null keys have no pair; an empty table gives no rows.
    """
    spark = df.sparkSession
    rows = written(_unit_bytes(df, key, vector), "unit-vectors")
    # equal vectors are compared once: copies are expanded only in the result
    distinct = written(rows.groupBy("v").agg(F.min("id").alias("id")).select("id", "v"), "vectors")
    count = -(-distinct.count() // block)
    kind = df.schema[key].dataType.simpleString()
    shape = f"a {kind}, b {kind}, similarity double"
    if not count:
        return spark.createDataFrame([], shape)
    drawn = [bytes(r["v"]) for r in distinct.orderBy(F.xxhash64("id"), "id").limit(count).select("v").collect()]
    width = len(drawn[0]) // 8
    centres = _matrix(drawn, width)
    placed = written(_placed(distinct, centres), "placed")
    # a crowded cell is split by hash; a block is (cell, part)
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
    first, blocks = {}, []
    for r in sorted(sizes, key=lambda r: r["cell"]):
        first[r["cell"]] = (len(blocks), -(-r["n"] // block))
        blocks += [(r["cell"], r["far"])] * first[r["cell"]][1]
    shared = spark.sparkContext.broadcast((first, centres[[c for c, _ in blocks]], np.array([f for _, f in blocks])))
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * least)) + 1e-9

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, middle, radius = shared.value
        partners: dict[int, np.ndarray] = {}
        for batch in batches:
            start = np.array([first[c][0] for c in batch.column(2).to_pylist()], dtype=np.int64)
            parts = np.array([first[c][1] for c in batch.column(2).to_pylist()], dtype=np.int64)
            own = start + np.array(batch.column(4).to_pylist(), dtype=np.int64) % parts
            others = []
            for b in own.tolist():
                if b not in partners:
                    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (middle @ middle[b])))
                    partners[b] = np.flatnonzero(apart <= radius + radius[b] + reach)
                others.append(partners[b])
            sizes = np.array([len(o) for o in others])
            at, other = np.repeat(np.arange(batch.num_rows), sizes), np.concatenate(others) if others else np.zeros(0, np.int64)
            mine = own[at]
            low, high = np.minimum(mine, other), np.maximum(mine, other)
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(mine), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], ["low", "high", "own", "id", "v"])

    salted = placed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(1 << 30)))
    dealt = salted.mapInArrow(deal, f"low bigint, high bigint, own bigint, id {kind}, v binary")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        low = frame["low"].iloc[0] == frame["own"]
        x, y = frame[low], frame[~low]
        same = frame["low"].iloc[0] == frame["high"].iloc[0]
        y = x if same else y
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": [], "similarity": []}).astype({"a": frame["id"].dtype, "b": frame["id"].dtype, "similarity": "float64"})
        out, ids, other = [], x["id"].to_numpy(), y["id"].to_numpy()
        right = _matrix(list(y["v"]), width).T
        for k in range(0, len(ids), BLOCK):  # a skewed split may leave a block somewhat larger
            sims = _matrix(list(x["v"].iloc[k : k + BLOCK]), width) @ right
            i, j = np.nonzero(sims >= least)
            a, b, s = ids[k + i], other[j], sims[i, j]
            keep = a < b if same else np.ones(len(a), bool)
            out.append(pd.DataFrame({"a": np.where(a < b, a, b)[keep], "b": np.where(a < b, b, a)[keep], "similarity": s[keep]}))
        return pd.concat(out)

    found = dealt.groupBy("low", "high").applyInPandas(compare, shape)
    copies = rows.join(distinct.select("v", F.col("id").alias("first")), "v").filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("similarity"))
    return found.unionByName(copies)


#: Queries that are sent to every task at once.
QUERY_BLOCK = 4096


def nearest(df: DataFrame, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(query, id, similarity, rank): the k rows of greatest cosine for each query of a stated
    set, ties by id, itself excluded.  Keys are integers; null and zero vectors have no place.

    Queries go in blocks of QUERY_BLOCK; each task multiplies its rows with a block and keeps k
    of them a query, so what is exchanged is k rows a query and task, not every pair.
    """
    rows = df.select(F.col(key).cast("bigint").alias("id"), unit(F.col(vector)).alias("v")).filter("v is not null and id is not null")
    asked = queries.select(F.col(key).cast("bigint").alias("query"), unit(F.col(vector)).alias("q")).filter("q is not null and query is not null")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    best = None
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).toPandas()
        ids, matrix = part["query"].to_numpy(), np.array(part["q"].tolist(), dtype=np.float64)
        if not len(ids):
            continue
        shared = df.sparkSession.sparkContext.broadcast((ids, matrix))
        found = rows.mapInPandas(_scorer(shared, k), "query bigint, id bigint, similarity double")
        best = found if best is None else best.unionByName(found)
    if best is None:
        return df.sparkSession.createDataFrame([], "query bigint, id bigint, similarity double, rank int")
    order = W.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _scorer(shared, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix = shared.value
        keep: list[pd.DataFrame] = []
        for batch in batches:
            if len(batch):
                own = batch["id"].to_numpy()
                sims = np.array(batch["v"].tolist(), dtype=np.float64) @ matrix.T
                sims[own[:, None] == ids[None, :]] = -np.inf
                by_id = np.argsort(own, kind="stable")
                top = by_id[np.argsort(-sims[by_id], axis=0, kind="stable")[:k]]
                frame = pd.DataFrame({"query": np.tile(ids, len(top)), "id": own[top].ravel(), "similarity": np.take_along_axis(sims, top, axis=0).ravel()})
                keep = [pd.concat([*keep, frame[np.isfinite(frame["similarity"])]]).sort_values(["similarity", "id"], ascending=[False, True]).groupby("query").head(k)]
        yield from keep

    return run


#: Star rounds grow with the logarithm of the longest chain; so many mean that the edges change
#: while they are read, which is an error, not an answer.
MOST_ROUNDS = 1000


def _forest(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, of the same components: each task's edges become stars around the
    least id that the task can reach, so what it sends on is at most a row a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        def drain() -> pa.RecordBatch:
            nodes = [n for n in parent if root(n) != n]
            out = pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([parent[n] for n in nodes], pa.int64())], ["u", "v"])
            parent.clear()
            return out

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > 1_000_000:  # bounds memory; the rounds join what is drained apart
                yield drain()
        yield drain()

    return edges.select("a", "b").mapInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of undirected edges (a, b); the component is its least id.

    Each task first joins its own edges, then large-star and small-star steps alternate until
    the edges no longer change, O(log n) rounds as a rule.  Each round's edges are written to
    the shared folder, so lineage stays short and a lost executor costs no more than its own
    tasks; number and fingerprint of the edges come from the write itself.
    Null ends are no edge; a node with an edge to itself is a component.
    """
    pairs = written(edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).filter("a is not null and b is not null"), "edges")
    links = written(_forest(pairs.filter("a <> b")).distinct(), "links")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    before = None
    for _ in range(MOST_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: a node's greater neighbours go to the least of its neighbours and itself
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: a node and its smaller neighbours go to the least of these
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        stars = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        seen = Observation()
        stars = stars.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hash"))
        links = written(stars, "links")
        now = (seen.get.get("n"), seen.get.get("hash"))
        if now == before:
            return nodes.join(links.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "id"), "id", "left").select("id", F.least("id", F.coalesce("m", "id")).alias("component"))
        before = now
    raise RuntimeError(f"edges still change after {MOST_ROUNDS} rounds")
