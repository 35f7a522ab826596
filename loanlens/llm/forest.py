"""Approximate nearest neighbours by a hash-prefix forest.

Every tree is a sorted array of long hash strings, one bit per random hyperplane.  A
query descends in each tree to its longest matching prefix by binary search, then all
trees ascend together, bit by bit, each widening its run of equal prefixes, until the
runs hold enough candidates.  Those are ranked by exact cosine.

Rows are divided into blocks by hash, queries likewise; a task holds one block's forest
and one block of queries, and each query's best are merged over the blocks.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.store import Store

TREES = 48
#: Bits of a hash string.
BITS = 32
#: The ascent ends when a query has this share of the block's rows, and at least so many
#: rows, as candidates.  On vectors without structure, whose nearest are hardly nearer
#: than others, 0.9 of the true neighbours takes about this much; close neighbours are
#: met long before.
SHARE = 0.4
LEAST = 2048
#: Most rows and most queries of a block.
BLOCK_ROWS = 8_192
BLOCK_QUERIES = 4_096

_FOUND = "query_id long, query_key long, vec_id long, score double"
_KINDS = {"query_id": "int64", "query_key": "int64", "vec_id": "int64", "score": "float64"}


class Forest:
    """Trees over the rows of a matrix of unit vectors."""

    def __init__(self, unit: np.ndarray, centre: np.ndarray, trees: int, bits: int, seed: int) -> None:
        planes = np.random.default_rng(seed).normal(size=(unit.shape[1], trees * bits))
        self.trees, self.bits, self.planes, self.centre = trees, bits, planes, centre
        keys = self.strings(unit)
        self.order = np.argsort(keys, axis=0, kind="stable")
        self.sorted = np.take_along_axis(keys, self.order, axis=0)
        self.n = len(unit)

    def strings(self, unit: np.ndarray) -> np.ndarray:
        """Per row and tree the hash string as an integer, its first bit highest."""
        out = [np.zeros((0, self.trees), np.int64)]
        for start in range(0, len(unit), 1024):
            signs = (unit[start : start + 1024] - self.centre) @ self.planes > 0
            packed = np.packbits(signs.reshape(-1, self.trees, self.bits), axis=2)
            weights = 256 ** np.arange(packed.shape[2] - 1, -1, -1, dtype=np.int64)
            out.append(packed @ weights >> (-self.bits % 8))
        return np.concatenate(out)

    def runs(self, keys: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree the run of rows when the common ascent ends.

        The ascent is the same prefix length in all trees: the longest whose runs
        together hold ``want`` rows, found by halving the range of lengths.
        """
        short, long = np.zeros(len(keys), np.int64), np.full(len(keys), self.bits)
        while (short < long).any():
            middle = (short + long + 1) // 2
            low, high = self._at(keys, middle)
            enough = (high - low).sum(axis=1) >= want
            short, long = np.where(enough, middle, short), np.where(enough, long, middle - 1)
        return self._at(keys, short)

    def _at(self, keys: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        free = (self.bits - length)[:, None]
        first = keys >> free << free
        last = first + (np.int64(1) << free)
        low, high = np.empty(keys.shape, np.int64), np.empty(keys.shape, np.int64)
        for t in range(self.trees):
            low[:, t] = np.searchsorted(self.sorted[:, t], first[:, t], "left")
            high[:, t] = np.searchsorted(self.sorted[:, t], last[:, t], "left")
        return low, high

    def candidates(self, unit: np.ndarray, want: int):
        """Per query the rows that its runs hold."""
        for start in range(0, len(unit), 512):
            low, high = self.runs(self.strings(unit[start : start + 512]), want)
            for a, b in zip(low, high, strict=True):
                hit = np.zeros(self.n, bool)
                for t in range(self.trees):
                    hit[self.order[a[t] : b[t], t]] = True
                yield np.flatnonzero(hit)


def matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.concatenate(column.to_list()).astype(np.float64).reshape(-1, width)


def nearest(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int,
    trees: int = TREES, bits: int = BITS, share: float = SHARE, seed: int = 1, query_keys: np.ndarray | None = None,
) -> pd.DataFrame:
    """The ``k`` best candidates of each query in one block, ties to smaller ids.

    ``query_keys`` tell queries apart that share an id; the result carries them.

    The runs of all trees hold a row several times; they grow until, counted so, they
    would hold ``share`` of the block if rows fell into them at random.
    """
    norms, query_norms = np.linalg.norm(rows, axis=1), np.linalg.norm(queries, axis=1)
    unit, query_unit = rows / norms[:, None], queries / query_norms[:, None]
    forest = Forest(unit, unit.mean(axis=0), trees, bits, seed)
    need = max(k + 1, LEAST, int(np.ceil(share * len(rows))))
    want = trees * len(rows)
    if need < len(rows):
        want = min(want, int(np.ceil(-len(rows) * np.log(1 - need / len(rows)))))
    out = []
    for q, found in enumerate(forest.candidates(query_unit, want)):
        found = found[ids[found] != query_ids[q]]
        score = rows[found] @ queries[q] / (norms[found] * query_norms[q])
        if len(found) > k:
            near = np.flatnonzero(score >= np.partition(score, -k)[-k] - 1e-12)
            found, score = found[near], score[near]
        best = np.lexsort((ids[found], -score))[:k]
        out.append((np.full(len(best), q), ids[found[best]], score[best]))
    columns = zip(*out, strict=True) if out else ([], [], [])
    query, vec, score = (np.concatenate([*c, np.zeros(0, kind)]) for c, kind in zip(columns, (np.int64, np.int64, float), strict=True))
    keys = np.arange(len(query_ids)) if query_keys is None else query_keys
    return pd.DataFrame({"query_id": query_ids[query], "query_key": keys[query], "vec_id": vec, "score": score}).astype(_KINDS)


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has only finite numbers and is not zero."""
    value = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.where(
        F.col("vec_id").isNotNull() & value.isNotNull() & F.forall(value, finite) & F.exists(value, lambda x: x != 0)
    )


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding",
    trees: int = TREES, bits: int = BITS, share: float = SHARE,
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest rows found.

    Both tables have vec_id and a vector column; nearness is the cosine in double
    precision, ties go to the smaller vec_id, a row is no neighbour of its own id.  Only
    vectors of equal length meet.  Null and zero vectors, those holding a null or
    non-finite number, and rows without vec_id take no part.  A repeated vec_id is found as
    often as it stands there.  Queries alike in id and vector are one query; two vectors
    under one id are two, each with its own ranks.  Fewer than ``k`` candidates give as
    many rows; empty tables give none; other columns are ignored.

    Every row is indexed.  A task holds one block of rows (8 Ki) and one of queries
    (4 Ki); ``k`` rows per query and block are merged.
    """
    store = Store(vectors.sparkSession)
    slim = lambda df: usable(df, vector).select(
        F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("width")
    )
    rows = slim(vectors).withColumn("query_key", F.lit(0).cast("long"))
    asked = slim(queries).withColumn("query_key", F.xxhash64("v")).dropDuplicates(["vec_id", "query_key", "v"])
    counts = (
        rows.groupBy("width").count().join(asked.groupBy("width").agg(F.count("*").alias("asked")), "width")
        .select(
            "width", F.ceil(F.col("count") / block_rows).alias("blocks"), F.ceil(F.col("asked") / block_queries).alias("parts"),
        )
    )
    counts = store.put("blocks", counts)
    block = lambda salt, n: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(n))
    span = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    sides = (
        rows.join(F.broadcast(counts), "width")
        .select("width", block(1, "blocks").alias("block"), F.explode(span("parts")).alias("part"), F.lit(False).alias("asks"), "vec_id", "query_key", "v")
        .unionByName(
            asked.join(F.broadcast(counts), "width")
            .select("width", F.explode(span("blocks")).alias("block"), block(2, "parts").alias("part"), F.lit(True).alias("asks"), "vec_id", "query_key", "v")
        )
    )

    def task(key: tuple[Any, ...], held: pd.DataFrame) -> pd.DataFrame:
        width, asks = int(key[0]), held["asks"].to_numpy()
        held_rows, held_queries = held[~asks].sort_values("vec_id"), held[asks].sort_values("vec_id")
        if not len(held_rows) or not len(held_queries):
            return pd.DataFrame({name: [] for name in _KINDS}).astype(_KINDS)
        return nearest(
            matrix(held_queries["v"], width), held_queries["vec_id"].to_numpy(),
            matrix(held_rows["v"], width), held_rows["vec_id"].to_numpy(), k, trees, bits, share,
            query_keys=held_queries["query_key"].to_numpy(),
        )

    found = sides.groupBy("width", "block", "part").applyInPandas(task, _FOUND)
    place = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
