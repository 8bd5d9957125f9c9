"""Exact top-k inner products by no-random-access aggregation.

A block of vectors keeps, for each dimension, its rows sorted by component: the sorted
lists. A query reads every list from the end that gives it the largest products, a few
rows at a time and in step. What has been read gives each row a lower bound (the least
possible product for every list that has not shown it) and an upper bound (the product at
the list's reading head). Reading stops when all rows but a few have upper bounds below the
k-th best lower bound: no outsider can qualify any more. The scores of those few are then
resolved. The k-th best score among a first few thousand rows is known to every block, so
blocks stop sooner. Scores are integers, so nothing is rounded.

Queries and candidates are dealt to blocks; each pair of blocks is one group of bounded
size. Per query and block at most k rows go on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilospan.llm.common import kept

K = 5
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
SEED_ROWS = 2048
DEPTHS = (0.5, 0.65, 0.8, 1.0)  # shares of a list after which bounds are compared
FEW = 0.15


class SortedLists:
    """The lists of one block: per dimension row numbers by ascending component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(rows.T, self.order, axis=1).astype(float)

    def search(self, query_id: int, query: np.ndarray, k: int, floor: float):
        """(ids, scores) of the rows that may be among the best k of all, at most k;
        ``floor``: a k-th best score already reached elsewhere (-inf if none)."""
        alive = self._read(query, self.ids == query_id, k, floor)
        alive = alive[self.ids[alive] != query_id]
        scores = self.rows[alive] @ query  # resolve
        if len(alive) > k:
            best = np.lexsort((self.ids[alive], -scores))[:k]
            alive, scores = alive[best], scores[best]
        return self.ids[alive], scores

    def _read(self, query, own, k, floor) -> np.ndarray:
        """Row numbers whose upper bound reaches the bar when reading stops."""
        n, used = len(self.ids), np.flatnonzero(query)
        weight = query[used].astype(float)
        alive = np.arange(n)
        if not len(used):  # no list tells rows apart
            return alive
        for depth in DEPTHS:
            read = min(n, max(k + 1, int(n * depth)))
            parts = [slice(n - read, n) if w > 0 else slice(0, read) for w in weight]
            rows = np.concatenate([self.order[d, p] for d, p in zip(used, parts)])
            seen = [self.sorted[d, p] * w for d, p, w in zip(used, parts, weight)]
            # the reading head bounds what a list has not shown; at the end nothing is left
            head = [c[0] if w > 0 else c[-1] for c, w in zip(seen, weight)]
            more = np.concatenate([c - h for c, h in zip(seen, head)])
            upper = sum(head) + np.bincount(rows, more, n)
            bar = floor
            if floor == -np.inf and n - own.sum() >= k:
                least = [
                    w * (self.sorted[d, 0] if w > 0 else self.sorted[d, -1])
                    for d, w in zip(used, weight)
                ]
                more = np.concatenate([c - m for c, m in zip(seen, least)])
                lower = sum(least) + np.bincount(rows, more, n)
                lower[own] = -np.inf
                bar = np.partition(lower, n - k)[n - k]
            alive = np.flatnonzero(upper >= bar)
            if len(alive) <= max(4 * k, FEW * n):
                break
        return alive


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, q): components as floor(scale * x). Rows with a null id, and vectors that are
    null, empty, or hold null, NaN or infinite components, take no part."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(
        F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("bigint"))
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine)
        .select("vec_id", whole.alias("q"))
    )


def kept_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """:func:`quantised`, computed once for all that reads it."""
    return kept(quantised(vectors, id_col, vector_col, scale), "vectors")


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = K,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates by inner
    product, without the query's own id; ties go to the smaller id.

    Both tables have (vec_id, q) with vectors of integers. Vectors of another length than
    the query's are not compared with it. Repeated ids are candidates each; a query id that
    occurs more than once is asked once, with its least vector. Empty tables give no rows.
    """
    asked = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    n_rows, n_asked = candidates.count(), asked.count()
    if n_rows > 2 * SEED_ROWS:
        # a first few rows for every query give bars that let the blocks stop early
        share = F.pmod(F.xxhash64("vec_id", F.lit(7)), -(-n_rows // SEED_ROWS)) == 0
        first = _in_blocks(asked, candidates.where(share), n_asked, SEED_ROWS, k, block_rows, query_rows)
        enough = first.groupBy("query_id").agg(F.min("score").alias("m"), F.count("*").alias("n"))
        bars = kept(
            enough.where(F.col("n") >= k).select("query_id", F.col("m").alias("floor")), "bars"
        )
        asked = asked.join(bars, asked["vec_id"] == bars["query_id"], "left").select(
            "vec_id", "q", "floor"
        )
    return _in_blocks(asked, candidates, n_asked, n_rows, k, block_rows, query_rows)


def _in_blocks(asked, candidates, n_asked, n_rows, k, block_rows, query_rows) -> DataFrame:
    if "floor" not in asked.columns:
        asked = asked.withColumn("floor", F.lit(None).cast("bigint"))
    blocks, groups = -(-n_rows // block_rows) or 1, -(-n_asked // query_rows) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select(  # names of their own: both sides may come from one table
        F.col("vec_id").alias("query_id"), F.col("q").alias("asked"), "floor",
        F.pmod(F.xxhash64("vec_id", F.lit(1)), groups).cast("int").alias("g"),
        every(blocks).alias("b"),
    )
    right = candidates.select(
        "vec_id", "q", F.pmod(F.xxhash64("vec_id", "q"), blocks).cast("int").alias("b"),
        every(groups).alias("g"),
    )

    def answer(asked_rows: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for width, part in rows.groupby(rows["q"].map(len)):
            lists = SortedLists(part["vec_id"].to_numpy(), np.stack(part["q"].to_numpy()))
            mine = asked_rows[asked_rows["asked"].map(len) == width]
            for query_id, q, floor in zip(mine["query_id"], mine["asked"], mine["floor"]):
                bar = -np.inf if pd.isna(floor) else float(floor)
                ids, scores = lists.search(query_id, np.asarray(q), k, bar)
                found.append(np.stack([np.full(len(ids), query_id), ids, scores], axis=1))
        rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    pairs = left.groupBy("g", "b").cogroup(right.groupBy("g", "b"))
    local = pairs.applyInPandas(answer, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
