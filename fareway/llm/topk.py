"""Exact top-k search by multi-resolution segment statistics.

Each integer vector is cut into segments; a segment keeps its mean and the
norm of its deviations. For a segment of length L the inner product is
L * mean_q * mean_x + <dev_q, dev_x>, and the second term is at most
|dev_q| * |dev_x|. Their sum over segments bounds the score from above; more
segments bound it closer. Since |q - x|^2 = |q|^2 + |x|^2 - 2 <q, x>, this is
the lower bound on the distance at given norms. Candidates pass from coarse
to fine levels, each pruned against the k-th best exact score known so far;
survivors get their exact inner product.

Queries are shared with all tasks in chunks of bounded size. Each task streams
its vectors past the queries in blocks, without a shuffle, and carries the
k best of every query from block to block, so later blocks are pruned by all
earlier ones. A task gives at most k rows per query; the final ranking is over these.

Defined results: vectors that are null, or hold null or non-finite
components, take no part, nor do rows without an id. Only vectors of equal
length are compared. Rows with the query's own id are not its candidates;
repeated query rows are one query per distinct vector. A query without
candidates has no rows; empty tables give none. Equal scores are ranked by the smaller id. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fareway.llm.common import materialize, small_batches, table

LEVELS = (2, 8, 32)
OUT = "query_id long, query_hash long, vec_id long, score long"


def quantize(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) per component, valid vectors only."""
    x = F.col(vector)
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def segment_stats(m: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row and segment: sum / sqrt(length), and the norm of the deviations from the mean."""
    cuts = np.linspace(0, m.shape[1], segments + 1).astype(int)
    means, devs = [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = m[:, a:b]
        mean = part.mean(axis=1, keepdims=True)
        means.append(mean[:, 0] * np.sqrt(b - a))
        devs.append(np.sqrt(((part - mean) ** 2).sum(axis=1)))
    return np.stack(means, 1), np.stack(devs, 1)


class Searcher:
    """The ``k`` best of each of the queries (ids, matrix of one row each) among the blocks seen so far."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, k: int, together: int = 256) -> None:
        self.ids, self.m, self.k, self.together = ids, m, k, together
        self.levels = [(s, *segment_stats(m, s)) for s in LEVELS if 4 * s <= m.shape[1]]  # finer ones cost as much as the scores
        self.score = np.full((len(ids), k), -np.inf)
        self.best = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, ids: np.ndarray, m: np.ndarray) -> None:
        stats = [segment_stats(m, s) for s, _, _ in self.levels]
        for at in range(0, len(self.ids), self.together):
            self._add(slice(at, at + self.together), ids, m, stats)

    def _add(self, part: slice, ids: np.ndarray, m: np.ndarray, stats: list) -> None:
        q, k = self.m[part], self.k
        alive = ids[:, None] != self.ids[None, part]
        floor = self.score[part, -1].copy()  # the k-th best so far
        for (_, means, devs), (mean, dev) in zip(self.levels, stats, strict=True):
            bound = mean @ means[part].T + dev @ devs[part].T
            if np.isneginf(floor).any() and len(ids) > 4 * k:  # the most promising rows give a first floor
                top = np.argpartition(-np.where(alive, bound, -np.inf), k, axis=0)[:k]
                own = np.einsum("kqd,qd->kq", m[top], q)
                reached = np.where(np.take_along_axis(alive, top, 0), own, -np.inf).min(axis=0)
                floor = np.maximum(floor, reached)
            low = np.where(np.isneginf(floor), -np.inf, floor - 1e-6 * (np.abs(np.where(np.isneginf(floor), 0, floor)) + 1))
            alive &= bound * (1 + 1e-9 * np.sign(bound)) + 1e-6 >= low
        if alive.mean() < 0.02:  # few survivors: their scores alone
            row, col = np.nonzero(alive)
            score = np.einsum("nd,nd->n", m[row], q[col])
        else:
            every = np.where(alive, m @ q.T, -np.inf)
            if len(ids) > k:
                floor = np.maximum(floor, np.partition(every, len(ids) - k, axis=0)[len(ids) - k])
            row, col = np.nonzero((every >= floor) & alive)
            score = every[row, col]
        keep = score >= floor[col]
        row, col, score = row[keep], col[keep], score[keep]
        n = len(floor)
        owner = np.concatenate([np.repeat(np.arange(n), k), col])
        score = np.concatenate([self.score[part].ravel(), score])
        found = np.concatenate([self.best[part].ravel(), ids[row]])
        order = np.lexsort((found, -score, owner))  # ties to the smaller id
        owner, score, found = owner[order], score[order], found[order]
        first = np.searchsorted(owner, np.arange(n))
        take = first[:, None] + np.arange(k)
        self.score[part], self.best[part] = score[take], found[take]

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query, id and score of what was found."""
        query, place = np.nonzero(~np.isneginf(self.score))
        return query, self.best[query, place], self.score[query, place].astype(np.int64)


def _matrix(column: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    return column.take(pa.array(rows)).flatten().to_numpy().astype(np.float64).reshape(len(rows), dim)


def _search(shared, k: int, block_rows: int):
    """``shared``: per length of vectors, ids, hashes and matrix of the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = {dim: Searcher(ids, m, k) for dim, (ids, _, m) in shared.value.items()}
        held: dict[int, list] = {dim: [] for dim in searchers}

        def flush(dim: int) -> None:
            if held[dim]:
                searchers[dim].add(np.concatenate([i for i, _ in held[dim]]), np.concatenate([m for _, m in held[dim]]))
                held[dim] = []

        for b in batches:
            dims, ids = b["dim"].to_numpy(), b["vec_id"].to_numpy()
            for dim in searchers:
                rows = np.flatnonzero(dims == dim)
                if len(rows):
                    held[dim].append((ids[rows], _matrix(b["v"], rows, dim)))
                if sum(len(i) for i, _ in held[dim]) >= block_rows:
                    flush(dim)
        for dim, searcher in searchers.items():
            flush(dim)
            query, found, score = searcher.results()
            names = shared.value[dim]
            yield pa.RecordBatch.from_arrays([pa.array(names[0][query]), pa.array(names[1][query]), pa.array(found), pa.array(score)],
                                             ["query_id", "query_hash", "vec_id", "score"])

    return run


def search(spark: SparkSession, vectors: DataFrame, is_query, k: int = 5, block_rows: int = 4_000,
           query_bytes: int = 8 << 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for quantized ``vectors``; ``is_query``: a condition on vec_id.

    About ``query_bytes`` of queries are on the driver, and shared, at a time; each such chunk is one pass over the vectors."""
    small_batches(spark)
    vectors = materialize(spark, vectors.withColumn("dim", F.size("v")).withColumn("h", F.xxhash64("v")).filter("dim > 0"), "topk")
    asked = materialize(spark, vectors.filter(is_query).dropDuplicates(["vec_id", "dim", "h"]), "topk-queries")
    total = asked.agg(F.sum((F.col("dim") + 2) * 8)).first()[0] or 0
    chunks = max(1, -(-total // query_bytes))
    found = []
    for chunk in range(chunks):
        got = asked.filter(F.pmod(F.xxhash64("vec_id", "h"), F.lit(chunks)) == chunk).select("vec_id", "dim", "h", "v").toArrow().combine_chunks()
        dims = got["dim"].to_numpy()
        queries = {}
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            queries[dim] = (got["vec_id"].to_numpy()[rows], got["h"].to_numpy()[rows], _matrix(got["v"].combine_chunks(), rows, dim))
        shared = spark.sparkContext.broadcast(queries)
        found.append(materialize(spark, vectors.select("vec_id", "dim", "v").mapInArrow(_search(shared, k, block_rows), OUT), "topk-found"))
        shared.destroy()
    every = reduce(lambda a, b: a.union(b), found)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, quantize(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)
