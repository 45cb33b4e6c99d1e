"""Exact top-k search by inner product, block at a time.

Vectors stand in blocks of neighbouring ids, each with its forward index (the vectors themselves, small integers) and the largest and
smallest value of every dimension. Queries stand in blocks too. Groups of vector blocks meet groups of query blocks, both of fixed
size, so a task's memory does not grow with the tables. There each query visits blocks by falling bound - the sum over its
dimensions of the best value the block has - and stops when no bound reaches its k-th score. The best of all groups are ranked at last.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import stage

#: Vectors of a block, blocks of a group of vectors, queries of a group of queries.
BLOCK, GROUP, QUERIES = 256, 64, 2048


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id, v`` of every row: floor(scale * x) of every component as double. A vector that is null or holds a null, NaN or infinity is left out."""
    v = vectors["embedding"]
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(fine & vectors["vec_id"].isNotNull())
    return rows.select(vectors["vec_id"].cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: in floating point where every sum fits its mantissa."""
    most = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of one query, ties to smaller ids and then rows."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((rows[at], ids[at], -scores[at]))[:k]]


def _search(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_row", "query_id", "row", "vec_id", "score")})
    if not len(queries) or not len(vectors):
        return empty
    width = max(max(map(len, queries["v"])), max(map(len, vectors["v"])))
    vectors = vectors.sort_values(["vec_id", "row"])
    ids, places, v = vectors["vec_id"].to_numpy(), vectors["row"].to_numpy(), _matrix(vectors["v"], width)
    qids, qrows, q = queries["vec_id"].to_numpy(), queries["row"].to_numpy(), _matrix(queries["v"], width)
    cuts = np.arange(0, len(ids), BLOCK)
    highest, lowest = np.maximum.reduceat(v, cuts), np.minimum.reduceat(v, cuts)
    bounds = products(np.maximum(q, 0), highest) + products(np.minimum(q, 0), lowest)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_at = [np.zeros(0, np.int64)] * len(qids)
    best = [np.zeros(0, np.int64)] * len(qids)
    kth = np.full(len(qids), np.iinfo(np.int64).min)
    for turn in range(len(cuts)):
        # A bound equal to the k-th score may still hold a smaller id.
        going = np.flatnonzero(bounds[np.arange(len(qids)), order[:, turn]] >= kth)
        if not len(going):
            break
        at = order[going, turn]
        for b in np.unique(at):
            own = going[at == b]
            block = slice(int(cuts[b]), int(cuts[b]) + BLOCK)
            scores = products(q[own], v[block])
            for i, row in zip(own, scores):
                maybe = np.flatnonzero((row >= kth[i]) & (places[block] != qrows[i]))
                if len(maybe):
                    all_at, all_scores = np.concatenate([best_at[i], maybe + block.start]), np.concatenate([best[i], row[maybe]])
                    top = _best(all_scores, ids[all_at], places[all_at], k)
                    best_at[i], best[i] = all_at[top], all_scores[top]
                    if len(top) == k:
                        kth[i] = best[i][-1]
    counts, at = [len(b) for b in best], np.concatenate(best_at)
    return pd.DataFrame({"query_row": np.repeat(qrows, counts), "query_id": np.repeat(qids, counts), "row": places[at], "vec_id": ids[at], "score": np.concatenate(best)})


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every vector that ``is_query`` holds for, the ``k`` others with the highest inner product.

    Components count as floor(scale * x). Ties go to the smaller id; all others come out if there are fewer than ``k``. Vectors that are null,
    have a null id or a component that is null or not finite take no part. A shorter vector counts as filled up with 0. Rows that
    repeat an id are vectors, and queries, of their own: each row is a candidate for every other row, and each query row has ranks
    of its own. Columns other than ``vec_id`` and ``embedding`` are not read.
    """
    ready = stage(quantised(vectors, scale).withColumn("row", F.monotonically_increasing_id()))
    n, n_queries = ready.count(), ready.filter(is_query).count()
    groups, query_groups = max(1, -(-n // (BLOCK * GROUP))), max(1, -(-n_queries // QUERIES))
    # Ranges of ids, even in the number of rows whatever the ids are, also where one id repeats; queries are dealt by a hash of their row.
    placed = stage(ready.repartitionByRange(groups, "vec_id", "row").withColumn("g", F.spark_partition_id().cast("long")))
    queries = ready.filter(is_query).withColumn("qg", F.pmod(F.xxhash64("row"), F.lit(query_groups)))
    spread = lambda df, name, count: df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    left, right = spread(queries, "g", groups), spread(placed, "qg", query_groups)
    found = left.groupBy("g", "qg").cogroup(right.groupBy("g", "qg")).applyInPandas(lambda key, a, b: _search(a, b, k), "query_row long, query_id long, row long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

