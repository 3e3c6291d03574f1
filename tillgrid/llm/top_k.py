"""Exact top-k search by inner product with pivot-table elimination.

Vectors are integers floor(scale * x). Every vector has its distances to the same ``pivots`` in a table. For a query q
and a candidate x, the triangle inequality over all pivots gives the greatest lower bound of their distance, and so an
upper bound of their inner product, (|q|^2 + |x|^2 - bound^2) / 2. Candidates are taken in the order of their bounds;
a query stops once its k-th score is above the next bound, so what it never scores cannot be among its k.

Candidates and queries are both cut into blocks of bounded size by position, and every query block meets every
candidate block once, by an equi-join on block numbers; each meeting gives k rows per query, ranked together
afterwards. Pivots are a bounded random sample of the vectors; any choice gives exact results.

Defined results: a vector that is null, empty, of another length than the table's commonest (smallest of ties), or
that holds a null or non-finite component takes no part; rows that share an id are queries and
candidates of their own, and no query meets a row of its own id; queries without candidates give no rows, as does an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.llm.common import written

PIVOTS = 32
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 512
_STEP = 128


def integer_vector(vec: Column, scale: int) -> Column:
    """floor(scale * x) of every component x, as long; null unless all components are finite."""
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**40 / scale))
    whole = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(sound & (F.size(vec) > 0), whole)


def _rows(blobs, dim: int) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in blobs]) if len(blobs) else np.zeros((0, dim), np.int64)


class Block:
    """Vectors of a block with squared norms and distances to the pivots, one contiguous row per pivot."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray) -> None:
        self.vectors = vectors
        self.wide = vectors.astype(np.float64)
        self.largest = float(np.abs(self.wide).max(initial=0.0))
        self.norms = (self.wide * self.wide).sum(axis=1)
        gap = self.norms[None, :] + (pivots * pivots).sum(axis=1)[:, None] - 2.0 * (pivots @ self.wide.T)
        self.table = np.sqrt(np.maximum(gap, 0.0))


def upper_bounds(query: int, queries: Block, candidates: Block) -> np.ndarray:
    """Upper bounds of one query's inner products with all candidates; never below the exact score."""
    low, gap = np.zeros(len(candidates.norms)), np.empty(len(candidates.norms))
    for p in range(len(candidates.table)):
        np.subtract(candidates.table[p], queries.table[p, query], out=gap)
        np.abs(gap, out=gap)
        np.maximum(low, gap, out=low)
    both = queries.norms[query] + candidates.norms
    slack = 1e-9 * both + 1e-6  # rounding of squares and roots
    return 0.5 * (both - low * low) + slack


def _scores(query: int, queries: Block, candidates: Block, part: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every partial sum is a whole number below 2^53, else in integers."""
    if queries.largest * candidates.largest * candidates.vectors.shape[1] >= 2.0**53:
        return candidates.vectors[part] @ queries.vectors[query]
    if 2 * len(part) > len(candidates.wide):
        return (candidates.wide @ queries.wide[query])[part].astype(np.int64)
    return (candidates.wide[part] @ queries.wide[query]).astype(np.int64)


def _best(scores: np.ndarray, chosen: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best in order, ties to the smaller id; only rows at or above the k-th score are sorted."""
    if len(scores) > k:
        top = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, chosen = scores[top], chosen[top]
    order = np.lexsort((ids[chosen], -scores))[:k]
    return scores[order], chosen[order]


def search_block(ids_q, queries: Block, ids_c, candidates: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query rows, candidate rows and scores of each query's k best in the block, ties to the smaller id.

    Candidates are scored in runs of falling bounds; after each run those whose bound is below the k-th score are
    eliminated, and a query stops when none is left.
    """
    ids_c = np.asarray(ids_c)
    rows, found, values = [], [], []
    for q in range(len(ids_q)):
        bounds = upper_bounds(q, queries, candidates)
        alive = np.flatnonzero(ids_c != ids_q[q])
        scores, chosen = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        step = max(_STEP, k)
        while len(alive):
            if len(alive) > step:
                split = np.argpartition(bounds[alive], len(alive) - step)
                part, alive = alive[split[-step:]], alive[split[:-step]]
            else:
                part, alive = alive, alive[:0]
            fresh = _scores(q, queries, candidates, part)
            scores, chosen = _best(np.concatenate([scores, fresh]), np.concatenate([chosen, part]), ids_c, k)
            if len(scores) >= k:
                alive = alive[bounds[alive] >= scores[-1]]
            step *= 4
        rows.append(np.full(len(chosen), q))
        found.append(chosen)
        values.append(scores)
    if not rows:
        return (np.zeros(0, dtype=np.int64),) * 3
    return np.concatenate(rows), np.concatenate(found), np.concatenate(values)


def top_k(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    scale: int = 64,
    pivots: int = PIVOTS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k best of every query among all rows but its own id's.

    ``is_query`` is a condition on the id column, named as in ``df``.
    """
    numbered = df.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
        integer_vector(F.col(vec_col), scale).alias("v"),
    ).where("vec_id is not null and v is not null")
    rows = written(numbered.withColumn("place", F.monotonically_increasing_id()), "topk-rows")
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "dim").first()
    if common is None:
        return _empty(df)
    dim = common["dim"]
    rows = rows.where(F.size("v") == dim)
    n_blocks = -(-common["n"] // CANDIDATE_BLOCK)
    n_queries = rows.where("query").count()
    q_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    # A bounded sample: the rows with the smallest hashes, one pivot each.
    sample = rows.select("v", F.xxhash64("vec_id", F.lit(5)).alias("h")).orderBy("h").limit(pivots).collect()
    table = np.array([r["v"] for r in sample], dtype=np.float64)

    block = F.pmod(F.xxhash64("place", F.lit(1)), F.lit(n_blocks)).cast("int")
    q_block = F.pmod(F.xxhash64("place", F.lit(2)), F.lit(q_blocks)).cast("int")

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        ids = group[["vec_id", "place"]].to_numpy(np.int64)
        blob = _rows(list(group["v"]), dim).astype("<i8").tobytes()
        return pd.DataFrame({"b": group["b"].iloc[:1], "ids": [ids.tobytes()], "vectors": [blob]})

    form = "b int, ids binary, vectors binary"
    candidates = rows.select(block.alias("b"), "vec_id", "place", "v").groupBy("b").applyInPandas(packed, form)
    queries = rows.where("query").select(q_block.alias("b"), "vec_id", "place", "v").groupBy("b").applyInPandas(packed, form)
    queries = queries.toDF("qb", "q_ids", "q_vectors")
    meets = queries.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def search(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids_q, places = np.frombuffer(row.q_ids, np.int64).reshape(-1, 2).T
                ids_c = np.frombuffer(row.ids, np.int64).reshape(-1, 2)[:, 0]
                q = Block(np.frombuffer(row.q_vectors, "<i8").reshape(-1, dim), table)
                c = Block(np.frombuffer(row.vectors, "<i8").reshape(-1, dim), table)
                a, b, score = search_block(ids_q, q, ids_c, c, k)
                yield pd.DataFrame({"place": places[a], "query_id": ids_q[a], "vec_id": ids_c[b], "score": score})

    met = meets.join(candidates, "b").select("q_ids", "q_vectors", "ids", "vectors")
    met = met.repartition(max(1, min(n_blocks * q_blocks, 4096)))  # pairs of blocks, spread evenly
    best = met.mapInPandas(search, "place long, query_id long, vec_id long, score long")
    by_score = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
