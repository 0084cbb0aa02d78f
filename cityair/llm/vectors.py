"""Blocks of vectors: a stated query set against all rows, block by block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROW_BLOCK = 4096
QUERY_BLOCK = 2048


def usable(vectors: DataFrame, id_col: str, vec_col: str, zero_ok: bool) -> DataFrame:
    """(vec_id long, v array<double>) of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(
        float("inf"))))
    out = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    return out if zero_ok else out.where(F.exists("v", lambda x: x != 0))


def search(own: DataFrame, every: int, k: int, best, score_type: str,
           row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` best candidates of each query (ids divisible by ``every``).

    ``own`` is landed (vec_id, v). Rows are hashed to blocks of about
    ``row_block``, queries to blocks of about ``query_block``; every pair of
    blocks is one group of bounded size. ``best(row_ids, rows, query_ids,
    queries, k) -> (query_id, vec_id, score) arrays`` finds a block's best;
    the best of all blocks are merged by rank.
    """
    n = own.agg(F.count("*").alias("n"), F.sum(F.expr(
        f"if(vec_id % {every} = 0, 1, 0)")).alias("q")).first()
    n_rows, n_queries = -(-max(1, n["n"]) // row_block), -(-max(1, n["q"] or 0) // query_block)
    place = F.xxhash64("vec_id", F.lit(5))
    blocks = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    rows = own.select(F.pmod(place, F.lit(n_rows)).cast("int").alias("row_block"),
                      blocks(n_queries).alias("query_block"), "vec_id", "v")
    queries = own.where(f"vec_id % {every} = 0").select(
        blocks(n_rows).alias("row_block"),
        F.pmod(place, F.lit(n_queries)).cast("int").alias("query_block"), "vec_id", "v")
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()),
                     ("score", pa.int64() if score_type == "long" else pa.float64())])

    def block(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return out.empty_table()
        (ra, va), (rb, vb) = dense(a), dense(b)
        d = max(va.shape[1], vb.shape[1])
        va, vb = (np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (va, vb))
        return pa.table(list(best(ra, va, rb, vb, k)), schema=out)

    keys = ["row_block", "query_block"]
    found = rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        block, f"query_id long, vec_id long, score {score_type}")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def dense(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the matrix of a block; shorter vectors are filled with zeros.
    Rows come by id, so equal scores keep the order of ids."""
    ids = table.column("vec_id").to_numpy()
    col = table.column("v").combine_chunks()
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    lens = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(ids), int(lens.max(initial=0))))
    out[np.arange(out.shape[1]) < lens[:, None]] = flat
    order = np.argsort(ids, kind="stable")
    return ids[order], out[order]


def top(ids: np.ndarray, scores: np.ndarray, k: int, tie: np.ndarray | None = None):
    """Partition selection: the k largest scores, ties to the smaller id (or
    the smaller ``tie``)."""
    tie = ids if tie is None else tie
    if len(ids) > k:
        edge = np.partition(scores, len(ids) - k)[len(ids) - k]
        sure = np.flatnonzero(scores > edge)
        tied = np.flatnonzero(scores == edge)
        tied = tied[np.argsort(tie[tied], kind="stable")][:k - len(sure)]
        keep = np.concatenate([sure, tied])
        ids, scores, tie = ids[keep], scores[keep], tie[keep]
    order = np.lexsort((tie, -scores))
    return ids[order], scores[order]
