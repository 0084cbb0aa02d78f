"""Exact top-k by exhaustive term-at-a-time accumulation.

Vectors are rows of a sparse matrix of integer weights ``floor(256 * x)``;
a dimension's rows with their weights are its posting list. In a block, for
a tile of queries, each term with a weight in some query scatters its
weighted postings into a dense score array; partition selection takes each
query's best, and the blocks' best are merged by rank.

Defined results: null vectors and vectors with null, NaN or infinite
components take no part; an empty or zero vector scores 0; vectors of
different lengths are compared as if filled with zeros; scores are exact
wherever they fit a long, vectors of large weights taking Python's integers;
a score that fits no long (the SQL fails there) is that of weights cut to
+-2^26 (which fits up to 2^11 dimensions); null ids take no part; repeated rows are candidates of their own, and a query's
own id is never one; ties go to the smaller id; fewer candidates than k are
all returned.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame

from cityair.llm.common import landed
from cityair.llm.vectors import search, top, usable

TILE = 64
LIMIT = float(1 << 26)


def accumulate(rows: np.ndarray, queries: np.ndarray):
    """Scores (queries, rows), a tile of queries at a time."""
    postings = []
    for j in range(rows.shape[1]):
        at = np.flatnonzero(rows[:, j])
        # A full posting list is scattered as a slice.
        postings.append((slice(None) if 2 * len(at) > len(rows) else at))
    columns = np.ascontiguousarray(rows.T)
    for start in range(0, len(queries), TILE):
        tile = queries[start:start + TILE]
        scores = np.zeros((len(tile), len(rows)), np.int64)
        for j, at in enumerate(postings):
            asks = np.flatnonzero(tile[:, j])
            if not len(asks) or not isinstance(at, slice) and not len(at):
                continue
            weighted = tile[asks, j][:, None] * columns[j, at][None, :]
            if isinstance(at, slice) and len(asks) == len(tile):
                scores += weighted
            elif isinstance(at, slice):
                scores[asks] += weighted
            else:
                scores[np.ix_(asks, at)] += weighted
        yield start, scores


def _whole(x: np.ndarray, limit: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(256.0 * x), -limit, limit).astype(np.int64)


def _wide(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Scores (queries, rows) by integers of any size."""
    exact = [np.array([256 * int(x) if abs(x) > 2.0 ** 52 else math.floor(256.0 * x)
                       for x in m.ravel().tolist()], object).reshape(m.shape)
             for m in (queries, rows)]
    scores = exact[0] @ exact[1].T
    out = _whole(queries, LIMIT) @ _whole(rows, LIMIT).T
    fits = ((scores >= -(1 << 63)) & (scores < 1 << 63)).astype(bool)
    out[fits] = scores[fits].astype(np.int64)
    return out


def _scores(rows: np.ndarray, queries: np.ndarray):
    """Exact scores (queries, rows), a tile of queries at a time."""
    # Products of weights within the limit add up to a long.
    limit = math.isqrt(((1 << 63) - 1) // max(1, rows.shape[1]))
    large = [np.flatnonzero((np.abs(m) > limit // 256 - 1).any(axis=1)) for m in (rows, queries)]
    for start, scores in accumulate(_whole(rows, limit), _whole(queries, limit)):
        tile = queries[start:start + len(scores)]
        own = large[1][(large[1] >= start) & (large[1] < start + len(scores))]
        if len(large[0]):
            scores[:, large[0]] = _wide(rows[large[0]], tile)
        if len(own):
            scores[own - start] = _wide(rows, queries[own])
        yield start, scores


def _best(ids, rows, query_ids, queries, k):
    out = []
    for start, scores in _scores(rows, queries):
        for i, line in enumerate(scores):
            q = query_ids[start + i]
            other = ids != q
            a, b = top(ids[other], line[other], k)
            out.append((np.full(len(a), q), a, b))
    return (np.concatenate(c) for c in zip(*out))


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id",
                vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for every query id divisible by ``every``."""
    own = landed(usable(vectors, id_col, vec_col, zero_ok=True), "topk-vectors")
    return search(own, every, k, _best, "long")
