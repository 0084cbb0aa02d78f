"""Approximate nearest neighbours by collision counting.

Every vector is projected on ``projections`` random lines; each line keeps
the rows of a block as one sorted array. A query's window on a line starts
at its own projection and widens round by round by a constant factor
(virtual rehashing: a wider bucket is a wider window on the same array).
A vector that falls into the windows of at least ``threshold`` lines collides
often enough and is verified: its exact inner product is taken in double
precision. A query stops by the usual two conditions: k verified vectors lie
so near that vectors nearer still would have collided by now (the window is
``SURE`` times the k-th distance), or a ``verify`` share of the block's
vectors was verified.

Largest inner product becomes nearest distance by one more component that
fills every vector to the largest norm M of all rows (queries get 0), so the
order of distances is the order of inner products; M is an aggregate over
the whole table. Lines are fixed by a seed, every row is indexed, none is
sampled. Equal vectors of a block are counted once and then returned with
their smallest ids, which is exact, since ties go to the smaller id.

Defined results: vectors that are null, empty, zero or hold null, NaN or
infinite components take no part, nor do null ids; shorter vectors are
filled with zeros; the query's own id is never returned; repeated rows are
candidates of their own; fewer candidates than k are all returned; vectors of
tiny or huge components are indexed by their direction, their scores being the
products as doubles have them; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.llm.common import landed
from cityair.llm.vectors import search, top, usable

PROJECTIONS = 96
THRESHOLD = 0.85
FIRST, WIDEN = 0.6, 1.4
ROW_BLOCK = 1 << 14
LEVELS = 64
TILE = 64
VERIFY = 0.08
SURE = 1.8
SEED = 71


def _lines(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, count))


def _index(place: np.ndarray, levels: int):
    """Each line's sorted array cut into ``levels`` buckets of equal depth:
    bucket edges, and for every edge the rows before it as a bit set."""
    lines, n = place.shape
    step = -(-n // levels)
    order = np.argsort(place, axis=1, kind="stable")
    cuts = np.minimum(np.arange(levels + 1) * step, n)
    edges = np.take_along_axis(place, order[:, np.minimum(cuts, n - 1)], axis=1)
    edges[:, cuts == n] = np.inf
    edges[:, 0] = -np.inf
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[None, :], axis=1)
    words = -(-n // 64)
    bits = np.zeros((lines, levels + 1, words * 8), np.uint8)
    for t, cut in enumerate(cuts):
        packed = np.packbits(rank < cut, axis=1, bitorder="little")
        bits[:, t, :packed.shape[1]] = packed
    return edges, bits.view(np.uint64)


def _collided(edges, bits, centres, radius: float, need: int, n: int) -> np.ndarray:
    """(queries, n) booleans: the rows in the windows of at least ``need``
    lines. A window is a run of whole buckets, so wider windows only move its
    ends; lines are added up in bit-sliced counters."""
    queries = len(centres)
    planes = np.zeros((len(edges).bit_length(), queries, bits.shape[2]), np.uint64)
    for j, line in enumerate(edges):
        a = np.searchsorted(line, centres[:, j] - radius, "right") - 1
        b = np.searchsorted(line, centres[:, j] + radius, "right")
        carry = bits[j, np.minimum(b, bits.shape[1] - 1)] ^ bits[j, a]
        for plane in planes[:(j + 1).bit_length()]:
            more = plane & carry
            plane ^= carry
            carry = more
    above, equal = np.zeros_like(planes[0]), ~np.zeros_like(planes[0])
    for p in range(len(planes) - 1, -1, -1):
        if need >> p & 1:
            equal &= planes[p]
        else:
            above |= equal & planes[p]
            equal &= ~planes[p]
    return np.unpackbits((above | equal).view(np.uint8), axis=1, bitorder="little")[:, :n]


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows at length 1, by their largest component first: no square of a tiny
    or huge component is lost."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def _block(largest: float, norm: float, projections: int, share: float, verify: float):
    """``largest``: of all components; ``norm``: of all vectors, in its units."""
    def best(ids, rows, query_ids, queries, k):
        # Equal vectors once, with their smallest ids.
        whole, inverse, n = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        members = ids[np.lexsort((ids, inverse.ravel()))]
        at = np.r_[0, np.cumsum(n)]
        unit = whole / largest / norm
        fill = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", unit, unit)))
        lines = _lines(rows.shape[1] + 1, projections)
        edges, bits = _index((unit @ lines[:-1] + fill[:, None] * lines[-1]).T, LEVELS)
        ways = _unit(queries)
        centres = ways @ lines[:-1]
        need, total = int(np.ceil(share * projections)), len(whole)
        enough = min(total, int(verify * total) + 4 * k)
        found, radius, live = [None] * len(queries), FIRST, np.arange(len(queries))
        while len(live):
            still = []
            for start in range(0, len(live), TILE):
                tile = live[start:start + TILE]
                hits = _collided(edges, bits, centres[tile], radius, need, total)
                for q, hit in zip(tile, hits):
                    own = np.flatnonzero(hit)
                    near = len(own) >= enough
                    if not near and len(own) > k:  # distance of the k-th verified vector
                        score = unit[own] @ ways[q]
                        kth = np.partition(score, len(own) - k - 1)[len(own) - k - 1]
                        near = SURE * np.sqrt(max(0.0, 2 - 2 * kth)) <= radius
                    if near:
                        found[q] = own
                    else:
                        still.append(q)
            live, radius = np.array(still, np.int64), radius * WIDEN
        out = []
        for i, q in enumerate(query_ids):
            score = np.einsum("ij,j->i", whole[found[i]], queries[i])
            few, line = [], []
            for v, s in zip(*top(found[i], score, k + 1, tie=members[at[found[i]]])):
                own = members[at[v]:at[v + 1]][:k + 1]  # the smallest ids of equal vectors
                few.append(own)
                line.append(np.full(len(own), s))
            few, line = np.concatenate(few), np.concatenate(line)
            other = few != q
            a, b = top(few[other], line[other], k)
            out.append((np.full(len(a), q), a, b))
        return (np.concatenate(c) for c in zip(*out))

    return best


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding", projections: int = PROJECTIONS,
            threshold: float = THRESHOLD, verify: float = VERIFY) -> DataFrame:
    """query_id, rank, vec_id, score for every query id divisible by ``every``."""
    own = landed(usable(vectors, id_col, vec_col, zero_ok=False), "ann-vectors")
    largest = own.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 1.0
    square = own.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + F.pow(
        x / F.lit(largest), F.lit(2.0))))).first()[0]
    return search(own, every, k, _block(largest, float(np.sqrt(square or 1.0)), projections,
                                        threshold, verify), "double", row_block=ROW_BLOCK)
