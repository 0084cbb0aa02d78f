"""Centroid clustering: exact Lloyd rounds with geometrically tightened bounds.

Every vector keeps its cluster, an upper bound of the distance to its own
centroid and a lower bound of the distance to every other one. When the
centroids move, the upper bound grows by its centroid's drift. The lower bound
needn't shrink by the largest drift: the vectors of a cluster lie in a sphere
around its old centroid, and ``loosening`` bounds by planar geometry how much
nearer a moved centroid can have come to any point of that sphere. Vectors
whose bounds still part are kept as they are; the ambiguous ones get their own
distance anew and, if that does not decide, are scanned against all centroids
in exact integer arithmetic. Bounds carry a margin for rounding, so ties and
near ties are always scanned.

Spark: vectors and their state travel in blocks; a round reads one landed
table and writes the next, without a shuffle of vectors. A task adds up its
clusters' components (one row a cluster), which Spark sums; the driver sees
``k`` centroids of ``dims`` components.

Defined results: vectors that are null, of other length, or hold null, NaN or
infinite components take no part; repeated rows are vectors of their own; a
null id is kept but can't name a starting centroid; equal hashes (repeated
ids) start in order of their components; ties go to the smaller cluster
number; fewer kept vectors than ``k`` give as many centroids; empty centroids
stay where they are; an empty table gives an empty result; extra columns are
ignored. Components from 2^54 on (2^62 as integers), and squared distances
that fit no long, raise an error.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.llm.common import discard, landed

K, ROUNDS, DIMS, SEED, SCALE = 40, 5, 64, 2, 256
BLOCK = 4096
FLOAT_EXACT = 1 << 22  # up to here, 64 products add up exactly in doubles
MARGIN = 1e-9
STATE = ("ids array<long>, w binary, own binary, upper binary, lower binary, dist binary, "
         "cluster int, n long, high array<long>, low array<long>, radius double, "
         "inertia decimal(38,0)")
STATE_ARROW = pa.schema([
    ("ids", pa.list_(pa.int64())), ("w", pa.binary()), ("own", pa.binary()),
    ("upper", pa.binary()), ("lower", pa.binary()), ("dist", pa.binary()),
    ("cluster", pa.int32()), ("n", pa.int64()), ("high", pa.list_(pa.int64())),
    ("low", pa.list_(pa.int64())), ("radius", pa.float64()), ("inertia", pa.decimal128(38, 0))])
RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
          "centroid_sha256 string")


def kept(vectors: DataFrame, dims: int = DIMS, id_col: str = "vec_id",
         vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, w array<long>) of the vectors that take part."""
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("v", lambda x: F.when(
        F.abs(x) < 2.0 ** 62 / scale, F.floor(x * F.lit(float(scale)))).otherwise(
        F.raise_error(F.lit("a component's integer is 2^62 or more")).cast("long")))
    return own.where(F.col("v").isNotNull() & (F.size("v") == dims) & finite).select(
        "vec_id", whole.alias("w"))


def starts(own: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors of smallest hash, in its order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    best = own.where("vec_id IS NOT NULL").select(h.alias("h"), "w").orderBy("h", "w").limit(k)
    return [list(r["w"]) for r in best.collect()]


def squared(rows: np.ndarray, centres: list[list[int]], which=None) -> np.ndarray:
    """Exact squared distances (rows, centroids), or of each row to centroid
    ``which`` of it."""
    most = max(int(np.abs(rows).max(initial=0)), max(abs(x) for c in centres for x in c))
    if most <= FLOAT_EXACT:
        a, c = rows.astype(np.float64), np.array(centres, np.float64)
        if which is not None:
            return np.square(a - c[which]).sum(axis=1).astype(np.int64)
        return (np.square(a).sum(axis=1)[:, None] - 2.0 * (a @ c.T)
                + np.square(c).sum(axis=1)).astype(np.int64)
    a, c = rows.astype(object), np.array(centres, object).reshape(len(centres), -1)
    if which is not None:
        return ((a - c[which]) ** 2).sum(axis=1)
    return np.stack([((a - x) ** 2).sum(axis=1) for x in c], axis=1)


def two_nearest(rows: np.ndarray, centres: list[list[int]]):
    """Nearest centroid (ties: smaller number), its squared distance, and a
    bound of the distance to every other."""
    d = squared(rows, centres)
    own = d.argmin(axis=1) if len(d) else np.empty(0, np.int64)
    at = np.arange(len(d))
    first = d[at, own].copy()
    if d.shape[1] == 1:
        return own.astype(np.int32), first, np.full(len(d), np.inf)
    rest = d.astype(np.float64)
    rest[at, own] = np.inf
    return own.astype(np.int32), first, np.sqrt(rest.min(axis=1))


def loosening(centre: np.ndarray, radius: float, before: np.ndarray, after: np.ndarray) -> float:
    """A bound of ``|x - before| - |x - after|`` over the sphere around
    ``centre``, at most the drift ``|after - before|``.

    The difference is constant on hyperbolas with foci ``before`` and
    ``after``, and such a branch lies within the cone of its asymptotes: seen
    from the middle of the foci, a point at angle ``t`` from the direction of
    the drift has a difference of ``drift * cos(t)`` at most, and of 0 at most
    beyond a right angle. In the plane through the foci and the sphere's
    centre the sphere is a disc; the smallest angle of its points is its
    centre's less the angle that its radius spans.
    """
    move = after - before
    drift = float(np.sqrt(move @ move))
    if drift == 0.0:
        return 0.0
    out = centre - (before + after) / 2.0
    far = float(np.sqrt(out @ out))
    if far <= radius:
        return drift
    angle = np.arccos(np.clip(out @ move / (far * drift), -1.0, 1.0))
    return drift * max(0.0, float(np.cos(max(0.0, angle - np.arcsin(radius / far)))))


def moved(old: list[list[int]], new: list[list[int]], radius: np.ndarray):
    """For each cluster: its drift, how much its vectors' lower bounds
    loosen, and half the distance from its centroid to the next one."""
    a, b = np.array(old, np.float64), np.array(new, np.float64)
    k = len(a)
    slack = 1e-12 * max(1.0, float(np.abs(np.r_[a, b]).max()))
    drift = np.sqrt(np.square(b - a).sum(axis=1)) * (1 + MARGIN) + slack
    loose, half = np.zeros(k), np.full(k, np.inf)
    for i in range(k):
        others = [j for j in range(k) if j != i]
        loose[i] = max((loosening(a[i], radius[i] * (1 + MARGIN), a[j], b[j])
                        for j in others), default=0.0) * (1 + MARGIN) + slack
        half[i] = min((0.5 * np.sqrt(np.square(b[i] - b[j]).sum()) for j in others),
                      default=np.inf)
    return drift, loose, half * (1 - MARGIN) - slack


def decided(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return upper * (1 + MARGIN) < lower * (1 - MARGIN)


def assign(rows, own, upper, lower, centres, drift, loose, half):
    """The block's clusters and bounds against moved centroids, and how many
    vectors were scanned."""
    upper, lower = upper + drift[own], lower - loose[own]
    beside = np.maximum(lower, half[own])
    open_ = np.flatnonzero(~decided(upper, beside))
    if len(open_):
        upper[open_] = np.sqrt(squared(rows[open_], centres, own[open_]).astype(np.float64))
        open_ = open_[~decided(upper[open_], beside[open_])]
    if len(open_):
        own[open_], first, lower[open_] = two_nearest(rows[open_], centres)
        upper[open_] = np.sqrt(first.astype(np.float64))
    return own, upper, lower, len(open_)


class Sums:
    """A task's clusters: vectors, components (as high and low halves, which
    can't overflow), radius and inertia."""

    def __init__(self, k: int, dims: int):
        self.n = np.zeros(k, np.int64)
        self.high, self.low = np.zeros((k, dims), np.int64), np.zeros((k, dims), np.int64)
        self.radius, self.inertia = np.zeros(k), [0] * k

    def add(self, rows, own, upper, dist):
        order = np.argsort(own, kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(own[order]) != 0]) if len(own) else []
        for i, at in zip(own[order][cut].tolist(), np.split(order, cut[1:])):
            self.n[i] += len(at)
            self.high[i] += (rows[at] >> 31).sum(axis=0)
            self.low[i] += (rows[at] & ((1 << 31) - 1)).sum(axis=0)
            self.radius[i] = max(self.radius[i], upper[at].max())
            if dist is not None:
                self.inertia[i] += sum(dist[at].tolist())

    def batch(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.n).tolist()
        none = [None] * len(some)
        cols = [none] * 6 + [some, self.n[some].tolist(), self.high[some].tolist(),
                             self.low[some].tolist(), self.radius[some].tolist(),
                             [self.inertia[i] for i in some]]
        return _state(cols)


def _state(cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([None if x is None else Decimal(x) for x in c], t)
         if pa.types.is_decimal(t) else pa.array(c, t)
         for c, t in zip(cols, STATE_ARROW.types)], schema=STATE_ARROW)


def _block(ids, rows, own, upper, lower, dist) -> pa.RecordBatch:
    if dist is not None and dist.max(initial=0) >= 1 << 63:
        raise ArithmeticError("a squared distance fits no long")
    most = int(np.abs(rows).max(initial=0))
    kind = next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
    cols = [[ids], [rows.astype(kind).tobytes()], [own.astype(np.int32).tobytes()], [upper.tobytes()],
            [lower.tobytes()], [None if dist is None else dist.astype(np.int64).tobytes()],
            *[[None]] * 6]
    return _state(cols)


def _first(centres, dims):
    """Blocks of the vectors, each scanned against the starting centroids."""
    def run(batches):
        sums = Sums(len(centres), dims)
        for batch in batches:
            rows = batch.column("w").flatten().to_numpy(zero_copy_only=False).astype(
                np.int64).reshape(batch.num_rows, dims)
            ids = batch.column("vec_id").to_pylist()
            for s in range(0, len(rows), BLOCK):
                part = np.ascontiguousarray(rows[s:s + BLOCK])
                own, first, lower = two_nearest(part, centres)
                upper = np.sqrt(first.astype(np.float64))
                sums.add(part, own, upper, None)
                yield _block(ids[s:s + BLOCK], part, own, upper, lower, None)
        yield sums.batch()
    return run


def _next(centres, drift, loose, half, dims, last):
    def run(batches):
        sums = Sums(len(centres), dims)
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                size = len(r["w"]) // (len(r["ids"]) * dims)
                rows = np.frombuffer(r["w"], f"i{size}").reshape(-1, dims).astype(np.int64)
                own, upper, lower = (np.frombuffer(r[c], t).copy() for c, t in (
                    ("own", np.int32), ("upper", np.float64), ("lower", np.float64)))
                own, upper, lower, _ = assign(rows, own, upper, lower, centres, drift, loose, half)
                dist = squared(rows, centres, own) if last else None
                sums.add(rows, own, upper, dist)
                yield _block(r["ids"], rows, own, upper, lower, dist)
        yield sums.batch()
    return run


def gathered(state: DataFrame, k: int, dims: int):
    """The clusters' sizes, component sums, radii and inertia, over all tasks."""
    stats = state.where("cluster IS NOT NULL")
    size, radius, inertia = np.zeros(k, object), np.zeros(k), np.zeros(k, object)
    for r in stats.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("r"),
                                          F.sum("inertia").alias("i")).collect():
        size[r["cluster"]], radius[r["cluster"]], inertia[r["cluster"]] = r["n"], r["r"], int(r["i"])
    total = np.zeros((k, dims), object)
    halves = stats.select("cluster", F.posexplode(F.arrays_zip("high", "low")).alias("j", "x"))
    wide = [F.sum(F.col(f"x.{c}").cast("decimal(20,0)")).alias(c) for c in ("high", "low")]
    for r in halves.groupBy("cluster", "j").agg(*wide).collect():
        total[r["cluster"], r["j"]] = (int(r["high"]) << 31) + int(r["low"])
    return size, total, radius, inertia


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS,
            seed: int = SEED, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 a vector."""
    spark = vectors.sparkSession
    own = kept(vectors, dims, id_col, vec_col)
    centres = starts(own, k, seed)
    if not centres:
        return spark.createDataFrame([], RESULT)
    state = landed(own.mapInArrow(_first(centres, dims), STATE), "centroids-0")
    for t in range(1, rounds + 1):
        size, total, radius, _ = gathered(state, len(centres), dims)
        new = [[int(x) // int(n) for x in s] if n else c
               for c, n, s in zip(centres, size, total)]
        drift, loose, half = moved(centres, new, radius)
        blocks = state.where("cluster IS NULL").select(*STATE_ARROW.names[:5])
        after = landed(blocks.mapInArrow(_next(new, drift, loose, half, dims, t == rounds), STATE),
                       f"centroids-{t}")
        discard(state)
        state, centres = after, new
    inertia = gathered(state, len(centres), dims)[3]
    return _result(state, centres, [int(x) for x in inertia], dims)


def _result(state: DataFrame, centres, inertia, dims) -> DataFrame:
    if max(sum(inertia), 0) >= 1 << 63:
        raise ArithmeticError("the inertia fits no long")
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at = np.frombuffer(r["own"], np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["ids"], pa.int64()), pa.array(at),
                    pa.array(np.frombuffer(r["dist"], np.int64)),
                    pa.array(np.array(inertia, np.int64)[at]),
                    pa.array(np.full(len(at), sum(inertia), np.int64)),
                    pa.array([digest[i] for i in at.tolist()], pa.string())],
                    names=[c.split()[0] for c in RESULT.split(", ")])

    return state.where("cluster IS NULL").select("ids", "own", "dist").mapInArrow(run, RESULT)


def oracle(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, seed: int = SEED) -> str:
    """DuckDB SQL for ``cluster`` over ``embeddings``, a group of CTEs a round."""
    ctes = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, generate_subscripts(w, 1) AS j, unnest(w) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT no, generate_subscripts(w, 1) AS j, unnest(w) AS c FROM (
    SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), w) - 1
                AS INTEGER) AS no, w
    FROM kept WHERE vec_id IS NOT NULL) WHERE no < {k})"""]
    for t in range(rounds + 1):
        ctes.append(f"""
d{t} AS (
  SELECT rid, no, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
  FROM parts JOIN c{t} USING (j) GROUP BY rid, no),
a{t} AS MATERIALIZED (
  SELECT rid, no, d FROM d{t}
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, no) = 1)""")
        if t < rounds:
            ctes.append(f"""
s{t} AS (
  SELECT no, j, sum(x) AS s, count(*) AS n FROM a{t} JOIN parts USING (rid) GROUP BY no, j),
c{t + 1} AS MATERIALIZED (
  SELECT no, j, CASE WHEN n IS NULL THEN c
                ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS c
  FROM c{t} LEFT JOIN s{t} USING (no, j))""")
    return "WITH" + ",".join(ctes) + f""",
digest AS (
  SELECT no, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256
  FROM c{rounds} GROUP BY no)
SELECT vec_id, no AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY no) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN digest USING (no)
"""
