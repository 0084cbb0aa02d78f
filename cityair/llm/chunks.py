"""Chunks of rows, and counting of 64-bit keys over all chunks.

``pack_rows`` lands a table as chunks: one row holds a record batch of at
most ``chunk_bytes`` of text (one longer row makes a chunk of its own). A
row's place, ``ref = chunk << 20 | index``, identifies it from then on, so
repeated rows and null ids need no key of their own. ``count_keys`` answers,
for the keys each chunk sends, how often a key occurs in all chunks. Keys
are deduplicated in their chunk before the shuffle, and travel in blocks by
key range; a key that a third of all rows share costs a range one entry a
chunk, never one a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cityair.llm.common import landed, reclaim, shuffle_partitions

CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 1 << 14
REF_BITS = 20
ASKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()),
                   ("counts", pa.binary())])
ANSWER = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("totals", pa.binary()),
                    ("first", pa.binary())])
ANSWER_DDL = "chunk long, bucket int, totals binary, first binary"


def pack_rows(df: DataFrame, name: str, text: str = "text", chunk_bytes: int = CHUNK_BYTES,
              batch_rows: int = 1024) -> DataFrame:
    """Land ``df`` as ``(chunk long, n_bytes long, rows binary)``."""
    spark = df.sparkSession

    def pack(batches):
        part, seq = TaskContext.get().partitionId(), 0
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(
                zero_copy_only=False).astype(np.int64)
            end, start = np.cumsum(size), 0
            while start < batch.num_rows:
                base = end[start] - size[start]
                stop = min(max(start + 1, int(np.searchsorted(end, base + chunk_bytes, "right"))),
                           start + CHUNK_ROWS)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as w:
                    w.write_batch(batch.slice(start, stop - start))
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [part << 20 | seq], "n_bytes": [int(end[stop - 1] - base)],
                     "rows": [sink.getvalue().to_pybytes()]},
                    schema=pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()),
                                      ("rows", pa.binary())]))
                start, seq = stop, seq + 1

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(batch_rows))  # bounds a batch of very long texts
    try:
        return landed(df.mapInArrow(pack, "chunk long, n_bytes long, rows binary"), name)
    finally:
        spark.conf.set(key, before)


def unpack(rows) -> pa.Table:
    return pa.ipc.open_stream(rows.as_py() if hasattr(rows, "as_py") else rows).read_all()


def text_bytes(column) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def key_ranges(chunks: DataFrame, bytes_per_key: float, keys_per_range: int = 1 << 20) -> int:
    """Number of key ranges: some for each shuffle partition, more as keys grow."""
    total = chunks.agg({"n_bytes": "sum"}).first()[0] or 0
    return max(3 * shuffle_partitions(chunks.sparkSession),
               int(total / bytes_per_key / keys_per_range))


def split_keys(chunk: int, keys: np.ndarray, ranges: int):
    """A chunk's distinct keys with their counts, a row for each key range."""
    keys, counts = np.unique(keys, return_counts=True)
    where = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(keys) else []
    for a, b in zip(cut, [*cut[1:], len(keys)]):
        yield int(where[a]), chunk, keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes()


def asked_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), ASKED.types)] if rows
        else [pa.array([], t) for t in ASKED.types], schema=ASKED)


def count_keys(chunks: DataFrame, keys_of, columns, ranges: int, name: str) -> DataFrame:
    """How often each chunk's keys occur in all chunks.

    ``keys_of(row: dict) -> uint64 array`` gives a chunk's keys, repeats
    included. Returns landed rows ``(chunk, bucket, totals, first)``: for the
    chunk's distinct keys in ascending order, range by range, their count over
    all chunks, and whether the chunk is the one with the smallest number that
    sent the key. The keys themselves do not travel back; ``look_up`` makes
    them again.
    """
    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                yield asked_batch(list(split_keys(row["chunk"].as_py(), keys_of(row), ranges)))

    def answer(group: pa.Table) -> pa.Table:
        own = np.array(group.column("chunk").to_pylist())
        parts = [np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.uint32)
                                 for x in group.column("counts").to_pylist()])
        keys = np.concatenate(parts)
        part = np.repeat(np.argsort(np.argsort(own, kind="stable"), kind="stable"),
                         [len(p) for p in parts])
        order = np.lexsort((part, keys))
        k = keys[order]
        new = np.r_[True, k[1:] != k[:-1]]
        total, first = np.empty(len(k), np.uint32), np.empty(len(k), np.uint8)
        total[order] = np.bincount(np.cumsum(new) - 1, weights=counts[order]).astype(
            np.uint32)[np.cumsum(new) - 1]
        first[order] = new
        cut = np.cumsum([0, *(len(p) for p in parts)])
        bounds = list(zip(cut[:-1], cut[1:]))
        return pa.table([pa.array(own), group.column("bucket"),
                         [total[a:b].tobytes() for a, b in bounds],
                         [first[a:b].tobytes() for a, b in bounds]], schema=ANSWER)

    sent = chunks.select("chunk", *columns).mapInArrow(
        ask, "bucket int, chunk long, keys binary, counts binary")
    out = landed(sent.groupBy("bucket").applyInArrow(answer, ANSWER_DDL), name)
    del sent  # its shuffle is the largest there is
    reclaim(chunks.sparkSession, rounds=3)
    return out


def look_up(keys: np.ndarray, answer: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Count over all chunks, and first, of each of a chunk's keys: ``keys``
    must be those it asked about, ``answer`` its answers."""
    if not len(keys):
        return np.empty(0, np.uint32), np.empty(0, np.uint8)
    order = np.argsort(answer["bucket"].to_numpy())
    total, first = (np.concatenate([np.frombuffer(x, t) for x in answer[c].take(
        pa.array(order)).to_pylist()]) for c, t in (("totals", np.uint32), ("first", np.uint8)))
    at = np.unique(keys, return_inverse=True)[1].ravel()
    return total[at], first[at]
