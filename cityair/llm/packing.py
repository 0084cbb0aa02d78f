"""Bulk-synchronous best-fit packing of token sequences.

Documents are tokenised (ids, then the end id), only longer ones than
``capacity`` are cut. Pieces of one length are interchangeable, so a round
of the packing works on the length classes of pieces and the runs of equal
gaps, both range-sorted by size: at most ``capacity`` classes whatever the
corpus, counted by one aggregate. In each round the largest class left is
swept over its successors, the smallest gaps that hold it; a run of gaps
takes as many pieces as fit, pieces claim gaps in the order of their rank in
the class, what finds no gap opens new sequences, the runs' gaps are updated,
and the next round begins. This is best fit by decreasing length. A round
yields intervals (class, ranks -> sequences, offset); the tasks place every
piece by binary search for its rank.

Ranks are made in Spark in two levels, about sqrt(n) buckets of sqrt(n)
pieces in each class, so a length that a third of all pieces share (pieces
cut to full length) is spread like the others. No piece passes the driver;
it sees counts by length and the intervals.

Defined results: null and empty texts are the end id alone; repeated rows
are documents of their own; null ids pass through; pieces of equal length
are placed in a fixed pseudorandom order; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import array
import base64
import bisect
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityair.llm.common import landed, once, small_batches, trim

CAPACITY = 2048
END_ID = 0
CACHE = 400_000
SEED = 29


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    The pre-tokenizer never joins a character that is not white space with a
    space after it, so a text is the sum of its words, each with the space
    before it; the ids of up to ``CACHE`` words are kept. Words go
    through the same vocabulary as ranks (the file beside ``path`` with the
    ending ``.tiktoken``); texts with white space before a space or a special
    token's string go whole through the tokenizer itself.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([r"\s ", *map(re.escape, special)]))
        with open(re.sub(r"[.]json$", ".tiktoken", path), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def word(self, text: str) -> bytes:
        return array.array("I", self.words.encode_ordinary(text)).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.whole.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return array.array("I", ids).tobytes()
        first, *rest = text.split(" ")
        parts = list(map(self.known.get, rest))
        if None in parts:
            new = {w: self.word(" " + w) for w, p in zip(rest, parts) if p is None}
            if len(self.known) + len(new) > CACHE:
                self.known.clear()
            if len(new) <= CACHE:
                self.known.update(new)
            parts = [new[w] if p is None else p for w, p in zip(rest, parts)]
        return self.word(first) + b"".join(parts)


def encoder(path: str) -> Encoder:
    return once(("encoder", path), lambda: Encoder(path))


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of pieces: full ones, but for a shorter first one."""
    n = len(ids) // 4
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Intervals (length, first rank, first sequence, pieces a sequence,
    offset of the first piece), by length and rank."""
    gaps: dict[int, list] = {}  # gap -> runs (first sequence, sequences)
    sizes: list[int] = []  # the gaps, sorted
    opened, out = 0, []

    def add(gap, first, count):
        if count and gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)  # successor: smallest gap that holds it
            if at < len(sizes):
                gap = sizes[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, fit = capacity, capacity // length
                first, count = opened, -(-left // fit)
                opened += count
            fit = gap // length
            used = min(count, -(-left // fit))
            placed = min(left, used * fit)
            full, some = divmod(placed, fit)
            out.append((length, rank, first, fit, capacity - gap))
            add(gap - fit * length, first, full)
            if some:
                add(gap - some * length, first + full, 1)
            add(gap, first + used, count - used)
            rank, left = rank + placed, left - placed
    return sorted(out)


def tokenised(docs: DataFrame, path: str, id_col="doc_id", text_col="text",
              capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        trim()
        encode = encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(),
                                 batch.column("text").to_pylist()):
                ids = encode(text or "") + end
                rows += [(doc, i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)]))
                         for i, (s, n) in enumerate(cut(ids, capacity))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows
                else [pa.array([], t) for t in schema.types], schema=schema)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset a piece."""
    spark = docs.sparkSession
    with small_batches(spark):
        pieces = landed(tokenised(docs, path or vocabulary(), id_col, text_col, capacity,
                                  end_id).withColumn("ref", F.monotonically_increasing_id()),
                        "pack-pieces")
    counts = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}
    fits = best_fit(counts, capacity)
    classes = spark.createDataFrame([(n, max(1, math.isqrt(c))) for n, c in counts.items()],
                                    "length long, buckets long")
    # At most ``capacity`` rows: a proven bound for the broadcast.
    dealt = pieces.join(F.broadcast(classes), "length").withColumn("bucket", F.pmod(
        F.xxhash64("ref", F.lit(SEED)), F.col("buckets"))).drop("buckets")
    sums = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = landed(sums.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(
        0)).alias("first")), "pack-starts")
    within = Window.partitionBy("length", "bucket").orderBy("ref")
    ranked = dealt.join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("first") + F.row_number().over(within) - 1)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    table = np.array(fits, np.int64).reshape(-1, 5)

    def place(batches):
        step = 1 << 44
        key = table[:, 0] * step + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, length * step + rank, "right") - 1
            q = rank - table[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(table[at, 2] + q // table[at, 3]),
                 pa.array(table[at, 4] + q % table[at, 3] * length)],
                names=[*names, "sequence_id", "offset"])

    return ranked.select(*names, "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
               "sequence_id long, offset long")
