"""Mixing sources to target weights, in blocks of fixed length.

A source's documents, in a fixed pseudorandom order, are one stream of words
cut into blocks of ``block`` words. Every output shard draws its number of
blocks of each source from a multinomial distribution over the targets;
slots of a source are numbered over the shards, and slot t takes block
``permutation(t mod blocks)`` of epoch ``t div blocks``: a keyed Feistel
permutation of the block numbers, another one in every epoch. Slots and
documents meet in a join by (source, block).

A source's slots end exactly where its target is reached: draws beyond it
are dropped, missing ones are dealt to shards by a hash, and the last block
is cut to the words still wanted. Nothing is drawn oftener than a target of
three times the source asks for, so no document is taken more than three
times. Seeds are fixed and documents are ordered by a hash of what they are
(id and size, or text), not by where they were read, so reruns agree.

Places in a stream are prefix sums in two levels, about sqrt(n) buckets of
sqrt(n) documents in each source, so a source that holds a third of all rows
is spread like the others. Only what the mixture is made of, a row a source,
is on the driver.

Defined results: null and blank texts have size 0 and are taken 0 times;
null sources are one source, last in order; a total of 0 words gives targets
of 0; repeated rows are documents of their own; null ids pass through; an
empty table gives an empty result; extra columns are ignored by ``mix_words``
and kept by ``mix_texts``.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityair.llm.chunks import REF_BITS, pack_rows, text_bytes, unpack
from cityair.llm.common import WORD, landed, mix64, shuffle_partitions, trim

BLOCK = 256
SHARD = 1024
SEED = 17
MOST = 3
_U = np.uint64


def _round_key(key, j: int, half: int, x: np.ndarray) -> np.ndarray:
    return mix64(x ^ key, 40 + j) & _U((1 << half) - 1)


def permute(i: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """Keyed pseudorandom permutation of 0..n-1: four Feistel rounds over the
    next even number of bits, repeated while the result lies outside."""
    half = max(1, (max(2, n) - 1).bit_length() + 1 >> 1)
    mask, key = _U((1 << half) - 1), _U(key)
    out = np.asarray(i, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        a, b = out[todo] >> _U(half), out[todo] & mask
        for j in (3, 2, 1, 0) if inverse else (0, 1, 2, 3):
            a, b = ((b ^ _round_key(key, j, half, a)), a) if inverse else (
                b, a ^ _round_key(key, j, half, b))
        out[todo] = a << _U(half) | b
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its size; what
    is above is shared again by weight until none is."""
    total, out, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        whole = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / whole for i in open_}
        above = {i for i in open_ if share[i] > most * sizes[i]}
        for i in open_:
            out[i] = float(most * sizes[i]) if i in above else share[i]
        if not above:
            break
        open_ -= above
    return out


def _key(seed: int, source: int, epoch: int) -> int:
    return int(mix64(np.array([seed << 40 ^ source << 8 ^ epoch], np.uint64), 41)[0])


class Quota:
    """What one source gives: whole epochs, then ``rest`` words of another."""

    def __init__(self, index: int, size: int, target: float, block: int, seed: int, most: int):
        self.index, self.size, self.target, self.block, self.seed = index, size, target, block, seed
        self.blocks = -(-size // block)
        self.tail = size - (self.blocks - 1) * block if size else 0
        self.epochs = min(most, int(target / size + 1e-9)) if size else 0
        self.rest = 0 if self.epochs == most or not size else int(
            min(size, max(0, round(target - self.epochs * size))))
        self.tail_slot, more = 0, 0
        if self.rest:
            self.tail_slot = int(permute(np.array([self.blocks - 1]), self.blocks,
                                         _key(seed, index, self.epochs), inverse=True)[0])
            more = -(-self.rest // block)
            if more * block - (block - self.tail) * (self.tail_slot < more) < self.rest:
                more += 1
        self.slots = self.epochs * self.blocks + more

    def fill(self, t: np.ndarray):
        """(epoch, block, words taken) of slots."""
        epoch, i = t // self.blocks, t % self.blocks
        block, take = np.empty(len(t), np.int64), np.empty(len(t), np.int64)
        for e in np.unique(epoch):
            at = epoch == e
            block[at] = permute(i[at], self.blocks, _key(self.seed, self.index, int(e)))
        take[:] = np.where(block == self.blocks - 1, self.tail, self.block)
        before = i * self.block - (self.block - self.tail) * (self.tail_slot < i)
        last = epoch == self.epochs
        return epoch, block, np.where(last, np.clip(self.rest - before, 0, take), take)


def _placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """(ref, src, size, at): each document's place in its source's stream."""
    own = sizes.join(sources.select("source", "src", "buckets"), sizes["source"].eqNullSafe(
        sources["source"])).select("ref", "key", "src", "size", F.pmod(
            F.xxhash64("key", F.lit(SEED)), F.col("buckets")).alias("bucket"))
    own = landed(own, "mix-sizes")
    sums = own.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = landed(sums.select("src", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0))
                                .alias("start")), "mix-starts")
    within = Window.partitionBy("src", "bucket").orderBy("key", "ref").rowsBetween(
        Window.unboundedPreceding, -1)
    return own.join(starts, ["src", "bucket"]).select(
        "ref", "src", "size", (F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .alias("at"))


def _slots(spark, quotas: list[Quota], seed: int) -> DataFrame | None:
    """(src, shard, epoch, block, take): every slot of the mixture."""
    total = sum(q.slots for q in quotas)
    if not total:
        return None
    shard_slots = max(SHARD, int(math.sqrt(total)))
    shards = -(-total // shard_slots)
    p = np.array([q.slots for q in quotas]) / total

    def draw(batches):
        for batch in batches:
            rows = []
            for shard in batch.column("id").to_pylist():
                n = min(shard_slots, total - shard * shard_slots)
                counts = np.random.default_rng([seed, shard]).multinomial(n, p)
                rows += [(s, shard, int(c)) for s, c in enumerate(counts) if c]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], names=["src", "shard", "n"])

    drawn = landed(spark.range(0, shards, 1, min(shards, shuffle_partitions(spark))).mapInArrow(
        draw, "src long, shard long, n long"), "mix-draws")
    before = Window.partitionBy("src").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    spans = drawn.select("src", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(
        "lo"), "n")
    wanted = spark.createDataFrame([(q.index, q.slots) for q in quotas], "src long, slots long")
    # Draws end at the source's slots; what is missing goes to hashed shards.
    spans = spans.join(wanted, "src").select(
        "src", "shard", "lo", F.least(F.col("lo") + F.col("n"), "slots").alias("hi"))
    missing = wanted.join(drawn.groupBy("src").agg(F.sum("n").alias("n")), "src", "left").select(
        "src", F.explode(F.when(F.coalesce("n", F.lit(0)) < F.col("slots"), F.sequence(
            F.coalesce("n", F.lit(0)), F.col("slots") - 1)).otherwise(
                F.array().cast("array<long>"))).alias("lo")).select(
        "src", F.pmod(F.xxhash64("src", "lo"), F.lit(shards)).alias("shard"), "lo",
        (F.col("lo") + 1).alias("hi"))

    def expand(batches):
        names = ["src", "shard", "epoch", "block", "take"]
        for batch in batches:
            for src, shard, lo, hi in zip(*(batch.column(c).to_pylist() for c in (
                    "src", "shard", "lo", "hi"))):
                epoch, block, take = quotas[src].fill(np.arange(lo, hi, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, src)), pa.array(np.full(hi - lo, shard)),
                     pa.array(epoch), pa.array(block), pa.array(take)], names=names)

    return spans.where("lo < hi").unionByName(missing).mapInArrow(
        expand, "src long, shard long, epoch long, block long, take long")


def mix_plan(sizes: DataFrame, weights=(1, 2, 3), block: int = BLOCK, seed: int = SEED,
             most: int = MOST):
    """From landed (ref, key, source, size), key ordering documents: the sources as (src, source,
    source_size, target), and the parts taken as (ref, src, shard, epoch,
    start, n): n words of the document from word ``start`` on."""
    spark = sizes.sparkSession
    found = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias(
        "docs")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["size"] for r in found],
                   [weights[i % len(weights)] for i in range(len(found))], most)
    quotas = [Quota(i, int(r["size"]), t, block, seed, most)
              for i, (r, t) in enumerate(zip(found, goal))]
    sources = spark.createDataFrame(
        [(i, r["source"], int(r["size"]), float(t), max(1, math.isqrt(r["docs"])))
         for i, (r, t) in enumerate(zip(found, goal))],
        "src long, source string, source_size long, target double, buckets long")
    slots = _slots(spark, quotas, seed)
    if slots is None:
        return sources, spark.createDataFrame(
            [], "ref long, src long, shard long, epoch long, start long, n long")
    placed = _placed(sizes, sources).where("size > 0")
    parts = placed.select("ref", "src", "size", "at", F.explode(F.sequence(
        F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))).alias(
            "block"))
    lo = F.greatest(F.col("at"), F.col("block") * block)
    hi = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block)
    parts = parts.select("ref", "src", "block", (lo - F.col("at")).alias("start"),
                         (lo - F.col("block") * block).alias("off"), (hi - lo).alias("len"))
    n = F.least(F.col("len"), F.col("take") - F.col("off"))
    return sources, parts.join(slots, ["src", "block"]).select(
        "ref", "src", "shard", "epoch", "start", n.alias("n")).where("n > 0")


def _count_words(batches):
    for batch in batches:
        n = pc.fill_null(pc.count_substring_regex(batch.column("text"), WORD), 0)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"),
                                          n.cast(pa.int64())], names=["doc_id", "source", "size"])


def mix_words(docs: DataFrame, weights=(1, 2, 3), block: int = BLOCK, seed: int = SEED,
              id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every document."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast(
        "string").alias("source"), F.col(text_col).alias("text"))
    sizes = landed(own.mapInArrow(_count_words, "doc_id long, source string, size long").select(
        F.monotonically_increasing_id().alias("ref"), F.xxhash64("doc_id", "size").alias("key"),
        "doc_id", "source", "size"), "mix-words")
    sources, parts = mix_plan(sizes.select("ref", "key", "source", "size"), weights, block, seed)
    taken = parts.groupBy("ref").agg(F.sum("n").alias("taken"))
    return sizes.join(taken, "ref", "left").join(
        sources.withColumnRenamed("source", "source_"),
        sizes["source"].eqNullSafe(F.col("source_"))).select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mix_texts(docs: DataFrame, weights=(1, 2, 3), block: int = BLOCK, seed: int = SEED,
              text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture as rows of ``docs``: one for each document and epoch that
    takes words of it, with the words taken (the text as it is, if all are). A
    column ``n_chars`` of integers is counted anew, one of another type is kept."""
    packed = pack_rows(docs, "mix-texts", text_col)

    def count(batches):
        trim()
        names = ["ref", "key", "source", "size"]
        for batch in batches:
            for i in range(batch.num_rows):
                rows = unpack(batch.column("rows")[i])
                base = batch.column("chunk")[i].as_py() << REF_BITS
                n = pc.fill_null(pc.count_substring_regex(rows.column(text_col), WORD), 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + np.arange(rows.num_rows), pa.int64()),
                     pa.array([xxhash.xxh3_64_intdigest(t or b"") >> 1
                               for t in text_bytes(rows.column(text_col))], pa.int64()),
                     rows.column(source_col).combine_chunks().cast(pa.string()),
                     n.combine_chunks().cast(pa.int64())], names=names)

    sizes = landed(packed.select("chunk", "rows").mapInArrow(
        count, "ref long, key long, source string, size long"), "mix-words")
    _, parts = mix_plan(sizes, weights, block, seed)
    parts = parts.select(F.shiftright("ref", REF_BITS).alias("chunk"), "ref", "epoch", "start",
                         "n")
    word = re.compile(rb"[^\x20\x09-\x0D]+")
    target = docs.schema

    def cut(own: pa.Table, taken: pa.Table) -> pa.Table:
        trim()
        rows = unpack(own.column("rows")[0])
        if not taken.num_rows:
            return rows.slice(0, 0)
        texts = text_bytes(rows.column(text_col))
        taken = taken.sort_by([("ref", "ascending"), ("epoch", "ascending"),
                               ("start", "ascending")])
        index = taken["ref"].to_numpy() & ((1 << REF_BITS) - 1)
        epoch, start, n = (taken[c].to_numpy() for c in ("epoch", "start", "n"))
        new = np.flatnonzero(np.r_[True, (index[1:] != index[:-1]) | (epoch[1:] != epoch[:-1])])
        out = []
        for a, b in zip(new, [*new[1:], len(index)]):
            text = texts[index[a]]
            spans = [m.span() for m in word.finditer(text)]
            if n[a:b].sum() < len(spans):
                runs: list[list[int]] = []
                for s, c in zip(start[a:b].tolist(), n[a:b].tolist()):
                    if runs and runs[-1][1] == s:
                        runs[-1][1] = s + c
                    else:
                        runs.append([s, s + c])
                text = b" ".join(text[spans[x][0]:spans[y - 1][1]] for x, y in runs)
            out.append(text.decode("utf-8"))
        rows = rows.take(pa.array(index[new]))
        rows = rows.set_column(rows.schema.get_field_index(text_col), text_col,
                               pa.array(out, pa.string()))
        at = rows.schema.get_field_index("n_chars")
        if at >= 0 and pa.types.is_integer(rows.schema.field(at).type):
            rows = rows.set_column(at, "n_chars", pc.utf8_length(rows.column(text_col)).cast(
                rows.schema.field(at).type))
        return rows

    return packed.select("chunk", "rows").groupBy("chunk").cogroup(
        parts.groupBy("chunk")).applyInArrow(cut, target)
