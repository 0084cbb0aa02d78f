"""Cross-tokenizer alignment: tokens of two vocabularies over the same bytes.

Texts are deduplicated by a shuffle on the full text; each distinct text is
tokenised and aligned once and weighs as often as it occurs. A text with a
space before it is a line of bytes; both token sequences cut it, and the cuts
they share end the alignment's groups. Every cut of either ends one link: the
pair of tokens whose ranges overlap before it.

Where white space can't tie words together, a text is the sum of its words
with the space before them, and a chunk of texts aligns each of its distinct
words once; any other text is one such unit as a whole. Pair counts are added
up in the chunks, weighted by multiplicity, and summed by Spark; each B id's
highest count is one row a vocabulary entry. The counts of a chunk's pairs
come back to it, and a text's measures are sums over its units. They meet the
documents by the text's SHA-256; texts that hold more than a thousandth of
all documents (a thousand at most) by a broadcast, so no key gathers more.

Defined results: null and empty texts, and texts whose tokens don't spell
them, have zeros and an empty ``groups_sha256``; special tokens' strings are
ordinary text; repeated rows and null ids are documents of their own; texts
of any length are aligned whole; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import array
import base64
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.llm.common import discard, landed, once

CHUNK_BYTES = 8 << 20
UNITS = 1 << 14  # aligned at a time: bounds the lists of tokens in memory
HOT_SHARE = 1000
MARK = "▁"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def vocabularies() -> tuple[str, str]:
    import public_tokenizers as p
    return p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a: str, b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        with open(a, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        with open(re.sub(r"[.]json$", ".tiktoken", a), "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        # The same ids without special tokens: their strings are ordinary text.
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN,
                                   mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        self.a_bytes = {i: x for x, i in ranks.items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # Words are independent of each other unless a piece crosses a word's start.
        crosses = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        self.whole = re.compile("" if crosses else "|".join(
            [r"^\s", r"\s ", " $", MARK, *map(re.escape, special)]))

    def units(self, text: str) -> list[str]:
        """Parts of a text that tokenise alone, each with a space before it."""
        return [text] if self.whole.search(text) else text.split(" ")

    def align(self, units: list[str]) -> "Aligned":
        return Aligned(self, units)


class Aligned:
    """Units' counts, group strings and links; ``ok`` where tokens spell them."""

    def __init__(self, pair: Pair, units: list[str]):
        parts = [_aligned_units(pair, units[i:i + UNITS], i)
                 for i in range(0, len(units), UNITS)] or [_aligned_units(pair, [], 0)]
        (self.ok, self.n_a, self.n_b, self.n_groups, self.n_links, self.links,
         self.link_unit) = (np.concatenate([p[c] for p in parts]) for c in range(7))
        self.groups = [g for p in parts for g in p[7]]


def _aligned_units(pair: Pair, units: list[str], base: int):
    a = [pair.a.encode_ordinary(" " + u) for u in units]
    b = pair.b.encode(units, num_threads=1) if units else []
    a_of, b_of = pair.a_bytes.__getitem__, pair.b_bytes.__getitem__
    ok = np.array([b"".join(map(a_of, x)) == (want := b" " + u.encode())
                   and b"".join(map(b_of, y)) == want
                   for u, x, y in zip(units, a, b)], bool)
    if not ok.all():
        a, b = ([x if good else [] for x, good in zip(y, ok)] for y in (a, b))
    n_a, n_b = (np.fromiter(map(len, x), np.int32, len(x)) for x in (a, b))
    ids_a, ids_b = (np.fromiter((i for x in y for i in x), np.int64) for y in (a, b))
    del a, b
    # All units on one line of bytes: their ends are ends in both.
    end_a, end_b = np.cumsum(pair.a_size[ids_a]), np.cumsum(pair.b_size[ids_b])
    cuts = np.union1d(end_a, end_b)
    at_a, at_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
    shared = (end_a[at_a] == cuts) & (end_b[at_b] == cuts)
    unit = np.repeat(np.arange(len(units), dtype=np.int32), n_a)[at_a]
    n_groups = np.bincount(unit[shared], minlength=len(units)).astype(np.int32)
    text_a, text_b = (list(map(str, x.tolist())) for x in (ids_a, ids_b))
    stop_a, stop_b = (at_a[shared] + 1).tolist(), (at_b[shared] + 1).tolist()
    groups = [f"{','.join(text_a[i:j])}|{','.join(text_b[k:m])}" for i, j, k, m in
              zip([0, *stop_a], stop_a, [0, *stop_b], stop_b)]
    first = np.cumsum(n_groups) - n_groups
    return (ok, n_a, n_b, n_groups,
            np.bincount(unit, minlength=len(units)).astype(np.int32),
            ids_a[at_a] << 32 | ids_b[at_b], unit + np.int32(base),
            [";".join(groups[s:s + n]) for s, n in zip(first.tolist(), n_groups.tolist())])


def tokenizers(a: str, b: str) -> Pair:
    return once(("pair", a, b), lambda: Pair(a, b))


class Chunk:
    """Texts in work together: each distinct unit of theirs is aligned once."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.texts: list[tuple] = []  # (text, digest, multiplicity, places)

    def add(self, pair: Pair, text: str, digest: bytes, times: int):
        at = array.array("I", [self.places.setdefault(u, len(self.places))
                               for u in pair.units(text)])
        self.texts.append((text, digest, times, at))

    def flush(self, pair: Pair, number: int) -> pa.RecordBatch:
        got = pair.align(list(self.places))
        at = [np.frombuffer(x[3], np.uint32) for x in self.texts]
        failed = [i for i, x in enumerate(at) if not got.ok[x].all()]
        if failed:  # a unit fails: the text as a whole decides
            more = {self.texts[i][0] for i in failed}
            for t in more:
                self.places.setdefault(t, len(self.places))
            got = pair.align(list(self.places))
            for i in failed:
                at[i] = np.array([self.places[self.texts[i][0]]], np.uint32)
        at = [x if got.ok[x].all() else x[:0] for x in at]
        times = np.array([x[2] for x in self.texts], np.int64)
        size = np.array([len(x) for x in at])
        text = np.repeat(np.arange(len(at)), size)
        flat = np.concatenate(at) if at else np.empty(0, np.uint32)
        uses = np.bincount(flat, weights=times[text], minlength=len(self.places))
        keys, key_of = np.unique(got.links, return_inverse=True)
        n = np.bincount(key_of, weights=uses[got.link_unit], minlength=len(keys))
        add = lambda x: np.bincount(text, weights=x[flat], minlength=len(at)).astype(
            np.int64)
        groups = got.groups.__getitem__
        digests = [hashlib.sha256(";".join(map(groups, x.tolist())).encode()).hexdigest()
                   if len(x) else "" for x in at]
        sink = pa.BufferOutputStream()
        inner = pa.RecordBatch.from_arrays(
            [pa.array([x[1] for x in self.texts], pa.binary()), pa.array(times),
             *(pa.array(add(x)) for x in (got.n_a, got.n_b, got.n_groups, got.n_links)),
             pa.array(digests, pa.string()), pa.array(at, pa.list_(pa.uint32()))],
            names=["digest", "times", *MEASURES[:4], "groups_sha256", "places"])
        unit = pa.RecordBatch.from_arrays(
            [pa.array(got.link_unit.astype(np.uint32)), pa.array(key_of.astype(np.uint32))],
            names=["unit", "key"])
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for b in (inner, unit):
            with pa.ipc.new_stream(sink, b.schema, options=options) as w:
                w.write_batch(b)
        used = n > 0
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([np.flatnonzero(used)], pa.list_(pa.int32())),
             pa.array([keys[used]], pa.list_(pa.int64())),
             pa.array([n[used].astype(np.int64)], pa.list_(pa.int64())),
             pa.array([len(self.places)]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            names=["chunk", "place", "pair", "n", "units", "texts"])


def _aligned(distinct: DataFrame, paths, chunk_bytes: int) -> DataFrame:
    def run(batches):
        pair = tokenizers(*paths)
        part, seq, size, own = TaskContext.get().partitionId(), 0, 0, Chunk()
        for batch in batches:
            texts = batch.column("text")
            digests, times = (batch.column(c).to_pylist() for c in ("digest", "times"))
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                own.add(pair, text, digests[i], times[i])
                size += len(text)
                if size >= chunk_bytes:
                    yield own.flush(pair, part << 24 | seq)
                    size, seq, own = 0, seq + 1, Chunk()
        if own.texts:
            yield own.flush(pair, part << 24 | seq)

    return distinct.mapInArrow(run, "chunk long, place array<int>, pair array<long>, "
                                    "n array<long>, units long, texts binary")


def alignment(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id",
              text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> tuple:
    """(measures, pairs): measures a distinct text, by its SHA-256 ``digest``,
    with its multiplicity ``times``; pairs (a, b, count, best), where ``best``
    says whether the count is b's highest."""
    paths = paths or vocabularies()
    texts = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL AND text <> ''")
    distinct = texts.groupBy("text").agg(F.count("*").alias("times")).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))
    chunks = landed(_aligned(distinct, paths, chunk_bytes), "align-chunks")
    sent = chunks.select(F.explode(F.arrays_zip("pair", "n")).alias("x")).select(
        F.col("x.pair").alias("pair"), F.col("x.n").alias("n"))
    counts = landed(sent.groupBy("pair").agg(F.sum("n").alias("count")), "align-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    highest = counts.groupBy(b).agg(F.max("count").alias("highest"))
    # A row an id of B's vocabulary at most: a proven bound for the broadcast.
    pairs = counts.withColumn("b", b).join(F.broadcast(highest), "b").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    asked = chunks.select("chunk", F.explode(F.arrays_zip("place", "pair")).alias("x")).select(
        F.col("chunk").alias("to"), F.col("x.place").alias("place"), F.col("x.pair").alias("pair"))
    answers = asked.join(pairs, "pair").select("to", "place", "count", "best")
    names = ["digest", "times", *MEASURES, "groups_sha256"]
    types = [pa.binary(), *[pa.int64()] * 7, pa.string()]

    def measure(own: pa.Table, back: pa.Table) -> pa.Table:
        at = back.column("place").to_numpy()
        # Pairs of units that no counted text uses have no answer, and need none.
        count, best = np.zeros(at.max(initial=-1) + 1, np.int64), np.zeros(
            at.max(initial=-1) + 1, bool)
        count[at] = back.column("count").to_numpy()
        best[at] = back.column("best").to_numpy()
        parts = []
        for units, blob in zip(own.column("units").to_pylist(), own.column("texts").to_pylist()):
            source = pa.BufferReader(blob)
            text = pa.ipc.open_stream(source).read_all().combine_chunks()
            link = pa.ipc.open_stream(source).read_all()
            unit, key = link.column("unit").to_numpy(), link.column("key").to_numpy()
            known = key < len(count)
            unit, key = unit[known], key[known]
            places = text.column("places").combine_chunks()
            flat = places.values.to_numpy()
            line = np.repeat(np.arange(text.num_rows), np.diff(places.offsets.to_numpy()))
            add = lambda x: _sums(line, _sums(unit, x[key], units)[flat], text.num_rows)  # noqa: E731, B023
            parts.append(pa.table(
                [text.column("digest"), text.column("times"),
                 *(text.column(c) for c in MEASURES[:4]), pa.array(add(best.astype(np.int64))),
                 pa.array(add(count)), text.column("groups_sha256")],
                schema=pa.schema(list(zip(names, types)))))
        return pa.concat_tables(parts) if parts else pa.schema(
            list(zip(names, types))).empty_table()

    ddl = "digest binary, times long, " + ", ".join(f"{c} long" for c in MEASURES) + \
        ", groups_sha256 string"
    measures = landed(chunks.select("chunk", "units", "texts").groupBy("chunk").cogroup(
        answers.groupBy("to")).applyInArrow(measure, ddl), "align-measures")
    discard(chunks)
    return measures, pairs


def _sums(at: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of longs by ``at``, as halves that doubles hold."""
    low = np.bincount(at, weights=(x & ((1 << 26) - 1)), minlength=size).astype(np.int64)
    return (np.bincount(at, weights=x >> 26, minlength=size).astype(np.int64) << 26) + low


def align(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id",
          text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 a document."""
    measures, _ = alignment(docs, paths, id_col, text_col, chunk_bytes)
    own = landed(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(F.when(
            F.col(text_col) != "", F.col(text_col)), 256)).alias("digest")), "align-docs")
    some = measures.agg(F.sum("times")).first()[0] or 0
    limit = max(HOT_SHARE, some // HOT_SHARE)
    values = [*MEASURES, "groups_sha256"]
    rest, often = (measures.where(c).select("digest", *values)
                   for c in (f"times <= {limit}", f"times > {limit}"))
    # Texts of more than a thousandth of all documents: a thousand rows at most.
    hot = own.join(F.broadcast(often), "digest")
    cold = own.where("digest IS NOT NULL").join(
        F.broadcast(often.select("digest")), "digest", "left_anti").join(rest, "digest")
    none = own.where("digest IS NULL").select(
        "digest", "doc_id", *(F.lit(0).cast("long").alias(c) for c in MEASURES),
        F.lit("").alias("groups_sha256"))
    return hot.unionByName(cold).unionByName(none).select("doc_id", *values)
