"""Subword lattice likelihood of texts.

A text, A-Z lower-cased, is its words and one end. A word is spelt by pieces
of an existing subword vocabulary: the word mark and the word's bytes are the
positions of a lattice, each piece that matches there an edge, and the byte
pieces spell what no other piece does. The score of a word is the log of the
probability of all its segmentations together, by a forward recursion in log
space; no piece crosses a word's start, so a text's marginal probability is
the product over its words and the end.

Piece probabilities start from the vocabulary's scores (its pieces' ranks,
taken as Zipf's law) and are trained on the words of all training documents
by expectation maximisation: the forward and backward sums give every piece's
expected count in all segmentations, weighted by the word's count.

Spark: documents become chunks that hold their distinct words and, a document,
places and counts of words. Words are counted over all chunks by one
aggregate; each distinct word meets the lattice once a pass, in batches of
numpy arrays; counts and scores go back to the chunks that hold the word. The
driver sees one number a vocabulary piece. A word in a third of all documents
is one row a chunk.

Defined results: null and empty texts are the end alone; a null id counts as
a training document; repeated rows are documents of their own; words of any
length are scored whole; without training documents every piece keeps the
vocabulary's start and ``train_tokens`` is 0; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.llm.common import landed, once, small_batches, trim

MODULUS, HELD = 7, 2
ROUNDS = 4
CHUNK_BYTES = 32 << 20
ROW_BYTES, ROW_WORDS = 1 << 20, 1 << 14
BATCH_BYTES = 1 << 17
MARK = "▁".encode()
ALPHA = 0.1


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Trie:
    """The vocabulary's pieces by their bytes, as a table of next states.

    Pieces are a word mark at most at their start, and then bytes. Pieces with
    a capital letter, marks within or control pieces match no text here. Byte
    pieces are edges of their byte everywhere. The last piece is the end.
    """

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, ranks = [], []
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if sp.is_byte(i):
                piece = bytes([int(sp.id_to_piece(i)[3:5], 16)])
            else:
                piece = sp.id_to_piece(i).encode()
            inner = piece.removeprefix(MARK)
            if not inner and piece != MARK or MARK in inner or re.search(rb"[A-Z\s]", inner):
                continue
            pieces.append(piece)
            ranks.append(sp.is_byte(i) and sp.get_piece_size() or -sp.get_score(i))
        # A byte piece and a piece of the same single byte are one edge.
        best: dict[bytes, float] = {}
        for p, r in zip(pieces, ranks):
            best[p] = min(best.get(p, r), r)
        for b in range(256):
            best.setdefault(bytes([b]), float(sp.get_piece_size()))
        self.pieces = sorted(best)
        states = {b"": 0}
        for p in self.pieces:
            for n in range(1, len(p) + 1):
                states.setdefault(p[:n], len(states))
        self.next = np.full((len(states), 256), -1, np.int32)
        for s, at in states.items():
            if s:
                self.next[states[s[:-1]], s[-1]] = at
        self.piece = np.full(len(states), -1, np.int32)
        for i, p in enumerate(self.pieces):
            self.piece[states[p]] = i
        weight = 1.0 / (np.array([best[p] for p in self.pieces] + [1.0]) + 2.7)
        self.start = np.log(weight / weight.sum())


def trie(path: str) -> Trie:
    return once(("trie", path), lambda: Trie(path))


class Lattice:
    """All edges of a batch of words, by the place in its word where they end."""

    def __init__(self, words: list[bytes], t: Trie):
        spelt = [MARK + w for w in words]
        text = np.frombuffer(b"".join(spelt), np.uint8)
        self.n = np.array([len(s) for s in spelt], np.int64)
        first = np.cumsum(self.n) - self.n
        self.node = np.cumsum(self.n + 1) - self.n - 1  # the words' first nodes
        owner = np.repeat(np.arange(len(words)), self.n)
        at, state = np.arange(len(text)), np.zeros(len(text), np.int64)
        left = (first + self.n)[owner] - at
        found, begin = [], at
        length = 0
        while len(begin):
            state = t.next[state, text[begin + length]].astype(np.int64)
            length += 1
            live = state >= 0
            begin, state, left = begin[live], state[live], left[live]
            hit = t.piece[state] >= 0
            found.append((begin[hit], np.full(int(hit.sum()), length), t.piece[state[hit]]))
            more = left > length
            begin, state, left = begin[more], state[more], left[more]
        begin, size, self.piece = (np.concatenate(c) for c in zip(*found))
        self.owner = owner[begin]
        self.source = begin + self.owner  # a word of n bytes has n + 1 nodes
        self.target = self.source + size
        self.total = int(len(text) + len(words))
        self.place = self.target - self.node[self.owner]

    def _sweep(self, into, out, steps, value, score):
        """Log sums over edges, grouped by ``steps``, from node ``out`` to ``into``."""
        order = np.lexsort((into, steps))
        cut = np.flatnonzero(np.r_[True, np.diff(steps[order]) != 0])
        for a, b in zip(cut, [*cut[1:], len(order)]):
            e = order[a:b]
            v = value[out[e]] + score[e]
            g = np.flatnonzero(np.r_[True, np.diff(into[e]) != 0])
            top = np.maximum.reduceat(v, g)
            n = np.diff(np.r_[g, len(e)])
            value[into[e][g]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, n)), g))
        return value

    def forward(self, log_p: np.ndarray):
        """Log sum over all ways from a word's first node, at every node."""
        value = np.full(self.total, -np.inf)
        value[self.node] = 0.0
        return self._sweep(self.target, self.source, self.place, value, log_p[self.piece])

    def scores(self, log_p: np.ndarray) -> np.ndarray:
        """The words' marginal log probabilities."""
        return self.forward(log_p)[self.node + self.n]

    def expected(self, log_p: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
        """The pieces' expected counts over all segmentations."""
        ahead = self.forward(log_p)
        back = np.full(self.total, -np.inf)
        back[self.node + self.n] = 0.0
        left = self.n[self.owner] - (self.source - self.node[self.owner])
        self._sweep(self.source, self.target, left, back, log_p[self.piece])
        whole = ahead[self.node + self.n]
        share = np.exp(ahead[self.source] + log_p[self.piece] + back[self.target]
                       - whole[self.owner])
        return np.bincount(self.piece, weights=share * counts[self.owner], minlength=size)


def batches_of(words, limit: int = BATCH_BYTES):
    """Slices of about ``limit`` bytes; a longer word is alone."""
    start, size = 0, 0
    for i, w in enumerate(words):
        if i > start and size + len(w) > limit:
            yield start, i
            start, size = i, 0
        size += len(w) + len(MARK)
    if len(words) > start:
        yield start, len(words)


def held_out(id_col: str, modulus: int, held: int):
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == held, F.lit(False))


def _chunks(docs: DataFrame, id_col, text_col, modulus, held, chunk_bytes) -> DataFrame:
    """(chunk, first, words array<binary>, n array<long>, docs binary). A chunk's
    distinct words and their counts in training documents come in rows of at most
    ``ROW_WORDS``, ``first`` being the place of a row's first word; its documents
    in rows of about ``ROW_BYTES`` of text, as record batches (doc_id, held_out,
    n_tokens, place list, count list). So neither side of the pipe to Python
    holds a row as large as a chunk."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      held_out(id_col, modulus, held).alias("held_out"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    inner = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                       ("place", pa.list_(pa.uint32())), ("count", pa.list_(pa.uint32()))])
    outer = pa.schema([("chunk", pa.int64()), ("first", pa.int64()),
                       ("words", pa.list_(pa.binary())), ("n", pa.list_(pa.int64())),
                       ("docs", pa.binary())])

    def row(chunk, first=None, words=None, n=None, blob=None):
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip((chunk, first, words, n, blob), outer.types)],
            schema=outer)

    def run(batches):
        part, seq, size, packed, n_docs = TaskContext.get().partitionId(), 0, 0, 0, 0
        places: dict[bytes, int] = {}
        n = np.zeros(0, np.int64)
        rows: list = []

        def documents():
            nonlocal n, rows, packed
            if len(places) > len(n):
                n = np.r_[n, np.zeros(len(places) - len(n), np.int64)]
            for _, out, _, at, count in rows:
                if not out:
                    n[at] += count
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, inner, options=pa.ipc.IpcWriteOptions(
                    compression="zstd")) as w:
                w.write_batch(pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), inner.types)], schema=inner))
            rows, packed = [], size
            return row(part << 24 | seq, blob=sink.getvalue().to_pybytes())

        def distinct():
            words = iter(places)
            for a in range(0, len(places), ROW_WORDS):
                yield row(part << 24 | seq, a, list(islice(words, ROW_WORDS)),
                          n[a:a + ROW_WORDS])

        for batch in batches:
            ids, out = (batch.column(c).to_pylist() for c in ("doc_id", "held_out"))
            texts = batch.column("text")
            for i in range(batch.num_rows):
                # Lower-cases A-Z and splits at ASCII white space only.
                words = texts[i].as_py().encode().lower().split()
                found = Counter(words)
                at = np.array([places.setdefault(w, len(places)) for w in found], np.uint32)
                rows.append((ids[i], out[i], len(words) + 1, at,
                             np.fromiter(found.values(), np.uint32, len(found))))
                size += sum(map(len, words)) + len(words)
                n_docs += 1
                full = size >= chunk_bytes or n_docs >= 1 << 16
                if full or size - packed >= ROW_BYTES or len(rows) >= 1 << 13:
                    yield documents()
                if full:
                    yield from distinct()
                    places, n, size, packed, n_docs, seq = {}, n[:0].copy(), 0, 0, 0, seq + 1
        if rows:
            yield documents()
        yield from distinct()
        places, n = {}, n[:0].copy()
        trim()

    return own.mapInArrow(
        run, "chunk long, first long, words array<binary>, n array<long>, docs binary")


def _words(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("word").to_pylist()


def trained(counts: DataFrame, ends: int, path: str, rounds: int) -> np.ndarray:
    """Log probabilities of the pieces and, last, the end, by expectation
    maximisation over the counted words."""
    t = trie(path)
    log_p, size = t.start, len(t.pieces)

    def expect(log_p):
        def run(batches):
            own, total = trie(path), np.zeros(size)
            for batch in batches:
                words, n = _words(batch), batch.column("n").to_numpy()
                for a, b in batches_of(words):
                    total += Lattice(words[a:b], own).expected(log_p, n[a:b], size)
            some = np.flatnonzero(total)
            trim()
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)),
                                              pa.array(total[some])], names=["piece", "n"])
        return run

    if not ends:
        return log_p
    known = counts.where("n > 0").select("word", "n")
    for _ in range(rounds):
        sums = known.mapInArrow(expect(log_p), "piece int, n double").groupBy("piece").agg(
            F.sum("n").alias("n"))
        n = np.full(size + 1, ALPHA)
        for r in sums.collect():  # at most a row a piece of the vocabulary
            n[r["piece"]] += r["n"]
        n[size] += ends
        log_p = np.log(n / n.sum())
    return log_p


def score(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS, id_col: str = "doc_id",
          text_col: str = "text", modulus: int = MODULUS, held: int = HELD,
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score a document."""
    path = path or vocabulary()
    with small_batches(docs.sparkSession):
        chunks = landed(_chunks(docs, id_col, text_col, modulus, held, chunk_bytes),
                        "lattice-chunks")
    ends = docs.where(~held_out(id_col, modulus, held)).count()
    listed = chunks.where("words is not null")
    pairs = listed.select(F.explode(F.arrays_zip("words", "n")).alias("x")).select(
        F.col("x.words").alias("word"), F.col("x.n").alias("n"))
    counts = landed(pairs.groupBy("word").agg(F.sum("n").alias("n")), "lattice-counts")
    known = counts.where("n > 0").agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    tokens = (known["n"] or 0) + ends
    distinct = known["v"] + (ends > 0)
    log_p = trained(counts, ends, path, rounds)

    def each(batches):
        own = trie(path)
        for batch in batches:
            words = _words(batch)
            out = [Lattice(words[a:b], own).scores(log_p) for a, b in batches_of(words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"),
                 pa.array(np.concatenate(out) if out else np.empty(0))], names=["word", "n", "lp"])
        trim()

    scored = counts.mapInArrow(each, "word binary, n long, lp double")
    asked = listed.select("chunk", "first", F.posexplode("words").alias("at", "word"))
    answers = asked.join(scored, "word").select(
        F.col("chunk").alias("to"), (F.col("first") + F.col("at")).alias("place"), "n", "lp")
    end_lp = float(log_p[-1])
    log_all = np.log10(float(tokens + distinct + 1))
    result = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def measure(own: pa.Table, back: pa.Table) -> pa.Table:
        n, lp = np.zeros(back.num_rows, np.int64), np.zeros(back.num_rows)
        at = back.column("place").to_numpy()
        n[at], lp[at] = back.column("n").to_numpy(), back.column("lp").to_numpy()
        base = np.log10(n + 1.0) - log_all
        parts = []
        for blob in own.column("docs").to_pylist():
            t = pa.ipc.open_stream(blob).read_all().combine_chunks()
            place, count = (t.column(c).combine_chunks() for c in ("place", "count"))
            at, tf = (c.values.to_numpy() for c in (place, count))
            doc = np.repeat(np.arange(t.num_rows), np.diff(place.offsets.to_numpy()))
            add = lambda x: np.bincount(doc, weights=x, minlength=t.num_rows)  # noqa: E731, B023
            tokens_of = t.column("n_tokens").to_numpy()
            parts.append(pa.table([
                t.column("doc_id"), t.column("held_out"), pa.array(tokens_of),
                pa.array(add(tf * (n[at] > 0)).astype(np.int64) + (ends > 0)),
                pa.array(np.full(t.num_rows, tokens)),
                pa.array(add(tf * base[at]) + np.log10(ends + 1.0) - log_all),
                pa.array((add(tf * lp[at]) + end_lp) / np.log(10.0))], schema=result))
        return pa.concat_tables(parts) if parts else result.empty_table()

    return chunks.where("docs is not null").select("chunk", "docs").groupBy("chunk").cogroup(
        answers.groupBy("to")).applyInArrow(
        measure, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                 "train_tokens long, base_score double, score double")
