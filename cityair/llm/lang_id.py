"""Language identification with error-correcting output codes.

Every language gets a binary codeword. For each bit a binary classifier
(logistic regression on hashed byte n-grams of one, two and three bytes of
the lower-cased text) predicts that bit. Loss-weighted decoding sums, for each
language, the logistic losses of its codeword against all margins, weighted
by how sure each bit's classifier is on its training rows; the nearest
codeword wins, and a document is ambiguous if the second nearest is close.

For up to five languages the code is exhaustive (every way to
split them in two); for more it is a random code with large
distances, drawn with a fixed seed.

Training uses a bounded sample: of every language at most ``sample`` labelled
documents (a documented parameter), the share being set by counts over the
whole table and the choice by a hash of the id. Prediction reads whole texts.

Defined results: null texts and texts without a letter are ``und`` with
score 0; null languages and null ids are not learned from; without labelled
documents everything is ``und``; with one learned language every document
with a letter gets it; equal losses go to the language first by code point;
repeated rows are predicted alike; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.llm.common import landed

BUCKETS = 1 << 12
SAMPLE = 400
SEED = 5
CLOSE = 0.15
_LOWER = np.arange(256, dtype=np.int64)
_LOWER[ord("A"):ord("Z") + 1] += 32


def features(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Unit vector of root frequencies of hashed byte n-grams; the text is
    read in pieces, so a very long one needs no more memory."""
    counts = np.zeros(buckets)
    for start in range(0, len(text), 1 << 20):
        b = _LOWER[np.frombuffer(text[start:start + (1 << 20) + 2], np.uint8)]
        last = min(len(b), 1 << 20)
        counts += np.bincount(b[:last], minlength=buckets)
        two = b[:-1] * 257 + b[1:]
        counts += np.bincount((two[:last] * 40503 >> 4) % buckets, minlength=buckets)
        three = two[:-1] * 263 + b[2:]
        counts += np.bincount((three[:last] * 2654435761 >> 9) % buckets, minlength=buckets)
    root = np.sqrt(counts)
    return root / max(1e-12, float(np.sqrt(counts.sum())))


def codewords(n: int, seed: int = SEED) -> np.ndarray:
    """(languages, bits) of -1 and 1."""
    if n <= 1:
        return np.ones((n, 0))
    if n <= 5:  # every split of the languages into two sides
        rows = [c for c in itertools.product((-1, 1), repeat=n) if c[0] == 1 and min(c) < 0]
        return np.array(rows, float).T
    bits = max(15, int(10 * math.log2(n)))
    rng = np.random.default_rng(seed)
    best, best_gap = None, -1
    for _ in range(200):
        code = rng.choice((-1.0, 1.0), (n, bits))
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        gap = min((bits - np.abs(code[i] @ code[:i].T)).min() for i in range(1, n))
        if gap > best_gap:
            best, best_gap = code, gap
    return best


def train_bits(x: np.ndarray, bits: np.ndarray, rounds: int = 200, rate: float = 4.0,
               decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features + 1, bits) of one logistic regression for each bit,
    by accelerated gradient steps; rows of rarer sides count more."""
    x = np.hstack([x, np.ones((len(x), 1))])
    side = (bits > 0).mean(axis=0)
    weight = np.where(bits > 0, 0.5 / np.maximum(side, 1e-9), 0.5 / np.maximum(1 - side, 1e-9))
    w = np.zeros((x.shape[1], bits.shape[1]))
    ahead = w.copy()
    for i in range(rounds):
        margin = bits * (x @ ahead)
        push = weight * bits / (1 + np.exp(np.clip(margin, -60, 60)))
        new = ahead + rate * (x.T @ push / len(x) - decay * ahead)
        ahead = new + i / (i + 3) * (new - w)
        w = new
    right = (np.sign(x @ w) == bits).mean(axis=0)
    return w, np.clip(2 * right - 1, 0.05, 1.0)


def decode(margins: np.ndarray, code: np.ndarray, trust: np.ndarray):
    """Nearest codeword by weighted logistic loss: (class, score, ambiguous)."""
    loss = np.log1p(np.exp(-np.clip(margins[:, None, :] * code[None], -60, 60))) @ (
        trust / max(1e-12, trust.sum()))
    order = np.argsort(loss, axis=1, kind="stable")
    near = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
    score = near.max(axis=1) / near.sum(axis=1)
    rows = np.arange(len(loss))
    gap = loss[rows, order[:, min(1, loss.shape[1] - 1)]] - loss[rows, order[:, 0]]
    return order[:, 0], score, (gap < CLOSE) & (loss.shape[1] > 1)


def _held_out(id_col):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang",
        sample: int = SAMPLE, buckets: int = BUCKETS):
    """(languages, code, weights, trust) from labelled documents that are not
    held out. Counts by language bound the sample; its features are made in
    tasks, the bits are trained on the driver from at most ``sample`` rows a
    language."""
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.col(lang_col).alias("lang")).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
        & ~_held_out("doc_id"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return [], np.ones((0, 0)), None, None
    langs = sorted(counts)
    # At most 16 times the sample in all, however many languages there are.
    bound = max(8, min(sample, 16 * sample // len(langs)))
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, min(1.0, bound / counts[lang])).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.where(draw < share)

    def make(batches):
        for batch in batches:
            t = batch.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"),
                 pa.array([features(x, buckets).astype(np.float32).tobytes() for x in t],
                          pa.binary())], names=["lang", "x"])

    rows = drawn.select("lang", "text").mapInArrow(make, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    langs = sorted({r["lang"] for r in rows})
    code = codewords(len(langs))
    if len(langs) < 2:
        return langs, code, None, None
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64)
    y = np.searchsorted(langs, [r["lang"] for r in rows])
    w, trust = train_bits(x, code[y])
    return langs, code, w, trust


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", sample: int = SAMPLE, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every document."""
    langs, code, w, trust = fit(docs, id_col, text_col, lang_col, sample, buckets)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()),
                        ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("ambiguous", pa.bool_())])

    def predict(batches):
        names = np.array(langs + ["und"], object)
        for batch in batches:
            text = batch.column("text")
            has = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(
                zero_copy_only=False)
            pred = np.full(batch.num_rows, len(langs))
            score, close = np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            at = np.flatnonzero(has) if langs else []
            if len(at) and len(langs) == 1:
                pred[at], score[at], close[at] = 0, 1.0, False
            elif len(at):
                t = text.cast(pa.large_binary())
                margins = np.array([features(t[int(i)].as_py(), buckets) @ w[:-1] + w[-1]
                                    for i in at])
                pred[at], score[at], close[at] = decode(margins, code, trust)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(names[pred].tolist(), pa.string()), pa.array(score), pa.array(close)],
                schema=schema)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      _held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return own.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, "
                          "score double, ambiguous boolean")


__all__ = ["identify", "fit", "features", "codewords", "train_bits", "decode", "landed"]
