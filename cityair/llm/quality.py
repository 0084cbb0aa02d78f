"""Quality classifier with hierarchical empirical Bayes.

A logistic regression on surface statistics of the text (case, symbols,
digits, word lengths, repeated words and five-word shingles) gives each
document's evidence, the log-likelihood ratio of good against bad. Sites are
hosts and, below them, paths. Grouped aggregation counts every path's
documents and expected good ones; a host's posterior shrinks its mean towards
the global rate, a path's towards its host's posterior. How strongly is
estimated from the spread between sites (Beta priors by the method of
moments), so sparse sites stay near their prior. A document's posterior
combines its path's posterior, as prior odds, with its own evidence.

Training takes the ``sample`` labelled documents that come first in the order
of a hash of their id (a bounded sample; the bound is a parameter);
counts and posteriors cover all documents.

Defined results: null and empty texts have no evidence (0) and follow their
site; null hosts and paths are sites of their own; without labels of both
kinds evidence is 0 and everything is kept; of several labels for an id the
best counts; repeated rows count as often as they occur; null ids pass
through; a posterior of exactly ``reject`` is kept; an empty table gives an
empty result; extra columns are ignored by ``judge`` and kept by ``good_rows``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.llm.common import landed, unused
from cityair.llm.near_dup import shingles

SAMPLE = 4000
REJECT = 0.5
LABEL_KEY = "doc_id"
_CLASSES = np.zeros(256, np.int64)
for _i, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                           b"0123456789", b" \t\r", b"\n", b".,;:'\"()-", b"!?",
                           b"#$%&*@^~|<>{}[]\\/_=+`"), 1):
    _CLASSES[list(_set)] = _i
_CLASSES[128:] = 9
N_FEATURES = 16


def features(texts: list[bytes | None], group_bytes: int = 1 << 20) -> np.ndarray:
    """(texts, N_FEATURES) surface statistics, made for groups of texts of
    about ``group_bytes`` to bound memory."""
    out, start = [np.zeros((0, N_FEATURES))], 0
    while start < len(texts):
        stop, held = start, 0
        while stop < len(texts) and (stop == start or held < group_bytes):
            held += len(texts[stop] or b"")
            stop += 1
        out.append(_features(texts[start:stop]))
        start = stop
    return np.concatenate(out)


def _features(texts: list[bytes | None]) -> np.ndarray:
    out = np.zeros((len(texts), N_FEATURES))
    doc, key, words = shingles(texts)
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    again = np.r_[False, (d[1:] == d[:-1]) & (k[1:] == k[:-1])] if len(d) else np.zeros(0, bool)
    repeated = np.bincount(d[again], minlength=len(texts)) / np.maximum(
        1, np.bincount(d, minlength=len(texts)))
    for i, t in enumerate(texts):
        if not t:
            continue
        part = np.bincount(_CLASSES[np.frombuffer(t, np.uint8)], minlength=10) / len(t)
        own = t.split()
        n = max(1, len(own))
        lines = [x for x in t.split(b"\n") if x.strip()]
        out[i, :10] = np.sqrt(part)
        out[i, 10] = repeated[i]
        out[i, 11] = len(set(own)) / n
        out[i, 12] = np.log1p(words[i]) / 10
        out[i, 13] = min(3.0, len(t) / n / 10)
        out[i, 14] = 1 - len(set(lines)) / max(1, len(lines))
        out[i, 15] = min(3.0, part[6] + part[7]) * n / max(1, len(t)) * 10
    return out


def _terms(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, x * x, np.ones((len(x), 1))])


def train(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 40):
    """(weights, mean, scale, prior log-odds) of a ridge logistic regression
    by Newton steps."""
    raw = _terms(x)
    mean, scale = raw.mean(axis=0), raw.std(axis=0) + 1e-9
    mean[-1], scale[-1] = 0.0, 1.0
    z = (raw - mean) / scale
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) / len(y) - ridge * w
        step = np.linalg.solve(z.T * (p * (1 - p)) @ z / len(y) + (ridge + 1e-6) * np.eye(
            len(w)), grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    rate = y.mean()
    return w, mean, scale, float(np.log(rate / (1 - rate)))


def evidence(texts: list[bytes | None], model) -> np.ndarray:
    if model is None:
        return np.zeros(len(texts))
    w, mean, scale, prior = model
    logit = (_terms(features(texts)) - mean) / scale @ w - prior
    empty = np.array([not t for t in texts], bool)
    return np.where(empty, 0.0, np.clip(logit, -20, 20))


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text",
        sample: int = SAMPLE):
    """The document classifier, or None without labels of both kinds."""
    known = labels.where(F.col(LABEL_KEY).isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col(LABEL_KEY).cast("long").alias("id")).agg(F.max("quality").alias("good"))
    drawn = landed(known.orderBy(F.xxhash64("id"), "id").limit(sample), "quality-labels")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = own.join(F.broadcast(drawn), "id").where("text is not null")  # at most ``sample`` rows

    def make(batches):
        for batch in batches:
            x = features(batch.column("text").cast(pa.large_binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("good").cast(pa.int64()),
                 pa.array(list(x), pa.list_(pa.float64()))], names=["id", "good", "x"])

    got = rows.select("id", "good", "text").mapInArrow(
        make, "id long, good long, x array<double>").collect()
    got.sort(key=lambda r: (r["id"], r["x"]))
    y = np.array([r["good"] > 0 for r in got], float)
    if not len(y) or y.min() == y.max():
        return None
    return train(np.array([r["x"] for r in got]), y)


def _strength(rate, spread: float, noise: float) -> float:
    """Prior strength, in documents, of sites around ``rate``: the method of
    moments for a Beta prior, within sensible limits."""
    between = max(spread - noise, 1e-6)
    return float(np.clip(rate * (1 - rate) / between - 1, 2.0, 1e4))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, host_posterior, path_posterior) from (host, path,
    evidence) of all documents."""
    first = scored.agg(F.avg(_odds_to_p(F.col("evidence")))).first()[0]
    rate = float(np.clip(0.5 if first is None else first, 1e-4, 1 - 1e-4))
    for _ in range(3):  # the global rate that agrees with its own posteriors
        shift = float(np.log(rate / (1 - rate)))
        rate = float(np.clip(scored.agg(F.avg(_odds_to_p(F.col("evidence") + shift))).first()[0]
                             if first is not None else rate, 1e-4, 1 - 1e-4))
    shift = float(np.log(rate / (1 - rate)))
    paths = landed(scored.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum(_odds_to_p(F.col("evidence") + shift)).alias("good")),
        "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    spread = hosts.agg(
        F.sum(F.pow(F.col("host_good") / F.col("host_n") - rate, 2) * F.col("host_n")).alias("v"),
        F.sum("host_n").alias("n"), F.count("*").alias("sites")).first()
    noise = lambda s: rate * (1 - rate) * s["sites"] / max(1, s["n"] or 0)
    strong = _strength(rate, (spread["v"] or 0.0) / max(1, spread["n"] or 0), noise(spread))
    hosts = landed(hosts.select("host", (
        (F.lit(strong * rate) + F.col("host_good")) / (F.lit(strong) + F.col("host_n"))).alias(
            "host_posterior")), "quality-hosts")
    both = paths.join(hosts, "host")
    spread = both.agg(
        F.sum(F.pow(F.col("good") / F.col("n") - F.col("host_posterior"), 2) * F.col("n")).alias(
            "v"), F.sum("n").alias("n"), F.count("*").alias("sites")).first()
    strong = _strength(rate, (spread["v"] or 0.0) / max(1, spread["n"] or 0), noise(spread))
    return landed(both.select("host", "path", "host_posterior", (
        (F.lit(strong) * F.col("host_posterior") + F.col("good")) / (F.lit(strong) + F.col("n")))
        .alias("path_posterior")), "quality-sites")


def _odds_to_p(x):
    return 1 / (1 + F.exp(-x))


NO_SITE = "\u0000null"  # null hosts and paths are a site of their own


def _site(column):
    return F.coalesce(F.col(column).cast("string"), F.lit(NO_SITE))


def _posterior():
    p = F.least(F.greatest(F.col("path_posterior"), F.lit(1e-6)), F.lit(1 - 1e-6))
    return _odds_to_p(F.col("evidence") + F.log(p / (1 - p)))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang", sample: int = SAMPLE,
          reject: float = REJECT) -> DataFrame:
    """doc_id, host, path, evidence, host_posterior, path_posterior, quality
    (the document's posterior) and keep, for every document."""
    model = fit(docs, labels, id_col, text_col, sample)

    def score(batches):
        for batch in batches:
            e = evidence(batch.column("text").cast(pa.large_binary()).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "host", "path")), pa.array(e)],
                names=["doc_id", "host", "path", "evidence"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), _site(host_col).alias("host"),
                      _site(path_col).alias("path"), F.col(text_col).alias("text"))
    scored = landed(own.mapInArrow(score, "doc_id long, host string, path string, "
                                          "evidence double"), "quality-scored")
    return scored.join(site_posteriors(scored), ["host", "path"]).withColumn(
        "quality", _posterior()).select(
        "doc_id", *(F.nullif(F.col(c), F.lit(NO_SITE)).alias(c) for c in ("host", "path")),
        "evidence", "host_posterior", "path_posterior", "quality",
        (F.col("quality") >= reject).alias("keep"))


def good_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source", path_col: str = "lang", sample: int = SAMPLE,
              reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps."""
    model = fit(docs, labels, id_col, text_col, sample)
    extra = unused(docs.columns, "evidence_")

    def score(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            e = evidence(batch.column(at).cast(pa.large_binary()).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(e)],
                                             names=[*batch.schema.names, extra])

    from pyspark.sql.types import DoubleType, StructType
    wide = StructType([*docs.schema.fields]).add(extra, DoubleType())
    light = docs.select(_site(host_col).alias("host"), _site(path_col).alias("path"),
                        F.col(text_col).alias("text"))

    def light_score(batches):
        for batch in batches:
            e = evidence(batch.column("text").cast(pa.large_binary()).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("path"),
                                              pa.array(e)], names=["host", "path", "evidence"])

    scored = landed(light.mapInArrow(light_score, "host string, path string, evidence double"),
                    "quality-scored")
    sites = site_posteriors(scored).select(
        F.col("host").alias("host__site"), F.col("path").alias("path__site"), "path_posterior")
    marked = docs.mapInArrow(score, wide)
    full = marked.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         F.col(extra).alias("evidence"), _site(host_col).alias("host__site"),
                         _site(path_col).alias("path__site"))
    return full.join(sites, ["host__site", "path__site"]).where(_posterior() >= reject).select(
        "row.*")
