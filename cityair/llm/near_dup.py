"""Near-duplicate classes by consistent weighted sampling.

A document is the weighted set of its five-word shingles. A shingle weighs
``tf * idf`` with a normalised, damped inverse document frequency::

    idf = 1 + damping * (1 - ln(df) / ln(N))

where df counts documents that hold the shingle and N documents, over the
whole corpus. The damping (0.1, a parameter) keeps idf between 1 and 1.1:
with plain ``ln(N / df)`` a text copied thousands of times would weigh next
to nothing against an edit, and its near copies would stop looking alike.

Steps: (1) count df over all documents (keys by range, deduplicated in their
chunk); (2) sketch each document by consistent weighted sampling, every
value by draws of its own over all shingles: a weight is cut into layers of
idf's upper bound, a repeated shingle has a layer for each time, so a value's
cost is one draw a word and two sketch values are equal with the probability
of the weighted Jaccard similarity, whatever the weights; (3) identical texts
become one representative; representatives that share a band of sketch
values become candidates of the first and the last member of that band's
bucket in a fixed random order (aggregates, so a bucket that holds a third
of all rows is combined map-side; no pairs within a bucket); (4) every
candidate pair is verified by exact weighted Jaccard similarity, a leader's
members being dealt to groups of bounded size; (5) members of a bucket whom
its leaders leave in different classes are compared with each other, in pairs
of blocks (a bucket's most frequent class only with the other members), so
every pair that shares a band is verified or already in one class. Only those
are compared that can have a partner: two sets of similarity t or more share a
shingle among the rarest ones that hold more than 1 - t of either's weight, so
a member stays out that shares none of its rarest shingles with any member of
another class; (6) connected components of verified pairs by minimum labels,
over links that span: a member is linked to one of its leaders and these to
each other, and a pair of blocks yields a link for each merge of classes.

Defined results: texts without a word (null, empty, white space) are never
duplicates; fewer than five words make one shingle of all words; repeated
rows are copies; null ids pass through; ties go to the smaller row
reference; an empty table gives an empty result; extra columns are ignored
by ``classes`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.llm.chunks import (REF_BITS, count_keys, key_ranges, look_up, pack_rows, text_bytes,
                                unpack)
from cityair.llm.common import discard, landed, mix64, once, reclaim

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
DAMPING = 0.1
GROUP = 64
BLOCK = 64
_U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_MULT = 0xD6E8FEB86659FD93
_BYTE_KEYS = mix64(np.arange(1, 257, dtype=np.uint64), 11)
_LAST, _LEVEL = ~_U(0), _U((1 << 24) - 1)
LAYERS = 1 << 17
PIECE = 1 << 17


def _words(data: np.ndarray):
    """Start and fingerprint of every word of a buffer that ends with white
    space; the buffer is read in pieces of about ``PIECE`` bytes."""
    size = PIECE * 2 if len(data) > PIECE else len(data)
    powers, starts, keys, begin = _powers(size), [], [], 0
    while begin < len(data):
        end = min(begin + PIECE, len(data))
        while not _WHITE[data[end - 1]]:  # up to the end of a word
            more = np.flatnonzero(_WHITE[data[end:end + PIECE]])
            end = end + int(more[0]) + 1 if len(more) else min(end + PIECE, len(data))
        piece = data[begin:end]
        if len(piece) > size:
            size = len(piece)
            powers = _powers(size)
        up, down = powers
        white = np.empty(len(piece) + 1, bool)
        white[0] = True
        np.take(_WHITE, piece, out=white[1:], mode="clip")
        edge = np.flatnonzero(white[1:] != white[:-1])
        start, stop = edge[::2], edge[1::2]
        prefix = np.zeros(len(piece) + 1, np.uint64)
        spelt = np.take(_BYTE_KEYS, piece, out=prefix[1:], mode="clip")
        np.cumsum(np.multiply(spelt, up[:len(piece)], out=spelt), out=spelt)
        keys.append(mix64((prefix[stop] - prefix[start]) * down[start]
                          + (stop - start).astype(np.uint64), 3))
        starts.append(start + begin)
        begin = end
    return np.concatenate(starts), np.concatenate(keys)


def _powers(n: int):
    """The first ``n`` powers of the fingerprint's factor, and of its inverse."""
    if n > 2 * PIECE:  # one very long word
        return _made_powers(n)
    return tuple(p[:n] for p in once(("neardup-powers", PIECE), lambda: _made_powers(2 * PIECE)))


def _made_powers(n: int):
    up, down = np.full(n, _MULT, np.uint64), np.full(n, pow(_MULT, -1, 1 << 64), np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def shingles(texts: list[bytes | None], size: int = SHINGLE):
    """Shingle fingerprints of many texts: (document index, fingerprint, one
    for each place where a shingle starts), and each text's number of words."""
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    lens = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    start, word = _words(np.frombuffer(joined, np.uint8))
    ends = np.searchsorted(start, np.cumsum(lens))
    words = np.diff(ends, prepend=0)
    # Five consecutive words of one text; a shorter text has one shingle.
    n = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), n)
    # Shingles of ``size`` words at every place, whatever text it is in.
    whole = np.zeros(max(0, len(word) - size + 1), np.uint64)
    for j in range(size):
        np.bitwise_xor(whole, word[j:j + len(whole)], out=whole)
        whole = mix64(whole, 4)
    at = np.arange(len(doc)) + np.repeat(ends - words - (np.cumsum(n) - n), n)
    short = np.flatnonzero(words[doc] < size)
    key = np.take(whole, at, mode="clip") if len(whole) else np.zeros(len(at), np.uint64)
    key[short] = 0
    for j in range(size):
        inside = short[j < words[doc[short]]]
        key[inside] = mix64(key[inside] ^ word[at[inside] + j], 4)
    return doc, key, words


def _distinct(doc: np.ndarray, key: np.ndarray):
    """Each document's distinct shingles, sorted, with their frequency; the
    shingles come document by document."""
    d, k = doc, key.copy()
    cut = np.flatnonzero(np.r_[True, d[1:] != d[:-1], True]) if len(d) else [0]
    for a, b in zip(cut[:-1], cut[1:]):
        k[a:b].sort()
    new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (k[1:] != k[:-1])]) if len(d) else []
    tf = np.diff(np.r_[new, len(d)]).astype(np.float64)
    return (d[new], k[new], tf) if len(d) else (d, k, tf)


def _weights(tf, df, n_docs: int, damping: float):
    return tf * (1 + damping * (1 - np.log(df) / math.log(max(2, n_docs))))


def _asked_sets(own: pa.Table, asked: pa.Table, text: str, n_docs: int, damping: float):
    """The weighted shingles of a chunk's rows that ``asked`` names by ``ref``,
    with their document counts as ``_sketches`` found them: {ref: (keys,
    weights, df)}. No other text of the chunk is looked at."""
    known = dict(zip(asked.column("ref").to_pylist(), asked.column("df").to_pylist()))
    at = np.fromiter(known, np.int64, len(known)) & ((1 << REF_BITS) - 1)
    rows = unpack(own.column("rows")[0]).column(text).take(pa.array(at))
    d, k, tf = _distinct(*shingles(text_bytes(rows))[:2])
    df = np.frombuffer(b"".join(known.values()), np.uint32)
    w = _weights(tf, df, n_docs, damping)
    cut = np.searchsorted(d, np.arange(len(known) + 1))
    return {ref: (k[a:b], w[a:b], df[a:b]) for ref, a, b in zip(known, cut[:-1], cut[1:])}


def sketch(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, bins: int,
           height: float = 1.0) -> np.ndarray:
    """Consistent weighted samples, (n, bins), each bin by draws of its own
    over all shingles (which come document by document); rows of documents
    without shingles hold zeros.

    A weight is cut into layers of ``height``, the last one filled in part.
    In every layer points arrive in time, at random levels, the same ones in
    all documents; a document's sample is the first point within the filled
    part of its layers. Two samples are then equal with the probability
    (sum of lesser weights) / (sum of greater weights)."""
    out = np.full((bins, n), _LAST)
    bin_keys = mix64(np.arange(bins, dtype=np.uint64), 24)
    layers = np.maximum(1, np.ceil(weight / height)).astype(np.int64)
    ends = np.cumsum(layers)
    cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(
        LAYERS, ends[-1], LAYERS), "right"), len(key)]) if len(key) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        at = np.repeat(np.arange(a, b), layers[a:b])
        layer = np.arange(len(at)) - (ends[at] - layers[at] - (ends[a] - layers[a]))
        seed = mix64(key[at] ^ mix64(layer.astype(np.uint64), 21), 22)
        filled = np.minimum(weight[at] / height - layer, 1.0)
        level = np.maximum(1, np.ceil(filled * (1 << 24))).astype(np.uint64)
        first = np.flatnonzero(np.r_[True, doc[at[1:]] != doc[at[:-1]]])
        size = np.diff(np.r_[first, len(at)])
        own, run = doc[at[first]], np.repeat(np.arange(len(first)), size)
        level_min = np.minimum.reduceat(level, first)
        x, spare = np.empty_like(seed), np.empty_like(seed)
        for j in range(bins):
            # High bits are the time of a layer's first point, low bits its level.
            np.bitwise_xor(seed, bin_keys[j], out=x)
            _scramble(x, spare)
            least = np.minimum.reduceat(x, first)
            # A level below that of every layer is within the filled part of its
            # own; the other documents' layers are looked at one by one.
            late = np.flatnonzero((least & _LEVEL) >= level_min)
            if len(late):
                begin = np.cumsum(size[late]) - size[late]
                over = np.arange(int(size[late].sum())) + np.repeat(first[late] - begin,
                                                                    size[late])
                point = x[over]
                outside = (point & _LEVEL) >= level[over]
                least[late] = np.minimum.reduceat(np.where(outside, _LAST, point), begin)
                outside &= point < least[run[over]]
                if outside.any():
                    over = over[outside]
                    _later_points(over, x[over], level, run, least)
            out[j, own] = np.minimum(out[j, own], least)
    out[out == _LAST] = 0
    return out.T


def _scramble(x: np.ndarray, spare: np.ndarray) -> None:
    """Mix evenly spread 64-bit numbers anew, in place."""
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        np.multiply(x, _U(factor), out=x)
        np.right_shift(x, _U(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)


def _later_points(over, point, level, run, least) -> None:
    """Layers whose points so far lie over their filled part: their next points,
    as long as these come before the document's sample, which they replace."""
    state, time = point, None
    while True:
        open_ = point < least[run[over]]
        if not open_.any():
            return
        over, state, point = over[open_], state[open_], point[open_]
        spent = -np.log1p(-(state >> _U(24)).astype(np.float64) * 2.0 ** -40)
        time = spent if time is None else time[open_] + spent
        state = mix64(state, 23)
        gap = -np.log1p(-(state >> _U(24)).astype(np.float64) * 2.0 ** -40)
        ticks = np.minimum(-np.expm1(-(time + gap)) * 2.0 ** 40, 2.0 ** 40 - 1).astype(np.uint64)
        point = (ticks << _U(24)) | (state & _LEVEL)
        inside = (state & _LEVEL) < level[over]
        np.minimum.at(least, run[over[inside]], point[inside])
        over, state, point, time = (v[~inside] for v in (over, state, point, time))


def bands_of(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signature), bands), np.uint64)
    for b in range(bands):
        acc = np.full(len(signature), b + 1, np.uint64)
        for j in range(b * rows, (b + 1) * rows):
            acc = mix64(acc ^ signature[:, j], 31)
        out[:, b] = acc
    return out


def jaccard(a, b) -> float:
    """Weighted Jaccard similarity of (sorted keys, weights) pairs."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def _sketches(packed, df_answers, text, n_docs, damping, bands, rows):
    """(ref, text_hi, text_lo, bands, df) of every row with a word; df holds the
    document counts of its distinct shingles, in ascending order of these."""
    schema = pa.schema([("ref", pa.int64()), ("text_hi", pa.int64()), ("text_lo", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("df", pa.binary())])

    def run(own: pa.Table, answer: pa.Table) -> pa.Table:
        if own.num_rows == 0:
            return schema.empty_table()
        chunk = own.column("chunk")[0].as_py()
        texts = text_bytes(unpack(own.column("rows")[0]).column(text))
        doc, key, words = shingles(texts)
        d, k, tf = _distinct(doc, key)
        df = look_up(k, answer)[0]
        w = _weights(tf, df, n_docs, damping)
        cut = np.searchsorted(d, np.arange(len(texts) + 1))
        sig = bands_of(sketch(d, k, w, len(texts), bands * rows, max(1.0, 1 + damping)),
                       bands, rows).view(np.int64)
        has = np.flatnonzero(words)
        same = [xxhash.xxh3_128_digest(texts[i]) for i in has]
        same = np.frombuffer(b"".join(same), np.int64).reshape(-1, 2)
        return pa.table([(chunk << REF_BITS) + has, same[:, 0], same[:, 1],
                         pa.array(list(sig[has]), pa.list_(pa.int64())),
                         pa.array([df[cut[i]:cut[i + 1]].tobytes() for i in has], pa.binary())],
                        schema=schema)

    return landed(packed.groupBy("chunk").cogroup(df_answers.groupBy("chunk")).applyInArrow(
        run, "ref long, text_hi long, text_lo long, bands array<long>, df binary"),
        "neardup-sketches")


def _candidates(reps: DataFrame) -> DataFrame:
    """(ref, leader) pairs, distinct: each bucket's members with its first
    and last member in a fixed random order."""
    placed = reps.select("ref", F.posexplode("bands").alias("band", "key"))
    order = F.struct(F.xxhash64("ref"), F.col("ref"))
    buckets = (placed.groupBy("band", "key")
               .agg(F.count("*").alias("n"), F.min(order).alias("lo"), F.max(order).alias("hi"))
               .where("n > 1").select("band", "key", F.col("lo.ref").alias("lo"),
                                      F.col("hi.ref").alias("hi")))
    buckets = landed(buckets, "neardup-buckets")
    both = placed.join(buckets, ["band", "key"])
    pairs = both.select("ref", F.explode(F.array("lo", "hi")).alias("leader")).where(
        "ref <> leader")
    pairs = pairs.select(F.greatest("ref", "leader").alias("a"), F.least("ref", "leader").alias(
        "b")).distinct()
    # The leader of a pair is the end that comes first in the random order.
    first = F.struct(F.xxhash64("a"), F.col("a")) < F.struct(F.xxhash64("b"), F.col("b"))
    return landed(pairs.select(F.when(first, F.col("b")).otherwise(F.col("a")).alias("ref"),
                               F.when(first, F.col("a")).otherwise(F.col("b")).alias("leader")),
                  "neardup-candidates")


def _counts(sketched: DataFrame) -> DataFrame:
    """(chunk, ref, df) of the sketched rows."""
    return sketched.select(F.shiftright("ref", REF_BITS).alias("chunk"), "ref", "df")


def _verify(packed, sketched, pairs, text, n_docs, damping, similarity) -> DataFrame:
    """The pairs whose weighted Jaccard similarity reaches ``similarity``."""
    # Landed, so that the join below has an exchange on either side and Spark
    # can split a leader with very many members.
    members = landed(pairs.groupBy("leader").agg(F.count("*").alias("n")), "neardup-leaders")
    dealt = pairs.join(members, "leader").select(
        "ref", "leader", F.pmod(F.xxhash64("ref", F.lit(7)), F.greatest(
            F.lit(1), F.ceil(F.col("n") / GROUP))).alias("salt"))
    # A leader is sent once and copied to its groups after the exchange.
    asks = dealt.select("ref", "leader", F.col("salt").alias("lo"), F.col("salt").alias(
        "hi")).unionByName(members.select(
            F.col("leader").alias("ref"), "leader", F.lit(0).cast("long").alias("lo"),
            (F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP)) - 1).alias("hi")))
    asks = asks.select(F.shiftright("ref", REF_BITS).alias("chunk"), "ref", "leader", "lo", "hi")
    more = _counts(sketched).unionByName(asks, allowMissingColumns=True)
    blob = pa.schema([("leader", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()),
                      ("ref", pa.int64()), ("keys", pa.binary()), ("weights", pa.binary())])

    def send(own: pa.Table, asked: pa.Table) -> pa.Table:
        known = pa.compute.is_valid(asked["df"])
        wanted = asked.filter(pa.compute.invert(known))
        if own.num_rows == 0 or wanted.num_rows == 0:
            return blob.empty_table()
        counts = asked.filter(pa.compute.and_(known, pa.compute.is_in(
            asked["ref"], wanted["ref"].combine_chunks())))
        sets = _asked_sets(own, counts, text, n_docs, damping)
        refs = wanted["ref"].to_pylist()
        return pa.table([wanted["leader"], wanted["lo"], wanted["hi"], wanted["ref"],
                         pa.array([sets[r][0].tobytes() for r in refs], pa.binary()),
                         pa.array([sets[r][1].tobytes() for r in refs], pa.binary())],
                        schema=blob)

    sent = packed.groupBy("chunk").cogroup(more.groupBy("chunk")).applyInArrow(
        send, "leader long, lo long, hi long, ref long, keys binary, weights binary").select(
        "leader", F.explode(F.sequence("lo", "hi")).alias("salt"), "ref", "keys", "weights")
    link = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def compare(group: pa.Table) -> pa.Table:
        leader = group.column("leader")[0].as_py()
        sets = {r: (np.frombuffer(k, np.uint64), np.frombuffer(w, np.float64)) for r, k, w in zip(
            *(group.column(c).to_pylist() for c in ("ref", "keys", "weights")))}
        own = sets.pop(leader)
        scored = [(r, leader, jaccard(own, s)) for r, s in sets.items()]
        kept = [x for x in scored if x[2] >= similarity - 1e-12]
        return pa.table([list(c) for c in zip(*kept)], schema=link) if kept else link.empty_table()

    return landed(spanning(landed(sent.groupBy("leader", "salt").applyInArrow(
        compare, "a long, b long, similarity double"), "neardup-verified")), "neardup-links")


def spanning(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same connected components as the given ones: each
    ``a`` with its smallest ``b``, and that one with the other ``b`` of ``a``,
    which many ``a`` have in common. A member's leaders are few (two a band).
    ``links`` is landed: it is read twice."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    hubs = links.join(low, "a").where("b <> low").select(F.col("low").alias("a"), "b").distinct()
    return low.select("a", F.col("low").alias("b")).unionByName(hubs)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(v, label) for every end of a link ``(a, b)``: label is the smallest
    end in its connected component. Minimum labels spread over links and
    through pointers (a label's own label) until nothing changes; every
    round is landed, so a lost executor costs one round at most."""
    ends = links.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(
        links.select(F.col("b").alias("v"), F.col("a").alias("u")))
    labels = landed(ends.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("label")),
                    f"{name}-0")
    done, step = False, 1
    while not done:
        near = (ends.join(labels.select(F.col("v").alias("u"), F.col("label").alias("near")), "u")
                .groupBy("v").agg(F.min("near").alias("near")))
        best = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least(
            "label", "near").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("next"))
        new = landed(best.join(jump, "label", "left").select(
            "v", "old", F.least("label", F.coalesce("next", "label")).alias("label")),
            f"{name}-{step}")
        done = new.where("label <> old").limit(1).count() == 0
        labels, step = new.select("v", "label"), step + 1
    return labels


def rare_prefix(keys, weights, df, similarity: float) -> np.ndarray:
    """Places of the rarest shingles (ties by key) that hold more than
    ``1 - similarity`` of a set's weight. Of two sets that reach the similarity,
    what they share weighs at least ``similarity`` of either's weight; without a
    common shingle in the prefixes, all of it would lie behind the prefix that
    ends first, where less is left of that set."""
    order = np.lexsort((keys, df))
    left = weights.sum() - np.cumsum(weights[order])
    enough = left < (similarity - 1e-9) * weights.sum()
    return order[:int(np.argmax(enough)) + 1]


def _prefixes(packed, sketched, refs, text, n_docs, damping, similarity) -> DataFrame:
    """(ref, shingle): the rarest shingles of the rows ``refs``, but for those
    that no other document holds."""
    chunks = landed(refs.select(F.shiftright("ref", REF_BITS).alias("chunk")).distinct(),
                    "neardup-left-chunks")
    packed = packed.join(chunks, "chunk", "left_semi")
    asks = _counts(sketched).join(refs, "ref", "left_semi")
    out = pa.schema([("ref", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def send(own: pa.Table, asked: pa.Table) -> pa.Table:
        if own.num_rows == 0 or asked.num_rows == 0:
            return out.empty_table()
        sets = _asked_sets(own, asked, text, n_docs, damping)
        rare = []
        for k, w, df in sets.values():
            at = rare_prefix(k, w, df, similarity)
            rare.append(k[at[df[at] > 1]].view(np.int64))
        return pa.table([list(sets), pa.array(rare, pa.list_(pa.int64()))], schema=out)

    return packed.groupBy("chunk").cogroup(asks.groupBy("chunk")).applyInArrow(
        send, "ref long, shingles array<long>").select(
        "ref", F.explode("shingles").alias("shingle"))


def _sets(packed, sketched, refs, text, n_docs, damping) -> DataFrame:
    """(ref, keys, weights): the weighted shingles of the rows ``refs``."""
    chunks = landed(refs.select(F.shiftright("ref", REF_BITS).alias("chunk")).distinct(),
                    "neardup-left-chunks")
    packed = packed.join(chunks, "chunk", "left_semi")
    asks = _counts(sketched).join(refs, "ref", "left_semi")
    blob = pa.schema([("ref", pa.int64()), ("keys", pa.binary()), ("weights", pa.binary())])

    def send(own: pa.Table, asked: pa.Table) -> pa.Table:
        if own.num_rows == 0 or asked.num_rows == 0:
            return blob.empty_table()
        sets = _asked_sets(own, asked, text, n_docs, damping)
        return pa.table([list(sets), [k.tobytes() for k, _, _ in sets.values()],
                         [w.tobytes() for _, w, _ in sets.values()]], schema=blob)

    return landed(packed.groupBy("chunk").cogroup(asks.groupBy("chunk")).applyInArrow(
        send, "ref long, keys binary, weights binary"), "neardup-sets")


def _left_over(reps: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, key, ref, label): every bucket's members other than its leaders,
    where they are not all in one class by ``labels`` yet."""
    order = F.struct(F.xxhash64("ref"), F.col("ref"))
    placed = reps.select("ref", F.posexplode("bands").alias("band", "key"))
    buckets = placed.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.min(order).alias("lo"), F.max(order).alias("hi")).where("n > 3")
    buckets = landed(buckets.select("band", "key", F.col("lo.ref").alias("lo"),
                                    F.col("hi.ref").alias("hi")), "neardup-wide")
    rest = placed.join(buckets, ["band", "key"]).where("ref <> lo and ref <> hi").select(
        "band", "key", "ref")
    label_of = labels.select(F.col("v").alias("ref"), "label")
    rest = landed(rest.join(label_of, "ref", "left").select(
        "band", "key", "ref", F.coalesce("label", "ref").alias("label")), "neardup-rest")
    mixed = rest.groupBy("band", "key").agg(F.min("label").alias("a"), F.max("label").alias(
        "b")).where("a <> b").select("band", "key")
    return landed(rest.join(mixed, ["band", "key"]), "neardup-left-over")


def _with_partners(rest, packed, sketched, text, n_docs, damping, similarity) -> DataFrame:
    """The rows of ``rest`` (``_left_over``) whose member shares one of its
    rarest shingles with a member of another class, in buckets that still hold
    more than one class."""
    of = landed(rest.select("ref", "label").distinct(), "neardup-left-refs")
    rare = landed(_prefixes(packed, sketched, of.select("ref"), text, n_docs, damping,
                            similarity).join(of, "ref"), "neardup-prefixes")
    shared = rare.groupBy("shingle").agg(F.min("label").alias("a"), F.max("label").alias(
        "b")).where("a <> b").select("shingle")
    paired = landed(rare.join(shared, "shingle").select("ref").distinct(), "neardup-partners")
    return landed(rest.join(paired, "ref"), "neardup-paired")


def _blocks(rest: DataFrame) -> DataFrame:
    """``rest`` with, a row: whether its class is its bucket's most frequent one,
    and how many blocks that class and the other members make."""
    sizes = rest.groupBy("band", "key", "label").agg(F.count("*").alias("n"))
    mixed = landed(sizes.groupBy("band", "key").agg(
        F.count("*").alias("labels"), F.max(F.struct("n", "label")).alias("top"),
        (F.sum("n") - F.max("n")).alias("minor")).where("labels > 1").select(
        "band", "key", F.col("top.label").alias("top"), F.col("top.n").alias("major"), "minor"),
        "neardup-mixed")
    return rest.join(mixed, ["band", "key"]).select(
        "band", "key", "ref", "label", (F.col("label") == F.col("top")).alias("is_major"),
        F.ceil(F.col("major") / BLOCK).cast("int").alias("major_blocks"),
        F.ceil(F.col("minor") / BLOCK).cast("int").alias("minor_blocks"))


def _verify_left_over(packed, sketched, reps, labels, text, n_docs, damping, similarity):
    """Verified pairs of the members that their buckets' leaders leave in
    different classes: all of them, block of members by block of members.

    A bucket's most frequent class needs no pairs of its own; its members meet
    the other members only. A pair is compared in the first band it shares."""
    rest = _left_over(reps, labels)
    if rest.limit(1).count() == 0:
        return None
    rest = landed(_blocks(_with_partners(rest, packed, sketched, text, n_docs, damping,
                                         similarity)), "neardup-dealt")
    if rest.limit(1).count() == 0:
        return None
    refs = landed(rest.select("ref").distinct(), "neardup-compared")
    sets = _sets(packed, sketched, refs, text, n_docs, damping).join(
        reps.select("ref", "bands"), "ref")
    # Blocks: minor ones are numbered from 0, the most frequent class's follow.
    place = F.xxhash64("ref", F.lit(9))
    first = F.when(F.col("is_major"), F.col("minor_blocks") + F.pmod(place, "major_blocks"))
    rest = rest.withColumn("block", first.otherwise(F.pmod(place, "minor_blocks")).cast("int"))
    others = F.when(F.col("is_major"), F.sequence(F.lit(0), F.col("minor_blocks") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("minor_blocks") + F.col("major_blocks") - 1))
    dealt = rest.select("band", "key", "ref", "label", "block", F.explode(others).alias("other"))
    dealt = dealt.select("band", "key", "ref", "label", "block", F.least("block", "other").alias(
        "one"), F.greatest("block", "other").alias("two"))
    link = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def compare(group: pa.Table) -> pa.Table:
        one, two = group.column("one")[0].as_py(), group.column("two")[0].as_py()
        found = list(similar_pairs(
            group.column("ref").to_numpy(), group.column("label").to_numpy(),
            np.array(group.column("bands").to_pylist(), np.int64),
            group.column("band")[0].as_py(), group.column("block").to_numpy() == one, one == two,
            [np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()],
            [np.frombuffer(x, np.float64) for x in group.column("weights").to_pylist()],
            similarity))
        return pa.table([list(c) for c in zip(*found)], schema=link) if found else (
            link.empty_table())

    return landed(dealt.join(sets, "ref").groupBy("band", "key", "one", "two").applyInArrow(
        compare, "a long, b long, similarity double"), "neardup-left-links")


def similar_pairs(refs, labels, bands, band, left, within, keys, weights, similarity):
    """(a, b, similarity) of pairs of a left and another member (or of two left
    ones, ``within`` a block) that share no band before ``band`` and reach
    ``similarity``: one for each merge of their classes ``labels``, so that all
    similar pairs of the group are in one class by them."""
    above: dict[int, int] = {}  # merged class -> the class it went to

    def now(label: int) -> int:
        while label in above:
            label = above[label]
        return label
    right = np.flatnonzero(left if within else ~left)
    if not len(right):
        return
    vocabulary, at = np.unique(np.concatenate([keys[j] for j in right]), return_inverse=True)
    own = np.repeat(np.arange(len(right)), [len(keys[j]) for j in right])
    weight = np.concatenate([weights[j] for j in right])
    totals = np.array([weights[j].sum() for j in right])
    for i in np.flatnonzero(left):
        asked = labels[right] != labels[i]
        asked &= ~(bands[right, :band] == bands[i, :band]).any(axis=1)
        if within:
            asked &= right > i
        if not asked.any():
            continue
        mine = np.zeros(len(vocabulary))
        _, a, b = np.intersect1d(vocabulary, keys[i], assume_unique=True, return_indices=True)
        mine[a] = weights[i][b]
        both = np.bincount(own, np.minimum(weight, mine[at]), len(right))
        alike = both / (totals + weights[i].sum() - both)
        for j in np.flatnonzero(asked & (alike >= similarity - 1e-12)):
            one, two = now(int(labels[i])), now(int(labels[right[j]]))
            if one != two:
                above[max(one, two)] = min(one, two)
                yield int(refs[right[j]]), int(refs[i]), float(alike[j])


def _labels(docs: DataFrame, text: str, similarity: float, bands: int, rows: int, damping: float):
    """Landed chunks, and (ref, label) of every row in a class of two or more."""
    packed = pack_rows(docs, "neardup-texts", text)
    n_docs = docs.count()

    def keys(row):
        doc, key, _ = shingles(text_bytes(unpack(row["rows"]).column(text)))
        return _distinct(doc, key)[1]

    counted = count_keys(packed, keys, ["rows"], key_ranges(packed, 6.5), "neardup-df")
    sketched = _sketches(packed, counted, text, n_docs, damping, bands, rows)
    discard(counted)
    copies = (sketched.groupBy("text_hi", "text_lo").agg(
        F.min("ref").alias("rep"), F.count("*").alias("n")))
    copies = landed(copies.where("n > 1"), "neardup-copies")
    copied = sketched.select("ref", "text_hi", "text_lo").join(copies, ["text_hi", "text_lo"])
    copied = landed(copied.select("ref", "rep"), "neardup-copied")
    reps = sketched.select("ref", "bands").join(copied.where("ref <> rep").select("ref"), "ref",
                                                "left_anti")
    pairs = _candidates(reps)
    links = _verify(packed, sketched, pairs, text, n_docs, damping, similarity)
    labels = components(links, "neardup-led")
    more = _verify_left_over(packed, sketched, reps, labels, text, n_docs, damping, similarity)
    discard(pairs)
    if more is not None:
        labels = components(links.unionByName(more.select("a", "b")), "neardup-components")
    # A class of near copies takes its members' exact copies along.
    label_of = labels.select(F.col("v").alias("rep"), "label")
    alone = copied.join(label_of, "rep", "left").select("ref", F.coalesce("label", "rep").alias(
        "label"))
    rest = labels.select(F.col("v").alias("ref"), "label").join(copied.select("ref"), "ref",
                                                                "left_anti")
    labels = landed(alone.unionByName(rest), "neardup-labels")
    reclaim(docs.sparkSession, rounds=2)
    return packed, labels


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
            damping: float = DAMPING) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its
    class), class_size, keeps (the one row of its class that stays)."""
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    packed, labels = _labels(own, "text", similarity, bands, rows, damping)
    schema = pa.schema([("ref", pa.int64()), ("doc_id", pa.int64())])

    def ids(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                col = unpack(batch.column("rows")[i]).column("doc_id").combine_chunks()
                base = batch.column("chunk")[i].as_py() << REF_BITS
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + np.arange(len(col)), pa.int64()), col.cast(pa.int64())],
                    schema=schema)

    rows_ = landed(packed.select("chunk", "rows").mapInArrow(ids, "ref long, doc_id long").join(
        labels, "ref", "left"), "neardup-rows")
    found = landed(rows_.where("label is not null").groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "neardup-classes")
    alone = rows_.where("label is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("keeps"))
    return alone.unionByName(rows_.where("label is not null").join(found, "label").select(
        "doc_id", "class_id", "class_size", (F.col("ref") == F.col("label")).alias("keeps")))


def one_of_each(docs: DataFrame, text_col: str = "text", similarity: float = SIMILARITY,
                bands: int = BANDS, rows: int = ROWS, damping: float = DAMPING) -> DataFrame:
    """``docs`` with one row of each class of near duplicates."""
    packed, labels = _labels(docs, text_col, similarity, bands, rows, damping)
    gone = labels.where("ref <> label").select(
        F.shiftright("ref", REF_BITS).alias("chunk"), "ref")

    def keep(own: pa.Table, out: pa.Table) -> pa.Table:
        rows_ = unpack(own.column("rows")[0])
        left = np.ones(rows_.num_rows, bool)
        left[out["ref"].to_numpy() & ((1 << REF_BITS) - 1)] = False
        return rows_.filter(pa.array(left))

    return packed.select("chunk", "rows").groupBy("chunk").cogroup(
        gone.groupBy("chunk")).applyInArrow(keep, docs.schema)
