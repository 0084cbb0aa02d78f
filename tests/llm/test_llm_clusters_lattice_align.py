"""Centroid clustering, lattice scores and cross-tokenizer alignment."""

import hashlib
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from cityair.llm import align, centroids, lattice
from cityair.llm.queries import ORACLE, QUERIES
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

NAN, INF = float("nan"), float("inf")


def vectors_of(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 f"vec_id long, embedding array<{kind}>, w string, cluster int")


def lloyd(rows, k, rounds, dims, seed=centroids.SEED):
    """Plain Lloyd rounds over Python integers."""
    own = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
           if v is not None and len(v) == dims and all(
               x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), w)
                   for i, w in own if i is not None)
    centres = [w for _, w in first[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for t in range(rounds + 1):
        at = [min(range(len(centres)), key=lambda j: (square(w, centres[j]), j)) for _, w in own]
        if t < rounds:
            for j in range(len(centres)):
                mine = [w for (_, w), a in zip(own, at) if a == j]
                if mine:
                    centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    dist = [square(w, centres[a]) for (_, w), a in zip(own, at)]
    each = Counter()
    for a, d in zip(at, dist):
        each[a] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, a, d, each[a], sum(dist), sha[a]) for (i, _), a, d in zip(own, at, dist)]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_clusters_equal_sql(spark, duck_at):
    got = QUERIES["op11_centroid_clustering"](spark, SF0001)
    want = duck_at(SF0001).sql(ORACLE["op11_centroid_clustering"])
    assert got.columns == want.columns
    assert ordered(got.collect()) == ordered(want.fetchall())


def test_clusters_of_edge_cases(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 4)).astype("f4"))]
    same = rows[3][1]
    rows += [(i, same) for i in range(300, 400)]  # ties, a hot vector
    rows += [(5, [0.5, 0.0, 0.0, 1.0]), (None, same), (400, None), (401, []), (402, [1.0] * 3),
             (403, [1.0, None, 0.0, 0.0]), (404, [NAN] * 4), (405, [INF, 0.0, 0.0, 0.0]),
             (406, [0.0] * 4), (407, [-1.0] * 4)]
    got = centroids.cluster(vectors_of(spark, rows), k=7, rounds=4, dims=4).collect()
    assert ordered(got) == ordered(lloyd(rows, 7, 4, 4))


def test_clusters_of_large_numbers_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 2)) * 2.0 ** 20)]
    got = centroids.cluster(vectors_of(spark, rows, "double"), k=5, rounds=3, dims=2).collect()
    assert ordered(got) == ordered(lloyd(rows, 5, 3, 2))


def test_clusters_fail_rather_than_wrap(spark):
    for far in (2.0 ** 30, 2.0 ** 60):
        rows = [(0, [0.0, far]), (1, [0.0, -far]), (2, [1.0, 0.0])]
        with pytest.raises(Exception, match="fits no long|2\\^62"):
            centroids.cluster(vectors_of(spark, rows, "double"), k=1, rounds=1, dims=2).collect()


def test_clusters_of_few_and_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, -4.0])]
    got = centroids.cluster(vectors_of(spark, rows), k=9, rounds=2, dims=2).collect()
    assert ordered(got) == ordered(lloyd(rows, 9, 2, 2))
    none = centroids.cluster(vectors_of(spark, rows), k=9, rounds=2, dims=3)
    assert none.collect() == [] and "centroid_sha256" in none.columns


coordinate = st.floats(-50, 50)
point = st.tuples(coordinate, coordinate, coordinate)


@settings(max_examples=300, deadline=None)
@given(point, point, point, st.floats(0, 60), st.lists(point, min_size=1, max_size=8))
def test_loosening_bounds_every_point_of_the_sphere(centre, before, after, radius, ways):
    centre, before, after = map(np.array, (centre, before, after))
    bound = centroids.loosening(centre, radius, before, after)
    drift = np.linalg.norm(after - before)
    assert bound <= drift * (1 + 1e-12)
    for way in ways:
        n = np.linalg.norm(way)
        x = centre + (np.array(way) / n * radius if n else 0.0)
        nearer = np.linalg.norm(x - before) - np.linalg.norm(x - after)
        assert nearer <= bound + 1e-9 * (1 + drift)


def test_loosening_spares_scans():
    """Bounds loosened by geometry leave fewer vectors to scan than the full drift."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(8, 2)) * 4000
    rows = np.floor(np.concatenate([m + rng.normal(size=(400, 2)) * 700 for m in middle])).astype(
        np.int64)
    centres = [list(map(int, rows[i * 400])) for i in range(8)]
    own, first, lower = centroids.two_nearest(rows, centres)
    upper = np.sqrt(first.astype(float))
    new = [[int(x) for x in rows[own == j].mean(axis=0)] for j in range(8)]
    radius = np.array([upper[own == j].max() for j in range(8)])
    drift, loose, half = centroids.moved(centres, new, radius)
    assert (loose <= drift.max() * (1 + 1e-6)).all() and loose.mean() < 0.8 * drift.max()
    no_half = np.full(8, -np.inf)
    scanned = []
    for by in (loose, np.full(8, drift.max())):
        a, u, low, n = centroids.assign(rows, own.copy(), upper, lower, new, drift, by, no_half)
        assert (a == centroids.two_nearest(rows, new)[0]).all()
        scanned.append(n)
    assert scanned[0] < scanned[1] < len(rows)


# Lattice scores

def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "de", 1) for r in rows],
                                 "doc_id long, text string, word string, n int")


def tokens_of(text):
    return (text or "").encode().lower().split()


def is_held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def ways(word, pieces):
    """All segmentations of a word, by plain recursion."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in ways(word[n:], pieces):
                yield [word[:n], *rest]


def brute_lattice(rows, rounds):
    """Enumerated segmentations instead of forward and backward recursions."""
    t = lattice.trie(lattice.vocabulary())
    at = {p: i for i, p in enumerate(t.pieces)}
    train = Counter(w for d, x in rows if not is_held(d) for w in tokens_of(x))
    ends = sum(not is_held(d) for d, _ in rows)
    p = np.exp(t.start)
    split = {w: [[at[x] for x in way] for way in ways(lattice.MARK + w, at)]
             for w in {w for _, x in rows for w in tokens_of(x)}}
    for _ in range(rounds if ends else 0):
        n = np.full(len(p), lattice.ALPHA)
        for w, c in train.items():
            each = [math.prod(p[i] for i in way) for way in split[w]]
            for way, e in zip(split[w], each):
                for i in way:
                    n[i] += c * e / sum(each)
        n[-1] += ends
        p = n / n.sum()
    known = train + Counter({None: ends})
    total, kinds = sum(known.values()), len(+known)
    out = []
    for d, x in rows:
        words = [*tokens_of(x), None]
        base = sum(math.log10((known[w] + 1) / (total + kinds + 1)) for w in words)
        score = sum(math.log10(sum(math.prod(p[i] for i in way) for way in split[w]))
                    for w in words[:-1]) + math.log10(p[-1])
        out.append((d, is_held(d), len(words), sum(known[w] > 0 for w in words), total, base,
                    score))
    return out


def close(got, want):
    got, want = ([r[:5] for r in x] for x in (ordered(got), ordered(want))), (ordered(got),
                                                                             ordered(want))
    a, b = got
    assert a == b
    assert [r[5:] for r in want[0]] == [pytest.approx(r[5:], rel=1e-9) for r in want[1]]


LATTICE_ROWS = [(i, t) for i, t in enumerate([
    "The cat", "the CAT sat\n", None, "", " \t\x0b", "x y Ää", "日本 ▁a", "cat cat",
    "<s> \x00", "\U0001f600", "hello\x1fthere", "Café"])] + [(None, "cat null"), (3, "again"), (3, "again")]


def test_lattice_equals_enumeration(spark):
    for rounds in (0, 2):
        got = lattice.score(docs_of(spark, LATTICE_ROWS), rounds=rounds, chunk_bytes=12).collect()
        close(got, brute_lattice(LATTICE_ROWS, rounds))


def test_lattice_chunks_make_no_difference(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    whole = lattice.score(docs).collect()
    small = lattice.score(docs.repartition(5), chunk_bytes=20_000).collect()
    close(small, whole)
    assert len(whole) == docs.count() and {r.held_out for r in whole} == {True, False}
    for r in docs.collect():
        assert len(tokens_of(r.text)) + 1 == next(x.n_tokens for x in whole if x.doc_id == r.doc_id)


def test_lattice_chunks_come_in_small_rows(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(900))) for i in range(400)]
    chunks = lattice._chunks(docs_of(spark, rows).coalesce(1), "doc_id", "text", lattice.MODULUS,
                             lattice.HELD, lattice.CHUNK_BYTES).collect()
    assert {r.chunk for r in chunks} == {0}
    assert max(len(r.words or []) for r in chunks) == lattice.ROW_WORDS
    texts = [pa.ipc.open_stream(r.docs).read_all() for r in chunks if r.docs is not None]
    assert len(texts) > 2 and sorted(i for t in texts for i in t["doc_id"].to_pylist()) == [
        i for i, _ in rows]
    words = [w for r in chunks if r.words for w in r.words]
    assert len(set(words)) == len(words) == 400 * 900
    assert sorted(r.first for r in chunks if r.words) == [*range(0, len(words), lattice.ROW_WORDS)]


def test_lattice_without_training_or_rows(spark):
    held = [i for i in range(200) if is_held(i)][:3]
    rows = [(i, "some words") for i in held]
    got = lattice.score(docs_of(spark, rows)).collect()
    close(got, brute_lattice(rows, 2))
    assert {(r.train_tokens, r.n_known) for r in got} == {(0, 0)}
    assert lattice.score(docs_of(spark, rows).limit(0)).collect() == []


def test_lattice_of_long_words(spark):
    rows = [(1, "ab" * 20_000), (2, "日" * 9_000 + " tail"), (4, "ab")]
    got = {r.doc_id: r for r in lattice.score(docs_of(spark, rows), rounds=1).collect()}
    assert all(math.isfinite(r.score) and r.score < 0 for r in got.values())
    assert got[1].n_tokens == 2 and got[2].n_tokens == 3


def test_training_raises_held_out_scores(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    score = [sum(r.score for r in lattice.score(docs, rounds=n).collect() if r.held_out)
             for n in (0, 1, 4)]
    assert score[0] < score[1] < score[2]


# Cross-tokenizer alignment

def byte_alphabet():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute_align(rows):
    """Each text whole through both tokenizers, two pointers, all links listed."""
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = byte_alphabet()
    out, count = [], Counter()
    for doc, text in rows:
        links, groups, a, b = [], [], [], []
        if text:
            a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            own = [bytes(byte[c] for c in a_tok.id_to_token(i)) for i in a]
            other = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                     else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(own) == b"".join(other) == f" {text}".encode():
                a, b = [], []
        i = j = at_a = at_b = 0
        in_a, in_b = [], []
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = at_a + len(own[i]), at_b + len(other[j])
            if end_a <= end_b:
                in_a.append(str(a[i]))
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                in_b.append(str(b[j]))
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append(",".join(in_a) + "|" + ",".join(in_b))
                in_a, in_b = [], []
        count.update(links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((doc, len(a), len(b), len(groups), links, sha))
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(d, n_a, n_b, n_g, len(x), sum(count[p] == top[p[1]] for p in x),
             sum(count[p] for p in x), sha) for d, n_a, n_b, n_g, x, sha in out]


def test_alignment_of_the_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = QUERIES["op13_tokenizer_alignment"](spark, SF0001)
    assert got.columns == ["doc_id", *align.MEASURES, "groups_sha256"]
    assert ordered(got.collect()) == ordered(brute_align(rows))


ALIGN_ROWS = [(1, None), (2, ""), (3, " "), (4, " a  b "), (5, "x▁y"), (6, "<|endoftext|> hi <s>"),
              (7, "\x00a b"), (8, "é 日本 ﬁ"), (9, "a\n b"), (10, "\na b"),
              (11, "x▁y z"), (12, "a b"), (12, "a b"), (None, "a b"), (13, "it's a b's  end"),
              (14, "w" * 9000 + " " + "日本語" * 900), (15, "tab\t\tx  y\r\n z"), (16, "½ <0x41> <unk>"),
              (17, "\U0001f600‍ \U0001f680")]


def test_alignment_of_edge_cases_equals_brute_force(spark):
    for size in (10, 1 << 20):
        got = align.align(docs_of(spark, ALIGN_ROWS), chunk_bytes=size).collect()
        assert ordered(got) == ordered(brute_align(ALIGN_ROWS))
    assert align.align(docs_of(spark, ALIGN_ROWS).limit(0)).collect() == []
    blank = align.align(docs_of(spark, ALIGN_ROWS[:2])).collect()
    assert ordered(blank) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]


def test_copies_weigh_as_often_as_they_occur(spark, monkeypatch):
    monkeypatch.setattr(align, "HOT_SHARE", 5)  # the copies take the broadcast
    rows = [(i, "one hot text, copied") for i in range(40)] + [
        (100 + i, t) for i, t in enumerate(["a hot one", "copied text", "hotter texts"])]
    got = align.align(docs_of(spark, rows).repartition(4)).collect()
    assert ordered(got) == ordered(brute_align(rows))
    measures, pairs = align.alignment(docs_of(spark, rows))
    assert sorted(r.times for r in measures.collect()) == [1, 1, 1, 40]
    assert pairs.where("best").select((pairs.pair % 2 ** 32).alias("b")).distinct().count() == \
        pairs.select((pairs.pair % 2 ** 32).alias("b")).distinct().count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab'St \n\t1.,é日▁\x00<>| 　")), max_size=12),
                min_size=1, max_size=6))
def test_units_align_as_whole_texts(texts):
    pair = align.tokenizers(*align.vocabularies())
    texts = [t for t in texts if t]
    chunk = align.Chunk()
    for t in texts:
        chunk.add(pair, t, hashlib.sha256(t.encode()).digest(), 1)
    if not texts:
        return
    import pyarrow as pa
    blob = chunk.flush(pair, 0).column("texts")[0].as_py()
    got = pa.ipc.open_stream(pa.BufferReader(blob)).read_all().to_pylist()
    want = brute_align(list(enumerate(texts)))
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in got] == [
        (*w[1:5], w[7]) for w in want]


def test_all_pairs_overlap_once():
    """Links of a unit are the distinct cuts of both sequences."""
    pair = align.tokenizers(*align.vocabularies())
    got = pair.align(["tokenizers", "unbelievable", "日本"])
    assert (got.n_links == got.n_a + got.n_b - got.n_groups).all()
    assert list(itertools.accumulate(got.n_links))[-1] == len(got.links)
