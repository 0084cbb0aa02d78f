"""Suffix dedup: remove every byte covered by a 200-byte string seen twice.

A full suffix array of the corpus would shuffle a record for each byte,
many times the input. So suffixes are sampled by content: every 200-byte
window names as its anchor the leftmost position whose 64-byte string has
the least fingerprint among its own. Equal windows name the same anchor at
the same offset, wherever they stand, so suffixes at anchors (about one in 56 bytes)
find every repeat, and a window is only compared with windows of its anchor.
Consecutive windows with one anchor make a piece. Three exchanges by
fingerprint range (sampled suffixes are sorted in their range; a range is a
task's work) then settle every window exactly:

1. anchors by the fingerprint of their leading 64 bytes: an anchor that
   occurs once has no repeated window;
2. whole pieces: a piece whose bytes occur twice is removed whole;
3. the windows of pieces that differ only at an edge of a repeated passage,
   one piece for each different string.

Fingerprints have 64 bits (windows of one round are equal by chance with
probability about n^2 / 2^65).

Defined results: null text counts as empty; texts under 200 bytes keep all
bytes; repeated rows are copies like any others; null ids pass through;
matches never cross documents; an empty table gives an empty result; extra
columns are kept by ``dedup_texts`` and ignored by ``removed_bytes``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from cityair.llm.chunks import count_keys, key_ranges, look_up, pack_rows, text_bytes, unpack
from cityair.llm.common import discard, landed, mix64, reclaim

WINDOW = 200
CORE = 64
SEGMENT = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def _tables(size: int):
    rng = np.random.default_rng(20240607)
    byte = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return byte, np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_TABLES = []


def _prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the rolling hash (modulo 2^64)."""
    if not _TABLES or len(data) >= len(_TABLES[1]):  # windows beyond the usual need more
        _TABLES[:] = _tables(max(SEGMENT + WINDOW, len(data)) + 1)
    byte, up, _ = _TABLES
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte[data] * up[:len(data)], out=out[1:])
    return out


def _hashes(prefix: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    return mix64((prefix[starts + length] - prefix[starts]) * _TABLES[2][starts], 1)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from block-wise running minima."""
    n = len(v)
    blocks = -(-n // width)
    padded = np.full(blocks * width, ~_U(0), np.uint64)
    padded[:n] = v
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def pieces_of(text: bytes, window: int = WINDOW, core: int = CORE):
    """Runs of window starts with one anchor: (start, windows, anchor's
    fingerprint, fingerprint of the run's bytes)."""
    low = _U((1 << (SEGMENT + window - core).bit_length()) - 1)
    out = []
    for base in range(0, max(0, len(text) - window + 1), SEGMENT):
        view = memoryview(text)[base:base + SEGMENT + window - 1]
        prefix = _prefix(np.frombuffer(view, np.uint8))
        h = _hashes(prefix, np.arange(len(view) - core + 1), core)
        place = np.arange(len(h), dtype=np.uint64)
        least = _sliding_min(h & ~low | place, window - core + 1)
        owner = (least & low).astype(np.int64)
        start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        count = np.diff(np.r_[start, len(owner)])
        whole = np.fromiter((xxhash.xxh3_64_intdigest(view[a:a + n + window - 1])
                             for a, n in zip(start.tolist(), count.tolist())),
                            np.uint64, len(start))
        out.append((start + base, count, h[owner[start]], whole))
    if not out:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
    return tuple(np.concatenate(c) for c in zip(*out))


def _piece_windows(texts, doc, pos, num, window):
    """Fingerprints of all windows of the given pieces, piece by piece."""
    out = []
    for d, p, n in zip(doc.tolist(), pos.tolist(), num.tolist()):
        prefix = _prefix(np.frombuffer(texts[d], np.uint8, n + window - 1, p))
        out.append(_hashes(prefix, np.arange(n), window))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def cut(text: bytes, starts, counts, window: int = WINDOW) -> tuple[bytes, int, int]:
    """Remove the bytes that the windows in runs (start, count) cover:
    kept bytes, bytes removed, maximal runs removed."""
    if not len(starts):
        return text, 0, 0
    order = np.argsort(starts, kind="stable")
    a = np.asarray(starts)[order]
    b = np.maximum.accumulate(a + np.asarray(counts)[order] + window - 1)
    new = np.r_[True, a[1:] > b[:-1]]
    first = np.flatnonzero(new)
    begin, end = a[first], b[np.r_[first[1:], len(a)] - 1]
    kept = b"".join(text[x:y] for x, y in zip([0, *end.tolist()], [*begin.tolist(), len(text)]))
    return kept, int((end - begin).sum()), len(first)


def _runs(flags: np.ndarray):
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return edge[::2], edge[1::2] - edge[::2]


# A chunk's pieces: how many each document has, and for each piece its windows
# and fingerprints (a document's pieces follow each other without a gap).
def _kinds(window: int, core: int):
    """Columns of found and of placed pieces; a piece has window - core + 1
    windows at most."""
    num = ("num", np.min_scalar_type(window - core + 1))
    return ((("docs", np.uint32), num, ("anchor", np.uint64), ("whole", np.uint64)),
            (("doc", np.uint32), ("pos", np.uint32), num))


def _places(docs: np.ndarray, num: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and position of every piece."""
    doc = np.repeat(np.arange(len(docs)), docs)
    before = np.cumsum(num, dtype=np.int64) - num
    first = np.r_[0, np.cumsum(docs, dtype=np.int64)[:-1]]
    base = before[np.minimum(first, max(0, len(num) - 1))] if len(num) else first
    return doc, before - base[doc]


def _find_pieces(packed: DataFrame, text: str, window: int, core: int, kinds) -> DataFrame:
    def find(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                texts = text_bytes(unpack(batch.column("rows")[i]).column(text))
                found = [pieces_of(t or b"", window, core) for t in texts]
                cols = [np.array([len(f[0]) for f in found])]
                cols += [np.concatenate([f[j] for f in found]) for j in (1, 2, 3)]
                # An anchor is a minimum; mixed anew its fingerprint is even.
                cols[2] = mix64(cols[2], 3)
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([batch.column("chunk")[i].as_py()], pa.int64())}
                    | {k: pa.array([c.astype(t).tobytes()], pa.binary())
                       for (k, t), c in zip(kinds, cols)})

    return landed(packed.select("chunk", "rows").mapInArrow(
        find, "chunk long, docs binary, num binary, anchor binary, whole binary"),
        "suffix-pieces")


def _array(value, kind):
    return np.frombuffer(value.as_py() if hasattr(value, "as_py") else value, kind)


def _pick_repeated(pieces: DataFrame, anchors: DataFrame, found, place) -> DataFrame:
    """The pieces whose anchor repeats, with the key of the whole piece."""
    schema = pa.schema([("chunk", pa.int64()), ("doc", pa.binary()), ("pos", pa.binary()),
                        ("num", pa.binary()), ("key", pa.binary()), ("seen", pa.binary())])

    def pick(own: pa.Table, answer: pa.Table) -> pa.Table:
        if own.num_rows == 0 or answer.num_rows == 0:
            return schema.empty_table()
        row = {c: own.column(c)[0] for c in own.column_names}
        arrays = {k: _array(row[k], t) for k, t in found}
        arrays["doc"], arrays["pos"] = _places(arrays["docs"], arrays["num"])
        total, _ = look_up(arrays["anchor"], answer)
        at = np.flatnonzero(total >= 2)
        key = mix64(arrays["anchor"][at], 2) ^ arrays["whole"][at]
        return pa.table([[row["chunk"].as_py()], *([arrays[k][at].astype(t).tobytes()]
                                                   for k, t in place),
                         [key.tobytes()], [total[at].tobytes()]], schema=schema)

    return landed(pieces.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(
        pick, "chunk long, doc binary, pos binary, num binary, key binary, seen binary"),
        "suffix-repeated")


def _sort_out(repeated: DataFrame, wholes: DataFrame, place) -> DataFrame:
    """Pieces that go whole; pieces whose windows are asked for (they occur
    once, their anchor oftener); pieces that only lend their windows."""
    schema = pa.schema([("chunk", pa.int64())] + [(f"{k}_{c}", pa.binary()) for k in
                       ("full", "open", "lend") for c in ("doc", "pos", "num")])

    def sort(own: pa.Table, answer: pa.Table) -> pa.Table:
        if own.num_rows == 0:
            return schema.empty_table()
        row = {c: own.column(c)[0] for c in own.column_names}
        arrays = {k: _array(row[k], t) for k, t in place}
        key, seen = _array(row["key"], np.uint64), _array(row["seen"], np.uint32)
        total, first = look_up(key, answer)
        lend = (total >= 2) & (seen > total) & (first == 1)
        lend &= np.isin(np.arange(len(key)), np.unique(key, return_index=True)[1])
        out = [[row["chunk"].as_py()]]
        for mask in (total >= 2, (total < 2) & (seen > 1), lend):
            out += [[arrays[k][mask].tobytes()] for k in ("doc", "pos", "num")]
        return pa.table(out, schema=schema)

    ddl = "chunk long, " + ", ".join(f"{f.name} binary" for f in schema if f.name != "chunk")
    return landed(repeated.groupBy("chunk").cogroup(wholes.groupBy("chunk")).applyInArrow(
        sort, ddl), "suffix-sorted")


def _settle(docs: DataFrame, text: str, emit, ddl: str, window: int, core: int) -> DataFrame:
    packed = pack_rows(docs, "suffix-texts", text)
    found, place = _kinds(window, core)
    pieces = _find_pieces(packed, text, window, core, found)
    ranges = key_ranges(packed, 50)
    anchors = count_keys(pieces, lambda r: _array(r["anchor"], np.uint64), ["anchor"], ranges,
                         "suffix-anchors")
    repeated = _pick_repeated(pieces, anchors, found, place)
    discard(pieces, anchors)
    wholes = count_keys(repeated, lambda r: _array(r["key"], np.uint64), ["key"], ranges,
                        "suffix-wholes")
    sorted_out = _sort_out(repeated, wholes, place)
    discard(repeated, wholes)

    def open_windows(row, texts=None):
        texts = texts or text_bytes(unpack(row["rows"]).column(text))
        return np.concatenate([
            _piece_windows(texts, *(_array(row[f"{k}_{c}"], t) for c, t in place), window)
            for k in ("open", "lend")])

    with_text = packed.join(sorted_out, "chunk")
    columns = ["rows"] + [f"{k}_{c}" for k in ("open", "lend") for c in ("doc", "pos", "num")]
    seen = count_keys(with_text, open_windows, columns, ranges, "suffix-windows")

    def finish(own: pa.Table, more: pa.Table) -> pa.Table:
        rows = unpack(own.column("rows")[0])
        texts = [t or b"" for t in text_bytes(rows.column(text))]
        runs: dict[int, list] = {}
        for i in range(more.num_rows):
            if more.column("totals")[i].is_valid:
                continue
            row = {c: more.column(c)[i] for c in more.column_names if "_" in c}
            doc, pos, num = (_array(row[f"full_{c}"], t) for c, t in place)
            for d, p, n in zip(doc.tolist(), pos.tolist(), num.tolist()):
                runs.setdefault(d, []).append((p, n))
            doc, pos, num = (_array(row[f"open_{c}"], t) for c, t in place)
            total, _ = look_up(open_windows(row, texts), more.filter(
                pa.compute.is_valid(more["totals"])))
            at = 0
            for d, p, n in zip(doc.tolist(), pos.tolist(), num.tolist()):
                a, c = _runs(total[at:at + n] >= 2)
                runs.setdefault(d, []).extend(zip((a + p).tolist(), c.tolist()))
                at += n
        done = [(t, *cut(t, *(np.array(runs[i], np.int64).T if runs.get(i) else ((), ())),
                         window)) for i, t in enumerate(texts)]
        return emit(rows, done)

    reclaim(docs.sparkSession, rounds=2)
    lists = sorted_out.unionByName(seen, allowMissingColumns=True)
    return packed.select("chunk", "rows").groupBy("chunk").cogroup(
        lists.groupBy("chunk")).applyInArrow(finish, ddl)


def removed_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, core: int = CORE) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    def emit(rows, done):
        return pa.table({
            "doc_id": rows.column("doc_id").cast(pa.int64()),
            "n_bytes": pa.array([len(t) for t, *_ in done], pa.int64()),
            "n_removed": pa.array([r for _, _, r, _ in done], pa.int64()),
            "n_spans": pa.array([s for *_, s in done], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for _, k, *_ in done],
                                    pa.string())})

    own = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return _settle(own, "text", emit, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                   "kept_sha256 string", window, core)


def dedup_texts(docs: DataFrame, text_col: str = "text", window: int = WINDOW,
                core: int = CORE) -> DataFrame:
    """``docs`` with repeated bytes cut from the texts. A character that loses
    some of its bytes goes whole; n_chars, where it is an
    integer column, is counted anew."""
    def emit(rows, done):
        texts = pa.array([k.decode("utf-8", "ignore") if r else t.decode("utf-8", "ignore")
                          for t, k, r, _ in done], pa.string())
        old = rows.column(text_col)
        texts = pa.compute.if_else(pa.compute.is_valid(old), texts, pa.scalar(None, pa.string()))
        rows = rows.set_column(rows.schema.get_field_index(text_col), text_col, texts)
        at = rows.schema.get_field_index("n_chars")
        if at >= 0 and pa.types.is_integer(rows.schema.field(at).type):
            kind = rows.schema.field(at).type
            rows = rows.set_column(at, "n_chars", pa.compute.if_else(
                pa.array([bool(r) for _, _, r, _ in done]),
                pa.compute.utf8_length(texts).cast(kind), rows.column(at)))
        return rows

    return _settle(docs, text_col, emit, docs.schema, window, core)
