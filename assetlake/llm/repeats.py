"""Repeated byte strings across documents, by common-prefix interval trees.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
id. Sorting every suffix of a corpus isn't needed to find these strings:

1. Anchors: of the hashes of all ``GRAM``-byte strings within a window of ``LENGTH`` bytes the least
   marks an anchor (all places, if it stands at several). It depends on the window's bytes alone, so
   equal windows have equal anchors at equal places. One byte in about 14 is an anchor.
2. Anchors travel packed, many to a row, to where equal hashes meet; those of two documents or more
   are repeated, and only around them can windows be.
3. Around each repeated anchor the document's bytes (all windows that hold it) travel to where equal
   anchors meet. Equal surroundings are one, with the least document.
4. There, for each distance from window start to anchor, the suffixes that start so far before the
   anchor are sorted and their common prefixes computed: an enhanced suffix array. A run of prefixes
   of ``LENGTH`` or more whose left neighbours are all equal is no maximal repeat: it is part of the
   run that starts a byte earlier. In the other runs a stack scan lists the common-prefix intervals;
   an interval of prefix length n with least document m covers n bytes of all its occurrences in
   later documents.
5. Spans meet by document and are merged; what they leave is the kept text.

What one batch of documents repeats within itself is folded before each shuffle: a hash or a
surrounding that many of its documents share is sent on once.

Disk: surroundings are seven times the text where all of it repeats. So steps 3 and 4 run in passes,
each over the anchors of some classes of hashes (equal anchors are in one class). Their number follows
the share of anchors that repeat, so that the surroundings of a pass are never more than about the
text itself, whatever repeats; a pass's shuffles go before the next one's. Packed values are
compressed, and spans merged before they are sent or written.

Memory: a task holds the packed anchors or surroundings of one bucket; buckets grow in number with
the input, those of surroundings with what repeats too. A single string of ``GRAM`` bytes with very many different surroundings is held by one
task, 100 bytes for each.

Defined results: a null text is empty; texts shorter than ``LENGTH`` keep everything; rows with one
id never remove from each other; a null id counts as larger than all others, and null ids as equal;
repeated rows get equal results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import input_splits, release, stage
from assetlake.llm.hashing import BACK, STEP, as_bytes, mixed, powers, runs

LENGTH = 50
GRAM = 24
REACH = LENGTH - GRAM  # bytes that a window can have before or after an anchor
CHUNK = 1 << 20
LAST = (1 << 63) - 1
CLASSES = 24  # of hashes; a pass takes some of them
PASSES = 8  # where all anchors repeat
AT_ONCE = 1 << 26  # bytes of surroundings that are too few for several passes
BUCKET = 24 << 20  # bytes of surroundings that meet in one group, about
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width] for each i where that fits."""
    span = 1
    while 2 * span <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def _anchors_of(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors in concatenated texts; ``ends`` has the end of each byte's text."""
    n = len(raw)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * powers("up", STEP, n), out=total[1:])
    hashed = mixed((total[GRAM:] - total[:-GRAM]) * powers("down", BACK, n)[:n - GRAM + 1])
    least = _sliding(hashed, REACH + 1, np.minimum)
    start = np.arange(len(least))
    least[start + LENGTH > ends[:len(least)]] = 0  # windows that cross a text's end
    # a hash is an anchor if it is the least of a window that holds it: least windows start at most REACH before
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    top = _sliding(padded, REACH + 1, np.maximum)
    at = np.flatnonzero(top == hashed)
    return at, hashed[at]


def anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, position, hash) of all anchors, some texts at a time."""
    i = 0
    while i < len(texts):
        if len(texts[i]) > CHUNK:
            raw = np.frombuffer(texts[i], np.uint8)
            for at in range(0, len(raw), CHUNK):  # each window lies whole in one piece
                part = raw[at:at + CHUNK + LENGTH - 1]
                p, h = _anchors_of(part, np.full(len(part), len(part)))
                yield np.full(len(p), i), p + at, h
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and len(texts[j]) <= CHUNK and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        sizes = np.array([len(t) for t in texts[i:j]])
        stop = np.cumsum(sizes)
        p, h = _anchors_of(np.frombuffer(b"".join(texts[i:j]), np.uint8), np.repeat(stop, sizes))
        of = np.searchsorted(stop, p, "right")
        yield of + i, p - (stop - sizes)[of], h
        i = j


def _packed(bucket: np.ndarray, columns: list[np.ndarray], side: bool) -> list[tuple]:
    """One row for each bucket, with each column's values as compressed bytes."""
    by = np.argsort(bucket, kind="stable")
    first, size = runs(bucket[by])
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return [(int(bucket[by[a]]), side, *(squeeze(c[by[a:a + m]].tobytes()) for c in columns)) for a, m in zip(first, size)]


def _values(packed: pa.ChunkedArray, kind) -> np.ndarray:
    """The values of packed rows; a row that lacks them has no bytes."""
    loose = zstandard.ZstdDecompressor().decompress
    return np.frombuffer(b"".join(loose(x) for x in packed.to_pylist() if x), kind)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    kinds = [pa.int32(), pa.bool_()] + [pa.binary()] * (len(names) - 2)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_of = batch.column("d").to_numpy()
            found = list(anchors(as_bytes(batch.column("text"))))
            if not found:
                continue
            of, at, hashed = (np.concatenate(c) for c in zip(*found))
            doc = doc_of[of]
            order = np.lexsort((doc, hashed))
            doc, at, hashed = doc[order], at[order].astype(np.uint32), hashed[order]
            first, size = runs(hashed)
            last = first + size - 1
            many = doc[first] != doc[last]  # repeated within the batch
            own = np.repeat(many, size)
            # to any bucket of the hash's class, as one hash can have many documents
            to = (hashed[own] % np.uint64(CLASSES)).astype(np.int64) + CLASSES * (doc[own] % (buckets // CLASSES))
            rows = _packed(to, [doc[own], at[own]], True) if own.any() else []
            rows = [(*r, b"") for r in rows]
            # what isn't repeated here goes on whole, what is goes on once
            on = ~own
            on[first] = True
            rows += _packed((hashed[on] % np.uint64(buckets)).astype(np.int64), [doc[on], at[on], hashed[on]], False)
            yield _batch(rows, ["bucket", "side", "docs", "at", "hashes"])

    return run


def _column(t: pa.Table, side: bool, name: str, kind) -> np.ndarray:
    return _values(t.filter(pc.equal(t.column("side"), side)).column(name), kind)


def _by_part(owner: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.Table:
    """Columns packed into a row for each part that their owners fall into."""
    rows = _packed((mixed(owner.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), [owner, *columns], False)
    cols = list(zip(*rows)) or [()] * (3 + len(columns))
    return pa.table({"part": pa.array(cols[0], pa.int32()), "owner": pa.array(cols[2], pa.binary()),
                     **{f"c{i}": pa.array(c, pa.binary()) for i, c in enumerate(cols[3:])}})


def _unpacked(t: pa.Table) -> pa.Table:
    """From the packed anchors of a part: a row for each document, with its positions."""
    doc, at = _values(t.column("owner"), np.int64), _values(t.column("c0"), np.uint32)
    order = np.argsort(doc, kind="stable")
    doc, at = doc[order], at[order]
    first, size = runs(doc)
    return pa.table({"d": pa.array(doc[first], pa.int64()), "at": pa.array([at[a:a + m].tobytes() for a, m in zip(first, size)], pa.binary())})


def _repeated(t: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """(document, position) of the anchors that two documents have, and the number of all."""
    doc, at, hashed = (_column(t, False, c, k) for c, k in (("docs", np.int64), ("at", np.uint32), ("hashes", np.uint64)))
    order = np.lexsort((doc, hashed))
    doc, at, hashed = doc[order], at[order], hashed[order]
    first, size = runs(hashed)
    many = np.repeat(doc[first] != doc[first + size - 1], size) if len(first) else np.zeros(0, bool)
    own = _column(t, True, "docs", np.int64)
    return np.concatenate([doc[many], own]), np.concatenate([at[many], _column(t, True, "at", np.uint32)]), len(doc) + len(own)


def _anchors_by_part(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        doc, at, sent = _repeated(t)
        order = np.argsort(doc, kind="stable")
        out = _by_part(doc[order], [at[order]], buckets)
        if not out.num_rows:  # for the count
            out = pa.table({"part": pa.array([0], pa.int32()), "owner": pa.array([b""], pa.binary()), "c0": pa.array([b""], pa.binary())})
        n = [0] * (out.num_rows - 1)
        return pa.table({"class": pa.array([t.column("bucket")[0].as_py() % CLASSES] * out.num_rows, pa.int32()),
                         "sent": pa.array([sent, *n], pa.int64()), "kept": pa.array([len(doc), *n], pa.int64()),
                         **{c: out.column(c) for c in out.column_names}})

    return run


#: A surrounding: the byte before, REACH bytes, the anchor, REACH bytes; how many of the bytes before and after exist.
_AROUND = 1 + REACH + LENGTH


def _send_surroundings(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "side", "docs", "rows", "at", "around", "before", "after"]
        for batch in batches:
            doc_of, row_of = batch.column("d").to_numpy(), batch.column("row").to_numpy()
            parts = []
            for i, (text, packed) in enumerate(zip(as_bytes(batch.column("text")), batch.column("at").to_pylist())):
                at = np.unique(np.frombuffer(packed, np.uint32)).astype(np.int64)
                at = at[at + GRAM <= len(text)]
                if not len(at):
                    continue
                raw = np.zeros(len(text) + 1 + REACH + LENGTH, np.uint8)
                raw[1 + REACH:1 + REACH + len(text)] = np.frombuffer(text, np.uint8)
                around = np.lib.stride_tricks.sliding_window_view(raw, _AROUND)[at]
                parts.append((np.full(len(at), i), at, around, np.minimum(at, REACH + 1).astype(np.uint8), np.minimum(len(text) - at, LENGTH).astype(np.uint8)))
            if not parts:
                continue
            of, at, around, before, after = (np.concatenate(c) for c in zip(*parts))
            doc, row = doc_of[of], row_of[of]
            # equal surroundings (and their ends) of a batch: only the least document's goes on
            whole = np.ascontiguousarray(np.c_[around, before, after]).view(f"S{_AROUND + 2}").ravel()
            order = np.lexsort((doc, whole))
            same = np.r_[False, whole[order][1:] == whole[order][:-1]]
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            later = doc[order] > doc[order][head]
            gone = order[later]
            rows = []
            if len(gone):
                own = _joined(*_spans(row[gone], at[gone] - np.minimum(before[gone], REACH), at[gone] + after[gone], before[gone], after[gone]))
                rows = [(*r, b"", b"", b"") for r in _packed(own[0] % buckets, [*own], True)]
            on = order[~later]
            gram = np.ascontiguousarray(around[on, 1 + REACH:1 + REACH + GRAM]).view("<u8").reshape(len(on), -1)
            key = mixed(mixed(mixed(gram[:, 0]) ^ gram[:, 1]) ^ gram[:, 2])
            rows += _packed((key % np.uint64(buckets)).astype(np.int64), [doc[on], row[on], at[on].astype(np.uint32), around[on], before[on], after[on]], False)
            yield _batch(rows, names)

    return run


def _spans(row, start, stop, before, after):
    """Spans to remove, as columns docs, rows, at of a packed row: empty where no window fits in."""
    fits = np.minimum(before, REACH).astype(np.int64) + after >= LENGTH
    stop = np.where(fits, stop, start)
    return row.astype(np.int64), start.astype(np.int64), stop.astype(np.int64)


def _joined(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's spans as maximal runs, sorted; empty ones left out."""
    some = stop > start
    row, start, stop = row[some], start[some], stop[some]
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    # rows one after the other on one line, so that no span of a row reaches into the next
    _, size = runs(row)
    base = np.repeat(np.arange(len(size)), size) << 33
    reach = np.maximum.accumulate(base + stop)
    new = np.r_[True, (base + start)[1:] > reach[:-1]] if len(row) else np.zeros(0, bool)
    return row[new], start[new], (reach - base)[np.r_[new[1:], True]] if len(row) else stop


def intervals(prefix: list[int], at_least: int) -> list[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last) of a sorted list of suffixes, inner ones first.

    ``prefix[i]`` is the length of the common prefix of suffixes i - 1 and i (the first is 0).
    """
    out, stack = [], []  # of (length, first)
    for i, n in enumerate([*prefix[1:], 0], 1):
        first = i - 1
        while stack and stack[-1][0] > n:
            length, first = stack.pop()
            out.append((length, first, i - 1))
        if n >= at_least and (not stack or stack[-1][0] < n):
            stack.append((n, first))
    return out


def _covered(doc: np.ndarray, around: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(surrounding, start, stop) relative to the anchor, of what maximal repeats cover in later documents."""
    who, starts, stops = [], [], []
    for left in range(REACH + 1):
        fit = np.flatnonzero((before >= left) & (left + after.astype(np.int64) >= LENGTH))
        if len(fit) < 2:
            continue
        suffix = np.ascontiguousarray(around[fit, 1 + REACH - left:])
        order = np.argsort(suffix.view(f"V{suffix.shape[1]}").ravel(), kind="stable")
        suffix, fit = suffix[order], fit[order]
        size = left + after[fit].astype(np.int64)
        differ = suffix[1:] != suffix[:-1]
        common = np.where(differ.any(1), differ.argmax(1), suffix.shape[1])
        common = np.r_[0, np.minimum(common, np.minimum(size[1:], size[:-1]))]
        joined = common >= LENGTH
        if not joined.any():
            continue
        # runs of suffixes joined by prefixes of LENGTH or more
        first = np.flatnonzero(~joined)
        length = np.diff(np.r_[first, len(fit)])
        first, length = first[length > 1], length[length > 1]
        neighbour = np.where(before[fit] > left, around[fit, REACH - left].astype(np.int64), -1)
        low, high = (f.reduceat(neighbour, np.c_[first, first + length].ravel()[:-1] if first[-1] + length[-1] == len(fit) else np.c_[first, first + length].ravel())[::2] for f in (np.minimum, np.maximum))
        maximal = (low != high) | (low < 0) | (left == REACH)
        for a, n in zip(first[maximal].tolist(), length[maximal].tolist()):
            docs = doc[fit[a:a + n]].tolist()
            best = [0] * n
            for prefix, i, j in intervals([0, *common[a + 1:a + n].tolist()], LENGTH):
                least = min(docs[i:j + 1])
                for k in range(i, j + 1):
                    if not best[k] and docs[k] > least:  # an inner interval is longer
                        best[k] = prefix
            for k, b in enumerate(best):
                if b:
                    who.append(fit[a + k])
                    starts.append(-left)
                    stops.append(b - left)
    return np.array(who, np.int64), np.array(starts, np.int64), np.array(stops, np.int64)


def _maximal(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the bytes that the repeats of a bucket's anchors remove."""
    doc, row, at = (_column(t, False, c, k) for c, k in (("docs", np.int64), ("rows", np.int64), ("at", np.uint32)))
    around = _column(t, False, "around", np.uint8).reshape(-1, _AROUND)
    before, after = (_column(t, False, c, np.uint8) for c in ("before", "after"))
    at = at.astype(np.int64)
    out = [tuple(_column(t, True, c, np.int64) for c in ("docs", "rows", "at"))]
    if len(doc):
        whole = np.ascontiguousarray(np.c_[around[:, 1 + REACH:], around[:, :1 + REACH], before, after]).view(f"V{_AROUND + 2}").ravel()
        order = np.lexsort((doc, np.unique(whole, return_inverse=True)[1]))  # by anchor, then surrounding, then document
        whole = whole[order]
        same = np.r_[False, whole[1:] == whole[:-1]]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        later = doc[order] > doc[order][head]
        gone = order[later]
        out.append(_spans(row[gone], at[gone] - np.minimum(before[gone], REACH), at[gone] + after[gone], before[gone], after[gone]))
        # one of each surrounding stands for it, unless its anchor has no other surrounding
        heads = order[~same]
        gram = np.ascontiguousarray(around[heads, 1 + REACH:1 + REACH + GRAM]).view(f"V{GRAM}").ravel()
        new = np.r_[True, gram[1:] != gram[:-1]]
        size = np.diff(np.r_[np.flatnonzero(new), len(gram)])
        heads = heads[np.repeat(size > 1, size)]
        who, start, stop = _covered(doc[heads], around[heads], before[heads], after[heads])
        # rows that share the surrounding and the least document share its spans
        of = {int(order[h]): [] for h in np.flatnonzero(~same)}
        for k, h in zip(np.flatnonzero(~later), head[~later]):
            of[int(order[h])].append(int(order[k]))
        for w, a, b in zip(who.tolist(), start.tolist(), stop.tolist()):
            own = np.array(of[int(heads[w])])
            out.append((row[own], at[own] + a, at[own] + b))
    return _joined(*(np.concatenate(c) for c in zip(*out)))


def _spans_by_part(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        row, start, stop = _maximal(t)
        return _by_part(row, [start.astype(np.uint32), (stop - start).astype(np.uint32)], buckets)

    return run


def _spans_of_rows(t: pa.Table) -> pa.Table:
    """From the packed spans of a part: a row for each owner, with its spans as maximal runs."""
    start, size = (_values(t.column(c), np.uint32).astype(np.int64) for c in ("c0", "c1"))
    row, start, stop = _joined(_values(t.column("owner"), np.int64), start, start + size)
    first, size = runs(row)
    return pa.table({"row": pa.array(row[first], pa.int64()),
                     **{n: pa.array([c[a:a + m].tobytes() for a, m in zip(first, size)], pa.binary()) for n, c in (("starts", start), ("stops", stop))}})


def merged(starts: bytes | None, stops: bytes | None) -> list[tuple[int, int]]:
    """Spans as maximal runs."""
    out: list[tuple[int, int]] = []
    if starts:
        a, b = (np.frombuffer(x, np.int64) for x in (starts, stops))
        for i in np.argsort(a, kind="stable").tolist():
            if out and a[i] <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], int(b[i])))
            else:
                out.append((int(a[i]), int(b[i])))
    return out


def _row(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def passes(sent: int, kept: int) -> int:
    """Number of passes over ``kept`` repeated anchors of ``sent``: the surroundings of each are about as many bytes as the text."""
    return max(1, -(-PASSES * kept // sent)) if kept * (_AROUND + 2) > AT_ONCE else 1


def _pass(d: DataFrame, repeated: DataFrame, buckets: int, parts: int) -> DataFrame:
    """Table of the spans that the repeats around these anchors remove."""
    at = repeated.groupBy("part").applyInArrow(_unpacked, "d long, at binary")  # a document's own positions
    sent = d.join(at, "d").select("d", "row", "text", "at").mapInArrow(
        _send_surroundings(buckets), "bucket int, side boolean, docs binary, rows binary, at binary, around binary, before binary, after binary")
    return stage(sent.groupBy("bucket").applyInArrow(_spans_by_part(parts), "part int, owner binary, c0 binary, c1 binary"), "repeats-spans")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, starts, stops): for each row hash the packed spans to remove, as maximal runs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("d"), _row(F.col(id_col), text).alias("row"), text.alias("text"))
    buckets = -(-2 * input_splits(d) // CLASSES) * CLASSES
    sent = d.select("d", "text").mapInArrow(_send_anchors(buckets), "bucket int, side boolean, docs binary, at binary, hashes binary")
    repeated = stage(sent.groupBy("bucket").applyInArrow(
        _anchors_by_part(buckets), "class int, sent long, kept long, part int, owner binary, c0 binary"), "repeats-anchors")
    release(repeated.sparkSession)
    n_sent, n_kept = (n or 0 for n in repeated.agg(F.sum("sent"), F.sum("kept")).first())
    n = passes(n_sent, n_kept)
    met = max(buckets // n, n_kept * (_AROUND + 2) // (n * BUCKET), 1)
    found = []
    for k in range(n):
        found.append(_pass(d, repeated.where(F.col("class") % n == k).select("part", "owner", "c0"), met, buckets))
        release(repeated.sparkSession)
    return reduce(DataFrame.unionByName, found).groupBy("part").applyInArrow(_spans_of_rows, "row long, starts binary, stops binary")


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, bytes and runs removed, digest of what is kept, and the runs themselves."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), _row(F.col(id_col), text).alias("row"))
    found = spans(docs, id_col, text_col)
    joined = d.join(found, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, a, b in zip(as_bytes(batch.column("text")), batch.column("starts").to_pylist(), batch.column("stops").to_pylist()):
                gone = merged(a, b)
                kept, at = hashlib.sha256(), 0
                for x, y in gone:
                    kept.update(t[at:x])
                    at = y
                kept.update(t[at:])
                rows.append((len(t), sum(y - x for x, y in gone), len(gone), kept.hexdigest(), ",".join(f"{x}:{y}" for x, y in gone)))
            n, r, s, h, p = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.int64()), pa.array(h, pa.string()), pa.array(p, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    kind = dict(docs.dtypes)[id_col]
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string")
