"""Importance resampling of documents towards a target's distribution, by lines.

Features are all runs of one to three consecutive words, hashed into ``BUCKETS`` buckets by CRC-32.
Texts are cut at newlines. Each distinct line is hashed once: its bucket list is stored, its counts
enter the corpus's multiplied by the line's occurrences, and once the corpus's and the target's counts
give each bucket its gain, the stored list gives the line's weight. Runs that cross a line break belong
to a document and are added separately, from the words next to a break. A document's weight is the
sum over its lines plus that of its crossing runs.

CRC-32 is linear: numpy computes the sums of all words of a block of text from a table by byte and
distance to the word's end, and those of longer runs by shifting the sum of the front part by the
length of the next word.

Lines meet by 128 bits of two hashes. Lines with more than one in ``HOT`` of all occurrences, at most
HOT of them, are joined by broadcast, the others by key, so that no key gathers more than that share.
The draw is a global order by score and id: rows are sorted by range, and positions follow from the
sizes of the ranges.

Defined results: a null or empty text has no features and weight 0; a null id hashes as an empty one
and comes last among equal scores; repeated rows are documents of their own, and so are drawn one by
one; an empty table gives an empty table, an empty target one whose counts are 0; other columns are
ignored.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import stage
from assetlake.operators.rank import row_index

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
HOT = 10_000
BLOCK = 1 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_STEP = 256  # distances in the tables


# --- checksums ----------------------------------------------------------------------------------
@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Effect on the sum of a byte at a distance from the end, and of a sum's four bytes by zeros that follow."""
    one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    reach = np.empty((_STEP, 256), np.uint32)
    reach[0] = one
    for d in range(1, _STEP):
        reach[d] = (reach[d - 1] >> 8) ^ one[reach[d - 1] & 255]
    shift = np.empty((_STEP, 4, 256), np.uint32)
    shift[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, _STEP):
        shift[n] = (shift[n - 1] >> 8) ^ one[shift[n - 1] & 255]
    return reach, shift


def _shifted(sums: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """The sums' effect when so many bytes follow."""
    _, shift = _tables()
    sums, left = sums.copy(), zeros
    while True:
        n = np.minimum(left, _STEP - 1)
        sums = shift[n, 0, sums & 255] ^ shift[n, 1, (sums >> 8) & 255] ^ shift[n, 2, (sums >> 16) & 255] ^ shift[n, 3, sums >> 24]
        left = left - n
        if not left.any():
            return sums


def _word_sums(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each word of lower-cased bytes."""
    reach, _ = _tables()
    sums = np.zeros(len(start), np.uint32)
    short = end - start <= _STEP
    s, e = start[short], end[short]
    if len(s):
        size = e - s
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) - np.repeat(first - s, size)
        effect = reach[np.repeat(e, size) - at - 1, raw[at]]
        # the sum of as many zero bytes, which the table leaves out
        zero = np.array([zlib.crc32(bytes(n)) for n in range(_STEP + 1)], np.uint32)
        sums[short] = np.bitwise_xor.reduceat(effect, first) ^ zero[size]
    for i in np.flatnonzero(~short):
        sums[i] = zlib.crc32(raw[start[i]:end[i]].tobytes())
    return sums


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and where their words start and end."""
    raw = np.frombuffer(data.translate(_LOWER), np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _WORD[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return raw, edge[0::2], edge[1::2]


def run_sums(sums: np.ndarray, size: np.ndarray, group: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1, 2, .. LONGEST words: (index of the last word, CRC-32) of the runs within equal ``group``."""
    if not len(sums):
        return [(np.zeros(0, np.int64), sums)] * LONGEST
    # the sum of a space and the word, as a continuation: a run's sum is its front's, shifted, with this
    space = _shifted(np.full(len(sums), np.uint32(zlib.crc32(b" "))), size) ^ sums
    out = [(np.arange(len(sums)), sums)]
    for n in range(2, LONGEST + 1):
        last = np.arange(n - 1, len(sums))
        out.append((last, _shifted(out[-1][1][:-1], size[last] + 1) ^ space[last]))
    return [(last[group[last] == group[last - n]], value[group[last] == group[last - n]]) for n, (last, value) in enumerate(out)]


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK bytes; a longer text is alone."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK):
            size += len(texts[j]) + 1
            j += 1
        yield i, j
        i = j


def line_buckets(lines: list[bytes]) -> list[np.ndarray]:
    """The sorted buckets of all runs within each line."""
    out: list[np.ndarray] = []
    for i, j in _blocks(lines):
        raw, start, end = words(b"\n".join(lines[i:j]))
        first = np.cumsum([0] + [len(x) + 1 for x in lines[i:j]])
        line = np.searchsorted(first, start, "right") - 1
        found = run_sums(_word_sums(raw, start, end), end - start, line)
        bucket = np.concatenate([value % BUCKETS for _, value in found]).astype(np.int64)
        of = np.concatenate([line[last] for last, _ in found])
        order = np.argsort(of * BUCKETS + bucket, kind="stable")
        out += np.split(bucket[order], np.searchsorted(of[order], np.arange(1, j - i)))
    return out


def crossing_buckets(texts: list[bytes]) -> list[tuple[int, np.ndarray]]:
    """Of each text the number of words and the buckets of the runs over a newline."""
    out: list[tuple[int, np.ndarray]] = []
    for i, j in _blocks(texts):
        data = b"\n".join(texts[i:j])
        raw, start, end = words(data)
        first = np.cumsum([0] + [len(x) + 1 for x in texts[i:j]])
        text = np.searchsorted(first, start, "right") - 1
        line = np.searchsorted(np.flatnonzero(raw == 10), start)
        # only words within reach of a break are hashed
        near = np.zeros(len(start), bool)
        cut = np.flatnonzero((line[1:] != line[:-1]) & (text[1:] == text[:-1])) + 1
        for k in range(1 - LONGEST, LONGEST - 1):
            at = cut + k
            near[at[(at >= 0) & (at < len(start))]] = True
        some = np.flatnonzero(near)
        s, e = start[some], end[some]
        # words that were neighbours stay in one group
        apart = np.zeros(len(some), np.int64)
        apart[1:] = (np.diff(some) > 1) | (np.diff(text[some]) > 0)
        found = run_sums(_word_sums(raw, s, e), e - s, np.cumsum(apart))
        picked = [(last[line[some[last]] != line[some[last - n]]], value[line[some[last]] != line[some[last - n]]]) for n, (last, value) in enumerate(found)]
        bucket = np.concatenate([value % BUCKETS for _, value in picked]).astype(np.int64)
        of = np.concatenate([text[some[last]] for last, _ in picked])
        order = np.argsort(of * BUCKETS + bucket, kind="stable")
        parts = np.split(bucket[order], np.searchsorted(of[order], np.arange(1, j - i)))
        out += zip(np.bincount(text, minlength=j - i).tolist(), parts)
    return out


def _packed(sorted_buckets: np.ndarray) -> bytes:
    """Differences of sorted buckets: all low bytes, then all high ones, which are zeros mostly."""
    return np.diff(sorted_buckets, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(2, -1).T.copy().view("<u2").ravel().cumsum(dtype=np.int64)


# --- Spark --------------------------------------------------------------------------------------
def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _hashed(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _document_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, doc_id, n_words, crossing (packed) and lines (their hashes) of every document."""
    def crossing(text: pd.Series) -> pd.DataFrame:
        found = crossing_buckets([(t or "").encode("utf-8", "surrogatepass") for t in text])
        return pd.DataFrame({"n_words": [n for n, _ in found], "crossing": [_packed(b) for _, b in found]})

    text = F.col(text_col).cast("string")
    run = F.pandas_udf(crossing, "n_words long, crossing binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.transform(_lines(text), _hashed).alias("lines"), run(text).alias("f")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "lines", "f.n_words", "f.crossing")


def _line_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """h1, h2, occurrences and buckets (packed) of every distinct line."""
    lines = docs.select(F.explode(_lines(F.col(text_col).cast("string"))).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = pa.array([_packed(b) for b in line_buckets(_bytes(batch.column("line")))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("h1", "h2", "occurrences")), buckets], names=["h1", "h2", "occurrences", "buckets"])

    return (lines.withColumn("h", _hashed(F.col("line"))).select("h.h1", "h.h2", "occurrences", "line")
            .mapInArrow(run, "h1 long, h2 long, occurrences long, buckets binary"))


def _counts(lists: DataFrame) -> np.ndarray:
    """Occurrences of each bucket over (times, buckets) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for times, packed in zip(batch.column("times").to_pylist(), batch.column("buckets").to_pylist()):
                np.add.at(total, _unpacked(packed), times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in lists.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's whole-number gain: how much likelier a feature is in the target, each count plus one."""
    all_s, all_t = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weigher(gain: np.ndarray):
    def weigh(packed: pd.Series) -> pd.Series:
        return pd.Series([int(gain[_unpacked(p)].sum()) for p in packed], dtype="int64")

    return F.pandas_udf(weigh, "long")


def resample(docs: DataFrame, target: DataFrame, seed: int = 42, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document."""
    rows = stage(_document_rows(docs, id_col, text_col), "resample-documents")
    lines = stage(_line_rows(docs, text_col), "resample-lines")
    corpus = _counts(lines.select(F.col("occurrences").alias("times"), "buckets").unionAll(rows.select(F.lit(1).cast("long"), "crossing")))
    aims = _document_rows(target.select(F.lit(0).alias("i"), F.col(target_col)), "i", target_col).select(F.lit(1).cast("long").alias("times"), F.col("crossing").alias("buckets"))
    wanted = _counts(_line_rows(target, target_col).select(F.col("occurrences").alias("times"), "buckets").unionAll(aims))
    weigh = _weigher(gains(corpus, wanted))

    weights = stage(lines.select("h1", "h2", "occurrences", weigh("buckets").alias("weight")), "resample-weights")
    total = weights.agg(F.sum("occurrences").alias("total")).select("total").scalar()
    is_hot = F.col("occurrences") * HOT >= total  # at most HOT lines: their occurrences add up to no more than all
    each = rows.select("row", F.explode("lines").alias("l")).select("row", "l.h1", "l.h2")
    hot = F.broadcast(weights.where(is_hot).select("h1", "h2", F.col("weight").alias("hot_weight"), F.lit(True).alias("hot")))
    each = each.join(hot, ["h1", "h2"], "left")
    known = each.where("hot").select("row", F.col("hot_weight").alias("weight"))
    others = each.where("hot IS NULL").select("row", "h1", "h2").join(weights.where(~is_hot).select("h1", "h2", "weight"), ["h1", "h2"]).select("row", "weight")
    summed = known.unionAll(others).groupBy(F.col("row").alias("of")).agg(F.sum("weight").alias("weight"))
    weighed = rows.select("row", "doc_id", "n_words", weigh("crossing").alias("own")).join(summed, F.col("row") == F.col("of"), "left")

    drawn_by = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn_by + 0.5) / F.lit(4294967296.0))))
    n = F.col("n_words")
    weight = F.col("own") + F.coalesce("weight", F.lit(0))
    scored = weighed.select("row", "doc_id", n, sum(F.greatest(n - k, F.lit(0)) for k in range(LONGEST)).cast("long").alias("n_features"),
                            weight.cast("long").alias("weight"), (weight + noise).cast("long").alias("score"))
    scored = stage(scored, "resample-scores")
    takes_part = F.col("n_words") >= LEAST_WORDS
    draws = scored.where(takes_part).count() * percent // 100
    order = [(~takes_part).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    placed = row_index(scored.repartitionByRange(*order).sortWithinPartitions(*order), "place")
    rank = F.when(takes_part & (F.col("place") < draws), F.col("place") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
