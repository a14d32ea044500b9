"""Hard-negative mining by a secondary sort.

Every score is the integer inner product of two quantised vectors. The rows that can matter are found
in blocks: each task keeps, for each anchor, the first ``POSITIVES`` rows of its label that it has
seen, and in a second pass the first ``NEGATIVES`` rows of other labels in the window of each
positive. Both passes end in the same shuffle: a score becomes a packed key of anchor, descending
score, kind and id, whose byte order is the wanted order; ``repartitionAndSortWithinPartitions``
deals keys by anchor, and an iterator reads each anchor as a stream. A positive opens a window, a
negative is emitted for each open window that it lies in, and a window closes with its last rank.
Nothing of an anchor is held but its open windows.

What a task keeps doesn't depend on the rows it reads: rows x anchors pairs are scored, and at most
(POSITIVES + POSITIVES * NEGATIVES) a task and anchor are shuffled, so no label or vector, however
common, makes a large group. Anchors go in waves of at most ``WAVE_BYTES`` of vectors, which are sent
to all tasks; a wave costs two scans of the rows.

Scores are exact: products of whole numbers in doubles while they stay below 2^53, in Python's
integers beyond. Windows of a negative positive score are empty, those of zero hold zero scores.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take
no part, and neither do components too large to be quantised as doubles; vectors meet only vectors of
their own length; a score that no long can hold forms no pair; rows that repeat an anchor's id are
none of its positives or negatives; anchors equal in id, label and vector are one, and other repeated
rows count one by one, in the order of score and id; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import stage
from assetlake.operators.rank import row_index

POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90  # a negative's score, in hundredths of the positive's
WAVE_BYTES = 32 << 20
WAVE_ANCHORS = 1 << 14
ROWS_A_TASK = 1 << 18
TILE = (512, 4096)
_KEY = struct.Struct(">IQBQ")
_KEYS = np.dtype([("anchor", ">u4"), ("score", ">u8"), ("negative", "u1"), ("id", ">u8")])
_TOP = (1 << 63) - 1
_NONE = np.iinfo(np.int64).min

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def participants(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label and quantised vector of the rows that take part."""
    d = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > 7e305))
    d = d.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return d.select("id", moved.alias("label"), "v")


def _matrix(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (row numbers, quantised vectors of that length)."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(256 * column.flatten().to_numpy(zero_copy_only=False).astype(float))
    start = np.cumsum(sizes) - sizes
    out = {}
    for width in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == width)
        out[width] = rows, flat[start[rows, None] + np.arange(width)]
    return out


def _scores(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of all rows as longs, and where a long can hold them."""
    if not left.shape[1]:
        return np.zeros((len(left), len(right)), np.int64), np.ones((len(left), len(right)), bool)
    if np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1] < 2.0 ** 53:
        return (left @ right.T).astype(np.int64), np.ones((len(left), len(right)), bool)
    whole = [[[int(x) for x in row] for row in side] for side in (left, right)]
    exact = np.array([[sum(x * y for x, y in zip(p, q)) for q in whole[1]] for p in whole[0]], object).reshape(len(left), len(right))
    fits = (exact > _NONE) & (exact <= _TOP)
    return np.where(fits, exact, 0).astype(np.int64), fits.astype(bool)


class _First:
    """The first ``keep`` rows of each list by descending score, id and arrival."""

    def __init__(self, lists: int, keep: int):
        self.keep = keep
        self.floor = np.full(lists, _NONE)
        self.at, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, lists: np.ndarray, score: np.ndarray, fits: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """``score`` has a row for each of ``lists`` and a column for each of ``rows``."""
        floor = self.floor[lists]
        if score.shape[1] > self.keep and (floor == _NONE).any():
            seen = np.where(fits, score, _NONE)
            floor = np.maximum(floor, np.partition(seen, -self.keep, axis=1)[:, -self.keep])
        i, j = np.nonzero(fits & (score >= floor[:, None]))
        if not len(i):
            return
        at, value = np.r_[self.at, lists[i]], np.r_[self.score, score[i, j]]
        who, row = np.r_[self.id, ids[j]], np.r_[self.row, rows[j]]
        order = np.lexsort((row, who, -value, at))
        at = at[order]
        first = np.r_[True, at[1:] != at[:-1]]
        rank = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        stay = order[rank < self.keep]
        self.floor[at[rank == self.keep - 1]] = value[order[rank == self.keep - 1]]
        self.at, self.score, self.id, self.row = np.r_[self.at, lists[i]][stay], value[stay], who[stay], row[stay]


class _Wave:
    """Anchors that are sent to all tasks, by the length of their vectors."""

    def __init__(self, rows: list):
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        vectors = pa.array([r["v"] for r in rows], pa.list_(pa.float64()))
        self.by_length = _matrix(vectors) if rows else {}

    def tiles(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """(anchors, rows of the batch, scores, where they fit) in blocks of ``TILE``."""
        for width, (rows, vectors) in _matrix(batch.column("v")).items():
            anchors, queries = self.by_length.get(width, (np.zeros(0, np.int64), None))
            for a in range(0, len(anchors), TILE[0]):
                for b in range(0, len(rows), TILE[1]):
                    yield anchors[a:a + TILE[0]], rows[b:b + TILE[1]], *_scores(queries[a:a + TILE[0]], vectors[b:b + TILE[1]])


def _keys(anchor: np.ndarray, score: np.ndarray, negative: int, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for s in range(0, len(anchor), 10_000):
        part = slice(s, s + 10_000)
        key = np.zeros(len(anchor[part]), _KEYS)
        key["anchor"], key["negative"] = anchor[part], negative
        key["score"] = (_TOP - score[part]).astype(np.uint64)  # wraps into the unsigned range, in order
        key["id"] = ids[part].astype(np.uint64) + np.uint64(1 << 63)
        yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in key], pa.binary())], names=["key"])


def _unpacked(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, negative, ids = _KEY.unpack(key)
    return anchor, _TOP - score, negative, ids - (1 << 63)


def _near_positives(wave):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = wave.value
        first, seen = _First(len(w.ids), POSITIVES), 0
        for batch in batches:
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            for anchors, rows, score, fits in w.tiles(batch):
                fits &= (labels[rows] == w.labels[anchors, None]) & (ids[rows] != w.ids[anchors, None])
                first.add(anchors, score, fits, ids[rows], seen + rows)
            seen += batch.num_rows
        yield from _keys(first.at, first.score, 0, first.id)

    return run


def _near_negatives(wave, windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, (low, high) = wave.value, windows.value
        lists, seen = [_First(len(w.ids), NEGATIVES) for _ in range(POSITIVES)], 0
        for batch in batches:
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            for anchors, rows, score, fits in w.tiles(batch):
                fits &= (labels[rows] != w.labels[anchors, None]) & (ids[rows] != w.ids[anchors, None])
                for slot, first in enumerate(lists):
                    inside = fits & (score >= low[anchors, slot, None]) & (score <= high[anchors, slot, None])
                    first.add(anchors, score, inside, ids[rows], seen + rows)
            seen += batch.num_rows
        at, score, who, row = (np.concatenate([getattr(x, name) for x in lists]) for name in ("at", "score", "id", "row"))
        _, once = np.unique(np.stack([at, row]), axis=1, return_index=True)  # windows overlap
        yield from _keys(at[once], score[once], 1, who[once])

    return run


def _sorted_keys(keys: DataFrame, parts: int) -> RDD:
    """Packed keys in their order, each anchor in one partition."""
    return keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(
        parts, lambda key: int.from_bytes(key[:4], "big")).keys()


def _bounds(positive: int) -> tuple[int, int]:
    return -(-LOWEST * positive // 100), HIGHEST * positive // 100


def _first_of_each(keys: Iterator[bytes]) -> Iterator[bytes]:
    """The first POSITIVES keys of each anchor."""
    current, taken = None, 0
    for key in keys:
        if key[:4] != current:
            current, taken = key[:4], 0
        taken += 1
        if taken <= POSITIVES:
            yield key


def _open_windows(keys: Iterator[bytes]) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, their scores) from an ordered stream of keys."""
    current, windows = None, []
    for key in keys:
        anchor, score, negative, who = _unpacked(key)
        if anchor != current:
            current, windows = anchor, []
        if not negative:
            windows.append([who, score, *_bounds(score), 0])
            continue
        for window in windows:
            if window[2] <= score <= window[3] and window[4] < NEGATIVES:
                window[4] += 1
                yield anchor, window[0], window[4], who, window[1], score
        if any(window[2] > score or window[4] == NEGATIVES for window in windows):
            windows = [w for w in windows if w[2] <= score and w[4] < NEGATIVES]


def mine(vectors: DataFrame, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For each anchor and positive its hard negatives in order; anchors are ids divisible by ``every``."""
    spark = vectors.sparkSession
    context = spark.sparkContext
    rows = participants(vectors, id_col, vector_col, label_col)
    anchors = row_index(rows.where(F.col("id") % every == 0).distinct(), "number")
    n, many, width = rows.agg(F.count(F.lit(1)), F.count_if(F.col("id") % every == 0), F.max(F.size("v"))).first()
    if not many:
        return spark.createDataFrame([], RESULT)
    size = max(1, min(WAVE_ANCHORS, WAVE_BYTES // (8 * max(1, width))))
    # few rows a task would make a list of each anchor for each of them
    dealt = rows.coalesce(max(context.defaultParallelism, -(-n // ROWS_A_TASK)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for start in range(0, many, size):
        wave = _Wave(anchors.where((F.col("number") >= start) & (F.col("number") < start + size)).orderBy("number").collect())
        if not len(wave.ids):
            break  # equal anchors were one
        sent = context.broadcast(wave)
        positives = _sorted_keys(dealt.mapInArrow(_near_positives(sent), "key binary"), parts).mapPartitions(_first_of_each)
        positives = stage(spark.createDataFrame(positives.map(lambda key: (bytearray(key),)), "key binary"), "negatives-positives")
        low, high = np.full((len(wave.ids), POSITIVES), 1), np.zeros((len(wave.ids), POSITIVES), np.int64)
        slots = [0] * len(wave.ids)
        for r in positives.toLocalIterator():  # at most POSITIVES an anchor of the wave
            anchor, score, _, _ = _unpacked(bytes(r["key"]))
            low[anchor, slots[anchor]], high[anchor, slots[anchor]] = _bounds(score)
            slots[anchor] += 1
        windows = context.broadcast((low, high))
        keys = dealt.mapInArrow(_near_negatives(sent, windows), "key binary").unionAll(positives)
        names = context.broadcast(wave.ids.tolist())
        mined = _sorted_keys(keys, parts).mapPartitions(_open_windows).map(lambda r: (names.value[r[0]], *r[1:]))
        mined = stage(spark.createDataFrame(mined, RESULT), "negatives-mined")
        found = mined if found is None else found.unionAll(mined)
    return found


#: The same by brute force in DuckDB.
SQL = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 100 = 0),
positives AS (
  SELECT anchor, other, score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT p.anchor AS anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS r
  FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
  WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE r <= 10
"""
