"""Token ids as length-delimited binary records.

A shard is one file of frames in ascending order of document id, and shards follow each other in that
order. A frame is

    length of the payload (8 bytes) | masked checksum of these | payload | masked checksum of it | newline

and a payload the document id (8 bytes, with a byte before it that is 0 where it is null), the width
of an id in bytes (2 while the vocabulary allows, else 4) and the ids; numbers are little-endian. A
masked checksum is a CRC-32 rotated by 15 bits plus a constant, so that the checksum of data that hold
checksums stays meaningful.

Shards are written by Spark's own text writer, a frame a row with the newline as separator: its commit
protocol makes retried and speculative tasks harmless on any file system that Spark writes. They are
read back as whole files, sized by ``SHARD_BYTES`` of text. One pass over a shard checks all lengths
and checksums and gives the offset index, a separate table (shard, record, place, document, tokens),
with which records can be read in any order: ``read_at`` loads the records of any part of the index,
``read_shuffled`` all in a seeded order.

Words repeat, so a worker looks up the distinct chunks of a block of texts among those that it remembers, all
at once in arrays sorted by hash: about ``MEMO`` new ones, and of as many older ones those met again since;
of chunks of more than 16 bytes, ``LONG_MEMO``. A chunk lies between ASCII white space, or a letter and a last stop, where the vocabulary's
splitting rule always splits; texts that may hold a special token are encoded whole.

Defined results: a null or empty text is the end id alone; null ids come first; rows of one id go by
their text's hash, and repeated rows are a record each; an empty table gives no record; other
columns are ignored. A damaged shard raises an error that names the shard and the record.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import stage
from assetlake.llm.hashing import mixed
from assetlake.session import checkpoint_dir

END_ID = 1
MEMO = 240_000
LONG_MEMO = 30_000
LINE = 200  # letter runs that are encoded together
BLOCK = 1 << 19  # bytes of texts whose chunks are looked up together
SHARD_BYTES = 16 << 20
LEAST_BYTES = 4 << 20  # of a shard, where there are too few for all cores
#: Fixed value: the constant of the masked checksum.
MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
_DOCUMENT = struct.Struct("<BqB")
#: What ends a word's last token in the vocabulary; stops, which are words of their own behind letters.
_WORD_END = "</w>"
_STOPS = b".,;:!?"
#: ASCII letters in lower case, which the vocabulary has anyway, and ASCII white space that separates words as a space.
_PLAIN = np.frombuffer(bytes(range(256)).lower().translate(bytes.maketrans(b"\t\n\r", b"   ")), np.uint8)
_IS_STOP, _IS_SPACE = (np.isin(np.arange(256), list(x)) for x in (_STOPS, b" \t\n\r"))
#: Fixed value: the vocabulary's splitting rule for ASCII in lower case.
_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_IS_LETTER = np.isin(np.arange(256) | 32, np.arange(97, 123)) & (np.arange(256) < 128)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record without its newline."""
    length = struct.pack("<Q", len(payload))
    return b"".join([length, _TAIL.pack(masked(length)), payload, _TAIL.pack(masked(payload))])


def payload_of(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """``ids`` are little-endian numbers of ``width`` bytes."""
    return _DOCUMENT.pack(doc_id is not None, doc_id or 0, width) + ids


def document_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a payload."""
    known, doc_id, width = _DOCUMENT.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=_DOCUMENT.size).astype("<u4")


def record_at(data: bytes, offset: int, where: str = "") -> tuple[bytes, int]:
    """The payload of the record at ``offset`` and the offset of the next one."""
    body = offset + _HEAD.size
    if body > len(data):
        raise ValueError(f"{where}: cut short at {offset}")
    length, crc = _HEAD.unpack_from(data, offset)
    if crc != masked(data[offset:offset + 8]):
        raise ValueError(f"{where}: length of the record at {offset} is damaged")
    end = body + length + _TAIL.size
    if end + 1 > len(data):
        raise ValueError(f"{where}: cut short at {offset}")
    payload = data[body:body + length]
    if _TAIL.unpack_from(data, body + length)[0] != masked(payload) or data[end] != 10:
        raise ValueError(f"{where}: the record at {offset} is damaged")
    return payload, end + 1


# --- tokens -------------------------------------------------------------------------------------
def _clean(text: bytes) -> np.ndarray:
    """Bytes with ASCII letters in lower case and a space wherever the vocabulary's splitting rule always splits.

    That is at ASCII white space, and between an ASCII letter and a stop before white space.
    """
    raw = np.frombuffer(text, np.uint8)
    stop = np.flatnonzero(_IS_STOP[raw])
    stop = stop[(stop > 0) & (stop < len(raw) - 1)]
    return np.insert(_PLAIN[raw], stop[_IS_LETTER[raw[stop - 1]] & _IS_SPACE[raw[stop + 1]]], 32)


def _distinct(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Where the space-separated chunks start and end, one of each distinct chunk, which of these each chunk is, and their keys.

    Chunks of up to 16 bytes are compared by their first and last eight; longer ones count as distinct.
    Keys are the hash, these bytes and the size, in the order of the hashes.
    """
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = raw != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    size = (end - start).astype(np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded, 0, (1,))  # the eight bytes from every place on
    beyond = np.uint64(8) * (np.uint64(8) - np.minimum(size, np.uint64(8)))
    head = (eight[start] << beyond) >> beyond
    tail = np.where(size > 8, eight[np.maximum(end - 8, 0)], np.uint64(0))
    long = size > 16
    head[long], tail[long] = start[long], ~np.uint64(0)
    hashed = mixed(head + mixed(tail + size * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(hashed, kind="stable")
    keys = [x[order] for x in (hashed, head, tail, size)]
    first = np.ones(len(order), bool)
    first[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in keys])  # equal hashes of others only split a chunk's rows
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(first) - 1
    return start, end, order[first], which, [x[first] for x in keys]


def _spread(ids: np.ndarray, at: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` from ``at`` on, of ``many`` ids each, one behind the other."""
    before = np.cumsum(many) - many
    return ids[np.arange(many.sum()) + np.repeat(at - before, many)]


class _Known:
    """Token ids of chunks of up to 16 bytes, by their keys in the order of the hashes."""

    def __init__(self, width: int):
        self.keys = [np.empty(0, kind) for kind in ("u8", "u8", "u8", "u1")]
        self.at, self.many, self.ids = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, f"<u{width}")

    def __len__(self) -> int:
        return len(self.at)

    def find(self, keys: list[np.ndarray]) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        if not len(self):
            return np.full(len(keys[0]), -1)
        at = np.minimum(np.searchsorted(self.keys[0], keys[0]), len(self) - 1)
        same = np.logical_and.reduce([own[at] == other for own, other in zip(self.keys, keys)])
        return np.where(same, at, -1)

    def add(self, keys: list[np.ndarray], many: np.ndarray, ids: np.ndarray) -> None:
        hashed = np.concatenate([self.keys[0], keys[0]])
        order = np.argsort(hashed, kind="stable")  # two sorted runs or few

        def merged(own: np.ndarray, other: np.ndarray) -> np.ndarray:
            return np.concatenate([own, other.astype(own.dtype)])[order]

        self.keys = [hashed[order], *map(merged, self.keys[1:], keys[1:])]
        self.at = merged(self.at, len(self.ids) + np.cumsum(many) - many)
        self.many = merged(self.many, many)
        self.ids = np.concatenate([self.ids, ids])


class _Encoder:
    """Token ids of many texts by a file of the tokenizers library.

    The distinct chunks of a block of texts are looked up among those known. New runs of letters are
    encoded a line at a time: a run's last token, and no other, is one that ends a word in the
    vocabulary. Lines of ASCII letters in lower case, which no normalisation changes, need only be
    split at spaces; other ASCII chunks are cut by the same rule as the library does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True
        self.memo, self.older = _Known(self.width), _Known(self.width)
        self.long: dict[bytes, bytes] = {}
        self.long_older: dict[bytes, bytes] = {}
        self.learned: dict[bytes, bytes] = {}  # of the block at hand

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_runs(self, new: list[bytes], by) -> None:
        lines = [new[s:s + LINE] for s in range(0, len(new), LINE)]
        for line, found in zip(lines, by.encode_batch_fast([b" ".join(x).decode() for x in lines], add_special_tokens=False)):
            ids = np.array(found.ids, f"<u{self.width}")
            cut = ((np.flatnonzero(self.ends[ids]) + 1) * self.width).tolist()
            if len(cut) == len(line):
                data = ids.tobytes()
                self.learned.update(zip(line, [data[a:b] for a, b in zip([0, *cut], cut)]))
            else:  # a letter that the library splits at
                self.learned.update(zip(line, self._whole([x.decode() for x in line])))

    def _learn(self, new: list[bytes]) -> None:
        plain, letters, others, cut = [], [], [], {}
        for chunk in new:
            if chunk.isalpha():  # of ASCII
                plain.append(chunk)
            elif chunk.isascii():
                cut[chunk] = _PIECES.findall(chunk)
            elif (text := chunk.decode()).isalpha() and text.lower().isalpha():
                letters.append(chunk)
            else:
                others.append(chunk)
        pieces = set().union(*cut.values()).difference(self.learned, plain)
        self._learn_runs([*plain, *pieces], self.plain)
        self._learn_runs(letters, self.tokenizer)
        known = self.learned.__getitem__
        self.learned.update([(chunk, b"".join(map(known, own))) for chunk, own in cut.items()])
        self.learned.update(zip(others, self._whole([x.decode() for x in others])))

    def _new(self, data: bytes, start: np.ndarray, end: np.ndarray) -> list[bytes]:
        """The ids of chunks that aren't among ``memo`` and ``older``."""
        chunks = [data[a:b] for a, b in zip(start.tolist(), end.tolist())]
        if len(self.long) > LONG_MEMO:
            self.long_older, self.long = self.long, {}
        long = {c for c in chunks if len(c) > 16}
        self.learned = {c: ids for c in long if (ids := self.long.get(c, self.long_older.get(c))) is not None}
        if new := [c for c in dict.fromkeys(chunks) if c not in self.learned]:
            self._learn(new)
        self.long.update([(c, self.learned[c]) for c in long])
        out = list(map(self.learned.__getitem__, chunks))
        self.learned = {}
        return out

    def _block(self, texts: list[bytes]) -> list[bytes]:
        # a text ends with a newline, which no chunk holds, and is marked by another byte that none holds
        joined = _clean(b"".join([x for t in texts for x in (t, b"\n\xff\n")]))
        raw = np.where(joined == 255, np.uint8(32), joined)
        start, end, some, which, keys = _distinct(raw)
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, _Known(self.width)
        at, many = np.empty(len(some), np.int64), np.empty(len(some), np.int64)
        found = self.memo.find(keys)
        missed = np.flatnonzero(found < 0)
        before = self.older.find([x[missed] for x in keys])
        again, new = missed[before >= 0], missed[before < 0]
        made = self._new(raw.tobytes(), start[some[new]], end[some[new]])
        many[new] = np.fromiter(map(len, made), np.int64, len(new)) // self.width
        sources = [self.memo.ids, self.older.ids, np.frombuffer(b"".join(made), f"<u{self.width}")]
        at[new] = len(sources[0]) + len(sources[1]) + np.cumsum(many[new]) - many[new]
        for known, rows, places, first in ((self.memo, np.flatnonzero(found >= 0), found[found >= 0], 0), (self.older, again, before[before >= 0], len(sources[0]))):
            at[rows], many[rows] = first + known.at[places], known.many[places]
        ids = np.concatenate(sources)
        keep = missed[keys[3][missed] <= 16]
        if len(keep):
            self.memo.add([x[keep] for x in keys], many[keep], _spread(ids, at[keep], many[keep]))
        size = many[which]
        before = np.cumsum(size) - size
        every = _spread(ids, at[which], size)
        # the first chunk behind each text's mark, and so the next text's first id
        firsts = np.searchsorted(start, np.flatnonzero(joined == 255)[:-1])
        return [x.tobytes() for x in np.split(every, np.r_[before, len(every)][firsts])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out, block, size = [b""] * len(texts), [], 0
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = self._whole([text])[0]
            elif text:
                block.append((i, text.encode()))
                size += len(block[-1][1])
            if block and (size > BLOCK or i == len(texts) - 1):
                for (k, _), ids in zip(block, self._block([t for _, t in block])):
                    out[k] = ids
                block, size = [], 0
        return out


_ENCODERS: dict[str, _Encoder] = {}


def _framed(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        if tokenizer not in _ENCODERS:  # one vocabulary and memo for each worker process
            _ENCODERS[tokenizer] = _Encoder(public_tokenizers.path(f"{tokenizer}.json"))
        encode = _ENCODERS[tokenizer]
        end = np.array([END_ID], f"<u{encode.width}").tobytes()
        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            size = max(1, min(1024, 4 * BLOCK * batch.num_rows // max(1, texts.nbytes)))
            for s in range(0, len(names), size):
                ids = encode([t or "" for t in texts[s:s + size].to_pylist()])
                yield pa.RecordBatch.from_arrays([_binaries([frame(payload_of(n, x + end, encode.width)) for n, x in zip(names[s:s + size], ids)])], names=["frame"])

    return run


# pa.array loads pandas, 44 MB that a worker holds beside the vocabulary
def _binaries(values: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(values))])


def _longs(values: Sequence[int | None]) -> pa.Array:
    known = np.packbits([v is not None for v in values], bitorder="little")
    return pa.Array.from_buffers(pa.int64(), len(values), [pa.py_buffer(known), pa.py_buffer(np.array([v or 0 for v in values], np.int64))])


# --- writing and reading ------------------------------------------------------------------------
def write(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k", id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the shards of ``docs`` to the folder ``path``. ``tokenizer`` names a public vocabulary."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = d.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    # rows of one id, and equal rows, are split too
    d = d.withColumn("order", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    keys = [F.col("doc_id").asc_nulls_first(), "order", "row"]
    shards = max(-(-size // SHARD_BYTES), min(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-size // LEAST_BYTES)), 1)
    d = d.repartitionByRange(shards, *keys).sortWithinPartitions(*keys)
    frames = d.select("doc_id", "text").mapInArrow(_framed(tokenizer), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("shard"), "path", "content")


_INDEX = "shard long, record long, offset long, length long, doc_id long, n_tokens long, before long, ids_crc32 long"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _INDEX.split(", ")]
    for batch in batches:
        for shard, path, content in zip(batch.column("shard").to_pylist(), batch.column("path").to_pylist(), batch.column("content")):
            data, offset, before, rows = memoryview(content.as_buffer()), 0, 0, []
            while offset < len(data):
                payload, after = record_at(data, offset, path)
                doc_id, ids = document_of(payload)
                rows.append((shard, len(rows), offset, after - offset, doc_id, len(ids), before, zlib.crc32(ids.tobytes())))
                before += len(ids)
                offset = after
            if rows:
                yield pa.RecordBatch.from_arrays([_longs(c) for c in zip(*rows)], names=names)


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index of a folder of shards: a row for each record, read from the shards and checked.

    ``before`` is the number of ids in its shard before the record.
    """
    return _shards(spark, path).mapInArrow(_walk, _INDEX)


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the number of ids of all records before. A shard is a number on the driver."""
    per = sorted((r["shard"], r["n"]) for r in index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    spark, total, rows = index.sparkSession, 0, []
    for shard, n in per:
        rows.append((shard, total))
        total += n
    firsts = spark.createDataFrame(rows, "at long, first long")
    return index.join(firsts, F.col("shard") == F.col("at")).withColumn("start", F.col("first") + F.col("before")).drop("at", "first")


def read_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records that rows of an index name: their columns and ``ids``; only their shards are opened.

    A shard's rows of the index are dealt to its file in pieces, so shards are not gathered.
    """
    places = wanted.groupBy("shard").agg(F.collect_list(F.struct("*")).alias("places"))  # an index row is small
    kind = places.schema["places"].dataType.elementType
    files = _shards(spark, path).join(places, "shard").select("path", "content", "places")
    schema = f"{kind.simpleString()[7:-1].replace(',', ', ').replace(':', ' ')}, ids array<long>"

    def read(batches):
        import pandas as pd

        for batch in batches:
            for where, content, rows in zip(batch["path"], batch["content"], batch["places"]):
                data = memoryview(content)
                for s in range(0, len(rows), 256):
                    part = [dict(r) if isinstance(r, dict) else r.asDict() for r in rows[s:s + 256]]
                    yield pd.DataFrame([r | {"ids": document_of(record_at(data, r["offset"], where)[0])[1].astype(np.int64)} for r in part])

    return files.mapInPandas(read, schema)


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, seed: int) -> DataFrame:
    """All records in an order drawn by ``seed``, the same in every run: ``draw``, doc_id and ids, sorted by range.

    Each shard is read once; the records move, not the files.
    """
    drawn = index.select("shard", "record", "offset", "doc_id", F.xxhash64(F.lit(seed), "shard", "record").alias("draw"))
    out = read_at(spark, path, drawn)
    return out.repartitionByRange("draw", "shard", "record").sortWithinPartitions("draw", "shard", "record").select("draw", "doc_id", "ids")


def encode(docs: DataFrame, tokenizer: str = "word_bpe_49k") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from shards written and read back."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/assetlake-llm/records-{uuid.uuid4().hex}"
    write(docs, path, tokenizer)
    index = stage(build_index(spark, path), "records-index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")
