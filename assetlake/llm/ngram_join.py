"""N-gram Jaccard join on parity sketches.

1. A text's set is its distinct word shingles. Equal sets share a 64-bit signature, their *node*, so
   exact copies are one node from here on.
2. Nodes fall into size bands. A band fixes a largest symmetric difference d that two linked sets of
   its sizes can have, and a layout of d + 1 + ``spare`` blocks of 64 bits: every shingle flips one
   bit of one block. The Hamming distance of two sketches is at most the symmetric difference of the
   sets, so linked sets differ in at most d blocks and agree in ``spare`` + 1 or more: blocks are
   joined by their value, the XOR of their shingles' hashes (pigeonhole). Empty blocks, which
   unrelated sets share, aren't joined unless a set has more than ``spare`` of them. Where d is 1, one
   of two linked sets has one shingle more: such sets are joined by the XOR of all their shingles and
   of all but one. A set near its band's upper end also has a sketch in the next band's layout.
3. Blocks travel packed, many to a row. What one batch of texts shares is folded before the shuffle:
   a bucket gets one entry per batch of a value that a batch has many times, and the members beside it
   are dealt by node. What remains are the (value, node) rows of values with two nodes or more.
4. A node that shares fewer blocks with others than linked sets must is dropped, and with it values
   that only one node has then, until few go: what chance and common passages share is gone before
   any text or sketch moves.
5. Links are looked for in three rounds, each verified on the full shingle sets. First every node is
   compared with one centre: of the nodes that it shares blocks with, one that shares most with
   others (the original of a family, as a rule). Then, within values whose nodes aren't one component
   yet, all pairs of different components are compared by sketch: pair by pair for values with few
   nodes, where a pair must agree in as many blocks as linked sets must, in tiles of ``TILE`` nodes
   for those with many. Of these a node leaves out its most crowded ones, one less than linked sets
   share at least, so these still meet. A tile reports the pairs of nodes that are near few others,
   and a spanning forest of the rest; the third round reports every pair that is still apart, of the
   values where a pair of such a forest wasn't a link. So no pair of linked sets stays untested unless
   its ends are connected already: no link between components is lost, and no group's pairs are ever
   listed in full.

Node ids and shingles are 64-bit hashes: two different sets meet with a probability of about
pairs / 2^64.

Defined results: a null or empty text, or one of white space, has an empty set and links with
nothing; a text of fewer words than a shingle is one shingle; repeated rows and equal sets are
linked; a null id takes part, but names a component only if all its ids are null; an empty table
gives an empty table; other columns are ignored by ``join`` and kept by ``first_of_each``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assetlake.llm.common import give_back, input_splits, release, small_batches, stage
from assetlake.llm.components import components
from assetlake.llm.hashing import as_bytes, mixed, runs, shingles, word_hashes

BAND = 1.3
FEW = 64
TILE = 8192
TILE_BYTES = 16 << 20  # of sketches: wider ones make tiles of fewer nodes
NEAR = 32
PRUNINGS = 4
SLICE = 1 << 20  # bytes of texts that are hashed at a time
HELD = 1 << 19  # keys that are packed at a time
KNOWN = 1 << 14  # nodes that the packer remembers
BATCH = 4 << 20  # bytes of rows that a worker is handed at a time
MET = 1 << 17  # words of sketches that a node is compared with at a time
ONE_OFF = 2  # what stands for the number of blocks where linked sets differ in one shingle at most
_LAYOUT_BITS = np.uint64(7)


def spare(most: int) -> int:
    """Blocks beyond ``most`` + 1: one more is what linked sets agree in at least."""
    return 1 + most // 8


@functools.cache
def bands(percent: int, largest: int = 1 << 40) -> list[tuple[int, int]]:
    """(largest size, blocks) of each band at a similarity of ``percent`` / 100 or more."""
    out, upper = [], 8
    while not out or out[-1][0] < largest:
        # |A ^ B| <= (100 - percent) / (100 + percent) * (|A| + |B|); where it is 0, linked sets are equal
        most = (100 - percent) * 2 * upper // (100 + percent)
        out.append((upper, most + 1 + spare(most) if most > 1 else 1 + most))
        upper = int(upper * BAND) + 1
    return out


def layouts(size: int, percent: int, table: list[tuple[int, int]]) -> list[int]:
    """The bands whose layout a set of ``size`` is sketched in."""
    own = last = next(k for k, (upper, _) in enumerate(table) if size <= upper)
    # a partner of the next band has more than this band's upper size
    while 100 * size >= percent * (table[last][0] + 1):
        last += 1
    return [k for k in range(own, last + 1) if table[k][1] > 1]


def _blocks(hashed: np.ndarray, layout: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    h = mixed(hashed + np.uint64(layout + 1))
    return h, ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def sketch(hashed: np.ndarray, layout: int, blocks: int) -> np.ndarray:
    """The parity sketch of a set: ``blocks`` words of 64 bits."""
    h, block = _blocks(hashed, layout, blocks)
    bits = np.bincount((block * np.uint64(64) + (h & np.uint64(63))).astype(np.int64), minlength=64 * blocks) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<u8")


def keys_of(hashed: np.ndarray, layout: int, blocks: int) -> np.ndarray:
    """What a set's blocks are joined by, the layout in the lowest bits."""
    mark = np.uint64(layout)
    if blocks == ONE_OFF:
        h = mixed(hashed + np.uint64(layout + 1))
        every = np.bitwise_xor.reduce(h)
        return (mixed(np.append(every ^ h, every)) << _LAYOUT_BITS) | mark
    h, block = _blocks(hashed, layout, blocks)
    order = np.argsort(block, kind="stable")
    load = np.bincount(block.astype(np.int64), minlength=blocks)
    value = np.zeros(blocks, np.uint64)
    value[load > 0] = np.bitwise_xor.reduceat(mixed(h[order]), (np.cumsum(load) - load)[load > 0])
    place = np.arange(blocks, dtype=np.uint64) * np.uint64(128) + mark
    keys = (mixed(value + mixed(place + np.uint64(77))) << _LAYOUT_BITS) | mark
    return keys[load > 0] if (load == 0).sum() <= _spare_of(blocks) else keys


def least_shared(hashed: np.ndarray, layout: int, blocks: int) -> int:
    """How many of its keys a set shares with a linked one at least.

    Linked sets agree in spare + 1 blocks, and the set's empty ones are among these at most. Where
    these were joined too, a partner may have left out its own.
    """
    if blocks == ONE_OFF:
        return 1
    empty = blocks - int(np.count_nonzero(np.bincount(_blocks(hashed, layout, blocks)[1].astype(np.int64), minlength=blocks)))
    return max(1, _spare_of(blocks) + 1 - empty)


@functools.cache
def _spare_of(blocks: int) -> int:
    return next(spare(m) for m in range(blocks) if m + 1 + spare(m) == blocks)


_FACTS = "doc_id long, hashed long, size long, node long, needs array<int>"
_PACKED = "bucket int, side boolean, keys binary, nodes binary"


def _eased(run):
    """The step, before and after which its worker gives back what is kept for reuse: by earlier steps, and by this one."""
    def eased(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()

    return eased


def _eased_group(run):
    """The same for a step of one group at a time; small groups leave little to give back."""
    def eased(t: pa.Table) -> pa.Table:
        out = run(t)
        if t.nbytes > SLICE:
            give_back()
        return out

    return eased


def _sets(batch: pa.RecordBatch, n: int, column: str = "text") -> Iterator[tuple[np.ndarray, int | None]]:
    """Each text's set and node, some texts at a time."""
    texts = batch.column(column)
    size = max(1, SLICE * batch.num_rows // max(1, texts.nbytes))
    for start in range(0, batch.num_rows, size):
        for words in word_hashes(as_bytes(texts.slice(start, size))):
            s = shingles(words, n)
            node = int(mixed(np.array([s.sum(dtype=np.uint64) ^ np.bitwise_xor.reduce(mixed(s))]) + np.uint64(len(s))).view(np.int64)[0]) if len(s) else None
            yield s, node


def _facts(n: int, percent: int):
    """Rows of _FACTS; ``needs`` holds layout, least shared blocks, layout, .. of the set's layouts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bands(percent)
        for batch in batches:
            sizes, nodes, needs = [], [], []
            for s, node in _sets(batch, n):
                sizes.append(len(s))
                nodes.append(node)
                needs.append([x for k in layouts(len(s), percent, table) for x in (k, least_shared(s, k, table[k][1]))] if node is not None else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hashed"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(needs, pa.list_(pa.int32()))],
                names=["doc_id", "hashed", "size", "node", "needs"])

    return run


def _packed(k: np.ndarray, o: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row a bucket and side of the keys ``k`` and nodes ``o`` of some sets; the rows are views of two arrays."""
    order = np.argsort(k, kind="stable")
    k, o = k[order], o[order]
    first, length = runs(k)
    many, once = np.repeat(length > 1, length), np.zeros(len(k), bool)
    once[first] = True
    del order, first, length
    # members of a value that these sets repeat need no meeting: they are dealt by node
    for side in (True, False):
        pick = many if side else once
        kk, oo = k[pick], o[pick]
        if not len(kk):
            continue
        dealt = (mixed(oo.view(np.uint64) if side else kk) % np.uint64(buckets)).astype(np.int32)
        by = np.argsort(dealt, kind="stable")
        kk, oo, dealt = kk[by], oo[by], dealt[by]
        at, _ = runs(dealt)
        ends = pa.py_buffer((np.append(at, len(kk)) * 8).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(dealt[at]), pa.array(np.full(len(at), side))]
            + [pa.Array.from_buffers(pa.binary(), len(at), [None, ends, pa.py_buffer(x)]) for x in (kk, oo)],
            names=["bucket", "side", "keys", "nodes"])


def _flat(column: pa.ChunkedArray, kind) -> np.ndarray:
    """All values of a binary column as one array of numbers, with one copy at most."""
    c = pa.concat_arrays(column.cast(pa.large_binary()).chunks or [pa.array([], pa.large_binary())])
    if not len(c):
        return np.zeros(0, kind)
    ends = np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1]
    return np.frombuffer(c.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind)


def _packer(n: int, percent: int, buckets: int):
    """Rows of _PACKED: the keys of a task's sets, ``HELD`` at a time whatever the batches, by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bands(percent)
        keys, owners = np.empty(HELD, np.uint64), np.empty(HELD, np.int64)
        held, seen = 0, set()
        for batch in batches:
            for s, node in _sets(batch, n):
                if node is None or node in seen:
                    continue
                if len(seen) >= KNOWN:
                    seen.clear()
                seen.add(node)
                for layout in layouts(len(s), percent, table):
                    own = keys_of(s, layout, table[layout][1])
                    for start in range(0, len(own), HELD):
                        part = own[start:start + HELD]
                        if held + len(part) > HELD:
                            yield from _packed(keys[:held], owners[:held], buckets)
                            held = 0
                        keys[held:held + len(part)] = part
                        owners[held:held + len(part)] = node
                        held += len(part)
        if held:
            yield from _packed(keys[:held], owners[:held], buckets)

    return run


def _shared(t: pa.Table) -> pa.Table:
    """(key, node) of the keys that two entries of a bucket have, and all entries that were folded."""
    def all_of(side: bool, name: str, kind) -> np.ndarray:
        return _flat(t.column(name).filter(pc.equal(t.column("side"), side)), kind)

    pa.default_memory_pool().release_unused()
    key, node = all_of(False, "keys", np.uint64), all_of(False, "nodes", np.int64)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    once = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])] if len(key) else np.zeros(0, bool)
    key, node = key[once], node[once]
    _, length = runs(key)
    many = np.repeat(length > 1, length)
    key = np.concatenate([key[many], all_of(True, "keys", np.uint64)]).view(np.int64)
    node = np.concatenate([node[many], all_of(True, "nodes", np.int64)])
    return pa.table({"key": key, "node": node})


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for (x, _), (y, _) in zip(_sets(batch, n, "text_a"), _sets(batch, n, "text_b")):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common) and len(x) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(_eased(verify), "a long, b long")


def _sketches(texts: DataFrame, n: int, percent: int) -> DataFrame:
    table = bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, (s, _) in zip(batch.column("node").to_pylist(), _sets(batch, n)):
                rows += [(node, k, len(s), sketch(s, k, table[k][1]).tobytes()) for k in layouts(len(s), percent, table)] if len(s) else []
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())],
                names=["node", "layout", "size", "sketch"])

    return texts.select("node", "text").mapInArrow(_eased(run), "node long, layout int, size long, sketch binary")


def _slack(left: np.ndarray, right: np.ndarray, size_l: np.ndarray, size_r: np.ndarray, percent: int) -> np.ndarray:
    """How near sketches (a row each) are, below 0 where they can't belong to linked sets: pairwise over leading axes that broadcast."""
    apart = np.bitwise_count(left ^ right).sum(-1, dtype=np.int64)
    return (100 - percent) * (size_l + size_r) - (100 + percent) * apart


def _tile(percent: int, forest: bool):
    """Pairs of a tile that may be linked: nodes of chunk i beside the main component with the nodes of chunk j.

    As a forest, a node with more than ``NEAR`` of them reports those that join its tile's trees, the
    nearest first; ``rest`` marks the pairs of trees of which pairs are left out.
    """
    def run(t: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        order = np.argsort(t.column("node").to_numpy())
        node, part, size, lesser, row, column = (t.column(c).to_numpy()[order] for c in ("node", "component", "size", "lesser", "row", "column"))
        bits = _flat(t.column("sketch"), "<u8").reshape(len(node), -1)
        key, i, j = (t.column(c)[0].as_py() for c in ("key", "i", "j"))
        left, right = np.flatnonzero(row == i), np.flatnonzero(column == j)
        left = left[lesser[left]]
        parts = np.split(right, np.arange(0, len(right), max(1, MET // max(1, bits.shape[1])))[1:])
        parent = {c: c for c in part.tolist()}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        out, cut = [], set()
        for x in left:  # a row of the tile at a time: TILE comparisons
            slack = np.concatenate([_slack(bits[order[x]], bits[order[y]], size[x], size[y], percent) for y in parts])
            # two nodes beside the main component meet in either's tile
            near = (slack >= 0) & (part[right] != part[x]) & ((right > x) | ~lesser[right])
            some = forest and np.count_nonzero(near) > NEAR
            near = np.flatnonzero(near)
            for y in right[near[np.argsort(-slack[near], kind="stable")] if some else near]:
                p, q = root(part[x].item()), root(part[y].item())
                if some and p == q:
                    cut.add(p)
                    continue
                parent[p] = q
                out.append((x, y))
        cut = {root(c) for c in cut}
        rest = [root(part[x].item()) in cut for x, _ in out]
        ends = [pa.array(node[[pair[k] for pair in out]] if out else [], pa.int64()) for k in (0, 1)]
        return pa.table({"key": pa.array([key] * len(out), pa.int64()), "a": ends[0], "b": ends[1], "rest": pa.array(rest, pa.bool_())})

    return run


def _layout_of(key: str = "key"):
    return F.col(key).bitwiseAND(int(2 ** int(_LAYOUT_BITS) - 1)).cast("int")


def _pruned(shared: DataFrame, needs: DataFrame) -> DataFrame:
    """(key, node) rows of the nodes that share as many blocks of a layout as linked sets must, and of keys with two of them.

    Dropping rows may take others below their need, so it goes on while a tenth or more of the rows
    go, ``PRUNINGS`` times at most; stopping early only leaves more to compare.
    """
    shared = shared.withColumn("layout", _layout_of())
    before = shared.count()
    for _ in range(PRUNINGS):
        enough = (shared.groupBy("node", "layout").agg(F.count(F.lit(1)).alias("n")).join(needs, ["node", "layout"])
                  .where("n >= need").select("node", "layout"))
        kept = shared.join(enough, ["node", "layout"], "left_semi")
        twice = kept.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        shared = stage(kept.join(twice, "key", "left_semi"), "join-pruned")
        release(shared.sparkSession)
        after = shared.count()
        if after > 0.9 * before:
            break
        before = after
    return shared


def links(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, size, node), (nodes: node, component) of linked nodes."""
    with small_batches(docs.sparkSession, BATCH):  # all steps in Python are run and written here
        return _links(docs, n, percent)


def _links(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    hashed = F.xxhash64(F.col("text"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = 2 * input_splits(d)
    info = stage(d.withColumn("hashed", hashed).mapInArrow(_eased(_facts(n, percent)), _FACTS), "join-facts")
    # the keys are made anew from the texts rather than written twice: to a table and to the shuffle
    packed = d.select("text").mapInArrow(_eased(_packer(n, percent, buckets)), _PACKED)
    shared = stage(packed.groupBy("bucket").applyInArrow(_eased_group(_shared), "key long, node long").distinct(), "join-shared")
    release(info.sparkSession)
    each = info.where("node IS NOT NULL").groupBy("node").agg(F.first("needs").alias("needs"))  # the same in all copies
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.size("needs") - 2, F.lit(0)), F.lit(2)), lambda i: F.struct(
        F.get("needs", i).alias("layout"), F.get("needs", i + 1).alias("need")))
    needs = each.where(F.size("needs") > 0).select("node", F.explode(pairs).alias("x")).select("node", "x.layout", "x.need")
    shared = _pruned(shared, needs)

    # texts of the nodes that share enough blocks, one each
    one = (info.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("hashed", "doc_id")).alias("x"))
           .join(shared.select("node").distinct(), "node", "left_semi").select("node", F.col("x.hashed").alias("h"), F.col("x.doc_id").alias("i")))
    texts = stage(d.join(one, (F.xxhash64("text") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("i"))).select("node", "text")
                  .dropDuplicates(["node"]), "join-texts")
    release(info.sparkSession)

    # round 1: each node against one centre
    degree = shared.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    centre = (shared.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", "node")).alias("x"))
              .select("key", F.col("x.node").alias("centre")))
    best = (shared.join(centre, "key").where(F.col("node") != F.col("centre")).groupBy("node", "centre").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("node").agg(F.max(F.struct("n", "centre")).alias("x")))
    found = stage(_verified(best.select(F.col("node").alias("a"), F.col("x.centre").alias("b")), texts, n, percent), "join-links")
    release(info.sparkSession)

    parts = components(found, "a", "b")
    apart = stage(_open(shared.join(parts, "node", "left").select("key", "node", "layout", F.coalesce("component", "node").alias("component"))), "join-apart")
    if apart.isEmpty():
        return info, parts
    release(info.sparkSession)
    sketches = stage(_sketches(texts.join(apart.select("node").distinct(), "node", "left_semi"), n, percent), "join-sketches")
    # written before its keys are counted, which would make all its rows a second time
    prefixes = stage(_prefixes(apart.where(F.col("members") > FEW), needs), "join-prefixes")
    crowded = stage(_open(prefixes), "join-crowded")
    few = _from_pairs(apart, needs, sketches, percent).select(F.lit(None).cast("long").alias("key"), "a", "b", F.lit(False).alias("rest"))
    tried = stage(_from_tiles(crowded, sketches, percent, forest=True).unionAll(few), "join-candidates")
    release(info.sparkSession)
    pairs = tried.select("a", "b").distinct()
    linked = stage(_verified(pairs, texts, n, percent), "join-links")
    release(info.sparkSession)
    found = found.unionAll(linked)
    parts = components(found, "a", "b")

    # a tree of links joins its near nodes: values are left where a pair of a tree wasn't a link and others weren't told
    failed = tried.where("rest").join(linked, ["a", "b"], "left_anti").select("key").distinct()
    again = (crowded.select("key", "node", "layout").join(failed, "key", "left_semi").join(parts, "node", "left")
             .select("key", "node", "layout", F.coalesce("component", "node").alias("component")))
    again = stage(_open(again), "join-again")
    if again.isEmpty():
        return info, parts
    release(info.sparkSession)
    new = stage(_from_tiles(again, sketches, percent, forest=False).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"), "join-candidates")
    release(info.sparkSession)
    found = found.unionAll(stage(_verified(new, texts, n, percent), "join-links"))
    release(info.sparkSession)
    return info, components(found, "a", "b")


def _open(rows: DataFrame) -> DataFrame:
    """The rows of keys whose nodes aren't one component yet, with the number of a key's rows."""
    keys = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("members")).where("x < y")
    return rows.drop("members").join(keys.select("key", "members"), "key")


def _prefixes(crowded: DataFrame, needs: DataFrame) -> DataFrame:
    """The rows without those of each node's most crowded keys of a layout, one less than linked sets share at least.

    All nodes leave out by one order. Of the keys that two linked sets share, the least crowded has as
    many behind it as either needs, less one: neither leaves that one out, so they still meet.
    """
    own = crowded.groupBy("node", "layout").agg(  # a node is of one component, and its keys are no more than its layout's blocks
        F.max("component").alias("component"), F.sort_array(F.collect_list(F.struct((-F.col("members")).alias("fewer"), "key"))).alias("keys"))
    left = F.slice("keys", F.col("need"), F.size("keys"))
    return (own.join(needs, ["node", "layout"]).select("node", "layout", "component", F.explode(left).alias("x"))
            .select("x.key", "node", "layout", "component", (-F.col("x.fewer")).alias("members")))


def _from_pairs(apart: DataFrame, needs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components under keys with few nodes that agree in enough blocks and whose sketches are near enough.

    Blocks that a pair may share under keys with many nodes, which aren't listed, count as shared.
    """
    few = apart.where(F.col("members") <= FEW)
    x, y = few.alias("x"), few.alias("y")
    pairs = (x.join(y, F.col("x.key") == F.col("y.key")).where((F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")))
             .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.layout").alias("layout")).agg(F.count(F.lit(1)).alias("agree")))
    # a pair of different components shares open keys only: those of a node that aren't among the few
    many = apart.where(F.col("members") > FEW).groupBy("node", "layout").agg(F.count(F.lit(1)).alias("many"))
    least = needs.join(many, ["node", "layout"], "left").select(F.col("node").alias("a"), "layout", (F.col("need") - F.coalesce("many", F.lit(0))).alias("least"))
    pairs = pairs.join(least, ["a", "layout"]).where("agree >= least").select("a", "b", "layout")
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("node").alias(side), "layout", F.col("size").alias(f"size_{side}"), F.col("sketch").alias(f"sketch_{side}")), [side, "layout"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b = (batch.column(f"size_{s}").to_numpy() for s in "ab")
            keep = [bool(_slack(np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8"), m, k, percent) >= 0) for p, q, m, k in zip(
                batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), size_a, size_b)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(_eased(run), "a long, b long")


def _from_tiles(crowded: DataFrame, sketches: DataFrame, percent: int, forest: bool) -> DataFrame:
    """The same under a key with many nodes: those beside its largest component with all, in tiles of TILE by TILE nodes.

    A tile of sketches that fill ``TILE_BYTES`` sooner has fewer. Where these are no more than a tile's, a key's rows are no more than twice its nodes, however many these are.
    """
    main = (crowded.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("key").agg(F.max(F.struct("n", F.col("component").alias("main"))).alias("x")).select("key", "x.n", "x.main"))
    # a tile's memory doesn't follow the texts' length
    most = F.get(F.array(*[F.lit(max(1, min(TILE, TILE_BYTES // (8 * blocks)))) for _, blocks in bands(percent)]), F.col("layout"))
    rows, columns = (F.greatest(F.ceil(x / most), F.lit(1)).cast("int") for x in (F.col("members") - F.col("n"), F.col("members")))
    dealt = crowded.join(main, "key").withColumn("lesser", F.col("component") != F.col("main")).withColumn("rows", rows).withColumn("columns", columns)
    for own, of in (("row", "rows"), ("column", "columns")):
        dealt = dealt.withColumn(own, F.pmod(F.xxhash64("node"), F.col(of)).cast("int"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda k: F.struct(k.alias("i"), F.col("column").alias("j")))
    across = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda k: F.struct(F.col("row").alias("i"), k.alias("j")))
    spread = (dealt.withColumn("tile", F.explode(F.when(F.col("lesser"), F.array_union(tiles, across)).otherwise(tiles)))
              .join(sketches, ["node", "layout"])
              .select("key", F.col("tile.i").alias("i"), F.col("tile.j").alias("j"), "row", "column", "lesser", "node", "component", "size", "sketch"))
    return spread.groupBy("key", "i", "j").applyInArrow(_eased_group(_tile(percent, forest)), "key long, a long, b long, rest boolean")


def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    info, parts = links(docs, n, percent)
    placed = info.join(parts, "node", "left").withColumn("group", F.coalesce("component", "node"))
    least = placed.where("group IS NOT NULL").groupBy(F.col("group").alias("g")).agg(F.min("doc_id").alias("least"))
    return (placed.join(least, F.col("group") == F.col("g"), "left")
            .select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")))


def first_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near duplicates: of each component the row of the least id stays.

    Rows that share that id are told apart by their text's hash, and equal rows are one. Documents
    with an empty set all stay.
    """
    info, parts = links(docs, n, percent)
    placed = info.join(parts, "node", "left").withColumn("group", F.coalesce("component", "node"))
    # null ids last
    key: Column = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("i"), F.col("hashed").alias("h"))
    chosen = placed.where("group IS NOT NULL").groupBy("group").agg(F.min(key).alias("x")).select("x.i", "x.h")
    whole = docs.select(F.struct("*").alias("d"), F.col("doc_id").cast("long").alias("i"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    empties = placed.where("group IS NULL").select(F.col("doc_id").alias("i"), F.col("hashed").alias("h")).distinct()
    stays = chosen.withColumn("one", F.lit(True)).unionAll(empties.withColumn("one", F.lit(False)))
    stays = stays.select(F.col("i").alias("si"), F.col("h").alias("sh"), "one")
    kept = whole.join(stays, F.col("i").eqNullSafe(F.col("si")) & (F.col("h") == F.col("sh")))
    first = F.row_number().over(Window.partitionBy("i", "h").orderBy("h"))
    return kept.withColumn("nth", first).where(~F.col("one") | (F.col("nth") == 1)).select("d.*")
