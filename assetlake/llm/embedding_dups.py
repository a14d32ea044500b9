"""Embedding near-duplicates by tiled comparison in PCA order.

Vectors are normalised and turned onto the principal axes of a bounded sample (``SAMPLE`` rows by
hash order): most of a product is then in the leading dimensions. A k-d tree over the leading axes,
with cuts from the same sample, cuts space into leaves. Two unit vectors with cosine c are
sqrt(2 - 2 c) apart, so a vector meets its own leaf and those leaves whose box is that near; of two
leaves, the vectors of the lower one visit the higher one. Leaves and visitors are cut into chunks of
``LEAF`` rows, so that no task holds more than two chunks however crowded a leaf is.

In a tile, products accumulate over blocks of dimensions; after each block the rest is bounded by the
product of the suffix norms, and pairs that can't reach the threshold any more are left. The sample
only decides how early that is: every pair at or above the threshold is found. Products within
``CLOSE`` of the threshold are computed again from the vectors as given.

Equal vectors are one class with a count before anything is compared; links count all their rows. A
tile returns a count for each vector and a spanning forest of its links, never the pairs themselves.

Defined results: null, empty and zero vectors and those with a null or non-finite component link with
nothing; vectors of different lengths link with nothing between them; a null id takes part, but
names a component only if all its ids are null; repeated rows are linked; an empty table gives an
empty table; labels and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import stage
from assetlake.llm.components import components

SAMPLE = 20_000
LEAF = 4096
LEADING = 16
CLOSE = 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column as a matrix, padded with zeros to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes]) if len(sizes) else []] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    # by the largest component first: squares of very large or small ones leave the range
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _tree(x: np.ndarray, leaves: int) -> list | int:
    """Nested (axis, cut, below, above) over a sample; leaves are numbered from left to right."""
    number = iter(range(1 << 30))

    def grow(rows: np.ndarray, want: int):
        if want <= 1 or len(rows) < 4:
            return next(number)
        lead = x[rows, :LEADING]
        axis = int(lead.var(0).argmax())
        cut = float(np.quantile(lead[:, axis], (want // 2) / want))
        low = lead[:, axis] <= cut
        if low.all() or not low.any():
            return next(number)
        return axis, cut, grow(rows[low], want // 2), grow(rows[~low], want - want // 2)

    return grow(np.arange(len(x)), leaves)


def _visits(tree, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, home) of the home leaf of each row and of the higher leaves within ``reach``."""
    rows, leaves, homes = [], [], []

    def walk(node, at, home, gap):
        if not len(at):
            return
        if not isinstance(node, tuple):
            rows.append(at)
            leaves.append(np.full(len(at), node))
            homes.append(home)
            return
        axis, cut, below, above = node
        value = x[at, axis]
        low = value <= cut
        walk(below, at[low & home], home[low & home], gap[low & home])
        # a visitor comes from a lower leaf: it goes where its box distance allows
        for side, inside in ((below, low), (above, ~low)):
            visit = ~home
            g = gap[visit].copy()
            g[:, axis] = np.where(inside[visit], g[:, axis], np.maximum(g[:, axis], np.abs(value[visit] - cut)))
            near = (g * g).sum(1) <= reach * reach
            walk(side, at[visit][near], home[visit][near], g[near])
        walk(above, at[~low & home], home[~low & home], gap[~low & home])
        go = low & home  # homes below may have partners above
        g = gap[go].copy()
        g[:, axis] = np.maximum(g[:, axis], np.abs(value[go] - cut))
        near = (g * g).sum(1) <= reach * reach
        walk(above, at[go][near], np.zeros(near.sum(), bool), g[near])

    n = len(x)
    walk(tree, np.arange(n), np.ones(n, bool), np.zeros((n, min(LEADING, x.shape[1]))))
    return tuple(np.concatenate(c) if c else np.zeros(0, int) for c in (rows, leaves, homes))


def _linked(left: np.ndarray, right: np.ndarray, raw_l: np.ndarray, raw_r: np.ndarray, at_least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of the pairs of rows with cosine >= ``at_least``, some rows of ``left`` at a time."""
    width = left.shape[1]
    stops = sorted({max(1, width // 4), max(1, width // 2), width})
    rest_l = [np.sqrt((left[:, s:] ** 2).sum(1)) for s in stops]
    rest_r = [np.sqrt((right[:, s:] ** 2).sum(1)) for s in stops]
    for a in range(0, len(left), 256):
        b = min(len(left), a + 256)
        product = left[a:b, :stops[0]] @ right[:, :stops[0]].T
        i, j = np.nonzero(product + rest_l[0][a:b, None] * rest_r[0][None, :] >= at_least - CLOSE)
        value = product[i, j]
        i = i + a
        for k in range(1, len(stops)):
            part = np.empty(len(i))
            for c in range(0, len(i), 1 << 16):  # a bounded number of pairs at a time
                s = slice(c, c + (1 << 16))
                part[s] = np.einsum("ij,ij->i", left[i[s], stops[k - 1]:stops[k]], right[j[s], stops[k - 1]:stops[k]])
            value = value + part
            stay = value + rest_l[k][i] * rest_r[k][j] >= at_least - CLOSE
            i, j, value = i[stay], j[stay], value[stay]
        for p in np.flatnonzero(np.abs(value - at_least) <= CLOSE):
            u, v = raw_l[i[p]], raw_r[j[p]]
            value[p] = float(u @ v) / (float(np.sqrt(u @ u)) * float(np.sqrt(v @ v)))
        hit = value >= at_least
        yield i[hit], j[hit]


def _compare(axes: np.ndarray, at_least: float):
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        node, many, home, chunk = (t.column(c).to_numpy() for c in ("node", "many", "home", "chunk"))
        raw = _matrix(t.column("vector").chunk(0), len(axes))
        x = _unit(raw) @ axes
        i, j, visited = t.column("i")[0].as_py(), t.column("j")[0].as_py(), t.column("visited")[0].as_py()
        left = np.flatnonzero(home & (chunk == i))
        right = np.flatnonzero(~home & (chunk == j)) if visited else np.flatnonzero(home & (chunk == j))
        links = np.zeros(len(node), np.int64)
        parent = np.arange(len(node))

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        edges = []
        for p, q in _linked(x[left], x[right], raw[left], raw[right], at_least):
            p, q = left[p], right[q]
            if not visited and i == j:
                once = p < q
                p, q = p[once], q[once]
            np.add.at(links, p, many[q])
            np.add.at(links, q, many[p])
            for u, v in zip(p.tolist(), q.tolist()):
                ru, rv = root(u), root(v)
                if ru != rv:
                    parent[ru] = rv
                    edges.append((u, v))
        some = np.flatnonzero(links)
        u, v = np.array(edges, int).reshape(-1, 2).T
        return pa.table({"a": pa.array(np.r_[node[some], node[u]], pa.int64()),
                         "b": pa.array([None] * len(some) + node[v].tolist(), pa.int64()),
                         "links": pa.array(links[some].tolist() + [None] * len(u), pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, at_least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    d = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.coalesce((F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    d = d.select("vec_id", F.when(fine, F.col("v")).alias("vector")).withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    classes = stage(d.where("vector IS NOT NULL").groupBy("vector", "node").agg(F.count(F.lit(1)).alias("many")), "embed-classes")
    n, width = classes.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    ids = d.select("vec_id", "node")
    if not n:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sample = [r["vector"] for r in classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").collect()]
    x = np.zeros((len(sample), width))
    for row, v in zip(x, sample):
        row[:len(v)] = v
    x = _unit(x)
    values, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1].copy()
    tree = _tree(x @ axes, min(-(-n // LEAF), max(1, len(x) // 16)))
    reach = float(np.sqrt(max(0.0, 2 - 2 * at_least)) + 1e-6)
    kind = classes.schema["vector"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column("vector")
            if not len(vector):
                continue
            rows, leaf, home = _visits(tree, _unit(_matrix(vector, width)) @ axes, reach)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int32()), pa.array(home.astype(bool)), pa.array(np.diff(vector.offsets.to_numpy())[rows], pa.int32()),
                 batch.column("node").take(take), batch.column("many").take(take), vector.take(take)],
                names=["leaf", "home", "width", "node", "many", "vector"])

    placed = stage(classes.select("node", "many", "vector").mapInArrow(
        place, f"leaf int, home boolean, width int, node long, many long, vector {kind}"), "embed-placed")
    crowd = placed.groupBy("leaf", "width").agg(
        F.ceil(F.count_if("home") / LEAF).cast("int").alias("own"), F.ceil(F.count_if(~F.col("home")) / LEAF).cast("int").alias("guests"))
    tiled = placed.join(crowd, ["leaf", "width"]).where("own > 0")
    tiled = tiled.withColumn("chunk", F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("own")).otherwise(F.col("guests"))).cast("int"))

    def tile(visited, i, j):
        return F.struct(F.lit(visited).alias("visited"), i.cast("int").alias("i"), j.cast("int").alias("j"))

    chunk = F.col("chunk")
    own = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda o: tile(False, F.least(chunk, o), F.greatest(chunk, o)))
    hosts = F.when(F.col("guests") > 0, F.transform(F.sequence(F.lit(0), F.col("guests") - 1), lambda o: tile(True, chunk, o)))
    goes = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda o: tile(True, o, chunk))
    tiles = F.when(F.col("home"), F.concat(own, F.coalesce(hosts, F.array().cast("array<struct<visited:boolean,i:int,j:int>>")))).otherwise(goes)
    found = stage(tiled.withColumn("t", F.explode(tiles)).select("leaf", "width", "t.*", "chunk", "home", "node", "many", "vector")
                  .groupBy("leaf", "width", "visited", "i", "j").applyInArrow(_compare(axes, at_least), "a long, b long, links long"), "embed-links")
    linked = found.where("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = components(found.where("b IS NOT NULL"), "a", "b")
    per_node = (classes.select("node", "many").join(linked, "node", "left").join(parts, "node", "left")
                .select(F.col("node").alias("at"), (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"), F.coalesce("component", "node").alias("group")))
    out = ids.join(per_node, F.col("node") == F.col("at"), "left")
    least = out.where("group IS NOT NULL").groupBy(F.col("group").alias("g")).agg(F.min("vec_id").alias("least"))
    out = out.join(least, F.col("group") == F.col("g"), "left")
    component = F.when(F.col("group").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
