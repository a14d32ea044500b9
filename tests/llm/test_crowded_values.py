"""Near duplicates under block values that many nodes share."""

import itertools
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assetlake.llm import ngram_join
from test_pipeline import linked_by_force


def family(seed, count=70, size=150):
    """Texts that drift from one, so that many are near, and some links hang on others."""
    rng = np.random.default_rng(seed)
    made = [[f"v{x}" for x in rng.integers(0, 5000, size)]]
    for k in range(count):
        w = list(made[rng.integers(0, len(made))] if k % 3 else made[0])
        for i in rng.integers(0, size, rng.integers(1, 7)):
            w[i] = f"z{rng.integers(0, 9999)}"
        made.append(w)
    return [" ".join(w) for w in made]


@pytest.mark.parametrize("tile,near", [(8192, 32), (7, 1), (20, 3)])
def test_crowded_values_match_brute_force(spark, monkeypatch, tile, near):
    for name, value in (("FEW", 2), ("TILE", tile), ("NEAR", near)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = list(enumerate(family(1) + family(2, 25, 60)))
    # a node in the middle of none: only those linked to the centre are one component before the tiles
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, group = linked_by_force(rows)
    want = {i: min(j for j, g in enumerate(group) if g == group[i]) for i, _ in rows}
    assert {r.doc_id: r.component_id for r in ngram_join.join(docs, 5, 80).collect()} == want
    assert 1 < len(set(want.values())) < len(rows)


def test_prefixes_leave_a_key_to_each_pair(spark):
    rng = np.random.default_rng(3)
    members = {k: int(m) for k, m in enumerate(rng.integers(65, 90, 60))}
    own = {n: set(rng.choice(60, rng.integers(4, 40), replace=False).tolist()) for n in range(60)}
    need = {n: int(rng.integers(1, 9)) for n in own}
    rows = spark.createDataFrame([(k, n, 3, n, members[k]) for n, ks in own.items() for k in ks], "key long, node long, layout int, component long, members long")
    needs = spark.createDataFrame([(n, 3, x) for n, x in need.items()], "node long, layout int, need int")
    left = {n: set() for n in own}
    for r in ngram_join._prefixes(rows, needs).collect():
        left[r.node].add(r.key)
    assert all(len(left[n]) == max(0, len(own[n]) - need[n] + 1) for n in own)
    for a, b in itertools.combinations(own, 2):
        if len(own[a] & own[b]) >= max(need[a], need[b]):
            assert left[a] & left[b], (a, b)


@pytest.mark.parametrize("nodes", [100, 400])
def test_tiles_of_a_value_grow_with_its_nodes(spark, monkeypatch, nodes):
    monkeypatch.setattr(ngram_join, "TILE", 10)

    def counted(percent, forest):
        def run(t):
            return pa.table({"key": pa.array([1]), "a": pa.array([t.num_rows]), "b": pa.array([0]), "rest": pa.array([False])})
        return run

    monkeypatch.setattr(ngram_join, "_tile", counted)
    crowded = spark.range(nodes).select(F.lit(1).cast("long").alias("key"), F.col("id").alias("node"), F.lit(2).alias("layout"),
                                        F.when(F.col("id") % 20 == 3, F.col("id")).otherwise(0).alias("component"), F.lit(nodes).cast("long").alias("members"))
    crowded = crowded.withColumn("component", F.when(F.col("node") < 100, F.col("component")).otherwise(0))
    sketches = crowded.select("node", "layout", F.lit(9).cast("long").alias("size"), F.lit(bytearray(16)).alias("sketch"))
    sizes = [r.a for r in ngram_join._from_tiles(crowded, sketches, 80, True).collect()]
    assert nodes <= sum(sizes) <= 2 * nodes


def test_packing_holds_few_times_its_keys(monkeypatch):
    buckets, held = 50, 1 << 16
    monkeypatch.setattr(ngram_join, "HELD", held)
    rng = np.random.default_rng(8)
    rows = [" ".join(f"v{x}" for x in rng.integers(0, 900, 700)) for _ in range(600)]
    rows = [r + f" w{k}" for k, r in enumerate(rows[:40])] + rows + rows[:9] + [None, "", " ".join(f"u{x}" for x in range(400_000))]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    want, table = set(), ngram_join.bands(80)
    for s, node in ngram_join._sets(batch, 5):
        for layout in ngram_join.layouts(len(s), 80, table) if node is not None else ():
            want |= {(int(k), node) for k in ngram_join.keys_of(s, layout, table[layout][1])}
    assert len(want) > 2 * held
    got, folded, most = set(), 0, 0
    for out in ngram_join._packer(5, 80, buckets)(iter([batch])):
        size = 0
        for bucket, side, keys, nodes in zip(*(c.to_pylist() for c in out.columns)):
            k, o = np.frombuffer(keys, np.uint64), np.frombuffer(nodes, np.int64)
            dealt = ngram_join.mixed(o.view(np.uint64) if side else k) % np.uint64(buckets)
            assert len(k) == len(o) and (dealt == bucket).all()
            got |= set(zip(k.tolist(), o.tolist()))
            folded += side * len(k)
            size += len(k)
        most = max(most, size)
    assert got == want
    assert folded and most <= held  # with a set's keys alone beyond what is held, too

    keys = rng.integers(0, 1 << 62, 1 << 18, dtype=np.uint64)
    owners = rng.integers(0, 1 << 62, 1 << 18)
    tracemalloc.start()
    n = sum(out.num_rows for out in ngram_join._packed(keys, owners, buckets))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == buckets and peak < 5 * (keys.nbytes + owners.nbytes)


def test_wide_sketches_make_small_tiles(spark, monkeypatch):
    nodes, layout = 300, 20
    wide = 8 * ngram_join.bands(80)[layout][1]
    monkeypatch.setattr(ngram_join, "TILE_BYTES", 40 * wide)
    monkeypatch.setattr(ngram_join, "_tile", lambda percent, forest: lambda t: pa.table(
        {"key": pa.array([1]), "a": pa.array([sum(len(x) for x in t.column("sketch").to_pylist())]), "b": pa.array([len(t)]), "rest": pa.array([False])}))
    crowded = spark.range(nodes).select(F.lit(1).cast("long").alias("key"), F.col("id").alias("node"), F.lit(layout).alias("layout"),
                                        F.col("id").alias("component"), F.lit(nodes).cast("long").alias("members"))
    sketches = crowded.select("node", "layout", F.lit(9).cast("long").alias("size"), F.lit(bytearray(wide)).alias("sketch"))
    tiles = ngram_join._from_tiles(crowded, sketches, 80, True).collect()
    # nodes are dealt by hash: some more than 40 a side
    assert len(tiles) == 64 and max(r.a for r in tiles) <= 2.8 * 40 * wide


def test_wide_sketches_match_brute_force(spark, monkeypatch):
    for name, value in (("FEW", 2), ("TILE_BYTES", 4000), ("MET", 100)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = list(enumerate(family(5) + family(6, 25, 60)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, group = linked_by_force(rows)
    want = {i: min(j for j, g in enumerate(group) if g == group[i]) for i, _ in rows}
    assert {r.doc_id: r.component_id for r in ngram_join.join(docs, 5, 80).collect()} == want


def test_prefixes_make_a_row_once(spark, monkeypatch):
    """No join on the way to the prefixes makes a row for each key of a node, and their rows are made once."""
    nodes, keys = 80, 30
    rows = spark.createDataFrame([(k, n, 3, n, 70 + k) for n in range(nodes) for k in range(keys)], "key long, node long, layout int, component long, members long")
    needs = spark.createDataFrame([(n, 3, 1 + n % 40) for n in range(nodes)], "node long, layout int, need int")
    prefixes = ngram_join._prefixes(rows, needs)
    assert prefixes.count() == sum(max(0, keys - n % 40) for n in range(nodes))
    assert {r.key for r in prefixes.where("node = 29").collect()} == {0}  # the least crowded
    plan = prefixes._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and plan.index("Generate explode") < plan.index("Join Inner") < plan.index("collect_list")

    made, stage = [], ngram_join.stage

    def staged(df, name):
        made.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(ngram_join, "FEW", 2)
    monkeypatch.setattr(ngram_join, "stage", staged)
    docs = spark.createDataFrame(list(enumerate(family(1))), "doc_id long, text string")
    ngram_join.links(docs, 5, 80)
    assert sum(plan.count("collect_list") for name, plan in made if name in ("join-prefixes", "join-crowded")) == 1
