import math

from pyspark.sql import functions as F

from assetlake.operators import split as S
from assetlake.operators.rank import dense_ids, first_k, unit_hash
from conftest import SF01


def test_first_k_exact_with_ties(spark):
    df = spark.range(0, 5000).withColumn("u", (F.col("id") % 97) / F.lit(97.0))
    for k in (0, 1, 37, 2500, 4999, 5000, 7000):
        got = first_k(df, "u", ["id"], k, "in").filter("in").count()
        assert got == min(k, 5000)
    # the selected rows are exactly the k smallest by (u, id)
    k = 1234
    sel = {r.id for r in first_k(df, "u", ["id"], k, "in").filter("in").select("id").collect()}
    want = {r.id for r in df.orderBy("u", "id").limit(k).select("id").collect()}
    assert sel == want


def test_first_k_hot_copies(spark):
    # a third of all rows are copies of one key; the boundary falls inside it
    hot = spark.range(0, 3000).select(F.lit(0.5).alias("u"), F.lit(-1).cast("bigint").alias("id"))
    rest = spark.range(0, 6000).select((F.col("id") / 6000.0).alias("u"), F.col("id"))
    df = rest.unionByName(hot).repartition(6)
    k = 3000 + 1000  # rows below 0.5: 3000 of the rest, then 1000 copies
    out = first_k(df, "u", ["id"], k, "in")
    assert out.filter("in").count() == k
    assert out.filter("in AND id = -1").count() == k - 3000


def test_dense_ids(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "c", "a", None, "b"]], "name string")
    got = {r.name: r.id for r in dense_ids(df, "name", partitions=3).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_split_hash_stable_under_repartition(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    a = {r.doc_id: r.dataset_split for r in S.split_hash(docs, "doc_id").collect()}
    b = {r.doc_id: r.dataset_split for r in S.split_hash(docs.repartition(7), "doc_id").collect()}
    assert a == b
    n = len(a)
    share = sum(1 for v in a.values() if v == "train") / n
    assert 0.65 < share < 0.75


def test_split_thresholds(spark):
    df = spark.createDataFrame([(0.69999,), (0.70,), (0.8499,), (0.85,), (0.0,)], "u double")
    got = [r.s for r in df.select(S.split_label(F.col("u")).alias("s")).collect()]
    assert got == ["train", "validation", "validation", "test", "train"]


def test_exact_and_stratified(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    n = docs.count()
    ex = S.train_test_exact(docs, "doc_id", 0.2)
    assert ex.filter("split = 'test'").count() == math.ceil(0.2 * n)
    st = S.split_stratified(docs, "lang", "doc_id")
    per = {(r.lang, r.dataset_split): r["count"] for r in st.groupBy("lang", "dataset_split").count().collect()}
    for lang in {k[0] for k in per}:
        tot = sum(v for (l, _), v in per.items() if l == lang)
        assert abs(per.get((lang, "train"), 0) - 0.7 * tot) <= 1.5


def test_sample_n_repeatable(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    a = [r.doc_id for r in S.sample_n(docs, "doc_id", 50).collect()]
    b = [r.doc_id for r in S.sample_n(docs.repartition(5), "doc_id", 50).collect()]
    assert len(a) == 50 and sorted(a) == sorted(b)


def test_unit_hash_range(spark):
    r = spark.range(0, 2000).select(unit_hash(42, "id").alias("u")).agg(F.min("u"), F.max("u")).first()
    assert 0.0 <= r[0] and r[1] < 1.0


def test_stratified_copies_share_split(spark):
    base = spark.range(0, 3000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("string").alias("c"))
    hot = spark.range(0, 1500).select(F.lit("7").alias("id"), F.lit("1").alias("c"))
    df = base.unionByName(hot).repartition(5)
    out = S.split_stratified(df, "c", "id")
    assert out.count() == 4500
    assert out.filter("id = '7'").select("dataset_split").distinct().count() == 1
    per = {r.c: r["count"] for r in out.filter("dataset_split = 'train'").groupBy("c").count().collect()}
    assert abs(per["0"] - 700) <= 1 and abs(per["2"] - 700) <= 1


def test_null_ids_hash_and_rank(spark):
    df = spark.createDataFrame([(None,), ("a",), (None,), ("b",)], "id string")
    u = [r.u for r in df.select(unit_hash(42, "id").alias("u")).collect()]
    assert all(x is not None for x in u) and u[0] == u[2]
    out = first_k(df.withColumn("u", unit_hash(42, "id")), "u", ["id"], 3, "in")
    assert out.filter("in").count() == 3


def test_row_index_contiguous(spark):
    from assetlake.operators.rank import row_index
    df = spark.range(0, 5000).repartition(7).select((F.col("id") * 3).alias("v"))
    out = row_index(df, "idx")
    got = sorted(r.idx for r in out.select("idx").collect())
    assert got == list(range(5000))
    assert out.select("v").distinct().count() == 5000


def test_split_stratified_keeps_rows_without_a_class(spark):
    from assetlake.operators.split import split_stratified
    rows = [(i, None if i % 4 == 0 else f"c{i % 3}") for i in range(40)] + [(None, None)]
    out = split_stratified(spark.createDataFrame(rows, "id long, cls string"), "cls", "id").collect()
    assert len(out) == 41 and all(r.dataset_split is not None for r in out)
