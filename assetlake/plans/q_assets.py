"""Asset queries: medallion gold, file-name parts, ids, encoding, splits, unions.

Mapping of the driver's tables onto the asset model (see sources.tables):
documents are assets (key = source, group = lang), events are labelled
examples (key = event_type, idx = event_id).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions import columns as C
from assetlake.operators import encode as E
from assetlake.operators import split as S
from assetlake.operators.changes import snapshot_changes
from assetlake.operators.diagnose import first_k_per_group
from assetlake.operators.ingest import flag_known
from assetlake.operators.rank import first_k as exact_first_k
from assetlake.operators.rank import unit_hash
from assetlake.plans.medallion import ACCEPTED_FORMATS, bronze, documents_silver, gold
from assetlake.plans.registry import register, split_case, sql_list, uhash
from assetlake.sources.config import invert, with_positions
from assetlake.sources.tables import document_assets, read_table, union_all

# Config of the document assets (what the taxonomy/key files would hold):
# keys src0..src17 are known, src18/src19 encode to -1; 'es' is not a group.
DOC_KEYS = [f"src{i}" for i in range(18)]
DOC_GROUPS = ["de", "en", "fr"]
SEED = 42

_keys_sql = sql_list(E.sorted_names(DOC_KEYS))
_groups_sql = sql_list(E.sorted_names(DOC_GROUPS))


# ---------------------------------------------------------------- gold (flagship)

def gold_dataset(spark, d):
    silver = documents_silver(document_assets(spark, d))
    return gold(silver, DOC_KEYS, DOC_GROUPS, seed=SEED, columns=[
        "image_id", "food_type", "cuisine_category", "food_type_encoded", "cuisine_category_encoded",
        "dataset_split", "split_seed", "original_file_path", "filename", "dataset_index"])


register("gold_dataset", f"""
WITH a AS (
  SELECT doc_id, source, lang,
         '/vol/' || source || '/' || printf('%s_idx_%06d.jpg', source, doc_id) AS path
  FROM documents WHERE text IS NOT NULL
), b AS (SELECT *, regexp_extract(path, '([^/]+)$', 1) AS filename FROM a
), c AS (SELECT *, TRY_CAST(regexp_extract(filename, '_idx_(\\d+)', 1) AS BIGINT) AS dataset_index FROM b
), e AS (SELECT *, printf('%s_%06d', source, dataset_index) AS image_id FROM c
), f AS (SELECT *, {uhash(SEED, 'image_id')} AS split_seed FROM e)
SELECT image_id, source AS food_type, lang AS cuisine_category,
       CAST(coalesce(list_position({_keys_sql}, source) - 1, -1) AS INTEGER) AS food_type_encoded,
       CAST(coalesce(list_position({_groups_sql}, lang) - 1, -1) AS INTEGER) AS cuisine_category_encoded,
       {split_case('split_seed')} AS dataset_split, split_seed,
       path AS original_file_path, filename, dataset_index
FROM f
""")(gold_dataset)


# ---------------------------------------------------------------- file-name parts

def odd_paths(df):
    """Paths in six shapes (plain, nested dots + upper-case ext, no ext, junk
    index, trailing slash, empty index), chosen by doc_id."""
    s, i = F.col("source"), F.col("doc_id")
    m = i % 6
    base = F.concat(F.lit("/vol/"), s, F.lit("/"))
    return (F.when(m == 0, F.concat(base, F.format_string("%s_idx_%06d.jpg", s, i)))
            .when(m == 1, F.concat(base, F.format_string("%s.v2_idx_%06d.JPG", s, i)))
            .when(m == 2, F.concat(base, F.format_string("%s_idx_%d", s, i)))
            .when(m == 3, F.concat(base, F.format_string("%s_idx_%dx.png", s, i)))
            .when(m == 4, F.concat(base, F.lit("sub/")))
            .otherwise(F.concat(base, F.format_string("%s_idx_.jpeg", s))))


_ODD_PATH_SQL = """CASE doc_id % 6
  WHEN 0 THEN '/vol/' || source || '/' || printf('%s_idx_%06d.jpg', source, doc_id)
  WHEN 1 THEN '/vol/' || source || '/' || printf('%s.v2_idx_%06d.JPG', source, doc_id)
  WHEN 2 THEN '/vol/' || source || '/' || printf('%s_idx_%d', source, doc_id)
  WHEN 3 THEN '/vol/' || source || '/' || printf('%s_idx_%dx.png', source, doc_id)
  WHEN 4 THEN '/vol/' || source || '/sub/'
  ELSE '/vol/' || source || '/' || printf('%s_idx_.jpeg', source) END"""


def path_parts(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source")
    p = docs.withColumn("path", odd_paths(docs))
    fn = C.basename("path")
    return p.select(
        "doc_id", "path",
        fn.alias("filename"),
        C.extension(fn).alias("file_format"),
        # indexes as text: a nullable integer column has no common pandas
        # form between engines (float64 + NaN vs Int64 + NA); text compares exactly
        C.dataset_index(fn).cast("string").alias("dataset_index"),
        C.dataset_index(fn, strict=True).cast("string").alias("strict_index"),
        fn.contains("_idx_").alias("has_marker"),
        C.parent_dir("path").alias("parent_dir"))


register("path_parts", f"""
WITH p AS (SELECT doc_id, {_ODD_PATH_SQL} AS path FROM documents),
f AS (SELECT doc_id, path, regexp_extract(path, '([^/]+)$', 1) AS filename FROM p),
s AS (SELECT *, split_part(split_part(filename, '_idx_', 2), '.', 1) AS part FROM f)
SELECT doc_id, path, filename,
       regexp_extract(filename, '\\.(\\w+)$', 1) AS file_format,
       CAST(CASE WHEN contains(filename, '_idx_') THEN TRY_CAST(regexp_extract(filename, '_idx_(\\d+)', 1) AS BIGINT) END AS VARCHAR) AS dataset_index,
       CAST(CASE WHEN contains(filename, '_idx_') AND regexp_matches(part, '^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$')
            THEN TRY_CAST(replace(trim(part), '_', '') AS BIGINT) END AS VARCHAR) AS strict_index,
       contains(filename, '_idx_') AS has_marker,
       CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS parent_dir
FROM s
""")(path_parts)


def url_basename(spark, d):
    p = read_table(spark, d, "pages").select("page_id", "url")
    fn = C.basename("url")
    return p.select("page_id", fn.alias("url_name"), C.extension(fn).alias("url_ext"))


register("url_basename", """
SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS url_name,
       regexp_extract(regexp_extract(url, '([^/]+)$', 1), '\\.(\\w+)$', 1) AS url_ext
FROM pages
""")(url_basename)


def asset_id(spark, d):
    a = document_assets(spark, d)
    # German documents carry no index: their id falls back to a hash of the path.
    idx = F.when(F.col("group") != "de", F.col("doc_id"))
    return a.select("doc_id", C.asset_id("key", idx, "path").alias("image_id"),
                    C.asset_filename("key", "doc_id").alias("filename"))


register("asset_id", """
WITH a AS (SELECT doc_id, source, lang,
                  '/vol/' || source || '/' || printf('%s_idx_%06d.jpg', source, doc_id) AS path FROM documents)
SELECT doc_id,
       CASE WHEN lang <> 'de' THEN printf('%s_%06d', source, doc_id)
            ELSE source || '_' || substr(sha256(path), 1, 8) END AS image_id,
       printf('%s_idx_%06d.jpg', source, doc_id) AS filename
FROM a
""")(asset_id)


def binary_size_base64(spark, d):
    a = document_assets(spark, d)
    b64 = C.b64("content")
    return a.select("doc_id", F.col("length").alias("n_bytes"),
                    F.length(b64).cast("bigint").alias("b64_len"),
                    F.md5(b64).alias("b64_md5"),
                    (F.unbase64(b64) == F.col("content")).alias("roundtrip"))


register("binary_size_base64", """
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes,
       CAST(length(to_base64(encode(text))) AS BIGINT) AS b64_len,
       md5(to_base64(encode(text))) AS b64_md5,
       from_base64(to_base64(encode(text))) = encode(text) AS roundtrip
FROM documents
""")(binary_size_base64)


# ---------------------------------------------------------------- config, lookups, unions

def taxonomy_inverse(spark, d):
    docs = read_table(spark, d, "documents")
    pairs = docs.select(F.col("lang"), F.col("source")).where(F.col("source").isNotNull()).distinct()
    inv = invert(with_positions(pairs, "lang", "source"))
    return inv.select(F.col("key"), F.col("group").alias("group_name"), "n_groups")


register("taxonomy_inverse", """
SELECT source AS key, max(lang) AS group_name, CAST(count(DISTINCT lang) AS BIGINT) AS n_groups
FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY source
""")(taxonomy_inverse)


def keys_missing(spark, d):
    cust = read_table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    orders = read_table(spark, d, "orders").select(F.col("o_custkey").alias("key"))
    return flag_known(cust, orders, "key", "has_orders").withColumnRenamed("key", "c_custkey")


register("keys_missing", """
SELECT c_custkey, EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey) AS has_orders
FROM customer c
""")(keys_missing)


def union_by_group(spark, d):
    """UNION ALL by name of three asset tables with one schema -- web
    pages (key = host, group 'web'), documents (key = source, group = lang)
    and conversation turns (key = role, group 'chat') -- each scanned once,
    then counted per group."""
    docs = read_table(spark, d, "documents").select(
        F.col("source").alias("key"), F.col("lang").alias("group_name"),
        F.octet_length(F.encode("text", "UTF-8")).cast("bigint").alias("n_bytes"))
    pages = read_table(spark, d, "pages").select(
        F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("key"), F.lit("web").alias("group_name"),
        F.octet_length(F.encode("html", "UTF-8")).cast("bigint").alias("n_bytes"))
    turns = read_table(spark, d, "conversations").select(
        F.col("role").alias("key"), F.lit("chat").alias("group_name"),
        F.octet_length(F.encode("text", "UTF-8")).cast("bigint").alias("n_bytes"))
    u = union_all([docs, pages, turns])
    return u.groupBy("group_name").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                       F.count_distinct("key").cast("bigint").alias("keys"),
                                       F.sum("n_bytes").cast("bigint").alias("bytes"))


register("union_by_group", """
WITH u AS (
  SELECT source AS key, lang AS group_name, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes FROM documents
  UNION ALL
  SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), 'web', CAST(octet_length(encode(html)) AS BIGINT) FROM pages
  UNION ALL
  SELECT role, 'chat', CAST(octet_length(encode(text)) AS BIGINT) FROM conversations)
SELECT group_name, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT key) AS BIGINT) AS keys,
       CAST(sum(n_bytes) AS BIGINT) AS bytes
FROM u GROUP BY group_name
""")(union_by_group)


def format_filter(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source", "text")
    files = docs.select("doc_id", odd_paths(docs).alias("path"), F.encode("text", "UTF-8").alias("content"))
    b = bronze(files, key_from_dir=True, ingested_at=F.lit(None).cast("timestamp"))
    kept = b.filter(F.col("content").isNotNull()).filter(F.col("file_format").isin(ACCEPTED_FORMATS))
    return kept.select("doc_id", "file_format", "food_type")


register("format_filter", f"""
WITH p AS (SELECT doc_id, source, text, {_ODD_PATH_SQL} AS path FROM documents),
f AS (SELECT *, regexp_extract(regexp_extract(path, '([^/]+)$', 1), '\\.(\\w+)$', 1) AS file_format,
             regexp_extract(path, '([^/]+)/[^/]*$', 1) AS food_type FROM p)
SELECT doc_id, file_format, food_type FROM f
WHERE text IS NOT NULL AND file_format IN ('jpg', 'jpeg', 'png')
""")(format_filter)


def struct_expand(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "props", "value")
    parsed = ev.withColumn("p", F.from_json("props", "k BIGINT"))
    return parsed.select("event_id", "p.*", F.col("value").alias("amount"))


register("struct_expand", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value AS amount FROM events
""")(struct_expand)


# Known brands (config list): Brand#1..Brand#12; the others encode to -1.
BRANDS = [f"Brand#{i}" for i in range(1, 13)]
_brands_sql = sql_list(E.sorted_names(BRANDS))


def label_encode(spark, d):
    p = read_table(spark, d, "part").select("p_partkey", "p_brand")
    return E.encode(p, "p_brand", BRANDS, "brand_id")


register("label_encode", f"""
SELECT p_partkey, p_brand, CAST(coalesce(list_position({_brands_sql}, p_brand) - 1, -1) AS INTEGER) AS brand_id
FROM part
""")(label_encode)


def label_decode(spark, d):
    enc = label_encode(spark, d)
    return E.decode(enc, "brand_id", BRANDS, "brand_name").select("p_partkey", "brand_id", "brand_name")


register("label_decode", f"""
WITH e AS (SELECT p_partkey, CAST(coalesce(list_position({_brands_sql}, p_brand) - 1, -1) AS INTEGER) AS brand_id FROM part)
SELECT p_partkey, brand_id, CASE WHEN brand_id >= 0 THEN {_brands_sql}[brand_id + 1] END AS brand_name FROM e
""")(label_decode)


# Ordered label names of the labelled source (labels 8 and 9 have no name).
LABEL_NAMES = ["zero", "one", "two", "three", "four", "five", "six", "seven"]


def label_names(spark, d):
    e = read_table(spark, d, "embeddings").select("vec_id", "label")
    return E.names_lookup(e, "label", LABEL_NAMES, "name")


register("label_names", f"""
SELECT vec_id, label, CASE WHEN label >= 0 THEN {sql_list(LABEL_NAMES)}[label + 1] END AS name FROM embeddings
""")(label_names)


def labels_from_data(spark, d):
    ev = read_table(spark, d, "events").select("event_type")
    return E.labels_from_data(ev, "event_type")


register("labels_from_data", """
SELECT CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS id, event_type AS name
FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)
""")(labels_from_data)


# ---------------------------------------------------------------- splits and sampling

def split_hash(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id")
    return S.split_hash(docs, "doc_id", SEED)


register("split_hash", f"""
SELECT doc_id, {uhash(SEED, 'doc_id')} AS split_seed, {split_case(uhash(SEED, 'doc_id'))} AS dataset_split
FROM documents
""")(split_hash)


def split_stratified(spark, d):
    # one language stands for documents without a class
    docs = read_table(spark, d, "documents").select("doc_id", F.nullif("lang", F.lit("es")).alias("lang"))
    return S.split_stratified(docs, "lang", "doc_id", SEED)


register("split_stratified", f"""
WITH u AS (SELECT doc_id, nullif(lang, 'es') AS lang, {uhash(SEED, 'doc_id')} AS u FROM documents),
r AS (SELECT *, (rank() OVER (PARTITION BY lang ORDER BY u, doc_id) - 1)::DOUBLE
                / count(*) OVER (PARTITION BY lang) AS q FROM u)
SELECT doc_id, lang, {split_case('q')} AS dataset_split FROM r
""")(split_stratified)


def split_exact(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id")
    return S.train_test_exact(docs, "doc_id", test_size=0.2, seed=SEED)


register("split_exact", f"""
WITH u AS (SELECT doc_id, {uhash(SEED, 'doc_id')} AS u FROM documents),
r AS (SELECT *, row_number() OVER (ORDER BY u, doc_id) AS rn, count(*) OVER () AS n FROM u)
SELECT doc_id, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r
""")(split_exact)


def split_crowded(spark, d):
    """The exact first 30 % where a third of all rows share one place in the order and ties decide."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    u = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0.25)).otherwise(unit_hash(SEED, "l_orderkey", "l_linenumber"))
    flagged = exact_first_k(li.withColumn("_u", u), "_u", ["l_orderkey", "l_linenumber"], li.count() * 3 // 10, "chosen")
    return flagged.drop("_u")


register("split_crowded", f"""
WITH u AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 0.25 ELSE
             {uhash(SEED, "(l_orderkey || ':' || l_linenumber)")} END AS u FROM lineitem),
r AS (SELECT *, row_number() OVER (ORDER BY u, l_orderkey, l_linenumber) AS rn, count(*) OVER () AS n FROM u)
SELECT l_orderkey, l_linenumber, rn <= n * 3 // 10 AS chosen FROM r
""")(split_crowded)


def sample_n(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "lang")
    return S.sample_n(docs, "doc_id", 50, SEED)


register("sample_n", f"""
SELECT doc_id, lang FROM documents ORDER BY {uhash(SEED, 'doc_id')}, doc_id LIMIT 50
""")(sample_n)


# ---------------------------------------------------------------- listing, snapshots

def first_k(spark, d):
    c = read_table(spark, d, "customer").select("c_mktsegment", "c_name")
    top = first_k_per_group(c, "c_mktsegment", "c_name", 4)
    return top.select(F.col("c_mktsegment").alias("segment"),
                      F.array_join("first_items", ",").alias("first_names"))


register("first_k", """
SELECT c_mktsegment AS segment, string_agg(c_name, ',' ORDER BY c_name) AS first_names
FROM (SELECT c_mktsegment, c_name,
             row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) AS rn
      FROM customer WHERE c_name IS NOT NULL)
WHERE rn <= 4 GROUP BY c_mktsegment
""")(first_k)


def _snapshots(spark, d):
    """Two versions of the orders table: the later one archives finished
    orders from before 1996, closes open orders from before 1997 and adds
    orders placed after the first version's cut-off (2001-01-01)."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    old = o.filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    archived = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    new = (o.filter(~F.coalesce(archived, F.lit(False)))
           .withColumn("o_orderstatus",
                       F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")),
                              F.lit("F")).otherwise(F.col("o_orderstatus"))))
    return old, new


def snapshot_changes_q(spark, d):
    old, new = _snapshots(spark, d)
    return snapshot_changes(old, new, "o_orderkey")


register("snapshot_changes", """
WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
             WHERE o_orderdate < TIMESTAMP '2001-01-01'),
new AS (SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1997-01-01' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate
        FROM orders WHERE NOT coalesce(o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01', false)),
j AS (SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
             CASE WHEN o.o_orderkey IS NULL THEN 'insert'
                  WHEN n.o_orderkey IS NULL THEN 'delete'
                  WHEN o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus
                   AND o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice
                   AND o.o_orderdate IS NOT DISTINCT FROM n.o_orderdate THEN 'same'
                  ELSE 'update' END AS change_type
      FROM old o FULL OUTER JOIN new n ON o.o_orderkey = n.o_orderkey)
SELECT o_orderkey, change_type FROM j WHERE change_type <> 'same'
""")(snapshot_changes_q)
