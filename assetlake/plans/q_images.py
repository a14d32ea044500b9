"""Image queries on gray pictures that column functions make of documents.

A document's whole UTF-8 text is a picture, a byte a pixel: about square, at least 32 pixels wide and
high, the last rows padded with zeros. Its content is a PNG start with the size and mode, as every
header walk expects, and the raw pixels behind it; no file is written. ``image_gold`` takes it through
bronze, the header gate, byte histograms, the rules and gold; the SQL twins recompute everything from
the text bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.functions.columns import asset_id, round6
from assetlake.operators.headers import PNG_START, header, passes
from assetlake.operators.histograms import channel_stats, histogram, merged, moments, with_stats
from assetlake.operators.images import MAX_SIDE, MIN_SIDE, letterbox
from assetlake.operators.quality import apply_rules
from assetlake.plans.medallion import bronze, gold, silver_rules, wanted_files
from assetlake.plans.q_assets import DOC_GROUPS, DOC_KEYS, SEED, _groups_sql, _keys_sql
from assetlake.plans.registry import r6, register, split_case, uhash
from assetlake.sources.tables import document_assets, read_table

START = 33  # bytes before the pixels: the start of a PNG and its header chunk


def _key_to_group(spark, d):
    """Taxonomy derived from the data: each source's most frequent language
    (ties: the later name). One partial+final aggregation, then one per key."""
    docs = read_table(spark, d, "documents").select("source", "lang")
    c = docs.where(F.col("source").isNotNull() & F.col("lang").isNotNull()).groupBy("source", "lang").count()
    return c.groupBy(F.col("source").alias("key")).agg(
        F.max_by("lang", F.struct("count", "lang")).alias("group"))


def _hex_of(number: Column, digits: int) -> Column:
    return F.lpad(F.hex(number), digits, "0")


def _png_start(width: Column, height: Column, bits, kind) -> Column:
    """The first ``START`` bytes of a PNG (its header's checksum left 0)."""
    bits, kind = (x if isinstance(x, Column) else F.lit(x) for x in (bits, kind))
    return F.unhex(F.concat(F.lit(PNG_START + "0000000D49484452"), _hex_of(width, 8), _hex_of(height, 8), _hex_of(bits, 2), _hex_of(kind, 2),
                            F.lit("00" * 7)))


def picture_files(spark, d) -> DataFrame:
    """File rows (path, length, content, key ..) with a picture for every document that has a text."""
    a = document_assets(spark, d).where(F.col("content").isNotNull())
    n = F.length("content").cast("bigint")
    a = a.withColumn("_w", F.greatest(F.lit(MIN_SIDE), F.least(F.lit(MAX_SIDE), F.floor(F.sqrt(n.cast("double"))))).cast("bigint"))
    a = a.withColumn("_h", F.greatest(F.lit(MIN_SIDE), F.ceil(n / F.col("_w"))).cast("bigint"))
    pixels = F.rpad(F.col("content"), (F.col("_w") * F.col("_h")).cast("int"), F.unhex(F.lit("00")))
    return a.withColumn("content", F.concat(_png_start(F.col("_w"), F.col("_h"), 8, 0), pixels)).drop("_w", "_h")


def _silver(spark, d):
    """Rows before the rules: gate on the header, then one histogram a picture."""
    b = wanted_files(bronze(picture_files(spark, d), ingested_at=F.lit(None).cast("timestamp")).withColumn("pixels", F.substring("content", START + 1, 2 ** 31 - 1)))
    lut = _key_to_group(spark, d).select(F.col("key").alias("_k"), F.col("group").alias("cuisine_category"))
    b = b.withColumn("counts", histogram(F.col("pixels"))).join(lut, F.col("food_type") == F.col("_k"), "left")
    box = letterbox(F.col("header.width"), F.col("header.height"))
    return with_stats(b).select(
        asset_id("food_type", "dataset_index", "path").alias("image_id"), "food_type", "cuisine_category", "dataset_index",
        F.col("counts").alias("processed_image_data"), F.greatest(box["new_w"], box["new_h"]).alias("processed_width"),
        F.greatest(box["new_w"], box["new_h"]).alias("processed_height"), "mean_rgb", "std_rgb", "quality_score", "brightness", "contrast",
        box["aspect"].alias("aspect_ratio"))


def image_gold(spark, d):
    kept, _ = apply_rules(_silver(spark, d), silver_rules())
    g = gold(kept, DOC_KEYS, DOC_GROUPS, seed=SEED)
    return g.select("image_id", "food_type", "cuisine_category", "food_type_encoded", "cuisine_category_encoded",
                    "dataset_split", "dataset_index",
                    round6(F.col("mean_rgb")[0]).alias("mean"), round6(F.col("std_rgb")[0]).alias("std"),
                    round6("brightness").alias("brightness"), round6("contrast").alias("contrast"),
                    round6("quality_score").alias("quality_score"), round6("aspect_ratio").alias("aspect_ratio"))


_BYTES_SQL = f"""
d AS (SELECT doc_id, source, lang, hex(encode(text)) AS hx, octet_length(encode(text)) AS n
      FROM documents WHERE text IS NOT NULL),
w AS (SELECT *, greatest({MIN_SIDE}, least({MAX_SIDE}, CAST(floor(sqrt(n)) AS BIGINT))) AS w,
             list_transform(range(0, n), lambda i: CAST(('0x' || substr(hx, 2 * i + 1, 2)) AS INTEGER)) AS px FROM d),
b AS (SELECT *, greatest({MIN_SIDE}, CAST(ceil(n / w) AS BIGINT)) AS h FROM w),
s AS (SELECT doc_id, source, lang, w, h, n,
             coalesce(list_sum(px), 0)::DOUBLE / (w * h) AS m,
             coalesce(list_sum(list_transform(px, lambda x: x::DOUBLE * x)), 0)::DOUBLE / (w * h) AS m2 FROM b),
v AS (SELECT *, sqrt(greatest(m2 - m * m, 0.0::DOUBLE)) AS sd FROM s WHERE h BETWEEN {MIN_SIDE} AND {MAX_SIDE}),
cnt AS (SELECT source, lang, count(*) AS c FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY 1, 2),
tax AS (SELECT source, lang AS grp FROM (
          SELECT *, row_number() OVER (PARTITION BY source ORDER BY c DESC, lang DESC) AS rn FROM cnt) WHERE rn = 1),
g AS (SELECT v.*, tax.grp, printf('%s_%06d', v.source, v.doc_id) AS image_id FROM v JOIN tax ON v.source = tax.source)"""

register("image_gold", f"""WITH {_BYTES_SQL}
SELECT image_id, source AS food_type, grp AS cuisine_category,
       CAST(coalesce(list_position({_keys_sql}, source) - 1, -1) AS INTEGER) AS food_type_encoded,
       CAST(coalesce(list_position({_groups_sql}, grp) - 1, -1) AS INTEGER) AS cuisine_category_encoded,
       {split_case(uhash(SEED, 'image_id'))} AS dataset_split,
       doc_id AS dataset_index,
       {r6('m')} AS mean, {r6('sd')} AS std,
       {r6('m / 255.0::DOUBLE')} AS brightness, {r6('sd / 255.0::DOUBLE')} AS contrast,
       {r6('least(1.0::DOUBLE, sd / 255.0::DOUBLE * 2.0::DOUBLE)')} AS quality_score,
       {r6('w::DOUBLE / h')} AS aspect_ratio
FROM g
""")(image_gold)


def image_dq_report(spark, d):
    _, rep = apply_rules(_silver(spark, d), silver_rules())
    return rep


register("image_dq_report", f"""WITH {_BYTES_SQL}
SELECT rule, action, CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed FROM (
  SELECT 'valid_image_data' AS rule, 'drop' AS action, count(*) AS checked, 0 AS failed FROM g
  UNION ALL SELECT 'valid_food_type', 'drop', count(*), 0 FROM g
  UNION ALL SELECT 'valid_cuisine', 'drop', count(*), 0 FROM g
  UNION ALL SELECT 'valid_dimensions', 'drop', count(*), 0 FROM g
  UNION ALL SELECT 'good_quality', 'warn', count(*), count(*) FILTER (WHERE NOT (least(1.0, sd / 255.0 * 2.0) >= 0.3)) FROM g)
""")(image_dq_report)


# ---------------------------------------------------------------- headers

SEGMENT = 500  # text bytes in a segment before a JPEG's frame header


def _jpeg_start(text: Column, width: Column, height: Column, parts: Column) -> Column:
    """A JPEG up to its frame header, with the whole text in comment segments before it."""
    hx = F.hex(text)
    cuts = F.transform(F.sequence(F.lit(1), F.greatest(F.length(hx), F.lit(1)), F.lit(2 * SEGMENT)), lambda i: F.substring(hx, i, F.lit(2 * SEGMENT)))
    told = F.array_join(F.transform(cuts, lambda c: F.concat(F.lit("FFFE"), _hex_of(F.length(c) / 2 + 2, 4), c)), "")
    frame = F.concat(F.lit("FFC2000B08"), _hex_of(height, 4), _hex_of(width, 4), _hex_of(parts, 2))
    return F.unhex(F.concat(F.lit("FFD8FFD0FFFF"), F.substring(told, 3, 2 ** 31 - 1), frame, F.lit("FFDA")))


def image_headers(spark, d):
    """Size, mode and gate of headers: even documents are PNGs, odd ones JPEGs with their text before the frame header."""
    docs = read_table(spark, d, "documents").where("doc_id IS NOT NULL").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("b"))
    w, h = 1 + F.col("doc_id") * 37 % 5000, 1 + F.length("b").cast("bigint") % 5000
    kind = F.element_at(F.array(*map(F.lit, (0, 2, 3, 4, 6))), (F.col("doc_id") % 5 + 1).cast("int"))
    content = F.when(F.col("doc_id") % 2 == 0, _png_start(w, h, F.when(F.col("doc_id") % 3 == 0, 16).otherwise(8), kind)).otherwise(
        _jpeg_start(F.col("b"), w, h, F.col("doc_id") % 4 + 1))
    heads = docs.select("doc_id", content.alias("content")).withColumn("h", header(F.col("content")))
    return heads.select("doc_id", "h.*", passes(F.col("h")).alias("passes"))


register("image_headers", f"""
WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n FROM documents WHERE doc_id IS NOT NULL),
h AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'png' ELSE 'jpeg' END AS format,
             CAST(1 + doc_id * 37 % 5000 AS INTEGER) AS width, CAST(1 + n % 5000 AS INTEGER) AS height,
             CASE WHEN doc_id % 2 = 0 THEN
                    CASE WHEN doc_id % 5 = 0 AND doc_id % 3 = 0 THEN 'other'
                         ELSE ['L', 'RGB', 'P', 'LA', 'RGBA'][doc_id % 5 + 1] END
                  ELSE ['L', 'other', 'RGB', 'CMYK'][doc_id % 4 + 1] END AS mode FROM d)
SELECT *, width BETWEEN {MIN_SIDE} AND {MAX_SIDE} AND height BETWEEN {MIN_SIDE} AND {MAX_SIDE} AND mode IN ('RGB', 'RGBA', 'L') AS passes FROM h
""")(image_headers)


# ---------------------------------------------------------------- statistics

def image_key_stats(spark, d):
    """Statistics of all pictures of a source, from their histograms added up."""
    p = picture_files(spark, d).select("key", F.substring("content", START + 1, 2 ** 31 - 1).alias("pixels"))
    counts = merged(p.select("key", histogram(F.col("pixels")).alias("counts")), ["key"])
    s = channel_stats(F.col("m")[0])
    return counts.withColumn("m", moments(F.col("counts"))).select("key", F.col("parts").alias("pictures"), round6(s["mean"]).alias("mean"), round6(s["std"]).alias("std"))


register("image_key_stats", f"""WITH {_BYTES_SQL.replace(f"WHERE h BETWEEN {MIN_SIDE} AND {MAX_SIDE}", "")},
k AS (SELECT source AS key, count(*) AS pictures, sum(w * h)::DOUBLE AS c, sum(m * (w * h)) AS s1, sum(m2 * (w * h)) AS s2 FROM s GROUP BY source)
SELECT key, pictures, {r6('s1 / c')} AS mean, {r6('sqrt(greatest(s2 / c - (s1 / c) * (s1 / c), 0.0::DOUBLE))')} AS std FROM k
""")(image_key_stats)


def image_colour_stats(spark, d):
    """Statistics of documents as colour pictures: three bytes of text a pixel, an odd rest left off."""
    docs = read_table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.encode("text", "UTF-8").alias("pixels"))
    s = with_stats(docs.where(F.length("pixels") >= 3).withColumn("counts", histogram(F.col("pixels"), 3)), channels=3)
    return s.select("doc_id", *[round6(F.col("mean_rgb")[i]).alias(f"mean_{c}") for i, c in enumerate("rgb")],
                    *[round6(F.col("std_rgb")[i]).alias(f"std_{c}") for i, c in enumerate("rgb")],
                    round6("brightness").alias("brightness"), round6("contrast").alias("contrast"), round6("quality_score").alias("quality_score"))


_spread = "sqrt(greatest({0}2 / n - ({0}1 / n) * ({0}1 / n), 0.0::DOUBLE))"
register("image_colour_stats", f"""
WITH d AS (SELECT doc_id, hex(encode(text)) AS hx, octet_length(encode(text)) // 3 AS n FROM documents WHERE octet_length(encode(text)) >= 3),
p AS (SELECT doc_id, n::DOUBLE AS n, list_transform(range(0, n), lambda i: [CAST(('0x' || substr(hx, 6 * i + 1, 2)) AS BIGINT),
        CAST(('0x' || substr(hx, 6 * i + 3, 2)) AS BIGINT), CAST(('0x' || substr(hx, 6 * i + 5, 2)) AS BIGINT)]) AS px FROM d),
q AS (SELECT doc_id, n, px, list_transform(px, lambda x: (299 * x[1] + 587 * x[2] + 114 * x[3] + 500) // 1000) AS lu FROM p),
s AS (SELECT doc_id, n,
        {", ".join(f"list_sum(list_transform(px, lambda x: x[{i}]))::DOUBLE AS {c}1, list_sum(list_transform(px, lambda x: x[{i}] * x[{i}]))::DOUBLE AS {c}2" for i, c in ((1, "r"), (2, "g"), (3, "b")))},
        list_sum(lu)::DOUBLE AS l1, list_sum(list_transform(lu, lambda x: x * x))::DOUBLE AS l2 FROM q)
SELECT doc_id, {", ".join(f"{r6(f'{c}1 / n')} AS mean_{c}, {r6(_spread.format(c))} AS std_{c}" for c in "rgb")},
       {r6('l1 / n / 255.0::DOUBLE')} AS brightness, {r6(_spread.format('l') + ' / 255.0::DOUBLE')} AS contrast,
       {r6('least(1.0::DOUBLE, ' + _spread.format('l') + ' / 255.0::DOUBLE * 2.0::DOUBLE)')} AS quality_score
FROM s
""")(image_colour_stats)
