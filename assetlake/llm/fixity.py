"""Merkle fixity audit of web archive records.

A page becomes a WARC response record; the record of a page id is a leaf. Leaves stand in order of
their id, so a node of the tree (the ids that share a prefix of hex digits) is a range of records and
of byte offsets. A leaf's hash covers the number and the SHA-256 words of its records, a node's hash
those of its up to 16 children in order. Two replicas are compared from the roots down; only
children of mismatching nodes are read on, and each level joins the next by key.

Offsets come from the same descent: a child starts where its parent does, plus the bytes of the
siblings before it.

Defined results: a null id is one leaf of its own, before all others; rows that share an id are one
leaf whatever their order (sums of their hash words, so a crowded id needs no list); a null url or
html counts as empty; an empty replica has no root and every leaf of the other is reported; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assetlake.llm.common import stage

DIGITS = 16
_NONE = "-" * DIGITS


def record(key: Column, url: Column, html: Column) -> Column:
    """The bytes of a WARC response record."""
    body = F.coalesce(html.cast("string"), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("none")),
        F.lit(">\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def leaves(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """path, key, hash, records and bytes of every leaf of a replica."""
    k = F.col(key).cast("long")
    # unsigned order: the sign bit is turned
    path = F.coalesce(F.lpad(F.hex(k.bitwiseXOR(F.lit(-(1 << 63)))), DIGITS, "0"), F.lit(_NONE))
    r = pages.select(path.alias("path"), k.alias("key"), record(k, F.col("url"), F.col("html")).alias("r"))
    r = r.select("path", "key", F.octet_length("r").cast("long").alias("bytes"), F.sha2("r", 256).alias("sha"))
    words = [F.conv(F.substring("sha", 1 + 16 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = [F.sum(w).alias(f"w{i}") for i, w in enumerate(words)]
    leaf = r.groupBy("path", "key").agg(F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"), *sums)
    digest = F.sha2(F.concat_ws(":", F.lit("leaf"), F.col("records").cast("string"), *[F.col(f"w{i}").cast("string") for i in range(4)]), 256)
    return leaf.select("path", "key", digest.alias("hash"), "records", "bytes")


def _level_above(nodes: DataFrame) -> DataFrame:
    """Parents of the nodes of a level: at most 16 children each."""
    digit = F.substring("path", -1, 1)
    return (nodes.groupBy(F.expr("left(path, length(path) - 1)").alias("path"))
            .agg(F.sha2(F.concat_ws("|", F.transform(F.sort_array(F.collect_list(F.struct(digit.alias("d"), "hash"))), lambda x: F.concat(x["d"], x["hash"]))), 256).alias("hash"),
                 F.sum("records").alias("records"), F.sum("bytes").alias("bytes")))


def _shared_prefix(levels: list[DataFrame]) -> int:
    """Digits that all leaves of both replicas share: above them each level has one node."""
    r = reduce(DataFrame.unionAll, [t.select("path") for t in levels]).agg(F.min("path").alias("a"), F.max("path").alias("b")).first()
    if r["a"] is None:
        return DIGITS
    return next((i for i in range(DIGITS) if r["a"][i] != r["b"][i]), DIGITS)


def audit(primary: DataFrame, replica: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per leaf that differs: status (changed, missing, extra), offsets and sizes on both sides."""
    sides = {"p": [stage(leaves(primary, key), "fixity-leaves")], "r": [stage(leaves(replica, key), "fixity-leaves")]}
    top = _shared_prefix([sides["p"][0], sides["r"][0]])
    for _ in range(DIGITS - top):
        for levels in sides.values():
            levels.append(stage(_level_above(levels[-1]), "fixity-level"))

    def level(k: int, start: dict[str, DataFrame] | None) -> DataFrame:
        """Both replicas' nodes of a level below the mismatching parents, with their offsets."""
        out = []
        for s in "pr":
            t = sides[s][k]
            if start is not None:
                up = start[s].select(F.col("path").alias("up"), F.col("at").alias("up_at"))
                before = F.sum("bytes").over(Window.partitionBy("up").orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
                t = (t.join(up, F.expr("left(path, length(path) - 1)") == F.col("up"))
                     .withColumn("at", F.col("up_at") + F.coalesce(before, F.lit(0))))
            else:
                t = t.withColumn("at", F.lit(0).cast("long"))
            out.append(t.select("path", *(["key"] if k == 0 else []), "hash", "bytes", "records", "at"))
        p, r = out[0].alias("p"), out[1].alias("r")
        both = p.join(r, F.col("p.path") == F.col("r.path"), "full").where(~F.col("p.hash").eqNullSafe(F.col("r.hash")))
        return stage(both.select(
            F.coalesce("p.path", "r.path").alias("path"), *([F.coalesce("p.key", "r.key").alias("key")] if k == 0 else []),
            *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "pr" for c in ("hash", "bytes", "records", "at")]), "fixity-differs")

    differs = level(len(sides["p"]) - 1, None)
    for k in range(len(sides["p"]) - 2, -1, -1):
        differs = level(k, {s: differs.where(F.col(f"{s}_hash").isNotNull()).select("path", F.col(f"{s}_at").alias("at")) for s in "pr"})
    status = F.when(F.col("r_hash").isNull(), "missing").when(F.col("p_hash").isNull(), "extra").otherwise("changed")
    return differs.select(
        F.col("key").alias("page_id"), status.alias("status"), F.col("p_at").alias("primary_offset"), F.col("p_bytes").alias("primary_bytes"),
        F.col("r_at").alias("replica_offset"), F.col("r_bytes").alias("replica_bytes"))


def aged_copy(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` with faults by a fixed rule on the id, for the registered query.

    Of 997 ids one has a character overwritten, of 1499 one is lost, of 1999 one is cut in half.
    """
    half = F.floor(F.length("html") / 2).cast("int")
    worn = F.concat(F.substring(F.col("html"), F.lit(1), half), F.lit("#"), F.substring(F.col("html"), half + 2, F.length("html")))
    html = (F.when(F.col("page_id") % 997 == 5, worn).when(F.col("page_id") % 1999 == 11, F.substring(F.col("html"), F.lit(1), half))
            .otherwise(F.col("html")))
    return pages.where(F.coalesce(F.col("page_id") % 1499 != 7, F.lit(True))).select("page_id", "url", html.alias("html"))


#: The audit of ``aged_copy`` in DuckDB.
SQL = """
WITH both_sides AS (
  SELECT page_id, url, html,
    CASE WHEN page_id % 997 = 5 THEN concat(substr(html, 1, CAST(floor(length(html) / 2) AS INT)), '#', substr(html, CAST(floor(length(html) / 2) AS INT) + 2))
         WHEN page_id % 1999 = 11 THEN substr(html, 1, CAST(floor(length(html) / 2) AS INT)) ELSE html END AS worn,
    page_id % 1499 = 7 AS lost
  FROM pages),
sized AS (
  SELECT page_id, html, worn, lost,
    CAST(strlen(url) + strlen(CAST(page_id AS VARCHAR)) + 103 + strlen(html) + strlen(CAST(strlen(html) AS VARCHAR)) AS BIGINT) AS p,
    CAST(strlen(url) + strlen(CAST(page_id AS VARCHAR)) + 103 + strlen(worn) + strlen(CAST(strlen(worn) AS VARCHAR)) AS BIGINT) AS r
  FROM both_sides),
placed AS (
  SELECT *, CAST(sum(p) OVER (ORDER BY page_id) - p AS BIGINT) AS p_at,
    CAST(sum(CASE WHEN lost THEN 0 ELSE r END) OVER (ORDER BY page_id) - CASE WHEN lost THEN 0 ELSE r END AS BIGINT) AS r_at
  FROM sized)
SELECT page_id, CASE WHEN lost THEN 'missing' ELSE 'changed' END AS status, p_at AS primary_offset, p AS primary_bytes,
  CASE WHEN lost THEN NULL ELSE r_at END AS replica_offset, CASE WHEN lost THEN NULL ELSE r END AS replica_bytes
FROM placed WHERE lost OR html <> worn
"""
