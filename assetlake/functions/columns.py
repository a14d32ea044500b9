"""Column functions: file-name parts, ids, formatting.

Every function takes and returns ``Column`` expressions so they stay inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the surveyed pipeline's (file-name grammar).
BASENAME_RE = r"([^/]+)$"          # last path part; a trailing "/" gives ""
EXTENSION_RE = r"\.(\w+)$"         # case kept; no extension gives ""
INDEX_RE = r"_idx_(\d+)"           # lenient index: digits after the marker
INDEX_MARKER = "_idx_"
ASSET_ID_FMT = "%s_%06d"           # pads to 6, never truncates
ASSET_FILE_FMT = "%s_idx_%06d.jpg"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(path) -> Column:
    """the text after the last ``/`` (empty when the path ends in ``/``)."""
    return F.regexp_extract(_c(path), BASENAME_RE, 1)


def extension(filename) -> Column:
    """word characters after the last dot, case kept, else ``""``."""
    return F.regexp_extract(_c(filename), EXTENSION_RE, 1)


def dataset_index(filename, strict: bool = False) -> Column:
    """the integer index encoded in a file name, else null.

    Lenient (F3, the bronze column): digits right after the first ``_idx_``;
    ``a_idx_12x.jpg`` gives 12. Strict (F4): the whole text between the first
    and second ``_idx_`` up to the first dot must be an integer as Python's
    ``int()`` reads it (sign, surrounding blanks, ``_`` between digits), so
    ``a_idx_12x.jpg`` gives null. ``try_cast`` keeps ANSI mode from failing a
    batch on ``x_idx_.jpg`` or on 20-digit indexes.
    """
    fn = _c(filename)
    if not strict:
        return F.when(fn.contains(INDEX_MARKER),
                      F.regexp_extract(fn, INDEX_RE, 1).try_cast("bigint"))
    part = F.split_part(F.split_part(fn, F.lit(INDEX_MARKER), F.lit(2)), F.lit("."), F.lit(1))
    ok = part.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$")
    return F.when(fn.contains(INDEX_MARKER) & ok,
                  F.regexp_replace(F.trim(part), "_", "").try_cast("bigint"))


def asset_id(key, idx, path=None) -> Column:
    """``{key}_{idx:06d}``; without an index, 8 hex digits of sha2(path).

    The surveyed code falls back to a random uuid; a hash of the path is
    repeatable across retries and re-runs, which a random id is not.
    """
    k = F.coalesce(_c(key).cast("string"), F.lit("None"))
    with_idx = F.format_string(ASSET_ID_FMT, k, _c(idx))
    if path is None:
        fallback = F.concat(k, F.lit("_"), F.substring(F.uuid(), 1, 8))
    else:
        fallback = F.concat(k, F.lit("_"), F.substring(F.sha2(_c(path).cast("string"), 256), 1, 8))
    return F.when(_c(idx).isNotNull(), with_idx).otherwise(fallback)


def asset_filename(key, idx) -> Column:
    """``{key}_idx_{idx:06d}.jpg``."""
    return F.format_string(ASSET_FILE_FMT, _c(key), _c(idx))


def parent_dir(path) -> Column:
    """F8: everything before the last ``/``; ``""`` when there is none."""
    p = _c(path)
    return F.when(p.contains("/"), F.regexp_replace(p, r"/[^/]*$", "")).otherwise(F.lit(""))


def byte_size(binary) -> Column:
    """Number of bytes, 0 for null."""
    return F.coalesce(F.octet_length(_c(binary)), F.lit(0))


def b64(binary) -> Column:
    """base64 text without line breaks.

    Spark 4.1's ``base64`` breaks lines every 76 characters unless
    ``spark.sql.chunkBase64String.enabled`` is false; a transport payload
    needs one unbroken string whatever the session says. When the active
    session already turns chunking off, the line-break scan is skipped.
    """
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    if s is not None and s.conf.get("spark.sql.chunkBase64String.enabled", "true").lower() == "false":
        return F.base64(_c(binary))
    return F.regexp_replace(F.base64(_c(binary)), "[\\r\\n]", "")


def title(text) -> Column:
    """F16: title case that capitalises every letter after a non-letter (as Python does).

    ``initcap`` only starts words after a space, so a space is put after each non-letter and taken
    out again: plain string functions, kept in whole-stage codegen (a ``transform`` lambda would not be).
    """
    spaced = F.regexp_replace(_c(text), r"([^\p{L}])", "$1 ")
    return F.regexp_replace(F.initcap(spaced), r"([^\p{L}]) ", "$1")


def percent_text(ratio, places: int = 1) -> Column:
    """``0.1234 -> '12.3%'`` (half-up; a decimal cast stays in codegen,
    unlike ``format_string``)."""
    return F.concat((_c(ratio) * F.lit(100.0)).cast(f"decimal(38,{places})").cast("string"), F.lit("%"))


def mask(token, keep: int = 10) -> Column:
    """first ``keep`` characters and ``***`` (secrets in logs)."""
    return F.concat(F.substring(_c(token), 1, keep), F.lit("***"))


def preview(text, n: int = 200) -> Column:
    """display preview of a long text (the full text stays in its column)."""
    return F.substring(_c(text), 1, n)


def round6(x) -> Column:
    """Half-up rounding to 6 places, written the same way in the SQL oracles."""
    return F.floor(_c(x) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)
