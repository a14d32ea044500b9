"""Picture size and mode from the file header, before anything is decoded.

PNG keeps them at fixed places of its first chunk. JPEG keeps them in a frame header (SOF0-SOF15)
behind any number of segments, which a small state machine walks by their lengths. Both are Column
expressions over the file's bytes: no decoder, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetlake.operators.images import ACCEPTED_MODES, valid_size

# Fixed values of the two formats.
PNG_START = "89504E470D0A1A0A"
JPEG_START = "FFD8"
FRAME_MARKERS = ["C0", "C1", "C2", "C3", "C5", "C6", "C7", "C9", "CA", "CB", "CD", "CE", "CF"]
BARE_MARKERS = ["01", "D0", "D1", "D2", "D3", "D4", "D5", "D6", "D7"]
END_MARKERS = ["00", "D8", "D9", "DA"]
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}
JPEG_MODES = {1: "L", 3: "RGB", 4: "CMYK"}

#: Segments that are walked for every JPEG; only a file with more of them before its frame header costs more.
USUAL_SEGMENTS = 64
HEADER = "struct<format:string,width:int,height:int,mode:string>"
_STATE = "struct<at:int,height:int,width:int,parts:int,bits:int,done:boolean>"


def _hex(content: Column, at: Column, n: int) -> Column:
    return F.hex(F.substring(content, at, F.lit(n)))


def _number(content: Column, at: Column, n: int) -> Column:
    """Big-endian unsigned number of ``n`` bytes at a 1-based place; null beyond the end."""
    text = _hex(content, at, n)
    return F.when(F.length(text) == 2 * n, F.conv(text, 16, 10).cast("bigint"))


def _mode(names: dict[int, str], code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.lit("other"))


def _state(at, height, width, parts, bits, done) -> Column:
    cols = zip((at, height, width, parts, bits, done), ("at", "height", "width", "parts", "bits", "done"))
    return F.struct(*[(c if isinstance(c, Column) else F.lit(c)).alias(n) for c, n in cols]).cast(_STATE)


def _segment(content: Column):
    """One step of the walk: the state after the segment at ``at``."""
    def step(s: Column, _: Column) -> Column:
        at = s["at"]
        marker = _hex(content, at + 1, 1)
        size = _number(content, at + 2, 2)
        failed = _state(at, None, None, None, None, True)
        frame = _state(at, _number(content, at + 5, 2), _number(content, at + 7, 2), _number(content, at + 9, 1), _number(content, at + 4, 1), True)
        moved = lambda by: _state(at + by, None, None, None, None, False)
        return (F.when(s["done"], s)
                .when((_hex(content, at, 1) != "FF") | (marker == "") | marker.isin(END_MARKERS), failed)
                .when(marker == "FF", moved(1))
                .when(marker.isin(BARE_MARKERS), moved(2))
                .when(size.isNull() | (size < 2), failed)
                .when(marker.isin(FRAME_MARKERS), frame)
                .otherwise(moved(2 + size.cast("int"))))

    return step


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _jpeg(content: Column) -> Column:
    first = F.aggregate(F.sequence(F.lit(1), F.lit(USUAL_SEGMENTS)), _state(3, None, None, None, None, False), _segment(content))
    # a step moves by a byte at least, and a segment is four bytes or more but for fill bytes
    rest = lambda s: F.aggregate(F.sequence(F.lit(1), F.length(content)), s, _segment(content))
    walked = _bound(first, lambda s: F.when(s["done"], s).otherwise(rest(s)))
    return _bound(walked, lambda s: F.when(
        s["width"].isNotNull() & s["height"].isNotNull() & s["parts"].isNotNull(),
        F.struct(F.lit("jpeg").alias("format"), s["width"].cast("bigint").alias("width"), s["height"].cast("bigint").alias("height"),
                 F.when(s["bits"] == 8, _mode(JPEG_MODES, s["parts"])).otherwise(F.lit("other")).alias("mode"))))


def _png(content: Column) -> Column:
    kind, bits = _number(content, F.lit(26), 1), _number(content, F.lit(25), 1)
    mode = F.when((kind == 0) & bits.isin(1, 16), F.lit("other")).otherwise(_mode(PNG_MODES, kind))
    return F.struct(F.lit("png").alias("format"), _number(content, F.lit(17), 4).alias("width"),
                    _number(content, F.lit(21), 4).alias("height"), mode.alias("mode"))


def header(content: Column) -> Column:
    """format, width, height and mode of a PNG or JPEG; null for other bytes and broken headers.

    Gray PNGs of 1 or 16 bits are a mode of their own (``other``), as are JPEGs of more than 8 bits.
    """
    wide = "struct<format:string,width:bigint,height:bigint,mode:string>"
    most = F.lit(2 ** 31 - 1).cast("bigint")  # sides beyond an int are beyond every gate: kept as the largest int

    def told(c: Column) -> Column:
        png = (_hex(c, F.lit(1), 8) == PNG_START) & (_hex(c, F.lit(13), 4) == "49484452") & (F.length(c) >= 29)
        found = F.when(png, _png(c).cast(wide)).when(_hex(c, F.lit(1), 2) == JPEG_START, _jpeg(c).cast(wide))
        return _bound(found, lambda f: F.when(f.isNotNull(), F.struct(
            f["format"].alias("format"), F.least(f["width"], most).cast("int").alias("width"),
            F.least(f["height"], most).cast("int").alias("height"), f["mode"].alias("mode"))))

    return _bound(content, told)


def _fits(head: Column) -> Column:
    return F.coalesce(valid_size(head["width"], head["height"]) & head["mode"].isin(ACCEPTED_MODES), F.lit(False))


def passes(head: Column) -> Column:
    """I1/P7 on a header: both sides within bounds and an accepted mode; false where there is no header."""
    return _bound(head, lambda h: h.isNotNull() & _fits(h))


def refused(head: Column) -> Column:
    """Whether a header is there and doesn't pass: what need not be decoded."""
    return _bound(head, lambda h: h.isNotNull() & ~_fits(h))
