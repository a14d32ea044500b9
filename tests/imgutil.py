"""Stdlib PNG writer for test images (no imaging library needed)."""

import struct
import zlib

import numpy as np


def _chunk(tag, data):
    return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)


def png(arr: np.ndarray, color_type: int, palette: np.ndarray | None = None) -> bytes:
    """arr: (h, w) for types 0/3, (h, w, 2) for 4, (h, w, 3) for 2, (h, w, 4) for 6."""
    arr = np.asarray(arr, dtype=np.uint8)
    h, w = arr.shape[:2]
    rows = b"".join(b"\x00" + arr[y].tobytes() for y in range(h))
    out = b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color_type, 0, 0, 0))
    if color_type == 3:
        out += _chunk(b"PLTE", np.asarray(palette, dtype=np.uint8).tobytes())
    return out + _chunk(b"IDAT", zlib.compress(rows)) + _chunk(b"IEND", b"")


def write(path, data: bytes):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
