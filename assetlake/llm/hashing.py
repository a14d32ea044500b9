"""Word and shingle hashes of many texts at once, with numpy over their UTF-8 bytes.

A word's hash is a polynomial of random byte values, taken from one running sum over all bytes of a
chunk, so no word is touched by Python. ASCII letters count as lower case. Memory is bounded by
``CHUNK`` bytes of text at a time; a longer text is read in pieces cut at white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_POWERS.get(name, ())) < n:
        p = np.full(n, base, np.uint64)
        p[0] = 1
        _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[name][:n]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of each run of equal values in a sorted array, and the runs' lengths."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return first, np.diff(np.r_[first, len(values)])


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word."""
    raw = np.frombuffer(data, np.uint8)
    word = np.zeros(len(raw) + 2, bool)
    word[1:-1] = ~_SPACE[raw]
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[0::2], edge[1::2]
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[raw] * powers("up", STEP, len(raw)), out=total[1:])
    hashed = (total[end] - total[start]) * powers("down", BACK, len(raw) + 1)[start]
    return mixed(hashed + (end - start).astype(np.uint64)), start


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the hashes of its words in order."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(texts):
        if len(texts[i]) > CHUNK:
            out.append(np.concatenate([_words(p)[0] for p in _pieces(texts[i])]))
            i += 1
            continue
        j, size, starts = i, 0, []
        while j < len(texts) and len(texts[j]) <= CHUNK and (j == i or size + len(texts[j]) < CHUNK):
            starts.append(size)
            size += len(texts[j]) + 1
            j += 1
        data = b" ".join(texts[i:j])
        hashed, at = _words(data) if data else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        cut = np.searchsorted(at, starts[1:])
        out += np.split(hashed, cut)
        i = j
    return out


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of the ``n``-word shingles; of a shorter text the one hash of all its words."""
    if not len(words):
        return words
    size = min(n, len(words))
    h = np.full(len(words) - size + 1, np.uint64(size))
    for k in range(size):
        h = mixed(h * STEP + words[k:len(words) - size + 1 + k])
    return np.unique(h)


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
