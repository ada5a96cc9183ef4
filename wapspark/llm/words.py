"""Words of Arrow text columns as numpy arrays, shared by the text operators.

A word is a maximal run of bytes outside space and 0x09-0x0D. UTF-8 text is
read straight from the Arrow buffers: no Python string is made per row.
Batches are walked in chunks of a bounded number of bytes (one longer text is
a chunk of its own), so memory follows the chunk and not the batch.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once; a longer single text is taken alone.
CHUNK_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15
MULT = np.uint64(_MULT)  # odd: the step of rolling hashes
_INV = pow(_MULT, -1, 1 << 64)
_MASK = (1 << 64) - 1

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def give_back(run):
    """A map function over batches that hands memory which a task has freed
    back to the system when it ends: workers live on between tasks."""
    @wraps(run)
    def whole(*args):
        try:
            yield from run(*args)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# One pseudo-random 64-bit value per byte; the second table folds A-Z to a-z.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the multiplier (or of its inverse)."""
    have = _powers[kind]
    if len(have) < n:
        step = np.full(max(n, 1 << 16), _MULT if kind == "up" else _INV, np.uint64)
        step[0] = 1
        have = _powers[kind] = np.multiply.accumulate(step)
    return have[:n]


@dataclass
class Chunk:
    """Texts of rows ``first .. first+rows`` of a batch, back to back."""

    first: int          # row of the first text in its batch
    rows: int
    data: np.ndarray    # uint8, the texts' bytes
    offsets: np.ndarray  # int64, rows + 1, into data


@dataclass
class Words:
    """Words of a chunk; all arrays but ``per_row`` have one entry a word."""

    start: np.ndarray   # first byte
    end: np.ndarray     # byte after the last
    row: np.ndarray     # row in the chunk
    hash: np.ndarray    # uint64 of the word's bytes
    per_row: np.ndarray  # int64, rows + 1: where each row's words begin


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES):
    """Chunks of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    n = len(column)
    if n == 0:
        return
    _, off, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(off, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Chunk(lo, hi - lo, flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def span_hashes(chunk: Chunk, start: np.ndarray, end: np.ndarray,
                lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans of a chunk (A-Z folded for ``lower``);
    equal bytes have equal hashes wherever they stand."""
    return rolling((_BYTE_LOWER if lower else _BYTE)[chunk.data], start, end - start)


def rolling(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the slices of ``values`` (uint64) that begin at ``start``."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power("up", n), out=sums[1:])
    return mix((sums[start + size] - sums[start]) * _power("down", n + 1)[start]
               + size.astype(np.uint64))


def words(chunk: Chunk, lower: bool = False, outside: np.ndarray = _IS_SPACE) -> Words:
    """Words of every row with a 64-bit hash of their bytes (A-Z folded to a-z
    for ``lower``). Equal words have equal hashes wherever they stand.
    ``outside`` says of each byte whether it parts words."""
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    # A false column before and after, and a cut at each row's first byte.
    inside = ~outside[data]
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (first | ~before))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:] & ~first[1:]
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    hashed = span_hashes(chunk, start, end, lower)
    per_row = np.searchsorted(row, np.arange(chunk.rows + 1))
    return Words(start, end, row, hashed, per_row)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words starting at position 0, 1, ...;
    the caller drops runs that cross a row's end."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= MULT
        out += hashes[k:k + n]
    return mix(out)
