"""Vectorised text scanning inside tasks: word bounds, rolling hashes, winnowed window runs.

Texts reach the tasks as Arrow batches. Every helper works on one flat buffer
that holds the texts of some rows one after another, so numpy is called once
per chunk and not once per row. All hashes are polynomials modulo 2**64 with
fixed odd bases, mixed at the end; equal content gives equal hashes in every
process.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_U = np.uint64
_BASE = {"byte": 0x9E3779B97F4A7C15, "unit": 0xD1342543DE82EF95}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x632BE59BD9B4E019))


def _pow(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; tables for more than a chunk are not kept."""
    have = _powers.get(kind)
    if have is not None and len(have[0]) >= n:
        return have
    size = max(n, CHUNK_BYTES + 1024)
    out = []
    for b in (_BASE[kind], pow(_BASE[kind], -1, 1 << 64)):
        p = np.full(size, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    if size == CHUNK_BYTES + 1024:
        _powers[kind] = (out[0], out[1])
    return out[0], out[1]


class Rolling:
    """Hash of any range of a sequence of 64-bit codes, from prefix sums."""

    def __init__(self, codes: np.ndarray, kind: str):
        up, self._down = _pow(kind, len(codes) + 1)
        self._sum = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * up[: len(codes)], out=self._sum[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        n = len(self._sum) - k
        return mix((self._sum[k:] - self._sum[:n]) * self._down[:n] + _U(k))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """(first row, last row + 1, bytes, offsets) of slices of a string column.

    A slice holds whole texts and at most ``limit`` bytes unless one text is
    longer than that. Null texts are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + n + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        lens = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        parts = [flat[a: a + k] for a, k in zip(offsets[:-1], lens) if k]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        offsets = np.concatenate([[0], np.cumsum(lens)])
    row = 0
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), n)
        yield row, last, flat[offsets[row]: offsets[last]], offsets[row: last + 1] - offsets[row]
        row = last


def words(data: np.ndarray, offsets: np.ndarray):
    """Start, end and row of every word; a row's end also ends a word."""
    n = len(data)
    inside = ~SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Rolling(BYTE_CODE[data], "byte").ranges(start, end)


def _slide_min(x: np.ndarray, w: int) -> np.ndarray:
    have = 1
    while have < w:
        step = min(have, w - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def window_runs(codes: np.ndarray, row: np.ndarray, gram: int, width: int):
    """Windows of ``width`` codes, grouped into runs that share an anchor.

    The anchor of a window is its smallest ``gram``-code hash (leftmost of
    ties), so it depends on the window's content alone and equal windows have
    equal anchors at equal offsets. Returns None when no row has a window,
    else (rolling hash, anchor, first window, last window + 1): window j covers
    codes j .. j+width.
    """
    n = len(codes)
    if n < width:
        return None
    roll = Rolling(codes, "unit")
    grams = roll.grams(gram)
    bits = _U(max(1, int(n).bit_length()))
    key = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_slide_min(key, width - gram + 1) & ((_U(1) << bits) - _U(1))).astype(np.int64)
    valid = row[width - 1:] == row[: n - width + 1]
    first = valid.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    j0 = np.flatnonzero(first)
    if not len(j0):
        return None
    last = valid.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
    # a run also ends where the next window belongs to another row
    j1 = np.flatnonzero(last) + 1
    return roll, grams, anchor[j0], j0, j1
