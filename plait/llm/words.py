"""Vectorised words, word hashes and window hashes over Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which on UTF-8 text equals the code-point
pattern ``[^\\x20\\x09-\\x0D]+``.  Everything below works on the column's own byte buffer with numpy: no Python
object is made per word.  Memory is a small multiple of ``BLOCK`` bytes plus 8 to 24 bytes per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        _POW[0] = _powers(_BASE, n)
        _POW[1] = _powers(pow(_BASE, -1, 1 << 64), n)
    return _POW[0], _POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and n + 1 offsets into them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = 4 * BLOCK):
    """(first row, zero-copy slice) pieces of a column with about ``limit`` bytes each, one row at least."""
    _, at = text_bytes(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        yield row, column.slice(row, end - row)
        row = end


class Words:
    """The words of a column of texts: byte spans, and for each text the first word and the word after its last."""

    def __init__(self, column: pa.Array, lower: bool = False, gaps: np.ndarray = _SPACE):
        """``gaps`` tells for each byte whether it parts words."""
        raw, at = text_bytes(column)
        self.raw = _LOWER[raw] if lower else raw
        self.at = at
        inside = np.empty(len(raw) + 2, dtype=bool)
        inside[0] = inside[-1] = False
        np.logical_not(gaps[raw], out=inside[1:-1])
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        cut = at[1:-1]
        cut = cut[(cut > 0) & (cut < len(raw))]
        both = cut[inside[cut] & inside[cut + 1]]  # a text ends and the next begins within a run
        begins[both] = True
        ends[both - 1] = True
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        return span_hashes(self.raw, self.start, self.end)

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each k-word window within one text, index of its first word)."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = rolled(hashes, k)
        ok = np.ones(n, bool)
        for cut in self.first[1:-1]:
            ok[max(0, cut - k + 1) : min(cut, n)] = False
        at = np.flatnonzero(ok)
        return out[at], at

    def text(self, i: int, j: int) -> bytes:
        """The bytes from word i to word j - 1, white space between them included."""
        return self.raw[self.start[i] : self.end[j - 1]].tobytes()


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each of the ascending, non-overlapping byte spans, by a polynomial over the bytes, worked off in blocks."""
    out, i, n = np.empty(len(start), np.uint64), 0, len(start)
    while i < n:
        low = start[i]
        j = max(i + 1, int(np.searchsorted(end, low + BLOCK, side="right")))
        high = int(end[j - 1])
        power, inverse = _tables(max(BLOCK, high - low) + 1)
        total = np.empty(high - low + 1, np.uint64)
        total[0] = 0
        np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=total[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k hashes, each bound to its place in the run; log2(k) vector passes."""
    n = len(hashes) - k + 1
    done, width, out, shift = None, 0, hashes, 1
    while True:
        if k & shift:
            done = out[:n].copy() if done is None else mix(done * np.uint64(0xD6E8FEB86659FD93) + out[width : width + n])
            width += shift
        shift <<= 1
        if shift > k:
            return mix(done + np.uint64(k))
        half = shift >> 1
        out = mix(out[: len(out) - half] * np.uint64(0xA0761D6478BD642F) + out[half:])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
