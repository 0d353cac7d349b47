"""Words and hashes of whole Arrow batches with numpy: no Python object per word, bounded working arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE = 1 << 18  # bytes whose 8-byte working arrays exist at one time
BASE = 0x9E3779B97F4A7C15 | 1
BACK = pow(BASE, -1, 1 << 64)
SPACES = b"\x20\t\n\x0b\x0c\r"
_powers = {BASE: np.ones(1, U64), BACK: np.ones(1, U64)}


def power(base: int, n: int) -> np.ndarray:
    """``base ** i`` for i < n, modulo 2**64."""
    if len(_powers[base]) < n:
        steps = np.full(n, base, U64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the whole word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and n + 1 offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def small(batches: Iterator[pa.RecordBatch], column: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        ends = texts(batch.column(column))[1]
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def byte_table(separators: bytes, lower: bool = False) -> np.ndarray:
    """What each byte adds to a hash: 0 for a separator, else the (lowered) byte + 1."""
    values = np.arange(1, 257, dtype=np.uint16)
    if lower:
        values[65:91] += 32
    values[list(separators)] = 0
    return values


def pieces(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that cut no word: they end at a separator or where a document ends."""
    lo = 0
    while lo < len(data):
        step = size
        while True:
            hi = min(lo + step, len(data))
            if hi == len(data):
                break
            gap = np.flatnonzero(table[data[lo:hi]] == 0)
            last = lo + int(gap[-1]) + 1 if len(gap) else lo
            last = max(last, int(offsets[np.searchsorted(offsets, hi, "right") - 1]))
            if last > lo:
                hi = last
                break
            step *= 2  # a single word of this length
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, document) of every word; documents never share a word."""
    starts, ends, hashes = [], [], []
    for lo, hi in pieces(data, offsets, table):
        value = table[data[lo:hi]]
        inside = value != 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi, "left")] - lo
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(hi - lo + 1, U64)
        np.cumsum(value * power(BASE, hi - lo), out=total[1:])
        hashes.append(mixed((total[e] - total[s]) * power(BACK, hi - lo)[s] + (e - s).astype(U64) * U64(BASE)))
        starts.append(s + lo)
        ends.append(e + lo)
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U64), none
    start = np.concatenate(starts)
    return start, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(offsets, start, "right") - 1


def windows(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of first word, hash) of every run of ``n`` words inside one document."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    at = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1])
    total = np.zeros(len(at), U64)
    for k in range(n):
        total += hashes[at + k] * U64(pow(BASE, 2 * k + 3, 1 << 64))
    return at, mixed(total)


def spans(owner: np.ndarray, n: int) -> np.ndarray:
    """n + 1 borders of the sorted owner column."""
    return np.searchsorted(owner, np.arange(n + 1))


def sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True bytes per document."""
    out = np.zeros(len(offsets) - 1, np.int64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(mask.view(np.uint8), offsets[:-1][full], dtype=np.int64)
    return out


def repeated(values: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: values found twice or more, and those equal to an earlier one (as masks)."""
    twice, later = np.zeros(len(values), bool), np.zeros(len(values), bool)
    for lo, hi in zip(borders[:-1], borders[1:], strict=True):
        if hi - lo > 1:
            part = values[lo:hi]
            order = np.argsort(part, kind="stable")
            ranked = part[order]
            same = ranked[1:] == ranked[:-1]
            if same.any():
                later[lo + order[1:][same]] = True
                twice[lo + order[1:][same]] = True
                twice[lo + order[:-1][same]] = True
    return twice, later
