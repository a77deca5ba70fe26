"""Word hashing over Arrow text buffers: numpy arithmetic on whole batches instead of per-word Python."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)                       # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CHUNK = 1 << 18                                            # bytes handled at a time

#: Word characters as byte tables (bytes from 0x80 up belong to words).
SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_powers = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1024), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_span(buf: np.ndarray, cuts: np.ndarray, table: np.ndarray):
    """(starts, ends, hashes) of the words of ``buf``; words never cross the offsets in ``cuts``."""
    inside = table[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    inner = cuts[(cuts > 0) & (cuts < len(buf))]
    first[inner] = inside[inner]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[inner - 1] = inside[inner - 1]
    ends = np.flatnonzero(last) + 1
    values = _LOWER[buf].astype(np.uint64) + np.uint64(1)
    values *= _power(_BASE, len(buf))
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values, out=total[1:])
    h = (total[ends] - total[starts]) * _power(_INVERSE, len(buf) + 1)[starts]
    return starts, ends, mix(h)


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, positions: bool = False):
    """Words of ``len(offsets) - 1`` texts lying in ``data`` (ASCII letters count as lower case).

    Returns (counts per text, hashes[, starts, ends]) with the texts' words one after another;
    starts and ends are byte positions in ``data``. Texts are handled about ``_CHUNK`` bytes at a
    time, a longer text is cut between words, so working memory does not grow with a text.
    """
    n = len(offsets) - 1
    counts = np.zeros(n, np.int64)
    hashes, starts, ends = [], [], []
    at, end, doc = int(offsets[0]), int(offsets[-1]), 0
    while at < end:
        to = min(at + _CHUNK, end)
        if to < end:                                        # move the cut behind the last separator
            gaps = np.flatnonzero(~table[data[at:to]])
            later = offsets[(offsets > at) & (offsets <= to)]
            cut = max(at + int(gaps[-1]) + 1 if len(gaps) else at, int(later[-1]) if len(later) else at)
            while cut == at:                                # one word longer than the chunk
                gaps = np.flatnonzero(~table[data[to:to + _CHUNK]])
                later = offsets[(offsets > to) & (offsets <= to + _CHUNK)]
                found = [to + int(gaps[0]) + 1] if len(gaps) else []
                found += [int(later[0])] if len(later) else []
                to = min(to + _CHUNK, end)
                cut = min(found) if found else (end if to == end else at)
            to = cut
        lo, hi = np.searchsorted(offsets, [at, to])
        s, e, h = _hash_span(data[at:to], offsets[lo:hi + 1] - at, table)
        counts += np.bincount(np.searchsorted(offsets, s + at, side="right") - 1, minlength=n)[:n]
        hashes.append(h)
        if positions:
            starts.append(s + at)
            ends.append(e + at)
        at = to
    cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
    out = (counts, cat(hashes, np.uint64))
    return (*out, cat(starts, np.int64), cat(ends, np.int64)) if positions else out


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` hashes (one for each start that has enough behind it)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out *= _BASE
        out += hashes[i:i + n]
    return mix(out)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string column without copying; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return body, offsets


def slices(offsets: np.ndarray, limit: int = 4 * _CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive (from, to) of texts with about ``limit`` bytes together (a longer one alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
