"""Arrow text columns as numpy arrays of words, for the operators that read whole texts.

Work goes in pieces of about ``PIECE`` bytes, so memory follows the piece and not the batch; a longer text is cut between
words and only its word arrays (not its bytes) are held together.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}

#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII that is neither a letter nor a digit.
NOT_ALNUM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True


class Words(NamedTuple):
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more offset than texts); null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def groups_of_rows(offsets: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows with at most ``most`` bytes (``PIECE``), or one longer row."""
    most = most or PIECE
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, min(high, rows)
        low = min(high, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 4096), base, np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.cumprod(steps)
    return have[:n]


def _cut(data: np.ndarray, offsets: np.ndarray, to: int, end: int, separators: np.ndarray) -> int:
    """The first place from ``to`` on that is no middle of a word."""
    limit = int(offsets[np.searchsorted(offsets, to, "left")]) if to < end else end
    while to < limit:
        window = separators[data[to:min(to + 65536, limit)]]
        if window.any():
            return to + int(window.argmax())
        to += len(window)
    return limit


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> Words:
    """Words of the texts between ``offsets``: index of the text, first byte, byte after the last, 64-bit hash."""
    found = []
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = _cut(data, offsets, min(at + PIECE, end), end, separators)
        part = data[at:to]
        apart = separators[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[0] = edge[-1] = True
        inside = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, to)]
        edge[inside - at] = True
        first = edge[:-1].copy()
        first[1:] |= apart[:-1]
        last = edge[1:].copy()
        last[:-1] |= apart[1:]
        start = np.flatnonzero(first & ~apart)
        stop = np.flatnonzero(last & ~apart) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(part)), out=sums[1:])
        found.append((start + at, stop + at, mixed((sums[stop] - sums[start]) * _power(_INVERSE, len(part) + 1)[start])))
        at = to
    if not found:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64))
    start, stop, hashes = (np.concatenate(x) for x in zip(*found))
    return Words(np.searchsorted(offsets, start, "right") - 1, start, stop, hashes)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words within one text, and the index of the first word of each."""
    n = len(w.row) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(w.row[:n] == w.row[size - 1:])
    run = np.zeros(len(first), np.uint64)
    for k in range(size):
        run = run * _BASE + w.hash[first + k]
    return mixed(run), first


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once, and is an equal one before it."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    again[order[1:][same]] = True
    return twice, again


def per_row(row: np.ndarray, rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Count, or sum of weights, by index of the text."""
    return np.bincount(row, weights, rows)


def within(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys that differ where the texts differ, so that equal ones of two texts are told apart."""
    return mixed(keys + row.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def repeated_windows(w: Words, size: int) -> np.ndarray:
    """For each word: is it in a run of ``size`` words that its text has more than once."""
    runs, first = windows(w, size)
    twice, _ = repeated(within(runs, w.row[first]))
    covered = np.zeros(len(w.row), bool)
    for k in range(size):
        covered[first[twice] + k] = True
    return covered


def sums(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """How many bytes of a kind each text has, a piece at a time."""
    out = np.zeros(len(offsets) - 1)
    for low, high in groups_of_rows(offsets):
        if high == low + 1 and offsets[high] - offsets[low] > PIECE:
            steps = range(int(offsets[low]), int(offsets[high]), PIECE)
            out[low] = sum(np.count_nonzero(kind[data[a:min(a + PIECE, int(offsets[high]))]]) for a in steps)
        else:
            upto = np.zeros(offsets[high] - offsets[low] + 1, np.int64)
            np.cumsum(kind[data[offsets[low]:offsets[high]]], out=upto[1:])
            out[low:high] = np.diff(upto[offsets[low:high + 1] - offsets[low]])
    return out
