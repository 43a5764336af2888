"""Vectorised word hashing over Arrow text columns, shared by the operators on words.

Words are runs of bytes other than the six ASCII white-space bytes (0x20,
0x09-0x0D) in UTF-8 text with A-Z lower-cased. They are represented by 64-bit
hashes; two given words collide with a probability of about 2**-57.
"""

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: White space and every other ASCII byte but letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += np.uint64(32)
LOWER += np.uint64(1)

_powers = {"table": np.zeros(0, np.uint64)}


def mix(x):
    """The finaliser of splitmix64: a bijection of 64-bit numbers that spreads all bits."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def randoms(n, seed=0):
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(steps + np.uint64(seed))


def _factors(n):
    """Multipliers by position in a word, grown to the longest word met."""
    if len(_powers["table"]) < n:
        _powers["table"] = randoms(max(n, 256), seed=77) | np.uint64(1)
    return _powers["table"]


def column_bytes(column):
    """(bytes, offsets) of a string array; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column, most=4 << 20):
    """(first row, one past the last row) of runs of rows with about ``most`` bytes of text."""
    offsets = column_bytes(column)[1]
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def word_hashes(column, apart=SPACE):
    """(hashes of all words in order, offsets of the rows in them); ``apart`` marks the bytes between words."""
    data, offsets = column_bytes(column)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~apart[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = solid[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.arange(n, dtype=np.int64)
    lengths = np.diff(np.append(starts, n))
    place = at[starts[0] :] - np.repeat(starts, lengths)
    # Only solid bytes count, so a place beyond the longest word never matters.
    solid_place = np.where(solid[starts[0] :], place, 0)
    table = _factors(int(solid_place.max()) + 1)
    with np.errstate(over="ignore"):
        values = LOWER[data[starts[0] :]] * table[solid_place]
        values[~solid[starts[0] :]] = 0
        sums = np.add.reduceat(values, starts - starts[0])
    return mix(sums), np.searchsorted(starts, offsets)


def shingle_hashes(words, offsets, size):
    """(hashes of all shingles in order, offsets of the rows).

    A row with fewer words than ``size`` has one shingle of all of them; a row
    without words has none.
    """
    counts = np.diff(offsets)
    out = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    to = np.concatenate([[0], np.cumsum(out)])
    factors = randoms(size, seed=5) | np.uint64(1)
    total = int(to[-1])
    row = np.repeat(np.arange(len(counts)), out)
    first = np.arange(total) - to[row] + offsets[row]
    acc = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            inside = first + j < offsets[row + 1]
            at = np.where(inside, first + j, 0)
            acc += np.where(inside, mix(words[at] ^ factors[j]) if total else acc, np.uint64(j + 1)) * factors[j]
    return mix(acc), to


def distinct_per_row(hashes, offsets):
    """The distinct hashes of each row, sorted within it, and the rows' offsets in them."""
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[keep], r[keep]
    return h, np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(counts)))])
