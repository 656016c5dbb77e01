"""Ragged-array text kernels shared by the training-data operators.

A batch of texts is one flat ``uint8`` array plus row offsets, taken from Arrow without copying into Python strings.
Words, shingles and n-grams are then ranges over that array and every step is a numpy pass.  Word characters are
everything but the six ASCII white-space bytes ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a single longer text is worked on alone.
CHUNK_BYTES = 1 << 19
#: Bytes that are hashed at once.
BLOCK = 1 << 17

#: Hashes are polynomials modulo this prime, with two bases: no fixed pair of texts collides but by the choice of the bases.
PRIME = (1 << 31) - 1
_P, _SHIFT = np.uint64(PRIME), np.uint64(31)

_rng = np.random.default_rng(20240229)
_MULT = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASES = [int(x) for x in _rng.integers(1 << 20, PRIME - 1, 2)]
_BYTE = [_rng.integers(1, PRIME, 256).astype(np.uint64) for _ in _BASES]
_FAST_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_FAST_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_tables: dict = {}


def _family(seed: int) -> tuple[list[int], list[np.ndarray]]:
    """Bases and byte values of a family of hashes; 0 is the usual one."""
    if not seed:
        return _BASES, _BYTE
    rng = np.random.default_rng([20240229, seed])
    return [int(x) for x in rng.integers(1 << 20, PRIME - 1, 2)], [rng.integers(1, PRIME, 256).astype(np.uint64) for _ in range(2)]


def _fold(x: np.ndarray) -> np.ndarray:
    """Something smaller that is equal modulo the prime."""
    return (x & _P) + (x >> _SHIFT)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= _P, x - _P, x)


def _kept(key, n: int, make) -> np.ndarray:
    """The first n of a growing sequence, held while it is small."""
    have = _tables.get(key)
    if have is None or len(have) < n:
        have = make(max(n, CHUNK_BYTES + 8))
        if len(have) <= 4 * CHUNK_BYTES:
            _tables[key] = have
    return have[:n]


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base modulo the prime, by doubling."""

    def make(size: int) -> np.ndarray:
        out = np.ones(size, dtype=np.uint64)
        have = 1
        while have < size:
            more = min(have, size - have)
            out[have : have + more] = _reduced(out[:more] * np.uint64(pow(base, have, PRIME)))
            have += more
        return out

    return _kept(base, n, make)


def _fast_powers(base: int, n: int) -> np.ndarray:
    def make(size: int) -> np.ndarray:
        step = np.full(size, np.uint64(base), dtype=np.uint64)
        step[0] = 1
        return np.multiply.accumulate(step)

    return _kept(("fast", base), n, make)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (a bijection of xor-shifts and odd multiplications)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_large_string(column.type) or kind is np.int32 and pa.types.is_string(column.type) else b"")
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batch whose texts sum to about ``limit`` bytes, with their bytes and offsets."""
    n, start = batch.num_rows, 0
    if not n:
        return
    flat, off = buffers(batch.column(text))
    while start < n:
        stop = int(np.searchsorted(off, off[start] + limit, "right")) - 1
        stop = min(n, max(stop, start + 1))
        yield batch.slice(start, stop - start), flat[off[start] : off[stop]], off[start : stop + 1] - off[start]
        start = stop


def words(flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and offsets of each row's words."""
    space = _SPACE[flat]
    n = len(flat)
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    word = ~space
    begins, ends = word.copy(), word.copy()
    if n:
        begins[1:] &= space[:-1] | edge[1:n]
        ends[:-1] &= space[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


def prefix_hash(flat: np.ndarray, lower: bool = False, seed: int = 0) -> np.ndarray:
    """Sums of byte values times powers of the base, for both bases; entry i of a row covers the first i bytes."""
    bases, values = _family(seed)
    out = np.zeros((len(bases), len(flat) + 1), dtype=np.uint64)
    for i, base in enumerate(bases):
        table = values[i][_LOWER] if lower else values[i]
        powers = _powers(base, len(flat))
        for at in range(0, len(flat), BLOCK):  # what stands in between is small, however long the text
            part = out[i, at + 1 : at + 1 + BLOCK]
            np.cumsum(_fold(table[flat[at : at + BLOCK]] * powers[at : at + BLOCK]), out=part)
            part += out[i, at]
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each range of bytes, the same wherever the range stands: both polynomials in 62 bits, mixed with the length."""
    parts = []
    for i, base in enumerate(_family(seed)[0]):
        back = _powers(pow(base, -1, PRIME), prefix.shape[1])[starts]
        parts.append(_reduced(_fold(prefix[i, ends] - prefix[i, starts]) * back))
    return mix((parts[0] << _SHIFT | parts[1]) + (ends - starts).astype(np.uint64) * _MULT[63])


def quick_prefix(flat: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes modulo 2**64: quick, for uses in which bytes decide afterwards."""
    prefix = np.zeros(len(flat) + 1, dtype=np.uint64)
    np.cumsum(_FAST_BYTE[flat] * _fast_powers(_FAST_BASE, len(flat)), out=prefix[1:])
    return prefix


def quick_range(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A quick hash of each range of bytes: equal bytes have equal hashes, not the other way round."""
    return (prefix[ends] - prefix[starts]) * _fast_powers(pow(_FAST_BASE, -1, 1 << 64), len(prefix))[starts]


def window_keys(flat: np.ndarray, width: int) -> np.ndarray:
    """A quick key of each ``width`` neighbouring bytes."""
    prefix = quick_prefix(flat)
    n = len(flat) - width + 1
    return mix((prefix[width:] - prefix[:n]) * _fast_powers(pow(_FAST_BASE, -1, 1 << 64), n))


def agree(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the bytes of each range equal those of the range with number ``other``."""
    size = ends - starts
    same = size == size[other]
    test = np.flatnonzero(same & (other != np.arange(len(size))) & (size > 0))
    if len(test):
        n = size[test]
        cuts = np.cumsum(n) - n
        inner = np.arange(int(n.sum())) - np.repeat(cuts, n)
        differ = flat[np.repeat(starts[test], n) + inner] != flat[np.repeat(starts[other[test]], n) + inner]
        same[test] &= np.add.reduceat(differ, cuts) == 0
    return same


def word_hashes(flat: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and offsets of each row's words."""
    starts, ends, rows = words(flat, off)
    return range_hash(prefix_hash(flat, lower), starts, ends), rows


def word_ids(flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, the same for equal words only (A-Z lower-cased), and offsets of each row's words.

    Words meet by their hashes and are then compared by their bytes; should hashes of different words agree, the bytes decide.
    """
    low = _LOWER[flat]
    starts, ends, rows = words(flat, off)
    _, first, ids = np.unique(range_hash(prefix_hash(low), starts, ends), return_index=True, return_inverse=True)
    if not agree(low, starts, ends, first[ids]).all():
        known: dict = {}
        data = low.tobytes()
        ids = np.fromiter((known.setdefault(data[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts))
    return ids.astype(np.int64), rows


def gram_ids(ids: np.ndarray, rows: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the k-word shingles, the same for equal ones only, and the row of each; a row of fewer words, but some, is one shingle."""
    n = np.diff(rows)
    none = np.int64(ids.max() + 1 if len(ids) else 0)
    size = np.where((n > 0) & (n < k), k, n)  # short rows are filled up with a number that is no word's
    cuts = np.concatenate([[0], np.cumsum(size)])
    filled = np.full(int(cuts[-1]), none, dtype=np.int64)
    filled[np.arange(len(ids)) + np.repeat(cuts[:-1] - rows[:-1], n)] = ids
    total = len(filled) - k + 1
    if total <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gram = filled[:total]
    for j in range(1, k):
        _, gram = np.unique(gram * (none + 1) + filled[j : j + total], return_inverse=True)
    row = np.repeat(np.arange(len(n)), size)[:total]
    inside = row == np.repeat(np.arange(len(n)), size)[k - 1 :]
    return gram[inside].astype(np.int64), row[inside]


def shared_shingles(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact sizes of the shingle sets of each text of a and of b, and of what the i-th ones share; a and b are bytes and offsets."""
    pairs = len(a[1]) - 1
    ids, rows = word_ids(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1][1:] + len(a[0])]))
    gram, row = gram_ids(ids, rows, k)
    several = np.int64(gram.max() + 1 if len(gram) else 1)
    each = np.unique(row * several + gram)  # a shingle once a text
    owner, gram = each // several, each % several
    n = np.bincount(owner, minlength=2 * pairs)
    meet = np.sort(owner % pairs * several + gram) if pairs else each
    both = meet[1:][meet[1:] == meet[:-1]] // several
    return n[:pairs], n[pairs:], np.bincount(both, minlength=pairs)


def grams(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's k-word windows and the row of each; none for a row of fewer words."""
    n = np.diff(rows)
    counts = np.maximum(n - k + 1, 0)
    total = len(hashes) - k + 1
    if total <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = np.zeros(total, dtype=np.uint64)
    for j in range(k):
        out += hashes[j : j + total] * _MULT[j]
    row = np.repeat(np.arange(len(n)), counts)
    at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(rows[:-1], counts)
    return mix(out[at] + np.uint64(int(_MULT[62]) * k & (2**64 - 1))), row


def order_in_rows(value: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Order by row and value: one sort of the row with the value's upper bits, and a full one only where those don't tell values apart."""
    bits = max(1, int(row.max()).bit_length()) if len(row) else 1
    packed = row.astype(np.uint64) << np.uint64(64 - bits) | value >> np.uint64(bits)
    order = np.argsort(packed)
    packed, sorted_ = packed[order], value[order]
    if ((packed[1:] == packed[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
        return np.lexsort((value, row))
    return order


def shingle_sets(flat: np.ndarray, off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row in ascending hash order, and each row's offsets.

    A row with fewer than k words, but some, has its whole sequence as its one shingle.
    """
    hashes, rows = word_hashes(flat, off)
    n = np.diff(rows)
    value, row = grams(hashes, rows, k)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = n[short] > j
            extra[has] += hashes[rows[short[has]] + j] * _MULT[j]
        value = np.concatenate([value, mix(extra + _MULT[62] * n[short].astype(np.uint64))])
        row = np.concatenate([row, short])
    order = order_in_rows(value, row)
    value, row = value[order], row[order]
    if len(value):
        new = np.empty(len(value), dtype=bool)
        new[0] = True
        new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
        value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(off)))


def row_sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of each row's values (wrapping for unsigned integers)."""
    total = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=total[1:])
    return total[rows[1:]] - total[rows[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
