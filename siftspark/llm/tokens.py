"""Words of whole texts as Arrow arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame

#: Bytes of text in one piece, unless a single text is longer.
PIECE = 4 << 20
#: Bytes from which a word is hashed by itself.
LONG_WORD = 4096
#: Masks of the 0 to 8 low bytes of a number.
LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, done = 0, 0
        while start < batch.num_rows:
            end = max(int(np.searchsorted(size, done + limit, side="right")), start + 1)
            yield batch.slice(start, end - start)
            start, done = end, int(size[end - 1])


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """Texts, null as empty; large offsets, as one slice may be long.

    The copy starts at the first byte of its buffer: Arrow's ascii_lower writes wrong offsets
    for large strings that start elsewhere.
    """
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    return pa.concat_arrays([texts, pa.array([], pa.large_string())])


def words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased, and offsets by text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, ends = parts.flatten(), np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full), np.concatenate([[0], kept[ends]]) if len(ends) else np.zeros(1, np.int64)


def hashed(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, eight bytes at a time for all strings together."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    _, offsets, data = flat.buffers()
    kind = np.int64 if pa.types.is_large_string(flat.type) else np.int32
    ends = np.frombuffer(offsets, kind)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    start, n = ends[:-1] - ends[0], np.diff(ends)
    h = mixed(n.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at = np.arange(len(n))
    for done in range(0, min(int(n.max()), LONG_WORD) + 1, 8):
        left = n[at] - done
        word = eight[start[at] + done] & LOW_BYTES[np.minimum(left, 8)]
        h[at] = mixed(h[at] ^ word)
        at = at[(left > 8) & (n[at] <= LONG_WORD)]
        if not len(at):
            break
    for i in np.flatnonzero(n > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(raw[start[i] : start[i] + n[i]].tobytes())
    return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... n[0] numbers, then start[1] and so on."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(x: np.ndarray) -> bytes:
    """Numbers byte by byte of equal weight, compressed."""
    return _ZIP.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes())


def unpack(b: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(_UNZIP.decompress(b), np.uint8)
    return raw.reshape(np.dtype(dtype).itemsize, -1).T.copy().view(dtype).ravel()


def squeeze(x: np.ndarray) -> bytes:
    """Numbers of zero or more, in as many bytes each as the largest takes, compressed."""
    most = int(x.max()) if len(x) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + pack(x.astype(kind))


def expand(b: bytes) -> np.ndarray:
    """The numbers that :func:`squeeze` took, as 64-bit integers."""
    return unpack(b[1:], np.dtype(f"u{b[0]}")).astype(np.int64)


def runs(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has a new value."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


#: An array that many tasks add to goes to the driver in so many slices, those that are not all zero.
SLICES = 64
SLICED = "k int, v binary"


def sliced(x: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The slices (k, v) of an array of numbers below 2 ** 32."""
    for k, part in enumerate(x.reshape(SLICES, -1)):
        if part.any():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([pack(part.astype(np.uint32))])], names=["k", "v"])


def added(parts: DataFrame, size: int, most: int = 2**32 - 1) -> np.ndarray:
    """Sum of arrays of a fixed size from their slices, cut at ``most``; slices meet by number, and one array comes back."""

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(size // SLICES, np.int64)
        for v in part.column("v").to_pylist():
            total += unpack(v, np.uint32)
        return pa.table({"k": part.column("k").slice(0, 1), "v": pa.array([pack(np.minimum(total, most).astype(np.uint32))])})

    out = np.zeros((SLICES, size // SLICES), np.uint32)
    for r in parts.select("k", "v").groupBy("k").applyInArrow(add, SLICED).collect():
        out[r["k"]] = unpack(r["v"], np.uint32)
    return out.ravel()


class Filter:
    """A bit for each slot that one of many 64-bit numbers falls into: no number is missed, a few others may pass.

    It has sixteen bits for each number, but ``most`` at most: beyond that more pass, which costs time and changes no result.
    """

    def __init__(self, bits: np.ndarray) -> None:
        self.packed, self.size = np.packbits(bits), len(bits)

    def has(self, x: np.ndarray) -> np.ndarray:
        slot = slots_of(x, self.size)
        return (self.packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def slots_of(x: np.ndarray, size: int) -> np.ndarray:
    return (mixed(x.view(np.uint64)) % np.uint64(size)).astype(np.int64)


def filter_of(numbers: DataFrame, most: int = 1 << 26) -> Filter:
    """The filter of the numbers in one column of a written table."""
    n = numbers.count()
    size = min(most, 1 << max(12, (16 * n).bit_length()))

    def fall(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_ = np.zeros(size // 32, np.int64)
        seen = np.zeros(size, bool)
        for batch in batches:
            seen[slots_of(batch.column(0).to_numpy(zero_copy_only=False), size)] = True
        words_[:] = np.packbits(seen).view(">u4")
        yield from sliced(words_)

    return Filter(np.unpackbits(_either(numbers.mapInArrow(fall, SLICED), size // 32).astype(">u4").view(np.uint8)).astype(bool))


def _either(parts: DataFrame, size: int) -> np.ndarray:
    """Bitwise or of arrays from their slices."""

    def join(part: pa.Table) -> pa.Table:
        total = np.zeros(size // SLICES, np.uint32)
        for v in part.column("v").to_pylist():
            total |= unpack(v, np.uint32)
        return pa.table({"k": part.column("k").slice(0, 1), "v": pa.array([pack(total)])})

    out = np.zeros((SLICES, size // SLICES), np.uint32)
    for r in parts.groupBy("k").applyInArrow(join, SLICED).collect():
        out[r["k"]] = unpack(r["v"], np.uint32)
    return out.ravel()
