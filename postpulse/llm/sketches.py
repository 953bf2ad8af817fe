"""Count-min sketches and filters over 64-bit hashes, built by partition and merged.

A partition's counts travel as the ascending list of its cells, which is what a
sketch of few values comes to, and are added up range by range. Only flags of a
bounded number of bits reach the driver and, from there, the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import map_batches, mixed

RANGE_BITS = 19  # cells of a range of the sketch, merged at a time
CHUNK_VALUES = 6_000_000
LISTS = "row int, range int, blob binary"


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each hash in a row of a sketch with 2 ** bits cells."""
    salted = hashes if row == 0 else mixed(hashes + np.uint64(row))
    found = salted >> np.uint64(64 - bits)
    return found.astype(np.uint32) if bits <= 32 else found


def varint(ascending: np.ndarray) -> bytes:
    """Distances of ascending numbers, seven bits to a byte."""
    gaps = np.diff(ascending.astype(np.int64), prepend=0)
    length = np.ones(len(gaps), np.int64)
    for bits in (7, 14, 21, 28):
        length += gaps >= 1 << bits
    ends = np.cumsum(length)
    out = np.empty(int(length.sum()), np.uint8)
    for k in range(5):
        has = length > k
        more = np.where(length[has] > k + 1, 0x80, 0)
        out[ends[has] - length[has] + k] = ((gaps[has] >> (7 * k)) & 0x7F) | more
    return out.tobytes()


def unvarint(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8)
    last = np.flatnonzero(raw < 0x80)
    first = np.concatenate([[0], last[:-1] + 1])
    gaps = np.zeros(len(last), np.int64)
    for k in range(5):
        has = last - first >= k
        gaps[has] |= (raw[first[has] + k].astype(np.int64) & 0x7F) << (7 * k)
    return np.cumsum(gaps)


def sketch_lists(
    texts: DataFrame,
    hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
    bits: int,
    depth: int,
    fine: int = 0,
) -> DataFrame:
    """(row, range, blob): the cells, of 2 ** (bits + fine), that each partition's hashes fall into."""
    span = RANGE_BITS + fine

    def parts(batches):
        held, size = [[] for _ in range(depth)], 0

        def flush():
            out = {"row": [], "range": [], "blob": []}
            for row in range(depth):
                found = np.sort(np.concatenate(held[row]))
                held[row].clear()
                ranges = found >> found.dtype.type(span)
                borders = np.searchsorted(ranges, np.arange((1 << bits - RANGE_BITS) + 1))
                for k in np.flatnonzero(np.diff(borders)).tolist():
                    own = found[borders[k] : borders[k + 1]].astype(np.int64)
                    out["row"].append(row)
                    out["range"].append(k)
                    out["blob"].append(varint(own - (k << span)))
            return out

        for batch in batches:
            for hashes in hashes_of(batch):
                for row in range(depth):
                    held[row].append(cells(hashes, row, bits + fine))
                size += len(hashes)
                if size >= CHUNK_VALUES:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return map_batches(texts, parts, LISTS)


def merged_flags(
    lists: DataFrame,
    bits: int,
    depth: int,
    flags: Callable[[np.ndarray], np.ndarray],
    width: int,
    fine: int = 0,
) -> list[np.ndarray]:
    """`flags` of the merged counts, `width` bits a cell (packed), for each row.

    Lists of a range are added one after the other, so a task holds one range's counts.
    Of lists of finer cells, a task holds one range's values, and a cell has the largest of its
    2 ** fine cells' flags, which must be 0 for a count of 0.
    The driver holds depth * 2 ** bits * width / 8 bytes.
    """
    dealt = lists.repartition("row", "range").sortWithinPartitions("row", "range")

    def merge(batches):
        own, counts = None, None

        def done():
            bits_ = largest_flags(counts, flags, fine) if fine else flags(counts)
            planes = [np.packbits((bits_ >> k) & 1) for k in range(width)]
            blob = np.concatenate(planes).tobytes()
            return {"row": [own[0]], "range": [own[1]], "blob": [blob]}

        for batch in batches:
            for row, part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != (row, part):
                    if own:
                        yield done()
                    own, counts = (row, part), [] if fine else np.zeros(1 << RANGE_BITS, np.uint32)
                found = unvarint(blob)
                if fine:
                    counts.append(found.astype(np.uint32))
                    continue
                counts += np.bincount(found, minlength=1 << RANGE_BITS).astype(np.uint32)
        if own:
            yield done()

    size = 1 << RANGE_BITS - 3
    merged = [np.zeros((width, 1 << bits - 3), np.uint8) for _ in range(depth)]
    for found in map_batches(dealt, merge, LISTS).toLocalIterator():
        at = found["range"] * size
        planes = np.frombuffer(found["blob"], np.uint8).reshape(width, size)
        merged[found["row"]][:, at : at + size] = planes
    return merged


def largest_flags(
    found: list[np.ndarray], flags: Callable[[np.ndarray], np.ndarray], fine: int
) -> np.ndarray:
    """For each cell of a range, the largest flag of its 2 ** fine cells, from the lists of these."""
    values = np.sort(np.concatenate(found))
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    own = flags(np.diff(np.append(first, len(values))))
    cell = values[first] >> np.uint32(fine)
    new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    out = np.zeros(1 << RANGE_BITS, own.dtype)
    out[cell[new]] = np.maximum.reduceat(own, new)
    return out


def look_up(plane: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """The bit of each cell in a packed plane."""
    return (plane[cell >> np.uint32(3)] >> (~cell & np.uint32(7)).astype(np.uint8)) & np.uint8(1)


def membership(blobs: DataFrame, bits: int) -> np.ndarray:
    """Packed marks of the cells of all values in a binary column of packed 64-bit values.

    2 ** bits bits in all, whatever their number. The partitions' cells are merged range
    by range, so the driver is sent each bit once.
    """

    def cell_lists(batches):
        marks = np.zeros(1 << bits, bool)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                marks[cells(mixed(np.frombuffer(blob, np.uint64)), 0, bits)] = True
        found = np.flatnonzero(marks)
        ranges = found >> RANGE_BITS
        out = {"row": [], "range": [], "blob": []}
        for own in np.split(found, np.flatnonzero(np.diff(ranges)) + 1):
            if len(own):
                part = int(own[0]) >> RANGE_BITS
                out["row"].append(0)
                out["range"].append(part)
                out["blob"].append(varint(own - (part << RANGE_BITS)))
        yield out

    lists = map_batches(blobs, cell_lists, LISTS)
    return merged_flags(lists, bits, 1, lambda counts: (counts > 0).astype(np.uint8), 1)[0][0]


def may_hold(marks: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value may be among those that `membership` marked."""
    bits = int(np.log2(len(marks))) + 3
    return look_up(marks, cells(mixed(values.view(np.uint64)), 0, bits)) > 0
