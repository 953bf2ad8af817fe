"""Words, word hashes and Arrow batches that the document operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MOST_CACHED = 500_000


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [b"" if text is None else text for text in column.to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all bits (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, offsets: list[int]) -> np.ndarray:
    """One hash per window start, of the words at `offsets` from it."""
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = mixed(np.arange(1, len(offsets) + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    for at, factor in zip(offsets, factors, strict=True):
        total += hashes[at : at + n] * factor
    return mixed(total)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """One hash per window of `length` neighbouring words, by doubling the length."""
    factor = np.uint64(0x9E3779B97F4A7C15)
    whole, done, power, size = None, 0, hashes, 1
    while True:
        if length & size:
            if whole is None:
                whole = power
            else:
                tail = power[done:]
                whole = mixed(whole[: len(tail)] * factor + tail)
            done += size
        if done == length:
            return whole
        power = mixed(power[: len(power) - size] * factor + power[size:])
        size *= 2


BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
TAKEN = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def hash_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and the number of the text that it is in.

    Words are runs of anything but ASCII white space. They are hashed eight bytes at
    a time over the whole list, without a Python object for each.
    """
    joined = b"\n".join([*texts, b"\0" * 8])
    raw = np.frombuffer(joined, np.uint8)
    used = len(raw) - 8
    blank = BLANK[raw[:used]]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if used and not blank[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]  # the line end before the padding ends the last word
    length = ends - starts
    eight = np.ndarray(used + 1, "<u8", joined, strides=(1,))
    hashes = mixed(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    left, at, which = length, starts, slice(None)
    while len(left):
        part = eight[at] & TAKEN[np.minimum(left, 8)]
        hashes[which] = mixed(hashes[which] * np.uint64(0x9E3779B97F4A7C15) + part)
        more = np.flatnonzero(left > 8)
        which = more if isinstance(which, slice) else which[more]
        at, left = at[more] + 8, left[more] - 8
    first = np.cumsum([0, *(len(text) + 1 for text in texts)])
    return hashes, np.searchsorted(first, starts, "right") - 1


def unused(df: DataFrame, *names: str) -> list[str]:
    """`names`, each with as many underscores behind it as no column of `df` needs to clash."""
    taken = {name.lower() for name in df.columns}
    return [next(new for k in count() if (new := name + "_" * k).lower() not in taken) for name in names]


def portions(sizes: list[int], limit: int) -> Iterator[slice]:
    """Neighbouring rows of about `limit` bytes in all; a larger row is alone with what went before."""
    start = total = 0
    for k, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield slice(start, k + 1)
            start, total = k + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def map_batches(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """Arrow batches of `df` through `rows`, which yields dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for columns in rows(batches):
            arrays = [pa.array(columns[f.name], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)
