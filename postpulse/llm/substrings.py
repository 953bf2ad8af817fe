"""Substring dedup: words of windows that start earlier elsewhere are removed.

Two passes over the texts. In the first each partition counts its windows in a
count-min sketch; the sketches are merged by ranges of their cells, which never
underestimates a count. In the second only windows that the merged sketch puts at
two or more are grouped exactly, by their hash; the others occur once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.sources import materialise

from .sketches import cells, look_up, may_hold, membership, merged_flags, sketch_lists
from .words import hash_texts, map_batches, run_hashes, texts_of

WINDOW = 20
DEPTH = 2
LEAST_BITS, MOST_BITS = 20, 30
MARK_BITS = 26
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 32
CHUNK_WINDOWS = 1_000_000
DOCS_AT_ONCE = 250
PACKED = "kind int, part int, hashes binary, ids binary, tags binary, starts binary"


def windows_of(
    texts: list[bytes], window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of the text and start of every window."""
    words, doc = hash_texts(texts)
    if len(words) < window:
        return words[:0], doc[:0], doc[:0]
    hashes = run_hashes(words, window)
    at = np.flatnonzero(doc[: len(hashes)] == doc[window - 1 :])
    start = at - np.searchsorted(doc, doc[at])
    return hashes[at], doc[at], start


def repeated_cells(texts: DataFrame, total: int, window: int) -> tuple[int, list[np.ndarray]]:
    """Bits and, for each row of the sketch, one bit per cell: estimated at two or more.

    The sketch has about two cells a word, up to 2 ** MOST_BITS of them, so the
    driver never holds more than DEPTH * 2 ** (MOST_BITS - 3) bytes of it. Of more
    words it lets more windows through to the exact pass, and loses none.
    """
    bits = int(np.clip(np.ceil(np.log2(max(total / 6, 1))), LEAST_BITS, MOST_BITS))

    def hashes(batch):
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            yield windows_of(texts_of(batch.slice(at, DOCS_AT_ONCE)), window)[0]

    lists = sketch_lists(texts, hashes, bits, DEPTH)
    flags = merged_flags(lists, bits, DEPTH, lambda n: (n >= 2).astype(np.uint8), 1)
    return bits, [planes[0] for planes in flags]


def seen_twice(hashes: np.ndarray, bits: int, flags: list[np.ndarray]) -> np.ndarray:
    passed = np.ones(len(hashes), bool)
    for row, plane in enumerate(flags):
        passed &= look_up(plane, cells(hashes, row, bits)) > 0
    return passed


def packed(kind: int, part: np.ndarray, parts: int, hashes, ids, tags, starts) -> dict:
    """One row for each value of `part`, its arrays as bytes."""
    order = np.argsort(part, kind="stable")
    borders = np.searchsorted(part[order], np.arange(parts + 1))
    out = {name: [] for name in ("kind", "part", "hashes", "ids", "tags", "starts")}
    for k in np.flatnonzero(np.diff(borders)):
        own = order[borders[k] : borders[k + 1]]
        out["kind"].append(kind)
        out["part"].append(int(k))
        out["hashes"].append(b"" if hashes is None else hashes[own].tobytes())
        out["ids"].append(ids[own].tobytes())
        out["tags"].append(tags[own].tobytes())
        out["starts"].append(starts[own].astype(np.int32).tobytes())
    return out


def earliest(hashes, ids, tags, starts):
    """The places sorted by hash and place, and marks: first of its hash; later than that.

    Rows that agree in id and tag are one document, so a place equal to the first is
    neither.
    """
    order = np.lexsort((starts, tags, ids, hashes))
    hashes, ids, tags, starts = (x[order] for x in (hashes, ids, tags, starts))
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    at = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (ids != ids[at]) | (tags != tags[at]) | (starts != starts[at])
    return (hashes, ids, tags, starts), new, later


def repeated_windows(docs: DataFrame, total: int, window: int, buckets: int) -> DataFrame:
    """Packed places of windows whose words also start earlier, by bucket of the document.

    Within a chunk of documents the first place of a hash stands for it, and its other
    places are settled there and then. So a window that a third of all documents hold
    is shuffled once a chunk.
    """
    bits, flags = repeated_cells(docs.select("text"), total, window)
    shared = docs.sparkSession.sparkContext.broadcast(flags)

    def places(batches):
        held, size = [], 0

        def flush():
            (hashes, ids, tags, starts), new, later = earliest(*map(np.concatenate, zip(*held)))  # noqa: B905
            part = (hashes >> np.uint64(34)).astype(np.int64) % buckets
            yield packed(0, part[new], buckets, *(x[new] for x in (hashes, ids, tags, starts)))
            own = [x[later] for x in (ids, tags, starts)]
            yield packed(1, tags[later] % buckets, buckets, None, *own)

        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                hashes, doc, start = windows_of(texts_of(part), window)
                keep = np.flatnonzero(seen_twice(hashes, bits, shared.value))
                ids, tags = (np.array(part.column(k), np.int64) for k in (0, 1))
                own = doc[keep]
                held.append((hashes[keep], ids[own], tags[own], start[keep]))
                size += len(keep)
                if size >= CHUNK_WINDOWS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def exact(frame):
        open_ = frame[frame["kind"] == 0]
        columns = [b"".join(open_[name]) for name in ("hashes", "ids", "tags", "starts")]
        kinds = (np.uint64, np.int64, np.int64, np.int32)
        arrays = [np.frombuffer(c, k) for c, k in zip(columns, kinds, strict=True)]
        if not len(arrays[0]):
            return frame
        (_, ids, tags, starts), _, later = earliest(*arrays)
        own = [x[later] for x in (ids, tags, starts)]
        found = pd.DataFrame(packed(1, tags[later] % buckets, buckets, None, *own))
        return pd.concat([frame[frame["kind"] == 1], found])

    # What is settled already goes along to the exact grouping, and from there to its bucket.
    settled = map_batches(docs, places, PACKED).groupBy("part").applyInPandas(exact, PACKED)
    return materialise(settled.drop("kind", "hashes"), "windows")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """id, n_words, n_removed and kept (words joined by one space) of every row.

    Words are runs of anything but ASCII white space; a word goes if a window of
    `window` words over it also starts earlier: in a row of smaller id, or in the same
    row further left. Ids are whole numbers. Rows of equal id stand in the order of a
    hash of id and text, rows that agree in both are one document, and null ids come
    first. Null text and texts shorter than a window lose nothing. Other columns are
    not read.

    Only texts that may lose words (by a filter of fixed size over the tags of those
    that do) are shuffled, to meet their windows; the others are finished where they are.
    """
    least = -(1 << 63)
    known = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("id"),
        F.xxhash64(id_col, text).alias("tag"),
        F.col(text).alias("text"),
    )
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    flagged = repeated_windows(known, total, window, buckets)
    marks = docs.sparkSession.sparkContext.broadcast(membership(flagged.select("tags"), MARK_BITS))
    rows = "id long, tag long, text string"

    def touched(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(marks.value, np.array(batch.column(1), np.int64))))

    def whole(batches):
        for batch in batches:
            keep = ~may_hold(marks.value, np.array(batch.column(1), np.int64))
            part = batch.filter(pa.array(keep))
            words = [text.split() for text in texts_of(part)]
            yield {
                "id": part.column(0),
                "n_words": list(map(len, words)),
                "n_removed": [0] * len(words),
                "kept": [b" ".join(w).decode() for w in words],
            }

    def cut(rows, flags):
        starts, tags, ids = (
            np.frombuffer(b"".join(flags[name]), kind)
            for name, kind in (("starts", np.int32), ("tags", np.int64), ("ids", np.int64))
        )
        order = np.argsort(tags, kind="stable")
        starts, tags, ids = starts[order], tags[order], ids[order]
        first, end = (np.searchsorted(tags, rows["tag"], side) for side in ("left", "right"))
        out = {"n_words": [], "n_removed": [], "kept": []}
        for key, one, a, b in zip(rows["id"], rows["text"], first, end, strict=True):
            words = one.encode().split() if one else []
            own = starts[a:b][ids[a:b] == key]
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, own, 1)
            np.add.at(change, own + window, -1)
            gone = np.cumsum(change)[:-1] > 0
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            kept = [word for word, off in zip(words, gone.tolist(), strict=True) if not off]
            out["kept"].append(b" ".join(kept).decode())
        return pd.DataFrame({"id": rows["id"].to_numpy(), **out})

    schema = "id long, n_words long, n_removed long, kept string"
    bucket = F.pmod("tag", F.lit(buckets)).cast("int")
    changed = known.mapInArrow(touched, rows).withColumn("part", bucket).groupBy("part")
    changed = changed.cogroup(flagged.groupBy("part")).applyInPandas(cut, schema)
    done = map_batches(known, whole, schema).unionByName(changed)
    back = F.when(F.col("id") != least, F.col("id")).cast(docs.schema[id_col].dataType)
    return done.select(back.alias(id_col), "n_words", "n_removed", "kept")

