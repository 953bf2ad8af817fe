"""Benchmark decontamination by spaced seeds.

Windows of words are hashed under fixed masks that ignore some positions, so that
a changed word at an ignored position leaves the hash as it is. Hashes of documents
and of benchmark items are joined, and around each hit the two word sequences are
laid side by side and scored: a match counts one, a substitution costs two. Items of few
words have masks of their own, which between them ignore every set of places that may differ.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.sources import materialise

from .words import hash_texts, map_batches, mixed, portions, texts_of, unused, window_hashes

# Positions that count, of a window; what is between them is ignored.
MASKS = (
    (0, 1, 2, 3, 4, 5, 6, 7),
    (0, 1, 3, 4, 6, 7, 9, 10),
    (0, 2, 4, 6, 8, 10, 12, 14),
    (0, 1, 2, 5, 6, 7, 10, 11),
)
SHORTEST_ITEM = 4  # words; shorter items would be found everywhere and are left out
LONG_ITEM = 12  # items with fewer words than this are looked for as a whole as well
AROUND = 48  # words that a hit takes along on either side
BLOOM_BITS = 23
COST = 2
ENOUGH, SHARE = 10, 0.8  # words that must match: so many, or this share of a short item
PORTION_BYTES = 1_000_000
MARKS = b".,;:!?\"'()[]"
PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + MARKS, bytes(range(97, 123)) + b" " * len(MARKS)
)


def plain_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words without case (A-Z), split at marks too, and the text of each."""
    return hash_texts([text.translate(PLAIN) for text in texts])


def needed_words(n: int) -> int:
    """How many words of an item of `n` must match."""
    return min(ENOUGH, int(np.ceil(SHARE * n)))


def whole_masks(n: int) -> list[tuple[int, ...]]:
    """Masks over an item of `n` words that leave out any places that may differ.

    Places are dealt in turn to two classes more than may differ, and each mask ignores as
    many classes as words may differ: whichever differ, a mask ignores all of them.
    """
    free = n - needed_words(n)
    classes = range(free + 2)
    return [
        tuple(k for k in range(n) if k % len(classes) not in ignored)
        for ignored in combinations(classes, free)
    ]


def seeds(
    words: np.ndarray, doc: np.ndarray, whole: list[int], item: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word that counts) of all windows inside a text, under the masks for all
    items and those of items of so many words as `whole` tells; of an `item` itself these
    masks are laid on it once."""
    masks = list(enumerate(MASKS))
    masks += [(100 * n + k, mask) for n in whole for k, mask in enumerate(whole_masks(n))]
    hashes, starts = [], []
    for salt, mask in masks:
        found = window_hashes(words, [at - mask[0] for at in mask])
        last = doc[mask[-1] - mask[0] :][: len(found)]
        at = np.flatnonzero(doc[: len(found)] == last)
        if item and salt >= 100:
            at = at[at == mask[0]]
        hashes.append(mixed(found[at] + np.uint64(salt)))
        starts.append(at)
    return np.concatenate(hashes), np.concatenate(starts)


def items(benchmark: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """One row per usable benchmark item: item, n (words), words and seeds."""

    def rows(batches):
        for batch in batches:
            out = {k: [] for k in ("item", "n", "words", "seeds")}
            for item, one in zip(batch.column(0).to_pylist(), texts_of(batch, text), strict=True):
                words, doc = plain_words([one])
                if len(words) < SHORTEST_ITEM:
                    continue
                whole = [len(words)] if len(words) < LONG_ITEM else []
                hashes, starts = seeds(words, doc, whole, item=True)
                out["item"].append(item)
                out["n"].append(len(words))
                out["words"].append(words.tobytes())
                pairs = zip(hashes.view(np.int64).tolist(), starts.tolist(), strict=True)
                out["seeds"].append([{"hash": h, "at": a} for h, a in pairs])
            yield out

    kind = benchmark.schema[id_col].dataType.simpleString()
    schema = f"item {kind}, n int, words binary, seeds array<struct<hash: bigint, at: int>>"
    return map_batches(benchmark.select(id_col, text), rows, schema)


def _bloom_cells(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = hashes.view(np.uint64)
    top = np.uint64(64 - BLOOM_BITS)
    return own >> top, mixed(own + np.uint64(1)) >> top


def bloom(found: DataFrame) -> np.ndarray:
    """Filter over all seed hashes of the items: 2 ** BLOOM_BITS bits, whatever their number."""

    def parts(batches):
        marks = np.zeros(1 << BLOOM_BITS, bool)
        for batch in batches:
            values = batch.column(0).flatten().field("hash")
            for cell in _bloom_cells(np.array(values, np.int64)):
                marks[cell] = True
        if marks.any():
            yield {"bits": [np.packbits(marks).tobytes()]}

    merged = np.zeros(1 << BLOOM_BITS - 3, np.uint8)
    for row in map_batches(found.select("seeds"), parts, "bits binary").toLocalIterator():
        merged |= np.frombuffer(row["bits"], np.uint8)
    return np.unpackbits(merged).view(bool)


def hits(texts: DataFrame, marks: np.ndarray, whole: list[int]) -> DataFrame:
    """Stretches of texts around seeds that the filter lets through: one row for each.

    `texts` has tag and check (hashes of the text) and text. A stretch has its place
    in the text, its words' hashes and its seeds; neighbouring hits share one. Texts are
    taken in portions of about `PORTION_BYTES`, a longer one by itself.
    """
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(marks))
    widest = max(mask[-1] + 1 for mask in MASKS)

    def stretches(batch, known):
        out = {k: [] for k in ("tag", "check", "start", "words", "seeds")}
        tags, checks = (batch.column(k).to_pylist() for k in (0, 1))
        words, doc = plain_words(texts_of(batch))
        hashes, starts = seeds(words, doc, whole)
        first, second = _bloom_cells(hashes)
        at = np.flatnonzero(known[first])
        at = at[known[second[at]]]
        at = at[np.argsort(starts[at], kind="stable")]
        place = starts[at]
        far = np.diff(place) > 2 * AROUND + widest
        for group in np.split(at, np.flatnonzero(far | (np.diff(doc[place]) > 0)) + 1):
            if not len(group):
                continue
            own = int(doc[starts[group[0]]])
            low, high = np.searchsorted(doc, [own, own + 1])
            begin = max(low, starts[group[0]] - AROUND)
            end = min(high, starts[group[-1]] + widest + AROUND)
            pairs = zip(
                hashes[group].view(np.int64).tolist(), (starts[group] - begin).tolist(), strict=True
            )
            out["tag"].append(tags[own])
            out["check"].append(checks[own])
            out["start"].append(int(begin - low))
            out["words"].append(words[begin:end].tobytes())
            out["seeds"].append([{"hash": h, "at": a} for h, a in pairs])
        return out

    def rows(batches):
        known = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2).cast(pa.binary())), 0).to_pylist()
            for part in portions(sizes, PORTION_BYTES):
                yield stretches(batch.slice(part.start, part.stop - part.start), known)

    schema = "tag long, check long, start int, words binary, "
    schema += "seeds array<struct<hash: bigint, at: int>>"
    return map_batches(texts, rows, schema)


def best_overlap(left: np.ndarray, right: np.ndarray, shift: int) -> tuple[int, int]:
    """(matching words, length) of the best stretch where right[i] stands at left[i + shift]."""
    begin, end = max(0, -shift), min(len(right), len(left) - shift)
    if end <= begin:
        return 0, 0
    same = left[begin + shift : end + shift] == right[begin:end]
    score = np.concatenate([[0], np.cumsum(np.where(same, 1, -COST))])
    lowest = np.minimum.accumulate(score)
    to = int(np.argmax(score - lowest))
    since = int(np.argmax(score[: to + 1] == lowest[to]))
    return int(same[since:to].sum()), to - since


def laid_over(left: np.ndarray, right: np.ndarray, shift: int) -> int:
    """How many words of the whole of `right` match where right[i] stands at left[i + shift]."""
    begin, end = max(0, -shift), min(len(right), len(left) - shift)
    return int((left[begin + shift : end + shift] == right[begin:end]).sum()) if begin < end else 0


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(tag, check, item, matched): texts and the benchmark items that they hold."""
    found = materialise(items(benchmark), "items")
    lengths = found.where(F.col("n") < LONG_ITEM).select("n").distinct().collect()
    whole = sorted(row["n"] for row in lengths)  # LONG_ITEM - SHORTEST_ITEM values at most
    stretches = materialise(hits(tagged(docs, text), bloom(found), whole), "hits")
    # Copies of a text have the same stretches; one of each is enough.
    once = stretches.groupBy("tag", "check", "start").agg(
        F.first("words").alias("words"), F.first("seeds").alias("seeds")
    )
    once = materialise(once, "stretches")
    of_texts = once.select("tag", "check", "start", F.inline("seeds")).withColumnRenamed("at", "_p")
    of_items = found.select("item", F.inline("seeds")).withColumnRenamed("at", "_q")
    pairs = (
        of_texts.join(of_items, "hash")
        .select("tag", "check", "start", "item", (F.col("_p") - F.col("_q")).alias("shift"))
        .distinct()
    )
    side_by_side = pairs.join(once.drop("seeds"), ["tag", "check", "start"]).join(
        found.select("item", F.col("words").alias("own")), "item"
    )

    def verify(batches):
        for batch in batches:
            out = []
            columns = (c.to_pylist() for c in batch.columns[3:])
            for shift, words, own in zip(*columns, strict=True):
                left, right = np.frombuffer(words, np.uint64), np.frombuffer(own, np.uint64)
                matched, _ = best_overlap(left, right, shift)
                if len(right) < LONG_ITEM:
                    matched = max(matched, laid_over(left, right, shift))
                out.append(matched if matched >= needed_words(len(right)) else 0)
            yield dict(zip(("tag", "check", "item"), batch.columns, strict=False)) | {
                "matched": out
            }

    kind = found.schema["item"].dataType.simpleString()
    checked = map_batches(
        side_by_side.select("tag", "check", "item", "shift", "words", "own"),
        verify,
        f"tag long, check long, item {kind}, matched long",
    )
    best = checked.where("matched > 0").groupBy("tag", "check", "item")
    return best.agg(F.max("matched").alias("matched"))


def tagged(docs: DataFrame, text: str = "text", *columns: str) -> DataFrame:
    tag, check = F.xxhash64(text).alias("tag"), F.xxhash64(F.lit(1), text).alias("check")
    return docs.select(*columns, tag, check, F.col(text).alias("text"))


def verdicts(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Per contaminated text (tag, check): n_items, and the item it shares most words with."""
    first = F.struct((-F.col("matched")).alias("m"), "item")
    return (
        overlaps(docs, benchmark, text)
        .groupBy("tag", "check")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.max("matched").alias("overlap"),
            F.min(first)["item"].alias("item_id"),
        )
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """id, n_items, item_id, overlap (words) and contaminated of every row.

    Null and empty texts and null ids are clean or judged like any other; repeated
    rows are judged alike, since the text alone decides. An empty benchmark, or one
    with items under `SHORTEST_ITEM` words only, leaves every document clean.
    """
    found = verdicts(docs, benchmark, text)
    rows = tagged(docs, text, id_col).drop("text")
    return rows.join(found, ["tag", "check"], "left").select(
        id_col,
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "item_id",
        F.coalesce("overlap", F.lit(0)).alias("overlap"),
        F.col("n_items").isNotNull().alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no benchmark item."""
    tag, check = unused(docs, "_tag", "_check")
    found = verdicts(docs, benchmark, text).select(F.col("tag").alias(tag), F.col("check").alias(check))
    same = (F.xxhash64(text) == F.col(tag)) & (F.xxhash64(F.lit(1), text) == F.col(check))
    return docs.join(found, same, "left_anti")
