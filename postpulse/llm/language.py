"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram binds the vectors of its three
letters, permuted by place, into one by multiplication; a text bundles the vectors of all
its trigrams by addition, and a language bundles its texts. A text is in the language
whose prototype is nearest by cosine.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postpulse.sources import materialise

from .words import map_batches, mixed, portions

DIMENSIONS = 2048
PORTION_BYTES = 2_000_000
PIECE_CHARS = 500_000
GRAM_BLOCK = 2048
UNIT = 1 << 20  # a text's vector of length one in whole numbers, so that sums don't depend on order
UNKNOWN = "und"
_letters: dict[int, bool] = {}


def letter_vector(code: int) -> np.ndarray:
    """The vector of a letter, from its code point alone; 0 stands for what is between words."""
    counters = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    with np.errstate(over="ignore"):
        words = mixed(counters + np.uint64(code + 1) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(words.astype("<u8").view(np.uint8))
    return bits.astype(np.int8) * 2 - 1


def spelled(text: str) -> np.ndarray:
    """Code points of the letters; anything else between two words is one 0."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    table = np.zeros(0x80, bool)
    table[ord("a") : ord("z") + 1] = True
    is_letter = table[np.minimum(codes, 0x7F)] & (codes < 0x80)
    for code in np.unique(codes[codes >= 0x80]).tolist():
        if code not in _letters:
            _letters[code] = chr(code).isalpha()
        if _letters[code]:
            is_letter |= codes == code
    codes = np.where(is_letter, codes, 0)
    return codes[is_letter | np.append(True, is_letter[:-1])]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different trigrams of a whole text, as 63-bit numbers, and their counts.

    A long text is read in pieces; the end of one goes before the next. A text without
    a letter has none.
    """
    keys, counts, before = [], [], np.zeros(1, np.uint64)
    text = text.lower()
    size = max(len(text), 1)
    for at in range(0, size, PIECE_CHARS):
        own = spelled(text[at : at + PIECE_CHARS]).astype(np.uint64)
        last = at + PIECE_CHARS >= size
        run = np.concatenate([before, own, np.zeros(int(last), np.uint64)])
        run = run[np.append(True, (run[1:] > 0) | (run[:-1] > 0))]
        key, count = np.unique(run[:-2] << np.uint64(42) | run[1:-1] << np.uint64(21) | run[2:], return_counts=True)
        keys.append(key)
        counts.append(count)
        before = run[-2:]
    if len(keys) == 1:
        return keys[0], counts[0]
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(where, np.concatenate(counts)).astype(np.int64)


def gram_vectors(keys: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 for each trigram."""
    low = np.uint64((1 << 21) - 1)
    places = [(keys >> np.uint64(42)), (keys >> np.uint64(21)) & low, keys & low]
    letters, where = np.unique(np.concatenate(places), return_inverse=True)
    known = np.stack([letter_vector(int(c)) for c in letters])
    first, second, third = where.reshape(3, -1)
    return np.roll(known, 2, axis=1)[first] * np.roll(known, 1, axis=1)[second] * known[third]


def bundled(texts: list[str]) -> np.ndarray:
    """The sum of the trigram vectors of each text: one row of DIMENSIONS numbers a text."""
    found = [trigrams(text) for text in texts]
    doc = np.repeat(np.arange(len(texts)), [len(keys) for keys, _ in found])
    keys, gram = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    count = np.concatenate([n for _, n in found]).astype(np.float32)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    # Trigrams of many texts first: they are added as a product of matrices, the rest one by one.
    met = np.bincount(gram, minlength=len(keys))
    order = np.argsort(-met, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    keys, at = keys[order], place[gram]
    common = int((met >= max(len(texts) // 50, 2)).sum())
    by_place = np.argsort(at, kind="stable")
    doc, at, count = doc[by_place], at[by_place], count[by_place]
    for start in range(0, common, GRAM_BLOCK):
        stop = min(start + GRAM_BLOCK, common)
        a, b = np.searchsorted(at, [start, stop])
        table = np.zeros((len(texts), stop - start), np.float32)
        table[doc[a:b], at[a:b] - start] = count[a:b]
        out += table @ gram_vectors(keys[start:stop]).astype(np.float32)
    rest = int(np.searchsorted(at, common))
    for a in range(rest, len(at), GRAM_BLOCK):
        part = slice(a, a + GRAM_BLOCK)
        by_doc = np.argsort(doc[part], kind="stable")
        own, first = np.unique(doc[part][by_doc], return_index=True)
        rows, where = np.unique(at[part][by_doc], return_inverse=True)
        vectors = gram_vectors(keys[rows])[where] * count[part][by_doc][:, None]
        out[own] += np.add.reduceat(vectors, first, axis=0)
    return out


def profiles(docs: DataFrame, id_col: str, text: str, label: str, learn: Column) -> DataFrame:
    """(id, label, learn, profile): the text's bundle at 8 bits a dimension, null without a letter."""
    named = docs.select(
        F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"),
        F.col(label).cast("string").alias("label"), F.coalesce(learn, F.lit(False)).alias("learn"),
    )

    def rows(batches):
        for batch in batches:
            texts = [one or "" for one in batch.column(1).to_pylist()]
            for part in portions([len(t) for t in texts], PORTION_BYTES):
                sums = bundled(texts[part])
                most = np.abs(sums).max(axis=1, keepdims=True)
                small = np.rint(sums * (127 / np.maximum(most, 1))).astype(np.int8)
                profile = [
                    row.tobytes() if any(map(str.isalpha, one)) else None
                    for row, one in zip(small, texts[part], strict=True)
                ]
                held = batch.slice(part.start, part.stop - part.start)
                yield {"id": held.column(0), "label": held.column(2), "learn": held.column(3), "profile": profile}

    kind = named.schema["id"].dataType.simpleString()
    return map_batches(named, rows, f"id {kind}, label string, learn boolean, profile binary")


def unit_vectors(blobs: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(blobs), np.int8).reshape(-1, DIMENSIONS).astype(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def prototypes(found: DataFrame) -> DataFrame:
    """(label, place, total): the sum of the profiles of the rows to learn from, by label.

    Each text counts alike, however long. A partition sends one vector a label.
    """

    def rows(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            whole = np.rint(unit_vectors(batch.column(1).to_pylist()) * UNIT).astype(np.int64)
            for own in set(labels.tolist()):
                sums[own] = sums.get(own, 0) + whole[labels == own].sum(axis=0)
        yield {"label": list(sums), "sums": list(sums.values())}

    known = found.where("learn and label is not null and profile is not null")
    parts = map_batches(known.select("label", "profile"), rows, "label string, sums array<long>")
    single = parts.select("label", F.posexplode("sums").alias("place", "part"))
    return single.groupBy("label", "place").agg(F.sum("part").alias("total"))


def predict(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", label: str = "lang"
) -> DataFrame:
    """id, lang_pred and score of every row's whole text, one row per input row.

    Prototypes are learned from the rows where `learn` is true and label and text aren't
    null; label and id play no part in a prediction. A text that is null or has no letter
    is `und` with score 0, and so is every text if there is nothing to learn from. The
    score is the cosine, 0 where it is negative; of equal cosines the first label by code
    point wins. Null ids and repeated rows give a row each; other columns are not read.
    The driver and each task hold one vector of DIMENSIONS numbers a label. Profiles, one
    byte a dimension and text, are stored once and read twice.
    """
    found = materialise(profiles(docs, id_col, text, label, learn), "profiles")
    sums: dict[str, np.ndarray] = {}
    for row in prototypes(found).toLocalIterator():  # labels x DIMENSIONS rows
        sums.setdefault(row["label"], np.zeros(DIMENSIONS))[row["place"]] = row["total"]
    labels = sorted(sums)
    known = np.array([sums[k] / max(np.linalg.norm(sums[k]), 1e-9) for k in labels], np.float32)

    def rows(batches):
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            which = [k for k, blob in enumerate(blobs) if blob is not None and labels]
            names, score = [UNKNOWN] * len(blobs), [0.0] * len(blobs)
            if which:
                cosines = unit_vectors([blobs[k] for k in which]) @ known.T
                for k, best, own in zip(which, cosines.argmax(axis=1), cosines, strict=True):
                    names[k], score[k] = labels[best], min(max(float(own[best]), 0.0), 1.0)
            yield {id_col: batch.column(0), "lang_pred": names, "score": score}

    kind = found.schema["id"].dataType.simpleString()
    return map_batches(found.select("id", "profile"), rows, f"{id_col} {kind}, lang_pred string, score double")
