"""Phrase collocation mining by a multikey quicksort of suffixes.

Every word starts a suffix: itself and up to three further words of its piece, cut where a
pair of neighbouring words is surely rare. Suffixes are dealt to tasks in ranges of their
order, that is by leading words, and each task sorts its own by three-way partitions, word
after word. A partition of equal leading words is a phrase and its size the phrase's count;
a partition that can't reach the least count is abandoned.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postpulse.operators.joins import join_by_size, top_k
from postpulse.sources import materialise

from .sketches import cells, look_up, merged_flags, sketch_lists
from .words import TAKEN, map_batches, mixed, portions

DEPTH = 4
LEAST = 30
PORTION_BYTES = 3_000_000
HELD_ROWS = 1_200_000
TASK_ROWS = 250_000
TASKS_PER_CORE = 2
TEXT_BYTES = 256_000_000
SKETCH_DEPTH = 2
FEWEST_BITS, MOST_BITS = 20, 28
END = re.compile(rb"[.,;:!?\x0A-\x0D]")
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?"]] = True
ENDS[0x0A:0x0E] = True
GAPS = ENDS.copy()
GAPS[[0x20, 0x09]] = True


def words_of(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one run of bytes, and of each word its start, end, hash and piece.

    Letters A to Z are lower; words are divided by single blanks in the run. No piece is
    in two texts.
    """
    lower = b"\n".join([*texts, b""]).lower().replace(b"\t", b" ")
    while b"  " in lower:
        lower = lower.replace(b"  ", b" ")
    joined = lower + b"\0" * 8
    raw = np.frombuffer(joined, np.uint8)[: len(lower)]
    gap = GAPS[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(gap) and not gap[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[: len(edge) // 2 * 2 : 2], edge[1::2]
    piece = np.searchsorted(np.flatnonzero(ENDS[raw]), starts)
    eight = np.ndarray(len(lower) + 1, "<u8", joined, strides=(1,))
    hashes = mixed((ends - starts).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, left, which = starts, ends - starts, np.arange(len(starts))
    while len(which):
        part = eight[at] & TAKEN[np.minimum(left, 8)]
        hashes[which] = mixed(hashes[which] * np.uint64(0x9E3779B97F4A7C15) + part)
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    return lower, starts, ends, hashes, piece


def cut_at_pieces(text: bytes) -> list[bytes]:
    """A long text as several, cut where a piece ends."""
    out, at = [], 0
    while len(text) - at > PORTION_BYTES:
        end = END.search(text, at + PORTION_BYTES // 2)
        if end is None:
            break
        out.append(text[at : end.end()])
        at = end.end()
    return [*out, text[at:]]


def marked_words(batch: pa.RecordBatch):
    """Words of a batch of (lang, text), portion by portion, with the number of their language.

    The hash of a word is that of language and word.
    """
    langs = batch.column(0).dictionary_encode()
    names = langs.dictionary.to_pylist()
    salts = [hashlib.blake2b(name.encode(), digest_size=8).digest() for name in names]
    salts = np.frombuffer(b"".join(salts), np.uint64)
    texts, lang_of = [], []
    for text, lang in zip(batch.column(1).cast(pa.binary()).to_pylist(), langs.indices.to_pylist(), strict=True):
        parts = cut_at_pieces(text or b"")
        texts += parts
        lang_of += [lang] * len(parts)
    for part in portions([len(t) for t in texts], PORTION_BYTES):
        own = texts[part]
        lower, starts, ends, hashes, piece = words_of(own)
        if not len(starts):
            continue
        lines = np.cumsum([text.count(b"\n") + 1 for text in own])
        line = np.searchsorted(np.flatnonzero(np.frombuffer(lower, np.uint8) == 0x0A), starts)
        lang = np.array(lang_of[part])[np.searchsorted(lines, line, "right")]
        yield names, lower, starts, ends, mixed(hashes ^ salts[lang]), piece, lang


def runs(hashes: np.ndarray, inside: np.ndarray, passes: Callable[[int, np.ndarray], np.ndarray]):
    """(length, starts, keys) of the runs of two words and more that go on `inside` and pass at each length.

    `inside` tells of each word whether the next one may follow it.
    """
    at, key = np.arange(len(hashes)), hashes
    for ahead in range(1, DEPTH):
        on = inside[at + ahead - 1]
        at = at[on]
        key = mixed(key[on] * np.uint64(0x9E3779B97F4A7C15) + hashes[at + ahead])
        on = passes(ahead + 1, key)
        at, key = at[on], key[on]
        yield ahead + 1, at, key


def followed(piece: np.ndarray) -> np.ndarray:
    return np.append(piece[:-1] == piece[1:], False)


def _at_least(counts: np.ndarray, least: int) -> np.ndarray:
    return (counts >= least).astype(np.uint8)


def texts_by_language(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).cast("string").alias("text"),
    )


class Sketch:
    """Merged counts of hashes, as flags that tell which may come `least` times or more."""

    def __init__(self, texts: DataFrame, hashes_of, bits: int, least: int):
        self.bits = bits
        lists = sketch_lists(texts, hashes_of, bits, SKETCH_DEPTH)
        planes = merged_flags(lists, bits, SKETCH_DEPTH, partial(_at_least, least=least), 1)
        self.planes = texts.sparkSession.sparkContext.broadcast([plane[0] for plane in planes])

    def may_be_frequent(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for row, plane in enumerate(self.planes.value):
            found &= look_up(plane, cells(hashes, row, self.bits)) > 0
        return found


def suffixes(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, suffix, n): the suffixes that start at a word, equal ones of a task folded.

    Two merged count-min sketches, of words and pairs and then of the runs of three and
    four words all of whose pairs may be frequent, tell which surely come fewer than
    `least` times. Suffixes end before they get rare, and rare words have none; rows of
    empty suffix count these. A sketch has a cell for every few words, up to
    2 ** MOST_BITS (32 MB of flags a row in driver and tasks). That tells runs apart up to
    some 40 GB of text; beyond that more rare ones pass, to be found rare when sorted.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(int(size // 24).bit_length(), FEWEST_BITS), MOST_BITS)

    def words_and_pairs(batch):
        for _, _, _, _, hashes, piece, _ in marked_words(batch):
            yield hashes
            yield next(runs(hashes, followed(piece), lambda length, key: np.ones(len(key), bool)))[2]

    short = Sketch(texts, words_and_pairs, bits, least)

    def frequent_pairs(hashes, piece):
        inside = followed(piece)
        _, at, key = next(runs(hashes, inside, lambda length, key: short.may_be_frequent(key)))
        inside[:] = False
        inside[at] = True
        return inside

    def longer_runs(batch):
        for _, _, _, _, hashes, piece, _ in marked_words(batch):
            inside = frequent_pairs(hashes, piece)
            for length, _, key in runs(hashes, inside, lambda length, key: np.ones(len(key), bool)):
                if length > 2:
                    yield key

    long = Sketch(texts, longer_runs, max(bits - 1, FEWEST_BITS), least)

    def passes(length, key):
        return np.ones(len(key), bool) if length == 2 else long.may_be_frequent(key)

    def of_portion(names, lower, starts, ends, hashes, piece, lang) -> list[tuple]:
        useful, size, key = short.may_be_frequent(hashes), np.ones(len(starts), np.int64), hashes.copy()
        for length, at, own in runs(hashes, frequent_pairs(hashes, piece), passes):
            useful[at], size[at], key[at] = True, length, own
        used = np.flatnonzero(useful)
        keys, first, n = np.unique(key[used], return_index=True, return_counts=True)
        first = used[first]
        left_out = np.bincount(lang[~useful], minlength=len(names))
        shown = np.flatnonzero(left_out)
        salts = np.array([zlib.crc32(names[k].encode()) for k in shown.tolist()], np.uint64)
        named = pa.array(names, pa.string())
        texts = slices(lower, starts[first], ends[first + size[first] - 1])
        return [
            (keys, named.take(pa.array(lang[first])), texts, n),
            (salts, named.take(pa.array(shown)), pa.array([""] * len(shown), pa.string()), left_out[shown]),
        ]

    def rows(batches):
        parts = (part for batch in batches for portion in marked_words(batch) for part in of_portion(*portion))
        for _, lang, text, n in folds(parts, HELD_ROWS):
            # In their order neighbours begin alike, which stores and ships in fewer bytes.
            order = pc.sort_indices(text)
            yield {"lang": lang.take(order), "suffix": text.take(order), "n": n[order.to_numpy()]}

    # A frequent suffix is in most tasks' texts and leaves each of them once, so tasks are few and large.
    cores = texts.sparkSession.sparkContext.defaultParallelism
    few = texts.coalesce(max(TASKS_PER_CORE * cores, size // TEXT_BYTES))
    return map_batches(few, rows, "lang string, suffix string, n long")


def folded(held: list[tuple]) -> tuple:
    """(keys, languages, texts, counts) of several such parts as one, equal keys added up."""
    keys, first, place = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
    n = np.bincount(place, np.concatenate([h[3] for h in held]), len(keys)).astype(np.int64)
    lang, text = (pa.concat_arrays([h[k] for h in held]).take(pa.array(first)) for k in (1, 2))
    return keys, lang, text, n


def folds(parts: Iterable[tuple], most: int) -> Iterator[tuple]:
    """`folded` parts, of which about `most` rows are held at a time.

    What a fold leaves is held for the next one while that has room for a quarter of new rows.
    """
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= most:
            held = [folded(held)]
            size = len(held[0][0])
            if size > most * 3 // 4:
                yield held.pop()
                size = 0
    if held:
        yield folded(held)


def slices(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of a run of UTF-8 as an Arrow array."""
    length = ends - starts
    offsets = np.concatenate([[0], np.cumsum(length)])
    at = np.repeat(starts - offsets[:-1], length) + np.arange(offsets[-1])
    data = np.frombuffer(raw, np.uint8)[at].tobytes()
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.string(), len(length), buffers)


def quicksorted(codes: np.ndarray, n: np.ndarray, least: int):
    """(row, depth, size) of each partition of equal leading codes whose size is `least` or more.

    Rows of `codes` are strings of codes, ended by 0. A partition is split in three around
    the code of a row of it at the depth it has come to: smaller and larger codes go on at
    this depth, equal ones at the next.
    """
    depth_of_all = codes.shape[1]
    stack = [(np.arange(len(codes)), 0)]
    while stack:
        rows, depth = stack.pop()
        own, weight = codes[rows, depth], n[rows]
        ends = np.sort(own[[0, len(own) // 2, -1]])
        pivot = ends[1]
        for which, equal in ((own < pivot, False), (own > pivot, False), (own == pivot, True)):
            size = int(weight[which].sum())
            if size < least or not which.any():
                continue
            part = rows[which]
            if not equal:
                stack.append((part, depth))
            elif pivot:
                yield int(part[0]), depth + 1, size
                if depth + 1 < depth_of_all:
                    stack.append((part, depth + 1))


def sorted_counts(found: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f): language totals (empty phrase) and phrases that come `least` times or more.

    `found` has suffixes and their counts. They are dealt in ranges of (lang, words), so
    equal leading words are in one task or, however many, in neighbouring ones. What a task
    counts whole and finds rare it drops; prefixes of its first and last suffix, which a
    neighbour may hold as well, leave it with any count and are added up by phrase.
    """
    found = materialise(found, "suffixes")
    tasks = max(found.count() // TASK_ROWS + 1, found.sparkSession.sparkContext.defaultParallelism)
    dealt = found.repartitionByRange(tasks, "lang", F.split("suffix", " ", -1))

    def rows(batches):
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables).combine_chunks()
        parts = pc.split_pattern(table["suffix"].chunk(0), " ")
        flat = pa.concat_arrays([table["lang"].chunk(0), parts.flatten()]).dictionary_encode()
        rank = pc.rank(flat.dictionary.cast(pa.binary())).to_numpy()
        code = rank[flat.indices.to_numpy()].astype(np.int64)
        codes = np.zeros((table.num_rows, DEPTH + 1), np.int64)
        codes[:, 0] = code[: table.num_rows]
        length = pc.list_value_length(parts).to_numpy()
        row = np.repeat(np.arange(table.num_rows), length)
        column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        codes[row, column + 1] = code[table.num_rows :]
        codes[np.asarray(pc.equal(table["suffix"].chunk(0), "")), 1] = 0
        n = table["n"].chunk(0).to_numpy()
        sizes = {}
        for at, depth, size in quicksorted(codes, n, least):
            sizes[tuple(codes[at, :depth].tolist())] = (at, size)
        order = np.lexsort(codes.T[::-1])
        for edge in (order[0], order[-1]):
            same = np.ones(len(codes), bool)
            for depth in range(1, DEPTH + 2):
                if codes[edge, depth - 1] == 0:
                    break
                same &= codes[:, depth - 1] == codes[edge, depth - 1]
                sizes[tuple(codes[edge, :depth].tolist())] = (int(edge), int(n[same].sum()))
        names = flat.dictionary.take(pa.array(np.argsort(rank))).to_pylist()
        found = [(key, size) for key, (_, size) in sizes.items()]
        yield {
            "lang": [names[key[0] - 1] for key, _ in found],
            "phrase": [" ".join(names[c - 1] for c in key[1:]) for key, _ in found],
            "f": [size for _, size in found],
        }

    parts = map_batches(dealt, rows, "lang string, phrase string, f long")
    total = parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return total.where((F.col("f") >= least) | (F.col("phrase") == ""))


def _whole(name: str) -> Column:
    return F.col(name).cast("decimal(38,0)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most: int = 2000
) -> DataFrame:
    """The `most` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Null text is empty, null language is `und`; a language without a phrase has no row.
    Repeated rows count as often as they come. Other columns are not read. Of equal scores
    and counts the first phrase by UTF-8 bytes comes first, so ranks are unique.
    """
    counts = materialise(sorted_counts(suffixes(texts_by_language(docs, text, lang), least), least), "phrases")
    totals = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    known = counts.where("phrase <> ''").withColumn("words", F.split("phrase", " ", -1))
    size = F.size("words")
    several = known.where(size > 1).withColumnRenamed("f", "a")

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.slice("words", i, k)),
        )
    )
    inside = several.where(size > 2).select(
        "lang", F.explode(inner).alias("words"), F.lit(None).cast("long").alias("a"), F.col("a").alias("around")
    )
    both = several.select("lang", "words", "a", F.lit(None).cast("long").alias("around")).unionByName(inside)
    folded = both.groupBy("lang", "words").agg(F.max("a").alias("a"), F.max("around").alias("around"))
    covered = _whole("around") * 100 >= _whole("a") * 80
    kept = folded.where(F.col("a").isNotNull() & ~F.coalesce(covered, F.lit(False)))

    joined = partial(F.array_join, delimiter=" ")
    cuts = kept.withColumn("phrase", joined("words")).withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        joined(F.slice("words", F.lit(1), F.col("k"))).alias("left"),
        joined(F.slice("words", F.col("k") + 1, size)).alias("right"),
    )
    for part, count in (("left", "l"), ("right", "r")):
        # A part that many phrases share is a skewed key, which an inner join splits at run time.
        side = known.select("lang", F.col("phrase").alias(part), F.col("f").alias(count))
        cuts = cuts.join(side, ["lang", part])
    score = F.expr("(cast(a as decimal(38,0)) * 2000000) div (cast(l as decimal(38,0)) + r)")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "cut.*")
    best = top_k(scored, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], most, "phrase")
    ranked = join_by_size(best, totals, ["lang"], "inner", ["phrase"])
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
