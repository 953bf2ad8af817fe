"""N-gram Jaccard join by signature trees.

Texts are sets of word shingles. Sets that can be similar share one of the rarest
quarter of their shingles, so such a shingle brings them into a group. In a group a
signature tree is built: nodes hold the OR of their sets' bitmaps and the range of
their sizes, and a dual traversal drops pairs of nodes whose largest possible overlap
is too small. What is left joins the members to families, and the same traversal over
a family's sets, with exact overlaps at its leaves, finds the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.sources import materialise

from .graph import components
from .sketches import cells, look_up, may_hold, membership, merged_flags, sketch_lists
from .words import hash_texts, map_batches, mixed, portions, run_hashes, texts_of, unused

SHINGLE = 5
NUM, DEN = 3, 4  # links: DEN * intersection >= NUM * union
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
LEAST_BITS, MOST_BITS = 20, 29
MOST_FINE = 13  # a range's cells are numbered in 32 bits
MARK_BITS = 26
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 32
CHUNK_POSTINGS = 1_000_000
DOCS_AT_ONCE = 250
PORTION_BYTES = 2_000_000
NO_ID = (1 << 63) - 1  # stands for null
BLOCK = 1024  # members that are compared in one task
FAN = 16  # children of a node
LEAST_WIDTH, MOST_WIDTH = 64, 8192  # bits of a bitmap
PACKED = "kind int, part int, keys binary, sids binary, sizes binary"


# Sets


def sets_of(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, number of the text), each pair once, sorted by text and hash.

    A text with fewer words than a shingle has is one shingle; one without words, none.
    """
    words, doc = hash_texts([text.translate(LOWER) for text in texts])
    counts = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(counts) - counts
    hashes, own = [], []
    for n in range(1, min(size, len(words) + 1)):
        short = np.flatnonzero(counts == n)
        if len(short):
            hashes.append(run_hashes(words, n)[first[short]] ^ np.uint64(n))
            own.append(short)
    if len(words) >= size:
        runs = run_hashes(words, size)
        at = np.flatnonzero(doc[: len(runs)] == doc[size - 1 :])
        hashes.append(runs[at])
        own.append(doc[at])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes, own = np.concatenate(hashes), np.concatenate(own)
    order = np.lexsort((hashes, own))
    hashes, own = hashes[order], own[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1])])
    return hashes[new], own[new]


def set_ids(hashes: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sid, size) of each of n texts: a 64-bit hash of the set; 0 for the empty set."""
    sizes = np.bincount(own, minlength=n)
    total = np.zeros(n, np.uint64)
    held = np.flatnonzero(sizes)
    if len(held):
        starts = (np.cumsum(sizes) - sizes)[held]
        total[held] = np.add.reduceat(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts)
        total[held] = mixed(total[held] + sizes[held].astype(np.uint64)) | np.uint64(1)
    return total.view(np.int64), sizes


def overlap_needed(a, b):
    """Least intersection of two linked sets of sizes a and b."""
    return -(-NUM * (a + b) // (NUM + DEN))


# Groups


def rarity(texts: DataFrame, total: int, size: int) -> tuple[int, np.ndarray]:
    """Bits, and for each cell of a count sketch two bits: how frequent its shingles are.

    Any order of shingles gives right groups, and rare shingles first gives small ones.
    Counts are never too low, so a shingle at level 0, whose cell was met once, is in no
    other text. The sketch has one to two cells a word, and no more than
    2 ** MOST_BITS: beyond that shingles are counted in finer cells, and a cell has the
    highest of its cells' levels. So many words may share a cell, and only those that are met
    again count; the finer cells are enough that at most one cell in eight has two different
    shingles in one of them.
    """
    bits = int(np.clip(np.ceil(np.log2(max(total / 6, 1))), LEAST_BITS, MOST_BITS))
    load = total / 6 / (1 << bits)
    fine = 0 if load <= 1 else min(int(np.ceil(2 + 2 * np.log2(load))), MOST_FINE)
    steps = np.array([1, 3, 15])

    def hashes(batch):
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            yield sets_of(texts_of(batch.slice(at, DOCS_AT_ONCE)), size)[0]

    lists = sketch_lists(texts, hashes, bits, 1, fine)
    level = lambda n: np.digitize(n, steps, right=True).astype(np.uint8)
    return bits, merged_flags(lists, bits, 1, level, 2, fine)[0]


def _by_part(kind: int, part: np.ndarray, parts: int, keys, sids) -> dict:
    order = np.argsort(part, kind="stable")
    borders = np.searchsorted(part[order], np.arange(parts + 1))
    out = {name: [] for name in ("kind", "part", "keys", "sids", "sizes")}
    for k in np.flatnonzero(np.diff(borders)).tolist():
        own = order[borders[k] : borders[k + 1]]
        values = (kind, k, keys[own].tobytes(), sids[own].tobytes(), b"")
        for name, value in zip(out, values, strict=True):
            out[name].append(value)
    return out


def groups_and_sizes(docs: DataFrame, total: int, size: int) -> DataFrame:
    """Packed rows: kind 0, sids that share a rare shingle; kind 1, ids with sid and size.

    Of a set of n shingles the n - ceil(3 n / 4) + 1 rarest stand for it: a set without
    any of these has too few of its shingles. Those that are in no other text bring no
    sets together and stay where they are. A set that is met again in a chunk of
    documents is sent once.
    """
    bits, planes = rarity(docs.select("text"), total, size)
    shared = docs.sparkSession.sparkContext.broadcast(planes)
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))

    def rows(batches):
        held, count = [], 0

        def flush():
            keys, sids = map(np.concatenate, zip(*held))  # noqa: B905
            order = np.lexsort((sids, keys))
            keys, sids = keys[order], sids[order]
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (sids[1:] != sids[:-1])])
            keys, sids = keys[new], sids[new]
            part = (keys >> np.uint64(34)).astype(np.int64) % buckets
            return _by_part(0, part, buckets, keys, sids)

        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                hashes, own = sets_of(texts_of(part), size)
                sids, sizes = set_ids(hashes, own, part.num_rows)
                cell = cells(hashes, 0, bits)
                level = look_up(shared.value[0], cell) + 2 * look_up(shared.value[1], cell)
                order = np.lexsort((hashes, level, own))
                rank = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                rare = rank < (sizes - -(-NUM * sizes // DEN) + 1)[own]
                first = order[rare & (level[order] > 0)]
                held.append((hashes[first], sids[own[first]]))
                count += len(first)
                ids = np.array(part.column(0), np.int64)
                to = int(mixed(ids[:1].view(np.uint64))[0] % np.uint64(buckets))
                yield {
                    "kind": [1], "part": [to],
                    "keys": [ids.tobytes()], "sids": [sids.tobytes()],
                    "sizes": [sizes.astype(np.int64).tobytes()],
                }
                if count >= CHUNK_POSTINGS:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    def group(frame):
        open_ = frame[frame["kind"] == 0]
        keys = np.frombuffer(b"".join(open_["keys"]), np.uint64)
        sids = np.frombuffer(b"".join(open_["sids"]), np.int64)
        order = np.lexsort((sids, keys))
        keys, sids = keys[order], sids[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (sids[1:] != sids[:-1])
        keys, sids = keys[new], sids[new]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
        counts = np.diff(np.append(starts, len(keys))).astype(np.int64)
        found = {}
        if len(keys):
            # Neighbouring shingles bring the same sets together: one group of each kind.
            marks = np.add.reduceat(mixed(sids.view(np.uint64)), starts) + counts.astype(np.uint64)
            for mark, start, n in zip(marks.tolist(), starts, counts, strict=True):
                if n > 1 and mark not in found:
                    found[mark] = sids[start : start + n].tobytes()
        marks = np.array(list(found), np.uint64)
        made = pd.DataFrame(
            {
                "kind": 0, "part": 0, "keys": [m.tobytes() for m in marks],
                "sids": list(found.values()), "sizes": b"",
            }
        )
        return pd.concat([frame[frame["kind"] == 1], made])

    packed = map_batches(docs, rows, PACKED).groupBy("part").applyInPandas(group, PACKED)
    return materialise(packed, "groups")


# Signature trees


def bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
    """One row of `width` bits (as 64-bit words) for each set."""
    out = np.zeros((len(sets), width // 64), np.uint64)
    sizes = np.array([len(s) for s in sets])
    if sizes.sum():
        cell = np.concatenate(sets) & np.uint64(width - 1)
        row = np.repeat(np.arange(len(sets)), sizes)
        bit = np.uint64(1) << (cell & np.uint64(63))
        np.bitwise_or.at(out, (row, (cell >> np.uint64(6)).astype(np.intp)), bit)
    return out


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap of fewer bits: halves laid on each other."""
    while len(bits) * 64 > width:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


def width_for(size: float, times: int) -> int:
    return int(np.clip(1 << int(np.ceil(np.log2(max(times * size, 1)))), LEAST_WIDTH, MOST_WIDTH))


class SignatureTree:
    """Levels of nodes over sets sorted by size: OR of bitmaps, range of sizes, slack.

    The slack of a set is its size less its bits, so an overlap of two sets is at most
    the bits they share and the smaller slack; for nodes, the largest slack in them.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        slack = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, sizes, sizes, slack)]
        while len(self.levels[-1][0]) > FAN:
            below = self.levels[-1]
            at = np.arange(0, len(below[0]), FAN)
            ways = (np.bitwise_or, np.minimum, np.maximum, np.maximum)
            self.levels.append(
                tuple(way.reduceat(x, at, axis=0) for way, x in zip(ways, below, strict=True))
            )

    def children(self, level: int, node: int) -> np.ndarray:
        n = len(self.levels[level - 1][0])
        return np.arange(node * FAN, min(n, (node + 1) * FAN))

    def span(self, level: int, node: int) -> slice:
        return slice(node * FAN**level, (node + 1) * FAN**level)


def possible(level_a: tuple, a: np.ndarray, level_b: tuple, b: np.ndarray) -> np.ndarray:
    """Which pairs of nodes (rows a of one level, columns b of the other) may hold a link."""
    bits_a, low_a, high_a, slack_a = (x[a] for x in level_a)
    bits_b, low_b, high_b, slack_b = (x[b] for x in level_b)
    shared = np.bitwise_count(bits_a[:, None] & bits_b[None]).sum(axis=2).astype(np.int64)
    most = shared + np.minimum(slack_a[:, None], slack_b[None])
    most = np.minimum(most, np.minimum(high_a[:, None], high_b[None]))
    fits = most >= overlap_needed(low_a[:, None], low_b[None])
    fits &= DEN * high_a[:, None] >= NUM * low_b[None]
    return fits & (DEN * high_b[None] >= NUM * low_a[:, None])


def traverse(
    left: SignatureTree,
    right: SignatureTree,
    labels: np.ndarray,
    offset: int,
    test: Callable[[int, int], bool],
) -> Iterator[tuple[int, int]]:
    """Dual traversal: links (i, offset + j) that bring sets together which weren't yet.

    `labels` has the group of each set of both trees, the right tree's from `offset`
    on (0: the trees are one). Nodes whose sets are all in one group are skipped.
    """
    same = left is right
    tops = len(left.levels) - 1, len(right.levels) - 1
    stack = [(tops, np.arange(len(left.levels[-1][0])), np.arange(len(right.levels[-1][0])))]
    while stack:
        (la, lb), a, b = stack.pop()
        fits = possible(left.levels[la], a, right.levels[lb], b)
        for i, j in zip(*np.nonzero(fits), strict=True):
            x, y = int(a[i]), int(b[j])
            if same and la == lb and x > y:
                continue
            if la == lb == 0:
                one, two = x, offset + y
                if one != two and labels[one] != labels[two] and test(one, two):
                    low, high = sorted((labels[one], labels[two]))
                    labels[labels == high] = low
                    yield one, two
                continue
            own, other = labels[left.span(la, x)], labels[offset:][right.span(lb, y)]
            if not same:
                own = labels[:offset][left.span(la, x)]
            if (own == own[0]).all() and (other == own[0]).all():
                continue
            below_a = left.children(la, x) if la else np.array([x])
            below_b = right.children(lb, y) if lb else np.array([y])
            stack.append(((max(la - 1, 0), max(lb - 1, 0)), below_a, below_b))


def exact_test(sets: list[np.ndarray]) -> Callable[[int, int], bool]:
    def linked(i: int, j: int) -> bool:
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return DEN * both >= NUM * (len(sets[i]) + len(sets[j]) - both)

    return linked


# The join


def _streams(batches, keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches, group by group of their first columns."""
    own, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != own:
                if held:
                    yield own, held
                own, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield own, held


def possible_links(groups: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): in each group, links that join all sets which may be similar.

    Groups of more than `BLOCK` sets are joined as a whole, which only makes families
    larger; the others go through a signature tree of small bitmaps.
    """

    def unpacked(batches):
        for batch in batches:
            for key, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sids = np.frombuffer(blob, np.int64)
                if len(sids) <= BLOCK:
                    yield {"key": np.full(len(sids), int.from_bytes(key, "little", signed=True)),
                           "sid": sids}

    def chained(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                sids = np.frombuffer(blob, np.int64)
                if len(sids) > BLOCK:
                    yield {"a": sids[:-1], "b": sids[1:]}

    def trees(batches):
        for _, rows in _streams(batches, 1):
            if len(rows) < 2:
                continue
            rows.sort(key=lambda row: (row[1], row[0]))
            maps = [np.frombuffer(row[2], np.uint64) for row in rows]
            width = min(len(m) for m in maps) * 64
            bits = np.array([fold(m, width) for m in maps])
            tree = SignatureTree(np.array([row[1] for row in rows], np.int64), bits)
            links = list(traverse(tree, tree, np.arange(len(rows)), 0, lambda i, j: True))
            yield {"a": [rows[i][0] for i, _ in links], "b": [rows[j][0] for _, j in links]}

    small = map_batches(groups.select("keys", "sids"), unpacked, "key long, sid long")
    small = small.distinct().join(known.select("sid", "n", "bits"), "sid")
    small = small.select("key", "sid", "n", "bits").repartition("key").sortWithinPartitions("key")
    links = map_batches(small, trees, "a long, b long")
    return links.unionByName(map_batches(groups.select("sids"), chained, "a long, b long"))


def exact_links(families: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): links that span every group of similar sets, from (sid, family).

    A family of more than `BLOCK` sets is dealt into blocks, and each pair of blocks is
    compared by itself, so no task holds more than two blocks.
    """
    sizes = families.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_blocks"))
    dealt = (
        families.join(sizes, "family")
        .withColumn("_own", F.pmod(F.xxhash64("sid"), F.col("_blocks")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .select(
            "sid", "family", "_own",
            F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"),
        )
    )
    keys = ["family", "_low", "_high"]
    rows = dealt.join(known.select("sid", "n", "shingles"), "sid")
    rows = rows.select(*keys, "_own", "n", "sid", "shingles").repartition(*keys)
    rows = rows.sortWithinPartitions(*keys, "_own", "n", "sid")

    def compare(batches):
        for (_, low, high), members in _streams(batches, 3):
            sets = [np.frombuffer(row[3], np.uint64) for row in members]
            sizes = np.array([row[1] for row in members], np.int64)
            bits = bitmaps(sets, width_for(np.median(sizes), 8))
            labels = np.arange(len(members))
            cut = sum(row[0] == low for row in members)
            test = exact_test(sets)
            if low == high:
                tree = SignatureTree(sizes, bits)
                links = list(traverse(tree, tree, labels, 0, test))
            elif 0 < cut < len(members):
                trees = (SignatureTree(sizes[x], bits[x]) for x in (slice(cut), slice(cut, None)))
                links = list(traverse(*trees, labels, cut, test))
            else:
                continue
            yield {"a": [members[i][2] for i, _ in links], "b": [members[j][2] for _, j in links]}

    return map_batches(rows, compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE
) -> DataFrame:
    """id, n_shingles and component_id (smallest id reachable by links) of every row.

    Words are lower-cased (A-Z) runs of anything but ASCII white space. A text without
    words, null included, has no shingles and is its own component. Ids are whole
    numbers; a null id is null in the result and larger than any other for its
    component. Repeated rows and copies of a text are one set and get one component.
    Sets are known by a 64-bit hash. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    return members(docs, id_col, text, size).select(
        F.when(F.col("id") != NO_ID, F.col("id")).cast(kind).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("component_id") != NO_ID, F.col("component_id")).cast(kind).alias("component_id"),
    )


def members(docs: DataFrame, id_col: str, text: str, size: int = SHINGLE) -> DataFrame:
    """(id, sid, n, component, component_id) of every row; null ids are NO_ID, empty sets have no component."""
    given = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text")
    )
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    packed = groups_and_sizes(given, total, size)

    def unpacked(batches):
        for batch in batches:
            for blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, sids, sizes = (np.frombuffer(blob, np.int64) for blob in blobs)
                yield {"id": ids, "sid": sids, "n": sizes}

    of_docs = packed.where("kind = 1").select("keys", "sids", "sizes")
    of_docs = map_batches(of_docs, unpacked, "id long, sid long, n long")
    labels = _labels(given, packed.where("kind = 0"), size)
    named = of_docs.join(labels, "sid", "left").withColumn(
        "component", F.coalesce("label", F.when(F.col("n") > 0, F.col("sid")))
    )
    smallest = named.where("component is not null").groupBy(F.col("component").alias("_c"))
    smallest = smallest.agg(F.min("id").alias("component_id"))
    # Stored, the smallest ids are joined like any table, and a large component is split.
    joined = named.join(
        materialise(smallest, "smallest"),
        F.col("component") == F.col("_c"),
        "left",
    )
    component = F.coalesce("component_id", "id").alias("component_id")
    return joined.select("id", "sid", "n", "component", component)


def _labels(given: DataFrame, groups: DataFrame, size: int) -> DataFrame:
    """(sid, label) of every set with a link."""

    found = membership(groups.select("sids"), MARK_BITS)
    marks = given.sparkSession.sparkContext.broadcast(found)

    def candidates(batches):
        sent = set()
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                texts = texts_of(batch.slice(at, DOCS_AT_ONCE))
                hashes, own = sets_of(texts, size)
                sids, sizes = set_ids(hashes, own, len(texts))
                ends = np.cumsum(sizes)
                out = {"sid": [], "n": [], "bits": [], "shingles": []}
                for k in np.flatnonzero(may_hold(marks.value, sids) & (sizes > 0)).tolist():
                    sid = int(sids[k])
                    if sid in sent:
                        continue
                    if len(sent) < 1_000_000:  # what is sent twice is dropped later
                        sent.add(sid)
                    own_set = hashes[ends[k] - sizes[k] : ends[k]]
                    bits = bitmaps([own_set], width_for(len(own_set), 2))
                    values = (sid, len(own_set), bits.tobytes(), own_set.tobytes())
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
                yield out

    schema = "sid long, n long, bits binary, shingles binary"
    sets = map_batches(given.select("text"), candidates, schema)
    firsts = [F.first(name).alias(name) for name in ("n", "bits", "shingles")]
    known = materialise(sets.groupBy("sid").agg(*firsts), "sets")
    maybe = components(possible_links(groups, known))
    families = maybe.select(F.col("node").alias("sid"), F.col("label").alias("family"))
    families = materialise(families, "families")
    labels = components(exact_links(families, known))
    return materialise(labels.select(F.col("node").alias("sid"), "label"), "labels")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` of each component, with all its columns: the one of smallest id.

    Rows without a shingle are linked with nothing, and each stays. Of several rows of the
    smallest id, or of a component all of whose ids are null, one stays: that whose text
    has the smallest hash; of equal rows any. An id that only one row has, as is usual,
    settles its row by itself; the others' texts are hashed once more to tell rows apart.
    """
    found = materialise(members(docs, id_col, text), "members")
    first = (F.col("id") == F.col("component_id")) | F.col("component").isNull()
    by_id = found.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.bool_or(first).alias("first"))
    alone = (F.col("rows") == 1) & (F.col("id") != NO_ID)
    named, status = unused(docs, "_id", "_status")
    firsts = by_id.where("first").select(F.col("id").alias(named), alone.alias(status))
    joined = docs.join(firsts, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col(named))
    settled = joined.where(F.col(status)).select(*docs.columns)

    # In plain names from here on; a row's own columns are in a struct.
    tag, check = F.xxhash64(text).alias("tag"), F.xxhash64(F.lit(1), text).alias("check")
    unsettled = joined.where(~F.col(status)).select(
        F.col(named).alias("id"), tag, check, F.col(text).alias("text"), F.struct(*docs.columns).alias("row")
    )
    texts = unsettled.select("id", "tag", "check", "text").dropDuplicates(["id", "tag", "check"])
    of_sets = found.where(first).select("id", "sid", "component").distinct()
    texts = with_set_ids(texts).join(of_sets, ["id", "sid"]).drop("sid")
    kept = unsettled.join(texts, ["id", "tag", "check"])
    empty = kept.where("component is null").select("row.*")
    one = kept.where("component is not null").groupBy("component")
    one = one.agg(F.min_by("row", F.struct("id", "tag", "check")).alias("row"))
    return settled.unionByName(empty).unionByName(one.select("row.*"))


def with_set_ids(texts: DataFrame) -> DataFrame:
    """(id, tag, check, sid): the id of the set of each text."""

    def run(batches):
        for batch in batches:
            column = texts_of(batch)
            for part in portions([len(text) for text in column], PORTION_BYTES):
                hashes, own = sets_of(column[part])
                sids, _ = set_ids(hashes, own, part.stop - part.start)
                held = batch.slice(part.start, part.stop - part.start)
                yield {"id": held.column(0), "tag": held.column(1), "check": held.column(2), "sid": sids}

    return map_batches(texts, run, "id long, tag long, check long, sid long")
