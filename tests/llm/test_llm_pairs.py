"""Near duplicates, repeated substrings, near-equal lines and benchmark overlaps against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.llm import decontaminate, graph, jaccard, lines, sketches, substrings
from postpulse.sources import local_frame, materialise

DOCS = "doc_id long, text string, id string, key string"


def make_texts(seed, families=12, size=9, words=90):
    """Families of copies at rising distance, single texts, shared passages, odd cases."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 5)))
    passage = " ".join(word() for _ in range(30))
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.randint(words // 3, words))]
        for k in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + (" " + passage if rng.random() < 0.3 else ""))
    texts += ["", " \n ", "One two", "one  TWO", "one", "a b c d e", "A b c d E f", passage, passage]
    rng.shuffle(texts)
    return texts


def frame_of(spark, texts):
    rows = [(3 * k, text, "x", "y") for k, text in enumerate(texts)] + [(10_000, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def brute_components(texts):
    sets = {}
    for key, text in texts.items():
        w = (text or "").encode().translate(jaccard.LOWER).split()
        sets[key] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    label = {key: key for key in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                union = len(sets[a] | sets[b])
                if union and 100 * both >= 75 * union and label[a] < label[b]:
                    label[b], changed = label[a], True
    return {key: (len(sets[key]), label[key]) for key in sets}


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates(spark, monkeypatch, block):
    # With blocks of four, groups and families are cut; only the driver's side sees the patch,
    # and it decides the blocks of families.
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = make_texts(3, families=14, words=220)
    frame = frame_of(spark, texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame).collect()}
    want = brute_components({3 * k: t for k, t in enumerate(texts)} | {10_000: None})
    assert got == want
    assert len({c for _, c in want.values()}) < len(texts) - 10


def test_near_duplicates_of_odd_tables(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (None, text), (2, text.upper()), (9, None), (9, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(jaccard.near_duplicates(frame).collect(), key=str)
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got) == [
        (0, 3, 2), (2, 3, 2), (5, 3, 2), (5, 3, 2), (9, 0, 9), (9, 0, 9),
    ]
    kept = jaccard.one_of_each(frame.withColumn("component_id", F.lit("clash")))
    assert kept.columns == ["doc_id", "text", "component_id"]
    assert sorted(str(r["text"]) for r in kept.collect()) == ["", "None", text.upper()]
    assert jaccard.near_duplicates(frame.limit(0)).collect() == []


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(12)) for x in "abcd")
    rows = [
        (None, a), (None, a), (None, b), (5, c), (5, c), (5, d), (6, d), (7, d + " more"),
        (None, d), (8, None), (8, ""), (None, ""), (9, c + " more"), (1, "solo"), (0, "SOLO"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("_id", "_status", "id", "row", "tag", "component"):
        frame = frame.withColumn(name, F.lit(name))
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    assert {tuple(r) for r in kept.select("doc_id", "text").collect()} == {
        (None, a), (None, b), (5, c), (5, d), (8, None), (8, ""), (None, ""), (0, "SOLO")
    }
    assert kept.count() == 8 and kept.where("_id = '_id' and row = 'row'").count() == 8
    assert jaccard.one_of_each(frame.limit(0)).collect() == []


def test_a_traversal_prunes_no_link():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 60, rng.integers(5, 60)).astype(np.uint64)
        for _ in range(rng.integers(1, 9)):
            part = base[rng.random(len(base)) > rng.choice([0.0, 0.1, 0.2])]
            sets.append(np.unique(part if len(part) else base))
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    test = jaccard.exact_test(sets)
    links = {(i, j) for i in range(len(sets)) for j in range(i) if test(i, j)}
    for width in (64, 512):
        bits = jaccard.bitmaps(sets, width)
        tree = jaccard.SignatureTree(sizes, bits)
        labels = np.arange(len(sets))
        list(jaccard.traverse(tree, tree, labels, 0, test))
        assert all(labels[i] == labels[j] for i, j in links)
        cut = len(sets) // 3
        pair = [jaccard.SignatureTree(sizes[x], bits[x]) for x in (slice(cut), slice(cut, None))]
        labels = np.arange(len(sets))
        crossing = list(jaccard.traverse(*pair, labels, cut, test))
        assert all(i < cut <= j and test(i, j) for i, j in crossing)
        assert all(labels[i] == labels[j] for i, j in links if (i < cut) != (j < cut))


def test_components_of_a_long_chain(spark):
    links = [(k, k + 1) for k in range(200)] + [(500, 501), (502, 502), (None, 3), (501, 500)]
    got = graph.components(local_frame(spark, links, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}


def brute_repeats(rows, window):
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda row: row[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            if run in seen:
                gone[i : i + window] = [True] * window
            seen.add(run)
        kept = b" ".join(w for w, off in zip(words, gone, strict=True) if not off)
        out.append((key, len(words), sum(gone), kept.decode()))
    return out


@pytest.mark.parametrize("window", [20, 3])
def test_repeated_substrings(spark, window):
    texts = [*make_texts(8, families=6), "a b " * 60]
    frame = frame_of(spark, texts)
    got = sorted(map(tuple, substrings.remove_repeats(frame, window=window).collect()))
    assert got == brute_repeats([*((3 * k, t) for k, t in enumerate(texts)), (10_000, None)], window)
    assert any(row[2] for row in got)


def test_repeated_substrings_of_odd_tables(spark):
    text = " ".join(map(str, range(25)))
    rows = [(4, text), (4, text), (None, text), (1, "x " + text), (4, "y " + text)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    removed = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in got)
    # Null ids come first; rows that agree in id and text are one document.
    assert removed == [(0, 25, 0), (1, 26, 25), (4, 25, 25), (4, 25, 25), (4, 26, 25)]
    assert substrings.remove_repeats(frame_of(spark, []).limit(0)).collect() == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2])
def test_band_and_segments_lose_no_near_line(spark, edits):
    rng = random.Random(edits)
    pool = ["".join(rng.choice("abé") for _ in range(rng.choice([3, 4, 5, 6, 7, 9, 12, 16, 20, 24]))) for _ in range(40)]
    for text in list(pool):
        for _ in range(4):
            changed = list(text)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(changed))
                changed[at : at + 1] = rng.choice([[], ["x"], [changed[at], "𝄞"]])
            pool.append("".join(changed))
    pool = sorted(set(pool) - {""})
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(pool)], "doc_id long, text string")
    pairs = frame.alias("a").join(frame.alias("b"), F.col("a.doc_id") < F.col("b.doc_id"))
    near = pairs.where(lines.within(F.col("a.text"), F.col("b.text"), edits))
    want = {
        (i, j) for i, a in enumerate(pool) for j, b in enumerate(pool)
        if i < j and distance(a, b) <= edits
    }
    assert {(r[0], r[2]) for r in near.collect()} == want
    long_enough = {(i, j) for i, j in want if min(len(pool[i]), len(pool[j])) >= lines.least_chars(edits)}
    got = {r["doc_id"]: r for r in lines.dedupe_lines(frame, edits=edits).collect()}
    assert {k: r["n_links"] for k, r in got.items()} == {
        k: sum(k in pair for pair in long_enough) for k in range(len(pool))
    }
    assert {k for k, r in got.items() if r["n_removed"]} == {j for _, j in long_enough}


def test_lines_of_odd_tables(spark):
    line = "a line of more than sixteen characters"
    rows = [
        (1, f"{line}\n\n {line} \nshort\nother"), (2, f"short\n{line}s\n\t"), (3, None), (4, ""),
        (None, "short"), (2, "shorts"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit(1))
    got = {(r["doc_id"], r["n_lines"]): tuple(r)[2:] for r in lines.dedupe_lines(frame).collect()}
    assert got == {
        (1, 4): (2, 0, 1), (2, 2): (2, 2, 2), (2, 1): (1, 2, 2), (3, 0): (0, 0, 0), (4, 0): (0, 0, 0),
        (None, 1): (0, 0, 1),
    }
    cleaned = lines.without_repeats(frame.where("doc_id <> 2 or doc_id is null"))
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert texts == {1: f"{line}\n\nother", 3: None, 4: "", None: "short"}
    assert lines.dedupe_lines(frame.limit(0)).collect() == []


def test_benchmark_passages(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    items = [[word() for _ in range(n)] for n in (40, 25, 12, 6, 3)]
    prose = lambda n: [word() for _ in range(n)]

    def changed(item, every):
        return [word() if k % every == every - 1 else w for k, w in enumerate(item)]

    docs = {
        1: prose(50) + items[0] + prose(50), 2: prose(5) + changed(items[0], 7) + prose(500),
        3: [w.upper() + "," for w in items[1]], 4: prose(30) + items[2], 5: items[3] + prose(9),
        6: prose(200), 7: prose(20) + items[0][:16] + prose(20), 8: prose(9) + items[4] + prose(9),
        9: prose(40) + items[0][:6] + prose(40), 10: [], 11: prose(3000) + items[1] + prose(2000),
    }
    rows = [(k, " ".join(v), "c") for k, v in docs.items()] + [(12, None, "c"), (None, " ".join(docs[1]), "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = [(k, " ".join(v)) for k, v in enumerate(items)] + [(7, None), (8, "")]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(frame, benchmark).collect()}
    assert {k for k, r in got.items() if r["contaminated"]} == {1, 2, 3, 4, 5, 7, 11, None}
    assert {k: got[k]["item_id"] for k in (1, 2, 3, 4, 5, 7, 11)} == {1: 0, 2: 0, 3: 1, 4: 2, 5: 3, 7: 0, 11: 1}
    assert got[1]["overlap"] == 40 and got[7]["overlap"] == 16 and got[11]["n_items"] == 1
    clashing = frame.withColumns({"_tag": F.lit(1), "_check": F.lit(2)})
    assert decontaminate.without_contaminated(clashing, benchmark).columns == clashing.columns
    left = decontaminate.without_contaminated(frame, benchmark)
    assert left.columns == frame.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [6, 8, 9, 10, 12]
    for docs_, bench_ in ((frame, benchmark.limit(0)), (frame.limit(0), benchmark)):
        assert not [r for r in decontaminate.contamination(docs_, bench_).collect() if r["contaminated"]]


def test_short_items_with_changed_words(spark):
    """Every place of one changed word in items of 5 to 11 words, and every two of those of 10 and 11."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    items, rows, wanted = [], [], {}
    for n in range(4, 12):
        own = [word() for _ in range(n)]
        items.append((n, " ".join(own)))
        free = n - decontaminate.needed_words(n)
        changes = [c for size in range(free + 2) for c in itertools.combinations(range(n), size)]
        for change in changes:
            text = [word() if k in change else w for k, w in enumerate(own)]
            around = [word() for _ in range(rng.choice([0, 9, 300]))]
            rows.append((len(rows), " ".join(around + text + around)))
            wanted[len(rows) - 1] = n if len(change) <= free else None
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["item_id"] for r in decontaminate.contamination(docs, benchmark).collect()}
    assert got == wanted


def test_largest_flags_are_those_of_the_finer_cells():
    rng = np.random.default_rng(5)
    fine, level = 3, lambda n: np.digitize(n, [1, 3], right=True).astype(np.uint8)
    lists = [np.sort(rng.integers(0, 4_000, 700)).astype(np.uint32) for _ in range(3)]
    want = np.zeros(1 << sketches.RANGE_BITS, np.uint8)
    for value, n in zip(*np.unique(np.concatenate(lists), return_counts=True), strict=True):
        want[value >> fine] = max(want[value >> fine], level(n))
    got = sketches.largest_flags(lists, level, fine)
    assert got.dtype == want.dtype and (got == want).all() and set(want) == {0, 1, 2}


def test_a_full_sketch_still_tells_which_shingles_are_alone(spark, monkeypatch):
    """Of twice as many words as the sketch has cells, those met once stay where they are."""
    monkeypatch.setattr(jaccard, "MOST_BITS", 20)
    rng = np.random.default_rng(6)
    words = rng.integers(100_000, 1_000_000, (2_000, 1_050))
    texts = [" ".join(map(str, row)) for row in words.tolist()]
    rows = [(i, text) for i, text in enumerate(texts)] + [(2_000 + i, texts[i] + " end") for i in range(0, 60, 3)]
    docs = materialise(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    total = sum(len(text) for _, text in rows)
    bits, planes = jaccard.rarity(docs.select("text"), total, jaccard.SHINGLE)
    hashes, own = jaccard.sets_of([text.encode() for text in texts[:60]])
    cell = sketches.cells(hashes, 0, bits)
    level = sketches.look_up(planes[0], cell) + 2 * sketches.look_up(planes[1], cell)
    copied = own % 3 == 0
    assert bits == 20 and (level[copied] > 0).all()
    assert (level[~copied] == 0).mean() > 0.8
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert found == {i: i if i < 2_000 else i - 2_000 for i, _ in rows}
