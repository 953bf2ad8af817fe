"""Mixing, quality rules, shards and the pipeline against brute force."""

import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postpulse.llm import mixing, quality, shards

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, lang="en"):
    common = quality.COMMON[lang]
    odd = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    words = [rng.choice(common) if rng.random() < 0.4 else rng.choice(odd) for _ in range(n)]
    return " ".join(words).capitalize() + "."


# Mixing


def brute_mix(rows):
    sizes = {row: len(WORD.findall(row[1] or "")) for row in rows}
    by = defaultdict(list)
    for row in rows:
        by[row[3]].append(row)
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode("utf-32-be"))
    names += [None] * (None in by)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    size = {s: sum(sizes[r] for r in by[s]) for s in by}
    budget, free, target = 1.5 * sum(size.values()), set(by), {}
    while True:
        level = budget / max(sum(weight[s] for s in free), 1)
        over = {s for s in free if weight[s] * level >= 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in over}
        budget -= sum(2 * size[s] for s in over)
        free -= over
        if not over:
            return sizes, size, target | {s: weight[s] * level for s in free}


def mix_rows(seed):
    rng = random.Random(seed)
    rows = [(k, prose(rng, rng.randint(1, 60)), "en", "hot", 0) for k in range(300)]
    rows += [(1000 + k, prose(rng, rng.randint(1, 60)), "en", rng.choice(["b", "c", "dé", None]), 0) for k in range(150)]
    rows += [(2000, None, "en", "b", 0), (2001, "", "en", "empty", 0), (None, "one two", "en", "b", 0)]
    return rows


@pytest.mark.parametrize("bucket_rows", [4096, 8])
def test_mix_meets_its_targets(spark, bucket_rows):
    rows = mix_rows(1)
    sizes, size, target = brute_mix(rows)
    got = mixing.mix(spark.createDataFrame(rows, COLUMNS), bucket_rows=bucket_rows).collect()
    assert len(got) == len(rows)
    by_id, taken = {r["doc_id"]: r for r in got}, defaultdict(int)
    for row, n in sizes.items():
        r = by_id[row[0]]
        assert (r["size"], r["source_size"]) == (n, size[row[3]])
        assert r["target"] == pytest.approx(target[row[3]])
        assert 0 <= r["taken"] <= 2 * n
        assert r["taken"] == sum(p["words"] for p in r["parts"])
        assert all(0 <= p["moment"] <= 1 for p in r["parts"])
        taken[row[3]] += r["taken"]
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in target)
    again = mixing.mix(spark.createDataFrame(rows[::-1], COLUMNS).repartition(7)).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in got}


def test_moments_invert_the_demand(spark):
    places = [k / 10 for k in range(11)]
    for slope in (-0.5, 0.0, 0.5):
        frame = spark.createDataFrame([(p,) for p in places], "p double")
        times = [r[0] for r in frame.select(mixing.moment(F.col("p"), F.lit(slope)), "p").collect()]
        asked = [(1 - slope) * t + slope * t * t for t in sorted(times)]
        assert asked == pytest.approx(places)


def test_the_mixed_documents_are_in_order_and_whole(spark):
    rows = mix_rows(2)
    frame = spark.createDataFrame(rows, COLUMNS).withColumn("size", F.lit("clash"))
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    _, _, target = brute_mix(rows)
    got, words = mixed.collect(), defaultdict(int)
    for r in got:
        words[r["source"]] += len(WORD.findall(r["text"]))
    texts = {r["text"] for r in frame.select("text").collect()}
    assert {r["text"] for r in got} <= texts
    largest = max(len(WORD.findall(t or "")) for t in texts)
    for source, wanted in target.items():
        assert abs(words[source] - wanted) <= largest / 2 + 1
    ordered = mixing.training_order(mixing.mix(frame), 5)
    moments = [r["moment"] for r in ordered.collect()]
    assert moments == sorted(moments) and len(moments) == len(got)
    assert mixing.mixed_documents(frame.limit(0)).collect() == []


# Quality


def brute_base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    gone = [False] * len(words)
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            gone[i : i + 8] = [True] * 8
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": sum(gone),
        "base_failed": len(words) < 20 or 100 * sum(gone) > 30 * len(words),
    }


def quality_rows():
    rng = random.Random(4)
    langs = [rng.choice(["en", "de"]) for _ in range(190)]
    rows = [(k, prose(rng, rng.randint(5, 25), lang), lang, "s", 0) for k, lang in enumerate(langs[:20])]
    rows += [(k, prose(rng, rng.randint(80, 200), lang), lang, "s", 0) for k, lang in enumerate(langs) if k >= 20]
    again = prose(rng, 9)
    rows += [
        (200, None, "en", "s", 0), (201, "", None, "s", 0), (202, " \n\t\n", "xx", "s", 0),
        (203, f"{again} " * 9, "en", "s", 0), (204, f"{again}\n{again}\n\n{prose(rng, 80)}", "en", "s", 0),
        (205, " ".join(f"w{k}###&&&" for k in range(90)), "en", "s", 0),
        (206, "x " * 700, None, "s", 0), (207, " | ".join(prose(rng, 2) for _ in range(90)), "de", "s", 0),
        (208, "a b c d e f g h " * 2 + prose(rng, 90), "en", "s", 0), (209, prose(rng, 50, "fr"), "fr", "s", 0),
    ]
    return rows + [rows[3]]


def test_base_counts_and_verdicts(spark):
    rows = quality_rows()
    frame = spark.createDataFrame(rows, COLUMNS).withColumn("n_words", F.lit("clash"))
    got = {r["doc_id"]: r for r in quality.rated(frame).collect()}
    assert quality.rated(frame).count() == len(rows)
    for key, text, *_ in rows:
        assert {k: got[key][k] for k in brute_base(text)} == brute_base(text), key
    rejected = {k for k, r in got.items() if not r["kept"] and not r["base_failed"]}
    assert 205 in rejected, got[205]
    assert not rejected & set(range(190))
    assert not any(r["kept"] for r in got.values() if r["base_failed"])
    assert quality.rated(frame.limit(0)).collect() == []


def test_texts_of_few_words_without_common_ones_go(spark):
    rng = random.Random(5)
    odd = ["".join(rng.choice("abcdeinorst") for _ in range(6)) for _ in range(2000)]

    def text(n, lang):  # a fifth is common, as in the given documents
        common = quality.COMMON[lang]
        return " ".join(rng.choice(common) if k % 5 == 0 else rng.choice(odd) for k in range(n))

    langs = [rng.choice(["en", "de"]) for _ in range(300)]
    rows = [(k, text(rng.randint(30, 300), lang), lang, "s", 0) for k, lang in enumerate(langs)]
    lengths = [30, 40, 55, 70, 85, 110]
    for first, sep in ((1000, " "), (2000, " | "), (3000, "\n")):
        rows += [(first + n, sep.join(rng.sample(odd, n)), rng.choice(["en", "de"]), "s", 0) for n in lengths]
    rows += [(4000 + n, " ".join(rng.choices(odd, k=n // 5 + 1) * 5), "en", "s", 0) for n in lengths]
    got = {r["doc_id"]: r for r in quality.rated(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert [k for k in got if k >= 1000 and got[k]["kept"]] == []
    assert [k for k in range(300) if not got[k]["kept"]] == []


def test_distance_is_jensen_shannon(spark):
    cases = [([1, 1], [1, 1]), ([4, 0], [0, 3]), ([2, 6], [5, 5]), ([0, 0], [1, 1])]

    def want(p, q):
        p, q = ([x / max(sum(v), 1) for x in v] for v in (p, q))
        parts = [x * math.log2(2 * x / (x + y)) for a, b in ((p, q), (q, p)) for x, y in zip(a, b, strict=True) if x]
        return math.sqrt(max(sum(parts) / 2, 0))

    frame = spark.createDataFrame(cases, "p array<long>, q array<long>")
    got = [r[0] for r in frame.select(quality.distance(F.col("p"), F.col("q"))).collect()]
    assert sorted(got) == pytest.approx(sorted(want(p, q) for p, q in cases))


# Shards


def brute_best_fit(sizes, capacity, n=None):
    room, chosen = [capacity] * (n or 0), {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        fits = [(left, -k) for k, left in enumerate(room) if left >= size]
        if fits:
            at = -min(fits)[1]
        elif n:
            at = -max((left, -k) for k, left in enumerate(room))[1]
        else:
            room.append(max(capacity, size))
            at = len(room) - 1
        room[at] -= size
        chosen[item] = at
    return chosen


@pytest.mark.parametrize("n", [None, 7])
def test_best_fit(n):
    rng = random.Random(6)
    sizes = [(rng.choice([1, 5, 5, 30, 99, 140]), f"i{k}") for k in range(300)]
    capacity = 100 if n is None else sum(s for s, _ in sizes) / n
    assert shards.best_fit(sizes, capacity, n) == brute_best_fit(sizes, capacity, n)


def check_shards(rows, got, n, whole):
    assert len(got) == len(rows)
    slots, bytes_, of_text = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in got:
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        slots[r["shard"]].append(r["slot"])
        bytes_[r["shard"]] += r["size"]
        of_text[text].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(of_text[t.encode()]) == 1 for t in whole)
    return [bytes_[k] for k in range(n)]


def test_shards_are_even_and_groups_whole(spark):
    rng = random.Random(7)
    rows = [(k, prose(rng, rng.randint(1, 80))) for k in range(1500)]
    copies = prose(rng, 30)
    rows += [(5000 + k, copies) for k in range(12)] + [(6000 + k, "hot " * 50) for k in range(700)]
    rows += [(1, None), (1, None), (None, "x"), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash"))
    got = shards.assign_shards(frame, 10).collect()
    loads = check_shards(rows, got, 10, [copies, ""])
    assert max(loads) < 1.05 * min(loads)
    narrow = shards.assign_shards(frame.repartition(9), 10, keep_text=False).collect()
    assert sorted((str(r["doc_id"]), r["shard"], r["slot"]) for r in narrow) == sorted(
        (str(r["doc_id"]), r["shard"], r["slot"]) for r in got
    )
    assert shards.assign_shards(frame.limit(0), 10).collect() == []


def test_a_group_that_fits_one_shard_stays_whole(spark):
    rng = random.Random(8)
    rows = [(k, prose(rng, rng.randint(1, 80))) for k in range(3000)]
    share = sum(len(text.encode()) + 16 for _, text in rows) / 7.2  # with 2.8 shards of copies: 10
    groups = {part: f"{part} " * 40 for part in (0.6, 0.9, 1.3)}
    for part, text in groups.items():
        first = len(rows)
        rows += [(first + k, text) for k in range(int(part * share / (len(text) + 16)))]
    got = shards.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    loads = check_shards(rows, got, 10, [groups[0.6], groups[0.9]])
    assert max(loads) < 1.05 * min(loads)
    assert len({r["shard"] for r in got if r["text"] == groups[1.3]}) > 1


# Pipeline


def test_pipeline_stages_do_what_they_decide(spark, tmp_path):
    rng = random.Random(9)
    passage = prose(rng, 30)
    rows = [(k, prose(rng, rng.randint(70, 150)), "en", f"s{k % 4}", 0) for k in range(150)]
    rows += [(200 + k, rows[k][1], "en", "s1", 0) for k in range(20)]
    rows += [(300 + k, rows[k + 30][1] + " tail", "en", "s1", 0) for k in range(20)]
    rows += [(400, prose(rng, 30) + " " + passage + " " + prose(rng, 30), "en", "s2", 0)]
    rows += [(500, "too short", "en", "s0", 0), (501, None, None, None, None), (502, "", "en", "s3", 0)]
    rows += [(503, " ".join(f"w{k}###&&&" for k in range(90)), "en", "s0", 0)]
    frame = spark.createDataFrame(rows, COLUMNS)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    rated = {r["doc_id"] for r in quality.rated(frame).where("kept").collect()}
    assert rated == {r[0] for r in rows} - {500, 501, 502, 503}
    docs = corpus_pipeline.quality_rules(spark, frame, str(tmp_path))
    assert {r["doc_id"] for r in docs.collect()} == rated
    docs = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in docs.collect()} == set(range(150)) | {400}
    docs = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    left = {r["doc_id"] for r in docs.collect()}
    assert left == set(range(150))
    mixed = corpus_pipeline.mixed(spark, docs, str(tmp_path))
    assert mixed.columns == frame.columns
    want = sorted((r["doc_id"], r["text"]) for r in mixed.collect())
    _, _, target = brute_mix([row for row in rows if row[0] in left])
    words = defaultdict(int)
    for key, text in want:
        words[f"s{key % 4}"] += len(WORD.findall(text))
    # Texts are whole, so a source comes within half a document of its target.
    assert {text for _, text in want} <= {row[1] for row in rows}
    assert all(abs(words[s] - t) <= 76 for s, t in target.items())
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == want
    loads = check_shards(want, got, corpus_pipeline.SHARDS, [])
    assert len(loads) == 40 and all(loads)
