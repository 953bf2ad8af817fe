"""Language ID, phrases and conversation repair against other ways to the same."""

import hashlib
import random
import re
from collections import Counter
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postpulse.llm import language, phrases, queries, repair

# Language ID

WORDS = {
    "en": "the of and house water thing with shower threat".split(),
    "fr": "le la des eau être quelle nous maison avec".split(),
    "el": "και το της νερό σπίτι είναι μαζί".split(),
}


def brute_trigrams(text):
    spaced = " " + re.sub(r"[^\w]|[\d_]", " ", text.lower()) + " "
    spaced = re.sub(" +", " ", spaced)
    return Counter(spaced[i : i + 3] for i in range(len(spaced) - 2)) if spaced != " " else Counter()


@pytest.mark.parametrize("piece", [4, 7, 500_000])
def test_trigrams_of_a_text_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(language, "PIECE_CHARS", piece)
    for text in ("", "a", "A  b", "12 34", "Être, ou ne pas être? ça!", "x" * 30, " a1b2c3 ", "日本語 text"):
        keys, counts = language.trigrams(text)
        got = {}
        for key, n in zip(keys.tolist(), counts.tolist(), strict=True):
            codes = (key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF)
            got["".join(chr(c) if c else " " for c in codes)] = n
        assert got == dict(brute_trigrams(text))


def test_bundles_are_sums_of_bound_letters(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS[k]) for _ in range(rng.randint(0, 30))) for k in WORDS for _ in range(40)]
    texts[5] = "".join(chr(rng.randint(0x4E00, 0x4FFF)) for _ in range(500))
    want = np.zeros((len(texts), language.DIMENSIONS))
    for k, text in enumerate(texts):
        for gram, n in brute_trigrams(text).items():
            a, b, c = (language.letter_vector(0 if ch == " " else ord(ch)).astype(int) for ch in gram)
            want[k] += n * np.roll(a, 2) * np.roll(b, 1) * c
    assert (language.bundled(texts) == want).all()
    monkeypatch.setattr(language, "GRAM_BLOCK", 16)
    assert (language.bundled(texts) == want).all()


def test_languages_of_held_out_texts(spark):
    rng = random.Random(1)
    rows = []
    for k in range(300):
        lang = rng.choice(list(WORDS))
        rows.append((k, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 40))), lang, "x"))
    odd = [(1000, None, "en"), (1001, "12 !? 34", "en"), (None, "the water", None), (1002, "", None), (1002, "", None)]
    rows += [(*row, "y") for row in odd]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, profile string")
    learn = F.col("doc_id") % 3 != 1
    got = [tuple(r) for r in language.predict(docs, learn).collect()]
    assert len(got) == len(rows)
    by_id = {r[0]: r[1:] for r in got}
    held = [r for r in rows if r[0] is not None and r[0] < 1000 and r[0] % 3 == 1]
    assert np.mean([by_id[r[0]][0] == r[2] for r in held]) > 0.98
    assert by_id[1000] == by_id[1001] == by_id[1002] == ("und", 0.0)
    assert by_id[None][0] == "en" and all(0 <= r[2] <= 1 for r in got)
    untaught = language.predict(docs, F.lit(False)).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in untaught] == [("und", 0.0)]
    assert language.predict(docs.limit(0), learn).collect() == []


# Phrases


def brute_phrases(rows, least, most):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    cands = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= least}
    out = {}
    for (lang, words), a in cands.items():
        longer = [
            n
            for (other, more), n in cands.items()
            if other == lang and len(more) > len(words)
            and any(more[i : i + len(words)] == words for i in range(len(more)))
        ]
        if any(100 * n >= 80 * a for n in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return {
        (lang, rank, text.decode(), -a, l, r, total[lang], -score)
        for lang, own in out.items()
        for rank, (score, a, text, l, r) in enumerate(sorted(own)[:most], 1)
    }


PHRASE_DOCS = "lang string, text string, words string, n long"


@pytest.mark.parametrize("least,tasks", [(3, 10), (3, 100_000), (5, 40)])
def test_phrases_of_odd_texts(spark, monkeypatch, least, tasks):
    monkeypatch.setattr(phrases, "TASK_ROWS", tasks)
    monkeypatch.setattr(phrases, "PORTION_BYTES", 300)
    rng = random.Random(least)
    parts = ["a", "B", "b", "é", "É", "the", "\x01", "x\x00y", "日本", " ", "\t", "  ", ".", "\n", ",", "a b c d"]
    rows = [("en", " ".join(rng.choices(parts, k=rng.randint(0, 40)))) for _ in range(120)]
    rows += [(rng.choice(["en", "english1", "english2", None, "und"]), " ".join(rng.choices(parts[:6], k=25))) for _ in range(40)]
    rows += [(None, None), ("fr", ""), ("fr", "solo"), ("en", "a b " * 400)] + [("de", "immer das selbe wort")] * 7
    docs = spark.createDataFrame([(*row, "n", 1) for row in rows], PHRASE_DOCS).repartition(5)
    got = {tuple(r) for r in phrases.collocations(docs, least=least, most=20).collect()}
    assert got == brute_phrases(rows, least, 20)
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_quicksort_partitions_are_counts():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 4, (300, 5))
    codes[:, 0] += 1
    for k in range(1, 5):
        codes[codes[:, k - 1] == 0, k] = 0
    n = rng.integers(1, 5, 300)
    want = Counter()
    for row, size in zip(codes.tolist(), n.tolist(), strict=True):
        for depth in range(1, 6):
            if row[depth - 1]:
                want[tuple(row[:depth])] += size
    got = {tuple(codes[r, :d].tolist()): size for r, d, size in phrases.quicksorted(codes, n, 12)}
    assert got == {k: v for k, v in want.items() if v >= 12}


def test_suffixes_leave_a_task_once(spark):
    """The same texts in 64 pieces: rows are suffixes times tasks, of which there are two a core."""
    text = F.lit("one two three four. one two")
    docs = spark.range(0, 640, 1, 64).select(F.lit("en").alias("lang"), text.alias("text"))
    found = phrases.suffixes(docs, least=30)
    tasks = found.select(F.spark_partition_id().alias("task"), "*").collect()
    counts = {}
    for row in tasks:
        counts[row["suffix"]] = counts.get(row["suffix"], 0) + row["n"]
    assert counts == {
        "one two three four": 640, "two three four": 640, "three four": 640, "four": 640, "one two": 640, "two": 640,
    }
    assert len(tasks) <= len(counts) * phrases.TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def test_folds_hold_what_they_left():
    def part(keys):
        names = pa.array([f"w{k}" for k in keys], pa.string())
        return np.array(keys, np.uint64), pa.array(["en"] * len(keys), pa.string()), names, np.ones(len(keys), np.int64)

    (keys, lang, text, n), *more = phrases.folds((part(range(10)) for _ in range(50)), 40)
    assert not more and n.tolist() == [50] * 10 and text.to_pylist() == [f"w{k}" for k in keys.tolist()]
    parts = list(phrases.folds((part(range(k, k + 7)) for k in range(0, 300, 5)), 40))
    total = {}
    for keys, _, _, n in parts:
        assert len(keys) < 40 + 7
        for key, times in zip(keys.tolist(), n.tolist(), strict=True):
            total[key] = total.get(key, 0) + times
    assert len(parts) > 1 and sum(total.values()) == 60 * 7 and total[5] == 2 and total[7] == 1
    assert list(phrases.folds(iter([]), 40)) == []


# Conversation repair


def brute_repair(rows):
    """Cheapest audit over the grammar as an automaton, row by row."""

    @lru_cache(None)
    def go(i, place, inserted):
        found = [] if i < len(rows) or place not in "-a" else [(0, "")]
        after = {"-": "u", "s": "u", "u": "a", "a": "u"}[place]
        if inserted < 3:
            cost, audit = go(i, after, inserted + 1)
            found.append((cost + 2, "I" + audit))
        if i < len(rows):
            row = rows[i]
            cost, audit = go(i + 1, place, 0)
            found.append((cost + 3, "D" + audit))
            if row != "x":
                if row[0] == "s" and place == "-":
                    cost, audit = go(i + 1, "s", 0)
                    found.append((cost + int(row[1]), "K" + audit))
                cost, audit = go(i + 1, after, 0)
                keep = row[0] == after
                found.append((cost + int(row[1]) + 2 * (not keep), ("K" if keep else "R") + audit))
        return min(found, default=(10**9, ""))

    return go(0, "-", 0)


ROWS = st.lists(st.sampled_from(["u0", "u1", "a0", "a1", "s0", "s1", "?0", "?1", "x"]), min_size=1, max_size=14)


@settings(max_examples=400, deadline=None)
@given(ROWS, st.integers(1, 5))
def test_alignment_is_cheapest_and_least(rows, block):
    want = brute_repair(tuple(rows))
    assert repair.final(repair.aligned(tuple(rows), True)) == want
    blocks = [repair.aligned(tuple(rows[i : i + block])) for i in range(0, len(rows), block)]
    while len(blocks) > 1:
        blocks = [repair.chained(blocks[0], blocks[1]), *blocks[2:]]
    assert repair.final(blocks[0]) == want


def brute_conversations(rows):
    groups = {}
    for key, turn, role, text in rows:
        own = groups.setdefault(key, [])
        code = crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if code == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        role = "user" if code == 4 else role
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        own += [(turn is not None, turn or 0, digest, role, text)] * (1 + (code == 3))
    out = set()
    for key, own in groups.items():
        own.sort(key=lambda r: r[:3])
        seen, marks, counts, illegal = set(), [], Counter(), 0
        for k, (_, _, _, role, text) in enumerate(own):
            shown = text.rstrip(" \t\n\v\f\r")
            kind = "blank" if not shown else "dup" if (role, text) in seen else "cut" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[kind] += 1
            initial = role[:1] if role[:1] and role[:1] in "sua" else "?"
            marks.append("x" if kind in ("blank", "dup") else initial + str(int(kind == "cut")))
            illegal += k > 0 and own[k - 1][3][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit = brute_repair(tuple(marks)) if own else (0, "")
        odd = len(audit.replace("D", "")) % 2
        lines, source = [], iter(own)
        for edit in audit:
            row = None if edit == "I" else next(source)
            if edit != "D":
                role = "user" if (len(lines) - odd) % 2 == 0 else "assistant"
                lines.append(f"{row[3] if edit == 'K' else role}:{row[4] if row else ''}")
        turns = [r[1] for r in own if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.add((key, gaps, counts["blank"], counts["dup"], counts["cut"], illegal, cost, audit, digest))
    return out


@pytest.mark.parametrize("tasks", [7, 100_000])
def test_conversations_of_odd_rows(spark, monkeypatch, tasks):
    monkeypatch.setattr(repair, "TASK_ROWS", tasks)
    monkeypatch.setattr(repair, "BLOCK_ROWS", 9)
    rng = random.Random(tasks)
    texts = ["Yes.", "No", "", " \t", "a?", "b!", None, "é.\n", "c. ", "Long one."] + [f"text {k}." for k in range(30)]
    roles = ["user", "assistant"] * 6 + ["system", "tool", None, "", "User", "umpire"]
    rows = [
        (key, rng.choice([None, 0, 1, 2, 3, 5, 8, 11]), rng.choice(roles), rng.choice(texts))
        for key in [*range(60), None]
        for _ in range(rng.randint(1, 9))
    ]
    rows += [(77, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(150)]
    rows += [(78, 4, "user", "same.")] * 40 + [(79, k, "user", "same.") for k in range(40)]
    frame = spark.createDataFrame(
        [(*row, "x", 0) for row in rows], "conv_id long, turn long, role string, text string, digest string, step int"
    )
    answer = repair.repair(frame.repartition(3))
    assert {tuple(r) for r in answer.collect()} == brute_conversations(rows)
    assert answer.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert repair.repair(frame.limit(0)).collect() == []


def test_language_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op11_hyperdimensional_language(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]) > 0.95
