"""Token counts, secrets, chat formatting and word hashes against other ways to the same."""

import hashlib
import json
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postpulse.llm import chat, secrets, tokens
from postpulse.llm.words import hash_texts, run_hashes, window_hashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, n_tokens string, size string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    vocabulary, ranks, special = tokens.compiled(PATH)
    return tokens.PieceCounts(vocabulary, ranks), special


def library_counts(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_hashes_are_by_word():
    texts = [b"", b" a b\tab ", b"\x0b\x0c", b"a" * 20 + b" " + b"a" * 21, " é a".encode()]
    hashes, doc = hash_texts(texts)
    words = [(word, k) for k, text in enumerate(texts) for word in text.split()]
    assert doc.tolist() == [k for _, k in words]
    assert len(set(hashes.tolist())) == len({word for word, _ in words})
    by_word = {}
    for (word, _), value in zip(words, hashes.tolist(), strict=True):
        assert by_word.setdefault(word, value) == value
    assert len(hash_texts([])[0]) == 0


def test_runs_and_windows_agree_where_words_do():
    words = np.array([1, 2, 3, 1, 2, 3, 9, 1, 2], np.uint64)
    for n in (1, 2, 3, 5):
        runs = run_hashes(words, n).tolist()
        keys = [tuple(words[i : i + n].tolist()) for i in range(len(words) - n + 1)]
        assert len(runs) == len(keys)
        assert len(set(runs)) == len(set(keys)) == len(set(zip(runs, keys, strict=True)))
    spaced = window_hashes(words, [0, 2])
    assert spaced[0] == spaced[3] and spaced[1] != spaced[2]
    assert len(window_hashes(words[:2], [0, 2])) == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("'strevldmxé1٣½ \n\t.,!’日　"), max_size=60), max_size=6))
def test_tokens_of_odd_texts(library, counter, texts):
    counts, special = counter
    got = tokens.count_batch([text.encode() for text in texts], counts, special)
    assert got.tolist() == library_counts(library, texts)


def test_tokens_across_chunks_and_special_strings(library, counter):
    counts, special = counter
    texts = [
        "", " " * 3000, "a" * 5000, "-" * 700 + "x", "'" * 99, "x" * 255 + "'re" + "y" * 253 + "'s",
        "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "\n" * 300 + "z", "\x00\x85 \x1c", "é" * 400,
    ]
    got = tokens.count_batch([text.encode() for text in texts], counts, special)
    assert got.tolist() == library_counts(library, texts)


def test_token_query_rows(spark, library):
    rows = [(1, "the the", "x", "y"), (1, "the the", "x", "y"), (None, None, None, None), (3, "", "", "")]
    rows += [(4, "word " * 600, "a", "b")]
    got = tokens.token_counts(spark.createDataFrame(rows, DOCS), PATH).collect()
    want = [len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    assert sorted(r["n_tokens"] for r in got) == sorted(want)
    assert {r["doc_id"]: r["over_limit"] for r in got} == {1: False, None: False, 3: False, 4: True}
    assert sum(r["n_bytes"] for r in got) == sum(len((r[1] or "").encode()) for r in rows)
    empty = tokens.token_counts(spark.createDataFrame([], DOCS), PATH)
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


# Secrets

HEXES = "0123456789abcdef" * 3


def test_fixed_rules():
    text = f"é PassWord: 'abc12345' token=short AKIA{'Z9' * 6} AKIASHORT {HEXES} api_key = {HEXES}"
    found = [(secrets.KINDS[k], value) for _, k, _, value in secrets.base_spans(text)]
    assert found == [
        ("assign", "abc12345"), ("access", "AKIA" + "Z9" * 6), ("hex", HEXES),
        ("assign", HEXES), ("hex", HEXES),
    ]
    start, _, end, _ = secrets.base_spans(text)[0]
    assert text[start:end] == "PassWord: 'abc12345"
    # Letters that only fold to the keywords' letters aren't these letters.
    assert secrets.base_spans("to\u212aen = abcdefgh1") == []


def test_models_find_what_reads_as_random(spark):
    rng = np.random.default_rng(1)
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    key = lambda n: "".join(rng.choice(alphabet, n))
    prose = "the internationalization of counterrevolutionaries_and_representations was slow. "
    rows = [(k, f"{prose * 5} secret = {key(40)}") for k in range(60)]
    rows += [(100, f"{prose} {key(44)} {prose}"), (101, prose * 40), (102, None), (103, ""), (100, prose)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = secrets.scan(docs)
    assert got.count() == len(rows)
    by_id = {r["doc_id"]: r for r in got.where("n_markov > 0").collect()}
    assert set(by_id) == {100}
    assert got.where("doc_id = 101 and spans <> ''").count() == 0
    kind, start, end = by_id[100]["spans"].split(":")
    assert (kind, int(end) - int(start)) == ("markov", 44)
    nothing = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in got.where("doc_id >= 100").collect()} == {nothing}
    assert secrets.scan(docs.limit(0)).collect() == []


@pytest.mark.parametrize("copies", [1, 2, 20, 1000])
def test_copies_of_a_key_do_not_vouch_for_it(spark, copies):
    rng = np.random.default_rng(5)
    mixed = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    key = lambda signs, n: "".join(rng.choice(signs, n))
    words = [key(list("abcdeinorst"), k % 7 + 2) for k in range(3000)]
    rows = [(k, " ".join(rng.choice(words, 60)) + f" {key(list('0123456789abcdef'), 40)}") for k in range(60)]
    planted = [key(mixed, 40) for _ in range(10)]
    text = " and ".join(["-" * 40, "+---" * 9, "a" * 30, "-".join(words[:9]), *planted])
    rows += [(100 + k, text) for k in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = secrets.scan(docs).where("doc_id >= 100").select("n_markov", "spans").distinct().collect()
    at = [text.index(value) for value in planted]
    assert [r["spans"] for r in got] == [",".join(f"markov:{x}:{x + 40}" for x in at)]


def test_recall_by_alphabet_and_identifiers_left_alone(spark):
    rng = np.random.default_rng(8)
    words = "get account name value index table reader writer stream factory request response session".split()
    rows = [(k, " ".join(rng.choice(words, 30)) + f" token={HEXES[k % 9 : 40]}") for k in range(40)]
    models = secrets.fit(spark.createDataFrame(rows, "doc_id long, text string"))

    def found(text):
        return bool(secrets.model_spans(text, [], models, 1.0, 15.0))

    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    for signs in (lower, lower.upper(), lower + digits, lower.upper() + digits, lower + lower.upper(),
                  lower + lower.upper() + digits, lower + lower.upper() + digits + "+/"):
        for n in (24, 40):
            keys = ["".join(rng.choice(list(signs), n)) for _ in range(100)]
            assert sum(map(found, keys)) >= 90, (signs, n)
    plain = []
    for _ in range(100):
        parts = rng.choice(words, 4).tolist()
        camel = "".join(part.capitalize() for part in parts)
        plain += [camel, "_".join(parts), "/".join(parts), "_".join(parts).upper(), "".join(parts), f"{camel}2024"]
        parts = ["".join(rng.choice(list("0123456789abcdef"), n)) for n in (8, 4, 4, 4, 12)]
        assert not found("-".join(parts))
    assert sum(map(found, plain)) <= len(plain) // 50


def test_alphabets_of_labelled_strings():
    for label, value in enumerate(("abc", "AB", "12af", "1z", "1Z", "aZ", "1aZ", "a+"), 1):
        assert secrets.alphabet(value) == label
        drawn = secrets.drawn_strings(label)
        assert set("".join(drawn)) == set(secrets.ALPHABETS[label - 1])
        assert drawn == secrets.drawn_strings(label)


# Chat

TRICKY = ["<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|", "<\\\\|x", "<", "a<", "|>", "", "<|<|"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "\\n", "<|", ""]),
                          st.one_of(st.sampled_from(TRICKY), st.text(st.sampled_from("<|\\ab\n>"))))))
def test_format_reads_back(turns):
    text, spans = chat.formatted(turns)
    assert chat.read_back(text) == turns
    said = [t for role, t in turns if role == "assistant"]
    assert [chat.unescape(text[a:b]) for a, b in spans] == said
    assert len(re.findall(r"<\|im_start\|>", text)) == len(turns)


def test_layouts_are_told_by_their_paths():
    same = [("user", "q"), ("assistant", "a")]
    records = [
        '{"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}',
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',
        '{"response": "a", "prompt": "q"}', '{"prompt": "q", "completion": "a"}',
        '{"instruction": "q", "output": "a"}', '{"instruction": null, "input": "q", "output": "a"}',
    ]
    assert [chat.canonical(record) for record in records] == [same] * len(records)
    assert chat.canonical('{"prompt": {"text": "q"}, "response": "a"}') is None
    assert chat.canonical("not json") is None and chat.canonical(None) is None
    assert chat.canonical('{"prompt": 5, "response": ["a"]}') is None
    assert chat.canonical('{"prompt": 5, "response": true}') == [("user", "5"), ("assistant", "true")]
    assert chat.canonical('{"messages": []}') == []


def test_conversations_become_records_and_back(spark):
    rows = [
        (1, 2, "assistant", "a"), (1, 1, "user", "q"), (2, 0, "system", "s"), (2, 1, "user", None),
        (2, 2, "assistant", "é<|im_end|>"), (3, 0, "user", "x"), (3, 0, "user", "x"), (None, 1, None, "n"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("record", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat.digests(chat.format_records(chat.records(frame))).collect()}
    want = {
        1: [("user", "q"), ("assistant", "a")],
        2: [("system", "s"), ("user", ""), ("assistant", "é<|im_end|>")],
        3: [("user", "x"), ("user", "x")],
        None: [("", "n")],
    }
    assert set(got) == set(want)
    for key, turns in want.items():
        flat = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        assert got[key]["n_turns"] == len(turns)
        assert got[key]["turns_sha256"] == hashlib.sha256(flat.encode()).hexdigest()
        assert got[key]["loss_chars"] == len(loss)
        assert got[key]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[key]["formatted_chars"] == len(chat.formatted(turns)[0])
    assert chat.digests(chat.format_records(chat.records(frame.limit(0)))).collect() == []


# Records of odd layouts


def brute_turns(value):
    """Turns of a record, by reading it as its author would; None if that isn't clear."""
    if not isinstance(value, dict):
        return None
    fields = {k: v for k, v in value.items() if k not in chat.DESCRIPTIVE}
    if set(fields) in ({"messages"}, {"conversations"}):
        (name, turns), names = fields.popitem(), {"human": "user", "gpt": "assistant"}
        role, text = ("role", "content") if name == "messages" else ("from", "value")
        if turns == [] and name == "messages":
            return []
        if not isinstance(turns, list) or not turns:
            return None
        out = []
        for turn in turns:
            if not isinstance(turn, dict) or {k for k in turn if k not in chat.DESCRIPTIVE} != {role, text}:
                return None
            if not all(v is None or isinstance(v, str) for v in (turn[role], turn[text])):
                return None
            who = names.get(turn[role], turn[role]) if name == "conversations" else turn[role]
            out.append((who or "", turn[text] or ""))
        return out
    if any(not (v is None or isinstance(v, str)) for v in fields.values()):
        return None
    for names, roles in (
        (("prompt", "response"), ("user", "assistant")),
        (("prompt", "completion"), ("user", "assistant")),
        (("instruction", "output"), ("user", "assistant")),
        (("instruction", "input", "output"), ("system", "user", "assistant")),
    ):
        if set(fields) == set(names):
            return [(r, fields[n]) for n, r in zip(names, roles, strict=True) if fields[n] is not None]
    return None


TEXTS = st.one_of(st.none(), st.text(st.sampled_from("a<|\\n \n>im_end"), max_size=8))
TURN = st.dictionaries(
    st.sampled_from(["role", "content", "from", "value", "id", "name"]), TEXTS, max_size=4
)
FIELDS = ["prompt", "response", "completion", "instruction", "input", "output", "id", "source", "other"]
RECORDS = st.one_of(
    TEXTS,
    st.dictionaries(st.sampled_from(FIELDS), TEXTS, max_size=4),
    st.builds(
        lambda name, turns, more: {name: turns, **more},
        st.sampled_from(["messages", "conversations"]),
        st.lists(st.one_of(TURN, TURN, st.builds(lambda r, t: {"role": r, "content": t}, TEXTS, TEXTS), TEXTS), max_size=3),
        st.dictionaries(st.sampled_from(["id", "meta", "other"]), TEXTS, max_size=2),
    ),
)


@settings(max_examples=500, deadline=None)
@given(RECORDS)
def test_records_are_read_or_unknown(value):
    got = chat.canonical(json.dumps(value))
    want = brute_turns(value)
    if want is not None:
        assert got == want
    elif got is not None:  # only with turns of equal fields, some of them missing in others
        raise AssertionError(value)
    if got:
        assert chat.read_back(chat.formatted(got)[0]) == got


def test_records_that_cannot_be_read(spark):
    whole = {"messages": [{"role": "user", "content": "hi"}], "id": 3, "metadata": {"a": [1, {"b": 2}]}}
    ragged = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "user"}]},
        {"messages": [{"role": "user", "content": "hi"}, "text"]},
        {"messages": [{"role": "user", "content": "hi"}], "other": 1},
        [], 7, "text", {},
    ]
    texts = [json.dumps(whole), *map(json.dumps, ragged), "{", "", None, "[" * 100_000, '{"prompt":' * 5_000]
    texts.append('{"prompt": "half \\ud800 pair", "response": "\\ud83d\\ude00"}')
    frame = spark.createDataFrame(list(enumerate(texts)), "conv_id long, record string")
    got = {r["conv_id"]: r for r in chat.format_records(frame).collect()}
    assert [k for k, r in sorted(got.items()) if r["known"]] == [0, len(texts) - 1]
    assert chat.read_back(got[0]["formatted"]) == [("user", "hi")]
    assert chat.read_back(got[len(texts) - 1]["formatted"])[0] == ("user", "half � pair")
