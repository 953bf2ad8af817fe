"""Secret scan: three fixed rules, and character Markov models for the rest.

First-order models over characters are fitted on different tokens. One is of ordinary
tokens: those of the corpus that are short, or long and made of words and numbers, and
identifiers drawn from the words of Spark's stop-word lists. The others are of random strings, a model for each alphabet that keys are written in: drawn
samples, and the values that the fixed rules find in the corpus. A long run of token
characters is a secret when the log likelihood ratio of the mean of the random models to
the ordinary one, in total and per pair of characters, is high. Copies of a document and
repeats of a key change no model.
"""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import map_batches

# The rules, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

LEAST = 20
TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
# Words of a case each and numbers, with marks between. A longer word is asked about.
WORDS = re.compile(rf"(?:(?:[A-Z]?[a-z]{{1,{LEAST - 2}}}|[A-Z]{{1,{LEAST - 1}}}|[0-9]+)(?:[+/_=-]+|\Z))+")
# An identifier that is random by design and no secret.
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
SYMBOLS = "\nabcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
N = len(SYMBOLS) + 2  # further: other ASCII characters, and bytes of other characters
CODES = np.full(256, N - 2, np.int32)
CODES[128:] = N - 1
CODES[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
# Alphabets of random strings; the label of one is its place here, from 1.
ALPHABETS = (
    string.ascii_lowercase,
    string.ascii_uppercase,
    string.digits + "abcdef",
    string.digits + string.ascii_lowercase,
    string.digits + string.ascii_uppercase,
    string.ascii_letters,
    string.digits + string.ascii_letters,
    string.digits + string.ascii_letters + "+/_=-.",
)
LABELS = len(ALPHABETS) + 1
DRAWN, DRAWN_CHARS, SEED = 400, 40, 11  # random strings of each alphabet, and their length
LISTS = ("english", "french", "german", "spanish", "italian", "portuguese", "dutch", "finnish", "turkish")
RARE = 0.1  # share of a symbol's pairs in the ordinary model that follow the single symbols
IDENTIFIERS = 4000  # identifiers drawn, in turn in each style
MARKS = np.isin(np.arange(N), CODES[[ord(c) for c in "+/_=-"]])


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the fixed rules, in code points, by start and kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                found.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def ordinary(run: str) -> bool:
    """Short, or short words in one case or capitalised and numbers with marks between."""
    return len(run) < LEAST or WORDS.fullmatch(run) is not None


def alphabet(value: str) -> int:
    """Label of a random string: the first alphabet that has all its characters."""
    used = set(value)
    return next((k for k, own in enumerate(ALPHABETS, 1) if used <= set(own)), LABELS - 1)


def drawn_strings(label: int) -> list[str]:
    """Labelled samples of an alphabet, the same in every run."""
    draw = random.Random(SEED + label)
    return ["".join(draw.choices(ALPHABETS[label - 1], k=DRAWN_CHARS)) for _ in range(DRAWN)]


def drawn_identifiers() -> list[str]:
    """Labelled samples of ordinary identifiers, the same in every run."""
    lists = (StopWordsRemover.loadDefaultStopWords(name) for name in LISTS)
    words = sorted({word for own in lists for word in own if re.fullmatch("[a-z]{3,}", word)})
    draw, found = random.Random(SEED), []
    for k in range(IDENTIFIERS):
        parts = draw.choices(words, k=draw.randint(2, 5))
        camel = "".join(part.capitalize() for part in parts)
        styles = (
            camel, parts[0] + camel[len(parts[0]) :], "".join(parts), "_".join(parts), "-".join(parts),
            "/".join(parts), "_".join(parts).upper(), "_".join([*parts, str(draw.randrange(3000))]),
        )
        found.append(styles[k % len(styles)])
    return found


def _pairs(texts: list[str]) -> np.ndarray:
    """Counts of neighbouring symbols; a line end stands before and after each text."""
    joined = "\n".join(["", *texts, ""]).encode()
    codes = CODES[np.frombuffer(joined, np.uint8)]
    return np.bincount(codes[:-1] * N + codes[1:], minlength=N * N)


def labelled_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """(label, token), each once: the rules' values that aren't ordinary, labelled by their
    alphabet from 1, and ordinary runs that meet no value (0).

    Long runs that aren't made of words have no label: they are what is asked about.
    """

    def rows(batches):
        for batch in batches:
            plain, values = set(), set()
            for one in batch.column(0).to_pylist():
                if not one:
                    continue
                base = base_spans(one)
                values.update(value for *_, value in base)
                if base:
                    runs = [
                        m[0]
                        for m in RUN.finditer(one)
                        if not any(a < m.end() and m.start() < b for a, _, b, _ in base)
                    ]
                else:
                    runs = RUN.findall(one)
                plain.update(runs)
            plain = [run for run in plain if ordinary(run)]
            values = [value for value in values if not ordinary(value)]
            labels = [0] * len(plain) + [alphabet(value) for value in values]
            yield {"label": labels, "token": [*plain, *values]}

    return map_batches(docs.select(text), rows, "label int, token string").distinct()


def pair_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(label, pair, n): symbol pairs in all different tokens of each label.

    The different tokens are shuffled, with those of a batch folded before. LABELS * N * N
    rows a partition are shuffled then at most and as many in all are returned.
    """

    def rows(batches):
        counts = np.zeros((LABELS, N * N), np.int64)
        for batch in batches:
            labels, tokens = (column.to_pylist() for column in batch.columns)
            for label in range(LABELS):
                own = [t for k, t in zip(labels, tokens, strict=True) if k == label]
                if own:
                    counts[label] += _pairs(own)
        label, pair = np.nonzero(counts)
        yield {"label": label, "pair": pair, "n": counts[label, pair]}

    found = map_batches(labelled_tokens(docs, text), rows, "label int, pair int, n long")
    return found.groupBy("label", "pair").agg(F.sum("n").alias("n"))


class Models:
    """Pair counts of all labels, and the log likelihood ratio of a string.

    Pairs are smoothed by the single symbols of their model with the weight of so many
    pairs, so a symbol that is rare in a model stays rare after one it wasn't met after.
    The weight of the ordinary model is one pair, as each of its tokens counts once. A
    string that was counted as ordinary was so once; its pairs are taken out to score it.
    """

    def __init__(self, counts: np.ndarray, weights: tuple[float, float] = (1.0, 20.0)):
        self.counts, self.weights = counts.astype(float), weights
        self.firsts, self.seconds = self.counts.sum(axis=2), self.counts.sum(axis=1) + 0.5
        # Rows are pairs, columns the random models.
        second = self.seconds[1:] / self.seconds[1:].sum(axis=1, keepdims=True)
        pairs = self.counts[1:] + weights[1] * second[:, None, :]
        chances = np.log(pairs / (self.firsts[1:] + weights[1])[:, :, None])
        self.random = np.ascontiguousarray(chances.reshape(LABELS - 1, N * N).T)

    def ordinary_chances(self, a: np.ndarray, b: np.ndarray, own: bool) -> np.ndarray:
        pairs, first, second = self.counts[0][a, b], self.firsts[0][a], self.seconds[0][b]
        total, weight = self.seconds[0].sum(), self.weights[0] + RARE * first
        if own:
            pairs = np.maximum(pairs - np.bincount(a * N + b)[a * N + b], 0)
            first = np.maximum(first - np.bincount(a)[a], 0)
            second = np.maximum(second - np.bincount(b)[b], 0.5)
        return np.log((pairs + weight * second / total) / (first + weight))

    def ratio(self, text: str) -> tuple[float, int]:
        """Log likelihood ratio of the pairs of a string, and how many they are.

        The random side is the mean of the models' likelihoods. A pair that comes again
        and a pair of marks say nothing: rulers aren't random.
        """
        codes = CODES[np.frombuffer(text.encode(), np.uint8)]
        a, b = codes[:-1], codes[1:]
        once = np.unique(a * N + b, return_index=True)[1]
        once = once[~(MARKS[a[once]] & MARKS[b[once]])]
        plain = self.ordinary_chances(a, b, ordinary(text))[once].sum()
        chances = self.random[a[once] * N + b[once]].sum(axis=0)
        mean = np.logaddexp.reduce(chances) - np.log(LABELS - 1)
        return float(mean - plain), len(once)


def fit(docs: DataFrame, text: str = "text") -> Models:
    """All models: from drawn samples, and the different tokens of all rows' whole texts."""
    counts = np.zeros((LABELS, N, N))
    counts[0] = _pairs(drawn_identifiers()).reshape(N, N)
    for label in range(1, LABELS):
        counts[label] = _pairs(drawn_strings(label)).reshape(N, N)
    for row in pair_counts(docs, text).collect():  # LABELS * N * N rows at most
        counts[row["label"], row["pair"] // N, row["pair"] % N] += row["n"]
    return Models(counts)


def model_spans(
    text: str, base: list, models: Models, per_char: float, total: float
) -> list[tuple[int, int, int, str]]:
    """Runs of 20 or more token characters that read as random, meet no base span and aren't
    UUIDs."""
    found = []
    for m in TOKEN.finditer(text):
        start, end = m.span()
        if any(a < end and start < b for a, _, b, _ in base) or UUID.fullmatch(m[0]):
            continue
        score, pairs = models.ratio(m[0])
        if score >= total and score >= per_char * pairs:
            found.append((start, 3, end, m[0]))
    return found


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    per_char: float = 1.0,
    total: float = 15.0,
) -> DataFrame:
    """Spans of secrets of every row's whole text, one row per input row.

    Null text is empty: no spans. Repeated rows give repeated results. Other
    columns are not read. The models are fitted in a first pass over all rows.
    """
    models = fit(docs, text)

    def digest(spans):
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)

    def rows(batches):
        for batch in batches:
            out = {k: [] for k in (*(f"n_{k}" for k in KINDS), "base_sha256", "spans")}
            for one in batch.column(1).to_pylist():
                base = base_spans(one or "")
                more = model_spans(one or "", base, models, per_char, total)
                spans = sorted(base + more)
                for k, kind in enumerate(KINDS):
                    out[f"n_{kind}"].append(sum(s[1] == k for s in spans))
                out["base_sha256"].append(hashlib.sha256(digest(base).encode()).hexdigest())
                out["spans"].append(digest(spans))
            yield {id_col: batch.column(0), **out}

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_batches(
        docs.select(id_col, text),
        rows,
        f"{id_col} {docs.schema[id_col].dataType.simpleString()}, {counts}, "
        "base_sha256 string, spans string",
    )
