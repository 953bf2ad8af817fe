"""Token counts by finite-state transducers compiled from a byte-level BPE file.

Two transducers count the tokens of a text. The first reads character classes
and marks where the split pattern of the vocabulary starts a piece: texts are
laid end to end and cut into chunks, each chunk is run from every state at once
to get its state map, the maps are composed by a parallel prefix scan, and a
second run from the now known entry states emits the starts. The second reads
the bytes of a piece: each byte leads to the one token that can end there, and
the step carries the number of tokens emitted so far.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame

from .words import MOST_CACHED, map_batches, texts_of

CHUNK, SETTLE = 256, 8
LONG_PIECE = 64  # bytes; the counts of longer pieces aren't kept

# Character classes and states of the splitting transducer.
SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, END = range(7)
SHORT = {c: 7 + k for k, c in enumerate("stmdrvle")}  # letters of 's 't 'm 'd 're 've 'll
N_CLASSES = 7 + len(SHORT)
(FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AT_QUOTE, AT_R, AT_V, AT_L,
 ONE_SPACE, SPACES, ONE_BLANK, BLANKS) = range(12)
N_STATES = 12
START, BEFORE = 1, 2  # emitted: a piece starts here, one starts a character earlier
CLOSES = {AT_R: "e", AT_V: "e", AT_L: "l"}


@cache
def character_classes() -> np.ndarray:
    classes = np.full(sys.maxunicode + 2, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LN":
            classes[point] = LETTER if kind == "L" else NUMBER
    spaces = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029]
    classes[[*spaces, 0x202F, 0x205F, 0x3000]] = BLANK
    classes[0x20], classes[ord("'")], classes[-1] = SPACE, QUOTE, END
    for letter, kind in SHORT.items():
        classes[ord(letter)] = kind
    return classes


def _step(state: int, kind: int) -> tuple[int, int]:
    """Next state and what is emitted on reading a character of class `kind`."""
    letter = next((c for c, k in SHORT.items() if k == kind), "")
    if letter:
        kind = LETTER
    begin = {
        SPACE: ONE_SPACE, BLANK: ONE_BLANK, LETTER: IN_LETTERS, NUMBER: IN_NUMBERS,
        OTHER: IN_OTHERS, QUOTE: AT_QUOTE, END: FRESH,
    }
    run = {IN_LETTERS: LETTER, IN_NUMBERS: NUMBER, IN_OTHERS: OTHER}
    if state in run and (kind == run[state] or state == IN_OTHERS and kind == QUOTE):
        return state, 0
    if state == AT_QUOTE:
        if letter and letter in "stmd":
            return FRESH, 0
        if letter and letter in "rvl":
            return {"r": AT_R, "v": AT_V, "l": AT_L}[letter], 0
        if kind in (OTHER, QUOTE):
            return IN_OTHERS, 0
    if state in CLOSES:
        if letter == CLOSES[state]:
            return FRESH, 0
        later, emitted = _step(IN_LETTERS, SHORT.get(letter, kind))
        return later, emitted | BEFORE
    if state in (ONE_SPACE, SPACES, ONE_BLANK, BLANKS) and kind in (SPACE, BLANK):
        return (SPACES if kind == SPACE else BLANKS), 0
    if kind != END and state in (ONE_SPACE, SPACES):
        # The last space belongs to the piece after it, where a quote is like any other sign.
        later = IN_OTHERS if kind == QUOTE else begin[kind]
        return later, BEFORE if state == SPACES else 0
    if kind != END and state == BLANKS:
        return begin[kind], START | BEFORE
    return begin[kind], START


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By state * N_CLASSES + class: the next state, times N_CLASSES, and what is emitted."""
    steps = [_step(s, c) for s in range(N_STATES) for c in range(N_CLASSES)]
    after, emitted = zip(*steps, strict=True)
    return np.array(after, np.int32) * N_CLASSES, np.array(emitted, np.uint8)


def chunk_maps(classes: np.ndarray) -> np.ndarray:
    """End state of each chunk (rows) for each state it may be entered in (columns).

    In nearly every chunk all states have run into one after a few characters;
    from then on that one is followed, and the map is constant.
    """
    columns = np.arange(N_STATES, dtype=np.int32) * N_CLASSES
    states = np.broadcast_to(columns, (len(classes), N_STATES))
    states = _run(classes[:, :SETTLE], states)
    one = (states == states[:, :1]).all(axis=1)
    maps = np.empty((len(classes), N_STATES), np.int32)
    maps[one] = _run(classes[one, SETTLE:], states[one, :1])
    maps[~one] = _run(classes[~one, SETTLE:], states[~one])
    return maps


def _run(classes: np.ndarray, states: np.ndarray) -> np.ndarray:
    after = _tables()[0]
    for kind in np.ascontiguousarray(classes.T):
        states = after[states + kind[:, None]]
    return states


def entry_states(maps: np.ndarray) -> np.ndarray:
    """State in which each chunk is entered: prefix scan of the maps by doubling."""
    reach, step = maps, 1
    while step < len(reach):
        joined = np.take_along_axis(reach[step:], reach[:-step] // N_CLASSES, axis=1)
        reach = np.concatenate([reach[:step], joined])
        step *= 2
    return np.concatenate([[FRESH], reach[:-1, FRESH]]).astype(np.int32)


def piece_starts(classes: np.ndarray) -> np.ndarray:
    """Indexes at which pieces start, for texts that each end in the class END."""
    n = len(classes)
    padded = np.full(-(-n // CHUNK) * CHUNK, END, np.uint8)
    padded[:n] = classes
    chunks = padded.reshape(-1, CHUNK)
    states = entry_states(chunk_maps(chunks))
    after, emitted = _tables()
    out = np.empty((CHUNK, len(chunks)), np.uint8)
    for at, kind in enumerate(np.ascontiguousarray(chunks.T)):
        step = states + kind
        out[at] = emitted[step]
        states = after[step]
    out = out.T.reshape(-1)[:n]
    starts = (out & START).astype(bool)
    starts[:-1] |= (out[1:] & BEFORE).astype(bool)
    return np.flatnonzero(starts)


class PieceCounts(dict):
    """Tokens of a piece, by a deterministic transducer over bytes for the merges of a BPE.

    After any prefix just one token can be the last: the one whose bytes end the
    prefix and which the merges leave beside the last token of what is before it.
    So a state needs the places from which a longer token may still come, each with
    the last token before it and the tokens emitted since: their number is bounded
    by the vocabulary. Each transition carries the change in the number of tokens.
    States are made when first met; transitions and counts are remembered.
    """

    def __init__(self, vocabulary: dict[bytes, int], ranks: dict[tuple[int, int], tuple]):
        super().__init__()
        self.vocabulary, self.ranks = vocabulary, ranks
        self.prefixes = {b[:n] for b in vocabulary for n in range(1, len(b))}
        self.halves = {whole: (pair, rank) for pair, (rank, whole) in ranks.items()}
        self.edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.stable: dict[tuple[int, int], bool] = {}
        self.restart()

    def restart(self) -> None:
        # A state: the bytes from its furthest open place, and of each open place
        # how far back it is, the last token before it and the tokens since.
        self.states = [(b"", ((0, -1, 0),))]
        self.ids = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts that stand at one end of a token while it is merged, each with the
        rank of the merge that it goes into: 0 the left end, 1 the right end."""
        known = self.edges.get((token, side))
        if known is None:
            known, part, rank = [], token, float("inf")
            while True:
                known.append((part, rank))
                if part not in self.halves:
                    break
                pair, rank = self.halves[part]
                part = pair[side]
            self.edges[token, side] = known
        return known

    def fits(self, last: int, token: int) -> bool:
        """Whether the merges leave these two side by side: no merge across their border
        comes before one that takes a part of it away. Of equal ranks the left goes first."""
        if last < 0:
            return True
        known = self.stable.get((last, token))
        if known is None:
            if len(self.stable) >= MOST_CACHED:
                self.stable.clear()
            known = self.stable[last, token] = not any(
                (a, b) in self.ranks and self.ranks[a, b][0] < gone_a
                and self.ranks[a, b][0] <= gone_b
                for a, gone_a in self.edge(last, 1)
                for b, gone_b in self.edge(token, 0)
            )
        return known

    def step(self, state: int, byte: int) -> tuple[int, int]:
        seen, places = self.states[state]
        seen += bytes([byte])
        for back, last, since in places:
            token = self.vocabulary.get(seen[len(seen) - back - 1 :])
            if token is not None and self.fits(last, token):
                break
        emitted = 1 - since
        still = [
            (back + 1, last, since + emitted)
            for back, last, since in places
            if seen[len(seen) - back - 1 :] in self.prefixes
        ]
        furthest = max((back for back, _, _ in still), default=0)
        after = (seen[len(seen) - furthest :], ((0, token, 0), *still))
        if after not in self.ids:
            self.ids[after] = len(self.states)
            self.states.append(after)
        known = self.steps[state << 8 | byte] = self.ids[after], emitted
        return known

    def __missing__(self, piece: bytes) -> int:
        if len(self.steps) >= MOST_CACHED:
            self.restart()
        known, state, n = self.steps.get, 0, 0
        for byte in piece:
            state, emitted = known(state << 8 | byte) or self.step(state, byte)
            n += emitted
        if len(self) >= MOST_CACHED:
            self.clear()
        if len(piece) <= LONG_PIECE:
            self[piece] = n
        return n


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def merged(piece: bytes, ids: dict[bytes, int], ranks: dict) -> list[int]:
    """The tokens of a short piece by the merges themselves."""
    parts = [ids[piece[i : i + 1]] for i in range(len(piece))]
    while True:
        pairs = enumerate(pairwise(parts))
        ranked = [(ranks[p][0], i) for i, p in pairs if p in ranks]
        if not ranked:
            return parts
        i = min(ranked)[1]
        parts[i : i + 2] = [ranks[parts[i], parts[i + 1]][1]]


def compiled(path: str) -> tuple[dict, dict, list[str]]:
    """Vocabulary, merges and special strings of a tokenizer file, for `PieceCounts`."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = _byte_letters()
    ids = spec["model"]["vocab"]
    raw = {i: bytes(letters[c] for c in t) for t, i in ids.items() if all(c in letters for c in t)}
    ranks = {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        ranks.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
    special = [t["content"] for t in spec["added_tokens"] if t["special"]]
    known = {b: i for i, b in raw.items()}
    # A token that the merges don't lead to from its own bytes is never emitted.
    vocabulary = {b: i for b, i in known.items() if merged(b, known, ranks) == [i]}
    return vocabulary, ranks, special


def count_batch(texts: list[bytes], counts: PieceCounts, special: list[str]) -> np.ndarray:
    """Tokens of each text. A special string is one token and ends what is before it."""
    total = np.zeros(len(texts), np.int64)
    parts, owner = [], []
    for k, text in enumerate(texts):
        pieces = [text]
        for mark in map(str.encode, special):
            if mark in text:
                pieces = [x for piece in pieces for x in piece.split(mark)]
                total[k] += len(pieces) - 1
        parts += pieces
        owner += [k] * len(pieces)
    if not parts:
        return total
    # One byte marks the end of each part: 0xFF does not occur in UTF-8.
    buffer = b"\xff".join([*parts, b""])
    raw = np.frombuffer(buffer, np.uint8)
    first = np.flatnonzero((raw & 0xC0) != 0x80)  # where a character's bytes begin
    points = np.frombuffer("\0".join([*(p.decode() for p in parts), ""]).encode("utf-32-le"), "<u4")
    classes = character_classes()[points]
    classes[raw[first] == 0xFF] = END
    starts = first[piece_starts(classes)]
    ends = np.append(starts[1:], len(raw))
    whole = raw[starts] != 0xFF
    pieces = map(buffer.__getitem__, map(slice, starts[whole].tolist(), ends[whole].tolist()))
    n = np.fromiter(map(counts.__getitem__, pieces), np.int64, int(whole.sum()))
    part = np.searchsorted(np.flatnonzero(raw == 0xFF), starts[whole])
    return total + np.bincount(np.array(owner)[part], n, len(texts)).astype(np.int64)


COUNTERS: dict[str, PieceCounts] = {}


def counter(path: str, vocabulary: dict, ranks: dict) -> PieceCounts:
    """One for a Python worker: the tasks that it runs in turn share what is remembered."""
    if path not in COUNTERS:
        COUNTERS.clear()
        COUNTERS[path] = PieceCounts(vocabulary, ranks)
    return COUNTERS[path]


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", limit: int = 512
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row's whole text, in one pass.

    `tokenizer` is a byte-level BPE file with the usual split pattern. Null text is
    empty: 0 bytes, 0 tokens. Repeated rows give repeated results; other columns
    are not read. The driver reads the file; tasks get its compiled tables, whose
    size is that of the vocabulary.
    """
    tables = docs.sparkSession.sparkContext.broadcast(compiled(tokenizer))

    def rows(batches):
        vocabulary, ranks, special = tables.value
        counts = counter(tokenizer, vocabulary, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = texts_of(part, text)
                n = count_batch(texts, counts, special)
                yield {
                    id_col: part.column(0),
                    "n_bytes": list(map(len, texts)),
                    "n_tokens": n,
                    "over_limit": n > limit,
                }

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(docs.select(id_col, text), rows, schema)
