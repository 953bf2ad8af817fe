"""Chat formatting: records of any known layout to canonical turns to a chat template.

A record is JSON. The paths of its fields, without list positions and values, are
hashed to a fingerprint, and a table of declarative mappings says for each
fingerprint where the turns are. Mappings name paths only; no code is written for
a layout. Fields that only describe a record (`DESCRIPTIVE`) are left out of its paths. A
record of an unknown layout gives no turns and is counted as such.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import map_batches

# The template and the strings that control it.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
END_OF_TURN = CLOSE + "\n"
MARK = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")


# Fields that say something about a record or turn and hold none of its text.
DESCRIPTIVE = frozenset(
    "id conv_id conversation_id source origin dataset lang language license url created date "
    "timestamp model score rating weight tags meta metadata".split()
)
SURROGATE = re.compile("[\ud800-\udfff]")


def escape(text: str) -> str:
    r"""No `<|` is left: a backslash is put between, one more where there are some."""
    return MARK.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    plain = unescape(role)
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], plain)


def paths(value, at: str = "") -> set[str]:
    """Paths of all fields below a JSON value but descriptive ones; a list's elements share one path."""
    if isinstance(value, dict):
        inner = [paths(v, f"{at}.{k}") for k, v in value.items() if k not in DESCRIPTIVE]
        return {at, *(p for found in inner for p in found)}
    if isinstance(value, list):
        return {f"{at}[]", *(p for v in value for p in paths(v, f"{at}[]"))}
    return {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


def as_text(value) -> str:
    """A text as it is, null as empty, any other JSON value as JSON; half a surrogate pair is U+FFFD."""
    if not isinstance(value, str):
        value = "" if value is None else json.dumps(value, ensure_ascii=False)
    return SURROGATE.sub("\ufffd", value)


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns: a list with role and text, or one field per turn."""

    fields: tuple[str, ...]
    turns: str = ""
    role: str = ""
    text: str = ""
    parts: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprint(self) -> str:
        whole = set()
        for field in self.fields:
            steps = field.split(".")
            whole |= {".".join(steps[:n]) for n in range(1, len(steps) + 1)}
        lists = {p.removesuffix("[]") for p in whole if p.endswith("[]")}
        return fingerprint(whole - lists | {""})

    def read(self, record: dict) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn; ValueError if one lacks either."""
        renamed = dict(self.roles)
        if self.turns:
            for turn in record[self.turns]:
                if not isinstance(turn, dict) or not {self.role, self.text} <= turn.keys():
                    raise ValueError("a turn without role or text")
                role = turn[self.role]
                yield as_text(renamed.get(role, role) if isinstance(role, str) else role), as_text(turn[self.text])
        for role, field in self.parts:
            if record.get(field) is not None:
                yield role, as_text(record[field])


MAPPINGS = (
    Mapping((".messages[].role", ".messages[].content"), "messages", "role", "content"),
    Mapping(
        (".conversations[].from", ".conversations[].value"), "conversations", "from", "value",
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Mapping((".prompt", ".response"), parts=(("user", "prompt"), ("assistant", "response"))),
    Mapping((".prompt", ".completion"), parts=(("user", "prompt"), ("assistant", "completion"))),
    Mapping(
        (".instruction", ".input", ".output"),
        parts=(("system", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Mapping(
        (".instruction", ".output"), parts=(("user", "instruction"), ("assistant", "output"))
    ),
)
BY_FINGERPRINT = {m.fingerprint: m for m in MAPPINGS}


def canonical(record: str | None) -> list[tuple[str, str]] | None:
    """(role, text) of each turn of a JSON record; None if its layout is not known."""
    try:
        value = json.loads(record) if record else None
        found = paths(value)
        if isinstance(value, dict) and value.get("messages") == [] and found == {"", ".messages[]"}:
            return []
        mapping = BY_FINGERPRINT.get(fingerprint(found))
        return None if mapping is None else list(mapping.read(value))
    except (ValueError, RecursionError):
        return None


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text, and the loss mask: spans (code points) of the assistant's texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape_role(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END_OF_TURN]
        at += len(head) + len(body) + len(END_OF_TURN)
    return "".join(out), spans


def read_back(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(text):
        line = text.index("\n", at)
        end = text.index(END_OF_TURN, line + 1)
        role = unescape_role(text[at + len(OPEN) : line])
        turns.append((role, unescape(text[line + 1 : end])))
        at = end + len(END_OF_TURN)
    return turns


def _layout(turns: list[tuple[str, str]]) -> dict:
    """The shortest layout that holds the turns: fields by role, or a list of messages."""
    roles = [role for role, _ in turns]
    texts = [text for _, text in turns]
    if roles == ["user", "assistant"]:
        return dict(zip(("prompt", "response"), texts, strict=True))
    if roles == ["system", "user", "assistant"]:
        return dict(zip(("instruction", "input", "output"), texts, strict=True))
    return {"messages": [{"role": role, "content": text} for role, text in turns]}


def records(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(id, record): the turns of each id, in the order of turn, as one JSON record.

    Turns of equal number stand in the order of role and text; null role and text are
    empty; rows of null id are one conversation; repeated rows are repeated turns.
    Rows are dealt out and sorted by id and then read one after the other, so a task
    holds one conversation at a time.
    """
    narrow = rows.select(
        F.col(id_col).alias("id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ordered = narrow.repartition("id").sortWithinPartitions("id", "turn", "role", "text")

    def gather(batches):
        held, own = [], ()
        for batch in batches:
            ids, done = [], []
            columns = (batch.column(k).to_pylist() for k in (0, 2, 3))
            for key, who, said in zip(*columns, strict=True):
                if own != (key,):
                    if own:
                        ids.append(own[0])
                        done.append(json.dumps(_layout(held), ensure_ascii=False))
                    held, own = [], (key,)
                held.append((who, said))
            yield {id_col: ids, "record": done}
        if own:
            yield {id_col: [own[0]], "record": [json.dumps(_layout(held), ensure_ascii=False)]}

    kind = rows.schema[id_col].dataType.simpleString()
    return map_batches(ordered, gather, f"{id_col} {kind}, record string")


def format_records(
    found: DataFrame, id_col: str = "conv_id", record: str = "record"
) -> DataFrame:
    """id, known, formatted and mask of each JSON record, row by row.

    `mask` lists the spans of the assistant's texts in `formatted`, in code points.
    A null record, one that isn't JSON, one of an unknown layout, one nested too deep to
    read and one with a turn that lacks role or text are `known` false, with empty text and
    mask. Other columns are not read.
    """

    def rows(batches):
        for batch in batches:
            out = {"known": [], "formatted": [], "mask": []}
            for one in batch.column(1).to_pylist():
                turns = canonical(one)
                text, spans = formatted(turns or [])
                out["known"].append(turns is not None)
                out["formatted"].append(text)
                out["mask"].append([{"start": a, "end": b} for a, b in spans])
            yield {id_col: batch.column(0), **out}

    kind = found.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, known boolean, formatted string, "
    schema += "mask array<struct<start: bigint, end: bigint>>"
    return map_batches(found.select(id_col, record), rows, schema)


def digests(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Counts and digests of formatted chats, read back from text and mask alone."""

    def rows(batches):
        for batch in batches:
            names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            out = {name: [] for name in names}
            for text, mask in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                turns = read_back(text)
                flat = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unescape(text[span["start"] : span["end"]]) for span in mask)
                values = (
                    len(turns), hashlib.sha256(flat.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(text),
                )
                for name, value in zip(names, values, strict=True):
                    out[name].append(value)
            yield {id_col: batch.column(0), **out}

    kind = chats.schema[id_col].dataType.simpleString()
    return map_batches(
        chats.select(id_col, "formatted", "mask"),
        rows,
        f"{id_col} {kind}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )
