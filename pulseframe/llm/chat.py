"""Chat formatting: records of different layouts to canonical turns and one template."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import combinations
from typing import Any, NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import by_batch, pa_schema

#: The template: HEAD role MIDDLE text END, once for each turn.
HEAD, MIDDLE, END = "### ", ": ", " </turn>\n"
TRAINED_ROLE = "assistant"


class Mapping(NamedTuple):
    """How one layout becomes turns.

    ``turns`` lists (role, path) in order; a role that starts with ``$`` is read from that
    path. ``each`` is the array that they are taken from, if any. ``optional`` paths may
    be missing. ``names`` are the layout's own names of the canonical roles; other roles
    stay as they are.
    """

    name: str
    turns: tuple[tuple[str, str], ...]
    each: str = ""
    optional: tuple[str, ...] = ()
    before: tuple[tuple[str, str], ...] = ()
    names: dict[str, str] = {}


#: Names that records with a list of turns use for the canonical roles; the role of a turn row stands as it is.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("turn row", (("$role", "text"),), optional=("turn",)),
    Mapping("messages", (("$role", "content"),), each="messages", names=ROLES),
    Mapping("conversations", (("$from", "value"),), each="conversations", before=(("system", "system"),), optional=("system",), names=ROLES),
    Mapping("prompt", (("user", "prompt"), ("assistant", "completion")), optional=("system",), before=(("system", "system"),)),
    Mapping("response", (("user", "prompt"), ("assistant", "response")), optional=("system",), before=(("system", "system"),)),
    Mapping("instruction", (("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input", "system"), before=(("system", "system"),)),
    Mapping("question", (("user", "question"), ("assistant", "answer")), optional=("system",), before=(("system", "system"),)),
)


def field_paths(value: Any, path: str = "") -> Iterator[str]:
    """The paths of all leaves; ``[]`` stands for the items of an array."""
    if isinstance(value, dict):
        for name, inner in value.items():
            yield from field_paths(inner, f"{path}.{name}" if path else name)
    elif isinstance(value, list):
        for inner in value:
            yield from field_paths(inner, f"{path}[]")
    else:
        yield path


def schema_fingerprint(paths: set[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), 7)


def _paths_of(mapping: Mapping) -> tuple[set[str], set[str]]:
    """Its paths that must be there and those that may be."""
    inside = f"{mapping.each}[]." if mapping.each else ""
    paths = {inside + p for role, path in mapping.turns for p in (path, role[1:] if role[0] == "$" else path)}
    optional = {p for p in mapping.optional} & (paths | {p for _, p in mapping.before} | {"turn"})
    return paths - optional, optional


def _registry() -> tuple[dict[int, Mapping], set[str]]:
    by_fingerprint: dict[int, Mapping] = {}
    known: set[str] = set()
    for mapping in MAPPINGS:
        needed, optional = _paths_of(mapping)
        known |= needed | optional
        for n in range(len(optional) + 1):
            for some in combinations(sorted(optional), n):
                by_fingerprint.setdefault(schema_fingerprint(needed | set(some)), mapping)
    return by_fingerprint, known


BY_FINGERPRINT, KNOWN_PATHS = _registry()


#: Whole conversations first, then the layouts of more fields, so that a record of two layouts has one.
RANKED = sorted(MAPPINGS, key=lambda m: (not m.each, m.name == "turn row", -len(_paths_of(m)[0])))


def _parts(value: Any) -> bool:
    """Whether it is a list of content parts: texts, or objects."""
    return isinstance(value, list) and all(isinstance(part, (str, dict)) for part in value)


def _items(mapping: Mapping, record: dict) -> list:
    """The objects that turns are taken from; none if there is anything else among them."""
    items = record.get(mapping.each) if mapping.each else [record]
    return items if isinstance(items, list) and all(isinstance(item, dict) for item in items) else []


def _fits(mapping: Mapping, record: dict) -> bool:
    """Whether each path that the layout needs is there, whatever else is."""
    items, inside = _items(mapping, record), f"{mapping.each}[]."
    plain = lambda value: not isinstance(value, (dict, list)) or _parts(value)
    needed = [p.removeprefix(inside) if mapping.each else p for p in _paths_of(mapping)[0]]
    return all(any(p in item for item in items) and all(plain(item.get(p)) for item in items) for p in needed)


def _text(value: Any) -> str:
    if _parts(value):
        # Parts that are no text stay as JSON.
        return "".join(part["text"] if isinstance(part, dict) and isinstance(part.get("text"), str) else _text(part) for part in value)
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record: Any) -> tuple[str, list[tuple[str, str]]]:
    """(layout, [(role, text)]) of a parsed record.

    The paths that some layout knows are hashed; if no layout has just these, the first of
    RANKED whose needed paths are there is taken, so extra fields do no harm, those of
    other layouts included. A text may be a list of content parts. A record of no known layout has layout "unknown" and no turns. Null texts
    and roles are empty; an optional field that is missing makes no turn, nor does an
    empty ``input``.
    """
    if not isinstance(record, dict):
        return "unknown", []
    mapping = BY_FINGERPRINT.get(schema_fingerprint(set(field_paths(record)) & KNOWN_PATHS))
    if mapping is None or not _fits(mapping, record):
        mapping = next((m for m in RANKED if _fits(m, record)), None)
    if mapping is None:
        return "unknown", []
    found = [(role, _text(record[path])) for role, path in mapping.before if path in record]
    for item in _items(mapping, record):
        for role, path in mapping.turns:
            if path not in item or path in mapping.optional and not item[path]:
                continue
            role = _text(item.get(role[1:])) if role[0] == "$" else role
            found.append((mapping.names.get(role, role), _text(item[path])))
    return mapping.name, found


def canonical_turns(records: DataFrame) -> DataFrame:
    """(conv_id, turn, part, role, text, layout) of (conv_id, turn, record as JSON text).

    ``part`` numbers the turns of one record. Text that is no JSON has layout "unknown",
    with one row without role and text, so that nothing vanishes unseen.
    """

    def make():
        def step(conv_id, turn, record):
            out = []
            for c, t, r in zip(conv_id, turn, record):
                try:
                    layout, turns = turns_of(json.loads(r or "null"))
                except ValueError:
                    layout, turns = "unknown", []
                if layout == "unknown":
                    out.append((c, t, 0, None, None, layout))
                out.extend((c, t, n, role, text, layout) for n, (role, text) in enumerate(turns))
            return {name: [row[i] for row in out] for i, name in enumerate(("conv_id", "turn", "part", "role", "text", "layout"))}

        return step

    return by_batch(records.select("conv_id", "turn", "record"), make,
                    "conv_id LONG, turn LONG, part INT, role STRING, text STRING, layout STRING")


def escaped(text: str) -> str:
    """Puts a backslash before each backslash and each control string of the template."""
    return re.sub(r"\\|###|</turn>", lambda m: "\\" + m[0], text)


def escaped_role(role: str) -> str:
    return escaped(role).replace(":", "\\:")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turns(turns: DataFrame) -> DataFrame:
    """Adds ``formatted``, the turn in the template, and its loss span ``loss_start``, ``loss_end``.

    Spans are code points within ``formatted`` and empty unless the role is trained. A
    conversation is its turns' pieces one after another; pieces stay rows, so one very
    long conversation is no one task's work. Records of unknown layout are rows without
    ``formatted`` and span.
    """
    schema = "conv_id LONG, turn LONG, part INT, formatted STRING, loss_start LONG, loss_end LONG"

    def make():
        def step(conv_id, turn, part, role, text, layout):
            pieces, starts, ends = [], [], []
            for r, t, known in zip(role, text, layout):
                if known == "unknown":
                    for column in (pieces, starts, ends):
                        column.append(None)
                    continue
                head, body = HEAD + escaped_role(r or "") + MIDDLE, escaped(t or "")
                pieces.append(head + body + END)
                starts.append(len(head))
                ends.append(len(head) + (len(body) if r == TRAINED_ROLE else 0))
            return {"conv_id": conv_id, "turn": turn, "part": part, "formatted": pieces, "loss_start": starts, "loss_end": ends}

        return step

    return by_batch(turns.select("conv_id", "turn", "part", "role", "text", "layout"), make, schema)


#: An escaped character stands for itself, so marks count only where no backslash escapes them.
_MARKS = {mark: re.compile(r"\\.|(" + re.escape(mark) + ")", re.S) for mark in (MIDDLE, END)}


def _find(formatted: str, mark: str, start: int) -> int:
    for found in _MARKS[mark].finditer(formatted, start):
        if found[1]:
            return found.start()
    raise ValueError("the formatted text lacks a mark of the template")


def read_pieces(formatted: str) -> list[tuple[str, str]]:
    """[(role, text)] of formatted text, unescaped."""
    turns, start = [], 0
    while start < len(formatted):
        if not formatted.startswith(HEAD, start):
            raise ValueError("the formatted text lacks a mark of the template")
        middle = _find(formatted, MIDDLE, start + len(HEAD))
        end = _find(formatted, END, middle + len(MIDDLE))
        turns.append((unescaped(formatted[start + len(HEAD):middle]), unescaped(formatted[middle + len(MIDDLE):end])))
        start = end + len(END)
    return turns


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from formatted turns (as ``format_turns`` gives them).

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn), loss_chars and
    loss_sha256 (the unescaped text under the loss spans), formatted_chars. The turns of a
    conversation are sorted and hashed as they stream by; a hash is sequential, but a task
    holds no more than one batch. Rows without formatted text add nothing, but a
    conversation of such rows alone has a row with no turns. Turns of equal number are ordered by their text.
    """
    schema = "conv_id LONG, n_turns LONG, turns_sha256 STRING, loss_chars LONG, loss_sha256 STRING, formatted_chars LONG"
    arrow = pa_schema(formatted.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: list | None = None

        def row(state):
            conv_id, turns, hashed, loss, loss_hash, chars = state
            return conv_id, turns, hashed.hexdigest(), loss, loss_hash.hexdigest(), chars

        for batch in batches:
            done = []
            for conv_id, piece, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current[0] != conv_id:
                    if current is not None:
                        done.append(row(current))
                    current = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if piece is None:
                    continue
                for role, text in read_pieces(piece):
                    current[1] += 1
                    current[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                trained = unescaped(piece[start:end])
                current[3] += len(trained)
                current[4].update(trained.encode("utf-8", "surrogatepass"))
                current[5] += len(piece)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row(current), arrow)], schema=arrow)

    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "part", "formatted")
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInArrow(run, schema)
    )
