"""Chat formatting by schema fingerprints.

A record's fingerprint is the hash of its sorted nested field paths.  It
selects a declarative mapping that turns the record, whatever its layout
(prompt / completion, instruction / input / output, message lists, one row per
turn), into canonical (role, text) turns.  Turns are written with a template
whose control character cannot occur in an escaped text, and read back by it:

    <turn ROLE>\\nTEXT</turn>\\n

Inside ROLE and TEXT a backslash is written \\\\, '<' is written \\l and '>' is
written \\g, so the escape is reversible and no text can forge a marker.
The loss mask covers the texts of assistant turns, without their markers.

Edge cases: a null text or role is empty; rows of one conversation are taken
by turn (null first), then role, then text, repeated rows each count; a record
whose fingerprint no mapping knows gives no turns but a row with
``known = false``, it isn't dropped; a null conv_id is a conversation of its
own; extra columns are ignored; an empty table gives an empty table.  A
conversation is never held whole: its pieces are streamed in order.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def field_paths(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value, lists as ``[]``."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) or {at + "{}"}
    if isinstance(value, list):
        return set().union(*(field_paths(v, at + "[]") for v in value)) or {at + "[]"}
    return {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Either a list of turns under ``items`` with a role and a text field, or
    fixed (role, fields) turns; the fields of one turn are joined by newlines
    and empty ones left out."""
    items: str | None = None
    role: str | None = None
    text: str | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def apply(self, record: dict) -> list[tuple[str, str]]:
        if self.turns:
            return [(role, "\n".join(str(record[f]) for f in fields if record.get(f) not in (None, "")))
                    for role, fields in self.turns]
        rows = record[self.items] if self.items else [record]
        return [(ROLES.get(x.get(self.role), x.get(self.role)) or "", as_text(x.get(self.text))) for x in rows]


def as_text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


# Role names of other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS: tuple[tuple[tuple[str, ...], Mapping], ...] = (
    (("role", "text"), Mapping(role="role", text="text")),
    (("role", "content"), Mapping(role="role", text="content")),
    (("messages[].role", "messages[].content"), Mapping("messages", "role", "content")),
    (("conversations[].from", "conversations[].value"), Mapping("conversations", "from", "value")),
    (("system", "conversations[].from", "conversations[].value"), Mapping("conversations", "from", "value")),
    (("prompt", "completion"), Mapping(turns=(("user", ("prompt",)), ("assistant", ("completion",))))),
    (("prompt", "response"), Mapping(turns=(("user", ("prompt",)), ("assistant", ("response",))))),
    (("instruction", "output"), Mapping(turns=(("user", ("instruction",)), ("assistant", ("output",))))),
    (("instruction", "input", "output"), Mapping(turns=(("user", ("instruction", "input")), ("assistant", ("output",))))),
    (("system", "prompt", "response"),
     Mapping(turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))))),
)
MAPPINGS = {fingerprint(paths): m for paths, m in LAYOUTS}


def escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("<", "\\l").replace(">", "\\g")


_CODE = re.compile(r"\\(.)", re.DOTALL)
_PLAIN = {"\\": "\\", "l": "<", "g": ">"}


def unescape(s: str) -> str:
    return _CODE.sub(lambda m: _PLAIN[m[1]], s) if "\\" in s else s


_PIECE = re.compile(r"<turn ([^<>]*)>\n([^<>]*)</turn>\n")


def write_turn(role: str, text: str) -> str:
    return f"<turn {escape(role)}>\n{escape(text)}</turn>\n"


def read_turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound the escaped
    text in ``formatted``.  Anything else than turns raises ValueError."""
    at = 0
    for m in _PIECE.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        yield unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")


PIECES = ("key long, pos long, ord_role string, ord_text string, known boolean, fingerprint string, piece string, "
          "loss array<struct<start: long, end: long>>")


def format_records(records: DataFrame) -> DataFrame:
    """Format records (key long, pos long, record string holding JSON).  One
    output row per record: the formatted piece, its loss mask as code point
    spans of the piece, the fingerprint and whether a mapping knows it.  The
    pieces of one key, by pos, make the formatted conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            prints, known, pieces, masks, first = [], [], [], [], []
            for s in b.column(2):
                try:
                    record = json.loads(s.as_py() or "null")
                except ValueError:
                    record = None
                print_ = fingerprint(field_paths(record)) if isinstance(record, dict) else None
                mapping = MAPPINGS.get(print_)
                turns = mapping.apply(record) if mapping else []
                piece, mask = "", []
                for role, text in turns:
                    at = len(piece)
                    piece += write_turn(role, text)
                    if role == ASSISTANT:
                        end = len(piece) - len("</turn>\n")
                        mask.append({"start": at + len(f"<turn {escape(role)}>\n"), "end": end})
                prints.append(print_)
                known.append(mapping is not None)
                pieces.append(piece)
                masks.append(mask)
                first.append(turns[0] if turns else ("", ""))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r for r, _ in first], pa.string()), pa.array([t for _, t in first], pa.string()),
                 pa.array(known, pa.bool_()), pa.array(prints, pa.string()), pa.array(pieces, pa.string()), pa.array(masks, kind)],
                ["key", "pos", "ord_role", "ord_text", "known", "fingerprint", "piece", "loss"])

    return records.select(F.col("key").cast("long"), F.col("pos").cast("long"), F.col("record").cast("string")).mapInArrow(run, PIECES)


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as records of the role / text layout."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("key"), F.col("turn").cast("long").alias("pos"),
        F.to_json(F.struct(F.col("role").cast("string").alias("role"),
                           F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")),
                  {"ignoreNullFields": "false"}).alias("record"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted pieces alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, n_unknown.  Pieces
    are dealt by conversation and sorted, then streamed; a task holds one
    Arrow batch and a few digests, however long a conversation is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_unknown"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        at, state, done = None, None, []

        def close():
            turns, loss = state[1], state[3]
            done.append([at, state[0], turns.hexdigest(), state[2], loss.hexdigest(), state[4], state[5]])

        for b in batches:
            for key, known, piece, mask in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                               b.column(2).to_pylist(), b.column(3).to_pylist()):
                if state is None or key != at:
                    if state is not None:
                        close()
                    at, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text, _, _ in read_turns(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in mask:
                    text = unescape(piece[span["start"]:span["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
                state[5] += not known
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
                done = []
        if state is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    ordered = formatted.repartition("key").sortWithinPartitions("key", "pos", "ord_role", "ord_text")
    return ordered.select("key", "known", "piece", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_unknown long")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """:func:`format_records` for rows by turn."""
    return format_records(turn_records(conversations))
