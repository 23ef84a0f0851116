"""Chat formatting with schema fingerprints (operator 4).

Layouts: the nested field paths of a table (from its schema) or of a JSON record (from its
keys) are hashed; the hash selects a declarative mapping to canonical turns
(conv_id, turn, role, text).  Paths that no mapping names are left out of the hash, so extra
fields don't matter; if the rest still has no mapping of its own (extra fields with known
names), the mapping with the most paths among those present is taken.  JSON records that fit
none come back from ``unmapped``, as do those whose values can't be turns: broken or very
deep JSON, ids and turn numbers that aren't whole numbers of 64 bits, items that aren't
objects, texts that UTF-8 can't hold.

Template: each turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts ``<|``,
also with backslashes between, gets one more backslash, so control strings can't occur
in them and ``unescape`` restores every text; a line break in a role is ``<|nl|>``.  The loss mask
is one span of code points per turn: the text of assistant turns, empty elsewhere.

The formatted output has one row per turn (its segment and span): a conversation is its
segments in order.  Formatting groups nothing.  ``digests`` reads a conversation's segments
back in order, since a SHA-256 is sequential: one task for each conversation, with constant
memory and an external sort, so a conversation with a third of all rows takes that long.

Defined results: null text and null role are empty; equal turn numbers are ordered by
segment (role, then text); null ids and null turns come first and form a conversation (a
place) of their own; repeated rows are repeated turns; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from citymotion.llm.common import ship_package, small_batches, strings

START, END, NEW_LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
LOSS_ROLE = "assistant"
MAX_TURNS = 1 << 31  # of one JSON record
TURNS = "conv_id long, turn long, role string, text string"


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns: a list of items with role and text, or flat fields that
    are each a role's text (several fields are joined by an empty line, empty ones left out)."""

    name: str
    paths: tuple[str, ...]
    id: str
    items: str | None = None
    role: str = ""
    text: str = ""
    flat: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "prompter": "user", "model": "assistant"}
MAPPINGS = (
    Mapping("turn rows", ("conv_id", "turn", "role", "text"), "conv_id"),
    Mapping("messages", ("conv_id", "messages[].role", "messages[].content"), "conv_id", "messages", "role", "content"),
    Mapping("system and messages", ("conv_id", "system", "messages[].role", "messages[].content"), "conv_id", "messages", "role", "content", (("system", ("system",)),)),
    Mapping("from and value", ("id", "conversations[].from", "conversations[].value"), "id", "conversations", "from", "value", (), NAMES),
    Mapping("prompt and completion", ("conv_id", "prompt", "completion"), "conv_id", flat=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt and response", ("conv_id", "prompt", "response"), "conv_id", flat=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("instruction", ("conv_id", "instruction", "output"), "conv_id", flat=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction with input", ("conv_id", "instruction", "input", "output"), "conv_id", flat=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("question and answer", ("conv_id", "question", "answer"), "conv_id", flat=(("user", ("question",)), ("assistant", ("answer",)))),
)
KNOWN = frozenset(p for m in MAPPINGS for p in m.paths)


def fingerprint(paths: Iterable[str]) -> str:
    """SHA-256 of the sorted field paths that any mapping names."""
    return hashlib.sha256("\n".join(sorted(set(paths) & KNOWN)).encode("utf-8")).hexdigest()


BY_FINGERPRINT = {fingerprint(m.paths): m for m in MAPPINGS}


def select_mapping(paths: Iterable[str]) -> Mapping | None:
    paths = set(paths)
    exact = BY_FINGERPRINT.get(fingerprint(paths))
    if exact is not None:
        return exact
    fitting = [m for m in MAPPINGS if set(m.paths) <= paths]
    return max(fitting, key=lambda m: len(m.paths), default=None)


def schema_paths(kind: DataType, prefix: str = "") -> list[str]:
    """Paths of the leaves, ``[]`` for items of arrays."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, prefix + "[]")
    return [prefix]


def json_paths(value: object, prefix: str = "") -> set[str]:
    if isinstance(value, dict):
        return set().union(*(json_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(json_paths(v, prefix + "[]") for v in value))
    return {prefix}


def canonical_turns(df: DataFrame) -> DataFrame:
    """``TURNS`` rows of a table in any known layout; unknown layouts raise ValueError."""
    m = select_mapping(schema_paths(df.schema))
    if m is None:
        raise ValueError(f"no mapping for the fields {', '.join(schema_paths(df.schema))}")
    conv = F.col(m.id).cast("long").alias("conv_id")
    if m.name == "turn rows":
        return df.select(conv, F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def turn(role: Column, text: Column) -> Column:
        return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    def joined(names: tuple[str, ...]) -> Column:
        return F.concat_ws("\n\n", *[F.nullif(F.col(n).cast("string"), F.lit("")) for n in names])

    turns = F.array(*[turn(F.lit(role), joined(names)) for role, names in m.flat])
    if m.items:
        renamed = F.create_map(*[F.lit(x) for kv in (m.roles or {"": ""}).items() for x in kv])
        items = F.transform(F.col(m.items), lambda x: turn(F.coalesce(F.try_element_at(renamed, x[m.role]), x[m.role]), x[m.text]))
        turns = F.concat(turns, F.coalesce(items, F.array().cast(items_type()))) if m.flat else items
    return df.select(conv, F.posexplode(turns).alias("turn", "t")).select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def items_type() -> str:
    return "array<struct<role:string,text:string>>"


def record_turns(record: object, m: Mapping) -> list[tuple[str, str]]:
    """(role, text) of one JSON record by its mapping."""
    say = lambda v: "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    if m.name == "turn rows":
        return [(say(record["role"]), say(record["text"]))]
    turns = [(role, "\n\n".join(s for n in names if (s := say(record[n])))) for role, names in m.flat]
    for item in record[m.items] if m.items else ():
        role = say(item.get(m.role))
        turns.append((m.roles.get(role, role), say(item.get(m.text))))
    return turns


def _whole(value: object) -> bool:
    """Whether ``value`` is null or a whole number of 64 bits."""
    return value is None or isinstance(value, int) and not isinstance(value, bool) and -(1 << 63) <= value < (1 << 63) - MAX_TURNS


def _mapped(text: str | None) -> tuple[int | None, int, list[tuple[str, str]]] | None:
    """Id, first turn number and turns of a JSON record; None if no mapping fits."""
    try:
        record = json.loads(text or "")
        m = select_mapping(json_paths(record)) if isinstance(record, dict) else None
    except (ValueError, RecursionError):
        return None
    first = 0 if m is None or m.name != "turn rows" else record["turn"]
    if m is None or not _whole(record[m.id]) or not _whole(first):
        return None
    if m.items and not all(isinstance(x, dict) for x in record[m.items]):
        return None
    turns = record_turns(record, m)
    try:
        "".join(x for turn in turns for x in turn).encode("utf-8")
    except UnicodeEncodeError:  # a surrogate without its other half
        return None
    return record[m.id], first, turns


def canonical_json(df: DataFrame, col: str = "json") -> DataFrame:
    """``TURNS`` rows of JSON records, each mapped by its own fingerprint."""
    small_batches(df.sparkSession)
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, None if first is None else first + k, role, text) for r in b[0].to_pylist() if (x := _mapped(r)) for i, first, turns in [x] for k, (role, text) in enumerate(turns)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return df.select(col).mapInArrow(mapped, TURNS)


def unmapped(df: DataFrame, col: str = "json") -> DataFrame:
    """The JSON records that fit no mapping."""
    small_batches(df.sparkSession)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"json": pa.array([r for r in b[0].to_pylist() if _mapped(r) is None], type=pa.string())})

    return df.select(F.col(col).alias("json")).mapInArrow(rest, "json string")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


_ESCAPED = re.compile(r"<(\\*)\\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def format_turns(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, turn, segment, loss_start, loss_end): one segment per turn; the span counts
    code points from the segment's start."""
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit(NEW_LINE))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    start = F.char_length(head).cast("long")
    text = escape(F.col("text"))
    length = F.when(F.col("role") == loss_role, F.char_length(text)).otherwise(0).cast("long")
    return turns.select("conv_id", "turn", F.concat(head, text, F.lit(END + "\n")).alias("segment"), start.alias("loss_start"), (start + length).alias("loss_end"))


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not (segment.startswith(START) and segment.endswith(END + "\n")):
        raise ValueError("not a formatted turn")
    role, _, text = segment[len(START) : -len(END) - 1].partition("\n")
    return unescape(role.replace(NEW_LINE, "\n")), unescape(text)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """``DIGESTS`` of each conversation, read back from its segments."""
    ship_package(formatted.sparkSession)
    small_batches(formatted.sparkSession)
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment").select("conv_id", "segment", "loss_start", "loss_end")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, n, chars, all_chars, turns, loss = None, False, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
        row = lambda: (now, n, turns.hexdigest(), chars, loss.hexdigest(), all_chars)
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        for b in batches:
            rows = []
            for conv, segment, start, end in zip(b["conv_id"].to_pylist(), strings(b["segment"]), b["loss_start"].to_pylist(), b["loss_end"].to_pylist()):
                if begun and conv != now:
                    rows.append(row())
                    n, chars, all_chars, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                now, begun = conv, True
                role, text = parse_segment(segment)
                under = unescape(segment[start:end])
                turns.update(f"{role}\n{text}\n".encode("utf-8"))
                loss.update(under.encode("utf-8"))
                n, chars, all_chars = n + 1, chars + len(under), all_chars + len(segment)
            if rows:
                yield pack(rows)
        if begun:
            yield pack([row()])

    return ordered.mapInArrow(read, DIGESTS)
