"""Chat formatting: records of many layouts become canonical turns, then one template.

A record's schema is the set of its nested field paths (``messages[].role``); the hash of that set is
its fingerprint.  Layouts are declared, not coded: a list of turns with the names of role and text, or
single fields with their roles.  Each layout stands in a table under the fingerprints of all its forms
(with and without optional fields), so a record finds its mapping by one lookup.

The template marks turns with control strings.  Wherever a text holds something that reads as a
control string of this or another common template, a backslash goes in after its first character, one
more if some stand there already; taking one away restores the text.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, END = "<|im_start|>", "<|im_end|>\n"
_CONTROL = r"(?=\|\w*\|>|/?s>|</?SYS>>|(?:start|end)_of_turn>|/?INST\])"
_ESCAPE = re.compile(r"([<\[])(\\*)" + _CONTROL)
_UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _CONTROL)
_READ = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


@dataclass(frozen=True)
class Layout:
    """Where a record has its turns: either ``turns`` (path of a list) with ``role`` and ``text``, or
    ``fields``: (role, path, optional) in order.  Neighbouring fields of one role are one turn."""

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str, bool], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def forms(self) -> list[frozenset[str]]:
        """The sets of field paths that records of this layout may have."""
        if self.turns:
            parents = {".".join(self.turns.split(".")[: k + 1]) for k in range(self.turns.count("."))}
            listed = {*parents, self.turns}
            full = listed | {f"{self.turns}[]", *(f"{self.turns}[].{n}" for n in (self.role, self.text))}
            return [frozenset(full), frozenset(listed)]
        needed = {path for _, path, optional in self.fields if not optional}
        others = [path for _, path, optional in self.fields if optional]
        return [
            frozenset(_with_parents(needed | set(some)))
            for k in range(len(others) + 1)
            for some in combinations(others, k)
        ]


def _with_parents(paths) -> set[str]:
    out = set()
    for path in paths:
        parts = path.split(".")
        out |= {".".join(parts[: k + 1]) for k in range(len(parts))}
    return out


LAYOUTS = (
    Layout("messages", "messages", "role", "content"),
    Layout(
        "conversations",
        "conversations",
        "from",
        "value",
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout("dialog", "dialog.turns", "speaker", "utterance"),
    Layout("prompt", fields=(("user", "prompt", False), ("assistant", "response", False))),
    Layout("completion", fields=(("user", "prompt", False), ("assistant", "completion", False))),
    Layout(
        "instruction",
        fields=(
            ("system", "system", True),
            ("user", "instruction", False),
            ("user", "input", True),
            ("assistant", "output", False),
        ),
    ),
    Layout("question", fields=(("user", "data.question", False), ("assistant", "data.answer", False))),
)


def field_paths(value, at: str = "") -> set[str]:
    """All nested field paths of a JSON value; the elements of a list share ``[]``."""
    out, open_ = set(), [(value, at)]
    while open_:
        value, at = open_.pop()
        if isinstance(value, dict):
            for name, inner in value.items():
                path = f"{at}.{name}" if at else name
                out.add(path)
                open_.append((inner, path))
        elif isinstance(value, list):
            for inner in value:
                out.add(f"{at}[]")
                open_.append((inner, f"{at}[]"))
    return out


def fingerprint(paths) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def mappings(layouts=LAYOUTS) -> dict[str, Layout]:
    return {fingerprint(form): layout for layout in layouts for form in layout.forms()}


def _at(value, path: str):
    for name in path.split("."):
        value = value[name]
    return value


def _as_text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical(record, layout: Layout, present: set[str]) -> list[tuple[str, str]]:
    """The (role, text) turns of a record."""
    names = dict(layout.roles)
    if layout.turns:
        found = [
            (_as_text(t.get(layout.role)), _as_text(t.get(layout.text)))
            for t in _at(record, layout.turns)
        ]
        return [(names.get(role, role), text) for role, text in found]
    out: list[tuple[str, str]] = []
    for role, path, _ in layout.fields:
        if path in present:
            text = _as_text(_at(record, path))
            if out and out[-1][0] == role:
                text = f"{out.pop()[1]}\n\n{text}"
            out.append((role, text))
    return out


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a conversation and the spans (code points) that a model learns to write."""
    out, spans, at = [], [], 0
    for role, text in turns:
        name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
        head, body = f"{TURN}{name}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_back(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out = []
    for name, body in _READ.findall(text):
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(name))
        out.append((role, unescape(body)))
    return out


CONVERSATIONS = (
    "conv_id long, layout string, text string, loss array<struct<start:long,end:long>>"
)


def format_records(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Per row of ``records`` (conv_id, record as JSON): conv_id, layout, text and loss.

    ``text`` is the conversation in the template and ``loss`` the spans of assistant texts in it.  A
    record whose fingerprint no layout has, or that is null or not JSON, keeps its row with a null
    layout, text and loss.  Null values are empty texts, other values their JSON; a list without turns
    is an empty text.  Repeated rows are formatted alike, null ids stay, an empty input gives no rows
    and other columns are ignored.
    """
    table = mappings(layouts)

    def one(record):
        try:
            value = json.loads(record)
        except (TypeError, ValueError):
            return None, None, None
        present = field_paths(value)
        layout = table.get(fingerprint(present))
        try:
            turns = layout and canonical(value, layout, present)
        except (AttributeError, TypeError, KeyError):  # same paths, but other kinds of values
            return None, None, None
        if layout is None:
            return None, None, None
        text, spans = formatted(turns)
        return layout.name, text, [{"start": a, "end": b} for a, b in spans]

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            names, texts, spans = [], [], []
            for record in batch.column(1).to_pylist():
                name, text, loss = one(record)
                names.append(name)
                texts.append(text)
                spans.append(loss)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(spans, kind),
                ],
                names=["conv_id", "layout", "text", "loss"],
            )

    return records.select(F.col("conv_id").cast("long"), F.col("record").cast("string")).mapInArrow(
        run, CONVERSATIONS
    )


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, layout string"
)


def digests(conversations: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations (conv_id, layout, text, loss): number and
    hash of the turns, code points and hash of the unescaped text under the loss mask, and length."""

    def sha(text):
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches):
        for batch in batches:
            rows = []
            for name, text, loss in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                turns = read_back(text or "")
                learned = "".join(unescape(text[s["start"] : s["end"]]) for s in loss or ())
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append(
                    (len(turns), sha(whole), len(learned), sha(learned), len(text or ""), name)
                )
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[part.split()[0] for part in DIGESTS.split(", ")],
            )

    return conversations.mapInArrow(run, DIGESTS)


def as_records(turns: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as records (conv_id, record) in the layout that fits.

    A user and an assistant turn are a prompt with its response, with a system turn before them an
    instruction, other conversations of these three roles a list of ``from`` and ``value``, and the
    rest a list of messages.  Turns follow by number, equal ones by role and text.  A null text is
    empty.  One conversation is one record, so its turns meet in one task.
    """
    said = F.struct(
        "turn",
        F.col("role").cast("string").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("t"))
    roles = F.transform("t", lambda x: F.coalesce(x["role"], F.lit("")))
    text = lambda k: F.col("t")[k]["text"]
    names = F.create_map(*map(F.lit, ("user", "human", "assistant", "gpt", "system", "system")))
    known = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    are = lambda *want: roles == F.array(*map(F.lit, want))
    record = (
        F.when(
            are("user", "assistant"),
            F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))),
        )
        .when(
            are("system", "user", "assistant"),
            F.to_json(
                F.struct(
                    text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output")
                )
            ),
        )
        .when(
            known,
            F.to_json(
                F.struct(
                    F.transform(
                        "t",
                        lambda x: F.struct(
                            names[x["role"]].alias("from"), x["text"].alias("value")
                        ),
                    ).alias("conversations")
                )
            ),
        )
        .otherwise(
            F.to_json(
                F.struct(
                    F.transform(
                        "t",
                        lambda x: F.struct(
                            F.coalesce(x["role"], F.lit("")).alias("role"),
                            x["text"].alias("content"),
                        ),
                    ).alias("messages")
                )
            )
        )
    )
    return grouped.select("conv_id", record.alias("record"))
