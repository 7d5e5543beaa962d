"""Chat formatting: heterogeneous records to canonical turns by schema fingerprints, and a reversible chat template.

A record is a JSON text. The paths of its nested fields (`messages[].role`) are collected, those that no mapping knows are left
out, and a hash of the sorted rest is the record's fingerprint. Each layout is a declarative mapping from paths to turns,
registered under the fingerprints of its required paths with any of its optional ones. A record whose fingerprint is unknown
or that isn't JSON has layout null and no turns.

The template writes `<|im_start|>role\\ntext<|im_end|>\\n` for each turn. Control strings of this and other templates
inside texts and roles are escaped with a backslash after their first character (one more if they are escaped already), and
line ends in roles as well, so that reading back restores them. The loss mask is a list of spans (start, length in code
points) over the formatted text, one for the text of each assistant turn.

Null roles and texts are empty. Long texts are formatted whole. Turns with equal numbers are in order of role and text, null first; repeated rows stay
repeated turns. A conversation's turns are one value, its formatted text, and so meet in one row; all else is spread. Empty
tables give no conversations but those added. Extra columns don't matter, as the named ones are selected.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tessera.llm.common import table

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ESCAPE = re.compile("|".join(rf"{re.escape(c[0])}(?=\\*{re.escape(c[1:])})" for c in CONTROL))
_UNESCAPE = re.compile("|".join(rf"(?<={re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in CONTROL))
TURNS = "array<struct<role:string,text:string>>"
FORMATTED = "struct<formatted:string,loss:array<struct<start:int,length:int>>>"


@dataclass(frozen=True)
class Layout:
    """One layout: `turns` is the path of a list of turns whose fields `role` and `text` name, or `fixed` gives
    (path, role) pairs for texts of a flat record. `roles` translates role names. open: the list may be empty, its texts may be null or lists of parts
    with a `text` each (put together; parts without one add nothing), and a `system` text of the record comes first."""

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    fixed: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)
    open: bool = False

    def parts(self) -> list[str]:
        return [f"{self.turns}[].{self.text}[]", f"{self.turns}[].{self.text}[].text"] if self.open else []

    def paths(self) -> list[str]:
        return [p for p, _ in self.fixed] if self.fixed else [f"{self.turns}[]", f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"]

    def signatures(self):
        if self.open:
            turns, role, text = self.paths()
            texts = ([], [text], self.parts(), [text, *self.parts()])
            for own in ([turns], *([turns, role, *t] for t in texts)):
                yield sorted(own)
                yield sorted([*own, "system"])
            return
        needed = [p for p in self.paths() if p not in self.optional]
        for n in range(len(self.optional) + 1):
            for some in combinations(self.optional, n):
                yield sorted({*needed, *some})


NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("rows", "rows", "role", "text", optional=("rows[].role", "rows[].text", "rows[].turn")),
    Layout("messages", "messages", "role", "content", roles=NAMES, open=True),
    Layout("conversations", "conversations", "from", "value", roles=NAMES, open=True),
    Layout("dialog", "dialog", "speaker", "utterance", roles=NAMES, open=True),
    Layout("instruction", fixed=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")), optional=("system", "input")),
    Layout("prompt_completion", fixed=(("system", "system"), ("prompt", "user"), ("completion", "assistant")), optional=("system",)),
    Layout("prompt_response", fixed=(("system", "system"), ("prompt", "user"), ("response", "assistant")), optional=("system",)),
    Layout("question_answer", fixed=(("question", "user"), ("answer", "assistant"))),
)


def field_paths(value, at: str = "") -> set[str]:
    """Paths of all lists and scalar fields; `[]` stands for the elements of a list. Null fields count as absent."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in field_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {f"{at}[]"}.union(*(field_paths(v, f"{at}[]") for v in value))
    return set() if value is None else {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@lru_cache(maxsize=8)
def registry(layouts: tuple[Layout, ...]) -> tuple[frozenset, dict[str, Layout]]:
    known: dict[str, Layout] = {}
    for layout in layouts:
        for signature in layout.signatures():
            known.setdefault(fingerprint(signature), layout)
    return frozenset(p for x in layouts for p in (*x.paths(), *x.optional, *x.parts())), known


def canonical(record: str | None, layouts: tuple[Layout, ...] = LAYOUTS) -> tuple[str | None, str | None, list[dict]]:
    """(fingerprint, layout name, turns) of a JSON record."""
    try:
        value = json.loads(record or "null")
    except ValueError:
        return None, None, []
    if not isinstance(value, dict):
        return None, None, []
    vocabulary, known = registry(layouts)
    found = fingerprint(field_paths(value) & vocabulary)
    if not (layout := known.get(found)):
        return found, None, []
    if layout.fixed:
        pairs = [(role, value.get(path)) for path, role in layout.fixed if value.get(path) is not None]
    else:
        pairs = [(x.get(layout.role), x.get(layout.text)) for x in value.get(layout.turns) or [] if isinstance(x, dict)]
        if layout.open:
            said = [("system", value["system"])] if value.get("system") is not None else []
            pairs = said + [(r, _joined(t) if isinstance(t, list) else t) for r, t in pairs]
    word = lambda x: "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)
    return found, layout.name, [{"role": layout.roles.get(word(r), word(r)), "text": word(t)} for r, t in pairs]


def _joined(parts: list) -> str:
    """The texts of a list of parts, put together."""
    texts = [p.get("text") if isinstance(p, dict) else p for p in parts]
    return "".join(t for t in texts if isinstance(t, str))


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub("", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns) -> tuple[str, list[dict]]:
    """The formatted text and its loss spans."""
    parts, at, loss = [], 0, []
    for turn in turns:
        head, body = f"{START}{escape_role(turn['role'])}\n", escape(turn["text"])
        if turn["role"] == "assistant":
            loss.append({"start": at + len(head), "length": len(body)})
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    found, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END, line + 1)
        found.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return found


def canonical_turns(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """struct<fingerprint, layout, turns> of a JSON column."""

    @arrow_udf(f"struct<fingerprint:string,layout:string,turns:{TURNS}>")
    def mapped(records: pa.Array) -> pa.Array:
        found = [dict(zip(("fingerprint", "layout", "turns"), canonical(x.as_py(), layouts), strict=True)) for x in records]
        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        return pa.array(found, type=pa.struct([("fingerprint", pa.string()), ("layout", pa.string()), ("turns", pa.list_(turn))]))

    return mapped(record)


def formatted(turns: Column) -> Column:
    """struct<formatted, loss> of canonical turns."""

    @arrow_udf(FORMATTED)
    def rendered(lists: pa.Array) -> pa.Array:
        span = pa.struct([("start", pa.int32()), ("length", pa.int32())])
        done = [dict(zip(("formatted", "loss"), render(x.as_py() or []), strict=True)) for x in lists]
        return pa.array(done, type=pa.struct([("formatted", pa.string()), ("loss", pa.list_(span))]))

    return rendered(turns)


def read_back(chat: Column) -> Column:
    """struct<turns, masked>: the turns of a formatted text, and its text under the loss mask, unescaped."""

    @arrow_udf(f"struct<turns:{TURNS},masked:array<string>>")
    def restored(chats: pa.Array) -> pa.Array:
        rows = []
        for x in chats:
            x = x.as_py()
            text = x["formatted"]
            rows.append({"turns": [{"role": r, "text": t} for r, t in parse(text)], "masked": [unescape(text[s["start"] : s["start"] + s["length"]]) for s in x["loss"]]})
        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        return pa.array(rows, type=pa.struct([("turns", pa.list_(turn)), ("masked", pa.list_(pa.string()))]))

    return restored(chat)


def conversation_records(rows: DataFrame) -> DataFrame:
    """conv_id, record: one JSON record of layout `rows` for each conversation of a table by turn."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return rows.groupBy("conv_id").agg(F.to_json(F.struct(turns.alias("rows"))).alias("record"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return digests(rows.unionByName(more))


def digests(rows: DataFrame) -> DataFrame:
    """What op1 returns, read back from the formatted text of each conversation."""
    mapped = conversation_records(rows).select("conv_id", canonical_turns(F.col("record")).alias("m"))
    chats = mapped.select("conv_id", "m.fingerprint", "m.layout", formatted(F.col("m.turns")).alias("chat"))
    back = chats.select("*", read_back(F.col("chat")).alias("back"))
    lines = F.array_join(F.transform("back.turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("back.masked", "")
    return back.select(
        "conv_id",
        F.size("back.turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("chat.formatted").cast("long").alias("formatted_chars"),
    )
