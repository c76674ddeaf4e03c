"""Chat formatting: a state machine over roles and a declarative template.

``format_chats`` takes one row per turn.  Each turn becomes text segments with a loss flag; the
texts are escaped, so that no text can imitate a mark of the template, and ``read_chats`` gets roles
and texts back from the segments alone.

Turns are shuffled once by conversation and sorted; a task then streams over them and holds one
Arrow batch and the state of one conversation, however long it is.

Defined results: a null text is empty; a null role is the empty role; rows of one conversation with
equal ``turn`` are ordered by role, then text (nulls first); repeated rows are turns of their own;
rows with a null conversation id form one conversation; other columns are ignored.  An order of roles
that the machine refuses is formatted all the same and marked: ``valid`` is false from that turn on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around each role's text, the roles whose text counts for the loss, and the allowed order.

    ``{role}`` in ``other`` is replaced by the escaped name of a role without marks of its own.
    ``order`` maps a state (the last role, "" at the start) to the roles that may follow.
    """

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>"),
            "user": ("[INST]", "[/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    other: tuple[str, str, str] = ("<<ROLE>>", "<<TEXT>>", "<</TEXT>>")
    trained: frozenset[str] = frozenset({"assistant"})
    order: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )

    def controls(self) -> list[str]:
        return sorted({m for pair in self.marks.values() for m in pair} | set(self.other))


class Codec:
    """Writes turns as segments by a template, and reads them back."""

    def __init__(self, template: ChatTemplate):
        self.template = template
        any_mark = "|".join(map(re.escape, template.controls()))
        self._special = re.compile(rf"\\|(?={any_mark}).", re.DOTALL)
        self._escaped = re.compile(r"\\(.)", re.DOTALL)
        self._mark = re.compile(any_mark)
        self._role_of = {start: role for role, (start, _) in template.marks.items()}

    def escape(self, text: str) -> str:
        r"""Double each backslash, and break each mark by ``\.`` behind its first character."""
        return self._special.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\.", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: "\\" if m[1] == "\\" else "", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        body = (self.escape(text), role in self.template.trained)
        if role in self.template.marks:
            start, end = self.template.marks[role]
            return [(start, False), body, (end, False)]
        opening, between, end = self.template.other
        return [(opening + self.escape(role) + between, False), body, (end, False)]

    def read(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn, from its marks."""
        marks = list(self._mark.finditer(formatted))
        text = self.unescape(formatted[marks[-2].end() : marks[-1].start()])
        if len(marks) == 2:
            return self._role_of[marks[0][0]], text
        return self.unescape(formatted[marks[0].end() : marks[1].start()]), text


#: Output of :func:`format_chats`: one row per turn, in order within its task.
FORMATTED = "conv_id long, position long, segments array<struct<text:string,loss:boolean>>, state string, valid boolean"


def format_chats(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Segments of every turn of ``turns`` (conv_id, turn, role, text), sorted within partitions."""
    codec = Codec(template or ChatTemplate())
    order = codec.template.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run  # no conversation yet
        position, state, valid = 0, "", True
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("conv_id", "position", "segments", "state", "valid")}
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != current or current is run:
                    current, position, state, valid = conv, 0, "", True
                valid = valid and role in order.get(state, ())
                state = role
                out["conv_id"].append(conv)
                out["position"].append(position)
                out["segments"].append([{"text": t, "loss": m} for t, m in codec.segments(role, text)])
                out["state"].append(state)
                out["valid"].append(valid)
                position += 1
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("position", pa.int64()),
            ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
            ("state", pa.string()),
            ("valid", pa.bool_()),
        ]
    )
    sorted_turns = (
        turns.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return sorted_turns.mapInArrow(run, FORMATTED)


#: Output of :func:`read_chats`.
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "valid boolean"
)


def read_chats(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Per conversation, what its formatted segments say: counts, and digests of turns and trained text.

    ``formatted`` must come straight from :func:`format_chats`, whose rows of a conversation follow
    each other in one task; the digests are fed turn by turn.
    """
    codec = Codec(template or ChatTemplate())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [pa.field(n, pa.string() if "sha" in n else pa.bool_() if n == "valid" else pa.int64()) for n in names]
        )
        current: object = run
        done: list[tuple] = []

        def close() -> None:
            if current is not run:
                done.append((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid))

        for batch in batches:
            for conv, segments, ok in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "segments", "valid")), strict=True
            ):
                if conv != current or current is run:
                    close()
                    current, n, loss_chars, chars, valid = conv, 0, 0, 0, True
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                whole = "".join(s["text"] for s in segments)
                role, text = codec.read(whole)
                turns.update(f"{role}\n{text}\n".encode())
                trained = "".join(codec.unescape(s["text"]) for s in segments if s["loss"])
                loss.update(trained.encode())
                n, loss_chars, chars, valid = n + 1, loss_chars + len(trained), chars + len(whole), valid and ok
            if len(done) > 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in done], schema=schema)
                done.clear()
        close()
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in done], schema=schema)

    return formatted.mapInArrow(run, DIGESTS)
