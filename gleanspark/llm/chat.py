"""Conversations as training text, with a loss flag on each segment.

A template says how each role's turns are marked, whether they are learned, and
which role may follow which. A machine walks over the turns of a conversation
in order: it reports a turn that may not come where it does, and emits three segments
per turn, an opening mark, the text and a closing mark. A conversation is
streamed, never gathered, so its length does not matter.

Control strings inside texts are escaped: the escape character follows each of
their first characters, and itself. No control string can then occur in a text,
and reading takes the escapes away again.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import BATCH_ROWS


@dataclass(frozen=True)
class Mark:
    """How a role's turn opens and closes, and whether its text is learned."""

    open: str
    close: str
    learn: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, and the roles that may follow a state; ``start`` is the first state.

    Any other role is written with its name, in ``named``, between ``open`` and
    ``then``. No mark may be empty, and none holds the escape character.
    """

    roles: dict[str, Mark]
    follows: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    named: Mark = Mark("<role>", "</role>")
    then: str = "<says>"
    escape: str = "\\"
    first_characters: str = field(init=False)

    def __post_init__(self):
        marks = [*self.roles.values(), self.named]
        control = [self.then, *(m.open for m in marks), *(m.close for m in marks)]
        if any(not c or self.escape in c for c in control):
            raise ValueError("a mark is empty or holds the escape character")
        first = "".join(sorted({self.escape, *(c[0] for c in control)}))
        object.__setattr__(self, "first_characters", first)


INSTRUCT = Template(
    roles={
        "system": Mark("<<SYS>>", "<</SYS>>"),
        "user": Mark("[INST]", "[/INST]"),
        "assistant": Mark("<s>", "</s>", learn=True),
    },
    follows={
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    ends=("assistant",),
)

SEGMENT = "conv_id {id}, segment bigint, text string, loss boolean, error string"
DIGEST = (
    "conv_id {id}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint, valid boolean, first_error string"
)


class Codec:
    """Writes and reads the turns of a template."""

    def __init__(self, template: Template):
        self.template = template
        first, escape = re.escape(template.first_characters), re.escape(template.escape)
        self._first = re.compile(f"([{first}])")
        self._escaped = re.compile(f"([{first}]){escape}")
        # Possessive, as a text never has to be given back: it ends where a mark begins.
        body = f"((?:[^{first}]|[{first}]{escape})*+)"
        self._turns = [
            (role, re.compile(re.escape(m.open) + body + re.escape(m.close)))
            for role, m in template.roles.items()
        ]
        named = template.named
        self._named = re.compile(
            re.escape(named.open) + body + re.escape(template.then) + body + re.escape(named.close)
        )

    def escaped(self, text: str) -> str:
        return self._first.sub(lambda m: m[1] + self.template.escape, text)

    def plain(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        mark = self.template.roles.get(role)
        if mark is None:
            named = self.template.named
            mark = Mark(named.open + self.escaped(role) + self.template.then, named.close)
        return [(mark.open, False), (self.escaped(text), mark.learn), (mark.close, False)]

    def read(self, text: str, at: int) -> tuple[str, str, int] | None:
        """Role, text and end of the turn that begins ``at``; None if it is not all there."""
        for role, pattern in self._turns:
            if found := pattern.match(text, at):
                return role, self.plain(found[1]), found.end()
        if found := self._named.match(text, at):
            return self.plain(found[1]), self.plain(found[2]), found.end()
        return None


def _emit(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


_NONE = object()


def segments(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: Template = INSTRUCT,
) -> DataFrame:
    """``conv_id``, ``segment`` (from 0), ``text``, ``loss`` and ``error`` in reading order.

    Turns go by ``turn_col``, null first, ties by role and text. A null role or
    text is empty; a null id is one conversation. ``error`` tells on a turn's
    opening mark that its role may not come there. Every turn is written all the same. The rows
    of a conversation lie in one partition, in order.
    """
    id_type = dict(df.dtypes)[id_col]
    rows = df.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def work(batches):
        codec, last, state, number = Codec(template), _NONE, "start", 0
        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.bool_(), pa.string()]
            names = ["conv_id", "segment", "text", "loss", "error"]
            out = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]
            for conv, role, text in zip(*columns, strict=True):
                if last is _NONE or conv != last:
                    last, state, number = conv, "start", 0
                error = None
                if role not in template.follows.get(state, ()):
                    error = f"{role} after {state}"
                state = role
                for i, (part, loss) in enumerate(codec.segments(role, text)):
                    out.append((conv, number, part, loss, None if i else error))
                    number += 1
                if len(out) >= BATCH_ROWS:
                    yield _emit(out, names, kinds)
                    out = []
            if out:
                yield _emit(out, names, kinds)

    return rows.mapInArrow(work, SEGMENT.format(id=id_type))


class _Reader:
    """Digests of one conversation, read from its segments as they come."""

    def __init__(self, codec: Codec):
        self.codec, self.held, self.at = codec, "", 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.role, self.error = "start", None

    def add(self, text: str, loss: bool, error: str | None) -> None:
        self.chars += len(text)
        self.error = self.error or error
        if loss:
            plain = self.codec.plain(text)
            self.loss.update(plain.encode())
            self.loss_chars += len(plain)
        self.held += text
        while turn := self.codec.read(self.held, self.at):
            self.role, plain, self.at = turn
            self.turns.update(f"{self.role}\n{plain}\n".encode())
            self.n_turns += 1
        self.held, self.at = self.held[self.at :], 0

    def row(self, conv) -> tuple:
        if self.held:
            raise ValueError(f"conversation {conv} ends inside a turn")
        error = self.error
        if error is None and self.role not in self.codec.template.ends:
            error = f"ends with {self.role}"
        return (
            conv,
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
            error is None,
            error,
        )


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """A row of digests per conversation, from its formatted text and loss flags alone.

    ``formatted`` has each conversation's segments in one partition, in order.
    """

    def work(batches) -> Iterator[pa.RecordBatch]:
        codec, last, reader, kind = Codec(template), _NONE, None, None
        names = [c.split()[0] for c in DIGEST.split(", ")]
        out = []
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "text", "loss", "error")]
            for conv, text, loss, error in zip(*columns, strict=True):
                if last is _NONE or conv != last:
                    if reader is not None:
                        out.append(reader.row(last))
                    last, reader = conv, _Reader(codec)
                reader.add(text, loss, error)
            if len(out) >= BATCH_ROWS:
                yield _digests(out, names, kind)
                out = []
        if reader is not None:
            out.append(reader.row(last))
            yield _digests(out, names, kind)

    id_type = dict(formatted.dtypes)["conv_id"]
    return formatted.mapInArrow(work, DIGEST.format(id=id_type))


def _digests(rows, names, kind) -> pa.RecordBatch:
    long, text = pa.int64(), pa.string()
    return _emit(rows, names, [kind, long, text, long, text, long, pa.bool_(), text])
