"""Chat formatting: conversations rendered by a template that is only called, never looked into.

Incremental black-box rendering: successive prefixes of a conversation's turns are rendered, and consecutive outputs are
compared. What an output has beyond the one before is the turn's span; its text is found in the span by a probe, a turn
of the same role whose text is one character that no template writes. If an output does not begin with the one before,
the template has rewritten history: the turn then counts how many earlier characters changed, and its span begins where
the two outputs part.

A template is ``local`` if what a turn adds depends on it and on the turn before it only. Its conversations are rendered
in blocks of ``BLOCK`` turns, each led in by the turn before, so that prefixes and memory follow the block and not the
conversation, and a conversation of very many turns is dealt out by stretches of ``STRETCH`` turn numbers. For any other
template each prefix has the whole conversation so far and gives one block, which must fit into a task.

Edge cases: a null text is an empty one, a null role an empty name, turns with a null ``conv_id`` are one conversation; a
null ``turn`` comes first, ties go by role, then text, so repeated rows are turns of their own; a text not found as
written (a template that trims, say) has null places and no loss; very long texts are rendered once per later turn of
their block; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialize, work_folder

Turns = Sequence[tuple[str, str]]  # role, text

BLOCK, STRETCH = 32, 4096
LOSS_ROLE = "assistant"
PROBE = "\ue000"

#: Control strings of the template; a row of ``~`` after the first character makes them plain text.
CONTROL = re.compile(r"([<\[])(~*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\])")
SYSTEM, USER, ASSISTANT, OTHER = ("<s>[INST] <<SYS>>\n", "\n<</SYS>>\n\n"), ("<s>[INST] ", " [/INST]"), (" ", " </s>"), ("<s>[ROLE] ", " [/ROLE]")


def escape(text: str) -> str:
    """``text`` without control strings: each occurrence, escaped or not, gets one ``~`` more."""
    return CONTROL.sub(r"\1~\2\3", text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def render_inst(turns: Turns) -> str:
    """Marks of an instruction format; roles beyond system, user and assistant are written with their name."""
    out, before = [], None
    for role, text in turns:
        text = escape(text)
        if role == "system":
            out.append(f"{SYSTEM[0]}{text}{SYSTEM[1]}")
        elif role == "user":
            out.append(f"{'' if before == 'system' else USER[0]}{text}{USER[1]}")
        elif role == "assistant":
            out.append(f"{ASSISTANT[0]}{text}{ASSISTANT[1]}")
        else:
            name = escape(role).replace("\\", "\\\\").replace("\n", "\\n")
            out.append(f"{OTHER[0]}{name}\n{text}{OTHER[1]}")
        before = role
    return "".join(out)


def parse_inst(formatted: str) -> list[tuple[str, str]]:
    """The turns of a text that :func:`render_inst` wrote."""
    turns, at = [], 0
    while at < len(formatted):
        if formatted.startswith(SYSTEM[0], at):
            role, (start, close) = "system", SYSTEM
        elif formatted.startswith(USER[0], at):
            role, (start, close) = "user", USER
        elif formatted.startswith(OTHER[0], at):
            role, (start, close) = None, OTHER
        elif _next_control(formatted, at) == "[/INST]":  # after a system turn
            role, start, close = "user", "", USER[1]
        else:
            role, (start, close) = "assistant", ASSISTANT
        at += len(start)
        end = formatted.index(close, at)
        text, at = formatted[at:end], end + len(close)
        if role is None:
            name, text = text.split("\n", 1)
            role = unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name))
        turns.append((role, unescape(text)))
    return turns


def _next_control(formatted: str, at: int) -> str | None:
    while (found := CONTROL.search(formatted, at)) and found[2]:
        at = found.end()
    return found and found[0]


@dataclass(frozen=True)
class Template:
    """``render`` gives the text of a list of turns. ``escape`` is what it does to their texts, ``unescape`` undoes it."""

    render: Callable[[Turns], str]
    escape: Callable[[str], str]
    unescape: Callable[[str], str]
    local: bool = True


INST = Template(render_inst, escape, unescape)


@dataclass
class Turn:
    role: str
    start: int
    end: int
    text_start: int | None
    text_end: int | None
    rewritten: int


class Renderer:
    """Renders the turns of one conversation one by one and keeps where each lies in the output."""

    def __init__(self, template: Template):
        self.template, self._edges = template, {}

    def begin(self, lead: Turns = ()) -> None:
        self.window, self.turns = list(lead), []
        self.output = self.lead = self.template.render(self.window) if lead else ""

    def _around(self, role: str) -> tuple[int, int] | None:
        """How many characters a turn of that role adds before and after its text."""
        before = self.window[-1][0] if self.window else None
        if not self.template.local or (before, role) not in self._edges:
            known = [(before, "")] if self.template.local and before is not None else self.window
            old, new = (self.template.render(turns) if turns else "" for turns in (known, [*known, (role, PROBE)]))
            at = new.find(PROBE, len(os.path.commonprefix([old, new])))
            self._edges[before, role] = None if at < 0 or not new.startswith(old) else (at - len(old), len(new) - at - 1)
        return self._edges[before, role]

    def add(self, role: str, text: str) -> None:
        around = self._around(role)
        self.window.append((role, text))
        old, new = self.output, self.template.render(self.window)
        shared = len(old) if new.startswith(old) else len(os.path.commonprefix([old, new]))
        a = b = None
        if around is not None and shared == len(old):
            a, b = shared + around[0], len(new) - around[1]
            if new[a:b] != self.template.escape(text):
                a = b = None
        cut = len(self.lead)
        places = (shared - cut, len(new) - cut, None if a is None else a - cut, None if b is None else b - cut)
        self.turns.append(Turn(role, *places, len(old) - shared))
        self.output = new

    @property
    def formatted(self) -> str:
        return self.output[len(self.lead) :]


_KEYS = "conv_id bigint, stretch bigint, block bigint, only boolean"
_TURN = "role: string, start: bigint, end: bigint, text_start: bigint, text_end: bigint, loss: boolean, rewritten: bigint"
_BLOCKS = f"{_KEYS}, formatted string, turns array<struct<{_TURN}>>"
_MORE, _LEAD, _OWN = 0, 1, 2  # kinds of rows of a stretch, in order: it has a successor; the turn before it; its turns


def _rows(batches: Iterable[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``most`` bytes."""
    waiting, held = [], 0
    for row in rows:
        waiting.append(row)
        held += size(row) + 64
        if held >= most:
            yield _batch(waiting, schema)
            waiting, held = [], 0
    if waiting:
        yield _batch(waiting, schema)


_LONG, _TEXT = pa.int64(), pa.string()
_BLOCK_SCHEMA = pa.schema(
    [("conv_id", _LONG), ("stretch", _LONG), ("block", _LONG), ("only", pa.bool_()), ("formatted", _TEXT)]
    + [("turns", pa.list_(pa.struct([(f, t) for f, t in zip(
        ("role", "start", "end", "text_start", "text_end", "loss", "rewritten"),
        (_TEXT, _LONG, _LONG, _LONG, _LONG, pa.bool_(), _LONG), strict=True)])))]
)


def _rendered(template: Template, loss_role: str, block: int):
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        renderer, own, number, only, opened = Renderer(template), None, 0, True, False

        def closed(last: bool) -> tuple:
            turns = [{**t.__dict__, "loss": t.role == loss_role and t.text_start is not None} for t in renderer.turns]
            return (*own, number, only and last and number == 0, renderer.formatted, turns)

        for conv, stretch, kind, role, text in _rows(batches, ("conv_id", "stretch", "kind", "role", "text")):
            if (conv, stretch) != own:
                if opened:
                    yield closed(True)
                own, number, only, opened = (conv, stretch), 0, True, False
                renderer.begin()
            if kind != _OWN:
                only = False
                if kind == _LEAD:
                    renderer.begin([(role or "", text or "")])
                continue
            if opened and template.local and len(renderer.turns) == block:
                yield closed(False)
                number += 1
                renderer.begin(renderer.window[-1:])
            renderer.add(role or "", text or "")
            opened = True
        if opened:
            yield closed(True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(blocks(batches), _BLOCK_SCHEMA, lambda row: len(row[4]) + 64 * len(row[5]))

    return run


def format_conversations(
    conversations: DataFrame, template: Template = INST, loss_role: str = LOSS_ROLE, block: int = BLOCK, stretch: int = STRETCH
) -> DataFrame:
    """The formatted text of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``), a row per block of turns.

    ``formatted`` of the blocks of a conversation, in order of ``stretch`` and ``block``, make up its text; ``only`` says
    that there is one. ``turns`` has role, span and text place in code points of ``formatted``, whether the text is under
    the loss mask, and how many earlier characters the turn has ``rewritten``.
    """
    part = F.floor(F.col("turn").cast("double") / stretch).cast("bigint") if template.local else F.lit(0).cast("bigint")
    order = ["turn", "role", "text"]
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.coalesce(part, F.lit(-(1 << 62))).alias("stretch"), F.lit(_OWN).alias("kind"),
        F.col("turn").cast("bigint").alias("turn"), "role", "text",
    )
    every = rows
    if template.local:
        # What conversations of several stretches need besides: the turn before a stretch, and word that one follows.
        by_conv = Window.partitionBy("conv_id").orderBy("stretch")
        chain = rows.select("conv_id", "stretch").distinct().withColumn("next", F.lead("stretch").over(by_conv)).filter("next IS NOT NULL")
        spark = conversations.sparkSession
        chain = materialize(chain, work_folder(spark))  # few rows, mostly: once written, Spark knows their size for the join
        more = chain.select("conv_id", "stretch", F.lit(_MORE).alias("kind"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order])
        links = chain.select(F.col("conv_id").alias("__conv"), F.col("stretch").alias("__stretch"), "next")
        ends = rows.join(links, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("stretch") == F.col("__stretch")))
        last = ends.groupBy("conv_id", "stretch", "next").agg(F.max(F.struct(*order)).alias("last"))
        lead = last.select("conv_id", F.col("next").alias("stretch"), F.lit(_LEAD).alias("kind"), *[f"last.{c}" for c in order])
        every = rows.unionByName(more).unionByName(lead)
    keys = ["conv_id", "stretch"]
    dealt = every.repartition(*keys).sortWithinPartitions(*keys, "kind", *order)
    return dealt.mapInArrow(_rendered(template, loss_role, block), _BLOCKS)


def rewriting_turns(blocks: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns`` and ``rewritten`` (earlier characters changed, summed) of conversations that a template rewrites."""
    each = blocks.select("conv_id", F.explode("turns").alias("t")).filter("t.rewritten > 0")
    return each.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.sum("t.rewritten").alias("rewritten"))


# --- reading back --------------------------------------------------------------------------------------------------

_DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_DIGEST_SCHEMA = pa.schema([("conv_id", _LONG), ("n_turns", _LONG), ("turns_sha256", _TEXT), ("loss_chars", _LONG), ("loss_sha256", _TEXT), ("formatted_chars", _LONG)])
_CARRIED = f"{_DIGEST}, stretch bigint, block bigint, formatted string, loss array<string>"
_CARRIED_SCHEMA = pa.schema([*_DIGEST_SCHEMA, ("stretch", _LONG), ("block", _LONG), ("formatted", _TEXT), ("loss", pa.list_(_TEXT))])


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, loss: Iterable[str], parse: Callable[[str], list[tuple[str, str]]]) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for text in loss:
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    @property
    def values(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(template: Template, parse: Callable):
    """Whole conversations are digested; blocks of longer ones are passed on with the texts under their mask."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, stretch, block, only, formatted, turns in _rows(batches, ("conv_id", "stretch", "block", "only", "formatted", "turns")):
            loss = [template.unescape(formatted[t["text_start"] : t["text_end"]]) for t in turns if t["loss"]]
            if only:
                digest = _Digest()
                digest.add(formatted, loss, parse)
                yield (conv, *digest.values, None, None, None, None)
            else:
                yield (conv, None, None, None, None, None, stretch, block, formatted, loss)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), _CARRIED_SCHEMA, lambda row: 2 * len(row[8] or "") + 256)

    return run


def _finished(parse: Callable):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        own, digest = None, None
        for row in _rows(batches, _CARRIED_SCHEMA.names):
            if row[1] is not None:
                yield row[:6]
                continue
            if digest is None or row[0] != own:
                if digest is not None:
                    yield (own, *digest.values)
                own, digest = row[0], _Digest()
            digest.add(row[8], row[9], parse)
        if digest is not None:
            yield (own, *digest.values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), _DIGEST_SCHEMA, lambda row: 256)

    return run


def read_back(blocks: DataFrame, template: Template = INST, parse: Callable[[str], list[tuple[str, str]]] = parse_inst) -> DataFrame:
    """Digests of what the formatted text holds, one row per conversation.

    Turns come from parsing the text, loss texts from the mask. Only the blocks of conversations with several of them
    are shuffled; a digest takes its conversation in order, so one task reads those, one block at a time.
    """
    carried = blocks.mapInArrow(_read(template, parse), _CARRIED)
    order = ["conv_id", F.col("n_turns").isNotNull(), "stretch", "block"]
    return carried.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_finished(parse), _DIGEST)
