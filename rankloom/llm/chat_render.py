"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) messages to one string.  Nothing is
known about it; for every turn the prefix that ends with the turn is rendered and compared
with the render of the prefix before:

* the new output starts with the old one: what was added is the turn's span, and a second
  render, with a probe in place of the text, shows where in the span the text stands;
* it does not: the template rewrites history at this turn.  That is counted, and the texts
  are then located one by one in the finished render, by probing it.

A text that cannot be located (the template drops it or writes it twice) has no span and
is never under the loss mask.

By default a conversation is rendered whole, every prefix from its first turn on, so any
template is right at any length; a conversation is one task's work, and rendering grows with
the square of its length.

A template whose ``context_free`` attribute is true (``marked_turns``) writes each turn
without regard to the others.  Conversations are then cut into blocks of ``BLOCK_TURNS`` turn
numbers, so rendering stays linear in the conversation, and a conversation with a third of all
rows is spread over many tasks.  What the template writes for no messages is its opening and
is written once, by the first block.  A block's first turn is rendered after the last turn
before it as well, so history rewritten across the border is counted.  ``block_turns`` given
by a caller says that the template may be cut so.

Order of turns: turn number, then role, then text; null turn numbers come first, null roles
and texts count as empty.  Rows without a conv_id form one conversation; a row that repeats
another is a turn of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

BLOCK_TURNS = 64
PROBE = ""
SCHEMA = ("conv_id long, block long, piece int, n_turns int, formatted string, n_rewrites int, "
          "spans array<struct<role: string, start: int, stop: int>>")

Template = Callable[[list[tuple[str, str]]], str]

# Strings that a template or a tokenizer may read as control.
_MARK = r"\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>"
_BARE = re.compile(rf"([<\[])(\\*)({_MARK})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_MARK})")


def escape(text: str) -> str:
    """``text`` without control strings: a backslash goes after their first character."""
    return _BARE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def context_free(render: Template) -> Template:
    """Declares that a template writes each turn without regard to the others."""
    render.context_free = True
    return render


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


@context_free
def marked_turns(messages: list[tuple[str, str]]) -> str:
    """The default template: every turn between a start mark with its role and an end mark."""
    return "".join(f"<|im_start|>{_role_line(role)}\n{escape(text)}<|im_end|>\n"
                   for role, text in messages)


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The messages that ``marked_turns`` wrote."""
    return [(_role_of(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _text_in(render: Template, before: list, role: str, text: str, after: list, full: str):
    """(start, stop) of a message's text in ``full``, or None."""
    probed = render([*before, (role, PROBE), *after])
    at = probed.find(PROBE)
    if at < 0 or probed.find(PROBE, at + 1) >= 0:
        return None
    tail = probed[at + len(PROBE):]
    stop = len(full) - len(tail)
    if stop < at or not full.startswith(probed[:at]) or not full.endswith(tail):
        return None
    return at, stop


def render_block(render: Template, messages: list[tuple[str, str]], before: tuple[str, str] | None = None):
    """(formatted, spans, rewrites) of one block; a span is (role, start, stop).  ``before``
    is the message before the block, written by another one."""
    spans, rewrites, out = [], 0, render([])
    if before is not None and messages and not render([before, messages[0]]).startswith(render([before])):
        rewrites += 1
    for k, (role, text) in enumerate(messages):
        now = render(messages[:k + 1])
        if not now.startswith(out):
            rewrites += 1
        spans.append(_text_in(render, messages[:k], role, text, [], now))
        out = now
    if rewrites:  # earlier spans may have moved
        spans = [_text_in(render, messages[:k], role, text, messages[k + 1:], out)
                 for k, (role, text) in enumerate(messages)]
    return out, [(m[0], *s) for m, s in zip(messages, spans) if s], rewrites


def format_conversations(rows: DataFrame, render: Template = marked_turns,
                         block_turns: int | None = None) -> DataFrame:
    """One row per block (see SCHEMA): its text, the span of every located message text in
    it, and at how many turns the template rewrote what it had written before.  Without
    ``block_turns`` a conversation is one block, unless the template is context-free."""
    if block_turns is None and getattr(render, "context_free", False):
        block_turns = BLOCK_TURNS
    block = F.floor(F.col("turn") / block_turns) if block_turns else F.lit(0)
    msgs = rows.select(F.col("conv_id").cast("long").alias("conv_id"),
                       block.cast("long").alias("block"),
                       F.lit(False).alias("outside"),
                       F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if block_turns:
        # Every block but the conversation's first gets the last message before it.
        last = msgs.groupBy("conv_id", "block").agg(F.max(F.struct("turn", "role", "text")).alias("m"))
        ahead = last.withColumn("m", F.lag("m").over(W.partitionBy("conv_id").orderBy("block")))
        msgs = msgs.union(ahead.filter(F.col("m").isNotNull())
                          .select("conv_id", "block", F.lit(True).alias("outside"), "m.turn", "m.role", "m.text"))
    keyed = (msgs.repartition("conv_id", "block")
             .sortWithinPartitions("conv_id", "block", F.col("outside").desc(), "turn", "role", "text")
             .select("conv_id", "block", "outside", "role", "text"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(key, piece, message before, messages): runs of rows of one block, of block_turns at most."""
        key, piece, before, messages = None, 0, None, []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                now = (row[0], row[1])
                if messages and (now != key or len(messages) == block_turns):
                    yield key, piece, before, messages
                    piece, before, messages = (piece + 1, messages[-1], []) if now == key else (0, None, [])
                key = now
                if row[2]:
                    before = (row[3], row[4])
                else:
                    messages.append((row[3], row[4]))
        if messages:
            yield key, piece, before, messages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opening = render([])
        kind = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for (conv_id, block), piece, before, messages in blocks(batches):
            text, spans, rewrites = render_block(render, messages, before)
            cut = 0 if before is None or not text.startswith(opening) else len(opening)
            spans = [{"role": r, "start": a - cut, "stop": b - cut} for r, a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv_id], pa.int64()), pa.array([block], pa.int64()),
                 pa.array([piece], pa.int32()), pa.array([len(messages)], pa.int32()),
                 pa.array([text[cut:]]), pa.array([rewrites], pa.int32()), pa.array([spans], kind)],
                names=["conv_id", "block", "piece", "n_turns", "formatted", "n_rewrites", "spans"])

    return keyed.mapInArrow(run, SCHEMA)


def conversation_digests(formatted: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """Per conversation, from the formatted text and its spans alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, n_rewrites.

    A conversation's blocks pass through one task in order, one row at a time; only running
    digests are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def done() -> pa.RecordBatch:
            conv_id, n, turns, chars, loss, size, rewrites = state
            return pa.RecordBatch.from_arrays(
                [pa.array([conv_id], pa.int64()), pa.array([n], pa.int64()), pa.array([turns.hexdigest()]),
                 pa.array([chars], pa.int64()), pa.array([loss.hexdigest()]), pa.array([size], pa.int64()),
                 pa.array([rewrites], pa.int64())],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                       "formatted_chars", "n_rewrites"])

        for batch in batches:
            for k in range(batch.num_rows):
                conv_id, text, rewrites, spans = (batch.column(c)[k].as_py() for c in range(4))
                if state is None or state[0] != conv_id:
                    if state is not None:
                        yield done()
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in parse_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    if span["role"] == learn_role:
                        said = unescape(text[span["start"]:span["stop"]])
                        state[3] += len(said)
                        state[4].update(said.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
                state[6] += rewrites
        if state is not None:
            yield done()

    rows = (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece")
            .select("conv_id", "formatted", "n_rewrites", "spans"))
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long, n_rewrites long")


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """Format, store, read back, digest."""
    return conversation_digests(stored(format_conversations(conversations), "formatted"))
