"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and
only its reply is trainable. Turns after the last reply would be in no example, so a
conversation that does not end with a reply gets one more, without a trainable span.

A turn is written between `<s>` and `</s>`, marked by its role. Control strings inside
texts and role names, and backslashes, get a backslash in front, which reading takes away:
no text can end a turn or pretend to be another, and every text comes back as it was.

Rows meet by conversation and are read in the order of their turns, one at a time; what a
task holds is one conversation's transcript. An example repeats the turns before it, so the
output grows with the square of a conversation's turns, as the method has it.

Rows of one conversation follow each other by turn (null first), role and text; repeated
rows are turns of their own. Null texts and roles count as empty, null ids are one
conversation. No conversations give no examples. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.common import arrow_batches, batch_rows, stored, table

ASSISTANT = "assistant"

#: The strings that mark turns, and those around a text by its role.
BEGIN, END = "<s>", "</s>"
AROUND = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>"), ASSISTANT: ("", "")}
OTHER_OPEN, OTHER_MIDDLE, OTHER_CLOSE = "[ROLE ", "]\n", "\n[/ROLE]"

_CONTROL = re.compile(r"\\|</?s>|\[/?INST\]|<</?SYS>>|\[ROLE |\[/ROLE\]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>((?:[^\\<]+|\\.|<(?!/s>))*)</s>", re.DOTALL)
_ROLE = re.compile(r"\[ROLE ((?:[^\\\]]|\\.)*)\]\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as written, and where its escaped text starts and ends in it."""
    if role in AROUND:
        opening, closing = AROUND[role]
    else:
        opening = OTHER_OPEN + escape(role).replace("]", "\\]") + OTHER_MIDDLE
        closing = OTHER_CLOSE
    opening = BEGIN + opening
    inner = escape(text)
    return opening + inner + closing + END, len(opening), len(opening) + len(inner)


def parse_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) of every turn of an example."""
    return [_parse_turn(match.group(1)) for match in _TURN.finditer(text)]


def _parse_turn(inner: str) -> tuple[str, str]:
    for role, (opening, closing) in AROUND.items():
        if opening and inner.startswith(opening):
            return role, unescape(inner[len(opening) : len(inner) - len(closing)])
    if named := _ROLE.match(inner):
        return unescape(named.group(1)), unescape(inner[named.end() : len(inner) - len(OTHER_CLOSE)])
    return ASSISTANT, unescape(inner)


@dataclass(frozen=True)
class Example:
    """A formatted text of which only the characters from loss_start to loss_end are trainable."""

    text: str
    loss_start: int
    loss_end: int


def expand(turns: Iterable[tuple[str, str]]) -> Iterator[Example]:
    """One example for each reply, one more for turns behind the last."""
    transcript, pending = "", False
    for role, text in turns:
        written, start, end = format_turn(role, text)
        start, end = start + len(transcript), end + len(transcript)
        transcript += written
        pending = role != ASSISTANT
        if not pending:
            yield Example(transcript, start, end)
    if pending:
        yield Example(transcript, len(transcript), len(transcript))


def _by_conversation(df: DataFrame, order: list[str], run: Callable, schema: T.StructType) -> DataFrame:
    """Send the ordered rows of every conversation, one at a time, through `run(id, rows)`."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversations = groupby(batch_rows(batches), key=itemgetter(0))
        yield from arrow_batches((row for conv_id, rows in conversations for row in run(conv_id, rows)), schema)

    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(task, schema)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Examples: conv_id, example (from 0 in each), text, loss_start, loss_end."""
    schema = T.StructType(
        [
            T.StructField("conv_id", conversations.schema["conv_id"].dataType),
            T.StructField("example", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("loss_start", T.LongType()),
            T.StructField("loss_end", T.LongType()),
        ]
    )

    def run(conv_id: object, rows: Iterator[tuple]) -> Iterator[tuple]:
        turns = ((role or "", text or "") for _, _, role, text in rows)
        for i, example in enumerate(expand(turns)):
            yield conv_id, i, example.text, example.loss_start, example.loss_end

    rows = conversations.select("conv_id", "turn", "role", "text")
    return _by_conversation(rows, ["turn", "role", "text"], run, schema)


def read_back(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation say: its turns, and all text under the loss mask."""
    parsed = T.StructType(
        [
            T.StructField("conv_id", examples.schema["conv_id"].dataType),
            T.StructField("example", T.LongType()),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss", T.StringType()),
            T.StructField("chars", T.LongType()),
        ]
    )

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv_id, example, text, start, end in batch_rows(batches):
                turns = parse_turns(text)
                digest = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode())
                yield conv_id, example, len(turns), digest.hexdigest(), unescape(text[start:end]), len(text)

        yield from arrow_batches(rows(), parsed)

    summary = T.StructType(
        [
            parsed["conv_id"],
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def sum_up(conv_id: object, rows: Iterator[tuple]) -> Iterator[tuple]:
        loss, loss_chars, formatted = hashlib.sha256(), 0, 0
        for _, _, n_turns, turns_sha256, said, chars in rows:
            loss.update(said.encode())
            loss_chars += len(said)
            formatted += chars
        # The last example holds every turn.
        yield conv_id, n_turns, turns_sha256, loss_chars, loss.hexdigest(), formatted

    columns = examples.select("conv_id", "example", "text", "loss_start", "loss_end")
    return _by_conversation(columns.mapInArrow(parse, parsed), ["example"], sum_up, summary)


def op6_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that quotes the template, formatted, written, read back."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoting = spark.range(2).select(
        F.lit(-7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    quoting = quoting.select(*(F.col(f.name).cast(f.dataType) for f in conversations.schema))
    return read_back(stored(format_conversations(conversations.union(quoting)), "chat-examples"))
