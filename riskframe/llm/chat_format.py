r"""Chat formatting with prefix-target expansion.

A turn becomes ``<|turn|>role<|says|>text<|end|>``.  Inside roles and texts every
``<``, ``[`` and ``\`` is followed by a ``\``; so no control string of this template,
nor any other ``<...>`` or ``[...]`` mark, can occur inside a text, and dropping that
one ``\`` after each of the three characters gives the text back.

Every assistant turn is an example of its own: its context is the formatted
conversation up to and including the turn's ``<|says|>``, and only the reply's text
is trainable.  ``format_turns`` formats the turns and gives each example's spans in its
conversation's formatted text (``context_end``, ``loss_first``, ``loss_end``, in code
points); ``expand`` writes every example out, context and target, and ``read_examples``
reads conversations back from these alone.

Conversations are dealt by id, sorted by turn and read as a stream; the task holds one
conversation's formatted text, which must fit one value (2 GB).  Contexts repeat each
other, so examples grow with the square of a conversation's turns: they pass on in
batches of some 4 million code points (``BATCH``) and are never shuffled.  ``render``
writes out chosen examples only.

Defined results: null text counts as empty, a null role as the empty role; rows with
null conv_id form one conversation; null turns come first; equal turns are ordered by
role, then text, and repeated rows stay; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import pick, ship, table

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
ASSISTANT = "assistant"
_MARKED = re.compile(r"([<\[\\])")
_UNMARKED = re.compile(r"([<\[\\])\\")
_SEGMENT = re.compile(rf"{re.escape(TURN)}(.*?){re.escape(SAYS)}(.*?){re.escape(END)}", re.S)


def escape(text: str) -> str:
    return _MARKED.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _UNMARKED.sub(r"\1", text)


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn, sorted inside partitions that hold whole conversations:
    conv_id, seq, segment, first (its place in the conversation's formatted text), and
    for assistant turns the example's context_end, loss_first, loss_end."""
    spark = conversations.sparkSession
    ship(spark)
    c = pick(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = c.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seq, at = object(), 0, 0
        for b in batches:
            out = []
            for i, role, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                if i != conv:
                    conv, seq, at = i, 0, 0
                head = TURN + escape(role) + SAYS
                body = escape(text.as_py())
                segment = head + body + END
                loss = (at + len(head), at + len(head) + len(body)) if role == ASSISTANT else (None, None)
                out.append((i, seq, segment, at, loss[0], loss[0], loss[1]))
                seq, at = seq + 1, at + len(segment)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _TYPES)] if out else [pa.array([], t) for t in _TYPES], _NAMES)

    return dealt.mapInArrow(run, "conv_id long, seq long, segment string, first long, context_end long, loss_first long, loss_end long")


_NAMES = ["conv_id", "seq", "segment", "first", "context_end", "loss_first", "loss_end"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def examples(turns: DataFrame) -> DataFrame:
    """The examples as spans: one row per assistant turn (conv_id, seq, context_end, loss_first, loss_end)."""
    return turns.filter("loss_first is not null").select("conv_id", "seq", "context_end", "loss_first", "loss_end")


def render(turns: DataFrame, wanted: DataFrame) -> DataFrame:
    """Write out the contexts of the ``wanted`` examples: (conv_id, seq, context, target).
    Contexts of one conversation repeat each other, so this output grows with the
    square of a conversation's turns; use it on the examples of a training batch."""
    w = wanted.select(F.col("conv_id").alias("_c"), F.col("seq").alias("_s"), "context_end", "loss_first", "loss_end")
    parts = turns.select("conv_id", "seq", "segment").join(w, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("seq") <= F.col("_s")))
    whole = parts.groupBy("_c", "_s", "context_end", "loss_first", "loss_end").agg(F.array_sort(F.collect_list(F.struct("seq", "segment"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["segment"]), "")
    return (whole.withColumn("t", text).select(
        F.col("_c").alias("conv_id"), F.col("_s").alias("seq"), F.expr("substring(t, 1, int(context_end))").alias("context"),
        F.expr("substring(t, int(loss_first) + 1, int(loss_end - loss_first))").alias("target")))


#: Code points of contexts and targets in a batch of examples.
BATCH = 4_000_000
_EXAMPLE = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("context", pa.string()), ("target", pa.string())])


def expand(turns: DataFrame) -> DataFrame:
    """Prefix-target expansion of ``format_turns``: a row per assistant turn, in order
    (conv_id, seq, context, target).  The context is the whole formatted conversation before
    the reply, the target is the reply and all that is under the loss mask.  A conversation
    that does not end in a reply ends in a row of its whole text without a target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, last, parts, replied, rows, size = None, 0, None, True, [], 0
        for b in batches:
            for i, seq, segment, first, loss_first, loss_end in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 3, 5, 6))):
                if parts is None or i != conv:
                    if not replied:
                        rows.append((conv, last, "".join(parts), None))
                        size += len(rows[-1][2])
                    conv, parts = i, []
                last, replied = seq, loss_first is not None
                if replied:
                    before = "".join(parts)
                    parts = [before]
                    rows.append((i, seq, before + segment[:loss_first - first], segment[loss_first - first:loss_end - first]))
                    size += len(before) + len(segment)
                parts.append(segment)
                if size >= BATCH:
                    yield _batch(rows)
                    rows, size = [], 0
        if not replied:
            rows.append((conv, last, "".join(parts), None))
        if rows:
            yield _batch(rows)

    return turns.mapInArrow(run, "conv_id long, seq long, context string, target string")


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _EXAMPLE)], schema=_EXAMPLE)


def read_back(turns: DataFrame) -> DataFrame:
    """What the examples of ``format_turns`` say, a row per conversation."""
    return read_examples(expand(turns))


def read_examples(expanded: DataFrame) -> DataFrame:
    """What the output of ``expand`` says, a row per conversation: turns are taken from the
    examples' texts, loss texts from their targets.  A context that does not go on from the
    example before it is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for b in batches:
            done = []
            for i, context, target in zip(b.column(0).to_pylist(), b.column(2), b.column(3)):
                if state is None or i != conv:
                    if state is not None:
                        done.append(state.row(conv))
                    conv, state = i, _Digest()
                state.add(context.as_py(), target.as_py())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_RESULT)
        if state is not None:
            yield pa.RecordBatch.from_pylist([state.row(conv)], schema=_RESULT)

    return expanded.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                    "formatted_chars long, n_examples long, context_chars long")


_RESULT = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64()), ("context_chars", pa.int64())])


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.text, self.n, self.loss_chars, self.n_examples, self.context_chars = "", 0, 0, 0, 0

    def add(self, context: str, target: str | None) -> None:
        if not context.startswith(self.text):
            raise ValueError("an example's context does not go on from the example before it")
        known, self.text = len(self.text), context if target is None else context + target + END
        for m in _SEGMENT.finditer(self.text, known):
            self.turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            self.n += 1
        if target is not None:
            text = unescape(target)
            self.loss.update(text.encode())
            self.loss_chars += len(text)
            self.n_examples += 1
            self.context_chars += len(context)

    def row(self, conv: int | None) -> dict:
        return {"conv_id": conv, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": len(self.text), "n_examples": self.n_examples, "context_chars": self.context_chars}


#: The contract's extra conversation.
EXTRA = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(EXTRA).alias("text"))
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_turns(rows))


def _marks(c: str) -> str:
    return rf"length(regexp_replace({c}, '[^<\[\\]', '', 'g'))"


SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{EXTRA}' UNION ALL SELECT -1, 1, 'assistant', '{EXTRA}'),
s AS (SELECT *, {len(TURN + SAYS)} + length(role) + {_marks('role')} AS head, length(text) + {_marks('text')} AS body FROM c),
p AS (SELECT *, head + coalesce(sum(head + body + {len(END)}) OVER (PARTITION BY conv_id ORDER BY turn, role, text
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS context FROM s)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(head + body + {len(END)})::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       coalesce(sum(context) FILTER (role = 'assistant'), 0)::BIGINT AS context_chars
FROM p GROUP BY conv_id
"""
