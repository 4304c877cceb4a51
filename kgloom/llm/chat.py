"""Chat formatting: token-level assembly.

Every turn's text is escaped and encoded on its own; the ids of control marks, which no text
can produce, are spliced around it, so marks never merge with text. Positions in the
conversation and the loss mask (assistant texts) are prefix sums of the turns' token counts.

Escaping: a control string inside a text gets a backslash after its first character, one
more than any already there; unescaping takes one away. What a text says is thus never a mark,
and every text comes back unchanged.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import Vocabulary, public_path, vocabulary
from .common import map_arrow, table

#: fixed marks of the template, in the order of their reserved ids
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]"]
#: what opens and closes the text of a role; other roles are named between the marks of a role
ROLE_MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
LOSS_ROLE = "assistant"
_RESTS = r"(s>|/s>|<SYS>>|</SYS>>|\|endoftext\|>|INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\])"
_RAW = regex.compile(r"([<\[])(\\*)" + _RESTS)
_ESCAPED = regex.compile(r"([<\[])\\(\\*)" + _RESTS)


def escape(text: str) -> str:
    return _RAW.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class Template:
    """Marks as ids beyond those of the vocabulary."""

    def __init__(self, known: Vocabulary):
        self.known = known
        self.base = len(known.bytes_of)
        self.id_of = {mark: self.base + i for i, mark in enumerate(MARKS)}

    def turn(self, role: str | None, text: str | None) -> tuple[bytes, int, int]:
        """(ids of the turn, tokens before its text, tokens of its text)."""
        mark = lambda name: self.id_of[name].to_bytes(4, "little") if name else b""
        if role in ROLE_MARKS:
            head, tail = map(mark, ROLE_MARKS[role])
        else:
            head = mark("[ROLE]") + self.known.encode(escape(role or "")) + mark("[/ROLE]")
            tail = mark("[/TURN]")
        body = self.known.encode(escape(text or ""))
        return head + body + tail, len(head) // 4, len(body) // 4

    def text(self, ids: np.ndarray) -> str:
        """The formatted text, marks included."""
        out = []
        at = 0
        for cut in [*np.flatnonzero(ids >= self.base).tolist(), len(ids)]:
            out.append(self.known.decode(ids[at:cut].tolist()))
            if cut < len(ids):
                out.append(MARKS[ids[cut] - self.base])
            at = cut + 1
        return "".join(out)

    def parsed(self, ids: np.ndarray) -> tuple[str, str]:
        """(role, text) of a turn, from its ids alone."""
        marks = np.flatnonzero(ids >= self.base)
        names = [MARKS[ids[m] - self.base] for m in marks]
        between = lambda a, b: unescape(self.known.decode(ids[a:b].tolist()))
        if names[0] == "[ROLE]":
            return between(marks[0] + 1, marks[1]), between(marks[1] + 1, marks[2])
        for role, (head, tail) in ROLE_MARKS.items():
            if names == [x for x in (head, tail) if x]:
                return role, between(marks[0] + 1 if head else 0, marks[-1])
        raise ValueError(f"no turn has the marks {names}")


def format_conversations(rows: DataFrame, path: str) -> DataFrame:
    """Turns as tokens: conv_id, turn, ids, place (in the conversation's tokens), loss_start, loss_end (of the mask).

    ``rows`` has conv_id, turn, role, text; other columns are ignored. Turns go by number, equal ones by role
    and text, null before all. A null text is empty, a null role is a role without a name. A mask that covers
    nothing has equal ends. The start mark of a conversation stands before its first turn and counts in places.
    """

    def run(batches):
        template = Template(vocabulary(path))
        for batch in batches:
            turns = [template.turn(*x) for x in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            head, body = (pa.array([t[i] for t in turns], pa.int64()) for i in (1, 2))
            ids = pa.array([t[0] for t in turns], pa.binary())
            kept = [batch.column(n) for n in ("conv_id", "turn", "role", "text")]
            yield pa.RecordBatch.from_arrays([*kept, ids, head, body], ["conv_id", "turn", "role", "text", "ids", "head", "body"])

    kinds = dict(rows.dtypes)
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, ids binary, head long, body long"
    encoded = map_arrow(rows.select("conv_id", "turn", "role", "text"), run, schema)
    order = ["turn", "role", "text"]
    together = encoded.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    running = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.expr("octet_length(ids) div 4")
    placed = together.withColumn("place", F.lit(1) + F.sum(n).over(running) - n)
    start = F.col("place") + F.col("head")
    learnt = F.when(F.col("role") == LOSS_ROLE, F.col("body")).otherwise(0)
    return placed.select(
        "conv_id", "turn", "ids", "place", start.alias("loss_start"), (start + learnt).alias("loss_end")
    )


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """One row a conversation, from the formatted tokens and the mask: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. Digests run along a conversation's turns, so no conversation is held whole. Rows without
    a conversation id are one conversation."""

    def run(batches):
        template = Template(vocabulary(path))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        current, state = None, None

        def row():
            return [current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

        for batch in batches:
            done = []
            for conv, ids, place, start, end in zip(
                *(batch.column(n).to_pylist() for n in ("conv_id", "ids", "place", "loss_start", "loss_end"))
            ):
                if state is None or conv != current:
                    if state is not None:
                        done.append(row())
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), len(MARKS[0])]
                ids = np.frombuffer(ids, "<u4")
                role, text = template.parsed(ids)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                learnt = unescape(template.text(ids[start - place : end - place]))
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += len(template.text(ids))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row(), kinds)], names)

    rows = formatted.sortWithinPartitions("conv_id", "place")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(rows.withColumn("conv_id", F.col("conv_id").cast("long")), run, schema)


#: a conversation whose texts are made of marks
PROBE = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_path("byte_bpe_50k.json")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return read_back(format_conversations(rows.unionAll(probe), path), path)


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text,
      '[<\[]\\*(s>|/s>|<SYS>>|</SYS>>|\|endoftext\|>|INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\])'))
    + CASE role WHEN 'user' THEN length('[INST][/INST]') WHEN 'assistant' THEN length('</s>')
      WHEN 'system' THEN length('<<SYS>><</SYS>>')
      ELSE length('[ROLE][/ROLE][/TURN]') + length(role) END AS chars
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(chars))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
