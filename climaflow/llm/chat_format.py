r"""Chat formatting by columnar byte assembly.

A conversation becomes one text: for every turn the header ``<turn role>`` and a line feed, the content, and
``</turn>`` with a line feed. Control strings begin with ``<``. In contents every ``\`` and ``<`` gets a ``\`` in front,
so no content can hold a control string, and taking the added ones away gives back the content. Roles are escaped
the same way, with ``\n`` for a line feed and ``\>`` for ``>``.

Texts are not handled one by one. Contents of a batch lie in one buffer; lengths of all headers, contents and footers
give running offsets, these give for every source byte its place, and the bytes are scattered into one buffer
allocated for the whole batch. The loss mask is a list of byte spans per conversation: the escaped contents of the
assistant, without header and footer.

Rows are dealt by conversation and sorted by turn on disk; batches are streamed and only the conversation that a batch
breaks off in is carried over. Conversations are the unit of output, so one of them is held by one task.

Defined results: null texts and roles are empty; turns with the same number follow each other by role and text, null
turns come first; repeated rows are repeated turns; rows of a null id are one conversation; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .words import text_buffers

HEAD, HEAD_END, FOOT = "<turn ", ">\n", "</turn>\n"
LOSS_ROLE = "assistant"
# Bytes of contents that are assembled at a time; a longer conversation is assembled alone.
STEP_BYTES = 8 << 20

SCHEMA = "conv_id bigint, n_turns bigint, formatted string, loss_start array<bigint>, loss_end array<bigint>"


def escape_role(role: str | None) -> str:
    return (role or "").replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def unescape(content: str) -> str:
    return re.sub(r"\\(.)", r"\1", content, flags=re.S)


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``lengths[i]`` numbers, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def assemble(first_rows: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Formatted texts and loss spans of the conversations whose first rows are given (and one past the last row)."""
    at, data = text_buffers(texts)
    data = data[at[0]:at[-1]]
    raw_length = np.diff(at)
    marked = (data == 0x5C) | (data == 0x3C)
    before = _offsets(marked)
    edges = at - at[0]
    length = raw_length + before[edges[1:]] - before[edges[:-1]]

    coded = roles.dictionary_encode() if roles.null_count == 0 else pc.fill_null(roles, "").dictionary_encode()
    names = [r or "" for r in coded.dictionary.to_pylist()]
    heads = [f"{HEAD}{escape_role(r)}{HEAD_END}".encode() for r in names]
    head_at = _offsets(np.array([len(h) for h in heads], np.int64))
    pool = np.frombuffer(b"".join(heads) or b"\0", np.uint8)
    role = coded.indices.to_numpy(zero_copy_only=False)
    head_length = np.diff(head_at)[role]
    foot = np.frombuffer(FOOT.encode(), np.uint8)

    # Where each row's header, content and footer begin.
    turn_at = _offsets(head_length + length + len(foot))
    content_at = turn_at[:-1] + head_length
    foot_at = content_at + length

    out = np.empty(turn_at[-1], np.uint8)
    out[_places(turn_at[:-1], head_length)] = pool[_places(head_at[:-1][role], head_length)]
    # A byte moves on by the marks in its text before it, its own included.
    shift = np.repeat(content_at - edges[:-1] - before[edges[:-1]], raw_length)
    place = shift + np.arange(len(data)) + before[1:]
    out[place] = data
    out[place[marked] - 1] = 0x5C
    out[_places(foot_at, np.full(len(foot_at), len(foot)))] = np.tile(foot, len(foot_at))

    whole_at = turn_at[first_rows]
    formatted = pa.LargeStringArray.from_buffers(len(first_rows) - 1, pa.py_buffer(whole_at.astype(np.int64)), pa.py_buffer(out))
    learnt = np.flatnonzero(np.array([n == LOSS_ROLE for n in names], bool)[role]) if len(names) else np.zeros(0, np.int64)
    conversation = np.searchsorted(first_rows, learnt, "right") - 1
    lists = pa.array(np.searchsorted(conversation, np.arange(len(first_rows))).astype(np.int32))
    own = whole_at[conversation]
    spans = [pa.ListArray.from_arrays(lists, pa.array(x[learnt] - own)) for x in (content_at, foot_at)]
    return formatted, *spans


def _conversations(table: pa.Table) -> np.ndarray:
    """First row of every conversation, and the number of rows."""
    ids = table.column("conv_id")
    null = pc.is_null(ids).to_numpy(zero_copy_only=False)
    value = pc.fill_null(ids, 0).to_numpy()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
    return np.append(np.flatnonzero(new), len(value))


def _emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Formatted rows of whole conversations, a bounded number of bytes at a time."""
    table = table.combine_chunks()
    first = _conversations(table)
    size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy())])[first]
    c = 0
    while c < len(first) - 1:
        d = max(c + 1, int(np.searchsorted(size, size[c] + STEP_BYTES, "right")) - 1)
        part = table.slice(first[c], first[d] - first[c])
        rows = first[c:d + 1] - first[c]
        roles, texts = (part.column(k).combine_chunks() for k in ("role", "text"))
        formatted, begins, ends = assemble(rows, roles, texts)
        yield pa.record_batch(
            [part.column("conv_id").combine_chunks().take(pa.array(rows[:-1])), pa.array(np.diff(rows)), formatted.cast(pa.string()), begins, ends],
            names=["conv_id", "n_turns", "formatted", "loss_start", "loss_end"],
        )
        c = d


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        ids = table.column("conv_id")
        # Conversations that this batch goes on from are held until their end has been seen.
        first = _conversations(table)
        if held and (ids[0].as_py() != last or len(first) > 2):
            cut = 0 if ids[0].as_py() != last else int(first[1])
            yield from _emit(pa.concat_tables([*held, table.slice(0, cut)]))
            table, held = table.slice(cut), []
            first = first[first >= cut] - cut
        if not held and len(first) > 2:
            yield from _emit(table.slice(0, int(first[-2])))
            table = table.slice(int(first[-2]))
        held.append(table)
        last = ids[len(ids) - 1].as_py()
    if held:
        yield from _emit(pa.concat_tables(held))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): formatted text and loss spans in bytes."""
    dealt = rows.select("conv_id", "turn", "role", "text").repartition("conv_id")
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, SCHEMA)


_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n((?:[^\\<]|\\.)*)</turn>\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, read back from the text and the loss spans."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_end")]
            rows = []
            for conv, text, begins, ends in zip(*columns):
                turns = read_back(text)
                whole = hashlib.sha256()
                for role, content in turns:
                    whole.update(f"{role}\n{content}\n".encode())
                raw = text.encode()
                learnt = "".join(unescape(raw[b:e].decode()) for b, e in zip(begins, ends))
                rows.append((conv, len(turns), whole.hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op9_columnar_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return digests(format_conversations(rows.unionByName(extra)))


OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learnt,
    sum(length('<turn >' || chr(10) || '</turn>' || chr(10)) + length(role) + length(text)
      + 2 * length(role) - length(replace(replace(role, chr(92), ''), '<', '')) - length(replace(replace(role, '>', ''), chr(10), ''))
      + length(text) - length(replace(replace(text, chr(92), ''), '<', ''))) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
  formatted_chars::BIGINT AS formatted_chars
FROM said
"""
