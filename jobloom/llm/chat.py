"""Chat formatting by columnar byte assembly.

Each batch of turns is laid out at once: segment lengths (header, role, separator, text, end mark) give
cumulative offsets, the offsets give scatter indices, and constants and contents are copied with numpy
into one preallocated buffer that becomes the Arrow string column without another copy.

Control strings inside roles and texts are escaped reversibly: a backslash goes in after their first
character, one more where backslashes already stand there, and reading takes one away.

Rows of a conversation meet in one task, sorted by turn, and are streamed: a conversation longer than
``CHUNK`` bytes leaves as several consecutive rows (``chunk`` 0, 1, ...), so no task holds a whole one of
unbounded length. Nothing is dropped.

Defined cases: null texts and roles are empty; null ids form one conversation, null turns come first, equal turns go
by role and text, repeated rows all stay; an empty table gives no rows; columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import byte_slices, text_buffers

CHUNK = 8 << 20


@dataclass(frozen=True)
class Template:
    """Marks around a turn, further control strings to guard, and the role whose texts carry the loss."""

    start: str = "<|start|>"
    middle: str = "<|message|>"
    end: str = "<|end|>"
    guarded: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    loss_role: str = "assistant"

    def _tails(self) -> tuple[str, str]:
        marks = {self.start, self.middle, self.end, *self.guarded}
        return "".join(sorted({m[0] for m in marks})), "|".join(re.escape(m[1:]) for m in sorted(marks, key=lambda m: (-len(m), m)))

    def escaping(self) -> str:
        heads, tails = self._tails()
        return rf"([{re.escape(heads)}])(\\*)({tails})"

    def escape(self, texts: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(texts, self.escaping(), r"\1\\\2\3")

    def unescape(self, text: str) -> str:
        heads, tails = self._tails()
        return re.sub(rf"([{re.escape(heads)}])\\(\\*)(?={tails})", r"\1\2", text)

    def turns(self, formatted: str):
        """Read back ``(role, text, start)`` of each turn; ``start`` is the text's first code point."""
        pattern = re.escape(self.start) + "(.*?)" + re.escape(self.middle) + "(.*?)" + re.escape(self.end)
        for m in re.finditer(pattern, formatted, re.S):
            yield self.unescape(m[1]), self.unescape(m[2]), m.start(2)


def _strings(col: pa.Array) -> pa.Array:
    return (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).cast(pa.large_string()).fill_null("")


def assemble(roles: pa.Array, texts: pa.Array, template: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns as one byte buffer, the byte offsets of the turns, and where each text begins and ends."""
    parts = [template.start, roles, template.middle, texts, template.end]
    n = len(texts)
    lengths = np.empty((n, len(parts)), np.int64)
    sources = []
    for k, p in enumerate(parts):
        if isinstance(p, str):
            raw = np.frombuffer(p.encode(), np.uint8)
            lengths[:, k] = len(raw)
        else:
            raw, offsets = text_buffers(p)
            lengths[:, k] = np.diff(offsets)
        sources.append(raw)
    begin = np.concatenate([[0], np.cumsum(lengths.ravel())])
    at = begin[:-1].reshape(n, len(parts))
    out = np.empty(begin[-1], np.uint8)
    for k, p in enumerate(parts):
        if isinstance(p, str):
            out[at[:, k, None] + np.arange(len(sources[k]))] = sources[k]
        else:
            own = np.concatenate([[0], np.cumsum(lengths[:, k])])
            out[np.repeat(at[:, k] - own[:-1], lengths[:, k]) + np.arange(own[-1])] = sources[k]
    return out, np.append(at[:, 0], begin[-1]), at[:, 3], at[:, 3] + lengths[:, 3]


def _conversation_rows(ids: pa.Array, first: np.ndarray, roles, texts, chunk_of, last_open: bool, template: Template):
    """One output batch: a row for each run of turns that begins at ``first``."""
    loss = np.asarray(pc.equal(roles, template.loss_role).fill_null(False))
    buffer, offsets, text_from, text_to = assemble(template.escape(roles), template.escape(texts), template)
    points = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
    ends = np.append(first[1:], len(ids))
    conv = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(np.append(offsets[first], offsets[-1]).astype(np.int64)), pa.py_buffer(buffer))
    base = np.repeat(points[offsets[first]], ends - first)
    where = np.flatnonzero(loss)
    spans = pa.StructArray.from_arrays([pa.array(points[text_from[where]] - base[where]), pa.array(points[text_to[where]] - base[where])], ["start", "end"])
    counts = np.add.reduceat(loss.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), spans)
    done = np.ones(len(first), bool)
    if last_open:
        done[-1] = False
    return pa.RecordBatch.from_arrays([ids.take(pa.array(first)), pa.array(chunk_of, pa.int64()), pa.array(ends - first), conv.cast(pa.string()), lists, pa.array(points[offsets[ends]] - points[offsets[first]]), pa.array(done)], ["conv_id", "chunk", "n_turns", "formatted", "loss_spans", "formatted_chars", "done"])


def format_conversations(turns: DataFrame, template: Template = Template(), id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, chunk, n_turns, formatted, loss_spans, formatted_chars, done``; see the module's notes.

    ``loss_spans`` are code points of ``formatted``. The chunks of a conversation stand one after another in
    one partition and the last has ``done``.
    """
    cols = {"conv_id": turns[id_col], "turn": turns[turn_col], "role": turns[role_col], "text": turns[text_col]}
    rows = turns.select(*[c.alias(n) for n, c in cols.items()]).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        kept, chunk = None, 0  # turns of the open conversation, and its next chunk's number

        def emit(t: pa.Table, open_: bool):
            nonlocal chunk
            ids = t["id"].combine_chunks()
            code = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
            change = code[1:] != code[:-1]
            first = np.concatenate([[0], np.flatnonzero(change) + 1]).astype(np.int64)
            numbers = [chunk] + [0] * (len(first) - 1)
            chunk = numbers[-1] + 1 if open_ else 0
            return _conversation_rows(ids, first, t["role"].combine_chunks(), t["text"].combine_chunks(), numbers, open_, template)

        for b in batches:
            whole = pa.table({"id": b.column(0), "role": _strings(b.column(2)), "text": _strings(b.column(3))})
            _, offsets = text_buffers(whole["text"].combine_chunks())
            for lo, hi in byte_slices(offsets, 1 << 21):
                t = whole.slice(lo, hi - lo)
                t = pa.concat_tables([kept, t]) if kept is not None else t
                last = t["id"][-1]
                same = t["id"].is_null() if not last.is_valid else pc.equal(t["id"], last).fill_null(False)
                start = t.num_rows - int(pc.sum(same).as_py())
                if start:
                    yield emit(t.slice(0, start), False)
                kept = t.slice(start).combine_chunks()
                if kept["text"].nbytes > CHUNK:
                    # all but the last turn, so that the conversation's end always comes with a turn
                    if kept.num_rows > 1:
                        yield emit(kept.slice(0, kept.num_rows - 1), True)
                        kept = kept.slice(kept.num_rows - 1).combine_chunks()
        if kept is not None and kept.num_rows:
            yield emit(kept, False)

    return rows.mapInArrow(run, f"conv_id {kind}, chunk long, n_turns long, formatted string, loss_spans array<struct<start: long, end: long>>, formatted_chars long, done boolean")


def read_back(formatted: DataFrame, template: Template = Template(), in_order: bool = False) -> DataFrame:
    """Digests of each conversation read from its formatted text, chunk after chunk: ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    ``in_order`` says that the rows come straight from ``format_conversations``, whose tasks give a conversation's chunks one
    after another; a table that was written and read again is dealt by conversation and sorted first. A digest over all turns
    in order is serial, so each conversation is read by one task, chunk by chunk.
    """
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches):
        state = None
        for b in batches:
            out = []
            ids, text, spans, done = (b.column(i).to_pylist() for i in (0, 3, 4, 6))
            for i, conv in enumerate(ids):
                if state is None:
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _ in template.turns(text[i]):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for s in spans[i]:
                    said = template.unescape(text[i][s["start"] : s["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text[i])
                if done[i]:
                    out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                    state = None
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [b.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(\|im_start\|>|\|endoftext\|>|\|message\|>|\|im_end\|>|\|start\|>|\|end\|>|/INST\]|INST\]|/s>|s>)', '\1\\\2\3', 'g') AS r,
    regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|endoftext\|>|\|message\|>|\|im_end\|>|\|start\|>|\|end\|>|/INST\]|INST\]|/s>|s>)', '\1\\\2\3', 'g') AS t FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(9 + length(r) + 11 + length(t) + 7) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
