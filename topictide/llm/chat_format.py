"""Chat formatting: conversations become marked-up texts with loss spans, assembled column by column.

Rows are dealt by conversation and sorted inside their partition, then stream through Arrow. For every run of whole
conversations the lengths of all segments, their cumulative offsets and the scatter indices are computed with numpy, and markers,
roles and texts are copied into one preallocated buffer that becomes the Arrow column itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topictide.llm.common import slices, small_batches

# ---- fixed values -------------------------------------------------------------------
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"
LOSS_ROLE = "assistant"
# ---- end of fixed values ------------------------------------------------------------

# Control strings begin with "<|". Inside a text every "<", any backslashes, "|" gets one backslash more, so that no
# "<|" is left; taking one away restores the text.
_ESCAPE, _ESCAPED = r"<(\\*)\|", r"<\\\1|"
_UNESCAPE = re.compile(rb"<\\(\\*)\|")
_TURN = re.compile(rb"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

FORMATTED = "conv_id long, formatted binary, n_turns long, loss array<struct<start:long,stop:long>>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, _ESCAPE, _ESCAPED)


def unescape(text: bytes) -> bytes:
    return _UNESCAPE.sub(rb"<\1|", text)


def escape_role(roles: pa.Array) -> pa.Array:
    """A role stays on one line: line feeds and backslashes are escaped first."""
    return escape(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescape_role(role: bytes) -> bytes:
    return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], unescape(role), flags=re.DOTALL)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, data) of a string column without nulls."""
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


COPIED = 1 << 20  # bytes copied by one set of scatter indices


def _scatter(out: np.ndarray, at: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
    """Copy segment i of ``data`` to position ``at[i]``: short segments together, ``COPIED`` bytes at a time, long ones by themselves."""
    lengths = np.diff(offsets)
    for i in np.flatnonzero(lengths > COPIED):
        out[at[i] : at[i] + lengths[i]] = data[offsets[i] : offsets[i + 1]]
    short = np.flatnonzero(lengths <= COPIED)
    ends = np.cumsum(lengths[short])
    done, k = 0, 0
    while k < len(short):
        stop = max(k + 1, int(np.searchsorted(ends, done + COPIED, side="right")))
        some = short[k:stop]
        size = lengths[some]
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(at[some], size) + within] = data[np.repeat(offsets[some], size) + within]
        done, k = int(ends[stop - 1]), stop


def _fill(out: np.ndarray, at: np.ndarray, constant: str) -> None:
    marker = np.frombuffer(constant.encode(), np.uint8)
    out[at[:, None] + np.arange(len(marker))] = marker


def assemble(rows: pa.Table) -> pa.RecordBatch:
    """Whole conversations, sorted, to one formatted value each."""
    rows = rows.combine_chunks()
    ids, role, text = (rows[c].combine_chunks() if rows[c].num_chunks != 1 else rows[c].chunk(0) for c in ("conv_id", "role", "text"))
    roles, texts = escape_role(pc.fill_null(role, "")), escape(pc.fill_null(text, ""))
    (role_at, role_data), (text_at, text_data) = _bytes(roles), _bytes(texts)
    n = len(rows)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(TURN_START), 1, len(TURN_END)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]), np.uint8)
    _fill(out, starts[:, 0], TURN_START)
    _scatter(out, starts[:, 1], role_at, role_data)
    _fill(out, starts[:, 2], "\n")
    _scatter(out, starts[:, 3], text_at, text_data)
    _fill(out, starts[:, 4], TURN_END)

    number = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    missing = pc.is_null(ids).to_numpy(zero_copy_only=False)
    new = np.r_[True, (number[1:] != number[:-1]) | (missing[1:] != missing[:-1])]
    first = np.flatnonzero(new)
    bounds = np.r_[starts[first, 0], ends[-1, -1]]
    formatted = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(out)]
    )
    loss = pc.fill_null(pc.equal(role, LOSS_ROLE), False).to_numpy(zero_copy_only=False)
    conversation = np.cumsum(new) - 1
    base = bounds[:-1][conversation]
    spans = pa.StructArray.from_arrays(
        [pa.array((starts[:, 3] - base)[loss]), pa.array((ends[:, 3] - base)[loss])], names=["start", "stop"]
    )
    per = np.bincount(conversation[loss], minlength=len(first))
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)].astype(np.int32)), spans)
    turns = np.diff(np.r_[first, n])
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(first)), formatted.cast(pa.binary()), pa.array(turns.astype(np.int64)), lists],
        names=["conv_id", "formatted", "n_turns", "loss"],
    )


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []  # rows of the conversation that may go on in the next batch
    for batch in slices(batches):
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id")
        last, k = ids[-1], batch.num_rows - 1
        while k > 0 and ids[k - 1] == last:
            k -= 1
        if k or (held and held[-1].column("conv_id")[-1] != last):
            whole = pa.Table.from_batches([*held, batch.slice(0, k)])
            held = []
            yield assemble(whole)
        held.append(batch.slice(k))
    if held:
        yield assemble(pa.Table.from_batches(held))


def format_chat(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, formatted, n_turns, loss), one row per conversation.

    ``formatted`` is UTF-8; ``loss`` lists the byte ranges of assistant texts in it, markers excluded. Turns are in the
    order of ``turn`` (nulls first), equal turns in that of role and text, repeated rows stay. Null roles and texts
    count as empty; rows without a conversation id form one conversation of their own. A conversation is one value and so has
    to fit a Spark cell (2 GB). Other columns are not read; an empty table gives an empty result.
    """
    small_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of every turn; raises if anything lies outside the turns."""
    found = list(_TURN.finditer(formatted))
    if sum(m.end() - m.start() for m in found) != len(formatted):
        raise ValueError("not a formatted conversation")
    return [(unescape_role(m[1]), unescape(m[2])) for m in found]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
            turns = parse(formatted)
            all_turns, taught = hashlib.sha256(), b"".join(unescape(formatted[s["start"] : s["stop"]]) for s in loss)
            for role, text in turns:
                all_turns.update(role + b"\n" + text + b"\n")
            rows.append(
                (conv_id, len(turns), all_turns.hexdigest(), len(taught.decode()), hashlib.sha256(taught).hexdigest(), len(formatted.decode()))
            )
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests of turns and loss text, read back from the formatted values."""
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(_digest, DIGEST)
