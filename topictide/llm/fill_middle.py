"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put together anew, by displacement scatter.

The texts of a batch are one buffer of bytes. Cuts come from one scan for line feeds. A difference array holds, at the first byte
of every segment, by how much its output place moves against that of the segment before; its running sum is the
output shift of every byte, and one scatter moves them all. The way back finds the control strings in the output,
builds the same shifts from their places and gathers. Both go through the buffer window by window, so the index arrays stay
small however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topictide.llm.common import slices, small_batches, text_of

# ---- fixed values -------------------------------------------------------------------
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# ---- end of fixed values ------------------------------------------------------------
MARK = 3  # bytes of a control string
WINDOW = 1 << 20  # bytes moved at once
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")


@dataclass(frozen=True)
class FillMiddle:
    """``rate`` percent of texts are transformed, ``spm`` percent of those start with the suffix."""

    seed: int = 7
    rate: int = 100
    spm: int = 50


def _roll(digest: Column, k: int) -> Column:
    """The ``k``-th group of eight hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column without nulls; offsets start at 0."""
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], data


def _strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    n = len(offsets) - 1
    whole = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
    return whole.cast(pa.string())


def _lines(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, first, count): where lines end, the number of each text's first line, its number of lines."""
    feeds = np.concatenate(
        [np.empty(0, np.int64), *(np.flatnonzero(data[at : at + WINDOW] == 10) + at for at in range(0, len(data), WINDOW))]
    )
    open_end = np.flatnonzero((np.diff(offsets) > 0) & (data[np.maximum(offsets[1:] - 1, 0)] != 10 if len(data) else False))
    ends = np.sort(np.concatenate([feeds + 1, offsets[1:][open_end]]))
    at = np.searchsorted(ends, offsets, side="right")
    return ends, at[:-1], np.diff(at)


def _cut(first: np.ndarray, ends: np.ndarray, units: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The byte at which ``units`` lines of each text end."""
    if not len(ends):
        return begin.copy()
    return np.where(units > 0, ends[np.maximum(first + units - 1, 0)], begin)


def _layout(form: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Output places of prefix, middle and suffix (columns) of texts whose outputs start at ``out``; sizes by segment."""
    prefix, middle, suffix = sizes.T
    psm = np.stack([out + MARK, out + 3 * MARK + prefix + suffix, out + 2 * MARK + prefix], axis=1)
    spm = np.stack([out + 2 * MARK + suffix, out + 3 * MARK + suffix + prefix, out + MARK], axis=1)
    plain = np.stack([out, out + prefix, out + prefix + middle], axis=1)
    return np.where((form == PSM)[:, None], psm, np.where((form == SPM)[:, None], spm, plain))


def _events(starts: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The difference array as (byte, change of the shift): one event for every segment that is not empty."""
    full = sizes.ravel() > 0
    at = starts.ravel()[full]
    shift = places.ravel()[full] - at
    return at, np.diff(shift, prepend=0)


def _shifted(n: int, at: np.ndarray, change: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, stop, output place of each byte) window by window."""
    carry, edges = 0, np.searchsorted(at, np.arange(0, n + WINDOW, WINDOW))
    for k, start in enumerate(range(0, n, WINDOW)):
        stop = min(start + WINDOW, n)
        moved = np.zeros(stop - start, np.int64)
        lo, hi = edges[k], edges[k + 1]
        moved[at[lo:hi] - start] = change[lo:hi]
        moved[0] += carry
        np.cumsum(moved, out=moved)
        carry = int(moved[-1])
        moved += np.arange(start, stop)
        yield start, stop, moved


def _mark(out: np.ndarray, at: np.ndarray, mark: str) -> None:
    out[at[:, None] + np.arange(MARK)] = np.frombuffer(mark.encode(), np.uint8)


def _code_points(data: np.ndarray, start: int, stop: int) -> int:
    return sum(int(np.count_nonzero((data[a : min(a + WINDOW, stop)] & 0xC0) != 0x80)) for a in range(start, stop, WINDOW))


def scatter(offsets: np.ndarray, data: np.ndarray, form: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
    """Outputs of a batch of texts cut at the bytes ``low`` and ``high``: (offsets, bytes)."""
    begin, end = offsets[:-1], offsets[1:]
    sizes = np.stack([low - begin, high - low, end - high], axis=1)
    starts = np.stack([begin, low, high], axis=1)
    marked = form != PLAIN
    bounds = np.r_[0, np.cumsum(end - begin + np.where(marked, 3 * MARK, 0))].astype(np.int64)
    places = _layout(form, sizes, bounds[:-1])
    out = np.empty(int(bounds[-1]), np.uint8)
    for mark, segment in ((PREFIX, 0), (MIDDLE, 1), (SUFFIX, 2)):
        _mark(out, places[marked, segment] - MARK, mark)
    at, change = _events(starts, sizes, places)
    for start, stop, place in _shifted(len(data), at, change):
        out[place] = data[start:stop]
    return bounds, out


def _find_marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte, letter) of every control string, in order."""
    found = []
    for at in range(0, max(len(data) - MARK + 1, 0), WINDOW):
        x = data[at : at + WINDOW + MARK - 1]
        letter = x[1:-1]
        known = (letter == ord("P")) | (letter == ord("S")) | (letter == ord("M"))
        found.append(np.flatnonzero((x[:-2] == ord("<")) & (x[2:] == ord(">")) & known) + at)
    where = np.concatenate([np.empty(0, np.int64), *found])
    return where, data[where + 1]


def gather(offsets: np.ndarray, data: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a batch of outputs, read from output and form alone: (offsets, bytes)."""
    begin, end = offsets[:-1], offsets[1:]
    marked = np.flatnonzero(form != PLAIN)
    where, letter = _find_marks(data)
    # control strings inside plain texts, or across two outputs, are ordinary text
    owner = np.searchsorted(offsets, where, side="right") - 1
    inside = (form[owner] != PLAIN) & (where + MARK <= end[owner]) if len(where) else np.zeros(0, bool)
    where, letter, owner = where[inside], letter[inside], owner[inside]
    if not np.array_equal(owner, np.repeat(marked, 3)):
        raise ValueError("an output does not hold its three control strings")
    places = np.stack([begin, end, end], axis=1)  # a plain text is all prefix
    sizes = np.stack([end - begin, np.zeros_like(begin), np.zeros_like(begin)], axis=1)
    if len(marked):
        at, letters = where.reshape(-1, 3), letter.reshape(-1, 3)
        stops = np.c_[at[:, 1:], end[marked]]
        for segment, name in enumerate("PMS"):
            column = np.argmax(letters == ord(name), axis=1)
            rows = np.arange(len(marked))
            places[marked, segment] = at[rows, column] + MARK
            sizes[marked, segment] = stops[rows, column] - places[marked, segment]
    bounds = np.r_[0, np.cumsum(sizes.sum(axis=1))].astype(np.int64)
    starts = bounds[:-1, None] + np.c_[np.zeros(len(begin), np.int64), np.cumsum(sizes[:, :2], axis=1)]
    out = np.empty(int(bounds[-1]), np.uint8)
    for start, stop, place in _shifted(len(out), *_events(starts, sizes, places)):
        out[start:stop] = data[place]
    return bounds, out


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        offsets, data = _buffer(batch.column("text"))
        form = batch.column("form").to_numpy()
        ends, first, lines = _lines(offsets, data)
        begin = offsets[:-1]
        one, two = (batch.column(c).to_numpy() % (lines + 1) for c in ("h1", "h2"))
        low = _cut(first, ends, np.minimum(one, two), begin)
        high = _cut(first, ends, np.maximum(one, two), begin)
        bounds, out = scatter(offsets, data, form, low, high)
        chars = [
            (_code_points(data, a, b), _code_points(data, b, c)) if f else (None, None)
            for f, a, b, c in zip(form.tolist(), begin.tolist(), low.tolist(), high.tolist())
        ]
        prefix, middle = zip(*chars) if chars else ((), ())
        names = pa.array(FORMS).take(pa.array(form))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(lines.astype(np.int64)), names, pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), _strings(bounds, out)],
            names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        offsets, data = _buffer(batch.column("output"))
        names = batch.column("form").to_pylist()
        form = np.array([FORMS.index(x) for x in names], np.int64)
        columns = [*batch.columns, _strings(*gather(offsets, data, form))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "restored"])


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: FillMiddle = FillMiddle()) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output), one row per row of ``docs``.

    A text is cut into ``n`` lines; the draws follow from the seed and the id, so rows that repeat an id are cut by the same
    draws. Form is plain if the text is empty (or null) or contains a control string, else as drawn; plain texts are their own
    output and have no segment lengths. A null id draws like an empty one. Only id and text are read; an empty table
    gives an empty result. A text and its output have to fit a Spark cell (2 GB).
    """
    small_batches(docs.sparkSession)
    text = text_of(text_col)
    named = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.sha2(named, 256).alias("digest"))
    occupied = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | occupied | (_roll(F.col("digest"), 2) % 100 >= settings.rate)
    form = F.when(plain, PLAIN).when(_roll(F.col("digest"), 3) % 100 < settings.spm, SPM).otherwise(PSM)
    rows = rows.select(
        "id", "text", form.cast("long").alias("form"), _roll(F.col("digest"), 0).alias("h1"), _roll(F.col("digest"), 1).alias("h2")
    )
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(_transform, schema).withColumnRenamed("id", id_col)


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` with the column ``restored``: the texts, rebuilt from ``output`` and ``form``.

    Other columns pass through. Raises if an output that is not plain does not hold each control string once."""
    small_batches(outputs.sparkSession)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema)
    return outputs.mapInArrow(_restore, f"{columns}, restored string")
