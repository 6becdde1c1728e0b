"""Suffix-array deduplication: remove every byte of a string of 400 bytes that starts somewhere else, too.

Equal strings of 400 bytes have the same anchor, the smallest hash of a 200-byte substring in them. Every text is therefore cut
into contexts, each all the 400-byte windows with one anchor, and only contexts whose anchor hash occurs twice go on, as digests; their
bytes stay where they are. Contexts that are equal repeat as a whole. A window reaches 100 bytes or more beyond its anchor on one side at
least, so of different contexts only those matter of which the anchor with 100 bytes to the left, or to the right, occurs in another
one too. Their bytes are fetched once for each kind and meet in shards, whose suffix array is built by induced sorting; a
window repeats if its permuted common prefix with a neighbour in suffix order reaches 400. Every window lies in one context
only, so it never matches itself.

Anchors with very many different contexts are split by the place of the anchor in the window: all windows of a narrower range of places share
a longer core, and only ranges whose core is in several contexts are split again. At width 1 the core is the window and nothing is left
to compare. Digests alone are shuffled for that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topictide.llm.bloom import only, probed
from topictide.llm.common import hash128, parts_for, slices, small_batches, text_of
from topictide.llm.suffix_array import permuted_lcp, suffix_array
from topictide.session import materialise

LENGTH = 400
GRAM = 200
SIDE = (LENGTH - GRAM) // 2  # bytes that a window reaches beyond its anchor on one side at least
WIDTHS = (26, 6, 1)  # places of the anchor that one core covers, level by level
HOT = 1000  # different contexts of one anchor beyond which it is split
SHARD = 500  # contexts of a shard
FILTER_BITS = 1 << 26  # of the filter of anchors that occur twice (8 MB); a full one only lets more contexts pass
CHUNK = 1 << 20  # bytes of a text handled at once
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 24) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _P
    x = (x ^ (x >> np.uint64(29))) * _Q
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and their inverses."""
    up, down = np.full(n, _P), np.full(n, np.uint64(pow(int(_P), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Substrings:
    """64-bit hashes of substrings of ``data``, from running sums of its bytes times rising powers."""

    def __init__(self, data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]):
        up, self.down = powers
        values = _mix(np.arange(1, 257, dtype=np.uint64))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=self.sums[1:])

    def all(self, size: int) -> np.ndarray:
        sums = self.sums[size:] - self.sums[:-size]
        return _mix(sums * self.down[: len(sums)])

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return _mix((self.sums[starts + size] - self.sums[starts]) * self.down[starts])


def contexts(
    data: np.ndarray, length: int = LENGTH, sides: bool = False, powers: tuple[np.ndarray, np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (anchor hash, anchor, first window, last window) of the runs of windows with one anchor; with ``sides`` also the
    hashes of the anchor and ``SIDE`` bytes to the left and to the right, 0 where no window of the run holds them.

    The anchor of a window is the last of the smallest (40-bit) hashes in it. Long texts go chunk by chunk; chunks overlap by a window, so
    that each window is in one chunk, and a run that is cut there is two contexts with the same anchor."""
    width = length - GRAM + 1
    powers = powers or _powers(CHUNK + length)
    for start in range(0, len(data) - length + 1, CHUNK):
        known = Substrings(data[start : start + CHUNK + length - 1], powers)
        h = known.all(GRAM)
        place = np.arange(len(h), dtype=np.uint64)
        low = (h & ~_PLACE) | (_PLACE - place)
        size = 1
        while size * 2 <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        rest = width - size
        low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
        anchor = (_PLACE - (low & _PLACE)).astype(np.int64)
        edges = np.r_[0, np.flatnonzero(np.diff(anchor)) + 1, len(anchor)]
        at = anchor[edges[:-1]]
        first, last = edges[:-1], edges[1:] - 1
        out = (h[at].view(np.int64), at + start, first + start, last + start)
        if sides:
            left, right = np.zeros((2, len(at)), np.uint64)
            here = first <= at - SIDE
            left[here] = known.at(at[here] - SIDE, GRAM + SIDE)
            here = last >= at - SIDE
            right[here] = known.at(at[here], GRAM + SIDE) ^ _P
            out += (left.view(np.int64), right.view(np.int64))
        yield out


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = _powers(CHUNK + LENGTH)
    for batch in slices(batches):
        keys, hashes, firsts = [], [], []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("data").to_pylist()):
            if len(text) >= LENGTH:
                for h, _, first, _ in contexts(np.frombuffer(text, np.uint8), powers=powers):
                    keys += [key] * len(h)
                    hashes.append(h)
                    firsts.append(first)
        none = [np.empty(0, np.int64)]
        columns = [pa.array(keys, pa.binary()), pa.array(np.concatenate(hashes or none)), pa.array(np.concatenate(firsts or none))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "first"])


def _bit_of(anchors: np.ndarray) -> np.ndarray:
    return (_mix(anchors.view(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _bits(anchors: DataFrame) -> np.ndarray:
    """The filter of the ``anchors``: one bit for each, at most ``FILTER_BITS``."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bit_of(batch.column("anchor").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.left_shift(1, at & 63))], names=["word", "bit"])

    words = anchors.select("anchor").mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toPandas()  # FILTER_BITS / 64 rows at most
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out


CONTEXT = "anchor long, cid binary, key binary, base long, size long, place long, left long, right long"


def _cid(place: int, data: bytes) -> bytes:
    return hashlib.md5(place.to_bytes(4, "little") + data).digest()


def _digests(shared: Broadcast):
    """Contexts whose anchors pass the filter, without their bytes."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, powers = shared.value, _powers(CHUNK + LENGTH)
        kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 5]
        names = [c.strip().split(" ")[0] for c in CONTEXT.split(",")]
        for batch in slices(batches):
            rows = []
            for key, data in zip(batch.column("key").to_pylist(), batch.column("data").to_pylist()):
                if len(data) < LENGTH:
                    continue
                for h, at, first, last, left, right in contexts(np.frombuffer(data, np.uint8), sides=True, powers=powers):
                    bit = _bit_of(h)
                    keep = np.flatnonzero((bits[bit >> 6] >> (bit & 63)) & 1)
                    for a, p, f, e, x, y in zip(*(c[keep].tolist() for c in (h, at, first, last, left, right))):
                        rows.append((a, _cid(p - f, data[f : e + LENGTH]), key, f, e - f + LENGTH, p - f, x or None, y or None))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return digest


PART = "anchor long, cid binary, start long, place long, bytes binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted parts of texts."""
    kinds, names = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()], ["anchor", "cid", "start", "place", "bytes"]
    for batch in slices(batches, 1 << 20):
        rows = []
        for data, parts in zip(batch.column("data").to_pylist(), batch.column("parts").to_pylist()):
            for x in parts:
                at = x["base"] + x["start"]
                rows.append((x["anchor"], x["cid"], x["start"], x["place"] - x["start"], data[at : x["base"] + x["stop"]]))
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _cores(width: int):
    """(core, anchor, cid, low): a hash of the bytes that all windows of a part share in which the anchor's place is in a range of
    ``width``; of all ranges, or of those inside the ranges ``lows`` of the level before."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 18):
            rows = []
            for anchor, cid, place, data, lows, before in zip(*(batch.column(c).to_pylist() for c in ("anchor", "cid", "place", "bytes", "lows", "before"))):
                last = len(data) - LENGTH
                for base in lows:
                    for low in range(base, base + before, width):
                        # windows that start at place - high .. place - low
                        high = min(low + width, base + before) - 1
                        if max(0, place - high) > min(last, place - low):
                            continue
                        core = data[max(place - low, 0) : place - high + LENGTH]
                        named = hashlib.blake2b(core + low.to_bytes(4, "little") + anchor.to_bytes(8, "little", signed=True), digest_size=16)
                        rows.append((named.digest(), anchor, cid, low))
            columns = list(zip(*rows)) or [()] * 4
            kinds, names = [pa.binary(), pa.int64(), pa.binary(), pa.int32()], ["core", "anchor", "cid", "low"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return find


def repeated_windows(parts: list[bytes]) -> list[np.ndarray]:
    """For each of some different contexts, the starts of its windows that another place of any of them equals."""
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    t = np.ones(int(sizes.sum()) + len(parts) + 1, np.int64)  # 1 separates contexts, the last 0 is the sentinel
    inside = np.ones(len(t), bool)
    inside[starts + sizes] = False
    inside[-1] = False
    t[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + 2
    t[-1] = 0
    sa = suffix_array(t)
    # only where windows start: what is shorter than one cannot reach its length
    windows = np.zeros(len(t) + 1, np.int64)
    np.add.at(windows, starts, 1)
    np.add.at(windows, starts + np.maximum(sizes - LENGTH + 1, 0), -1)
    phi, plcp = permuted_lcp(t, sa, int(sizes.max()) + 1, starts, np.cumsum(windows[:-1]) > 0)
    long = plcp >= LENGTH
    flag = long.copy()
    flag[phi[long]] = True
    return [np.flatnonzero(flag[s : s + max(n - LENGTH + 1, 0)]) for s, n in zip(starts, sizes)]


def spans_of(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by windows at the sorted ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > LENGTH)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + LENGTH).tolist()))


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.reset_index(drop=True)
    found = [spans_of(s) for s in repeated_windows(rows["bytes"].tolist())]
    out = [(rows["anchor"][i], rows["cid"][i], rows["start"][i] + a, rows["start"][i] + b) for i, spans in enumerate(found) for a, b in spans]
    return pd.DataFrame(out, columns=["anchor", "cid", "start", "stop"])


SPANS = "anchor long, cid binary, start long, stop long"


def _meeting(different: DataFrame) -> DataFrame:
    """(anchor, cid, key, base, start, stop, place): of contexts of which a side occurs in another one, the bytes of the windows there."""
    ends = different.select("anchor", "cid", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("end")), F.struct(F.lit(1).alias("side"), F.col("right").alias("end")))).alias("e"))
    ends = ends.select("anchor", "cid", "e.side", "e.end").where("end is not null")
    one = F.xxhash64("cid")
    shared = ends.groupBy("end").agg(F.min(one).alias("a"), F.max(one).alias("b")).where("a <> b").select("end")
    sides = only(ends, materialise(shared, "shared-ends"), "end").join(shared, "end").groupBy("anchor", "cid")
    sides = sides.agg(F.min("side").alias("low"), F.max("side").alias("high"))
    start = F.when(F.col("low") == 0, F.lit(0).cast("long")).otherwise(F.greatest(F.col("place") - SIDE, F.lit(0).cast("long")))
    stop = F.when(F.col("high") == 1, F.col("size")).otherwise(F.least("size", F.col("place") - SIDE + LENGTH))
    return different.join(sides, ["anchor", "cid"]).select("anchor", "cid", "at.key", "at.base", start.alias("start"), stop.alias("stop"), "place")


def _hot_spans(parts: DataFrame) -> DataFrame:
    """Spans of parts of very frequent anchors, from digests alone, range by range."""
    whole = LENGTH - GRAM + 1
    todo = parts.withColumn("lows", F.array(F.lit(0))).withColumn("before", F.lit(whole))
    for width in WIDTHS:
        cores = materialise(todo.mapInArrow(_cores(width), "core binary, anchor long, cid binary, low int"), "cores")
        one = F.xxhash64("cid")
        shared = cores.groupBy("core").agg(F.min(one).alias("a"), F.max(one).alias("b")).where("a <> b").select("core")
        shared = materialise(shared, "shared-cores")
        found = only(cores, shared, "core").join(shared, "core").groupBy("anchor", "cid").agg(F.collect_set("low").alias("lows"))
        todo = parts.join(materialise(found, "ranges"), ["anchor", "cid"]).withColumn("before", F.lit(width))
    # a window starts where the anchor's place is `low`; those of one context overlap
    start = F.col("start") + F.col("place") - F.array_max("lows")
    stop = F.col("start") + F.col("place") - F.array_min("lows") + LENGTH
    return todo.select("anchor", "cid", start.alias("start"), stop.alias("stop"))


def _marks(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, start, stop) of repeated ranges, from the contexts ``found`` of ``texts`` (key, data)."""
    place = F.xxhash64("key", "base")
    different = found.groupBy("anchor", "cid").agg(
        F.min(place).alias("a"), F.max(place).alias("b"), F.min(F.struct("key", "base")).alias("at"),
        *[F.max(c).alias(c) for c in ("size", "place", "left", "right")],
    )
    different = materialise(different.withColumn("copied", F.col("a") != F.col("b")).drop("a", "b"), "contexts")
    # copies of a context repeat as a whole
    whole = different.where("copied").select("anchor", "cid", F.lit(0).cast("long").alias("start"), F.col("size").alias("stop"))
    meeting = materialise(_meeting(different), "meeting")
    wanted = meeting.groupBy("key").agg(F.collect_list(F.struct("anchor", "cid", "base", "start", "stop", "place")).alias("parts"))
    parts = only(texts, meeting.select("key").distinct(), "key").join(wanted, "key").select("data", "parts").mapInArrow(_cut, PART)
    parts = materialise(parts, "parts")
    hot = meeting.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > HOT).select("anchor")
    hot = materialise(hot, "hot-anchors")
    common = only(parts, hot, "anchor").join(hot, "anchor")
    rest = parts.join(F.broadcast(hot) if hot.count() <= 100_000 else hot, "anchor", "left_anti")
    n_shards = parts_for(meeting.count(), SHARD)
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("anchor", F.lit("shard")), F.lit(n_shards)))
    # a shard is much work for few bytes: by bytes Spark would put all of them into a few tasks
    spans = rest.repartition(min(n_shards, 10_000), "shard").groupBy("shard").applyInPandas(_shard, SPANS)
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(materialise(common, "hot-parts")))
    # what is covered as a whole needs no other span
    found_spans = spans.join(different.where("copied").select("anchor", "cid"), ["anchor", "cid"], "left_anti")
    found_spans = materialise(whole.unionByName(found_spans), "spans")
    members = only(found.select("anchor", "cid", "key", "base"), found_spans, "anchor", "cid")
    joined = members.join(found_spans, ["anchor", "cid"])
    return joined.select("key", (F.col("base") + F.col("start")).alias("start"), (F.col("base") + F.col("stop")).alias("stop"))


def _remove_marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        spans_out, kept_out = [], []
        for data, marks in zip(batch.column("data").to_pylist(), batch.column("marks").to_pylist()):
            spans: list[list[int]] = []
            for m in sorted(marks or [], key=lambda m: (m["start"], m["stop"])):
                if spans and m["start"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], m["stop"])
                else:
                    spans.append([m["start"], m["stop"]])
            edges = [0, *(x for s in spans for x in s), len(data)]
            kept_out.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans_out.append([{"start": a, "stop": b} for a, b in spans])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        sizes = pa.array([len(x) for x in batch.column("data").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), sizes, pa.array(spans_out, kind), pa.array(kept_out, pa.binary())], names=["id", "n_bytes", "spans", "kept"]
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept), one row per row of ``docs``: the maximal removed byte ranges and the remaining bytes.

    Texts are UTF-8 bytes, a null text is empty, and matches stay within a text. Strings are judged on the input, so all their places go,
    also in the same text; copies of a text of 400 bytes or more are removed whole. Texts are told apart by their MD5, so repeated
    rows and null ids are rows like others. Only id and text are read; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.encode(text_of(text_col), "UTF-8").alias("data"))
    rows = rows.select("id", "data", hash128(F.col("data")).alias("key"))
    kind = rows.schema["id"].dataType.simpleString()

    copies = rows.where(F.octet_length("data") >= LENGTH).select("key", F.octet_length("data").cast("long").alias("stop"))
    copies = copies.groupBy("key", "stop").count().where("count > 1").select("key", F.lit(0).cast("long").alias("start"), "stop")

    # one row of each text: of copies, which collapse before they are shuffled, and all others
    split = probed(rows.select("key", "data"), materialise(copies, "copies"), "key")
    once = split.where("possible").groupBy("key").agg(F.first("data").alias("data"))
    texts = split.where("not possible").select("key", "data").unionByName(once)

    anchors = texts.mapInArrow(_anchors, "key binary, anchor long, first long")
    # an anchor counts if it occurs at two places, copies of a text being one place
    place = F.xxhash64("key", "first")
    twice = anchors.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("anchor")
    bits = docs.sparkSession.sparkContext.broadcast(_bits(twice))
    found = materialise(texts.mapInArrow(_digests(bits), CONTEXT), "text-contexts")
    marks = copies.unionByName(_marks(found, texts))
    marks = marks.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    marks = materialise(marks, "text-marks")

    judged = probed(rows, marks, "key")
    touched = judged.where("possible").join(marks, "key", "left").select("id", "data", "marks")
    removed = touched.mapInArrow(_remove_marked, f"id {kind}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
    clean = judged.where("not possible").select(
        "id", F.octet_length("data").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"), F.col("data").alias("kept"),
    )
    return removed.unionByName(clean).withColumnRenamed("id", id_col)
