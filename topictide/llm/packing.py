"""Best-fit packing of tokenised documents into sequences with several capacities.

Documents are cut into pieces where they are read; what is placed is one short row per piece. Pieces are dealt at random into shards
of bounded size and every shard is packed on its own: items in order of falling length, each into the open bin that leaves the
smallest residual norm (or has the largest weighted dot product with the item) among those with room for it in every
dimension: tokens, documents and attention cost (squared length). A shard leaves less than one bin half empty, so
the loss against one global packing is below one bin per shard.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from topictide.llm.common import parts_for, released, slices, small_batches, text_of
from topictide.session import materialise

END_OF_DOCUMENT = 0
MAX_TOKENS = 2048
SHARD_PIECES = 40_000
MAX_CACHED_WORDS = 200_000  # per task, cleared when full


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteBpe:
    """Token ids as little-endian unsigned 32-bit bytes.

    Texts within Latin-1 are split into words by the tokenizer's own rule, so that each distinct word is encoded once per
    task; all others go through the tokenizer whole. Control strings in a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        chars = [chr(i) for i in range(256)]
        of = lambda kind: "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind)
        letter, number, space = of("L"), of("N"), r"\t-\r \x85\xa0"
        # the word rule of byte-level BPE, with its Unicode classes written out for Latin-1
        self.words = re.compile(
            rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
        )
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: b if b in shown else 256 + hidden.index(b) for b in range(256)}
        self.cache: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self.alphabet)
        ids = array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        self.cache[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.cache) > MAX_CACHED_WORDS:
            self.cache.clear()
        known = self.cache.get
        return b"".join([known(w) or self._word(w) for w in self.words.findall(text)])


def cut_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """(id, piece, start, length, ids): every document's tokens and the closing id 0, in pieces of at most ``max_tokens``.

    Only longer documents are cut; all their pieces are full except possibly the first. ``ids`` are unsigned 32-bit
    integers. A null text counts as empty (one piece, the closing id). Repeated rows and null ids pass; other columns are not read.
    """
    path = tokenizer_path or default_tokenizer()
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = ByteBpe(path), array("I", [END_OF_DOCUMENT]).tobytes()
        for batch in slices(batches):
            doc, piece, start, length, ids = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = bpe.encode(text) + end
                n, at = len(tokens) // 4, 0
                while at < n:
                    size = (n - at) % max_tokens or max_tokens
                    doc.append(doc_id)
                    piece.append(0 if at == 0 else piece[-1] + 1)
                    start.append(at)
                    length.append(size)
                    ids.append(tokens[4 * at : 4 * (at + size)])
                    at += size
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, batch.column(0).type), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                names=[id_col, "piece", "start", "length", "ids"],
            )

    rows = docs.select(F.col(id_col), text_of(text_col).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(released(cut), f"`{id_col}` {kind}, piece int, start long, length long, ids binary")


def vector_best_fit(
    lengths: np.ndarray,
    max_tokens: int = MAX_TOKENS,
    max_documents: int | None = None,
    max_attention: int | None = None,
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item. Items are (length, 1, length squared); a bin holds no more than its capacity in each.

    ``norm`` takes the bin that is left with the smallest weighted residual norm, ``dot`` the one whose residual has the largest
    weighted dot product with the item. Ties go to the older bin. Items of one length are placed together:
    after taking one, the bin of smallest norm stays the best for the next.
    """
    capacity = np.array([max_tokens, max_documents or max_tokens, max_attention or max_tokens**2], float)
    n = len(lengths)
    place, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    if n and (lengths.max() > max_tokens or lengths.max() ** 2 > capacity[2]):
        raise ValueError("a piece is larger than an empty sequence")
    ordered = lengths[order]
    edges = np.r_[0, np.flatnonzero(np.diff(ordered)) + 1, n]
    residual, names = np.empty((0, 3)), np.empty(0, np.int64)  # open bins
    made = 0
    w = np.asarray(weights)
    for lo, hi in zip(edges[:-1], edges[1:]):
        item = np.array([ordered[lo], 1, float(ordered[lo]) ** 2])
        while lo < hi:
            fits = np.flatnonzero((residual >= item).all(axis=1))
            if len(fits):
                left = residual[fits]
                if rule == "norm":
                    best = np.argsort((w * ((left - item) / capacity) ** 2).sum(1), kind="stable")
                    copies = (left[best] // item).min(axis=1).astype(np.int64)
                else:
                    # one copy in the best bin: its product falls with every item that it takes
                    best = np.argsort(-(w * (item / capacity) * (left / capacity)).sum(1), kind="stable")[:1]
                    copies = np.ones(1, np.int64)
                chosen = fits[best]
                upto = np.cumsum(copies)
                k = int(np.searchsorted(upto, hi - lo))
                if k < len(copies):
                    copies = copies[: k + 1].copy()
                    copies[k] -= upto[k] - min(hi - lo, upto[k])
                    chosen = chosen[: k + 1]
            else:
                per = int((capacity // item).min())
                if rule != "norm":
                    per = 1
                copies = np.full(-(-(hi - lo) // per), per, np.int64) if rule == "norm" else np.ones(1, np.int64)
                copies[-1] = (hi - lo) - per * (len(copies) - 1) if rule == "norm" else 1
                chosen = np.arange(len(residual), len(residual) + len(copies))
                residual = np.vstack([residual, np.repeat(capacity[None], len(copies), axis=0)])
                names = np.r_[names, np.arange(made, made + len(copies))]
                made += len(copies)
            total = int(copies.sum())
            members = order[lo : lo + total]
            within = np.arange(total) - np.repeat(np.cumsum(copies) - copies, copies)
            used = capacity[0] - residual[chosen, 0]
            place[members] = np.repeat(names[chosen], copies)
            offset[members] = np.repeat(used, copies) + within * item[0]
            residual[chosen] -= copies[:, None] * item
            lo += total
        room = (residual[:, 0] >= ordered[-1]) & (residual[:, 1] >= 1) & (residual[:, 2] >= float(ordered[-1]) ** 2)
        residual, names = residual[room], names[room]
    return place, offset


def pack(
    pieces: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_documents: int | None = None,
    max_attention: int | None = None,
    rule: str = "norm",
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """``pieces`` (any columns and ``length``) with ``sequence_id`` and ``offset``.

    The pieces are written once, since their number sets the number of shards. Sequence ids are unique across shards. An
    empty table gives an empty result; rows may repeat.
    """
    pieces = materialise(pieces, "pieces")
    n_shards = parts_for(pieces.count(), shard_pieces)
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        place, offset = vector_best_fit(rows["length"].to_numpy(np.int64), max_tokens, max_documents, max_attention, rule)
        return rows.drop(columns="_shard").assign(sequence_id=(key[0] << 32) + place, offset=offset)

    # dealt by row number in the written files: equal rows spread like all others
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_shards)).alias("_shard")
    return pieces.select("*", shard).groupBy("_shard").applyInPandas(pack_shard, schema)


def assemble(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, from placed pieces that still carry ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    joined = F.array_join(F.transform(parts, lambda p: p["ids"]), "")
    return placed.groupBy("sequence_id").agg(F.unhex(joined).alias("ids"))
