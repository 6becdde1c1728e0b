"""Near duplicates by a chosen-path join on word shingles.

Every distinct shingle set gets a minwise sketch. In every run a set follows randomly chosen sketch tokens down a tree: at each level it
enters the branches of the tokens whose hash, salted with the path so far, falls below a threshold, so that similar
sets stay together and others part. Buckets that are still large are split again; what is left is compared by sketch, large
buckets block by block. Runs are repeated until a pair at the threshold is expected to meet with the target recall; sets that were
in a bucket too large for the first depth get the further runs that a pair needs to meet again on every level of the splits.

What meets and looks similar forms candidate groups. Inside each the exact Jaccard similarity of all pairs is taken from the whole
shingle sets, by matrix products over shared shingles, and only sums leave a block: the links of each set and a spanning forest.
No pair is ever emitted, equal sets are compared once, and a large group is dealt to tasks as pairs of blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topictide.llm.bloom import join_counted, keep_rows, only, probed
from topictide.llm.common import ascii_lower, hash128, released, slices, small_batches, text_of
from topictide.operators.components import connected_components
from topictide.session import materialise

WORDS_PER_SHINGLE = 5
THRESHOLD = 0.8
SKETCH = 64  # minwise values of a set
BUCKET = 400  # larger buckets are split again ...
FIRST_DEPTH = 2  # levels before buckets are looked at
MAX_DEPTH = 4  # ... down to this depth and compared in blocks beyond it
SKETCH_BLOCK = 2048  # rows of a block of sketches; few blocks mean few roots, hence few edges
BLOCK = 400  # rows of a block of whole sets
HASHES = 1 << 20  # shingles compared at once
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _P
    x = (x ^ (x >> np.uint64(29))) * _Q
    return x ^ (x >> np.uint64(32))


def shingles(text: str, width: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``width`` words; of all words together if there are fewer.

    Words are separated by ASCII white space; letters count without case."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    # a word's hash: the sum of its mixed (byte, place in the word) values
    lengths = stop - start
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = _mix((data[inside].astype(np.uint64) << np.uint64(32)) | place.astype(np.uint64))
    words = _mix(np.add.reduceat(values, np.cumsum(lengths) - lengths))
    width = min(width, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        h = _mix(h) ^ words[k : k + len(h)]
    return np.unique(_mix(h))


def _seeds(salt: int, n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * _Q + np.uint64(salt))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Minwise values (32 bits) of a non-empty set."""
    add, multiply = _seeds(1, SKETCH)[:, None], _seeds(2, SKETCH)[:, None] | np.uint64(1)
    low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        x = hashes[at : at + 1024]
        low = np.minimum(low, ((x ^ add) * multiply).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32)


def _choice(threshold: float) -> float:
    """Probability that a path follows a token."""
    return min(1.0, 1 / (threshold * SKETCH))


def _agreeing(threshold: float) -> list[float]:
    """Probabilities that the sketches of a pair at the threshold agree in 0, 1, ... places."""
    return [math.comb(SKETCH, k) * threshold**k * (1 - threshold) ** (SKETCH - k) for k in range(SKETCH + 1)]


def least_agreeing(recall: float, threshold: float) -> int:
    """Places in which sketches must agree to make a candidate: pairs at the threshold stay below it with at most a tenth of the
    probability with which ``recall`` lets them be lost. No number of runs brings these back."""
    shares = _agreeing(threshold)
    least = 0
    while sum(shares[: least + 1]) <= (1 - recall) / 10:
        least += 1
    return least


def runs_needed(recall: float, threshold: float, depth: int = FIRST_DEPTH, least: int = 0) -> int:
    """Runs after which a pair at the threshold has met in a bucket of ``depth``, with sketches that agree in ``least`` places
    or more, with probability ``recall``.

    Both follow a token that they share with probability ``_choice``, on each level anew; how many they share is the same in
    every run, so the runs that miss are averaged over it."""
    shares = _agreeing(threshold)
    if 1 - recall <= sum(shares[: max(1, least)]):
        raise ValueError(f"sketches of {SKETCH} values cannot give a recall of {recall} at a threshold of {threshold}")
    apart = []
    for k in range(SKETCH + 1):
        meet = 1.0
        for _ in range(depth):
            meet = 1 - (1 - _choice(threshold) * meet) ** k
        apart.append(1 - meet if k >= least else 1.0)
    runs = 1
    while sum(share * a**runs for share, a in zip(shares, apart)) > 1 - recall:
        runs += 1
    return runs


def _tokens(sketches: np.ndarray) -> np.ndarray:
    """Tokens of sketches: coordinate and value in one number."""
    return _mix((np.arange(SKETCH, dtype=np.uint64) << np.uint64(32)) | sketches.astype(np.uint64))


def _step(paths: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, new path) of every token that row ``i``, on ``paths[i]``, follows."""
    h = _mix(tokens ^ _mix(paths)[:, None])
    limit = np.uint64(_choice(threshold) * 2.0**64 * (1 - 2**-53))
    row, token = np.nonzero(h < limit)
    return row, _mix(h[row, token] + _P)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Root (smallest member) of each of n nodes under the edges (i, j), by min-label propagation with pointer jumping."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _similar_forest(m: np.ndarray, left: np.ndarray, right: np.ndarray, least: float, root: np.ndarray) -> np.ndarray:
    """Roots of the sketches ``m``, so far ``root``, when those of ``left`` are joined with similar ones of ``right``.

    A few rows at a time, and only pairs that are still apart are looked at: nothing grows with the pairs."""
    for at in range(0, len(left), 64):
        rows = left[at : at + 64]
        i, j = np.nonzero((m[rows][:, None, :] == m[right][None]).mean(axis=2) >= least)
        u, v = root[rows[i]], root[right[j]]
        apart = u != v
        if apart.any():
            root = _forest(u[apart], v[apart], len(m))[root]
    return root


def _pairs_of_blocks(df: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """Each row once for every pair (a, b) of its group's blocks that its ``own`` block belongs to."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit("block")), blocks).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(o, F.col("own")).alias("a"), F.greatest(o, F.col("own")).alias("b")),
    )
    dealt = df.withColumn("blocks", blocks).withColumn("own", own).withColumn("pair", F.explode(pairs))
    return dealt.select("*", F.col("pair.a").alias("a"), F.col("pair.b").alias("b")).drop("pair", "blocks")


def _deal(df: DataFrame, group: str, size: str, block: int, small_tasks: int) -> DataFrame:
    """Column ``task``: a group of up to ``block`` rows is one block and shares a task with other small groups; a larger one
    becomes a task for every pair of its blocks."""
    dealt = _pairs_of_blocks(df, group, size, block)
    small = F.col(size) <= block
    task = F.when(small, F.pmod(F.xxhash64(group), F.lit(small_tasks)).cast("string")).otherwise(
        F.concat_ws("/", F.hex(group), "a", "b")
    )
    return dealt.withColumn("task", task)


def _sketch_forest(least: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in rows.groupby("path", sort=False):
            g = g.drop_duplicates("key")
            labels = g["label"].to_numpy()
            names, first, name = np.unique(labels, return_index=True, return_inverse=True)
            if len(names) < 2:
                continue
            m = np.frombuffer(b"".join(g["sketch"]), np.uint32).reshape(len(g), SKETCH)
            a, b = g["a"].iloc[0], g["b"].iloc[0]
            if a == b:
                left = right = np.arange(len(g))
            else:
                left, right = np.flatnonzero(g["own"] == a), np.flatnonzero(g["own"] == b)
            root = _similar_forest(m, left, right, least, first[name])
            moved = np.flatnonzero(root[first] != first)  # one edge for a label that was joined to another
            out.append(pd.DataFrame({"u": labels[root[first[moved]]], "v": names[moved]}))
        return pd.concat(out) if out else pd.DataFrame({"u": [], "v": []}, dtype="int64")

    return compare


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all pairs left x right with a Jaccard similarity of at least ``threshold``, from whole sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    inter = np.zeros((len(left), len(right)), np.float32)
    # by ranges of hashes, so that memory is bounded however long the texts are
    parts = int(sizes.sum()) // HASHES + 1
    bounds = [np.uint64(k * ((1 << 64) // parts)) for k in range(1, parts)]
    cuts = [np.r_[0, np.searchsorted(s, bounds), len(s)].astype(int) for s in sets] if bounds else [(0, len(s)) for s in sets]
    for p in range(parts):
        some = [s[c[p] : c[p + 1]] for s, c in zip(sets, cuts)]
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in some])
        _, column, times = np.unique(np.concatenate(some), return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1  # only shingles of two sets or more can meet
        keep = times[column] > 1
        owner, column = owner[keep], shared[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        width = int(column[-1]) + 1 if len(column) else 0
        for at in range(0, width, 4096):
            lo, hi = np.searchsorted(column, [at, at + 4096])
            m = np.zeros((len(sets), min(4096, width - at)), np.float32)
            m[owner[lo:hi], column[lo:hi] - at] = 1
            inter += m[left] @ m[right].T
    union = sizes[left][:, None] + sizes[right][None] - inter
    # compared without rounding: counts are exact in float64
    i, j = np.nonzero(inter.astype(np.float64) >= threshold * union - 1e-9)
    return left[i], right[j]


def _exact_links(threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in rows.groupby("component", sort=False):
            g = g.drop_duplicates("key")
            sets = [np.frombuffer(x, np.uint64) for x in g["hashes"]]
            a, b = g["a"].iloc[0], g["b"].iloc[0]
            everyone = np.arange(len(g))
            if a == b:
                i, j = _links(sets, everyone, everyone, threshold)
                i, j = i[i != j], j[i != j]
                from_i, to_j = i, j
            else:
                i, j = _links(sets, np.flatnonzero(g["own"] == a), np.flatnonzero(g["own"] == b), threshold)
                from_i, to_j = np.r_[i, j], np.r_[j, i]
            links = np.bincount(from_i, weights=g["copies"].to_numpy(float)[to_j], minlength=len(g)).astype(np.int64)
            keys = g["key"].to_numpy()
            out.append(pd.DataFrame({"key": keys, "root": keys[_forest(i, j, len(g))], "links": links}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "root": [], "links": []}, dtype=object)

    return compare


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        keys, sketches = [], []
        for text in batch.column("text").to_pylist():
            s = shingles(text)
            keys.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
            sketches.append(sketch(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("text_key"), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary())],
            names=["id", "text_key", "key", "sketch"],
        )


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = pa.array([shingles(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
        kept = [batch.column(c) for c in ("key", "component", "size", "copies")]
        yield pa.RecordBatch.from_arrays([*kept, found], names=["key", "component", "size", "copies", "hashes"])


def _paths(sketches: pa.Array, starts: np.ndarray, threshold: float, large: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of ``starts`` (row, path) at the first depth, and below it for as many levels as ``large`` has sorted arrays of the
    paths that are followed further."""
    tokens = _tokens(np.frombuffer(b"".join(sketches.to_pylist()), np.uint32).reshape(-1, SKETCH))
    for start in starts:
        row, path = np.arange(len(tokens)), np.full(len(tokens), start)
        for level in range(FIRST_DEPTH + len(large)):
            if level >= FIRST_DEPTH:
                row, path = _on(row, path, large[level - FIRST_DEPTH])
            again, path = _step(path, tokens[row], threshold)
            row = row[again]
        yield row, path


def _on(row: np.ndarray, path: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those (row, path) whose path is one of the sorted ``large``."""
    here = large[np.minimum(np.searchsorted(large, path), len(large) - 1)] == path
    return row[here], path[here]


def _descend(sets: DataFrame, labelled: DataFrame, starts: np.ndarray, threshold: float, least: float) -> tuple[DataFrame | None, DataFrame | None]:
    """One run from each of ``starts`` over ``sets`` (key, sketch), ``labelled`` (key, sketch, label) being the same: the edges (u, v) found
    between different labels, and the keys of sets in buckets that were split. A bucket of one label has nothing to tell and ends there.

    A bucket that is split is known by its path alone, of which the driver gets one for ``BUCKET`` rows at most. Its sets go on from
    where their sketches are; only those of buckets that are compared are joined."""
    context = sets.sparkSession.sparkContext

    def levels(large: list[np.ndarray]):
        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 1 << 20):
                for row, path in _paths(batch.column("sketch"), starts, threshold, large):
                    row = pa.array(row)
                    columns = [pa.array(path.view(np.int64)), batch.column("key").take(row), batch.column("label").take(row)]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "key", "label"])

        return descend

    def inside(large: np.ndarray):
        def crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 1 << 20):
                kept = np.zeros(batch.num_rows, bool)
                for row, path in _paths(batch.column("sketch"), starts, threshold, []):
                    kept[_on(row, path, large)[0]] = True
                yield batch.filter(pa.array(kept))

        return crowded

    small_tasks = 64 * max(1, context.defaultParallelism)
    edges, crowd, large = None, None, []
    labelled = labelled.select("key", "sketch", "label")
    for depth in range(FIRST_DEPTH, MAX_DEPTH + 1):
        rows = labelled if crowd is None else crowd
        level = materialise(rows.mapInArrow(levels(large), "path long, key binary, label long"), "paths")
        counts = level.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
        counts = materialise(counts.where("low <> high").select("path", "size"), "buckets")
        done = counts if depth == MAX_DEPTH else counts.where(F.col("size") <= BUCKET)
        n_done = done.count()
        if n_done:
            hit = materialise(join_counted(level, done, "path", n_done), "hits")
            met = join_counted(sets.select("key", "sketch"), hit, "key")
            dealt = _deal(met, "path", "size", SKETCH_BLOCK, small_tasks)
            found = dealt.groupBy("task").applyInPandas(_sketch_forest(least), "u long, v long").distinct()
            edges = found if edges is None else edges.unionByName(found)
        if depth == MAX_DEPTH:
            break
        split = counts.where(F.col("size") > BUCKET).select("path").toPandas()["path"].to_numpy(np.int64)
        if not len(split):
            break
        large = [*large, np.sort(split.view(np.uint64))]
        if crowd is None:
            crowd = materialise(labelled.mapInArrow(inside(large[0]), "key binary, sketch binary, label long"), "crowd")
    return edges, None if crowd is None else crowd.select("key")


def _with_labels(sets: DataFrame, moved: DataFrame | None) -> DataFrame:
    """Sets (key, sketch) with ``label``: a hash of the key, or where ``moved`` (node, component) has it, its component."""
    named = sets.select("key", "sketch", F.xxhash64("key").alias("node"))
    if moved is None:
        return named.withColumnRenamed("node", "label")
    split = probed(named, moved, "node")
    found = split.where("possible").join(moved, "node", "left")
    still = split.where("not possible").select("key", "sketch", F.col("node").alias("label"))
    return found.select("key", "sketch", F.coalesce("component", "node").alias("label")).unionByName(still)


def _contracted(sets: DataFrame, starts: np.ndarray, threshold: float, least: float, moved: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Labels (node, component) after runs from ``starts`` and before (``moved``), and the keys of sets in buckets that were split.

    What runs join gets one label, and later runs look only for edges between labels."""
    edges, split = _descend(sets, _with_labels(sets, moved), starts, threshold, least)
    if edges is None:
        return moved, split
    merged = connected_components(edges)
    if moved is not None:
        # labels joined now take their members along
        renamed = moved.join(merged.withColumnRenamed("component", "newer"), moved["component"] == merged["node"], "left").select(
            moved["node"], F.coalesce("newer", moved["component"]).alias("component")
        )
        merged = renamed.unionByName(merged).dropDuplicates(["node"])
    return materialise(merged, "moved"), split


def candidate_groups(sets: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(key, component) of the sets (key, sketch) that met in a bucket with similar sketches, directly or through others.

    A pair is lost if it never meets at the first depth in the first runs, or if its buckets there were split and it never meets
    at the last depth in all runs: half of what the recall allows goes to either, pairs whose sketches agree too little included.
    Only sets of split buckets need the further runs. Components are 64-bit numbers; should two fall on one number, their
    sets are compared with each other for nothing."""
    half, agreeing = (1 + recall) / 2, least_agreeing(recall, threshold)
    first = runs_needed(half, threshold, least=agreeing)
    starts = _seeds(3, max(first, runs_needed(half, threshold, MAX_DEPTH, agreeing)))
    least = agreeing / SKETCH
    # after the first few runs nearly all near copies have one label
    moved, split, at = None, None, 0
    for size in (1, 1, 3, first):
        some = starts[at : min(at + size, first)]
        at += len(some)
        if len(some):
            moved, more = _contracted(sets, some, threshold, least, moved)
            if more is not None:
                split = more if split is None else split.unionByName(more)
    if len(starts) > first and split is not None:
        split = materialise(split.distinct(), "split")
        if not split.isEmpty():
            crowded = materialise(sets.select("key", "sketch").join(split, "key", "left_semi"), "crowded")
            moved, _ = _contracted(crowded, starts[first:], threshold, least, moved)
    if moved is None:
        return sets.select("key", F.lit(0).cast("long").alias("component")).limit(0)
    named = sets.select("key", F.xxhash64("key").alias("node"))
    return only(named, moved, "node").join(moved, "node").select("key", "component")


def candidate_edges(sets: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(u, v): the candidate groups as stars, one edge for every set but the first of a group."""
    groups = materialise(candidate_groups(sets, threshold, recall), "groups")
    first = groups.groupBy("component").agg(F.min("key").alias("u"))
    return groups.join(first, "component").where("u <> key").select("u", F.col("key").alias("v"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = 0.999,
) -> DataFrame:
    """(id, text_key, class_id, n_links, class_size, kept), one row per row of ``docs``.

    Two documents are linked if their sets of five-word shingles have a Jaccard similarity of ``threshold`` or more; classes are
    connected components, named by their smallest id (null if none has one). ``n_links`` counts the linked rows, copies
    included. Links are exact where found; a pair is found with probability ``recall`` or more. ``kept`` marks the
    smallest (id, text hash) of each class, nulls last; rows that repeat both are all marked. Fewer than five words make
    one shingle; a text without a word (or null) is a class of its own with no link. ``text_key`` is the MD5 of the text
    with A-Z in lower case. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), ascii_lower(text_of(text_col)).alias("text"))
    rows = rows.select("id", "text", hash128(F.col("text")).alias("text_key"))
    kind = rows.schema["id"].dataType.simpleString()
    known = rows.mapInArrow(released(_sketched), f"id {kind}, text_key binary, key binary, sketch binary")
    known = materialise(known, "sketched")
    sets = known.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("text_key").alias("text_key"), F.first("sketch").alias("sketch")
    )
    sets = materialise(sets, "sets")
    groups = materialise(candidate_groups(sets, threshold, recall), "candidates")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    wanted = materialise(
        groups.join(sizes, "component").join(sets.select("key", "copies", "text_key"), "key"), "members"
    )
    # one text for each member; copies collapse before the shuffle
    texts = rows.groupBy("text_key").agg(F.first("text").alias("text"))
    full = texts.join(wanted, "text_key").select("key", "component", "size", "copies", "text")
    full = full.mapInArrow(released(_hashes), "key binary, component long, size long, copies long, hashes binary")
    small_tasks = 64 * max(1, spark.sparkContext.defaultParallelism)
    dealt = _deal(full, "component", "size", BLOCK, small_tasks)
    found = dealt.groupBy("task").applyInPandas(_exact_links(threshold), "key binary, root binary, links long")
    found = materialise(found, "links")
    joined = found.where("root <> key").select(F.col("root").alias("u"), F.col("key").alias("v"))
    classes = connected_components(joined).select(F.col("node").alias("key"), "component")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    per_set = sets.select("key", "copies").join(links, "key", "left").join(classes, "key", "left")
    per_set = materialise(
        per_set.select(
            "key",
            F.coalesce("component", "key").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "per-set",
    )
    lean = known.select("id", "text_key", "key")
    firsts = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("first")
    members = lean.where("key is not null").join(per_set, "key")
    named = members.groupBy("component").agg(firsts, F.count(F.lit(1)).alias("class_size"))
    decided = per_set.join(named, "component").drop("component")
    linked = lean.where("key is not null").join(decided, "key").select(
        "id", "text_key", F.col("first.id").alias("class_id"), "n_links", "class_size",
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key"))).alias("kept"),
    )
    alone = lean.where("key is null").select(
        "id", "text_key", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"),
    )
    return linked.unionByName(alone)


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = 0.999
) -> DataFrame:
    """One row of ``docs`` of every class of near duplicates, with all its columns."""
    judged = near_duplicates(docs, id_col, text_col, threshold, recall)
    keys = {"_id": F.col(id_col), "_key": hash128(ascii_lower(text_of(text_col)))}
    return keep_rows(docs, keys, judged.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "kept"))
