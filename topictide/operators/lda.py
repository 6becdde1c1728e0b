"""LDA topics, per slice or over the whole corpus."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topictide.operators import keywords as K
from topictide.operators import variational
from topictide.session import materialise

TOP_WORDS = 10


@dataclass(frozen=True)
class LdaSettings:
    """Full-batch variational Bayes with symmetric 1/k priors."""

    n_topics: int = 10
    max_features: int = 1000
    seed: int = 42
    max_iter: int = 10


# Numbers in a model that is fitted at once (a third of a gigabyte as broadcast, sums and new model); more slices go in groups.
MODEL_NUMBERS = 1 << 23


def _by_join(bag: DataFrame, vocab: DataFrame, placed: DataFrame, s: LdaSettings) -> DataFrame:
    """``_numbered`` for vocabularies too large to be known to every task."""
    keyed = materialise(bag.join(F.broadcast(placed), "slice").withColumn("row", F.monotonically_increasing_id()), "placed-bags")
    found = K.exploded(keyed, "slice", "row", "base").join(K.bounded(vocab, bag, s.max_features), ["slice", "term"])
    entry = F.struct((F.col("term_id") + F.col("base")).alias("id"), F.col("tf").cast("double").alias("tf"))
    terms = found.groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("t"))
    rows, none = keyed.select("slice", "doc_id", "slice_no", "row").join(terms, "row", "left"), F.array()
    return rows.select(
        "slice", "doc_id", "slice_no",
        F.coalesce(F.transform("t", lambda t: t["id"]), none.cast("array<int>")).alias("rows"),
        F.coalesce(F.transform("t", lambda t: t["tf"]), none.cast("array<double>")).alias("counts"),
    )


def _words(vocab: DataFrame) -> dict[int, list[str]]:
    """The words of every slice (in microseconds), in the order of their numbers."""
    rows = vocab.select(F.unix_micros("slice").alias("at"), "term_id", "term").toPandas().sort_values(["at", "term_id"])
    return {int(at): own["term"].tolist() for at, own in rows.groupby("at")}


def _numbered(bag: DataFrame, known: dict[int, tuple[int, int, list[str]]], at: Column | None = None) -> DataFrame:
    """(slice, doc_id, slice_no, rows, counts): the documents of ``bag``, numbered where they are. ``known`` has by slice (in microseconds)
    its number, the row of its first word and its words; ``at`` is taken for the slice of all documents."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = {at: pa.array(words, pa.string()) for at, (_, _, words) in known.items()}
        for batch in batches:
            ats = batch.column("at").to_numpy()
            for at in np.unique(ats).tolist():
                own = batch if len(known) == 1 else batch.filter(pa.array(ats == at))
                slice_no, base, _ = known[at]
                terms = own.column("terms")
                sizes = pc.list_value_length(terms).fill_null(0).to_numpy()
                flat = terms.flatten()
                places = pc.index_in(pc.struct_field(flat, "term").cast(pa.string()), value_set=vocabularies[at])
                found = pc.is_valid(places)
                held = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[found.to_numpy(zero_copy_only=False)], minlength=len(sizes))
                offsets = pa.array(np.r_[0, np.cumsum(held)].astype(np.int32))
                rows = pa.ListArray.from_arrays(offsets, pc.add(places.filter(found), pa.scalar(base, pa.int32())))
                counts = pa.ListArray.from_arrays(offsets, pc.struct_field(flat, "tf").filter(found).cast(pa.float64()))
                numbers = pa.array(np.full(len(sizes), slice_no, np.int32))
                yield pa.RecordBatch.from_arrays([own.column("slice"), own.column("doc_id"), numbers, rows, counts], names=["slice", "doc_id", "slice_no", "rows", "counts"])

    kinds = ", ".join(f"{c} {bag.schema[c].dataType.simpleString()}" for c in ("slice", "doc_id"))
    at = F.unix_micros("slice") if at is None else at
    return bag.select("slice", "doc_id", "terms", at.alias("at")).mapInArrow(number, f"{kinds}, slice_no int, rows array<int>, counts array<double>")


def _groups(sizes: dict[datetime, int], k: int) -> list[list[datetime]]:
    """Slices dealt so that a group's models have at most ``MODEL_NUMBERS`` numbers (one slice at least)."""
    out: list[list[datetime]] = []
    held = 0
    for start in sorted(sizes):
        if not out or held + sizes[start] * k > MODEL_NUMBERS:
            out.append([])
            held = 0
        out[-1].append(start)
        held += sizes[start] * k
    return out


@dataclass(frozen=True)
class LdaFit:
    topics: DataFrame  # slice, topic, rank, term, score
    mixtures: DataFrame  # slice, doc_id, mixture
    bounds: DataFrame  # slice, iteration, bound
    weights: DataFrame  # slice, term, weights array<double>: Dirichlet weights of the term in each topic


def fit_timesliced(
    docs: DataFrame, settings: LdaSettings = LdaSettings(), stopwords: Iterable[str] | None = None
) -> LdaFit:
    """The models of all slices.

    Every slice has its own vocabulary and model, and all of them are fitted together: an iteration is one aggregation over
    the documents of all slices. ``bound`` is the variational bound on the log likelihood of the slice before that iteration. A document
    without a vocabulary term has shares of zero; a slice without any term has neither topics nor mixtures. Models depend on the seed, the slice
    and its documents, not on the partitioning (up to the last digits of sums) or on other slices.
    """
    spark = docs.sparkSession
    s, k = settings, settings.n_topics
    prior = 1.0 / k
    # read by the vocabularies and by the numbering
    bag = materialise(K.bags(docs, stopwords).select("slice", "doc_id", "terms"), "bags")
    vocab = materialise(K.numbered_vocabulary(bag, s.max_features).select("slice", "term", "term_id"), "vocabulary")
    # one row per slice: calendar bound
    sizes = {r["slice"]: r["n"] for r in vocab.groupBy("slice").agg(F.count("*").alias("n")).collect()}
    stamps = {r["slice"]: r["s"] for r in vocab.select("slice", F.unix_timestamp("slice").alias("s")).distinct().collect()}
    words = _words(vocab) if sum(sizes.values()) <= K.BROADCAST_ROWS else None
    micros = {r["slice"]: r["at"] for r in vocab.select("slice", F.unix_micros("slice").alias("at")).distinct().collect()}
    topics, shares, bounds, weights = [], [], [], []
    for group in _groups(sizes, k):
        numbers = {start: i for i, start in enumerate(group)}
        model = variational.start_model([sizes[g] for g in group], [stamps[g] for g in group], k, s.seed)
        placed = spark.createDataFrame([(g, i, int(model.bounds[i])) for g, i in numbers.items()], "slice timestamp, slice_no int, base int")
        if words is None:
            own = _by_join(bag, vocab, placed, s)
        else:
            known = {micros[g]: (i, int(model.bounds[i]), words[micros[g]]) for g, i in numbers.items()}
            own = _numbered(bag.join(F.broadcast(placed.select("slice")), "slice"), known)
        own = materialise(own, "lda-rows")
        full = own.where(F.size("rows") > 0)
        for i in range(s.max_iter):
            model, bound = variational.iterate(full, model, prior, prior)
            bounds += [(g, i, float(bound[n])) for g, n in numbers.items()]
        for start, part in zip(group, model.parts()):
            weights += [(start, t, row) for t, row in enumerate(part.tolist())]
            part = part / part.sum(axis=0)
            for topic in range(k):
                best = np.lexsort((np.arange(len(part)), -part[:, topic]))[:TOP_WORDS]
                topics += [(start, topic, r + 1, int(t), float(part[t, topic])) for r, t in enumerate(best)]
        shares.append(materialise(variational.mixtures(own, model, prior, ["slice", "doc_id"]), "mixtures"))
    ranked = spark.createDataFrame(topics, "slice timestamp, topic int, rank int, term_id int, score double")
    ranked = ranked.join(K.bounded(vocab, vocab, s.max_features), ["slice", "term_id"]).select("slice", "topic", "rank", "term", "score")
    mixed = bag.select("slice", "doc_id", F.lit(None).cast("array<double>").alias("mixture")).limit(0)
    for part in shares:
        mixed = mixed.unionByName(part)
    named = spark.createDataFrame(weights, "slice timestamp, term_id int, weights array<double>").join(vocab, ["slice", "term_id"])
    rising = spark.createDataFrame(bounds, "slice timestamp, iteration int, bound double")
    return LdaFit(ranked, mixed, rising, named.select("slice", "term", "weights"))


def lda_timesliced(
    docs: DataFrame, settings: LdaSettings = LdaSettings(), stopwords: Iterable[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Per-slice models, fitted in one job: topics (slice, topic, rank, term, score) and mixtures (slice, doc_id, mixture)."""
    fit = fit_timesliced(docs, settings, stopwords)
    return fit.topics, fit.mixtures


def lda_corpus(
    docs: DataFrame, settings: LdaSettings = LdaSettings(), stopwords: Iterable[str] | DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """One fit over all slices: topics (topic, rank, term, score), mixtures (slice, doc_id, mixture).

    The model is that of ``fit_timesliced`` for a single slice of all documents; its words, at most ``max_features``, are known to every task, so
    that documents are numbered where they are."""
    s, k = settings, settings.n_topics
    prior = 1.0 / k
    # read by the vocabulary and by the numbering
    bag = materialise(K.bags(docs, stopwords).select("slice", "doc_id", "terms"), "bags")
    words = sorted(r["term"] for r in K.vocabulary(K.corpus_wide(bag), s.max_features).select("term").collect())
    if not words:
        raise ValueError("the corpus holds no token")
    own = materialise(_numbered(bag, {0: (0, 0, words)}, F.lit(0).cast("long")), "lda-rows")
    full = own.where(F.size("rows") > 0)
    model = variational.start_model([len(words)], [0], k, s.seed)
    for _ in range(s.max_iter):
        model, _ = variational.iterate(full, model, prior, prior)
    part = model.weights / model.weights.sum(axis=0)
    best = np.lexsort((np.broadcast_to(np.arange(len(words))[:, None], part.shape), -part), axis=0)[:TOP_WORDS]
    topics = [(topic, r + 1, words[t], float(part[t, topic])) for topic in range(k) for r, t in enumerate(best[:, topic].tolist())]
    mixed = materialise(variational.mixtures(own, model, prior, ["slice", "doc_id"]), "mixtures")
    return docs.sparkSession.createDataFrame(topics, "topic int, rank int, term string, score double"), mixed


def mean_mixture(mixtures: DataFrame) -> DataFrame:
    """(slice, topic, share): average topic share of the documents of a slice."""
    return (
        mixtures.select("slice", F.posexplode("mixture").alias("topic", "_share"))
        .groupBy("slice", "topic")
        .agg(F.avg("_share").alias("share"))
    )


def topic_strings(topics: DataFrame) -> DataFrame:
    """(slice, topic, top_keywords): "Topic i" and its words joined by a comma and a blank."""
    words = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return (
        topics.groupBy("slice", "topic")
        .agg(words.alias("_w"))
        .select(
            "slice",
            F.concat(F.lit("Topic "), F.col("topic").cast("string")).alias("topic"),
            F.array_join(F.transform("_w", lambda t: t["term"]), ", ").alias("top_keywords"),
        )
    )


def wide_mixtures(mixtures: DataFrame, n_topics: int) -> DataFrame:
    """Mixtures with one column per topic: ``Topic 0`` and so on."""
    columns = [F.get("mixture", F.lit(i)).alias(f"Topic {i}") for i in range(n_topics)]
    return mixtures.select("slice", "doc_id", *columns)
