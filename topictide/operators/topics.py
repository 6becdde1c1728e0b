"""Topic terms, topic summaries and document-topic tables from cluster labels.

Topic tables hold a few rows per topic; the document side is always aggregated by
(slice, topic, term) or by document with map-side partial sums before it is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topictide.operators.agglomerate import merged_topics
from topictide.operators.keywords import WeightedBags, exploded, join_frequent, rounded
from topictide.operators.ranking import top_n
from topictide.session import materialise

NOISE = -1
TOP_WORDS = 10
NAME_WORDS = 4
REPRESENTATIVE_DOCS = 3
# Temperature of the softmax that turns cosines into memberships.
MEMBERSHIP_TEMPERATURE = 0.1


def topic_sizes(doc_topics: DataFrame) -> DataFrame:
    """(slice, topic, count), noise included."""
    return doc_topics.groupBy("slice", "topic").agg(F.count("*").alias("count"))


def number_topics(clusters: DataFrame, min_cluster_size: int = 1) -> DataFrame:
    """(slice, doc_id, topic) from (slice, doc_id, cluster); a null cluster is noise.

    Topic 0 is the largest; equal sizes are decided by the smallest document id. Clusters
    below ``min_cluster_size`` are noise. The window runs over one row per cluster.
    """
    sizes = (
        clusters.where(F.col("cluster").isNotNull())
        .groupBy("slice", "cluster")
        .agg(F.count("*").alias("_size"), F.min("doc_id").alias("_first"))
        .where(F.col("_size") >= min_cluster_size)
    )
    order = Window.partitionBy("slice").orderBy(F.col("_size").desc(), F.col("_first").asc())
    numbered = sizes.select("slice", "cluster", (F.row_number().over(order) - 1).alias("topic"))
    # noise stays out of the join, where all of it would meet in one key
    found = clusters.where(F.col("cluster").isNotNull()).join(numbered, ["slice", "cluster"], "left")
    noise = clusters.where(F.col("cluster").isNull()).select("slice", "doc_id", F.lit(NOISE).alias("topic"))
    return found.select("slice", "doc_id", F.coalesce("topic", F.lit(NOISE)).alias("topic")).unionByName(noise)


def attach_topics(bag: DataFrame, doc_topics: DataFrame) -> DataFrame:
    """Bags with their topic column."""
    topics = doc_topics.select("slice", "doc_id", "topic")
    return bag.drop("topic").join(topics, ["slice", "doc_id"])


def class_frequencies(bag: DataFrame) -> DataFrame:
    """(slice, topic, term, tf): term counts of a topic taken as one document."""
    # null keys go before the grouping: joins would add the test to some branches only and so keep them from sharing it
    known = bag.where(F.col("slice").isNotNull() & F.col("topic").isNotNull())
    return exploded(known, "slice", "topic").groupBy("slice", "topic", "term").agg(F.sum("tf").alias("tf"))


def class_tfidf(bag: DataFrame) -> DataFrame:
    """(slice, topic, term, tf, score): class-based TF-IDF within each slice.

    tf / words of the topic * ln(1 + mean words per topic / count of the term in the slice).
    Both branches read the partial counts of ``class_frequencies``, shuffled once; the bag itself is not. The count of a term in the slice
    is summed where its topics already lie together, one row for each topic.
    """
    tc = class_frequencies(bag)
    words = tc.groupBy("slice", "topic").agg(F.sum("tf").alias("_words"))
    mean = words.groupBy("slice").agg(F.avg("_words").alias("_mean"))
    total = F.sum("tf").over(Window.partitionBy("slice", "term"))
    idf = F.log(F.lit(1.0) + F.col("_mean") / F.col("_total"))
    return (
        tc.withColumn("_total", total)
        .join(F.broadcast(mean), "slice")
        .join(words, ["slice", "topic"])
        .select("slice", "topic", "term", "tf", (F.col("tf") / F.col("_words") * idf).alias("score"))
    )


def topic_terms(scores: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    """(slice, topic, rank, term, score): the ``n`` best terms of every topic, from rank 1."""
    order = [rounded(F.col("score")).desc(), F.col("term").asc()]
    ranked = top_n(scores.select("slice", "topic", "term", "score"), ["slice", "topic"], order, n, "rank", ["term"])
    return ranked.select("slice", "topic", "rank", "term", "score")


def _labelled(weights: DataFrame | WeightedBags, topics: DataFrame) -> DataFrame:
    """(slice, doc_id, topic, term, weight) of the documents with a topic."""
    if isinstance(weights, WeightedBags):
        return weights.rows(topics)
    return weights.join(topics, ["slice", "doc_id"])


def _centers(rows: DataFrame) -> DataFrame:
    """(slice, topic, term, n, c), stored: centroids from rows with their topic; ``n`` of them hold the term."""
    sums = rows.groupBy("slice", "topic", "term").agg(F.sum("weight").alias("_sum"), F.count("*").alias("n"))
    sums = materialise(sums, "centroid-sums")
    norms = sums.groupBy("slice", "topic").agg(F.sqrt(F.sum(F.col("_sum") * F.col("_sum"))).alias("_norm"))
    return sums.join(norms, ["slice", "topic"]).select(
        "slice", "topic", "term", "n", (F.col("_sum") / F.col("_norm")).alias("c")
    )


def centroids(weights: DataFrame | WeightedBags, doc_topics: DataFrame, noise: bool = False) -> DataFrame:
    """(slice, topic, term, c): unit-length mean of the document vectors of a topic."""
    topics = doc_topics.select("slice", "doc_id", "topic")
    if not noise:
        topics = topics.where(F.col("topic") != NOISE)
    return _centers(_labelled(weights, topics)).drop("n")


def representative_docs(
    weights: DataFrame | WeightedBags, doc_topics: DataFrame, n: int = REPRESENTATIVE_DOCS
) -> DataFrame:
    """(slice, topic, rank, doc_id, similarity): documents nearest to their topic's centroid."""
    rows = _labelled(weights, doc_topics.select("slice", "doc_id", "topic"))
    sims = (
        join_frequent(rows, _centers(rows), ["slice", "topic", "term"], "n")
        .groupBy("slice", "topic", "doc_id")
        .agg(F.sum(F.col("weight") * F.col("c")).alias("similarity"))
    )
    order = [rounded(F.col("similarity")).desc(), F.col("doc_id").asc()]
    ranked = top_n(sims, ["slice", "topic"], order, n, "rank", ["doc_id"])
    return ranked.select("slice", "topic", "rank", "doc_id", "similarity")


def topic_info(doc_topics: DataFrame, terms: DataFrame, representatives: DataFrame) -> DataFrame:
    """(slice, topic, count, name, representation, representative_docs): one row per topic.

    The lists are short: at most ten terms and three documents of a topic are gathered.
    """
    words = terms.groupBy("slice", "topic").agg(
        F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_terms")
    )
    docs = representatives.groupBy("slice", "topic").agg(
        F.sort_array(F.collect_list(F.struct("rank", "doc_id"))).alias("_docs")
    )
    representation = F.transform("_terms", lambda t: t["term"])
    name = F.concat_ws("_", F.col("topic").cast("string"), F.slice(representation, 1, NAME_WORDS))
    return (
        topic_sizes(doc_topics)
        .join(words, ["slice", "topic"], "left")
        .join(docs, ["slice", "topic"], "left")
        .select(
            "slice",
            "topic",
            "count",
            name.alias("name"),
            representation.alias("representation"),
            F.transform("_docs", lambda d: d["doc_id"]).alias("representative_docs"),
        )
    )


def topic_cosines(weights: DataFrame, centers: DataFrame) -> DataFrame:
    """(slice, doc_id, topic, cosine) of documents and the topics they share a term with."""
    # a term meets all its topics at once; the number of documents that hold it is not less than the largest of a topic
    entries = centers.groupBy("slice", "term").agg(F.sum("n").alias("n"), F.collect_list(F.struct("topic", "c")).alias("_at"))
    met = join_frequent(weights, materialise(entries, "term-topics"), ["slice", "term"], "n")
    return (
        met.select("slice", "doc_id", "weight", F.explode("_at").alias("_t"))
        .groupBy("slice", "doc_id", F.col("_t.topic").alias("topic"))
        .agg(F.sum(F.col("weight") * F.col("_t.c")).alias("cosine"))
    )


def _met_by_join(weights: DataFrame, centers: DataFrame, temperature: float) -> DataFrame:
    """(slice, doc_id, _sum, _best, _met) from one row for every document and topic that share a term."""
    return (
        topic_cosines(weights, centers)
        .groupBy("slice", "doc_id")
        .agg(
            F.sum(F.exp(F.col("cosine") / temperature)).alias("_sum"),
            F.max("cosine").alias("_best"),
            F.count("*").alias("_met"),
        )
    )


def _met_by_document(weights: DataFrame, centers: DataFrame, temperature: float) -> DataFrame:
    """The same from whole documents and all centroids, which are sent to every task: products are added up where the document is."""
    rows = centers.select(F.unix_micros("slice").alias("slice"), "term", "topic", "c").toPandas().sort_values(["slice", "term"], kind="stable")
    tables = {}
    for start, own in rows.groupby("slice", sort=False):
        terms = own["term"].to_numpy()
        first = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])
        topics, topic = np.unique(own["topic"].to_numpy(), return_inverse=True)
        place = {t: i for i, t in enumerate(terms[first])}
        tables[int(start)] = (place, np.r_[first, len(terms)], topic, own["c"].to_numpy(), len(topics))
    shared = weights.sparkSession.sparkContext.broadcast(tables)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            micros = batch.column("micros").to_numpy()
            entries = batch.column("v")
            sizes = np.diff(entries.offsets.to_numpy())
            flat = entries.flatten()
            words = flat.field("term").dictionary_encode()
            owner, w = np.repeat(np.arange(len(sizes)), sizes), flat.field("weight").to_numpy()
            code, known = words.indices.to_numpy(), words.dictionary.to_pylist()
            out = np.zeros((3, len(sizes)))
            for start in np.unique(micros):
                if int(start) not in shared.value:
                    continue
                place, bounds, topic, c, k = shared.value[int(start)]
                docs = np.flatnonzero(micros == start)
                row = np.array([place.get(t, -1) for t in known])[code]
                at = np.flatnonzero((micros[owner] == start) & (row >= 0))
                n = bounds[row[at] + 1] - bounds[row[at]]
                posting = np.repeat(bounds[row[at]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                local = np.searchsorted(docs, owner[at])
                key = np.repeat(local, n) * k + topic[posting]
                cosines = np.bincount(key, weights=np.repeat(w[at], n) * c[posting], minlength=len(docs) * k).reshape(-1, k)
                met = np.bincount(key, minlength=len(docs) * k).reshape(-1, k) > 0
                out[0, docs] = np.where(met, np.exp(cosines / temperature), 0).sum(axis=1)
                out[1, docs] = np.where(met, cosines, 0).max(axis=1, initial=0)
                out[2, docs] = met.sum(axis=1)
            columns = [batch.column("slice"), batch.column("doc_id"), pa.array(out[0]), pa.array(out[1]), pa.array(out[2].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "doc_id", "_sum", "_best", "_met"])

    whole = weights.groupBy("slice", "doc_id").agg(F.collect_list(F.struct("term", "weight")).alias("v"))
    kind = whole.schema["doc_id"].dataType.simpleString()
    rows = whole.select("slice", "doc_id", F.unix_micros("slice").alias("micros"), "v")
    return rows.mapInArrow(meet, f"slice timestamp, doc_id {kind}, _sum double, _best double, _met long")


# Rows of a table of centroids (slice, topic, term, c) up to which it is sent to every task (some 100 MB).
CENTROID_ROWS = 1_000_000


def document_topics(
    weights: DataFrame | WeightedBags, doc_topics: DataFrame, temperature: float = MEMBERSHIP_TEMPERATURE, centroid_rows: int = CENTROID_ROWS
) -> DataFrame:
    """(slice, doc_id, topic, probability): labels with the largest topic membership.

    Memberships are the softmax of the cosines to the topic centroids of the slice. Topics
    that share no term with a document have cosine 0; they enter the sum by their number and are never
    paired with it. Without any topic in the slice the probability is null. Up to ``centroid_rows`` rows of centroids go to the
    documents; more are joined with them by term.
    """
    labels = doc_topics.select("slice", "doc_id", "topic")
    centers = materialise(_centers(_labelled(weights, labels.where(F.col("topic") != NOISE))), "centroids")
    n_topics = (
        labels.where(F.col("topic") != NOISE).groupBy("slice").agg(F.count_distinct("topic").alias("_k"))
    )
    if isinstance(weights, WeightedBags):
        met = _met_by_join(weights.rows(), centers, temperature)
    else:
        meet = _met_by_document if centers.count() <= centroid_rows else _met_by_join
        met = meet(weights, centers, temperature)
    unmet = F.col("_k") - F.coalesce("_met", F.lit(0))
    total = F.coalesce("_sum", F.lit(0.0)) + unmet
    # cosines of non-negative vectors are never below that of an unmet topic
    best = F.exp(F.coalesce("_best", F.lit(0.0)) / temperature)
    return (
        labels.join(met, ["slice", "doc_id"], "left")
        .join(F.broadcast(n_topics), "slice", "left")  # one row per slice: calendar bound
        .select("slice", "doc_id", "topic", (best / total).alias("probability"))
    )


def reduce_topics(weights: DataFrame | WeightedBags, doc_topics: DataFrame, n_topics: int | None) -> DataFrame:
    """(slice, doc_id, topic) with at most ``n_topics`` topics per slice, renumbered by size.

    The closest two topics are merged, by average linkage of their centroids, until ``n_topics`` are left. ``None`` means no
    reduction; noise stays noise. A topic none of whose documents has a weight has no centroid and is left as it is.
    """
    labels = doc_topics.select("slice", "doc_id", "topic")
    if n_topics is None:
        return labels
    merged = (
        labels.join(merged_topics(centroids(weights, labels), n_topics), ["slice", "topic"], "left")
        .withColumn("_to", F.coalesce("cluster", "topic"))
        .select("slice", "doc_id", F.when(F.col("_to") != NOISE, F.col("_to")).alias("cluster"))
    )
    return number_topics(merged)
