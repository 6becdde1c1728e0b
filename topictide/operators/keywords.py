"""Terms, vocabularies and TF-IDF scores for every slice in one plan.

``bags`` is the common input: one row per document with its term counts as an array. The
counting never shuffles. Statistics come from partial aggregates on (slice, term), so a
slice or a term holding a third of the rows costs each map task one row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topictide.functions import text as T
from topictide.operators.ranking import top_n
from topictide.session import materialise

# A vocabulary is broadcast only up to this many rows (about 100 MB as a hash table).
BROADCAST_ROWS = 1_000_000
# A stopword table of up to this many words becomes a hash set in the plan; a longer one is joined.
STOPWORD_SET = 50_000
VARIANTS = ("smooth_l2", "plain")


def without_stopwords(docs: DataFrame, stopwords: Iterable[str] | DataFrame | None, text_col: str = "text") -> DataFrame:
    """``docs`` with the stopwords taken out of the text.

    A list becomes a hash set of literals, and so does a table (column ``word``) of up to ``STOPWORD_SET`` different words, counted first: no
    text is shuffled then. A longer table is anti-joined with the words of every different text, which are then put together again.
    Either way a null text stays null and a text of stopwords becomes empty, whatever the other columns hold.
    """
    if stopwords is None:
        return docs
    if not isinstance(stopwords, DataFrame):
        return docs.withColumn(text_col, T.remove_stopwords(F.col(text_col), stopwords))
    stopwords = materialise(stopwords.select(F.lower("word").alias("word")).where("word is not null").distinct(), "stopwords")
    if stopwords.count() <= STOPWORD_SET:
        stop = [r["word"] for r in stopwords.collect()]
        kept = F.filter(T.words(F.col(text_col)), lambda w: ~F.lower(w).isin(stop) if stop else F.lit(True))
        return docs.withColumn(text_col, F.array_join(kept, " "))
    keyed = docs.withColumn("_text_key", F.unhex(F.sha2(text_col, 256)))
    texts = keyed.where(F.col(text_col).isNotNull()).groupBy("_text_key").agg(F.first(text_col).alias("_text"))
    words = texts.select("_text_key", F.posexplode(T.words(F.col("_text"))).alias("_at", "word"))
    left = (
        stopword_join(words, stopwords)
        .groupBy("_text_key")
        .agg(F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_w"))
        .select("_text_key", F.array_join(F.transform("_w", lambda w: w["word"]), " ").alias("_left"))
    )
    bare = F.when(F.col(text_col).isNotNull(), F.coalesce("_left", F.lit("")))
    return keyed.join(left, "_text_key", "left").withColumn(text_col, bare).select(*docs.columns)


def bags(
    docs: DataFrame, stopwords: Iterable[str] | DataFrame | None = None, text_col: str = "text"
) -> DataFrame:
    """(slice, doc_id, [topic,] terms array<struct<term, tf>>) of cleaned documents."""
    docs = without_stopwords(docs, stopwords, text_col)
    text = F.col(text_col)
    keep = [c for c in ("slice", "slice_label", "doc_id", "topic") if c in docs.columns]
    return docs.select(*keep, T.count_terms(T.tokens(text)).alias("terms"))


def by_document(bag: DataFrame) -> DataFrame:
    """Hash-partition bags by document, for plans that read them more than once.

    All branches then share this one exchange: cleaning and tokenising run once, what is
    shuffled is the compact bag, and per-document windows behind it need no other shuffle.
    The keys are tested for null here because Spark would otherwise add the test to some branches
    only (those joined on that key), which makes their exchanges different ones.
    """
    return with_keys(bag).repartition("doc_id")


def with_keys(bag: DataFrame) -> DataFrame:
    """Bags without a null key."""
    for key in ("slice", "doc_id", "topic"):
        if key in bag.columns:
            bag = bag.where(F.col(key).isNotNull())
    return bag


def corpus_wide(docs: DataFrame) -> DataFrame:
    """All documents in a single slice (its start is the epoch)."""
    return docs.drop("slice", "slice_label").withColumn("slice", F.timestamp_seconds(F.lit(0)))


def term_counts(bag: DataFrame) -> DataFrame:
    """(slice, doc_id, term, tf)."""
    return exploded(bag, "slice", "doc_id")


def exploded(bag: DataFrame, *keep: str | Column) -> DataFrame:
    """One row per term of a bag: the kept columns, term, tf.

    The outer form matters: a plain explode makes Spark filter on the size of the array
    below the projection that builds it, which would clean and tokenise every text twice.
    """
    rows = bag.select(*keep, F.explode_outer("terms").alias("_t")).where(F.col("_t.term").isNotNull())
    return rows.select(*rows.columns[:-1], "_t.term", "_t.tf")


def term_stats(bag: DataFrame) -> DataFrame:
    """Document frequency ``df`` and total count ``cf`` per (slice, term)."""
    return (
        term_counts(bag)
        .groupBy("slice", "term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    )


def slice_totals(bag: DataFrame) -> DataFrame:
    """Documents per slice, the ones without a token included."""
    return bag.groupBy("slice").agg(F.count("*").alias("n_docs"))


def vocabulary(bag: DataFrame, max_features: int | None = None) -> DataFrame:
    """(slice, term, df, cf): per slice the ``max_features`` most frequent terms.

    Equal counts are decided by the smaller term.
    """
    stats = term_stats(bag)
    if max_features is None:
        return stats
    order = [F.col("cf").desc(), F.col("term").asc()]
    return top_n(stats, ["slice"], order, max_features, "_rank", ["term"]).drop("_rank")


def numbered_vocabulary(bag: DataFrame, max_features: int) -> DataFrame:
    """Vocabulary with ``term_id``, the alphabetical position (from 0) in its slice."""
    window = Window.partitionBy("slice").orderBy("term")
    return vocabulary(bag, max_features).withColumn("term_id", F.row_number().over(window) - 1)


def bounded(vocab: DataFrame, bag: DataFrame, max_features: int | None) -> DataFrame:
    """Mark ``vocab`` for broadcast if it provably is small.

    It has at most ``max_features`` rows per slice; the slices are counted (a scan of the
    date column alone). Otherwise Spark joins by (slice, term) and AQE splits hot keys.
    """
    if max_features is None or max_features > BROADCAST_ROWS:
        return vocab
    n_slices = bag.select("slice").distinct().count()
    return F.broadcast(vocab) if n_slices * max_features <= BROADCAST_ROWS else vocab


def join_frequent(rows: DataFrame, table: DataFrame, keys: list[str], count_col: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` joined with a stored ``table`` that has every key once and, in ``count_col``, how many rows have it.

    The keys that most rows have are sent to every task, at most ``most`` of them; only the rows of all others are shuffled. The
    table is read whole either way, and each row meets its key in one of the two joins.
    """
    graded = table.withColumn("_grade", F.floor(F.log2(F.col(count_col)) * 8))
    held, least = 0, None
    # one row for each eighth of a power of two
    for r in sorted(graded.groupBy("_grade").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["_grade"]):
        held += r["n"]
        if held > most:
            break
        least = r["_grade"]
    else:
        return rows.join(F.broadcast(table), keys)
    if least is None:
        return rows.join(table, keys)
    head = graded.where(F.col("_grade") >= least).drop("_grade")
    tail = graded.where(F.col("_grade") < least).drop("_grade")
    rare = rows.join(F.broadcast(head.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(head), keys).unionByName(rare.join(tail, keys))


def keyword_frequency(bag: DataFrame, max_features: int | None = None) -> DataFrame:
    """(slice, term, frequency): total count of every vocabulary term."""
    return vocabulary(bag, max_features).select("slice", "term", F.col("cf").alias("frequency"))


def count_vectors(bag: DataFrame, max_features: int) -> DataFrame:
    """(slice, doc_id, term_id, tf): bag-of-words rows over the slice vocabulary."""
    shared = by_document(bag)
    vocab = numbered_vocabulary(shared, max_features).select("slice", "term", "term_id")
    return (
        term_counts(shared)
        .join(bounded(vocab, bag, max_features), ["slice", "term"])
        .select("slice", "doc_id", "term_id", "tf")
    )


def tfidf_documents(
    bag: DataFrame, max_features: int | None = None, variant: str = "smooth_l2"
) -> DataFrame:
    """(slice, doc_id, term, tf, weight) for every kept term of every document.

    ``smooth_l2``: tf * (ln((1+N)/(1+df)) + 1), scaled to unit length over the kept terms.
    ``plain``: share of the term in the document * ln(N/(1+df)).
    """
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")
    if max_features is None and variant == "smooth_l2":
        return weighted_bags(bag).rows()
    shared = by_document(bag)
    vocab = (
        vocabulary(shared, max_features)
        .join(F.broadcast(slice_totals(bag)), "slice")  # one row per slice: calendar bound
        .select("slice", "term", _idf(variant).alias("idf"))
    )
    # the length is a column of the bag: beside the explode it would be added up again for every term of the document
    counts = exploded(with_length(shared), "slice", "doc_id", "doc_length")
    joined = counts.join(bounded(vocab, bag, max_features), ["slice", "term"])
    if variant == "plain":
        weight = F.col("tf") / F.col("doc_length") * F.col("idf")
    else:
        raw = F.col("tf") * F.col("idf")
        norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy("slice", "doc_id")))
        weight = raw / norm
    return joined.select("slice", "doc_id", "term", "tf", weight.alias("weight"))


def _idf(variant: str) -> Column:
    one = F.lit(1.0)
    n, df = F.col("n_docs").cast("double"), F.col("df").cast("double")
    return F.log((n + one) / (df + one)) + one if variant == "smooth_l2" else F.log(n / (df + one))


@dataclass(frozen=True)
class WeightedBags:
    """``smooth_l2`` weights of all terms as a stored bag, one row per document, and the factors of the terms, so that documents can be
    shuffled without a row for each of their terms."""

    bag: DataFrame  # slice, doc_id, terms
    norms: DataFrame  # slice, doc_id, norm: one row per document with a term
    idf: DataFrame  # slice, term, df, idf

    def with_norms(self, doc_topics: DataFrame | None = None) -> DataFrame:
        """Bags with ``norm``; with ``doc_topics`` also with their topic, and without documents that have none."""
        keys = ["slice", "doc_id"]
        own = self.norms if doc_topics is None else self.norms.join(doc_topics.select(*keys, "topic"), keys)
        return self.bag.join(own, keys)

    def rows(self, doc_topics: DataFrame | None = None, *more: str) -> DataFrame:
        """(slice, doc_id, [topic,] term, tf, weight) and columns ``more`` of the terms' table."""
        keep = ["slice", "doc_id"] if doc_topics is None else ["slice", "doc_id", "topic"]
        own = self.norms if doc_topics is None else self.norms.join(doc_topics.select(*keep), ["slice", "doc_id"])
        own = own if doc_topics is None else materialise(own, "document-norms")
        if own.count() <= BROADCAST_ROWS:
            bag = self.bag.join(F.broadcast(own), ["slice", "doc_id"])
        else:  # both kinds of terms read the documents with their norms
            bag = materialise(self.bag.join(own, ["slice", "doc_id"]), "weighted-bags")
        rows = join_frequent(exploded(bag, *keep, "norm"), self.idf, ["slice", "term"], "df")
        return rows.select(*keep, "term", "tf", (F.col("tf") * F.col("idf") / F.col("norm")).alias("weight"), *more)


def small(table: DataFrame) -> DataFrame:
    """A stored table marked for broadcast, if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def weighted_bags(bag: DataFrame, stored: bool = False) -> WeightedBags:
    """Weights over the whole vocabulary: bags (unless ``bag`` is ``stored``) and factors of terms are stored, and each is read instead of
    computed anew.

    The length of a document's vector is added up where its bag is, so no row of a term leaves its task for it.
    """
    bag = with_keys(bag).select("slice", "doc_id", "terms")
    bag = bag if stored else materialise(bag, "bags")
    totals = F.broadcast(slice_totals(bag))  # one row per slice: calendar bound
    idf = term_stats(bag).join(totals, "slice").select("slice", "term", "df", _idf("smooth_l2").alias("idf"))
    idf = materialise(idf, "idf")
    raw = F.col("tf") * F.col("idf")
    # rows that share slice and id are one document
    norms = join_frequent(exploded(bag, "slice", "doc_id"), idf, ["slice", "term"], "df").groupBy("slice", "doc_id")
    norms = norms.agg(F.sqrt(F.sum(raw * raw)).alias("norm"))
    return WeightedBags(bag, materialise(norms, "norms"), idf)


def with_length(bag: DataFrame) -> DataFrame:
    """Bags with ``doc_length``, the number of their tokens."""
    return bag.withColumn("doc_length", F.aggregate("terms", F.lit(0).cast("long"), lambda acc, t: acc + t["tf"]))


def _plain_slices(bag: DataFrame, max_features: int | None) -> DataFrame:
    """Plain scores of slices: a term's weight is its share of a document times a factor of the slice, so the shares are added up
    together with the document frequency, and no row of a document is shuffled."""
    rows = exploded(with_length(with_keys(bag)), "slice", "doc_length")
    stats = rows.groupBy("slice", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf"), F.sum(F.col("tf") / F.col("doc_length")).alias("_share")
    )
    if max_features is not None:
        stats = top_n(stats, ["slice"], [F.col("cf").desc(), F.col("term").asc()], max_features, "_rank", ["term"])
    idf = F.log(F.col("n_docs").cast("double") / (F.col("df").cast("double") + F.lit(1.0)))
    totals = F.broadcast(slice_totals(bag))  # one row per slice: calendar bound
    return stats.join(totals, "slice").select("slice", "term", (F.col("_share") * idf).alias("score"))


def tfidf_slices(
    bag: DataFrame, max_features: int | None = None, variant: str = "smooth_l2"
) -> DataFrame:
    """(slice, term, score): document weights summed over the slice."""
    if variant == "plain":
        return _plain_slices(bag, max_features)
    if max_features is None:
        # a term's factor is the same in all documents of the slice
        weighted = weighted_bags(bag)
        shares = exploded(weighted.with_norms(), "slice", "norm").groupBy("slice", "term").agg(F.sum(F.col("tf") / F.col("norm")).alias("_share"))
        return shares.join(weighted.idf, ["slice", "term"]).select("slice", "term", (F.col("_share") * F.col("idf")).alias("score"))
    return (
        tfidf_documents(bag, max_features, variant)
        .groupBy("slice", "term")
        .agg(F.sum("weight").alias("score"))
    )


def rounded(score: Column) -> Column:
    """Scores are ranked on six decimals, so that float noise never decides a tie."""
    return F.round(score, 6)


def top_keywords(scores: DataFrame, n: int = 10) -> DataFrame:
    """(slice, rank, term, score): the ``n`` best terms of every slice."""
    order = [rounded(F.col("score")).desc(), F.col("term").asc()]
    return top_n(scores, ["slice"], order, n, "rank", ["term"])


def document_keywords(weights: DataFrame, n: int = 10) -> DataFrame:
    """(slice, doc_id, rank, term, weight): the ``n`` best terms of every document."""
    order = [rounded(F.col("weight")).desc(), F.col("term").asc()]
    return top_n(weights.drop("tf"), ["slice", "doc_id"], order, n, "rank", ["term"])


def stopword_join(words: DataFrame, stopwords: DataFrame, word_col: str = "word") -> DataFrame:
    """Word rows without the stopwords of a table, for lists too long to be literals."""
    stop = stopwords.select(F.lower("word").alias("_stop")).distinct()
    return words.join(stop, F.lower(word_col) == F.col("_stop"), "left_anti")


def empty_documents(docs: DataFrame, stopwords: Iterable[str] | None = None) -> DataFrame:
    """(slice, n_docs, n_empty): documents left without a word."""
    text = F.col("text") if stopwords is None else T.remove_stopwords(F.col("text"), stopwords)
    return docs.groupBy("slice").agg(
        F.count("*").alias("n_docs"), F.count_if(F.trim(text) == "").alias("n_empty")
    )
