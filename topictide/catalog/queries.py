"""One query per operator, over the given tables: callables (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topictide.catalog import inputs as I
from topictide.catalog.inputs import r6, with_label
from topictide.functions import text as T
from topictide.functions import vectors as V
from topictide.functions.dates import parse_date, slice_label, slice_start, year_month
from topictide.operators import density, embedding, grid_density, hierarchy, intervals, kmeans, lda, similarity, slicing, staging, topics, trend
from topictide.operators import keywords as K
from topictide.plans.config import RunConfig, fingerprint
from topictide.plans import runs
from topictide.session import materialise, work_path
from topictide.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VOCABULARY = 500
DENSITY = density.DensitySettings(eps=0.4, min_samples=3, min_cluster_size=5)
HIERARCHY = hierarchy.HierarchySettings(min_samples=DENSITY.min_samples, min_cluster_size=DENSITY.min_cluster_size)
GRID = grid_density.GridSettings(eps=0.2, min_samples=4, min_cluster_size=5)
LDA_SETTINGS = lda.LdaSettings(n_topics=10, max_features=1000)
RESULT_CONFIG = {"job_name": "topics-monthly", "sampling_freq": "monthly", "n_topics": 7}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- time intervals and slices ----


def _ranges(spark: SparkSession, sf_dir: str, freq: str) -> DataFrame:
    return intervals.time_ranges_of(I.table(spark, sf_dir, "orders"), freq, "o_orderdate")


@query
def t1_time_ranges_monthly(spark, sf_dir):
    return _ranges(spark, sf_dir, "monthly")


@query
def t1_time_ranges_weekly(spark, sf_dir):
    return _ranges(spark, sf_dir, "weekly")


@query
def t1_time_ranges_daily(spark, sf_dir):
    return _ranges(spark, sf_dir, "daily")


def _assigned(spark: SparkSession, sf_dir: str, bounds: str) -> DataFrame:
    docs = I.documents(spark, sf_dir).select("doc_id", "published")
    return intervals.assign_intervals(docs, intervals.time_ranges_of(docs, "weekly"), bounds)


@query
def t2_assign_intervals_half_open(spark, sf_dir):
    return _assigned(spark, sf_dir, "half_open").select("doc_id", "start", "end")


@query
def t2_assign_intervals_closed(spark, sf_dir):
    return _assigned(spark, sf_dir, "closed").select("doc_id", "start", "end")


@query
def j2_range_join_orders(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ranges = intervals.time_ranges_of(orders, "monthly", "o_orderdate")
    return (
        intervals.assign_intervals(orders, ranges, "closed", "o_orderdate")
        .groupBy("start", "end")
        .agg(F.count("*").alias("n_orders"))
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("published"))


@query
def t3_cap_per_interval(spark, sf_dir):
    events = _events(spark, sf_dir)
    ranges = intervals.time_ranges_of(events, "weekly")
    capped = intervals.cap_per_interval(intervals.assign_intervals(events, ranges), 100)
    return capped.select("start", "doc_id")


@query
def t4_pending_intervals(spark, sf_dir):
    docs = I.documents(spark, sf_dir).select("doc_id", "published")
    done = intervals.assign_intervals(_events(spark, sf_dir), intervals.time_ranges_of(docs, "weekly"))
    return intervals.pending_intervals(intervals.time_ranges_of(docs, "weekly"), done)


@query
def t4_collected_records(spark, sf_dir):
    """Window, cap and resume together: what was published before March, then everything; the week that was open then stays as it was."""
    path = work_path(spark, "raw")
    docs = I.documents(spark, sf_dir).withColumn("id", F.col("doc_id").cast("string"))
    config = RunConfig(start_year=2024, end_year=2024, sampling_freq="weekly", max_per_interval=100)
    runs.collect_records(docs.where(F.col("published") < F.lit("2024-03-01").cast("timestamp")), path, config)
    runs.collect_records(docs, path, config)
    rows = spark.read.option("basePath", path).options(**readers.CSV_OPTIONS).option("multiLine", "true").csv(path)
    bounds = F.split("interval", "_to_")
    return rows.select("id", F.to_timestamp(bounds[0]).alias("start"), F.to_timestamp(bounds[1]).alias("end")).select(
        F.col("id").cast("string").alias("id"), "start", "end"
    )


@query
def t5_empty_intervals(spark, sf_dir):
    docs = I.documents(spark, sf_dir).select("doc_id", "published")
    ranges = intervals.time_ranges_of(docs, "weekly")
    return intervals.empty_intervals(ranges, intervals.assign_intervals(docs, ranges))


def _slices(spark: SparkSession, sf_dir: str, freq: str) -> DataFrame:
    return slicing.with_slice(_events(spark, sf_dir), freq).select("doc_id", "slice", "slice_label")


@query
def t6_slice_monthly(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("published"))
    return slicing.with_slice(orders, "monthly").select("o_orderkey", "slice", "slice_label")


@query
def t7_slice_weekly(spark, sf_dir):
    return _slices(spark, sf_dir, "weekly")


@query
def t7_slice_daily(spark, sf_dir):
    return _slices(spark, sf_dir, "daily")


@query
def t8_slice_labels(spark, sf_dir):
    start = {freq: slice_start(F.col("published"), freq) for freq in ("monthly", "weekly", "daily")}
    labels = [slice_label(s, freq).alias(f"{freq}_label") for freq, s in start.items()]
    return I.documents(spark, sf_dir).select("doc_id", *labels)


@query
def t9_date_parts(spark, sf_dir):
    date = F.col("o_orderdate")
    return I.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(date).alias("year"), F.month(date).alias("month"), year_month(date).alias("year_month")
    )


@query
def t10_min_docs(spark, sf_dir):
    docs = slicing.with_slice(I.documents(spark, sf_dir).select("doc_id", "published"), "weekly")
    return slicing.slices_with_min_docs(docs, 15).select("doc_id", "slice_label")


@query
def t11_slice_sizes(spark, sf_dir):
    return with_label(slicing.slice_sizes(slicing.with_slice(_events(spark, sf_dir), "weekly")), "weekly")


# ---- staging, projections, scalar functions ----


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records: all strings, some dates unparseable, empty summaries missing."""
    bad = F.col("doc_id") % 10 == 3
    stamp = F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return I.documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        "title",
        F.nullif("summary", F.lit("")).alias("summary"),
        F.when(bad, "not a date").otherwise(stamp).alias("published"),
        "authors",
        "link",
    )


@query
def p1_standardise_columns(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    messy = orders.select(F.col("o_orderkey").alias(" O OrderKey "), F.col("o_totalprice").alias("Total Price"))
    return staging.standardise_columns(messy)


@query
def p2_row_hash(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select("id", staging.row_hash(raw.columns).alias("hash"))


@query
def p3_parse_date(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", parse_date(F.col("published")).alias("published"))


@query
def p4_staged(spark, sf_dir):
    return staging.stage(_raw(spark, sf_dir)).select("id", "hash", "published", "year", "month", "year_month")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents")
    author = [F.struct(F.col(c).alias("name"), F.col("doc_id").alias("no")) for c in ("source", "lang")]
    return docs.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("title"), F.col("text").alias("summary"),
        F.col("n_chars").alias("published"), F.array(*author).alias("authors"), F.col("source").alias("link"),
        F.lit("x").alias("other"),
    )


@query
def p5_record_fields(spark, sf_dir):
    return staging.select_record_fields(_entries(spark, sf_dir))


@query
def p6_flatten_authors(spark, sf_dir):
    return _entries(spark, sf_dir).select("id", staging.flatten_authors(F.col("authors")).alias("authors"))


@query
def p7_join_title_summary(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select("id", T.join_title_summary(F.col("title"), F.col("summary")).alias("text"))


@query
def p8_expand_contractions(spark, sf_dir):
    text = F.regexp_replace(F.regexp_replace("text", " the ", " don't "), " of ", " it’s ")
    docs = I.spread(I.table(spark, sf_dir, "documents"), "doc_id")
    return docs.select("doc_id", T.expand_contractions(text).alias("text"))


@query
def p9_lowercase(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))


@query
def p10_nfkd(spark, sf_dir):
    docs = I.spread(I.table(spark, sf_dir, "documents"), "doc_id")
    return docs.select("doc_id", T.nfkd(F.col("text")).alias("text"))


@query
def p11_collapse_whitespace(spark, sf_dir):
    return I.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", T.collapse_whitespace(F.col("text")).alias("text")
    )


@query
def p12_remove_urls(spark, sf_dir):
    return I.table(spark, sf_dir, "pages").select(
        "page_id", T.remove_urls(F.concat_ws(" ", F.lit("see"), "url", "html")).alias("text")
    )


@query
def p13_remove_punctuation(spark, sf_dir):
    return I.table(spark, sf_dir, "pages").select("page_id", T.remove_punctuation(F.col("html")).alias("text"))


@query
def p14_strip(spark, sf_dir):
    padded = F.concat(F.lit(" \t\n"), "text", F.lit("\r\n  "))
    return I.table(spark, sf_dir, "conversations").select("conv_id", "turn", T.strip(padded).alias("text"))


@query
def p15_clean_text(spark, sf_dir):
    return I.cleaned(spark, sf_dir).select("doc_id", "text")


@query
def p15_clean_pages(spark, sf_dir):
    text = T.clean_text(T.join_title_summary(F.col("url"), F.col("html")))
    return I.spread(I.table(spark, sf_dir, "pages"), "page_id").select("page_id", text.alias("text"))


@query
def p16_metadata(spark, sf_dir):
    return I.documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "title", "published")


@query
def p17_tokens(spark, sf_dir):
    return I.cleaned(spark, sf_dir).select("doc_id", F.array_join(T.tokens(F.col("text")), " ").alias("tokens"))


@query
def p18_remove_stopwords(spark, sf_dir):
    text = T.remove_stopwords(F.col("text"), I.STOPWORDS)
    return I.cleaned(spark, sf_dir).select("doc_id", text.alias("text"))


@query
def p22_max_membership(spark, sf_dir):
    vectors = I.table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", r6(V.max_membership(F.col("embedding")).cast("double")).alias("probability"))


@query
def p24_empty_documents(spark, sf_dir):
    return with_label(K.empty_documents(I.sliced(spark, sf_dir, "weekly"), I.STOPWORDS), "weekly")


@query
def p25_l2_normalise(spark, sf_dir):
    tripled = F.transform("embedding", lambda x: x.cast("double") * 3.0)
    unit = F.posexplode(V.l2_normalise(tripled)).alias("pos", "value")
    return I.table(spark, sf_dir, "embeddings").select("vec_id", unit).select("vec_id", "pos", r6("value").alias("value"))


# ---- joins, deduplication, set operations ----


@query
def j1_corpus_metadata(spark, sf_dir):
    docs = I.cleaned(spark, sf_dir)
    return docs.select("doc_id", "text").join(docs.select("doc_id", "title", "published"), "doc_id")


@query
def j4_stopword_join(spark, sf_dir):
    words = I.cleaned(spark, sf_dir).select("doc_id", F.explode(T.words(F.col("text"))).alias("word"))
    stop = I.table(spark, sf_dir, "nation").select(F.lower("n_name").alias("word")).union(
        I.table(spark, sf_dir, "benchmark").select(F.explode(T.words(F.lower("text"))).alias("word"))
    )
    return K.stopword_join(words, stop).groupBy("word").agg(F.count("*").alias("n"))


@query
def a1_staged_per_year(spark, sf_dir):
    raw = I.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("published"))
    return staging.staged_per_year(staging.stage(raw))


@query
def a17_dedupe(spark, sf_dir):
    docs = I.documents(spark, sf_dir).select("doc_id", "title", "summary")
    hashed = docs.withColumn("hash", staging.row_hash(["title", "summary"]))
    return staging.dedupe_documents(hashed).select("doc_id", "hash")


@query
def u1_concat_parts(spark, sf_dir):
    parts = [
        I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "text"),
        I.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), "role", "text"),
    ]
    return staging.concat_parts(parts)


# ---- terms and keyword scores ----


def _bag(spark: SparkSession, sf_dir: str, freq: str = "monthly") -> DataFrame:
    return K.bags(I.sliced(spark, sf_dir, freq))


@query
def a3_term_counts(spark, sf_dir):
    return K.term_counts(_bag(spark, sf_dir)).select("doc_id", "term", "tf")


@query
def a4_document_frequency(spark, sf_dir):
    stats = K.term_stats(_bag(spark, sf_dir, "weekly"))
    totals = K.slice_totals(_bag(spark, sf_dir, "weekly"))
    joined = stats.join(F.broadcast(totals), "slice")  # one row per slice
    return with_label(joined.select("slice", "term", "df", "n_docs"), "weekly")


@query
def a5_keyword_freq(spark, sf_dir):
    return with_label(K.keyword_frequency(_bag(spark, sf_dir)))


@query
def w2_vocab(spark, sf_dir):
    return with_label(K.vocabulary(_bag(spark, sf_dir), 500).select("slice", "term", "cf"))


@query
def m1_count_vectors(spark, sf_dir):
    vectors = K.count_vectors(_bag(spark, sf_dir), VOCABULARY)
    return vectors.select("doc_id", F.col("term_id").cast("long").alias("term_id"), "tf")


@query
def a6_tfidf_doc(spark, sf_dir):
    weights = K.tfidf_documents(_bag(spark, sf_dir))
    return weights.select("doc_id", "term", r6("weight").alias("weight"))


@query
def a6_tfidf_doc_top_vocab(spark, sf_dir):
    weights = K.tfidf_documents(_bag(spark, sf_dir), VOCABULARY)
    return weights.select("doc_id", "term", r6("weight").alias("weight"))


@query
def a7_tfidf_table_stopwords(spark, sf_dir):
    """TF-IDF without the twenty terms that most documents hold; the list is a table."""
    found = K.term_stats(K.corpus_wide(_bag(spark, sf_dir))).orderBy(F.desc("df"), "term").limit(20)
    scores = K.tfidf_slices(K.bags(I.sliced(spark, sf_dir), found.select(F.col("term").alias("word"))))
    return with_label(scores.select("slice", "term", r6("score").alias("score")))


@query
def a7_tfidf_slice(spark, sf_dir):
    scores = K.tfidf_slices(_bag(spark, sf_dir), VOCABULARY)
    return with_label(scores.select("slice", "term", r6("score").alias("score")))


@query
def a8_tfidf_plain(spark, sf_dir):
    scores = K.tfidf_slices(_bag(spark, sf_dir), variant="plain")
    return with_label(scores.select("slice", "term", r6("score").alias("score")))


@query
def a9_tfidf_corpus(spark, sf_dir):
    scores = K.tfidf_slices(K.bags(K.corpus_wide(I.sliced(spark, sf_dir))), 500)
    return scores.select("term", r6("score").alias("score"))


@query
def w1_top_keywords(spark, sf_dir):
    scores = K.tfidf_slices(K.bags(I.sliced(spark, sf_dir), I.STOPWORDS))
    top = K.top_keywords(scores, 10)
    return with_label(top.select("slice", F.col("rank").cast("long").alias("rank"), "term", r6("score").alias("score")))


@query
def w9_document_keywords(spark, sf_dir):
    top = K.document_keywords(K.tfidf_documents(_bag(spark, sf_dir)), 5)
    return top.select("doc_id", F.col("rank").cast("long").alias("rank"), "term", r6("weight").alias("weight"))


@query
def w11_keyword_freq_sorted(spark, sf_dir):
    freq = with_label(K.keyword_frequency(_bag(spark, sf_dir), VOCABULARY))
    return freq.orderBy("slice_label", F.col("frequency").desc(), "term")


@query
def p21_joined_keywords(spark, sf_dir):
    top = K.top_keywords(K.tfidf_slices(_bag(spark, sf_dir), 500), 10)
    words = F.sort_array(F.collect_list(F.struct("rank", "term")))
    joined = top.groupBy("slice").agg(F.array_join(F.transform(words, lambda t: t["term"]), ", ").alias("top_keywords"))
    return with_label(joined)


@query
def m17_tfidf_timesliced(spark, sf_dir):
    config = RunConfig(sampling_freq="weekly", tfidf_max_features=500)
    scores = runs.tfidf_timesliced(I.cleaned(spark, sf_dir), config, I.STOPWORDS)
    return scores.select("slice_label", "term", r6("score").alias("score"))


# ---- topics from labels ----


@query
def a16_topic_sizes(spark, sf_dir):
    return with_label(topics.topic_sizes(_fixture_topics(spark, sf_dir)))


def _fixture_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = slicing.with_slice(I.documents(spark, sf_dir).select("doc_id", "published"), "monthly")
    return docs.select("slice", "doc_id", I.fixture_topic().alias("topic"))


@query
def a18_ctfidf(spark, sf_dir):
    scores = topics.class_tfidf(I.topic_bag(spark, sf_dir))
    return with_label(scores.select("slice", "topic", "term", "tf", r6("score").alias("score")))


def _fixture_terms(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    return topics.topic_terms(topics.class_tfidf(I.topic_bag(spark, sf_dir)), n)


@query
def w4_topic_terms(spark, sf_dir):
    terms = _fixture_terms(spark, sf_dir)
    return with_label(
        terms.select("slice", "topic", F.col("rank").cast("long").alias("rank"), "term", r6("score").alias("score"))
    )


@query
def w7_number_topics(spark, sf_dir):
    clusters = slicing.with_slice(I.documents(spark, sf_dir), "monthly").select(
        "slice", "doc_id", F.when(F.col("authors") != "src0", F.hash("authors").cast("long")).alias("cluster")
    )
    return topics.number_topics(clusters, 5).select("doc_id", F.col("topic").cast("long").alias("topic"))


def _weighted(spark: SparkSession, sf_dir: str) -> K.WeightedBags:
    return K.weighted_bags(_bag(spark, sf_dir))


@query
def w8_representative_docs(spark, sf_dir):
    reps = topics.representative_docs(_weighted(spark, sf_dir), _fixture_topics(spark, sf_dir))
    return with_label(
        reps.select("slice", "topic", F.col("rank").cast("long").alias("rank"), "doc_id", r6("similarity").alias("similarity"))
    )


@query
def m11_topic_info(spark, sf_dir):
    labels, weighted = _fixture_topics(spark, sf_dir), _weighted(spark, sf_dir)
    # the stored bags serve both: texts are cleaned and counted once
    terms = topics.topic_terms(topics.class_tfidf(weighted.bag.withColumn("topic", I.fixture_topic())))
    info = topics.topic_info(labels, terms, topics.representative_docs(weighted, labels))
    return with_label(
        info.select(
            "slice", "topic", "count", "name", F.array_join("representation", " ").alias("representation"),
            F.array_join(F.col("representative_docs").cast("array<string>"), " ").alias("representative_docs"),
        )
    )


@query
def m12_document_topics(spark, sf_dir):
    rows = topics.document_topics(_weighted(spark, sf_dir), _fixture_topics(spark, sf_dir))
    return rows.select("doc_id", "topic", r6("probability").alias("probability"))


@query
def m8_reduce_topics(spark, sf_dir):
    weights = _weighted(spark, sf_dir)
    reduced = topics.reduce_topics(weights, _fixture_topics(spark, sf_dir), 3)
    return reduced.select("doc_id", F.col("topic").cast("long").alias("topic"))


# ---- density topics ----


@query
def j11_core_documents(spark, sf_dir):
    return density.core_documents(_weighted(spark, sf_dir), DENSITY).select("doc_id")


@query
def j11_cosine_links(spark, sf_dir):
    """How many documents of its month a document is similar to, and its class of similar documents."""
    return similarity.cosine_links(_weighted(spark, sf_dir), DENSITY.cosine).select("doc_id", "n_links", "class_id")


@query
def m7_density_topics(spark, sf_dir):
    docs = slicing.with_slice(I.documents(spark, sf_dir), "monthly")
    labels = density.density_topics(docs, _weighted(spark, sf_dir), DENSITY)
    return labels.select("doc_id", F.col("topic").cast("long").alias("topic"))


@query
def m7_cluster_hierarchy(spark, sf_dir):
    """Topics that are stable over all distances, with the membership that the hierarchy gives."""
    docs = slicing.with_slice(I.documents(spark, sf_dir), "monthly")
    labels = hierarchy.hierarchical_topics(docs, _weighted(spark, sf_dir), HIERARCHY)
    return labels.select("doc_id", F.col("topic").cast("long").alias("topic"), r6("probability").alias("probability"))


# ---- trend and positions ----


def _trend_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic terms in which the two commonest words read "language" and "model" in some slices."""
    terms = _fixture_terms(spark, sf_dir)
    word = (
        F.when(F.col("term").isin("the", "de"), "language")
        .when(F.col("term").isin("of", "la"), "model")
        .otherwise(F.col("term"))
    )
    return terms.withColumn("term", word)


@query
def p19_flagged_topics(spark, sf_dir):
    return with_label(trend.flagged_topics(_trend_terms(spark, sf_dir), "on th|language model|ou de"))


@query
def a10_topic_ids(spark, sf_dir):
    return with_label(_fixture_topics(spark, sf_dir).select("slice", "topic").distinct())


@query
def a11_topic_text(spark, sf_dir):
    return with_label(trend.topic_text(_fixture_terms(spark, sf_dir)))


def _sourced_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of which some occur in most weeks and some in few."""
    docs = slicing.with_slice(I.documents(spark, sf_dir).select("doc_id", "published"), "weekly")
    rare = 10 + F.dayofyear("published") % 20
    topic = F.when(F.col("doc_id") % 3 == 0, rare).otherwise(F.col("doc_id") % 4 - 1).cast("int")
    return docs.select("slice", "doc_id", topic.alias("topic"))


@query
def a12_presence(spark, sf_dir):
    return trend.topic_presence(trend.topic_counts(_sourced_topics(spark, sf_dir)))


@query
def a13_stable(spark, sf_dir):
    labels = _sourced_topics(spark, sf_dir)
    return trend.stable_topics(trend.counted_slices(labels, labels), labels)


@query
def j8_counted_slices(spark, sf_dir):
    """Only January to April have a topic result; the other slices are left out."""
    labels = _fixture_topics(spark, sf_dir)
    known = labels.where(F.month("slice") <= 4)
    return with_label(trend.counted_slices(labels, known))


@query
def a14_flagged_ids(spark, sf_dir):
    return trend.flagged_topics(_trend_terms(spark, sf_dir), "on th|language model|ou de").select("topic").distinct()


@query
def a15_topic_counts(spark, sf_dir):
    return with_label(trend.topic_counts(_sourced_topics(spark, sf_dir)), "weekly")


@query
def j7_baseline_topics(spark, sf_dir):
    labels = _fixture_topics(spark, sf_dir)
    flagged = trend.flagged_topics(_fixture_terms(spark, sf_dir), "whthti")
    return trend.baseline_topics(trend.stable_topics(trend.topic_counts(labels), labels), flagged)


@query
def m15_trend_summary(spark, sf_dir):
    terms = materialise(_trend_terms(spark, sf_dir), "terms")
    return with_label(trend.trend_summary(terms, _fixture_topics(spark, sf_dir), "en|st"))


def _halves() -> list[Column]:
    """Two coordinates from all 64: the sums of the first and of the second half of a vector."""

    def total(part: Column) -> Column:
        return F.round(F.aggregate(part, F.lit(0.0), lambda a, x: a + x.cast("double")), 9)

    return [total(F.slice("embedding", 1, 32)), total(F.slice("embedding", 33, 32))]


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored coordinates of the documents, from ``embeddings``; documents beyond them have none."""
    x, y = _halves()
    xy = I.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), x.alias("x"), y.alias("y"))
    return _fixture_topics(spark, sf_dir).join(xy, "doc_id", "left")


@query
def j9_attach_layout(spark, sf_dir):
    return _layout(spark, sf_dir).select("doc_id", "topic", r6("x").alias("x"), r6("y").alias("y"))


@query
def p23_complete_positions(spark, sf_dir):
    rows = trend.topic_positions(_fixture_terms(spark, sf_dir), _layout(spark, sf_dir))
    return with_label(rows.groupBy("slice", "topic").agg(F.count("*").alias("n"), r6(F.min("x")).alias("x"), r6(F.max("y")).alias("y")))


@query
def m14_topic_positions(spark, sf_dir):
    rows = trend.topic_positions(_fixture_terms(spark, sf_dir), _layout(spark, sf_dir))
    return with_label(
        rows.select("slice", "topic", "keyword", r6("score").alias("score"), r6("x").alias("x"), r6("y").alias("y"))
    )


# ---- fitted models: what SQL can state about their results ----


def _lda(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return lda.lda_timesliced(I.sliced(spark, sf_dir), LDA_SETTINGS, I.STOPWORDS)


@query
def m2_lda_timesliced(spark, sf_dir):
    """Every rank of every topic, whether its term is in the slice's vocabulary, how many words the slice's model shares out
    among its topics, and whether the bound on the likelihood has risen."""
    fit = lda.fit_timesliced(I.sliced(spark, sf_dir), LDA_SETTINGS, I.STOPWORDS)
    vocabulary = K.vocabulary(K.bags(I.sliced(spark, sf_dir), I.STOPWORDS), LDA_SETTINGS.max_features)
    known = vocabulary.select("slice", "term", F.lit(True).alias("known"))
    rows = fit.topics.join(known, ["slice", "term"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    distinct = rows.groupBy("slice", "topic").agg(F.count_distinct("term").alias("n_terms"))
    # weights are the prior 1 / k and the words given to a topic
    words = fit.weights.groupBy("slice").agg(F.round(F.sum(F.aggregate("weights", F.lit(-1.0), lambda a, w: a + w)), 6).alias("n_words"))
    ends = fit.bounds.groupBy("slice").agg((F.max_by("bound", "iteration") > F.min_by("bound", "iteration")).alias("improved"))
    rows = rows.join(distinct, ["slice", "topic"]).join(words, "slice").join(ends, "slice")
    return with_label(rows.select("slice", *[F.col(c).cast("long").alias(c) for c in ("topic", "rank", "n_terms")], "known", "n_words", "improved"))


@query
def m3_lda_mixture(spark, sf_dir):
    """The wide mixtures: every document, the sum of its columns, whether they are shares, and whether one topic stands out."""
    _, mixtures = _lda(spark, sf_dir)
    wide = lda.wide_mixtures(mixtures, LDA_SETTINGS.n_topics)
    columns = [F.col(f"Topic {i}") for i in range(LDA_SETTINGS.n_topics)]
    total, least, most = sum(columns[1:], columns[0]), F.least(*columns), F.greatest(*columns)
    return wide.select("doc_id", F.round(total, 6).alias("total"), (least >= 0).alias("shares"), (most > 1.001 / LDA_SETTINGS.n_topics).alias("uneven"))


@query
def w3_lda_topic_strings(spark, sf_dir):
    found, _ = _lda(spark, sf_dir)
    words = F.split("top_keywords", ", ")
    rows = lda.topic_strings(found).select("slice", "topic", F.size(words).cast("long").alias("n_words"))
    return with_label(rows)


@query
def m4_lda_corpus(spark, sf_dir):
    """Mean shares of every slice: how many topics, and their sum over the documents."""
    _, mixtures = lda.lda_corpus(I.sliced(spark, sf_dir), LDA_SETTINGS, I.STOPWORDS)
    means = lda.mean_mixture(mixtures).groupBy("slice").agg(F.count("*").alias("n_topics"), F.round(F.sum("share"), 6).alias("total"))
    return with_label(means)


def hashed_encoder(dim: int = 32):
    """A small deterministic encoder for the query: words signed and placed by digits of their MD5."""

    def make():
        import hashlib

        import numpy as np

        def encode(texts):
            out = np.zeros((len(texts), dim), dtype="float32")
            for row, text in enumerate(texts):
                for word in text.split():
                    digits = hashlib.md5(word.encode()).hexdigest()
                    out[row, int(digits[:2], 16) % dim] += 1.0 if digits[2] in "01234567" else -1.0
            return out

        return encode

    return make


@query
def m5_embed_documents(spark, sf_dir):
    vectors = embedding.embed_documents(I.sliced(spark, sf_dir), hashed_encoder())
    rows = vectors.select("doc_id", F.posexplode("embedding").alias("at", "value"))
    return rows.select("doc_id", F.col("at").cast("long").alias("at"), F.round(F.col("value").cast("double"), 4).alias("value"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.make_timestamp(F.lit(2024), F.col("label") % 6 + 1, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return I.table(spark, sf_dir, "embeddings").select(
        month.alias("slice"), F.col("vec_id").alias("doc_id"), "embedding"
    )


def _axes(vectors: DataFrame, coordinates: DataFrame, dim: int) -> DataFrame:
    """(a, b, n, mean, covariance, ordered, spread): axes of a reduction are centred and uncorrelated, none spreads more than the one
    before it, and together they spread at least as much as the ``dim`` most spread entries of the vectors."""
    at = [F.element_at("embedding", i + 1).cast("double") for i in range(dim)]
    pairs = [(i, j) for i in range(dim) for j in range(i + 1, dim)]
    entries = vectors.select(F.posexplode("embedding").alias("at", "x")).groupBy("at").agg(F.var_pop(F.col("x").cast("double")).alias("v"))
    least = sum(r["v"] for r in entries.orderBy(F.desc("v")).limit(dim).collect())
    sums = coordinates.agg(
        F.count("*").alias("n"),
        *[F.covar_pop(at[i], at[j]).alias(f"c{i}_{j}") for i, j in pairs],
        *[F.var_pop(at[i]).alias(f"v{i}") for i in range(dim)],
        *[F.avg(at[i]).alias(f"m{i}") for i in range(dim)],
    )
    spread = sum((F.col(f"v{i}") for i in range(1, dim)), F.col("v0")) >= least - 1e-9
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("a"), F.lit(j).cast("long").alias("b"), F.col("n"), (F.round(F.col(f"m{i}"), 6) + 0.0).alias("mean"),
            (F.round(F.col(f"c{i}_{j}"), 6) + 0.0).alias("covariance"), (F.col(f"v{i}") >= F.col(f"v{j}")).alias("ordered"), spread.alias("spread"),
        )
        for i, j in pairs
    ]
    return sums.select(F.inline(F.array(*rows)))


@query
def m6_reduce_dimensions(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    return _axes(vectors, embedding.reduce_dimensions(vectors, 5), 5)


@query
def m7_grid_density_topics(spark, sf_dir):
    vectors = I.table(spark, sf_dir, "embeddings").select(
        F.make_timestamp(F.lit(2024), F.col("label") % 6 + 1, F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("slice"),
        F.col("vec_id").alias("doc_id"),
        F.array(*_halves()).alias("embedding"),
    )
    found = grid_density.grid_density_topics(vectors, GRID)
    return found.select("doc_id", F.col("topic").cast("long").alias("topic"))


@query
def m9_kmeans_topics(spark, sf_dir):
    """Sizes of a slice's topics: all documents are in one, and the numbers follow the sizes. ``one`` is the cost of a single
    cluster, below which k-means must stay."""
    vectors = _vectors(spark, sf_dir)
    clusters, fit = kmeans.kmeans_clusters(vectors, 4)
    labels = topics.number_topics(clusters)
    sizes = labels.groupBy("slice", "topic").agg(F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("topic", "n")))
    per_slice = sizes.groupBy("slice").agg(F.sum("n").alias("n"), F.count("*").alias("k"), listed.alias("l"), F.min("topic").alias("low"))
    counts = F.transform("l", lambda x: x["n"])
    ordered = F.sort_array(counts, asc=False) == counts
    sums = vectors.select("slice", F.posexplode(V.l2_normalise(F.col("embedding"))).alias("at", "x")).groupBy("slice", "at").agg(F.sum("x").alias("s"))
    one = sums.groupBy("slice").agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("length"))
    starts = [r["slice"] for r in vectors.select("slice").distinct().orderBy("slice").collect()]
    costs = spark.createDataFrame([(s, fit.costs[-1][i]) for i, s in enumerate(starts)], "slice timestamp, cost double")
    rows = per_slice.join(one, "slice").join(costs, "slice").withColumn("one", F.col("n") - F.col("length"))
    return with_label(
        rows.select(
            "slice", "n", (F.col("k") <= 4).alias("at_most_4"), (ordered & (F.col("low") == 0)).alias("ordered"),
            F.round("one", 4).alias("one"), (F.col("cost") < F.col("one")).alias("tighter"),
        )
    )


@query
def m13_layout_2d(spark, sf_dir):
    vectors = materialise(embedding.dense_tfidf(_bag(spark, sf_dir)), "vectors")
    return _axes(vectors, embedding.layout_2d(vectors).withColumn("embedding", F.array("x", "y")), 2)


@query
def m16_cluster_timesliced(spark, sf_dir):
    """The whole clustering run with its layout: topics, and by topic the rows of the other tables."""
    config = RunConfig(eps=DENSITY.eps, min_samples=DENSITY.min_samples, min_cluster_size=DENSITY.min_cluster_size, umap_reduce=True)
    found = runs.cluster_timesliced(I.cleaned(spark, sf_dir), config)
    keys = ["slice", "topic"]
    counts = [
        found["topic_terms"].groupBy(*keys).agg(F.count("*").alias("n_terms")),
        found["positions"].groupBy(*keys).agg(F.count_distinct("keyword").alias("n_positions")),
        found["doc_topics"].groupBy(*keys).agg(F.count("*").alias("n_docs"), F.count("x").alias("n_placed")),
        found["vectors"].join(found["doc_topics"].select("slice", "doc_id", "topic"), ["slice", "doc_id"]).groupBy(*keys).agg(F.count("*").alias("n_vectors")),
    ]
    rows = found["topic_info"]
    for part in counts:
        rows = rows.join(part, keys, "left")
    columns = ("n_terms", "n_positions", "n_docs", "n_placed", "n_vectors")
    return with_label(rows.select("slice", F.col("topic").cast("long").alias("topic"), "count", "name", *columns))


# ---- sources and sinks: written to the shared folder, then read back ----


@query
def s1_read_raw(spark, sf_dir):
    path = work_path(spark, "raw")
    docs = I.documents(spark, sf_dir).withColumn("id", F.col("doc_id").cast("string"))
    assigned = intervals.assign_intervals(docs, intervals.time_ranges_of(docs, "monthly"))
    writers.write_raw(assigned, path)
    return readers.read_raw(spark, path).select("id", "title", "summary", "published", "authors", "link")


@query
def s2_read_staged(spark, sf_dir):
    path = work_path(spark, "staged")
    orders = I.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("string").alias("published")
    )
    writers.write_staged(staging.stage(orders), path)
    return readers.read_staged(spark, path).select("id", "published", "year", "month", "year_month")


@query
def s3_metadata(spark, sf_dir):
    path = work_path(spark, "metadata")
    writers.write_metadata(I.documents(spark, sf_dir).withColumn("id", F.col("doc_id")), path)
    return readers.read_metadata(spark, path)


@query
def s4_corpus_lines(spark, sf_dir):
    path = work_path(spark, "corpus")
    writers.write_corpus(I.cleaned(spark, sf_dir), path)
    return readers.read_corpus(spark, path)


def _word_list(spark: SparkSession, sf_dir: str) -> str:
    """A stopword file: the names of the parts of the world, with blanks and empty lines."""
    path = work_path(spark, "stopwords")
    names = I.table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("  "), "n_name", F.lit(" \n")).alias("line"))
    lines = names.groupBy().agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "line"))).alias("l"))
    lines.select(F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("value")).write.text(path)
    return path


@query
def s5_stopwords(spark, sf_dir):
    return readers.read_stopwords(spark, _word_list(spark, sf_dir))


@query
def w6_first_stopwords(spark, sf_dir):
    return readers.read_stopwords(spark, _word_list(spark, sf_dir), 7)


def _rename_part(spark: SparkSession, folder: str, target: str) -> None:
    """Give the single file of a folder a name of its own."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.rename(files.globStatus(path(f"{folder}/part-*"))[0].getPath(), path(target))


@query
def s6_slice_results(spark, sf_dir):
    path = work_path(spark, "results")
    counts = with_label(trend.topic_counts(_fixture_topics(spark, sf_dir)))
    # one file per slice, named after it, as other tools leave them
    for label in [r["slice_label"] for r in counts.select("slice_label").distinct().collect()]:  # calendar bound
        writers.write_csv(counts.where(F.col("slice_label") == label).coalesce(1).drop("slice_label"), f"{path}/parts/{label}")
        _rename_part(spark, f"{path}/parts/{label}", f"{path}/doc_counts_{label}.csv")
    rows = readers.read_slice_results(spark, path, "topic int, doc_count long")
    return rows.select("slice_label", "topic", "doc_count")


@query
def s9_keywords_csv(spark, sf_dir):
    path = work_path(spark, "keywords")
    writers.write_csv(with_label(K.keyword_frequency(_bag(spark, sf_dir), VOCABULARY)), path)
    schema = "slice_label string, term string, frequency long"
    return spark.read.schema(schema).options(**readers.CSV_OPTIONS).csv(path)


@query
def s9_topics_csv(spark, sf_dir):
    """Topics as text: a name and the joined words."""
    path = work_path(spark, "topics")
    writers.write_csv(with_label(lda.topic_strings(_fixture_terms(spark, sf_dir))), path)
    return spark.read.schema("slice_label string, topic string, top_keywords string").options(**readers.CSV_OPTIONS).csv(path)


@query
def s9_document_topics_csv(spark, sf_dir):
    """Document mixtures with one column for each topic; the first entries of the vectors stand for shares."""
    path = work_path(spark, "mixtures")
    shares = F.transform(F.slice("embedding", 1, 3), lambda x: F.round(x.cast("double"), 6))
    writers.write_csv(with_label(lda.wide_mixtures(_vectors(spark, sf_dir).withColumn("mixture", shares), 3)), path)
    schema = "slice_label string, doc_id long, `Topic 0` double, `Topic 1` double, `Topic 2` double"
    return spark.read.schema(schema).options(**readers.CSV_OPTIONS).csv(path)


@query
def s10_keywords_parquet(spark, sf_dir):
    path = work_path(spark, "keywords")
    writers.write_parquet(with_label(K.keyword_frequency(_bag(spark, sf_dir), VOCABULARY)), path, partition_by=["slice_label"])
    return spark.read.schema("term string, frequency long, slice_label string").parquet(path)


@query
def s11_embeddings(spark, sf_dir):
    path = work_path(spark, "vectors")
    writers.write_embeddings(_vectors(spark, sf_dir), path)
    back = spark.read.parquet(path)
    values = F.transform("embedding", lambda x: F.floor(x.cast("double") * 10000).cast("string"))
    return back.select("doc_id", F.date_format("slice", "yyyy-MM").alias("slice_label"), F.md5(F.array_join(values, ",")).alias("digest"))


@query
def s12_trend_csv(spark, sf_dir):
    path = work_path(spark, "trend")
    writers.write_csv(m15_trend_summary(spark, sf_dir), path)
    schema = "slice_label string, topic int, label string, doc_count long"
    return spark.read.schema(schema).options(**readers.CSV_OPTIONS).csv(path)


@query
def s12_positions_csv(spark, sf_dir):
    path = work_path(spark, "positions")
    writers.write_csv(m14_topic_positions(spark, sf_dir), path)
    schema = "slice_label string, topic int, keyword string, score double, x double, y double"
    return spark.read.schema(schema).options(**readers.CSV_OPTIONS).csv(path)


@query
def s13_result_layout(spark, sf_dir):
    base = work_path(spark, "layout")
    counts = with_label(trend.topic_counts(_fixture_topics(spark, sf_dir)))
    mark = fingerprint(RESULT_CONFIG)
    for model in ("tfidf", "clusters"):
        path = writers.write_results(counts, base, "job", mark, model, "doc_counts")
    back = spark.read.schema("topic int, doc_count long, model string, config_hash string, slice_label string")
    return back.parquet(path)
