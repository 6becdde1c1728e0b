"""Weights without shuffling rows of terms: joins by frequency, weighted bags, short stopword tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from topictide.catalog import inputs
from topictide.catalog.queries import QUERIES
from topictide.operators import keywords as K
from topictide.operators import topics

JAN, FEB = datetime(2024, 1, 1), datetime(2024, 2, 1)
# document 1 comes twice, document 4 has no token
ROWS = [(JAN, 1, "aa bb cc cc"), (JAN, 1, "aa dd"), (JAN, 2, "aa bb ee"), (JAN, 3, "aa ff"), (JAN, 4, ""), (FEB, 1, "aa gg"), (FEB, 5, "gg hh")]
LABELS = [(JAN, 1, 0), (JAN, 2, 0), (JAN, 3, 1), (JAN, 4, -1), (FEB, 1, 0), (FEB, 5, 1), (FEB, 9, 1)]


def _docs(spark):
    return spark.createDataFrame(ROWS, "slice timestamp, doc_id long, text string")


@pytest.mark.parametrize("most", [0, 2, 100])
def test_every_row_meets_its_key_once(spark, most):
    table = spark.createDataFrame([("a", 900, 1.0), ("b", 30, 2.0), ("c", 30, 3.0), ("d", 1, 4.0)], "term string, df long, idf double")
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, "c"), (4, "d"), (5, "x"), (6, None)], "doc_id long, term string")
    found = K.join_frequent(rows, table, ["term"], "df", most)
    assert sorted((r["doc_id"], r["idf"]) for r in found.collect()) == [(1, 1.0), (1, 2.0), (2, 2.0), (3, 3.0), (4, 4.0)]


def test_only_rows_of_rare_keys_are_shuffled(spark):
    table = spark.createDataFrame([("a", 900, 1.0), ("d", 1, 4.0)], "term string, df long, idf double")
    rows = spark.range(10).select("id", F.lit("a").alias("term"))
    plan = K.join_frequent(rows, table, ["term"], "df", 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2, plan


def test_weights_are_those_of_a_window_over_the_document(spark, monkeypatch):
    monkeypatch.setattr(K.join_frequent, "__defaults__", (3,))
    whole = K.tfidf_documents(K.bags(_docs(spark)))
    windowed = K.tfidf_documents(K.bags(_docs(spark)), 1000)
    key = lambda r: (r["slice"], r["doc_id"], r["term"], r["tf"], round(r["weight"], 9))
    assert sorted(map(key, whole.collect())) == sorted(map(key, windowed.collect()))
    by_slice = whole.groupBy("slice", "term").agg(F.sum("weight").alias("score")).collect()
    scores = {(r["slice"], r["term"]): r["score"] for r in K.tfidf_slices(K.bags(_docs(spark))).collect()}
    assert scores == pytest.approx({(r["slice"], r["term"]): r["score"] for r in by_slice})


def test_topics_of_bags_are_those_of_rows(spark, monkeypatch):
    labels = spark.createDataFrame(LABELS, "slice timestamp, doc_id long, topic int")
    bag = K.bags(_docs(spark))
    rows = K.tfidf_documents(bag).cache()
    monkeypatch.setattr(K.join_frequent, "__defaults__", (3,))
    for step in (topics.representative_docs, topics.document_topics, lambda w, t: topics.reduce_topics(w, t, 1)):
        both = [sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in step(w, labels).collect()) for w in (rows, K.weighted_bags(bag))]
        assert both[0] == both[1] and both[0]


def test_short_stopword_table_shuffles_no_text(spark, monkeypatch):
    stop = spark.createDataFrame([("The",), ("SAT",), (" cat",), (None,)], "word string")
    docs = spark.createDataFrame([(JAN, 1, "the cat  sat"), (JAN, 1, None), (JAN, None, "sat")], "slice timestamp, doc_id long, text string")
    found = K.without_stopwords(docs, stop)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = [(JAN, 1, "cat"), (JAN, 1, None), (JAN, None, "")]
    assert sorted(map(str, found.collect())) == sorted(map(str, spark.createDataFrame(want, docs.schema).collect()))
    monkeypatch.setattr(K, "STOPWORD_SET", 1)
    long = K.without_stopwords(docs, stop)
    assert "Join" in long._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, long.collect())) == sorted(map(str, found.collect()))


def test_topic_info_cleans_and_counts_texts_once(spark, sf_dir, monkeypatch):
    calls, sliced = [], inputs.sliced
    monkeypatch.setattr(inputs, "sliced", lambda *args: calls.append(args) or sliced(*args))
    assert QUERIES["m11_topic_info"](spark, sf_dir).count() > 0
    assert len(calls) == 1
