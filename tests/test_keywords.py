import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from topictide.operators import keywords as K
from topictide.operators import topics, trend

JAN = datetime(2024, 1, 1)


def bag(spark, *texts):
    rows = [(JAN, i, t) for i, t in enumerate(texts)]
    return K.bags(spark.createDataFrame(rows, "slice timestamp, doc_id long, text string"))


def test_hand_computed_tfidf(spark):
    weights = {(r["doc_id"], r["term"]): r["weight"] for r in K.tfidf_documents(bag(spark, "aa bb", "aa cc cc")).collect()}
    rare = math.log(3 / 2) + 1
    first, second = math.hypot(1, rare), math.hypot(1, 2 * rare)
    assert weights[0, "aa"] == pytest.approx(1 / first) and weights[0, "bb"] == pytest.approx(rare / first)
    assert weights[1, "cc"] == pytest.approx(2 * rare / second)


def test_plain_tfidf(spark):
    weights = {(r["doc_id"], r["term"]): r["weight"] for r in K.tfidf_documents(bag(spark, "aa bb", "aa cc cc", ""), variant="plain").collect()}
    assert weights[1, "cc"] == pytest.approx(2 / 3 * math.log(3 / 2)) and weights[0, "aa"] == pytest.approx(0.0)
    with pytest.raises(ValueError):
        K.tfidf_documents(bag(spark, "aa"), variant="other")


def test_plain_scores_of_slices(spark):
    docs = bag(spark, "aa bb", "aa cc cc", "", "cc dd dd ee")
    weights = K.tfidf_documents(docs, variant="plain").groupBy("slice", "term").agg(F.sum("weight").alias("score"))
    wanted = {r["term"]: pytest.approx(r["score"]) for r in weights.collect()}
    scores = K.tfidf_slices(docs, variant="plain")
    assert {r["term"]: r["score"] for r in scores.collect()} == wanted
    assert {r["term"] for r in K.tfidf_slices(docs, 2, "plain").collect()} == {"aa", "cc"}
    for rows in (scores, K.tfidf_documents(docs, variant="plain")):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < plan.index("Generate explode") < plan.index("aggregate(")  # a length is added up below the explode, once per document


def test_rows_have_unit_length(spark):
    rows = K.tfidf_documents(bag(spark, "aa bb cc", "bb cc dd dd", "ee"), 3)
    norms = rows.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert all(r["n"] == pytest.approx(1) for r in norms)


def test_vocabulary_tie_takes_the_smaller_term(spark):
    assert [r["term"] for r in K.vocabulary(bag(spark, "bb aa cc"), 2).orderBy("term").collect()] == ["aa", "bb"]


def test_slice_without_token_has_no_row(spark):
    assert K.tfidf_slices(bag(spark, "a", "")).count() == 0


def test_empty_documents(spark):
    docs = spark.createDataFrame([(JAN, 0, "the"), (JAN, 1, "the cat")], "slice timestamp, doc_id long, text string")
    row = K.empty_documents(docs, ["the"]).first()
    assert (row["n_docs"], row["n_empty"]) == (2, 1)


def test_large_vocabulary_is_joined_not_broadcast(spark, monkeypatch):
    texts = ["aa bb cc", "bb cc dd", "dd ee"]
    want = sorted(map(tuple, K.tfidf_slices(bag(spark, *texts), 3).collect()))
    monkeypatch.setattr(K, "BROADCAST_ROWS", 1)
    assert sorted(map(tuple, K.tfidf_slices(bag(spark, *texts), 3).collect())) == want


# ---- trend ----

MONTHS = [datetime(2024, m, 1) for m in range(1, 6)]


def tables(spark, terms, docs):
    t = [(s, topic, rank, w, 1.0) for s, topic, words in terms for rank, w in enumerate(words, 1)]
    return (
        spark.createDataFrame(t, "slice timestamp, topic int, rank int, term string, score double"),
        spark.createDataFrame(docs, "slice timestamp, doc_id long, topic int"),
    )


def summary(spark, terms, docs):
    return sorted((r["slice"].month, r["topic"], r["label"], r["doc_count"]) for r in trend.trend_summary(*tables(spark, terms, docs)).collect())


def everywhere(topic, months, words=("plain",)):
    return [(m, topic, list(words)) for m in months], [(m, 100 * topic + i, topic) for i, m in enumerate(months)]


def test_trend_cases(spark):
    terms, docs = [], []
    for topic, months in ((1, MONTHS[:3]), (2, MONTHS[:2]), (-1, MONTHS)):
        t, d = everywhere(topic, months)
        terms, docs = terms + t, docs + d
    t, d = everywhere(3, MONTHS)
    t[0] = (MONTHS[0], 3, ["language", "model"])
    got = summary(spark, terms + t, docs + d)
    assert [r for r in got if r[1] == 1] == [(m, 1, "baseline", 1) for m in (1, 2, 3)]
    assert not [r for r in got if r[1] == 2]
    assert [r for r in got if r[1] == 3] == [(1, 3, "llm_related", 1)]
    assert len([r for r in got if r[1] == -1]) == 5


@pytest.mark.parametrize("words,flagged", [(["language", "model"], True), (["model", "language"], False), (["Transformers"], True), (["GPT"], True)])
def test_flags(spark, words, flagged):
    t, _ = tables(spark, [(MONTHS[0], 0, words)], [(MONTHS[0], 0, 0)])
    assert (trend.flagged_topics(t).count() == 1) == flagged


def test_slices_without_counterpart(spark):
    # topics but no documents: counts toward the threshold; documents but no topics: ignored
    terms, docs = everywhere(1, MONTHS[:2])
    extra = [(m, 9, ["other"]) for m in MONTHS[2:]]
    assert summary(spark, terms + extra, docs) == []
    assert summary(spark, terms, docs + [(MONTHS[4], 5, 1)]) == [(1, 1, "baseline", 1), (2, 1, "baseline", 1)]


def test_single_slice_makes_everything_baseline(spark):
    terms, docs = everywhere(1, MONTHS[:1])
    assert summary(spark, terms, docs) == [(1, 1, "baseline", 1)]


def test_topic_numbers_by_size(spark):
    rows = [(JAN, i, c) for i, c in enumerate([7, 7, 5, 5, 5, None, 3])]
    got = topics.number_topics(spark.createDataFrame(rows, "slice timestamp, doc_id long, cluster long"), 2)
    assert [r["topic"] for r in got.orderBy("doc_id").collect()] == [1, 1, 0, 0, 0, -1, -1]


def test_membership_without_topic_is_null(spark):
    b = bag(spark, "aa bb", "cc dd")
    labels = b.select("slice", "doc_id", F.lit(-1).alias("topic"))
    rows = topics.document_topics(K.tfidf_documents(b), labels).collect()
    assert [r["probability"] for r in rows] == [None, None]


def test_class_tfidf_shuffles_the_counts_of_topics_once_more(spark):
    rows = [(s, d, d % 3 if d != 4 else None, [(t, n)]) for s in (1, 2) for d, t, n in ((1, "a", 2), (1, "b", 1), (2, "a", 5), (3, "c", 4), (4, "a", 9), (5, "b", 3))]
    bag = spark.createDataFrame(rows, "slice long, doc_id long, topic int, terms array<struct<term:string,tf:long>>")
    scores = topics.class_tfidf(bag)
    counts = {(1, "a"): 2, (1, "b"): 1, (2, "a"): 5, (2, "b"): 3, (0, "c"): 4}
    words = {k: sum(n for (t, _), n in counts.items() if t == k) for k in range(3)}
    want = {
        (s, k, t): round(n / words[k] * math.log(1 + sum(words.values()) / 3 / sum(m for (_, u), m in counts.items() if u == t)), 9)
        for s in (1, 2) for (k, t), n in counts.items()
    }
    assert {(r["slice"], r["topic"], r["term"]): round(r["score"], 9) for r in scores.collect()} == want
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert not any("Join" in line and "term" in line.split("Join", 1)[1].split("]")[0] for line in plan.splitlines())
