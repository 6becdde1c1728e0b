import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from topictide.operators import embedding, intervals, kmeans, lda
from topictide.plans import runs
from topictide.plans.config import RunConfig, fingerprint
from topictide.sources import readers, writers
from topictide.streaming.ingest import stage_new_files

JAN, FEB = datetime(2024, 1, 1), datetime(2024, 2, 1)


def two_slices(spark, n=12):
    texts = ["cat dog cat mouse", "tax bank money tax", "cat mouse dog dog", "bank tax loan money"]
    rows = [((JAN, FEB)[i % 2], i, texts[i % 4] if i % 2 else texts[(i // 2) % 4]) for i in range(n)]
    return spark.createDataFrame(rows, "slice timestamp, doc_id long, text string")


def test_lda(spark):
    settings = lda.LdaSettings(n_topics=2, max_features=10)
    topics, mixtures = lda.lda_timesliced(two_slices(spark), settings)
    rows = mixtures.collect()
    assert len(rows) == 12 and all(len(r["mixture"]) == 2 and sum(r["mixture"]) == pytest.approx(1) for r in rows)
    assert {(r["slice"], r["topic"]) for r in topics.collect()} == {(s, t) for s in (JAN, FEB) for t in (0, 1)}
    again, _ = lda.lda_timesliced(two_slices(spark), settings)
    key = lambda r: (r["slice"], r["topic"], r["rank"])
    assert [r["term"] for r in sorted(topics.collect(), key=key)] == [r["term"] for r in sorted(again.collect(), key=key)]
    assert lda.wide_mixtures(mixtures, 2).columns == ["slice", "doc_id", "Topic 0", "Topic 1"]
    shares = lda.mean_mixture(mixtures).groupBy("slice").agg(F.sum("share").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1) for r in shares)


def test_lda_skips_a_slice_without_tokens(spark):
    docs = two_slices(spark, 4).union(spark.createDataFrame([(datetime(2024, 3, 1), 99, "a")], "slice timestamp, doc_id long, text string"))
    topics, _ = lda.lda_timesliced(docs, lda.LdaSettings(n_topics=2, max_features=5, max_iter=2))
    assert {r["slice"] for r in topics.collect()} == {JAN, FEB}


def letter_encoder():
    """A closure, so that the workers need not import this test."""

    def encoder():
        import numpy

        return lambda texts: numpy.array([[t.count("a"), t.count("o"), len(t)] for t in texts], dtype="float32")

    return encoder


def test_encoder_gives_unit_vectors(spark):
    rows = embedding.embed_documents(two_slices(spark), letter_encoder(), 5).collect()
    assert len(rows) == 12 and all(np.linalg.norm(r["embedding"]) == pytest.approx(1, abs=1e-6) for r in rows)


def test_kmeans(spark):
    v = [[1.0, 0.01], [1.0, 0.02], [1.0, 0.0], [0.0, 1.0], [0.02, 1.0], [0.0, 0.0]]
    df = spark.createDataFrame([(JAN, i, x) for i, x in enumerate(v)], "slice timestamp, doc_id long, embedding array<double>")
    assert [r["topic"] for r in kmeans.kmeans_topics(df, 2).orderBy("doc_id").collect()] == [0, 0, 0, 1, 1, -1]


def test_layout_is_repeatable(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(JAN, i, rng.normal(size=5).tolist()) for i in range(30)], "slice timestamp, doc_id long, embedding array<double>")
    a, b = (sorted(map(tuple, embedding.layout_2d(df).collect())) for _ in range(2))
    assert a == b


def test_csv_round_trip_of_awkward_fields(spark, tmp_path):
    row = ("1", 'a "quoted",\nbroken title', "s, t", "2024-01-03T00:00:00Z", "A, B", "l", datetime(2024, 1, 3))
    docs = spark.createDataFrame([row], "id string, title string, summary string, p string, authors string, link string, published timestamp")
    assigned = intervals.assign_intervals(docs, intervals.time_ranges(spark, 2024, 2024, "weekly"))
    writers.write_raw(assigned, str(tmp_path / "raw"))
    back = readers.read_raw(spark, str(tmp_path / "raw")).collect()
    assert len(back) == 1 and back[0]["title"] == row[1] and back[0]["summary"] == row[2]
    written = writers.written_intervals(spark.read.option("header", "true").csv(str(tmp_path / "raw")))
    assert tuple(written.first()) == (datetime(2024, 1, 1), datetime(2024, 1, 8))


def test_stopword_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("The\n\n of \nAND\n")
    words = lambda top: readers.stopword_list(readers.read_stopwords(spark, str(path), top))
    assert words("all") == ["the", "of", "and"] and words(2) == ["the", "of"] and words(None) == []
    with pytest.raises(AnalysisException):
        readers.read_stopwords(spark, str(tmp_path / "missing.txt")).collect()
    with pytest.raises(ValueError):
        readers.read_stopwords(spark, str(path), "some")


def test_slice_label_from_file_name(spark, tmp_path):
    for label in ("2024-01", "2024-02"):
        (tmp_path / f"doc_topics_{label}.csv").write_text("topic,n\n1,2\n")
    rows = readers.read_slice_results(spark, str(tmp_path), "topic int, n int").collect()
    assert sorted((r["slice_label"], r["topic"]) for r in rows) == [("2024-01", 1), ("2024-02", 1)]


def test_config():
    config = RunConfig.from_dict({"max_results_per_interval": 250, "sampling_freq": "weekly", "device": "gpu"})
    assert config.max_per_interval == 250 and config.extra == {"device": "gpu"} and config.reduce_to is None
    assert fingerprint({"b": 1, "a": 2}) == fingerprint({"a": 2, "b": 1}) and len(fingerprint({})) == 8


def raw_files(spark, tmp_path):
    rows = []
    for i in range(40):
        theme = ["graph node edge path", "cell gene protein tissue", "stock price market trade"][i % 3]
        date = datetime(2024, 1 + i % 2, 1 + i % 20)
        rows.append((str(i), theme, f"{theme} {theme} word{i}", "A", "l", date))
    docs = spark.createDataFrame(rows, "id string, title string, summary string, authors string, link string, published timestamp")
    path = str(tmp_path / "raw")
    writers.write_raw(intervals.assign_intervals(docs, intervals.time_ranges(spark, 2024, 2024, "monthly")), path)
    return path


def test_full_run(spark, tmp_path):
    raw = raw_files(spark, tmp_path)
    config = RunConfig(min_docs_per_slice=5, min_cluster_size=3, lda_n_topics=2, tfidf_max_features=20)
    paths = runs.run_all(spark, raw, str(tmp_path / "out"), config)
    info = spark.read.parquet(paths["topic_info"])
    assert info.where("topic >= 0").count() == 6 and info.select("model").distinct().count() == 1
    doc_topics = spark.read.parquet(paths["doc_topics"])
    assert doc_topics.count() == 40 and doc_topics.where("x is null or probability is null").count() == 0
    assert spark.read.parquet(paths["lda_topics"]).count() > 0
    assert spark.read.parquet(paths["keywords"]).groupBy("slice_label").count().where("count > 20").count() == 0
    assert os.path.isdir(paths["trend"])


def test_run_with_encoder(spark):
    docs = two_slices(spark, 40).withColumn("published", F.col("slice"))
    config = RunConfig(n_topics=2, umap_reduce=False)
    out = runs.cluster_timesliced(docs.drop("slice"), config, letter_encoder())
    assert out["doc_topics"].count() == 40 and out["topic_terms"].where("topic > 1").count() == 0
    auto = RunConfig(umap_reduce=False, reduced_dimensions=2, reduced_eps=0.01, min_samples=2, min_cluster_size=3)
    found = runs.cluster_timesliced(docs.drop("slice"), auto, letter_encoder())
    # four different texts in January, two in February, each of them several times
    assert found["doc_topics"].count() == 40 and found["topic_info"].where("topic >= 0").count() == 6


def test_incremental_staging(spark, tmp_path):
    raw = raw_files(spark, tmp_path)
    args = (spark, raw, str(tmp_path / "staged"), str(tmp_path / "checkpoint"))
    stage_new_files(*args).awaitTermination(120)
    assert spark.read.parquet(args[2]).count() == 40
    more = spark.createDataFrame(
        [("99", "t", "s", "A", "l", datetime(2024, 5, 5))], "id string, title string, summary string, authors string, link string, published timestamp"
    )
    writers.write_raw(intervals.assign_intervals(more, intervals.time_ranges(spark, 2024, 2024, "monthly")), raw)
    stage_new_files(*args).awaitTermination(120)
    assert spark.read.parquet(args[2]).count() == 41


def test_files_are_bounded_by_their_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "FILE_BYTES", 10_000)
    rows = [(f"{i}", "t" * 200, None, "2024-01-01", "a", "l", "2024-01-01", "2024-02-01") for i in range(1000)]
    names = "id string, title string, summary string, published string, authors string, link string, start string, end string"
    df = spark.createDataFrame(rows, names)
    df = df.withColumns({"start": F.col("start").cast("timestamp"), "end": F.col("end").cast("timestamp")})
    writers.write_raw(df, str(tmp_path / "raw"))
    sizes = [f.stat().st_size for f in (tmp_path / "raw").rglob("*.csv")]
    assert len(sizes) >= 10 and max(sizes) < 60_000
    assert readers.read_raw(spark, str(tmp_path / "raw")).count() == 1000
