"""Runs that are repeated, resumed or given awkward slices."""

import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from test_models_and_files import letter_encoder, raw_files
from topictide.operators import density, embedding, grid_density, keywords, lda, staging
from topictide.plans import runs
from topictide.plans.config import RunConfig
from topictide.session import scratch, work_path

JAN, FEB = datetime(2024, 1, 1), datetime(2024, 2, 1)


def rows_of(spark, path):
    csv = path.rsplit("/", 2)[-2].endswith("csv") or path.rsplit("/", 2)[-2] in ("trend", "positions")
    table = spark.read.option("header", "true").csv(path) if csv else spark.read.parquet(path)
    return sorted(map(str, table.collect()))


def test_second_run_replaces_the_first(spark, tmp_path):
    raw, base = raw_files(spark, tmp_path), str(tmp_path / "out")
    config = RunConfig(min_docs_per_slice=5, min_cluster_size=3, lda_n_topics=2, tfidf_max_features=20, save_embeddings=True, keywords_per_document=3)
    first = {k: rows_of(spark, p) for k, p in runs.run_all(spark, raw, base, config).items()}
    other = RunConfig(min_docs_per_slice=5, min_cluster_size=3, lda_n_topics=2, tfidf_max_features=5, lda_scope="corpus", tfidf_scope="corpus", tfidf_variant="plain")
    shares = runs.run_all(spark, raw, base, other)["lda_shares"]
    assert spark.read.parquet(shares).groupBy("slice_label").agg(F.sum("share").alias("s")).where("abs(s - 1) > 1e-6").isEmpty()
    paths = runs.run_all(spark, raw, base, config)
    mine = {k: [r for r in rows_of(spark, p) if "config_hash" not in r or config.fingerprint() in r] for k, p in paths.items()}
    assert {k: len(v) for k, v in mine.items()} == {k: len(v) for k, v in first.items()}
    for kind in ("keywords", "topic_terms", "doc_topics", "topic_info", "keyword_frequency", "trend"):
        assert mine[kind] == first[kind]


def test_records_are_capped_and_resumed(spark, tmp_path):
    raw = str(tmp_path / "raw")
    schema = "id string, title string, summary string, authors string, link string, published timestamp"
    rows = [(f"{i:02}", "t", "s", "a", "l", datetime(2024, 1 + i % 3, 1 + i)) for i in range(24)]
    config = RunConfig(start_year=2024, end_year=2024, max_per_interval=2)
    with scratch(spark):
        empty = runs.collect_records(spark.createDataFrame(rows, schema), raw, config).count()
    kept = lambda: sorted(r["id"] for r in spark.read.option("header", "true").csv(raw, recursiveFileLookup=True).collect())
    assert empty == 9 and kept() == ["18", "19", "20", "21", "22", "23"]
    more = [("99", "t", "s", "a", "l", datetime(2024, 1, 31)), ("98", "t", "s", "a", "l", datetime(2024, 7, 1))]
    with scratch(spark):
        runs.collect_records(spark.createDataFrame(more, schema), raw, config)
    assert kept() == ["18", "19", "20", "21", "22", "23", "98"]  # January was there already


def test_scratch_folder_goes(spark):
    with scratch(spark) as folder:
        spark.range(3).write.parquet(work_path(spark, "x"))
        assert os.path.isdir(folder.removeprefix("file://"))
    assert not os.path.exists(folder.removeprefix("file://"))


def test_config_refuses_and_warns():
    with pytest.raises(ValueError):
        RunConfig(interval_bounds="open")
    with pytest.raises(ValueError):
        RunConfig(algorithm="kmeans")
    with pytest.warns(UserWarning, match="device"):
        RunConfig.from_dict({"device": "gpu"})


def test_same_ids_in_two_slices(spark):
    words = [["graph", "node"], ["cell", "gene"]]
    rows = [(s, i, w, 0.5**0.5) for s in (JAN, FEB) for i in range(20) for w in words[i % 2 if s == JAN else i // 10]]
    weights = spark.createDataFrame(rows, "slice timestamp, doc_id long, term string, weight double")
    docs = weights.select("slice", "doc_id").distinct()
    found = density.density_topics(docs, weights, density.DensitySettings(min_cluster_size=5)).collect()
    assert len(found) == 40
    for s, side in ((JAN, lambda i: i % 2), (FEB, lambda i: i // 10)):
        groups = {(r["topic"], side(r["doc_id"])) for r in found if r["slice"] == s}
        assert len(groups) == 2 and {t for t, _ in groups} == {0, 1}


def test_same_ids_on_the_grid(spark):
    rows = [(s, i, [float(i % 2 if s == JAN else i // 10), i * 1e-4]) for s in (JAN, FEB) for i in range(20)]
    vectors = spark.createDataFrame(rows, "slice timestamp, doc_id long, embedding array<double>")
    found = grid_density.grid_density_topics(vectors, grid_density.GridSettings(eps=0.1, min_samples=3, min_cluster_size=5)).collect()
    assert len(found) == 40
    for s, side in ((JAN, lambda i: i % 2), (FEB, lambda i: i // 10)):
        assert len({(r["topic"], side(r["doc_id"])) for r in found if r["slice"] == s}) == 2


def test_grid_refuses_mixed_widths(spark):
    rows = [(JAN, 1, [0.0, 0.0]), (JAN, 2, [0.0, 0.0, 5.0])]
    vectors = spark.createDataFrame(rows, "slice timestamp, doc_id long, embedding array<double>")
    with pytest.raises(PySparkException, match="coordinates expected"):
        grid_density.grid_density_topics(vectors, grid_density.GridSettings(eps=0.1)).collect()


def test_encoder_runs_once_per_document(spark):
    docs = spark.createDataFrame([(JAN, 1, "a b")], "slice timestamp, doc_id long, text string")
    plan = embedding.embed_documents(docs, letter_encoder())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_layout_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(JAN, i, rng.normal(size=5).tolist()) for i in range(60)], "slice timestamp, doc_id long, embedding array<double>")
    layouts = [sorted(map(tuple, embedding.layout_2d(df.repartition(n)).collect())) for n in (1, 3, 7)]
    assert layouts[0] == layouts[1] == layouts[2]


def test_lda_without_any_token(spark):
    docs = spark.createDataFrame([(JAN, 1, ""), (FEB, 2, "a")], "slice timestamp, doc_id long, text string")
    found, mixtures = lda.lda_timesliced(docs)
    assert found.count() == 0 and mixtures.count() == 0


def test_stopwords_from_a_table(spark):
    docs = spark.createDataFrame([(JAN, 1, "the cat sat"), (JAN, 2, "the The"), (FEB, 1, "naïve dog")], "slice timestamp, doc_id long, text string")
    table = spark.createDataFrame([(0, "the"), (1, "sat"), (2, "naïve")], "pos int, word string")
    by_table = keywords.bags(docs, table).collect()
    by_list = keywords.bags(docs, ["the", "sat", "naïve"]).collect()
    assert sorted(map(str, by_table)) == sorted(map(str, by_list))


def test_dedupe_keeps_the_smallest_id(spark):
    df = spark.createDataFrame([(3, "h", "x"), (1, "h", "y"), (1, "h", "y"), (2, None, "z"), (None, "g", "w")], "doc_id long, hash string, text string")
    assert sorted(r["text"] for r in staging.dedupe_documents(df).collect()) == ["w", "y", "z"]


@pytest.mark.parametrize("stop", [["the", "sat", "naïve"], ["absent"]])
def test_stopword_forms_agree_on_repeated_and_null_keys(spark, stop):
    rows = [(JAN, 1, "the cat sat"), (JAN, 1, "the dog sat sat"), (JAN, 1, "the cat sat"), (None, None, "the end"), (JAN, None, "the The"), (FEB, None, None), (FEB, 2, "")]
    docs = spark.createDataFrame([(*r, "kept", 7) for r in rows], "slice timestamp, doc_id long, text string, word string, _at int")
    table = spark.createDataFrame([(i, w) for i, w in enumerate(stop)], "pos int, word string")
    by_list, by_table = (sorted(map(str, keywords.without_stopwords(docs, s).collect())) for s in (stop, table))
    assert by_list == by_table and len(by_table) == len(rows)


def test_columns_with_one_standard_name_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "` Row  Id` int, `row_Nr` int")
    assert staging.standardise_columns(df).columns == ["row_id", "row_nr"]
    with pytest.raises(ValueError):
        staging.standardise_columns(spark.createDataFrame([(1, 2)], "`Row Id` int, `row_id ` int"))
