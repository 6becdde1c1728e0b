"""Products of blocks of sparse vectors, and what they leave on disk."""

import os
import random
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topictide import session
from topictide.operators import density as D
from topictide.operators import hierarchy as H
from topictide.operators import keywords as K
from topictide.operators import products as P
from topictide.operators import similarity

JAN, FEB = datetime(2024, 1, 1), datetime(2024, 2, 1)


def vectors(x):
    return P.Vectors(np.concatenate([np.flatnonzero(r) for r in x]), np.concatenate([r[r != 0] for r in x]), (x != 0).sum(axis=1))


@pytest.mark.parametrize("share", [0.02, 0.3, 2.0])
def test_products_and_close_pairs(monkeypatch, share):
    monkeypatch.setattr(P, "DENSE_SHARE", share)
    monkeypatch.setattr(P, "POSTINGS", 500)
    rng = np.random.default_rng(5)
    x = rng.random((150, 200)) * (rng.random((150, 200)) < np.linspace(0.9, 0.01, 200))
    x[7] = 0
    x /= np.maximum(np.sqrt((x * x).sum(axis=1)), 1e-9)[:, None]
    block = P.Block(**P.packed(vectors(x[:90])), point=np.arange(90))
    others = vectors(x[90:])
    want = x[90:] @ x[:90].T
    assert np.allclose(block.products(others), want) and np.allclose(block.products(others, np.float32), want, atol=1e-5)
    assert (np.abs(block.products(others, np.float32) - want) < others.slack()[:, None]).all()
    for cosine in (0.3, round(float(np.median(want)), 6), round(float(want[3, 4]), 6)):
        i, j = block.close(others, cosine, 6)
        assert sorted(zip(i.tolist(), j.tolist())) == sorted(zip(*[v.tolist() for v in np.nonzero(np.round(want, 6) >= cosine)]))


def test_all_pairs_at_the_threshold_are_decided_exactly():
    x = np.full((40, 41), 0.0)
    x[:, 0] = np.sqrt(0.6)
    x[np.arange(40), np.arange(40) + 1] = np.sqrt(0.4)
    block, others = P.Block(**P.packed(vectors(x)), point=np.arange(40)), vectors(x)
    assert len(block.close(others, 0.6, 6)[0]) == 1600 and len(block.close(others, 0.600001, 6)[0]) == 40


def test_a_term_listed_twice_counts_once():
    twice = P.Vectors(np.array([3, 3, 5]), np.array([0.1, 0.6, 0.8]), np.array([3]))
    assert twice.ids.tolist() == [3, 5] and twice.ws.tolist() == [0.6, 0.8]
    assert P.Vectors.of(pa.table({"ids": [[3, 3, 5], []], "ws": [[0.1, 0.6, 0.8], []]})).n == 2


def docs_of(spark, seed=3, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    themes = [rng.sample(words, 7) for _ in range(4)]
    rows = [(rng.choice([JAN, FEB]), i, " ".join(rng.choices(rng.choice(themes), k=rng.randint(4, 9)) + rng.choices(words, k=rng.randint(0, 4)) + [f"u{i}"] * (i % 2))) for i in range(n)]
    return spark.createDataFrame(rows, "slice timestamp, doc_id long, text string")


def test_many_blocks_and_rounds_give_the_same(spark, monkeypatch):
    docs = docs_of(spark)
    bag = K.bags(docs)
    rows = K.tfidf_documents(bag).cache()
    monkeypatch.setattr(D, "FEW_PAIRS", 0)
    s, h = D.DensitySettings(0.4, 3, 4), H.HierarchySettings(3, 4)

    def results(weights):
        found = similarity.cosine_links(weights, 0.6), D.density_topics(docs, weights, s), H.hierarchical_topics(docs, weights, h)
        return [sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in t.collect()) for t in found]

    one = results(rows)
    for name, value in (("BLOCK_POINTS", 9), ("ROUND_ENTRIES", 150), ("ROWS", 8)):
        monkeypatch.setattr(P, name, value)
    monkeypatch.setattr(similarity, "KEPT", 20)
    monkeypatch.setattr(H, "HELD", 25)
    assert results(K.weighted_bags(bag)) == one
    assert len({t for _, _, t in one[1]}) > 2 and max(n for _, _, n, _ in one[0]) > 3


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "shuffle_" in f}


def test_a_stored_table_leaves_no_shuffle_behind(spark):
    before = shuffle_files(spark)
    stored = session.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("l")), "rows")
    assert stored.count() == 7 and not {f for f in shuffle_files(spark) - before if f.endswith(".data") and os.path.getsize(f) > 1000}


def test_steps_are_deleted_and_single_terms_left_out(spark, tmp_path):
    weights = K.weighted_bags(K.bags(docs_of(spark, n=30)))
    with session.scratch(spark) as folder:
        points, docs = H.weighted_points(weights)
        left = os.listdir(folder.removeprefix("file:"))
        assert len(left) == 2 and all(x.startswith("points-") for x in left)  # vectors and terms have gone
        held = points.select("slice", F.explode("ids").alias("id")).groupBy("slice", "id").count()
        assert held.count() > 20 and docs.count() == 30
        # a point stands for its copies; a term without a second document is not there
        assert points.agg(F.sum("copies")).first()[0] == 30 and points.agg(F.max(F.size("ids"))).first()[0] <= 40


def test_rows_are_numbered_without_gaps(spark):
    rows = session.numbered(spark.range(100, numPartitions=7), "rows", "n").orderBy("id").collect()
    assert [r["n"] for r in rows] == list(range(100))
    assert session.numbered(spark.range(0), "rows", "n").count() == 0
