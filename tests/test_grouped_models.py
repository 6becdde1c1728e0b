"""Models of all slices in one job against plain numpy, slice by slice and document by document."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest

from topictide.operators import agglomerate, kmeans, lda, topics, variational
from topictide.operators import keywords as K

JAN, FEB = datetime(2024, 1, 1), datetime(2024, 2, 1)
DOCS = "slice timestamp, doc_id long, text string"


def themed(seed=0, n=40):
    rng = np.random.default_rng(seed)
    themes = [["cat", "dog", "mouse", "horse"], ["bank", "tax", "loan", "money"], ["sun", "rain", "wind", "snow"]]
    rows = []
    for i in range(n):
        theme = themes[i % 3]
        words = [*rng.choice(theme, rng.integers(3, 12)), *rng.choice(themes[(i + 1) % 3], rng.integers(0, 3))]
        rows.append(((JAN, FEB)[i % 2], i, " ".join(words)))
    return [*rows, (JAN, 100, "a"), (FEB, 7, rows[0][2])]


def test_special_functions():
    x = np.array([1e-3, 0.1, 0.5, 1.0, 2.5, 7.0, 300.0])
    assert np.allclose(variational.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)
    slope = [(math.lgamma(v * (1 + 1e-6)) - math.lgamma(v * (1 - 1e-6))) / (2e-6 * v) for v in x]
    assert np.allclose(variational.digamma(x), slope, rtol=1e-6) and abs(variational.digamma(np.array([1.0]))[0] + 0.5772156649015329) < 1e-10


def lda_by_hand(docs, s):
    """Weights and mixtures of one slice's documents (lists of words), one document at a time."""
    counts = {}
    for words in docs:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    vocab = sorted(sorted(counts, key=lambda w: (-counts[w], w))[: s.max_features])
    place = {w: i for i, w in enumerate(vocab)}
    return vocab, [np.bincount([place[w] for w in words if w in place], minlength=len(vocab)) for words in docs]


def estep_by_hand(n, beta, alpha):
    """Topic counts and shares of a document with ``n`` of each word."""
    k = beta.shape[1]
    gamma = np.ones(k)
    if n.sum() == 0:
        return np.zeros(k), np.zeros_like(beta)
    used = n > 0
    for _ in range(variational.DOCUMENT_ROUNDS):
        theta = np.exp(variational.digamma(gamma) - variational.digamma(gamma.sum()))
        phi = beta[used] * theta
        new = alpha + (n[used][:, None] * phi / phi.sum(axis=1, keepdims=True)).sum(axis=0)
        done = np.abs(new - gamma).mean() < variational.TOLERANCE
        gamma = new
        if done:
            break
    theta = np.exp(variational.digamma(gamma) - variational.digamma(gamma.sum()))
    stats = np.zeros_like(beta)
    phi = beta[used] * theta
    stats[used] = n[used][:, None] * phi / phi.sum(axis=1, keepdims=True)
    return gamma, stats


def test_lda_equals_numpy(spark):
    s = lda.LdaSettings(n_topics=3, max_features=10, max_iter=6)
    rows = themed()
    fit = lda.fit_timesliced(spark.createDataFrame(rows, DOCS).repartition(5), s)
    found, mixtures, bounds = fit.topics.collect(), fit.mixtures.collect(), fit.bounds.collect()
    stamps = {start: int((start - datetime(1970, 1, 1)) / timedelta(seconds=1)) for start in (JAN, FEB)}
    for start in (JAN, FEB):
        own = [(i, [w for w in text.split() if len(w) > 1]) for m, i, text in rows if m == start]
        vocab, counted = lda_by_hand([w for _, w in own], s)
        model = variational.start_model([len(vocab)], [stamps[start]], 3, s.seed).weights
        for _ in range(s.max_iter):
            beta = np.exp(variational.digamma(model) - variational.digamma(model.sum(axis=0)))
            model = 1 / 3 + sum(estep_by_hand(n, beta, 1 / 3)[1] for n in counted)
        beta = np.exp(variational.digamma(model) - variational.digamma(model.sum(axis=0)))
        shares = model / model.sum(axis=0)
        want = {(t, vocab[w]): shares[w, t] for t in range(3) for w in range(len(vocab))}
        mine = [r for r in found if r["slice"] == start]
        assert len(mine) == 30 and all(abs(want[r["topic"], r["term"]] - r["score"]) < 1e-6 for r in mine)
        for t in range(3):
            scores = [r["score"] for r in sorted(mine, key=lambda r: r["rank"]) if r["topic"] == t]
            assert scores == sorted(scores, reverse=True)
        expected = sorted([i, *np.round(g / max(g.sum(), 1e-9), 6)] for (i, _), n in zip(own, counted) for g, _ in [estep_by_hand(n, beta, 1 / 3)])
        got = sorted([r["doc_id"], *np.round(r["mixture"], 6)] for r in mixtures if r["slice"] == start)
        assert np.allclose(got, expected, atol=2e-6)
        # the bound rises; what documents' rounds stop short of is small
        series = [r["bound"] for r in sorted(bounds, key=lambda r: r["iteration"]) if r["slice"] == start]
        assert len(series) == 6 and all(b >= a - 1e-3 * abs(a) for a, b in zip(series, series[1:])) and series[-1] > series[0]


def test_lda_models_do_not_depend_on_other_slices(spark, monkeypatch):
    s = lda.LdaSettings(n_topics=2, max_features=8, max_iter=3)
    df = spark.createDataFrame(themed(1), DOCS)
    key = lambda r: (r["topic"], r["rank"])
    alone = sorted(lda.lda_timesliced(df.where(df["slice"] == FEB), s)[0].collect(), key=key)
    monkeypatch.setattr(lda, "MODEL_NUMBERS", 1)  # every slice is a group of its own
    both = sorted((r for r in lda.lda_timesliced(df, s)[0].collect() if r["slice"] == FEB), key=key)
    assert [(r["term"], round(r["score"], 9)) for r in alone] == [(r["term"], round(r["score"], 9)) for r in both]


def clouds(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(120):
        start = (JAN, FEB)[i % 2]
        axis = np.eye(6)[i % 3 + (3 if i % 2 else 0)]
        rows.append((start, i, (axis * 3 + rng.normal(0, 0.2, 6)).tolist()))
    return [*rows, (JAN, 500, [0.0] * 6), (FEB, 501, rows[1][2]), (datetime(2024, 3, 1), 502, [1.0] * 6)]


def test_kmeans_equals_numpy_from_the_same_seeds(spark):
    rows = clouds()
    df = spark.createDataFrame(rows, "slice timestamp, doc_id long, embedding array<double>").repartition(7)
    unit = [(m, i, np.array(v) / np.linalg.norm(v)) for m, i, v in rows if any(v)]
    numbers = {JAN: 0, FEB: 1, datetime(2024, 3, 1): 2}
    table = spark.createDataFrame([(m, numbers[m], i, v.tolist()) for m, i, v in unit], "slice timestamp, slice_no int, doc_id long, v array<double>")
    seeds = kmeans.seed_centres(table, 3, 42)
    assert {s: len(c) for s, c in seeds.items()} == {0: 3, 1: 3, 2: 1}
    clusters, fit = kmeans.kmeans_clusters(df, 3)
    got = {(r["slice"], r["doc_id"]): r["cluster"] for r in clusters.collect()}
    assert got.pop((JAN, 500)) is None
    for start, number in numbers.items():
        x = np.array([v for m, _, v in unit if m == start])
        c, costs = seeds[number], []
        for _ in range(20):
            best = np.round(x @ c.T, 12).argmax(axis=1)
            costs.append((1 - (x * c[best]).sum(axis=1)).sum())
            moved = np.array([x[best == k].sum(axis=0) if (best == k).any() else c[k] for k in range(len(c))])
            moved /= np.linalg.norm(moved, axis=1, keepdims=True)
            if np.abs(moved - c).max() < 1e-9:
                break
            c = moved
        best = np.round(x @ fit.centres[number].T, 12).argmax(axis=1)
        assert [got[start, i] for m, i, _ in unit if m == start] == best.tolist()
        assert np.allclose(fit.centres[number], moved, atol=1e-7)
        assert np.allclose([h[number] for h in fit.costs][: len(costs)], costs, atol=1e-7) and costs == sorted(costs, reverse=True)
        one = x.sum(axis=0) / np.linalg.norm(x.sum(axis=0))
        assert fit.costs[-1][number] <= (1 - x @ one).sum() + 1e-9
        if number < 2:
            assert fit.costs[-1][number] < 0.2 * (1 - x @ one).sum()


def closest_pairs(vectors, n):
    """Clusters (frozensets) left when the closest pair by mean cosine is merged until ``n`` are left."""
    groups = [[i] for i in range(len(vectors))]
    dots = vectors @ vectors.T
    while len(groups) > n:
        best = max(
            ((round(np.mean(dots[np.ix_(a, b)]), 12), -a[0], -b[0], i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j),
        )
        i, j = best[3], best[4]
        groups[i] = sorted(groups[i] + groups[j])
        del groups[j]
        groups.sort()
    return {tuple(g) for g in groups}


# blocks of 7: rounds of nearest pairs, block against block, before a slice fits
@pytest.mark.parametrize("block,n", [(256, 1), (256, 9), (7, 4)])
def test_merging_equals_closest_pairs(spark, monkeypatch, block, n):
    monkeypatch.setattr(agglomerate, "BLOCK", block)
    monkeypatch.setattr(agglomerate, "COLUMNS", 3)
    rng = np.random.default_rng(2)
    rows, vectors = [], {}
    for start, size in ((JAN, 23), (FEB, 6)):
        x = rng.random((size, 12)) * (rng.random((size, 12)) < 0.4)
        x[:, 0] += 0.05 * (np.arange(size) % 4 > 0)
        x[x.sum(axis=1) == 0, 11] = 1
        vectors[start] = x / np.linalg.norm(x, axis=1, keepdims=True)
        rows += [(start, t, f"w{w}", float(v)) for t, row in enumerate(vectors[start]) for w, v in enumerate(row) if v]
    centers = spark.createDataFrame(rows, "slice timestamp, topic int, term string, c double")
    got = {}
    for r in agglomerate.merged_topics(centers, n).collect():
        got.setdefault(r["slice"], {}).setdefault(r["cluster"], []).append(r["topic"])
    for start, x in vectors.items():
        assert {tuple(sorted(g)) for g in got[start].values()} == closest_pairs(x, n)


def test_reduce_topics_numbers_by_size(spark):
    weights = [(JAN, d, t, 1.0) for d, t in [(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b"), (6, "c")]]
    weights = spark.createDataFrame([*weights, (JAN, 6, "a", 1.0)], "slice timestamp, doc_id long, term string, weight double")
    labels = spark.createDataFrame([(JAN, 1, 0), (JAN, 2, 0), (JAN, 3, 0), (JAN, 4, 1), (JAN, 5, 1), (JAN, 6, 2), (JAN, 7, -1)], "slice timestamp, doc_id long, topic int")
    got = {r["doc_id"]: r["topic"] for r in topics.reduce_topics(weights, labels, 2).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 6: 0, 4: 1, 5: 1, 7: -1}
    assert topics.reduce_topics(weights, labels, None).count() == 7
    assert topics.reduce_topics(weights.limit(0), labels.limit(0), 2).count() == 0


def test_class_tfidf_reads_texts_once(spark):
    docs = spark.createDataFrame([(JAN, 1, "naïve cat", 0), (JAN, 2, "cat dog", 1)], f"{DOCS}, topic int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = topics.topic_terms(topics.class_tfidf(K.bags(docs)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("ArrowEvalPython") + plan.count("Scan ExistingRDD") <= 2, plan


def test_memberships_by_document_equal_those_by_join(spark):
    rows = [(m, i, t) for m, i, t in themed(3, 30)]
    bag = K.bags(spark.createDataFrame(rows, DOCS))
    weights = K.tfidf_documents(bag).cache()
    labels = spark.createDataFrame([(m, i, i % 4 - 1) for m, i, _ in rows], "slice timestamp, doc_id long, topic int").dropDuplicates(["slice", "doc_id"])
    key = lambda r: (r["slice"], r["doc_id"])
    both = [sorted(topics.document_topics(weights, labels, centroid_rows=n).collect(), key=key) for n in (10**6, 0)]
    assert [key(r) for r in both[0]] == [key(r) for r in both[1]] and len(both[0]) == labels.count()
    assert [r["probability"] for r in both[0]] == pytest.approx([r["probability"] for r in both[1]], abs=1e-12)


def test_lda_of_the_corpus_is_the_model_of_one_slice(spark):
    s = lda.LdaSettings(n_topics=3, max_features=9, max_iter=5)
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice([f"w{c}" for c in "abcdefghijkl"], 12)) for _ in range(40)] + ["", "x", None]
    rows = [(datetime(2024, 1 + i % 3, 1), i // 2, text) for i, text in enumerate(texts)]  # ids come twice
    docs = spark.createDataFrame(rows, "slice timestamp, doc_id long, text string").repartition(5)
    topics_found, mixtures = lda.lda_corpus(docs, s)
    whole = lda.fit_timesliced(K.corpus_wide(docs), s)
    key = lambda r: (r["topic"], r["rank"])
    found, want = sorted(topics_found.collect(), key=key), sorted(whole.topics.collect(), key=key)
    assert [(*key(r), r["term"]) for r in found] == [(*key(r), r["term"]) for r in want] and len(found) == 27
    assert np.allclose([r["score"] for r in found], [r["score"] for r in want])
    shares = mixtures.collect()
    assert sorted((r["slice"], r["doc_id"]) for r in shares) == sorted(r[:2] for r in rows)
    mine, theirs = (sorted((r["doc_id"], *np.round(r["mixture"], 6).tolist()) for r in part) for part in (shares, whole.mixtures.collect()))
    assert np.allclose(mine, theirs, atol=2e-6) and sum(sum(r["mixture"]) == 0 for r in shares) == 3
    with pytest.raises(ValueError):
        lda.lda_corpus(docs.where("text = ''"), s)


def test_lda_documents_are_numbered_in_place_or_by_join(spark, monkeypatch):
    s = lda.LdaSettings(n_topics=3, max_features=7, max_iter=3)
    rows = [*themed(4), (JAN, 100, "cat cat dog"), (FEB, 101, None)]
    df = spark.createDataFrame(rows, DOCS)

    def results():
        fit = lda.fit_timesliced(df, s)
        found = sorted((str(r["slice"]), r["topic"], r["rank"], r["term"], round(r["score"], 6)) for r in fit.topics.collect())
        return found, sorted((str(r["slice"]), r["doc_id"], [round(x, 5) for x in r["mixture"]]) for r in fit.mixtures.collect())

    monkeypatch.setattr(lda, "_by_join", None)  # no row of a term is shuffled
    in_place = results()
    monkeypatch.undo()
    monkeypatch.setattr(K, "BROADCAST_ROWS", 1)
    assert results() == in_place and len(in_place[1]) == len(rows)


def test_topic_counts_of_late_documents(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 40, 200)
    rows = np.concatenate([rng.choice(60, n, replace=False) for n in sizes])
    counts, beta = rng.integers(1, 5, len(rows)).astype(float), rng.random((60, 4)) ** 6
    want = variational.infer(rows, counts, sizes, beta, 0.25)
    for few, rounds in ((0, 100), (1000, 100)):
        monkeypatch.setattr(variational, "FEW_LEFT", few)
        assert all(np.allclose(a, b, rtol=1e-9) for a, b in zip(variational.infer(rows, counts, sizes, beta, 0.25), want))
    starts = np.cumsum(sizes) - sizes
    for i in (0, 17, 199):
        own = slice(starts[i], starts[i] + sizes[i])
        n = np.zeros(60)
        n[rows[own]] = counts[own]
        assert np.allclose(want[0][i], estep_by_hand(n, beta, 0.25)[0], rtol=1e-9)
