"""Operators without SQL against versions that work one row, one n-gram or one item at a time."""

import zlib
from collections import Counter

import numpy as np
import pytest

from topictide.llm import language_id, packing, quality_classifier


def test_quality_scores_row_by_row(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    taught = {c: [i for i in rows if known.get(i) == c and zlib.crc32(str(i).encode()) % 5] for c in (0, 1)}
    x = {c: np.array([quality_classifier.statistics(rows[i]) for i in taught[c]]) for c in (0, 1)}
    both = np.concatenate([x[0], x[1]])
    spread = np.diag(np.maximum(both.var(axis=0), 1e-6))

    def log_density(v, c):
        own = (x[c] - x[c].mean(axis=0)).T @ (x[c] - x[c].mean(axis=0)) / len(x[c])
        cov = (1 - quality_classifier.SHRINKAGE) * own + quality_classifier.SHRINKAGE * spread
        away = v - x[c].mean(axis=0)
        return np.log((len(x[c]) + 1) / (len(both) + 2)) - 0.5 * (np.linalg.slogdet(cov)[1] + away @ np.linalg.solve(cov, away))

    model = quality_classifier.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.score_quality(docs, model).collect()}
    for i, text in rows.items():
        v = np.array(quality_classifier.statistics(text))
        d = np.clip(log_density(v, 0) - log_density(v, 1), -500, 500)
        assert got[i] == pytest.approx(1 / (1 + np.exp(d)), abs=2e-5), i


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    joined = f" {' '.join(words)} " if words else ""
    return [joined[i : i + n] for n in (2, 3) for i in range(len(joined) - n + 1)]


def test_language_counts_by_plain_sets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 2 = 0")
    rows = [r for r in docs.collect() if r["text"] is not None and r["lang"] is not None]
    model = language_id.fit(docs, docs_per_language=10**6, min_count=5, contrast=0.5, max_ngrams=10**7)
    times = {}
    for r in rows:
        times.setdefault(r["lang"], Counter()).update(grams(r["text"]))
    seen = {g for c in times.values() for g, n in c.items() if n >= 5}
    totals = {lang: sum(c[g] for g in seen) for lang, c in times.items()}
    listed = {lang: set() for lang in times}
    for g in seen:
        most = max(c[g] / totals[lang] for lang, c in times.items())
        for lang, c in times.items():
            if c[g] >= 5 and c[g] / totals[lang] >= 0.5 * most:
                listed[lang].add(g)
    assert model.languages == tuple(sorted(times))
    letters, wrong = language_id._letters(), 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 2 = 1").collect():
        mine = grams(r["text"] or "")
        counts = model.counts(r["text"] or "", letters)
        if not mine:
            assert counts is None
            continue
        want = np.array([sum(g in listed[lang] for g in mine) for lang in model.languages], float)
        # what false positives add is estimated and taken off again
        assert np.abs(counts - want).max() <= 3 + 0.01 * len(mine)
        wrong += int(counts.argmax() != want.argmax())
    assert wrong == 0


def one_by_one(lengths, max_tokens, max_documents, max_attention, rule):
    capacity = np.array([max_tokens, max_documents or max_tokens, max_attention or max_tokens**2], float)
    bins = []
    for n in sorted(lengths.tolist(), reverse=True):
        item = np.array([n, 1, float(n) ** 2])
        best, at = None, None
        for i, (residual, _) in enumerate(bins):
            if (residual >= item).all():
                if rule == "norm":
                    value = -(((residual - item) / capacity) ** 2).sum()
                else:
                    value = ((item / capacity) * (residual / capacity)).sum()
                if best is None or value > best:
                    best, at = value, i
        if at is None:
            bins.append([capacity.copy(), []])
            at = len(bins) - 1
        bins[at][0] -= item
        bins[at][1].append(n)
    return sorted(sorted(b) for _, b in bins)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(50, None, None), (50, 3, 900), (50, 2, None), (64, 6, 1500)])
def test_best_fit_equals_one_item_at_a_time(rule, caps):
    for seed in range(5):
        lengths = np.random.default_rng(seed).integers(1, 31 if caps[2] else 51, 150)
        place, _ = packing.vector_best_fit(lengths, *caps, rule=rule)
        bins = {}
        for p, n in zip(place.tolist(), lengths.tolist()):
            bins.setdefault(p, []).append(n)
        assert sorted(sorted(b) for b in bins.values()) == one_by_one(lengths, *caps, rule)
