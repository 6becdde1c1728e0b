"""Fill-in-the-middle, decontamination and whitening against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topictide.llm import decontamination as leaks
from topictide.llm import fill_middle as middles
from topictide.llm import queries as Q
from topictide.llm import whitening


def filled_by_hand(doc_id, text, s=middles.FillMiddle()):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    named = f"{s.seed}:{'' if doc_id is None else doc_id}"
    h = [int(hashlib.sha256(named.encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= s.rate:
        return len(lines), "plain", None, None, text
    if h[3] % 100 < s.spm:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TRICKY = ["", None, "\n", "\n\n\n", "a", "a\nb", "é\n你好\n😀", "<P", "x<\nS>\n<M\n>", "<P>\nx", "a<S>b", "\n<M>", "<<\n<\n>>P>", "P>\n<S", "x" * 5000 + "\n" + "é" * 3000]


@pytest.mark.parametrize("window", [1 << 20, 7])  # 7: segments, marks and characters lie across windows
@pytest.mark.parametrize("s", [middles.FillMiddle(), middles.FillMiddle(seed=3, rate=60, spm=20)])
def test_fill_middle_by_hand(spark, monkeypatch, window, s):
    monkeypatch.setattr(middles, "WINDOW", window)
    rows = [(i, t) for i, t in enumerate(TRICKY * 4)] + [(None, "a\nb\nc"), (1, "again\nand again"), (1, "again\nand again")]
    made = middles.restore(middles.fill_middle(spark.createDataFrame(rows, "doc_id long, text string"), settings=s)).collect()
    got = Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in made)
    assert got == Counter((i, *filled_by_hand(i, t, s), t or "") for i, t in rows)


def test_fill_middle_edges(edge, none):
    made = middles.fill_middle(edge)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    texts = Counter(r["text"] or "" for r in edge.collect())
    assert Counter(r["restored"] for r in middles.restore(made).collect()) == texts
    assert middles.restore(middles.fill_middle(none)).count() == 0


def test_restore_needs_its_control_strings():
    data = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError):
        middles.gather(np.array([0, 8]), data, np.array([middles.PSM]))


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def leaks_by_hand(docs, items, window=10):
    known = {}
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            known.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    widths = {len(k) for k in known}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in widths:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in known:
                    hit.update(range(i, i + k))
                    found |= known[tuple(w[i : i + k])]
        runs = [i for i in sorted(hit) if i - 1 not in hit]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(runs), bool(hit)))
    return out


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short ITEM, here!"), (10, "x"), (3, "three four five six seven eight nine ten eleven twelve thirteen"),
         (4, "a a a a a a a a a a a a"), (5, None), (6, "..."), (None, "é ü 你好 9"), (2, "the second row of an item"), (7, "two words")]


def test_leaks_by_hand(spark, sf_dir):
    rng = np.random.default_rng(0)
    vocabulary = "one two three four five six seven eight nine ten eleven twelve thirteen a short item here é ü 你好 9 words the second row of an".split()
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(150)]
    for item, text in ITEMS:
        for pad in range(12):
            docs.append((1000 + pad, "pad " * pad + (text or "").upper() + " -- tail " * (pad % 3)))
    docs += [(None, "Short;item\nhere"), (None, None), (5, ""), (5, "a " * 40), (5, "a " * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for own, most in ((ITEMS, 1000), (ITEMS[:2], 0)):  # 0: hashes and windows are joined, not broadcast
        some = items.where(F.col("item_id").isin([i for i, _ in own])) if len(own) == 2 else items
        some = some.where("text not like 'the second%'") if len(own) == 2 else some
        found = leaks.find_contamination(df, some, max_broadcast=most).collect()
        got = Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], len(r["spans"]), r["contaminated"]) for r in found)
        assert got == Counter(leaks_by_hand(docs, own))


def test_leaks_of_one_word_and_removal(spark):
    docs = [(1, "x, Y x! z"), (2, "y z"), (3, "A short item here. And more"), (4, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "X"), (2, "short item here")], "item_id long, text string")
    cut = {r["doc_id"]: r["text"] for r in leaks.decontaminate(df, items, remove="spans").collect()}
    assert cut == {1: "Y z", 2: "y z", 3: "A And more", 4: None}
    assert sorted(r["doc_id"] for r in leaks.decontaminate(df, items).collect()) == [2, 4]
    with pytest.raises(ValueError):
        leaks.decontaminate(df, items, remove="lines")


def test_leaks_edges(spark, edge, none):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the bank", "x"), (2, "wort7 das ist wort8 das", "y")], "item_id long, text string, key string")
    rows = leaks.find_contamination(edge, items).collect()
    assert len(rows) == edge.count()
    assert Counter(r["doc_id"] for r in rows if r["contaminated"]) == {1: 1, 2: 1, 5: 2}
    assert leaks.find_contamination(none, items).count() == 0
    assert not any(r["contaminated"] for r in leaks.find_contamination(edge, items.limit(0)).collect())
    spans = leaks.decontaminate(edge, items, remove="spans")
    assert spans.columns == edge.columns and spans.count() == edge.count()
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6), st.floats(-3, 3))
def test_inertia_counts(n, seed, shift):
    rng = np.random.default_rng(seed)
    a = rng.integers(-3, 4, (n, n)).astype(float)
    a = a + a.T
    values = np.linalg.eigvalsh(a)
    if np.abs(values - shift).min() > 1e-9:
        assert whitening.count_above(a, shift) == (values > shift).sum()


@pytest.mark.parametrize("values", [[9, 7, 5, 3, 1, 0.5], [4, 4, 4, 1, 1, 0], [1e6, 1, 1 - 1e-13, 1e-3, 0, 0], [2, 2 - 1e-9, 2 - 2e-9, 1, 1, 1]])
def test_leading_eigenpairs(values):
    turn, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((6, 6)))
    a = turn @ np.diag(values) @ turn.T
    a = (a + a.T) / 2
    found, vectors = whitening.leading_eigenpairs(a, 5)
    assert len(found) == min(5, sum(v > 1e-9 for v in values))
    assert np.allclose(found, values[: len(found)], rtol=1e-9, atol=1e-9 * values[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-10)
    assert np.allclose(a @ vectors, vectors * found, atol=1e-12 * values[0])


def whitened_by_hand(rows, k=16):
    usable = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in usable]
    fit = np.array(sorted({tuple(v) for _, v in x}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit.astype(float) - (sums / n).astype(float)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, v in x:
        deviation = int(sum((n * a - s) ** 2 for a, s in zip(v, sums)))
        out[i] = (n, deviation, (np.array(v, float) - (sums / n).astype(float)) @ vectors / np.sqrt(values), values / np.trace(cov))
    return out


def test_whitening_by_numpy(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, got = whitened_by_hand(rows), {}
    for r in Q.op13_embedding_whitening(spark, sf_dir).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert got.keys() == want.keys()
    first = next(iter(want))
    sign = np.sign([got[first][c + 1]["whitened"] * want[first][2][c] for c in range(16)])
    for i, (n, deviation, whitened, explained) in want.items():
        assert sorted(got[i]) == list(range(1, 17))
        for c, r in got[i].items():
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert abs(r["whitened"] * sign[c - 1] - whitened[c - 1]) < 1e-8 and abs(r["explained"] / explained[c - 1] - 1) < 1e-10
            assert r["identity_error"] < 1e-9


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, -2.0]), (2, [0.25, 3.0, 1.0]), (2, [0.25, 3.0, 1.0]), (None, [7.0, -1.0, 0.0]), (3, None), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]),
            (6, [inf, 0.0, 0.0]), (7, []), (8, [1.0, 2.0]), (9, [0.501, 1.0, -2.0]), (10, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "vec_id long, embedding array<double>, id string, width int")
    found = whitening.whiten(df).collect()
    assert Counter(r["vec_id"] for r in found) == Counter([1, 2, 2, None, 9, 10])
    assert {r["n"] for r in found} == {4}  # 1 and 9 are equal as whole numbers
    want = whitened_by_hand([(i, v) for i, v in rows if v and len(v) == 3])
    assert all(r["deviation"] == want[r["vec_id"]][1] for r in found)
    assert {len(r["whitened"]) for r in found} == {3}
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id = 3")).count() == 0
    same = whitening.whiten(df.where("vec_id = 2")).collect()
    assert [(r["n"], r["deviation"], r["whitened"]) for r in same] == [(1, 0, [])] * 2
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in huge} == {whitening.LONG.max}
