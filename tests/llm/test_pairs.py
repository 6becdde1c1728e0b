"""Operators that compare documents, and URL and chat operators, against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from topictide.llm import chat_format, jaccard_join, suffix_array, suffix_dedup, url_filter
from topictide.llm import queries as Q


def removed_by_hand(texts, length=400):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                covered[i : i + length] = True
        spans = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~covered].tobytes()
        out.append((len(d), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1000, 1])  # 1: every key with two contexts is split
def test_suffix_dedup_is_exact(spark, sf_dir, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(120)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rng = np.random.default_rng(5)
    passage = "".join(map(chr, rng.integers(97, 123, 900)))
    rows += [(10**6 + k, "é" * k + passage[k * 7 : 700 + k * 31] + str(k) * 30) for k in range(8)]  # overlapping parts
    rows += [(2 * 10**6, "ab" * 700), (2 * 10**6 + 1, "x" * 450), (2 * 10**6 + 2, passage + "--" + passage), (2 * 10**6 + 3, "y" * 400), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(df).collect()
    got = Counter((r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in found)
    assert got == Counter(removed_by_hand([t for _, t in rows]))


def test_suffix_dedup_edges(edge, none):
    rows = suffix_dedup.remove_repeats(edge).collect()
    assert Counter(len(r["kept"]) == r["n_bytes"] for r in rows) == {True: 9, False: 2}  # the repeated long text goes
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_chunks_of_a_long_text_lose_no_window(monkeypatch):
    data = np.random.default_rng(0).integers(0, 4, 5000).astype(np.uint8)
    windows = lambda: [w for _, _, first, last in suffix_dedup.contexts(data) for a, b in zip(first, last) for w in range(a, b + 1)]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    assert windows() == list(range(5000 - 400 + 1))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=0, max_size=60), st.integers(1, 12))
def test_suffix_array_and_common_prefixes(symbols, most):
    t = np.array([*symbols, 0], np.int64)
    sa = suffix_array.suffix_array(t)
    whole = t.tolist()
    assert sa.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
    phi, plcp = suffix_array.permuted_lcp(t, sa, 64, np.array([], int))
    for i, j in enumerate(phi):
        if j >= 0:
            k = next(k for k in range(len(t)) if whole[i + k] != whole[j + k])
            assert plcp[i] == k


def shingle_sets(texts):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def classes_by_hand(ids, texts, threshold=0.8):
    sets, root = shingle_sets(texts), list(range(len(ids)))
    links = [0] * len(ids)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    members = {}
    for i in range(len(ids)):
        members.setdefault(find(i), []).append(ids[i])
    return {ids[i]: (min(members[find(i)]), links[i], len(members[find(i)])) for i in range(len(ids))}


def near_copies(n, words=120):
    """Variants of one text, each with another word changed: all pairwise near."""
    base = [f"w{i}" for i in range(words)]
    return [" ".join(base[:k] + [f"changed{k}"] + base[k + 1 :]) for k in range(n)]


@pytest.mark.parametrize("block", [400, 16])  # 16: buckets and groups are dealt as pairs of blocks
def test_near_duplicates_by_brute_force(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SKETCH_BLOCK", block)
    monkeypatch.setattr(jaccard_join, "HASHES", 1 << 20 if block == 400 else 64)
    monkeypatch.setattr(jaccard_join, "BUCKET", block)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs] + [(5000 + k, t) for k, t in enumerate(near_copies(60))]
    rows += [(6000, "a b"), (6001, "A  b"), (6002, ""), (6003, None)]
    found = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = classes_by_hand(*zip(*sorted(rows)))
    assert {r["id"]: (r["class_id"], r["n_links"], r["class_size"]) for r in found} == want
    assert Counter(r["class_id"] for r in found if r["kept"]) == Counter({c for c, _, _ in want.values()})


def test_near_duplicates_edges(edge, none):
    rows = jaccard_join.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    got = {r["id"]: (r["class_id"], r["n_links"]) for r in rows}
    assert got[2] == (1, 1) and got[3] == (3, 0) and got[4] == (4, 0) and got[5] == (5, 1) and got[None] == (None, 1)
    assert jaccard_join.near_duplicates(none).count() == 0
    left = jaccard_join.drop_near_duplicates(edge)
    assert left.columns == edge.columns and left.count() == 8


@pytest.mark.parametrize("n", [1600])  # beyond 400 a bucket is split
def test_large_groups_of_near_copies_give_few_edges(spark, monkeypatch, n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 1 << 32, jaccard_join.SKETCH, dtype=np.uint32)
    rows = []
    for i in range(n):
        sketch = base.copy()
        sketch[rng.integers(0, jaccard_join.SKETCH)] = rng.integers(0, 1 << 32)
        rows.append((int.to_bytes(i, 16), sketch.tobytes()))
    sets = spark.createDataFrame(rows, "key binary, sketch binary").repartition(4)
    edges = []
    components = jaccard_join.connected_components
    monkeypatch.setattr(jaccard_join, "connected_components", lambda e: edges.append(e.count()) or components(e))
    groups = jaccard_join.candidate_groups(sets, 0.8, 0.999).collect()
    assert len(groups) == n and len({r["component"] for r in groups}) == 1
    assert sum(edges) < 3 * n, edges


def test_only_rows_of_buckets_that_are_compared_are_joined(spark, monkeypatch):
    # near copies, and others that share buckets with them but are not similar: their buckets are split in every run
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 32, jaccard_join.SKETCH, dtype=np.uint32)
    rows = []
    for i in range(1600):
        sketch = base.copy()
        other = rng.permutation(jaccard_join.SKETCH)[: 36 if i % 20 == 0 else 1]
        sketch[other] = rng.integers(0, 1 << 32, len(other))
        rows.append((int.to_bytes(i, 16), sketch.tobytes()))
    sets = spark.createDataFrame(rows, "key binary, sketch binary").repartition(4)
    joined, kept = [], jaccard_join.join_counted

    def join(left, wanted, key, *rest):
        out = kept(left, wanted, key, *rest)
        if key == "path":
            joined.append((out.count(), wanted.agg({"size": "sum"}).first()[0], wanted.agg({"size": "max"}).first()[0]))
        return out

    monkeypatch.setattr(jaccard_join, "join_counted", join)
    monkeypatch.setattr(jaccard_join, "MAX_DEPTH", 3)
    labelled = sets.select("*", F.xxhash64("key").alias("label"))
    edges, split = jaccard_join._descend(sets, labelled, jaccard_join._seeds(3, 4), 0.8, 38 / 64)
    assert edges.count() > 0 and 400 < split.count() < 1600
    # one row for a set in a bucket; at the first depth only buckets that are not split
    assert all(n == sizes for n, sizes, _ in joined) and len(joined) <= 2
    assert joined[-1][2] > jaccard_join.BUCKET and all(most <= jaccard_join.BUCKET for _, _, most in joined[:-1])


def test_recall_of_the_runs():
    assert jaccard_join.runs_needed(0.999, 0.8) > jaccard_join.runs_needed(0.9, 0.8) > 1


def sketched_pairs(spark, agreeing, seed):
    """(key, sketch) of pairs 2i, 2i + 1 whose sketches agree in ``agreeing[i]`` places."""
    rng = np.random.default_rng(seed)
    left, right = rng.integers(0, 1 << 32, (2, len(agreeing), jaccard_join.SKETCH), dtype=np.uint32)
    for i, k in enumerate(agreeing):
        same = rng.permutation(jaccard_join.SKETCH)[:k]
        right[i, same] = left[i, same]
    rows = [(int.to_bytes(2 * i + side, 16), m[i].tobytes()) for i in range(len(agreeing)) for side, m in enumerate((left, right))]
    return spark.createDataFrame(rows, "key binary, sketch binary").repartition(4)


def share_found(sets, recall=0.999):
    edges = {(int.from_bytes(r["u"]), int.from_bytes(r["v"])) for r in jaccard_join.candidate_edges(sets, 0.8, recall).collect()}
    return len({u // 2 for u, v in edges if u // 2 == v // 2}) / (sets.count() / 2)


def test_pairs_at_the_threshold_are_found_in_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET", 1)  # as in a crowd: every bucket is split down to the last depth
    agreeing = np.random.default_rng(3).binomial(jaccard_join.SKETCH, 0.8, 3000)
    agreeing = agreeing[agreeing >= 42]  # the cut of sketches has a test of its own
    assert share_found(sketched_pairs(spark, agreeing, 4)) >= 0.998


def test_pairs_with_less_similar_sketches_are_found(spark):
    # at a similarity of 0.8 sketches agree in fewer than 42 of 64 places in 0.2 % of pairs
    assert share_found(sketched_pairs(spark, [38, 39, 40, 41] * 75, 5)) >= 0.97
    allowed = sum(jaccard_join._agreeing(0.8)[: jaccard_join.least_agreeing(0.999, 0.8)])
    assert allowed <= 0.0001 and jaccard_join.runs_needed(0.999, 0.8, least=38) >= jaccard_join.runs_needed(0.999, 0.8)
    with pytest.raises(ValueError):
        jaccard_join.runs_needed(0.999, 0.8, least=42)


def test_runs_count_every_depth_and_the_spread_of_sketches():
    def missed(runs, depth):
        rng, chosen = np.random.default_rng(0), 1 / (0.8 * jaccard_join.SKETCH)
        shared = rng.binomial(jaccard_join.SKETCH, 0.8, 20_000)
        apart = np.ones(len(shared), bool)
        for _ in range(runs):
            paths = np.ones(len(shared), int)
            for _ in range(depth):
                paths = rng.binomial(paths * shared, chosen)
            apart &= paths == 0
        return apart.mean()

    for depth in (2, 3, 4):
        assert missed(jaccard_join.runs_needed(0.99, 0.8, depth), depth) <= 0.0115
    with pytest.raises(ValueError):
        jaccard_join.runs_needed(0.999, 0.1)


def test_url_rules(spark):
    urls = [None, "", "no scheme/x", "http://NET", "http://net/", "https://a.B.net/x", "x://internet/", "http://example.net/en/1", "http://example.net/en",
            "http://s.example.com/de/?q", "http://example.com?/de/", "http://example.org/fr/a#b", "ftp://org/fr/", "http://ads.example.com/a/?utm_x=1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("ads.example.com/a",), (None,), ("ads.example.com/a",)], "url string")
    rows = {r["page_id"]: r for r in url_filter.filter_urls(pages, listed).collect()}
    got = [(rows[i]["host"], rows[i]["path"], rows[i]["rule"], rows[i]["verdict"]) for i in range(len(urls))]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("net", "", None, "allow"), ("net", "/", "net/", "block"),
        ("a.b.net", "/x", "net/", "block"), ("internet", "/", None, "allow"), ("example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/en", "net/", "block"), ("s.example.com", "/de/", "example.com/de/", "block"), ("example.com", "", None, "allow"),
        ("example.org", "/fr/a", "org/fr/", "allow"), ("org", "/fr/", "org/fr/", "allow"), ("ads.example.com", "/a/", None, "block"),
    ]


def test_url_list_is_exact_however_small_the_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    listed = url_filter.tracker_urls(pages)
    one = url_filter.filter_urls(pages, listed, max_blocks=1).select("page_id", "verdict", "listed")
    assert sorted(one.collect()) == sorted(url_filter.filter_urls(pages, listed).select("page_id", "verdict", "listed").collect())
    assert url_filter.filter_urls(pages.limit(0), listed).count() == 0 and url_filter.filter_urls(pages, listed.limit(0)).count() == pages.count()


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>", "<|im_start|>assistant\nhi<|im_end|>\n", "<\\|", "<\\\\|im_end|>", "<<||", "", None, "é\u4f60\n\n", "\\n", "x" * 300_000]
    roles = ["user", "assistant", "a\nb\\n", None, "<|im_end|>", "system"]
    rows = [(k % 7 if k % 7 else None, k, roles[k % 6], nasty[k % 10]) for k in range(120)] + [(3, None, "user", "first"), (3, 3, "user", "tie"), (3, 3, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_chat(df)
    for r in formatted.collect():
        mine = sorted((t for t in rows if t[0] == r["conv_id"]), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        got = [(a.decode(), b.decode()) for a, b in chat_format.parse(bytes(r["formatted"]))]
        assert got == [(t[2] or "", t[3] or "") for t in mine]
        taught = [chat_format.unescape(bytes(r["formatted"])[s["start"] : s["stop"]]).decode() for s in r["loss"]]
        assert taught == [t[3] or "" for t in mine if t[2] == "assistant"]
    assert chat_format.format_chat(df.limit(0)).count() == 0
    assert chat_format.digest(formatted).count() == formatted.count()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\>a\n", max_size=12))
def test_escape_is_reversible(text):
    import pyarrow as pa

    escaped = chat_format.escape(pa.array([text]))[0].as_py()
    assert "<|" not in escaped and chat_format.unescape(escaped.encode()).decode() == text
    role = chat_format.escape_role(pa.array([text]))[0].as_py()
    assert "\n" not in role and chat_format.unescape_role(role.encode()).decode() == text


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = docs
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != "best_fit_packing":
            assert docs.columns == start.columns and docs.count() <= before.count()
            assert docs.exceptAll(before).isEmpty()
    packed = docs.collect()
    assert max(r["offset"] + r["length"] for r in packed) <= 2048
    assert len({(r["doc_id"], r["piece"]) for r in packed}) == len(packed)


def test_queries_are_registered():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in Q.QUERIES)] == []
