"""Operators on single documents: exact deduplication, quality rules and classifier, language, packing, mixing."""

import hashlib
import itertools
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topictide.llm import common, exact_dedup, language_id, mixing, packing, quality_classifier, quality_rules
from topictide.llm import queries as Q


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_exact_dedup_edges(edge, none):
    rows = exact_dedup.exact_dedup(edge, keep="max").collect()
    assert len(rows) == edge.count()
    groups = defaultdict(list)
    for r in rows:
        groups[r["text_sha256"]].append(r)
    for members in groups.values():
        assert sum(r["kept"] for r in members) == 1
        ids = [r["doc_id"] for r in members if r["doc_id"] is not None]
        assert {r["keep_id"] for r in members} == {max(ids, default=None)}
        assert {r["group_size"] for r in members} == {len(members)}
    assert hashlib.sha256(b"").hexdigest() in groups and len(groups) == 7
    assert exact_dedup.exact_dedup(none).count() == 0
    low = {r["doc_id"]: r["kept"] for r in exact_dedup.exact_dedup(edge, keep="min").collect()}
    assert low[1] and not low[2]


def test_drop_copies_keeps_all_columns(edge):
    left = exact_dedup.drop_copies(edge, keep="max")
    assert left.columns == edge.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 2, 4, 5, 6, 7, 8]


def rules_by_hand(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, edge, none):
    texts = ["a b c d e a b c d e", "x " * 30, "same line here\nsame line here\n\n other #$ \x0b|", " \t\n", "a b c d e f a b c d e g a b c d e"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for docs in (rows, edge):
        want = Counter(rules_by_hand(r["text"]) for r in docs.collect())
        found = quality_rules.apply_rules(docs).collect()
        assert Counter((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in found) == want
        assert all(r["kept"] == (not r["failed"]) for r in found)
    assert quality_rules.apply_rules(none).count() == 0
    plan = quality_rules.apply_rules(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_quality_classifier_held_out(spark, sf_dir):
    rows = Q.op6_quality_classifier(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.9


def test_quality_classifier_edges(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    model = quality_classifier.fit(edge, labels, fold=None)
    rows = quality_classifier.score_quality(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = quality_classifier.fit(none, labels.limit(0))
    assert {r["score"] for r in quality_classifier.score_quality(edge, empty).collect()} == {0.5}
    assert quality_classifier.score_quality(none, model).count() == 0


def test_language_held_out(spark, sf_dir):
    rows = Q.op1_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95


def test_language_edges(edge, none):
    model = language_id.fit(edge, min_count=1)
    rows = {r["doc_id"]: r for r in language_id.identify(edge, model).collect()}
    assert [rows[i]["lang_pred"] for i in (3, 4, 6)] == ["und"] * 3
    assert rows[1]["lang_pred"] == "en" and rows[5]["lang_pred"] == "de" and 0 < rows[5]["score"] <= 1
    assert language_id.identify(none, model).count() == 0
    untaught = language_id.fit(none)
    assert {r["lang_pred"] for r in language_id.identify(edge, untaught).collect()} == {"und"}


def test_bloom_filters_return_every_language():
    letters = language_id._letters()
    grams = {"aa": {"x"}, "ab": {"x", "y"}}
    words = np.zeros((1, 1 << language_id.LOG_BITS), np.uint64)
    for i, lang in enumerate("xy"):
        for gram, langs in grams.items():
            if lang in langs:
                h = list(language_id.ngram_hashes(gram, letters))[0][1:2]  # the bigram without a boundary
                for at in language_id._positions(h):
                    words[0][at] |= np.uint64(1 << i)
    model = language_id.LanguageFilters(("x", "y"), words, np.zeros(2))
    assert model.counts("aa", letters).tolist() == [1, 0]
    assert model.counts("ab", letters).tolist() == [1, 1]
    assert model.counts("12", letters) is None


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(50, None, None), (50, 3, 900), (50, 2, None)])
def test_best_fit_constraints(rule, caps):
    lengths = np.random.default_rng(3).integers(1, 31 if caps[2] else 51, 400)
    place, offset = packing.vector_best_fit(lengths, *caps, rule=rule)
    bins = defaultdict(list)
    for p, o, n in zip(place, offset, lengths):
        bins[p].append((o, n))
    for items in bins.values():
        items.sort()
        assert [o for o, _ in items] == [0, *itertools.accumulate(int(n) for _, n in items[:-1])]
        assert sum(n for _, n in items) <= 50 and (not caps[1] or len(items) <= caps[1])
        assert not caps[2] or sum(n * n for _, n in items) <= caps[2]
    if caps[1] is None:
        assert len(bins) <= lengths.sum() / 50 * 1.05 + 1


def test_best_fit_takes_the_tightest_bin():
    place, _ = packing.vector_best_fit(np.array([6, 7, 3, 4]), 10)
    assert place[1] == place[2] and place[0] == place[3]


def test_cut_and_pack_round_trip(edge, none):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_tokenizer())
    whole.encode_special_tokens = True
    pieces = packing.cut_documents(edge, max_tokens=512)
    placed = packing.pack(pieces, max_tokens=512, shard_pieces=100)
    rows = placed.collect()
    docs = defaultdict(list)
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) and len(r["ids"]) == 4 * r["length"]
        docs[r["doc_id"]].append(r)
    for doc_id, text in {(r["doc_id"], r["text"]) for r in edge.collect() if r["doc_id"] not in (None, 5)}:
        mine = sorted(docs[doc_id], key=lambda r: r["piece"])
        want = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        assert b"".join(bytes(r["ids"]) for r in mine) == array("I", want).tobytes()
    long = [r for r in docs[5] if r["piece"] > 0]
    assert {r["length"] for r in long} == {512}
    sequences = {r["sequence_id"]: bytes(r["ids"]) for r in packing.assemble(placed).collect()}
    for r in rows:
        at = 4 * r["offset"]
        assert sequences[r["sequence_id"]][at : at + 4 * r["length"]] == bytes(r["ids"])
    assert sum(map(len, sequences.values())) == sum(4 * r["length"] for r in rows) and max(map(len, sequences.values())) <= 2048
    assert packing.pack(packing.cut_documents(none)).count() == 0


def test_word_cache_gives_the_tokenizers_ids(spark, sf_dir):
    bpe = packing.ByteBpe(packing.default_tokenizer())
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += ["it's  we'll\t\n x\xa0\x85y \x1c\x1d z²½ 12a", "a\n\n\n b   c  ", "'s 'S <|endoftext|>", "\u2003 wide \u4f60"]
    for t in texts:
        assert bpe.encode(t) == array("I", bpe.tokenizer.encode(t, add_special_tokens=False).ids).tobytes()


def test_share_out_redistributes_among_siblings_first():
    tokens = {("a", "x", "1"): 10, ("a", "x", "2"): 100, ("a", "y", "1"): 100, ("b", "x", "1"): 1000}
    m = mixing.Mixture(max_epochs=1)
    b = mixing.leaf_budgets(tokens, 200, m)
    # a gets 100, x 50 of it; its source 1 has only 10, the other takes the rest
    assert b == {("a", "x", "1"): 10, ("a", "x", "2"): 40, ("a", "y", "1"): 50, ("b", "x", "1"): 100}
    b = mixing.leaf_budgets(tokens, 600, m)
    assert sum(v for k, v in b.items() if k[0] == "a") == 210 and b[("b", "x", "1")] == 390
    assert sum(mixing.leaf_budgets(tokens, 10**6, m).values()) == 1210
    assert mixing.share_out(5, {"u": (0.0, 9), "v": (1.0, 3)}) == {"u": 0, "v": 3}


def test_mix_prefix_by_brute_force(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for small in (4000, 2):  # the second narrows ranges several times
        monkeypatch.setattr(mixing, "SMALL", small)
        got = mixing.mix(docs).select("row.doc_id", *mixing.LEVELS, "n_tokens", "epoch").collect()
        lean = mixing._with_leaf(docs, "doc_id", "text", "lang", "source", mixing.source_domain).drop("row")
        everything = lean.select("*", *[mixing._order(17, F.lit(e).cast("long")).alias(f"h{e}") for e in (0, 1, 2)]).collect()
        tokens = Counter()
        for r in everything:
            tokens[tuple(r[c] for c in mixing.LEVELS)] += r["n_tokens"]
        budgets = mixing.leaf_budgets(dict(tokens), sum(tokens.values()), mixing.PRODUCTION)
        want = Counter()
        for leaf, budget in budgets.items():
            epochs, room = divmod(budget, tokens[leaf]) if tokens[leaf] else (0, 0)
            mine = [r for r in everything if tuple(r[c] for c in mixing.LEVELS) == leaf]
            for e in range(epochs):
                want.update((r["_id"], e) for r in mine)
            if room:
                for r in sorted(mine, key=lambda r: r[f"h{epochs}"]):
                    room -= r["n_tokens"]
                    if room < 0:
                        break
                    want[r["_id"], epochs] += 1
        assert Counter((r["doc_id"], r["epoch"]) for r in got) == want


def test_mix_edges(edge, none):
    rows = mixing.mix(edge, share=0.5).collect()
    assert {r["language"] for r in rows} <= {"en", "de", "fr", "unknown"}
    assert mixing.mix(none).count() == 0
    assert mixing.mix(edge, share=0.9).select("row.*").columns == edge.columns


def _resident() -> int:
    with open("/proc/self/smaps_rollup") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon:")) >> 10


def test_released_tasks_leave_no_unused_memory():
    def work(batches):
        for batch in batches:
            words = [f"{i}-{'x' * 600}" for i in range(300_000)]  # beyond the small objects that Python keeps in pools
            held = pa.array(words)
            peaks.append(_resident())
            yield batch.slice(0, min(1, len(held)))

    peaks, before = [], _resident()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["x"])
    out = list(common.released(work)(iter([batch, batch])))
    assert [b.num_rows for b in out] == [1, 1]
    assert max(peaks) - before > 300
    assert _resident() - before < 60


def test_leaf_tables_start_no_python_workers(spark):
    rows = [("web", "en", "src0", 1, 20, None), ("web", "de", "src1", 0, 7, -3)]
    for some in (rows, []):
        leaves = mixing._leaf_table(spark, some)
        assert leaves.schema == mixing.CUTS
        assert [tuple(r) for r in leaves.collect()] == some
        assert "RDD" not in leaves._jdf.queryExecution().executedPlan().toString()
