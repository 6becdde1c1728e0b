"""Edges of the pipeline and of operators on pages, conversations and equal digests."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from topictide.llm import chat_format, exact_dedup, url_filter
from topictide.session import scratch


def test_pipeline_chain_on_edges(spark, edge, none, sf_dir, tmp_path):
    for start in (edge, none):
        docs = start
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{start.count()}-{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            before, docs = docs, spark.read.parquet(path)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == start.columns and docs.count() <= before.count()
                # every row was there before, and no oftener
                left = Counter(map(str, docs.collect()))
                assert not left - Counter(map(str, before.collect()))
        if start is none:
            assert docs.count() == 0


def test_each_pipeline_stage_on_edges(spark, edge, sf_dir):
    kept = {name: stage(spark, edge, sf_dir).collect() for name, stage in corpus_pipeline.STAGES}
    ids = lambda name: Counter(r["doc_id"] for r in kept[name])
    assert ids("exact_dedup") == Counter([2, 4, 5, 6, 7, 8, None])  # the empty and the null text are equal; of 1 and 2 the larger stays
    assert ids("ngram_jaccard_join") == Counter([1, 3, 4, 5, 6, 7, 8, None])
    assert set(ids("quality_classifier")) <= set(ids("best_fit_packing"))
    places = [(r["sequence_id"], r["offset"], r["length"]) for r in kept["best_fit_packing"]]
    for s in {p[0] for p in places}:
        mine = sorted(p[1:] for p in places if p[0] == s)
        assert [o for o, _ in mine] == [0, *np.cumsum([n for _, n in mine])[:-1]] and sum(n for _, n in mine) <= 2048


def test_pipeline_deletes_what_it_has_read(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[1:3])
    with scratch(spark, "test") as folder:
        rows = corpus_pipeline.run(spark, sf_dir)
        assert [name.split("-")[1] for name in os.listdir(folder)] == ["ngram_jaccard_join"]
        assert 0 < rows.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_texts_with_equal_digests_are_compared(spark, monkeypatch):
    class SameDigest:
        def __getattr__(self, name):
            return getattr(F, name)

        def sha2(self, *_):
            return F.lit("same")

    monkeypatch.setattr(exact_dedup, "F", SameDigest())
    monkeypatch.setattr(exact_dedup, "hash128", lambda c: F.unhex(F.lit("00")))
    rows = [(1, "a"), (2, "b"), (3, "A"), (4, "b"), (4, "b"), (5, None), (6, "")]
    found = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep="max").collect()
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found)
    assert got == Counter([(1, 3, 2, False), (3, 3, 2, True), (2, 4, 3, False), (4, 4, 3, True), (4, 4, 3, False), (5, 6, 2, False), (6, 6, 2, True)])


def test_url_filter_edges(spark):
    long = "http://ads.example.de/" + "a/" * 50_000
    urls = [long, long, long + "?x=1", None, "", "http://", "://", "http://ads.example.de#f"]
    rows = [(i // 2 if i else None, u, 1, "m", "h", "c", True, 7) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, block int, m0 string, host string, canonical string, possible boolean, w0 long")
    listed = spark.createDataFrame([(url, 1) for url in (long.split("://")[1].rstrip("/"), "ads.example.de")], "url string, block int")
    found = url_filter.filter_urls(pages, listed)
    got = Counter((r["page_id"], r["host"], len(r["path"]), r["listed"], r["verdict"]) for r in found.collect())
    host = "ads.example.de"
    want = [(None, host, 100_001, True, "block"), (0, host, 100_001, True, "block"), (1, host, 100_001, False, "allow"), (1, "", 0, False, "allow"),
            (2, "", 0, False, "allow"), (2, "", 0, False, "allow"), (3, "", 0, False, "allow"), (3, host, 0, True, "block")]
    assert got == Counter(want)


@pytest.mark.parametrize("copied", [1 << 20, 5])
def test_chat_of_long_conversations_and_clashing_columns(spark, monkeypatch, copied):
    monkeypatch.setattr(chat_format, "COPIED", copied)
    rows = [(1, t, "assistant" if t % 2 else "user", f"<|im_end|>{t}é" * (60_000 if t == 3 else 3), b"x", 5, [1]) for t in range(12)]
    rows += [(None, 1, "user", "no id", b"", 0, []), (None, 1, "user", "no id", b"", 0, [])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted binary, n_turns long, loss array<int>")
    made = {r["conv_id"]: r for r in chat_format.format_chat(df).collect()}
    turns = [(a.decode(), b.decode()) for a, b in chat_format.parse(bytes(made[1]["formatted"]))]
    assert turns == [(r[2], r[3]) for r in rows[:12]] and made[1]["n_turns"] == 12 and made[None]["n_turns"] == 2
    taught = "".join(chat_format.unescape(bytes(made[1]["formatted"])[s["start"] : s["stop"]]).decode() for s in made[1]["loss"])
    assert taught == "".join(r[3] for r in rows[:12] if r[2] == "assistant")


def test_assembling_takes_a_few_times_the_text():
    import tracemalloc

    import pyarrow as pa

    text = "x" * (24 << 20)
    rows = pa.table({"conv_id": pa.array([1, 1]), "role": pa.array(["user", "assistant"]), "text": pa.array([text, "short"])})
    tracemalloc.start()
    chat_format.assemble(rows)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 4 * len(text)
