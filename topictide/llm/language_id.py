"""Language identification with bit-sliced Bloom filters over character n-grams.

Bit l of every filter word belongs to language l, so ANDing the words at an n-gram's positions gives the mask of all languages that
contain it. A text is decided by how many of its n-grams each language contains; counts are corrected for the
filter's false positives, whose rate follows from the filled share of each slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topictide.llm.common import small_batches

SIZES = (2, 3)  # n-gram lengths, word boundaries included
PROBES, LOG_BITS = 3, 20  # 2^20 words of 8 bytes: 8 MB for each 64 languages
CHUNK = 1 << 20  # characters handled at once
UNKNOWN = "und"
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def _codes(text: str, letters: np.ndarray) -> np.ndarray:
    """Lower-case letters as code points; every run of anything else is one 0, also at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letters[codes], codes, np.uint32(0))
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    return codes[(codes != 0) | np.r_[True, codes[:-1] != 0]]


def ngram_hashes(text: str, letters: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of all n-grams that hold a letter, chunk by chunk; chunks overlap so that none is lost or repeated."""
    codes = _codes(text, letters)
    if not codes.any():
        return
    for n in SIZES:
        for start in range(0, len(codes) - n + 1, CHUNK):
            part = codes[start : start + CHUNK + n - 1]
            h = np.full(len(part) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ part[k : k + len(h)]) * _PRIME
                h ^= h >> np.uint64(29)
            yield h


def _positions(h: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(PROBES):
        yield (h >> np.uint64(k * LOG_BITS)) & np.uint64((1 << LOG_BITS) - 1)


@dataclass(frozen=True)
class LanguageFilters:
    """``words[w]`` holds the slices of languages 64 w to 64 w + 63; ``rates`` are false-positive rates."""

    languages: tuple[str, ...]
    words: np.ndarray
    rates: np.ndarray

    def counts(self, text: str, letters: np.ndarray) -> np.ndarray | None:
        """Corrected number of the text's n-grams in each language; None if it has no letter."""
        total, found = 0, np.zeros(len(self.languages))
        for h in ngram_hashes(text, letters):
            total += len(h)
            at = list(_positions(h))
            for w, slices in enumerate(self.words):
                mask = slices[at[0]] & slices[at[1]] & slices[at[2]]
                for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                    found[i] += np.count_nonzero(mask & np.uint64(1 << (i - 64 * w)))
        if not total:
            return None
        return np.maximum((found - total * self.rates) / (1 - self.rates), 0)

    def predict(self, text: Column) -> Column:
        """struct<lang_pred, score>: the language of the largest count and its share of all counts.

        Ties go to the smaller name; without a letter the language is ``und`` and the score 0."""
        small_batches()
        # 8 MB for each 64 languages, whatever the corpus
        shared = SparkSession.getActiveSession().sparkContext.broadcast((self.languages, self.words, self.rates))

        @F.pandas_udf("lang_pred string, score double")
        def predict_language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            model, letters = LanguageFilters(*shared.value), _letters()
            for texts in batches:
                out = [decide(model, t, letters) for t in texts]
                yield pd.DataFrame(out, columns=["lang_pred", "score"])

        return predict_language(text)


def decide(model: LanguageFilters, text: str | None, letters: np.ndarray) -> tuple[str, float]:
    counts = model.counts(text, letters) if text else None
    if counts is None or not model.languages:
        return UNKNOWN, 0.0
    best, total = int(np.argmax(counts)), counts.sum()
    return model.languages[best], round(float(counts[best] / total), 6) if total else round(1 / len(counts), 6)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 1000,
    min_count: int = 5,
    contrast: float = 0.5,
    max_ngrams: int = 200_000,
) -> LanguageFilters:
    """Filters from rows with a text, a language and an id.

    Bounds: about ``docs_per_language`` documents of each language are read (chosen by a hash of the id) and the
    ``max_ngrams`` most frequent n-grams are stored. A language contains an n-gram if it shows it ``min_count``
    times and at least ``contrast`` times as often, for its size, as the language that shows it most.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return LanguageFilters((), np.zeros((1, 1 << LOG_BITS), np.uint64), np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, docs_per_language / sizes[lang]))])
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count_ngrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = _letters()
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                # a few texts at a time keep memory bounded
                held, size = [], 0
                for text in [*group["text"], None]:
                    if text is not None:
                        held += ngram_hashes(text, letters)
                        size += len(text)
                    if held and (text is None or size > CHUNK):
                        values, times = np.unique(np.concatenate(held), return_counts=True)
                        yield pd.DataFrame({"lang": lang, "gram": values.view(np.int64), "n": times})
                        held, size = [], 0

    counted = sample.select("lang", "text").mapInPandas(count_ngrams, "lang string, gram long, n long")
    counted = counted.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    per_gram = counted.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n"), F.max("n").alias("most"))
    top = per_gram.where(F.col("most") >= min_count).orderBy(F.desc("most"), "gram").limit(max_ngrams).collect()

    totals = np.zeros(len(languages))
    number = {lang: i for i, lang in enumerate(languages)}
    times = np.zeros((len(top), len(languages)))
    for i, r in enumerate(top):
        for lang, n in r["n"].items():
            times[i, number[lang]] = n
    totals = np.maximum(times.sum(0), 1)
    rate = times / totals
    has = (times >= min_count) & (rate >= contrast * rate.max(axis=1, keepdims=True))
    grams = np.array([r["gram"] for r in top], np.int64).view(np.uint64)
    words = np.zeros((-(-len(languages) // 64), 1 << LOG_BITS), np.uint64)
    filled = np.zeros(len(languages))
    for i in range(len(languages)):
        bit = np.uint64(1 << (i % 64))
        for at in _positions(grams[has[:, i]]):
            words[i // 64][at] |= bit
        filled[i] = np.count_nonzero(words[i // 64] & bit) / (1 << LOG_BITS)
    return LanguageFilters(languages, words, filled**PROBES)


def identify(docs: DataFrame, model: LanguageFilters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score), one row per row of ``docs``: repeated rows and null ids too; null texts and texts without a
    letter are ``und`` with score 0. Only id and text are read; an empty table gives an empty result."""
    found = docs.select(F.col(id_col).alias("id"), model.predict(F.col(text_col)).alias("p"))
    return found.select(F.col("id").alias(id_col), F.col("p.lang_pred").alias("lang_pred"), F.col("p.score").alias("score"))
