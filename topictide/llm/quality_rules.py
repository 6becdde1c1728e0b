"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topictide.llm.common import text_of

# ---- fixed values -------------------------------------------------------------------
WORD_SEPARATORS = " \t\n\x0b\x0c\r"
WORD_SEPARATOR_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
NGRAM = 5
# Frequent words of the languages in the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "was", "it", "on", "with", "as", "are",
    "de", "la", "le", "les", "et", "des", "en", "un", "une", "du", "que", "el", "los", "las", "del", "y", "por", "con",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "im", "dem",
)
# ---- end of fixed values ------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A statistic has to lie in [low, high]; documents under ``min_words`` words are not judged by it."""

    statistic: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


# Statistics: those of ``statistics`` below. The last rules are wide on purpose: short clean texts stay.
RULES = (
    Rule("n_words", low=10),
    Rule("repeat_word_pct", high=20),
    Rule("mean_word_chars", low=2, high=16),
    Rule("symbol_word_ratio", high=0.5),
    Rule("stop_word_ratio", low=0.01, min_words=100),
    Rule("dup_line_ratio", high=0.6, min_words=50),
)


def words_of(text: Column) -> Column:
    """Words of the text; the empty array if it has none."""
    bare = F.btrim(text, F.lit(WORD_SEPARATORS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_SEPARATOR_RUN))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, n: int = NGRAM) -> Column:
    """How many words lie in n-word windows that the text holds twice or more.

    Windows are compared by a 64-bit hash of their words within one text. Texts without a repeated window, most
    of them, end after one pass over a hash set; the others sort (hash, position) pairs.
    """

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(n)])

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - n), window_hash)

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def positions(p: Column) -> Column:
            same = lambda e, k: (F.get(p, k)["h"] == e["h"])
            twice = F.filter(
                p, lambda e, k: F.coalesce(same(e, k - 1), F.lit(False)) | F.coalesce(same(e, k + 1), F.lit(False))
            )
            return F.array_sort(F.transform(twice, lambda e: e["i"]))

        def covered(at: Column) -> Column:
            # a window adds its words up to where the next one starts
            gaps = F.transform(at, lambda i, k: F.least(F.coalesce(F.get(at, k + 1) - i, F.lit(n)), F.lit(n)))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        repeated = _let(_let(pairs, positions), covered)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(repeated)

    return F.when(F.size(words) < n, F.lit(0).cast("long")).otherwise(_let(hashes, count))


def duplicate_lines(text: Column) -> Column:
    """(lines with a word, those of them that equal an earlier one)."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WORD_SEPARATORS)) != "")
    return _let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")
        ),
    )


def statistics(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """A struct of every statistic that rules can name."""

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*stop_words))).cast("long").alias("n_stop_words"),
        )

    lines = duplicate_lines(text)
    return F.struct(
        _let(words_of(text), of_words).alias("w"),
        F.char_length(F.regexp_replace(text, WORD_SEPARATOR_RUN, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("l"),
    )


def apply_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, counts, ``failed``: names of the broken rules, ``kept``), one row per row of ``docs``.

    Null text counts as empty: no word, hence every count is 0 and the length rule fails. Ratios of a text without words
    are 0. Repeated rows, null ids and further columns change nothing; an empty table gives an empty result.
    """
    s = docs.select(F.col(id_col).alias("id"), statistics(text_of(text_col)).alias("s"))
    counts = {
        "n_words": F.col("s.w.n_words"),
        "word_chars": F.col("s.word_chars"),
        "n_symbols": F.col("s.n_symbols"),
        "n_lines": F.col("s.l.lines"),
        "n_dup_lines": F.col("s.l.dup"),
        "n_repeat_words": F.col("s.w.n_repeat_words"),
        "n_stop_words": F.col("s.w.n_stop_words"),
    }
    flat = s.select("id", *[c.alias(name) for name, c in counts.items()])
    one = F.lit(1)
    derived = {
        "repeat_word_pct": 100 * F.col("n_repeat_words") / F.greatest("n_words", one),
        "mean_word_chars": F.col("word_chars") / F.greatest("n_words", one),
        "symbol_word_ratio": F.col("n_symbols") / F.greatest("n_words", one),
        "stop_word_ratio": F.col("n_stop_words") / F.greatest("n_words", one),
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", one),
    }
    value = {name: F.col(name) for name in counts} | derived
    broken = []
    for rule in rules:
        x = value[rule.statistic]
        out = F.lit(False)
        if rule.low is not None:
            out = out | (x < rule.low)
        if rule.high is not None:
            out = out | (x > rule.high)
        name = F.lit(rule.statistic)
        broken.append(F.when(out & (F.col("n_words") >= rule.min_words), name))
    failed = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return flat.select(F.col("id").alias(id_col), *counts, failed.alias("failed")).withColumn("kept", F.size("failed") == 0)
