"""Text cleaning and tokenising as Column expressions.

Everything runs inside the JVM except Unicode NFKD, for which Spark has no builtin; that
step is an Arrow UDF which only ever receives the rows holding a non-ASCII character.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from topictide.session import small_batches

# ---- fixed values -------------------------------------------------------------------
# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Whitespace as a Unicode-aware regular expression class (Java's own leaves out the four
# information separators).
WHITESPACE = r"[\s\x1c-\x1f]"
NOT_WHITESPACE = r"[^\s\x1c-\x1f]"
# A token is a run of at least two letters, digits or underscores; combining marks split.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Whole-word contractions that no suffix rule covers.
IRREGULAR_CONTRACTIONS = {
    "ain't": "are not",
    "can't": "cannot",
    "let's": "let us",
    "ma'am": "madam",
    "o'clock": "of the clock",
    "shan't": "shall not",
    "won't": "will not",
    "y'all": "you all",
}
# Suffix rules, applied after the whole words above.
CONTRACTION_SUFFIXES = {
    "n't": " not",
    "'re": " are",
    "'ve": " have",
    "'ll": " will",
    "'m": " am",
    "'d": " would",
}
# Words after which 's stands for "is" and not for a possessive.
IS_SUBJECTS = ("he", "here", "how", "it", "she", "that", "there", "what", "when", "where", "who", "why")
# ---- end of fixed values ------------------------------------------------------------

_APOSTROPHE = "['’]"
_NOT_IN_WORD = r"(?<![\p{L}\p{N}_])"
_WORD_END = r"(?![\p{L}\p{N}_])"


def expand_contractions(text: Column) -> Column:
    """Spell out English contractions, for the straight and the typographic apostrophe.

    No rule looks beyond a blank, so the rules run over the words with an apostrophe only."""

    def word(w: Column) -> Column:
        return F.when(w.contains("'") | w.contains("’"), _expand_word(w)).otherwise(w)

    out = F.array_join(F.transform(F.split(text, " "), word), " ")
    # most rows hold no apostrophe and skip the whole chain
    return F.when(text.rlike(_APOSTROPHE), out).otherwise(text)


def _expand_word(out: Column) -> Column:
    for form, full in IRREGULAR_CONTRACTIONS.items():
        pattern = form.replace("'", _APOSTROPHE)
        out = F.regexp_replace(out, f"(?i){_NOT_IN_WORD}{pattern}{_WORD_END}", full)
    for suffix, full in CONTRACTION_SUFFIXES.items():
        pattern = suffix.replace("'", _APOSTROPHE)
        out = F.regexp_replace(out, rf"(?i)(?<=\p{{L}}){pattern}{_WORD_END}", full)
    subjects = "|".join(IS_SUBJECTS)
    return F.regexp_replace(out, f"(?i){_NOT_IN_WORD}({subjects}){_APOSTROPHE}s{_WORD_END}", "$1 is")


def nfkd(text: Column, of: Column | None = None) -> Column:
    """Unicode compatibility decomposition (ASCII text is its own decomposition).

    ``of``: what ``text`` was computed from, if that decides whether it can hold other characters. Then the
    computation itself runs once per row, on one of the two branches.
    """

    small_batches()

    def normalise(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFKD", t), na_action="ignore")

    udf = F.pandas_udf(normalise, StringType())
    wide = (text if of is None else of).rlike(r"[^\x00-\x7F]")
    return F.coalesce(udf(F.when(wide, text)), text)


def collapse_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U){WHITESPACE}+", " ")


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)http{NOT_WHITESPACE}+", "")


def remove_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{WHITESPACE}+|{WHITESPACE}+$", "")


def clean_text(text: Column, contractions: bool = True, unicode_fold: bool = True) -> Column:
    """Contractions, lower case, NFKD, whitespace, URLs, punctuation, trim: in this order."""
    out = expand_contractions(text) if contractions else text
    out = F.lower(out)
    if unicode_fold:
        # contractions and lower case never bring in a character beyond ASCII
        out = nfkd(out, of=text)
    # blanks are the only whitespace left once runs are collapsed, so a plain trim is exact
    return F.trim(remove_punctuation(remove_urls(collapse_whitespace(out))))


def join_title_summary(title: Column, summary: Column) -> Column:
    """Title, a blank, summary; nulls are skipped, two nulls give the empty document."""
    return F.concat_ws(" ", title, summary)


def words(text: Column) -> Column:
    """Blank-separated words of a cleaned text (an empty text has none)."""
    return F.filter(F.split(F.trim(text), " +"), lambda w: w != "")


def remove_stopwords(text: Column, stopwords: Iterable[str]) -> Column:
    """Drop the words of a bounded list; the list becomes one hash set in the plan."""
    stop = sorted({w.strip().lower() for w in stopwords if w.strip()})
    if not stop:
        return text
    kept = F.filter(words(text), lambda w: ~F.lower(w).isin(stop))
    return F.array_join(kept, " ")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated a single time per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def count_terms(toks: Column) -> Column:
    """``array<struct<term, tf>>`` of a token array, without leaving the row.

    Sort, find where each run of equal tokens begins, and the distances are the counts. A
    document is one row, so its counts never need a shuffle.
    """

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))
        )

        def count(st: Column) -> Column:
            return F.transform(
                st,
                lambda p, j: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(st, j + 1), n) - p).cast("long").alias("tf"),
                ),
            )

        empty = F.array().cast("array<struct<term:string,tf:bigint>>")
        return F.when(n > 0, once(starts, count)).otherwise(empty)

    return once(F.sort_array(toks), runs)  # tokens are never null
