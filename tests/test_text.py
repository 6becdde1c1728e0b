import string
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topictide.functions import text as T


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "given_text,expected",
    [
        ("Don't  STOP", "do not stop"),
        ("see http://a.b/c now", "see  now"),
        ("state-of-the-art", "stateoftheart"),
        ("snake_case", "snakecase"),
        ("naïve", "naïve"),
        ("ﬁne", "fine"),
        ("²x", "2x"),
        ("a b", "a b"),
        ("a\u0085b", "a b"),
        ("a\u001cb", "a b"),
        ("a", "a"),
        ("", ""),
        ("It’s  what we've", "it is what we have"),
        ("She can't; they won't", "she cannot they will not"),
        ("John's book", "johns book"),
        ("O'Reilly", "oreilly"),
    ],
)
def test_clean_text(spark, given_text, expected):
    assert apply(spark, [given_text], T.clean_text) == [expected]


def test_contractions_can_be_kept(spark):
    assert apply(spark, ["Don't stop"], lambda c: T.clean_text(c, contractions=False)) == ["dont stop"]


def test_tokens(spark):
    assert apply(spark, ["naïve a bb b_c 12", "x", ""], T.tokens) == [["nai", "ve", "bb", "b_c", "12"], [], []]


def test_title_and_summary(spark):
    df = spark.createDataFrame([("t", "s"), (None, "x y"), (None, None)], "title string, summary string")
    rows = df.select(T.join_title_summary(F.col("title"), F.col("summary")).alias("o")).collect()
    assert [r["o"] for r in rows] == ["t s", "x y", ""]


def test_stopwords_are_whole_words_in_any_case(spark):
    out = apply(spark, ["the Cat THE  hat", "the", ""], lambda c: T.remove_stopwords(c, ["the", " Hat "]))
    assert out == ["Cat", "", ""]


def test_many_stopwords_become_one_hash_set(spark):
    df = spark.createDataFrame([("w1 keep w99",)], "v string")
    out = df.select(T.remove_stopwords(F.col("v"), [f"w{i}" for i in range(100)]).alias("o"))
    assert out.first()["o"] == "keep"


def test_count_terms(spark):
    df = spark.createDataFrame([(["bb", "aa", "bb"],), ([],)], "v array<string>")
    rows = df.select(T.count_terms(F.col("v")).alias("o")).collect()
    assert [[tuple(t) for t in r["o"]] for r in rows] == [[("aa", 1), ("bb", 2)], []]


def walk(text):
    """What cleaning leaves of a text, character by character, without contractions."""
    kept, blank, at = [], False, 0
    chars = unicodedata.normalize("NFKD", text.lower())
    while at < len(chars):
        c = chars[at]
        if c.isspace():
            if not blank:
                kept.append(" ")
            blank, at = True, at + 1
            continue
        blank = False
        if chars.startswith("http", at) and at + 4 < len(chars) and not chars[at + 4].isspace():
            while at < len(chars) and not chars[at].isspace():
                at += 1
            continue
        if not ("!" <= c <= "/" or ":" <= c <= "@" or "[" <= c <= "`" or "{" <= c <= "~"):
            kept.append(c)
        at += 1
    return "".join(kept).strip()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("aZé ñÇ\t\n '-_.!http:/9ßﬁ²"), max_size=40), min_size=1, max_size=40))
def test_cleaning_matches_plain_python(spark, texts):
    out = apply(spark, texts, lambda c: T.clean_text(c, contractions=False))
    assert out == [walk(t) for t in texts]
    assert not any(ch in string.punctuation or ch in string.ascii_uppercase for t in out for ch in t)


def test_contractions_between_any_blanks(spark):
    texts = ["don't  can't\tit's ", " I’m\nwe'll (y'all) d'she's", "o'clock's 'tis rock'n'roll'd", "'", "", None, "it’sn't x'ren't_ won't'd"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("t", T.expand_contractions(F.col("t")).alias("got"), T._expand_word(F.col("t")).alias("want")).collect()
    assert all(r["got"] == r["want"] for r in rows) and rows[0]["got"] == "do not  cannot\tit is "


def test_few_rows_at_a_time_for_python(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        T.nfkd(F.lit("é"))
        assert int(spark.conf.get(name)) <= 1000
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("bB")) <= 8 << 20
    finally:
        spark.conf.set(name, before)
