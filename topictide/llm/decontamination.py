"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, scanned over training texts, hits verified.

A window is ten consecutive words of a benchmark item (all words of a shorter one). Wherever a window of w words stands in a
text, one of the text's aligned blocks, ceil(w / 2) words from a multiple of that number on, lies wholly inside it.
So the scan looks up one hash for every five words of a text, against the set of all five-word runs of the benchmark
(shorter runs for shorter windows). Only around blocks that are in the set are whole windows cut out and compared, word by
word, with the benchmark's. Everything is a DataFrame expression.

The set and the windows are broadcast while they have at most ``max_broadcast`` rows; a larger benchmark is joined by
hash, which Spark can split where one n-gram is very common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topictide.llm.bloom import only
from topictide.llm.common import ascii_lower, hash128, text_of
from topictide.session import materialise

# Words are runs of ASCII digits, ASCII letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
MAX_BROADCAST = 1_000_000  # rows: at ten words of usual length some 150 MB of windows, and less of hashes


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lower_words(text: Column) -> Column:
    """Words with A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(text), NO_WORD), "")


def _grams(words: Column, width: int, step: int) -> Column:
    """Hashes of the runs of ``width`` words that start at every ``step``-th word."""
    last = F.size(words) - width
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(window, width, origin) of every different window, and (origin, items): items that share all of a window."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), lower_words(text_of(text_col)).alias("words")
    ).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - width + 1)
    cut = items.select("item", "words", width.alias("width"), F.explode(starts).alias("at"))
    cut = cut.select("item", "width", F.array_join(F.slice("words", F.col("at"), F.col("width")), " ").alias("window"))
    per_window = cut.groupBy("window", "width").agg(F.array_sort(F.collect_set("item")).alias("items"))
    per_window = materialise(per_window.withColumn("origin", hash128(F.to_json("items"))), "windows")
    origins = per_window.groupBy("origin").agg(F.first("items").alias("items"))
    return per_window.select("window", "width", "origin"), origins


def _within(df: DataFrame, rows: int, most: int) -> DataFrame:
    return F.broadcast(df) if rows <= most else df


def _scan(rows: DataFrame, windows: DataFrame, max_broadcast: int) -> tuple[DataFrame, DataFrame]:
    """(id, key, n_words) of all rows and (key, width, at) of the aligned blocks that are in the set of benchmark runs.

    Texts are read once: the hashes of their blocks, eight bytes for every five words, are written and then looked up."""
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # at most as many as a window has words
    blocks = {w: (w + 1) // 2 for w in widths}
    worded = rows.select("id", "key", lower_words(F.col("text")).alias("words"))
    sizes = sorted(set(blocks.values()))
    scanned = worded.select(
        "id", "key", F.size("words").cast("long").alias("n_words"), *[_grams(F.col("words"), b, b).alias(f"grams{b}") for b in sizes]
    )
    scanned = materialise(scanned, "scanned")
    found = None
    for width in widths:
        block = blocks[width]
        runs = windows.where(F.col("width") == width).select(F.split("window", " ").alias("words"))
        known = materialise(runs.select(F.explode(_grams(F.col("words"), block, 1)).alias("gram")).distinct(), "grams")
        hits = scanned.select("key", F.posexplode(f"grams{block}").alias("at", "gram"))
        hits = hits.join(_within(known, known.count(), max_broadcast), "gram", "left_semi")
        hits = hits.select("key", F.lit(width).alias("width"), (F.col("at") * block).alias("at"))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = rows.select("key", F.lit(0).alias("width"), F.lit(0).alias("at")).limit(0)
    return scanned.select("id", "key", "n_words"), found


def _occurrences(rows: DataFrame, hits: DataFrame, windows: DataFrame, n_windows: int, max_broadcast: int) -> DataFrame:
    """(key, span, origin) of every place where a window stands, words compared one by one."""
    around = materialise(hits.groupBy("key").agg(F.collect_set(F.struct("width", "at")).alias("around")), "hit-blocks")
    touched = only(rows.select("key", "text"), around, "key").join(around, "key")
    touched = touched.groupBy("key").agg(F.first("text").alias("text"), F.first("around").alias("around"))
    touched = touched.select("key", "around", lower_words(F.col("text")).alias("words"))
    block = lambda h: F.floor((h["width"] + 1) / 2).cast("int")
    # a window over the block at `at` starts in the last width - block words before it
    starts = F.transform(
        "around",
        lambda h: F.transform(
            F.sequence(F.greatest(h["at"] + block(h) - h["width"], F.lit(0)), h["at"]),
            lambda i: F.struct(h["width"].alias("width"), i.alias("start")),
        ),
    )
    touched = touched.select("key", "words", F.array_distinct(F.flatten(starts)).alias("starts"))
    tried = F.transform(
        F.filter("starts", lambda s: s["start"] + s["width"] <= F.size("words")),
        lambda s: F.struct(
            s["start"].alias("start"), s["width"].alias("width"), F.array_join(F.slice("words", s["start"] + 1, s["width"]), " ").alias("window")
        ),
    )
    # written before it is exploded, so that no row carries the words of its text
    tried = materialise(touched.select("key", tried.alias("tried")), "tried").select("key", F.explode("tried").alias("t")).select("key", "t.*")
    met = tried.join(_within(windows, n_windows, max_broadcast), ["window", "width"])
    return met.select("key", F.struct("start", (F.col("start") + F.col("width")).alias("stop")).alias("span"), "origin")


def _merged(spans: Column) -> Column:
    """Maximal runs of words covered by sorted (start, stop)."""
    kind = "array<struct<start:int,stop:int>>"

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))),
        )
        apart = (F.size(done) == 0) | (s["start"] > last["stop"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(joined)

    # last of an empty array is null, not an error
    return F.aggregate(spans, F.array().cast(kind), lambda done, s: F.when(F.size(done) == 0, F.array(s)).otherwise(add(done, s)))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """(id, key, n_words, n_hit, n_items, items_sha256, spans, contaminated), one row per row of ``docs``.

    ``spans`` are the maximal runs of words (start, stop; from 0) inside occurrences of windows, ``n_hit`` their words. Words are
    compared with A-Z in lower case; a null text has none. ``n_items`` counts the items of which a window occurs and ``items_sha256`` digests
    their sorted, comma-joined ids (SHA-256 of nothing if there are none). Rows of the benchmark with one id are one item, a null id is
    an empty one. ``key`` is the MD5 of the text: repeated texts are compared once, repeated ids and null
    ids are rows like others. Only the named columns are read; an empty table on either side gives no hit.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("id", "text", hash128(F.col("text")).alias("key"))
    windows, origins = benchmark_windows(benchmark, item_col, item_text_col, window)
    lean, hits = _scan(rows, windows, max_broadcast)
    met = _occurrences(rows, hits, windows, windows.count(), max_broadcast)
    per_text = met.groupBy("key").agg(
        _merged(F.array_sort(F.collect_set("span"))).alias("spans"), F.array_sort(F.collect_set("origin")).alias("origins")
    )
    per_text = materialise(per_text.withColumn("mix", hash128(F.array_join(F.transform("origins", F.hex), ","))), "contaminated")
    # texts hit by the same origins share their items
    mixes = per_text.groupBy("mix").agg(F.first("origins").alias("origins"))
    items = mixes.select("mix", F.explode("origins").alias("origin")).join(origins, "origin").select("mix", F.explode("items").alias("item"))
    items = items.groupBy("mix").agg(F.array_sort(F.collect_set("item")).alias("items"))
    items = items.select("mix", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    per_text = per_text.join(items, "mix").select("key", "spans", "n_items", "items_sha256")
    kind = "array<struct<start:int,stop:int>>"
    spans = F.coalesce("spans", F.array().cast(kind))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    joined = lean.join(per_text, "key", "left").withColumn("spans", spans)
    return joined.select(
        F.col("id").alias(id_col),
        "key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        "spans",
        (n_hit > 0).alias("contaminated"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words in ``spans`` and what separates each of them from the next word."""
    words, between = words_of(text), F.split(text, WORD)

    def kept(i: Column) -> Column:
        hit = F.exists(spans, lambda s: (s["start"] <= i) & (i < s["stop"]))
        return F.when(hit, F.lit("")).otherwise(F.concat(F.get(words, i), F.get(between, i + 1)))

    places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.concat(F.get(between, F.lit(0)), F.array_join(F.transform(places, kept), ""))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: str = "documents", **settings
) -> DataFrame:
    """``docs``, all columns, without contaminated documents or (``remove="spans"``) with the hit words taken out of their texts.

    Rows are matched by the MD5 of their text, so copies fare alike; see ``find_contamination`` for the rest."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    found = find_contamination(docs, benchmark, id_col, text_col, **settings).where("contaminated")
    found = found.select(F.col("key").alias("_key"), F.col("spans").alias("_spans")).dropDuplicates(["_key"])
    rows = docs.select(F.struct("*").alias("_row"), hash128(text_of(text_col)).alias("_key"))
    if remove == "documents":
        return rows.join(found.select("_key"), "_key", "left_anti").select("_row.*")
    text = F.col("_row").getField(text_col)
    cut = F.when(F.col("_spans").isNull(), text).otherwise(without_spans(text, F.col("_spans")))
    joined = rows.join(found, "_key", "left")
    return joined.select(F.col("_row").withField(text_col, cut).alias("_row")).select("_row.*")
