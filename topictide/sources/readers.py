"""Readers: raw records, staged and processed documents, stopwords, result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from topictide.functions import text as T
from topictide.operators.staging import RAW_FIELDS

RAW_SCHEMA = StructType([StructField(name, StringType()) for name in RAW_FIELDS])
# Options that keep line breaks, commas and doubled quotes inside a field.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
# Stopwords up to this number become literals of the plan.
MAX_LITERAL_STOPWORDS = 50_000


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw interval files (a folder, or a pattern such as ``raw/raw_*.csv``); an empty field is null."""
    reader = spark.read.schema(RAW_SCHEMA).options(**CSV_OPTIONS)
    return reader.option("multiLine", "true").option("recursiveFileLookup", "true").csv(path)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Staged documents; ``year`` is the partition column, so year filters skip files."""
    return spark.read.parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned texts, one document per line."""
    return spark.read.text(path).select(T.strip(F.col("value")).alias("text"))


def read_stopwords(spark: SparkSession, path: str, top: int | str | None = "all") -> DataFrame:
    """(pos, word) of a newline-separated list: stripped, lower-cased, without blank lines.

    ``top`` is "all", a number of leading words, or None for no stopwords. A missing file
    raises. The list is read as one value so that line order is certain.
    """
    if top != "all" and top is not None and (isinstance(top, bool) or not isinstance(top, int)):
        raise ValueError(f"top must be 'all', a number or None, not {top!r}")
    lines = spark.read.text(path, wholetext=True).select(F.split("value", r"\r?\n").alias("lines"))
    clean = F.transform("lines", lambda line: F.lower(T.strip(line)))
    listed = lines.select(F.posexplode(F.filter(clean, lambda w: w != "")).alias("pos", "word"))
    if top == "all":
        return listed
    return listed.where(F.col("pos") < (0 if top is None else top))


def stopword_list(stopwords: DataFrame) -> list[str] | DataFrame:
    """The words as a Python list, which becomes literals of a plan; a longer list stays the table that it is."""
    rows = stopwords.orderBy("pos").select("word").limit(MAX_LITERAL_STOPWORDS + 1).collect()
    return stopwords if len(rows) > MAX_LITERAL_STOPWORDS else [r["word"] for r in rows]


def read_slice_results(spark: SparkSession, path: str, schema: str, pattern: str = "*.csv") -> DataFrame:
    """Per-slice CSV files ``<kind>_<slice>.csv`` with the slice label taken from the name."""
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", "true")
    rows = reader.csv(f"{path.rstrip('/')}/{pattern}")
    label = F.regexp_extract(F.col("_metadata.file_name"), r"([^_]+)\.[^.]*$", 1)
    return rows.withColumn("slice_label", label)
