"""Writers. Every one runs in parallel: a table is a folder of files, never one file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from topictide.functions import text as T
from topictide.operators.staging import RAW_FIELDS
from topictide.session import materialise
from topictide.sources.readers import CSV_OPTIONS


def flat_arrays(df: DataFrame, separator: str = ", ") -> DataFrame:
    """Array columns rendered as joined strings, for text formats."""
    flat = [
        F.array_join(F.col(f"`{f.name}`").cast("array<string>"), separator).alias(f.name)
        if isinstance(f.dataType, ArrayType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*flat)


# Rows and bytes of text per file when a table is clustered by its folders. A task reads a file with line breaks in its fields whole.
FILE_ROWS = 200_000
FILE_BYTES = 64 << 20


def _folder_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    """(_folder, _rows, _bytes): rows and bytes of text by folder."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, StringType)]
    size = F.sum(sum(texts, F.lit(0).cast("long"))).alias("_bytes")
    return df.groupBy(F.struct(*keys).alias("_folder")).agg(F.count("*").alias("_rows"), size)


def clustered(df: DataFrame, keys: list[str], per_file: int = FILE_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Rows gathered by folder, so that a folder gets one file per ``per_file`` rows or ``FILE_BYTES`` of text and not one per task.

    Large folders are spread over as many tasks as they need files (their sizes are one row per folder).
    """
    sizes = _folder_sizes(df, keys) if sizes is None else sizes
    files = F.ceil(F.greatest(F.col("_rows") / per_file, F.col("_bytes") / FILE_BYTES))
    salt = F.pmod(F.xxhash64(*df.columns), F.col("_files")).alias("_salt")
    salted = df.withColumn("_folder", F.struct(*keys)).join(sizes.select("_folder", files.alias("_files")), "_folder").select(*df.columns, salt)
    return salted.repartition(*keys, "_salt").drop("_salt")


def _replace(df: DataFrame, path: str, keys: list[str], mode: str, fmt: str, options: dict[str, str]) -> None:
    """Write folders by ``keys``. Mode ``replace`` overwrites the folders that ``df`` has rows for and no others."""
    sizes = materialise(_folder_sizes(df, keys), "folder-sizes")
    # a task may hold several parts of a folder, which would go into one file
    rows, size = sizes.agg(F.sum("_rows"), F.sum("_bytes")).first()
    limit = min(FILE_ROWS, max(1, rows * FILE_BYTES // size)) if size else FILE_ROWS
    writer = clustered(df, keys, sizes=sizes).write.partitionBy(*keys).options(**options).option("maxRecordsPerFile", str(limit))
    if mode == "replace":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer.format(fmt).mode(mode).save(path)


def write_raw(assigned: DataFrame, path: str, mode: str = "replace") -> None:
    """Raw records of assigned intervals, one folder ``interval=<start>_to_<end>`` each.

    Intervals already written stay as they are; one that is written again is replaced.
    """
    day = "yyyy-MM-dd"
    interval = F.concat_ws("_to_", F.date_format("start", day), F.date_format("end", day))
    rows = assigned.select(*[F.col(c).cast("string") for c in RAW_FIELDS], interval.alias("interval"))
    _replace(rows, path, ["interval"], mode, "csv", CSV_OPTIONS)


def written_intervals(raw: DataFrame) -> DataFrame:
    """(start, end) of the intervals a folder of raw records holds.

    ``raw`` is the folder read with its ``interval`` partition column; only names are read.
    """
    bounds = F.split("interval", "_to_")
    return raw.select("interval").distinct().select(
        F.to_timestamp(bounds[0]).alias("start"), F.to_timestamp(bounds[1]).alias("end")
    )


def write_staged(staged: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Staged documents as Parquet, partitioned by an integer year."""
    _replace(staged, path, ["year"], mode, "parquet", {})


def write_metadata(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    docs.select("id", "title", "published").write.mode(mode).parquet(path)


def write_corpus(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cleaned texts as lines in ``doc_id`` order; files and lines keep the order."""
    ordered = docs.orderBy("doc_id").select(F.coalesce(T.strip(F.col("text")), F.lit("")).alias("value"))
    ordered.write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = flat_arrays(df).write.options(**CSV_OPTIONS).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_embeddings(vectors: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Vectors as Parquet float arrays, partitioned by slice."""
    rows = vectors.withColumn("embedding", F.col("embedding").cast("array<float>"))
    _replace(rows, path, ["slice"], mode, "parquet", {})


def result_path(base: str, job_name: str, kind: str) -> str:
    return f"{base.rstrip('/')}/{job_name}/{kind}"


def write_results(
    df: DataFrame, base: str, job_name: str, config_hash: str, model: str, kind: str, mode: str = "replace"
) -> str:
    """Store one result table below ``<base>/<job>/<kind>``, partitioned by model,
    configuration and slice: results of several models never overwrite each other, and a second run of one replaces its own."""
    path = result_path(base, job_name, kind)
    rows = df.withColumn("model", F.lit(model)).withColumn("config_hash", F.lit(config_hash))
    _replace(rows, path, ["model", "config_hash", "slice_label"], mode, "parquet", {})
    return path
