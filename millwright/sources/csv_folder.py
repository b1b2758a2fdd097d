"""CSV folders: raw rows as event envelopes, or one table per file."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas as S
from millwright.functions.parse import source_system_of


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Sorted entries of a folder on any file system Spark can read.

    An entry may be a file or a folder of part files written by Spark.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(path) or []
    return sorted(str(f.getPath().toString()) for f in found)


def _part_files(spark: SparkSession, entry: str) -> list[str]:
    """The CSV files of an entry: itself, or the part files of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(entry)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.getFileStatus(path).isDirectory():
        return [entry]
    found = (str(f.getPath().toString()) for f in fs.listStatus(path) if f.isFile())
    return sorted(f for f in found if f.rsplit("/", 1)[1][0] not in "_.")


def read_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names of a CSV file; its first record alone is read, quoted line breaks included."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
    lines, record = jvm.java.io.BufferedReader(text), ""
    try:
        while (line := lines.readLine()) is not None:
            record = f"{record}\n{line}" if record else line
            if record and record.count('"') % 2 == 0:
                break
    finally:
        lines.close()
    return tuple(next(csv.reader([record.removeprefix("\ufeff")], strict=False), ())) if record else ()


def ingest_csv_dir(
    spark: SparkSession,
    folders: list[str],
    pattern: str = "*.csv",
    mode: str = "kafka_to_datalake_raw",
    multi_line: bool = True,
) -> DataFrame:
    """One envelope per CSV row: file name, source system, 1-based row number, text payload.

    Files are read in one scan for each distinct header, however many there are; names and
    places come from the scan. Quoted line breaks belong to their record. A very large file
    without such breaks is divided among tasks with ``multi_line=False``.
    """
    entries = [path for folder in folders for path in list_files(spark, folder, pattern)]
    if not entries:
        raise FileNotFoundError(f"no {pattern} file in {folders}")
    with ThreadPoolExecutor(16) as pool:
        parts = list(pool.map(lambda e: _part_files(spark, e), entries))
        files = [(file, file != entry) for entry, own in zip(entries, parts) for file in own]
        headers = list(pool.map(lambda f: read_header(spark, f[0]), files))
    groups: dict[tuple, list[str]] = {}
    for (file, nested), header in zip(files, headers):
        if header:
            groups.setdefault((header, nested), []).append(file)
    scans = [_envelopes(spark, own, header, nested, mode, multi_line) for (header, nested), own in groups.items()]
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], S.ENVELOPE).drop("datalake_ingested_at")


def _envelopes(spark: SparkSession, files: list[str], header: tuple[str, ...], nested: bool, mode: str, multi_line: bool) -> DataFrame:
    """Envelopes of files with one header; ``nested`` files are parts of the folder they are named after."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    rows = spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("escape", '"').option("nullValue", "\u0000").csv(files)
    fields = [x for i, name in enumerate(header) for x in (F.lit(name), F.coalesce(F.col(f"c{i}"), F.lit("")))]
    # A row's number is its place inside its file split plus the rows of earlier splits.
    # Counting per split keeps a very large file spread over its tasks.
    placed = rows.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.element_at(F.split("_metadata.file_path", "/"), -2 if nested else -1).alias("_name"),
        F.monotonically_increasing_id().alias("_at"),
        F.create_map(*fields).alias("payload"),
    )
    earlier = Window.partitionBy("_name").orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        placed.groupBy("_name", "_file", "_start")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
        .withColumn("_skip", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows", "_name")
    )
    # Names come percent-encoded in paths; a plus sign stands for itself there.
    name = F.url_decode(F.replace("_name", F.lit("+"), F.lit("%2B")))
    return placed.join(splits, ["_file", "_start"]).select(
        name.alias("source_file"),
        source_system_of(name).alias("source_system"),
        (F.col("_at") - F.col("_first") + F.col("_skip") + 1).alias("row_number"),
        F.lit(mode).alias("ingestion_mode"),
        "payload",
    )


def load_csv_folder(spark: SparkSession, folder: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """{file stem: all-text table} of every CSV of a folder; quoted line breaks belong to their record."""
    paths = list_files(spark, folder)
    if not paths:
        raise FileNotFoundError(f"no CSV file in {folder}")
    return {
        p.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]: spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(p)
        for p in paths
    }


def folder_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each loaded table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns")
        )
        out = one if out is None else out.unionByName(one)
    return out


def load_learning_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The sensor extract with typed columns in time order."""
    return spark.read.schema(schema).option("header", True).csv(path).orderBy(S.TIME_COL)
