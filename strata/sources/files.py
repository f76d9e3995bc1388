"""File sources: header CSV as all-string columns, folder discovery, Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def _csv_reader(spark: SparkSession, schema: StructType | None = None):
    reader = spark.read.option("header", True)
    # with a schema given, every file's header must show just those names, in that order
    return reader if schema is None else reader.schema(schema).option("enforceSchema", False)


def _all_strings(df: DataFrame) -> DataFrame:
    """Folder columns (``year=2020``) come typed; bronze is strings throughout."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV with every column typed ``string`` (no inference pass over the data).

    Defaults: ``,`` delimiter, ``"`` quote, empty field → NULL, leading blanks kept
    (trimming is a silver decision). ``path`` is a file, or a folder of part files under any name,
    compressed or in ``key=value`` folders. Without ``columns`` the names are those of one file's
    header. A file whose header differs makes the job fail, as its columns would be taken by
    position; ``read_csv_by_name`` reads such folders.
    """
    if columns is None:
        names = _csv_reader(spark).csv(path)
        folders = _folder_columns(spark, path)
        columns = [c for c in names.columns if c not in folders]
    return _all_strings(_csv_reader(spark, string_schema(columns)).csv(path))


def _folder_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that ``key=value`` folders below ``path`` add."""
    return [c for c in spark.read.text(path).columns if c != "value"]


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, names) of every part file: its first line that isn't blank, and the column names in it."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    # a file's first block is read by one task, so the order of its lines is known there
    headers = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    return headers.withColumn("width", F.size(F.split(F.regexp_replace("header", '"[^"]*"', ""), ",")))


def read_csv_by_name(spark: SparkSession, path: str) -> DataFrame:
    """The part files of one dataset, their columns matched by header name; missing ones are NULL.

    One pass over the files' first lines finds each file's header. All files are then read together by
    position, and a table from file to positions, joined by the file each row says it came from, puts
    the values under their names; Spark broadcasts that table while it is small. No list of files and no
    file name goes through the driver, only the different column names. Columns stand in the order of the
    header that most files have, others after them; an unnamed column is ``_c`` and its number.
    """
    headers = _headers(spark, path)
    width = headers.agg(F.max("width")).first()[0]
    if width is None:
        return _csv_reader(spark).csv(path)
    cells = [f"__cell{k}" for k in range(width)]
    parsed = F.from_csv("header", ", ".join(f"{c} string" for c in cells))
    named = [
        F.when(F.lit(k) < F.col("width"), F.coalesce(F.col(f"__h.{c}"), F.lit(f"_c{k}"))) for k, c in enumerate(cells)
    ]
    headers = headers.withColumn("__h", parsed).select("file", F.array_compact(F.array(*named)).alias("names"))
    rows = headers.groupBy("names").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.array_join("names", ",")).collect()
    columns = list(dict.fromkeys(name for row in rows for name in row["names"]))
    places = headers.select(
        F.col("file").alias("__file"),
        F.array(*[F.array_position("names", F.lit(c)).cast("int") for c in columns]).alias("__places"),
    )
    # every file's own header line is skipped, and its cells are taken by position
    cellwise = spark.read.option("header", True).schema(string_schema(cells)).csv(path)
    folders = [c for c in cellwise.columns if c not in cells]
    joined = cellwise.withColumn("__from", F.col("_metadata.file_path")).join(
        places, F.col("__from") == F.col("__file"), "left"
    )
    values = F.array(*cells)
    # places count from 1, and 0 stands for a column the file doesn't have
    by_name = [F.get(values, F.get("__places", F.lit(k)) - 1).alias(c) for k, c in enumerate(columns)]
    return _all_strings(joined.select(*by_name, *[F.col(f"`{c}`") for c in folders]))


def headers_differ(error: Exception) -> bool:
    """Whether a read failed because a file's header is not the one expected."""
    return "CSV header" in str(error)


def _hadoop_path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_entries(spark: SparkSession, folder: str) -> dict[str, bool]:
    """Entry name → whether it is a folder, for one level of ``folder`` on any Hadoop file system.

    One listing of that level: nothing below it is visited, however many files there are.
    Raises ``FileNotFoundError`` when the folder is missing.
    """
    path, fs = _hadoop_path(spark, folder)
    if not fs.exists(path):
        raise FileNotFoundError(f"input folder not found: {folder}")
    return {s.getPath().getName(): bool(s.isDirectory()) for s in fs.listStatus(path)}


def rename(spark: SparkSession, path: str, new: str) -> None:
    """Rename a file or folder this library wrote, on any Hadoop file system."""
    old, fs = _hadoop_path(spark, path)
    if not fs.rename(old, _hadoop_path(spark, new)[0]):
        raise OSError(f"cannot rename {path} to {new}")


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder this library wrote (scratch output), on any Hadoop file system."""
    path, fs = _hadoop_path(spark, folder)
    fs.delete(path, True)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; a missing path raises ``FileNotFoundError`` naming it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"parquet not found: {path}") from exc
        raise
