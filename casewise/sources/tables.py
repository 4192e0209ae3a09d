"""Reading call tables and writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Default headers of a call export and the column names used here.
HEADERS = {
    "StateName": "state",
    "DistrictName": "district",
    "BlockName": "block",
    "Crop": "crop",
    "Category": "category",
    "QueryType": "query_type",
    "Season": "season",
    "Sector": "sector",
    "QueryText": "question",
    "CreatedOn": "created_on",
    "RecordId": "call_id",
}
REQUIRED = ("state", "district", "crop", "category", "query_type", "question", "answer", "created_on")

# Texts that a table reader takes as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _missing_to_null(name: str) -> Column:
    return F.when(~F.col(name).isin(*MISSING), F.col(name)).alias(name)


def load_calls(
    spark: SparkSession,
    path: str | Sequence[str],
    headers: Mapping[str, str] | None = None,
    fmt: str = "csv",
    missing_as_null: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """A raw call table with the columns used here, or an error naming what is missing.

    ``headers`` maps the export's own headers to ours and is added to ``HEADERS``; at least
    the answer's header has to be given unless it is already ``answer``. Headers are stripped
    of blanks. CSV columns are read as text: quoted line breaks and doubled quotes are
    understood, and the usual missing-value texts become null.

    A CSV file that may hold line breaks inside quotes cannot be split, so each such file is
    one task: load large exports as many files, without ``multi_line`` where no text has line
    breaks, or as parquet.
    """
    reader = spark.read
    if fmt == "csv":
        raw = reader.options(header=True, multiLine=multi_line, quote='"', escape='"').csv(path)
    else:
        raw = reader.format(fmt).load(path)
    names = {**HEADERS, **(headers or {})}
    stripped = [c.strip() for c in raw.columns]
    raw = raw.toDF(*[names.get(c, c) for c in stripped])
    missing = [c for c in REQUIRED if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; found: {stripped}")
    if fmt == "csv" and missing_as_null:
        raw = raw.select(*[_missing_to_null(c) for c in raw.columns])
    return raw


def with_row_order(df: DataFrame, name: str = "row_order") -> DataFrame:
    """A unique id in file order, for tables that have no id of their own."""
    return df.withColumn(name, F.monotonically_increasing_id())


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, multi_line: bool = True) -> DataFrame:
    """Without ``multi_line``, CSV files of texts without line breaks are split over tasks."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, multiLine=multi_line, quote='"', escape='"')
    return (reader.schema(schema) if schema else reader).load(path)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None where it has not been written."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return None
        raise


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """S3."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, quote='"', escape='"')
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """A small metrics table as JSON lines."""
    df.write.mode("overwrite").json(path)


def spread(df: DataFrame) -> DataFrame:
    """Give per-row text work on a table, as read, as many tasks as there are cores.

    Only a table whose files yield fewer tasks than that is repartitioned; a large table,
    which has more splits than cores, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
