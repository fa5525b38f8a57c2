"""File scans and writes with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import file_name, lower_header
from ..functions.hashing import record_hash

Schema = T.StructType | str


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: Schema | None = None, trim: bool = False,
             encoding: str = "UTF-8", lower_names: bool = False, **options: str) -> DataFrame:
    """CSV with a header. ``trim`` strips every field; values that do not fit the schema become null."""
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("encoding", encoding)
              .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim))
    for name, value in options.items():
        reader = reader.option(name, value)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path if isinstance(path, str) else list(path))
    return lower_header(df) if lower_names else df


def read_json_lines(spark: SparkSession, path: str | Sequence[str], schema: Schema) -> DataFrame:
    return spark.read.schema(schema).json(path if isinstance(path, str) else list(path))


def read_json_array(spark: SparkSession, path: str | Sequence[str], schema: Schema) -> DataFrame:
    """Files that hold one JSON array each; a file is read by one task, so keep them small."""
    return spark.read.schema(schema).option("multiLine", True).json(path if isinstance(path, str) else list(path))


def read_recent(spark: SparkSession, path: str, schema: Schema, modified_after: str,
                fmt: str = "parquet", skip_unreadable: bool = False) -> DataFrame:
    """Only files changed after ``modified_after`` (ISO text). Unreadable files fail the job unless they are to be skipped;
    ``unread_files`` then lists them."""
    return (spark.read.format(fmt).schema(schema).option("modifiedAfter", modified_after)
            .option("recursiveFileLookup", True).option("ignoreCorruptFiles", skip_unreadable).load(path))


def unread_files(spark: SparkSession, path: str, rows: DataFrame, modified_after: str) -> DataFrame:
    """(path, bytes) of files changed since that gave no row to ``rows``, a frame that ``read_recent`` made."""
    listed = (spark.read.format("binaryFile").option("modifiedAfter", modified_after).option("recursiveFileLookup", True).load(path)
              .select("path", F.col("length").alias("bytes")))
    read = rows.select(F.col("_metadata.file_path").alias("path")).distinct()
    return listed.join(read, "path", "left_anti")


def with_arrival(df: DataFrame, name: str = "_arrival") -> DataFrame:
    """Order in which a file scan's rows arrived: file time, then path and place in the file."""
    meta = F.col("_metadata")
    return df.select("*", F.struct(meta["file_modification_time"].alias("changed"), meta["file_path"].alias("path"),
                                   meta["file_block_start"].alias("block")).alias(name))


def with_row_order(df: DataFrame, name: str = "_row") -> DataFrame:
    """Row number in scan order, for "the later row wins" on one small file read directly before."""
    return df.withColumn(name, F.monotonically_increasing_id())


def avro_available(spark: SparkSession) -> bool:
    jvm = spark.sparkContext._jvm
    try:
        jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroFileFormat", False,
                                    jvm.java.lang.Thread.currentThread().getContextClassLoader())
        return True
    except Exception:
        return False


def lake_format(spark: SparkSession) -> str:
    """Avro where its module is on the classpath, else Parquet."""
    return "avro" if avro_available(spark) else "parquet"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                fmt: str = "parquet", **options: str) -> None:
    writer = df.write.format(fmt).mode(mode)
    for name, value in options.items():
        writer = writer.option(name, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report of a few rows as one CSV file with a header. Not for tables."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_report_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.coalesce(1).write.mode(mode).json(path)


def with_source_metadata(df: DataFrame, batch_id: str) -> DataFrame:
    """Source file name, batch id and load time of a file scan."""
    return df.select("*", file_name(F.col("_metadata.file_path")).alias("_source_file"),
                     F.lit(batch_id).alias("_ingestion_batch_id"),
                     F.current_timestamp().alias("_bronze_ingested_at"))


def with_record_hash(df: DataFrame, columns: Sequence[str] | None = None, length: int = 16) -> DataFrame:
    """Load time and content hash of the original columns."""
    return df.withColumns({"_record_hash": record_hash(df, columns, length),
                           "_bronze_loaded_at": F.current_timestamp()})
