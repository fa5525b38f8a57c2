"""Partitioned landing, snapshots, run logs and incremental file ingest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.temporal import partition_parts

HOURLY = ("year", "month", "day", "hour")
DAILY = ("year", "month", "day")


def land_hourly(df: DataFrame, path: str, time: Column | str, fmt: str = "parquet", mode: str = "append") -> None:
    """Append under ``year=/month=/day=/hour=`` of the record time.

    Rows are brought together by hour and a hash spread, so a busy hour is written by several tasks
    and quiet hours do not scatter over all of them.
    """
    _by_parts(df, time, hour=True).write.format(fmt).mode(mode).partitionBy(*HOURLY).save(path)


def land_daily(df: DataFrame, path: str, time: Column | str, run_id: str, fmt: str = "parquet") -> None:
    """Add one run's rows under ``year=/month=/day=/run=``.

    Other runs of the same day stay; repeating a run replaces only its own directories.
    """
    parted = _by_parts(df, time, hour=False).withColumn("run", F.lit(run_id))
    (parted.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*DAILY, "run").save(path))


def _by_parts(df: DataFrame, time: Column | str, hour: bool) -> DataFrame:
    parted = df.withColumns(partition_parts(time, hour))
    # AQE splits the big and joins the small partitions of this rebalance
    return parted.hint("rebalance", *(HOURLY if hour else DAILY))


def list_partitions(spark: SparkSession, path: str, complete: bool = False) -> dict[str, str]:
    """Value and path of the ``column=value`` folders directly below ``path``; ``complete``: those whose own write has finished."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = hadoop_path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return {}
    found = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
    return {p.getName().split("=", 1)[1]: p.toString() for p in found if not complete or fs.exists(hadoop_path(p, "_SUCCESS"))}


def replace_partitions(df: DataFrame, path: str, column: str, touched: Sequence) -> None:
    """Replace the partitions of ``touched`` (values of ``column``) by the rows of ``df``; all other folders keep their files.

    ``df`` may read the table itself: new files are complete before any folder is exchanged. Touched partitions without a row
    are removed: they are those that still hold their old files after the write, so that ``df`` runs once. A repeated call ends in the same table.
    """
    spark = df.sparkSession
    here = list_partitions(spark, path)

    def data_files() -> set[str]:
        if not here:
            return set()
        return set(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles())

    before = data_files()
    (df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))
    stale = {unquote(name).split("/")[-2].split("=", 1)[1] for name in before & data_files()}
    for value in stale & {str(v) for v in touched}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(here[value])
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_snapshot(df: DataFrame, path: str, snapshot: str) -> None:
    """Write ``snapshot=<id>/`` and then publish it by one appended row; nothing that readers use is touched."""
    df.write.mode("overwrite").parquet(f"{path}/snapshot={snapshot}")
    published = df.sparkSession.createDataFrame([(snapshot,)], "snapshot string").withColumn("published_at", F.current_timestamp())
    published.coalesce(1).write.mode("append").parquet(f"{path}/published")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot that was published last."""
    newest = spark.read.parquet(f"{path}/published").agg(F.max_by("snapshot", F.struct("published_at", "snapshot"))).first()[0]
    return spark.read.parquet(f"{path}/snapshot={newest}")


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


RUN_LOG = ("run_id string, pipeline string, layer string, table_name string, records_processed bigint, "
           "status string, started_at timestamp")


def log_run(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Append run-log rows, in the order of :data:`RUN_LOG`."""
    spark.createDataFrame(list(rows), RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def source_inventory(spark: SparkSession, sources: dict[str, tuple[str, str]]) -> DataFrame:
    """(source, exists, row_count) per named (format, path)."""
    rows = []
    for name, (fmt, path) in sources.items():
        try:
            frame = spark.read.format(fmt).option("header", True).load(path)
            rows.append((name, True, frame.count()))
        except AnalysisException:
            rows.append((name, False, 0))
    return spark.createDataFrame(rows, "source string, exists boolean, row_count bigint")


def ingest_new_files(spark: SparkSession, source: str, schema: T.StructType | str, fmt: str, target: str,
                     checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None,
                     options: dict[str, str] | None = None) -> None:
    """Append files not seen before and stop; the checkpoint remembers which were processed.

    Each micro-batch is written to its own ``batch_id=`` directory, so a batch that is repeated
    after a failure replaces its files instead of adding them twice.
    """
    stream = spark.readStream.format(fmt).schema(schema)
    for name, value in (options or {}).items():
        stream = stream.option(name, value)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_source_file", F.col("_metadata.file_name"))
        rows = prepare(rows) if prepare else rows
        rows.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    query = (stream.load(source).select("*", "_metadata").writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def ingest_manifest(table: DataFrame) -> DataFrame:
    """Processed files with their batch and row count, read from the ingested table itself."""
    return (table.groupBy("batch_id", "_source_file").agg(F.count(F.lit(1)).alias("rows"))
            .orderBy("batch_id", "_source_file"))
