"""Shared state of multi-step operators: tables below the folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir

_OPEN: list[dict[str, SparkSession]] = []


def cut(frame: DataFrame, label: str = "step") -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there and lost executors lose nothing."""
    spark = frame.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    frame.write.parquet(path)
    if _OPEN:
        _OPEN[-1][path] = spark
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables cut inside the block are removed at its end, but for those that the yielded function is given to keep.

    For steps whose result has itself been cut: what they stored on the way would stay in the shared folder for good.
    """
    made: dict[str, SparkSession] = {}
    kept: list[str] = []
    _OPEN.append(made)

    def keep(frame: DataFrame) -> DataFrame:
        kept.extend(frame.inputFiles())
        return frame

    try:
        yield keep
        for path, spark in made.items():
            if not any(f"/{path.rsplit('/', 1)[1]}/" in file for file in kept):
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    finally:
        _OPEN.remove(made)
        if _OPEN:
            _OPEN[-1].update({p: s for p, s in made.items()})


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, or a longer form of it that no column of the frame has."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
