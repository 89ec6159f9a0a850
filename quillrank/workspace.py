"""Intermediate tables in the folder all executors share.

Writing a table cuts the lineage: a lost executor costs the tasks it was running, not a new pass over the
corpus. A table that may be broadcast later is measured while it is written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach, or name a root")
    return root.rstrip("/")


@dataclass(frozen=True)
class Measured:
    """A written table and what was observed while writing it."""

    frame: DataFrame
    rows: int
    nbytes: int
    observed: dict

    def fits(self, limit: int) -> bool:
        return self.nbytes <= limit


class Workspace:
    """A folder of its own below the shared root. Use it as a context manager to have it deleted."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{(root or shared_root(spark)).rstrip('/')}/quillrank-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, frame: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``frame`` as Parquet, in a folder per value of ``by``, and return it read back."""
        path = self.folder(name)
        (frame.write.partitionBy(by) if by else frame.write).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def save_measured(self, frame: DataFrame, name: str, **measures: Column) -> Measured:
        """``save``, with row count, byte size and the aggregates ``measures``, all from the same job."""
        watch = Observation()
        watched = frame.observe(
            watch,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(_row_bytes(frame.schema)), F.lit(0)).alias("nbytes"),
            *[column.alias(alias) for alias, column in measures.items()],
        )
        saved = self.save(watched, name)
        found = watch.get
        return Measured(saved, found["rows"], found["nbytes"], {alias: found[alias] for alias in measures})

    def close(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def _row_bytes(schema: T.StructType) -> Column:
    """In-memory size of a row: 16 bytes a column, and the length of what has no fixed width."""
    size = F.lit(16 * len(schema.fields)).cast("long")
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size
