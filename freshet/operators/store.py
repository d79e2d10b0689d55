"""Parquet tables with versions: write a new version, then let readers find it.

A version is a directory ``v=NNN``; it counts only once Spark has written its ``_SUCCESS`` file, so a job that dies half way
leaves the former version current.  Nothing reads and overwrites one path in the same plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str | None = None, keep: int = 3):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep

    def _fs(self):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        return root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        fs, hadoop = self._fs()
        root = hadoop.Path(self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        found = [int(n[2:]) for n in names if n.startswith("v=")]
        return sorted(v for v in found if fs.exists(hadoop.Path(f"{self.path}/v={v:09d}/_SUCCESS")))

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            if self.schema is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(f"{self.path}/v={versions[-1]:09d}")

    def write(self, df: DataFrame, partition_by: list[str] | None = None, version: int | None = None) -> int:
        """Write the next version (or the named one: the same batch written twice gives the same table)."""
        versions = self.versions()
        if version is None:
            version = versions[-1] + 1 if versions else 0
        elif version in versions:
            return version
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/v={version:09d}")
        self._drop_old()
        return version

    def _drop_old(self) -> None:
        fs, hadoop = self._fs()
        for old in self.versions()[:-self.keep]:
            fs.delete(hadoop.Path(f"{self.path}/v={old:09d}"), True)


class BatchTable:
    """An append-only table, one directory per batch id.

    A replayed batch overwrites its own directory and nothing else, so appending is exactly-once and the cost of a batch does
    not grow with the table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self) -> list[int]:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        found = [int(n[6:]) for n in names if n.startswith("batch=")]
        return sorted(b for b in found if fs.exists(hadoop.Path(f"{self.path}/batch={b}/_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame | None:
        """Rows of the complete batches (those earlier than ``before``), None when there are none."""
        held = [b for b in self.batches() if before is None or b < before]
        if not held:
            return None
        return self.spark.read.parquet(*[f"{self.path}/batch={b}" for b in held])

    def append(self, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions that ``df`` holds; other days stay as they are."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def commit_children_first(children: list[tuple[VersionedTable, DataFrame]], parent: tuple[VersionedTable, DataFrame]) -> None:
    """Write every child table, then the parent that marks the batch as done."""
    for table, df in children:
        table.write(df)
    table, df = parent
    table.write(df)
