"""Session settings and the stage store (written intermediates in the cluster's shared checkpoint folder)."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT = "spark.checkpoint.dir"
#: Shuffle files go at the end of the query that made them, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings the operators rely on; none depends on the size of one particular input."""
    for name, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # a hot key on the row side of a statistics join is split over many tasks ...
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # ... also where that costs one more shuffle further up the plan
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # rows dealt by some of the keys of a join stay where they are, only the other side is shuffled
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.session.timeZone": "UTC",
        # overflow and invalid casts fail instead of giving a wrong value
        "spark.sql.ansi.enabled": "true",
    }.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; where it names none, the warehouse, and a private folder in local mode (tests)."""
    named = spark.conf.get(_CHECKPOINT, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if master.startswith("local") and not master.startswith("local-cluster"):
            named = tempfile.mkdtemp(prefix="spark-stage-")
        else:                       # no folder of one machine on a cluster: the warehouse is shared
            named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


class Stages:
    """Writes an intermediate as Parquet and reads it back.

    A staged frame has no lineage, survives lost executors, and has a size the planner knows: a join with a small
    staged side becomes a broadcast by itself, a large one a sort-merge join whose hot partitions adaptive
    execution can split.
    """

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark = tune(spark)
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0
        self._paths: list[tuple[DataFrame, str]] = []

    def __call__(self, df: DataFrame, name: str = "stage") -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        cleanup = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")       # what is written is read back: nothing asks for its shuffles again
        try:
            df.write.option("compression", "zstd").parquet(path)       # digests are hex: half the size of snappy
        finally:
            self.spark.conf.set(_CLEANUP, cleanup)
        # schema is known: no second look at the files, and nullability and types stay as planned
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._paths.append((staged, path))
        return staged

    def drop(self, *frames: DataFrame) -> None:
        """Remove stages that nothing will read any more: all that was derived from them is staged itself."""
        for frame in frames:
            for entry in [e for e in self._paths if e[0] is frame]:
                delete_path(self.spark, entry[1])
                self._paths.remove(entry)

    def close(self) -> None:
        """Drop every stage of this run. Only when all results derived from them are written."""
        delete_path(self.spark, self.root)
