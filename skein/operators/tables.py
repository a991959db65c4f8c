"""Tables that cut the lineage between the rounds of an operator, in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_LEFT: dict[str, SparkSession] = {}


def shared(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set and the master is local, as in tests, a new one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        now = spark.sparkContext._jsc.sc().getCheckpointDir()
        if now.isDefined():
            return now.get()
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="skein-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def sweep() -> None:
    """Delete the folders of all runs; what a caller still reads goes with its process."""
    while _LEFT:
        path, spark = _LEFT.popitem()
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


class Tables:
    """The tables of one run.  A round's tables are dropped once the next one's are written; what a result reads stays until ``sweep``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.made, self.n = spark, f"{shared(spark)}/graph-{uuid.uuid4().hex}", {}, 0
        _LEFT[self.folder] = spark

    def save(self, df: DataFrame) -> DataFrame:
        return self.count(df, None)[0]

    def count(self, df: DataFrame, condition: Column | None) -> tuple[DataFrame, int]:
        """Write a table, and count the rows of it that a condition holds for, in one job."""
        from pyspark.sql import functions as F

        path, seen = f"{self.folder}/{self.n}", Observation()
        self.n += 1
        watched = df if condition is None else df.observe(seen, F.count_if(condition).alias("n"))
        # Each table is written once and read a few times, so smaller files are worth a little time.
        watched.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made[path] = out
        return out, 0 if condition is None else seen.get["n"]

    def drop(self, *tables: DataFrame) -> None:
        for path in [p for p, df in self.made.items() if any(df is t for t in tables)]:
            _delete(self.spark, path)
            del self.made[path]
