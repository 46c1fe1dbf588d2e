"""Session settings and reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "quillon", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tested under; anything passed in ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or the one set on the context.

    Only a local master may fall back to a temporary folder: on a cluster it would be lost with its
    machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="quillon-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def materialize(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read on from there.

    Used where a result is read several times or a lineage has to be cut. The table is columnar, so
    later passes read only the columns they need, and counting it reads no data at all. It survives
    the loss of any executor and stays in the folder until that is cleaned.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one job writes to the shared folder, under a folder of its own.

    ``keep`` writes a table and reads on from it, as ``materialize`` does; ``clear`` removes everything
    that was kept, once no result depends on it any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"

    def path(self, name: str = "") -> str:
        return f"{self.folder}/{name or uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove the tables, and the shuffle files of the finished jobs that wrote them.

        Executors drop shuffle files when the driver's JVM collects their handles, which it does only every half an hour
        by itself; until then they would add up over the steps of a job.
        """
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.spark._jvm.System.gc()


def spread(table: DataFrame) -> DataFrame:
    """Use every core on a table that arrives in fewer partitions than there are cores.

    Meant for freshly read tables ahead of heavy row work. A large table has far more partitions and
    passes through unchanged, without a shuffle.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table
