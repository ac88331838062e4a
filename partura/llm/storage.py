"""Tables between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DIR = "spark.checkpoint.dir"
_own: dict[str, str] = {}  # folders of local sessions that name none, by application


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session without one gets a folder of its own."""
    found = spark.conf.get(DIR, None) or spark.sparkContext.getConf().get(DIR, None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {DIR} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="partura-")
        found = _own[app]
    return found.rstrip("/")


class Workspace:
    """Written tables of one run. A written table cuts lineage and outlives executors.

    `save` writes and rereads; `drop` deletes a table that no later step reads. What the result is
    read from stays until the owner of the shared folder clears it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/partura-{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)
