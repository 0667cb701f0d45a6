"""Tables that cut lineage, written where every executor and the driver can read them.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only where that is unset (tests on one machine)
is a folder of our own used. Scratch tables are Parquet, so a later pass reads only the columns it needs and a lost
executor costs no more than its running tasks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; sets one of our own only where none is configured."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    set_already = spark.sparkContext.getCheckpointDir()
    if set_already is None:
        if named is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="threadloom-"))
    return named or spark.sparkContext.getCheckpointDir()


class Scratch:
    """``with Scratch(spark) as s``: ``s.table(df)`` writes and rereads; all tables go at the end.

    What leaves the block must have been written by ``keep`` (a reliable checkpoint, which Spark itself removes when
    nothing refers to it any more), so that no result depends on a deleted table.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.n = 0

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/t{self.n}"
        self.n += 1
        df.write.parquet(path)
        self.release()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, table: DataFrame) -> None:
        """Deletes a table of this scratch that no later plan reads."""
        for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
            if self.root.rpartition("/")[2] in path:
                self._delete(path)

    def release(self) -> None:
        """Lets the driver's JVM notice shuffles that nothing refers to, so their files go before the next pass."""
        self.spark.sparkContext._jvm.System.gc()

    @staticmethod
    def keep(df: DataFrame) -> DataFrame:
        return df.checkpoint(eager=True)
