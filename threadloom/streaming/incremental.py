"""Incremental ingestion: new artifacts once each, and claims merged into a state that batches can be replayed onto."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import claim_id

_KEY = ("subject", "relation", "object")


def new_artifacts(stream: DataFrame, key: str = "artifact_id", time: str = "updated_at", delay: str = "1 day") -> DataFrame:
    """Each key once within the watermark; a later copy, or one that comes too late, is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def partial_state(claims: DataFrame) -> DataFrame:
    """What merging needs of each claim: counts and sums that add up, and the span of time."""
    return claims.groupBy(F.lower("subject").alias("subject"), "relation", F.lower("object").alias("object")).agg(
        F.count("*").alias("n"),
        F.sum(F.col("confidence").cast("decimal(38,10)")).alias("total"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy(*_KEY).agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,10)").alias("total"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )


def finished(state: DataFrame) -> DataFrame:
    return state.select(
        claim_id(*(F.col(k) for k in _KEY)).alias("claim_id"), *_KEY,
        F.round(F.col("total") / F.col("n"), 4).cast("double").alias("confidence"), F.col("n").alias("support_count"), "first_seen", "last_seen",
    )


class ClaimState:
    """The state under a folder, in buckets by key: a batch writes new copies of the buckets that it touches only.

    A batch that runs again finds the copies before it and writes its own again; copies older than those are removed, so
    two of each bucket stay. Readers that hold a state across two batches may lose it under them and read again.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _copies(self) -> dict[int, list[int]]:
        """For each bucket the batches that wrote it wholly, in order."""
        copies: dict[int, list[int]] = {}
        for v in sorted(int(n[1:]) for n in self._names(self.folder) if n.startswith("v")):
            inside = self._names(f"{self.folder}/v{v}")
            for n in inside if "_SUCCESS" in inside else ():
                if n.startswith("bucket="):
                    copies.setdefault(int(n[7:]), []).append(v)
        return copies

    def read(self, before: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The newest copy of each bucket, or of those asked for; as it was before a batch, if that is named."""
        paths = []
        for bucket, copies in self._copies().items():
            known = [v for v in copies if before is None or v < before]
            if known and (only is None or bucket in only):
                paths.append(f"{self.folder}/v{known[-1]}/bucket={bucket}")
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """For foreachBatch. The batch is combined before its shuffle; at most `buckets` numbers come to the driver."""
        bucket = F.pmod(F.xxhash64(*_KEY), F.lit(self.buckets)).cast("int")
        new = partial_state(batch).persist()
        touched = [r["bucket"] for r in new.select(bucket.alias("bucket")).distinct().collect()]
        old = self.read(batch_id, touched)
        state = (new if old is None else merge_state(old, new)).withColumn("bucket", bucket)
        state.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/v{batch_id}")
        new.unpersist()
        for b, copies in self._copies().items():
            for v in [v for v in copies if v <= batch_id][:-2]:
                self._fs.delete(self._path(f"{self.folder}/v{v}/bucket={b}"), True)
