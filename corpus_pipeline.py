"""A training corpus from `documents`: toxic texts out, near copies out, repeats out, benchmark texts out, then packed.

Each stage works on the documents that the one before has kept, whole, and all but the last return the columns of
`documents`. Nothing but the documents' own decisions is handed on: stages are written as Parquet and read again.

In every stage null and empty texts and null ids are kept, rows that repeat an id are each judged or kept by it as the
stage says, texts of any length are read whole, extra columns pass through whatever their names, and an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm.decontaminate import drop_leaks
from threadloom.llm.names import fresh
from threadloom.llm.near_dup import near_duplicates
from threadloom.llm.packing import pack
from threadloom.llm.scratch import shared_dir
from threadloom.llm.substring import remove_repeats
from threadloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score reaches the threshold go, each by its own text; equal texts have equal scores."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays, by the operator's own rule of four words and 0.8.

    Of rows that repeat an id all stay or go; rows without an id or words stay.
    """
    (name,) = fresh(docs.columns, "gone")
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that lose words get their kept words, a space apart; a text that loses all of them goes, others stay.

    Of equal passages the one in the smallest id stays. Rows without an id keep all words.
    """
    taken = {"kept_text", "n_words", "n_removed"} & set(docs.columns)  # the operator's own columns: put aside meanwhile
    aside = dict(zip(sorted(taken), fresh(docs.columns, *sorted(taken))))
    cut = remove_repeats(docs.withColumnsRenamed(aside))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    cut = cut.where("n_removed = 0 or n_removed < n_words").withColumn("text", text)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, all rows of their id; rows without an id or text stay."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all rows, each row packed for itself; a null or empty text is its end id."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Boosted trees and tokenisers have no SQL; tests hold the operators and each stage after toxicity against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the cluster's shared folder and read again by the next."""
    import uuid

    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    result = STAGES[-1][1](spark, docs, sf_dir)  # holds no reference to the folder: its rows are checkpointed
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return result
