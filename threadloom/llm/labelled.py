"""A bounded, stratified sample of labelled rows, and the rates of the whole label table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def training_rows(
    documents: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most per_class rows of each class, in the order of a hash of the id; and all rows' counts.

    Held-out ids, null ids and labels other than 0 and 1 are left out; an id with both labels counts as 1, one with several
    texts has the least of them, a null text counts only if there is no other. The chosen ids, two times per_class at most,
    are broadcast.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = rows.where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id"), modulus, remainder))
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = [rows.where(f"y = {y}").orderBy(*order).limit(per_class) for y in (0, 1)]
    chosen = chosen[0].union(chosen[1])
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y")), counts
