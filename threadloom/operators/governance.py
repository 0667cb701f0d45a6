"""Rules over artifacts, claims and their evidence: exact repeats, durability, decay, orphans, access, the ontology."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schemas import EXTRA_ONTOLOGY, ONTOLOGY


def exact_repeats(artifacts: DataFrame) -> DataFrame:
    """(artifact_id, text_hash, canonical_id): the smallest id with the same text, white space and case aside.

    The minimum is combined before the shuffle, and the join back may be split where one text has very many copies.
    """
    text = F.lower(F.regexp_replace(strip(F.coalesce("text", F.lit(""))), r"(?U)\s+", " "))
    rows = artifacts.select("artifact_id", F.sha2(text, 256).alias("text_hash"))
    return rows.join(rows.groupBy("text_hash").agg(F.min("artifact_id").alias("canonical_id")), "text_hash").select("artifact_id", "text_hash", "canonical_id")


def durability(claims: DataFrame, at_least: int = 3) -> DataFrame:
    kind = F.when(F.col("support_count") >= at_least, "durable").otherwise("ephemeral")
    return claims.withColumn("memory", kind)


def decayed(claims: DataFrame, today: str, half_life_days: float = 365.0) -> DataFrame:
    """Confidence halves for every half life since a claim was last seen; unknown dates don't decay."""
    age = F.greatest(F.lit(0), F.date_diff(F.lit(today).cast("date"), F.substring("last_seen", 1, 10).try_cast("date")))
    factor = F.coalesce(F.exp(F.lit(-math.log(2) / half_life_days) * age), F.lit(1.0))
    return claims.withColumn("current_confidence", F.round(F.col("confidence") * factor, 4))


def _with_evidence_in(claims: DataFrame, ids: DataFrame) -> DataFrame:
    """Claims with the evidence whose artifact is among the ids; claims without any left go.

    A claim's other columns go with its pieces of evidence, so claims are made once.
    """
    rest = [c for c in claims.columns if c not in ("claim_id", "evidence")]
    e = claims.select("claim_id", F.struct(*rest).alias("rest"), F.posexplode("evidence").alias("nth", "e")).withColumn("artifact_id", F.col("e.artifact_id"))
    e = e.join(ids.select("artifact_id"), "artifact_id", "left_semi")
    kept = e.groupBy("claim_id").agg(F.first("rest").alias("rest"), F.array_sort(F.collect_list(F.struct("nth", "e"))).alias("k"))
    return kept.select("claim_id", *(F.col("rest")[c].alias(c) for c in rest), F.transform("k", lambda x: x["e"]).alias("evidence"))


def without_orphans(claims: DataFrame, artifacts: DataFrame) -> DataFrame:
    return _with_evidence_in(claims, artifacts)


def permitted(claims: DataFrame, access: DataFrame, user: str) -> DataFrame:
    """access (user, artifact_id): only evidence that the user may read, and claims that have some."""
    return _with_evidence_in(claims, access.where(F.col("user") == user))


def ontology_check(claims: DataFrame, extra: bool = False) -> DataFrame:
    """Typed claims with fits: whether the relation may lead from and to these types; null for relations without a rule.

    With extra, the relations of mail, chat and trackers have rules too.
    """
    spark = claims.sparkSession
    rules = spark.createDataFrame(
        [(r, list(a), list(b)) for r, (a, b) in (ONTOLOGY | (EXTRA_ONTOLOGY if extra else {})).items()], "relation string, from_types array<string>, to_types array<string>"
    )
    fits = F.array_contains("from_types", F.col("subject_type")) & F.array_contains("to_types", F.col("object_type"))
    return claims.join(F.broadcast(rules), "relation", "left").withColumn("fits", fits).drop("from_types", "to_types")
