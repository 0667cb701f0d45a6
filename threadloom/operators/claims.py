"""Claims merged by subject, relation and object, with evidence, conflicts and supersession."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.similarity import distinct_excerpts, first_of_repeats
from ..functions.text import claim_id

_EVIDENCE = ("excerpt", "source_url", "artifact_id", "chunk_id", "issue_number", "author", "timestamp", "offset_start", "offset_end")


def canonical_claims(claims: DataFrame, canonical: DataFrame | None) -> DataFrame:
    """Subject and object by their canonical names, themselves where there is none."""
    if canonical is None:
        return claims
    for side in ("subject", "object"):
        names = canonical.select(F.col("raw_name").alias(side), F.col("canonical").alias("to__"))
        claims = claims.join(names, side, "left").withColumn(side, F.coalesce("to__", side)).drop("to__")
    return claims


def merged(claims: DataFrame) -> DataFrame:
    """One row for each lower-cased (subject, relation, object): mean confidence, support, first and last seen.

    All are partial aggregates, so one pair that holds a third of the claims is combined before the shuffle. A missing
    timestamp sorts first and stays missing.
    """
    seen = F.struct(F.coalesce("timestamp", F.lit("")).alias("t"), "pos", "timestamp")
    keyed = claims.select(
        F.lower("subject").alias("subject"), "relation", F.lower("object").alias("object"), "confidence", seen.alias("seen")
    )
    return (
        keyed.groupBy("subject", "relation", "object")
        .agg(
            F.round(F.avg("confidence"), 4).alias("confidence"),
            F.count("*").alias("support_count"),
            F.min("seen").alias("a"),
            F.max("seen").alias("z"),
        )
        .select(
            claim_id(F.col("subject"), F.col("relation"), F.col("object")).alias("claim_id"),
            "subject", "relation", "object", "confidence", "support_count",
            F.col("a.timestamp").alias("first_seen"), F.col("z.timestamp").alias("last_seen"),
        )
    )


def judged(claims: DataFrame) -> DataFrame:
    """Adds superseded (a claim on the same pair has strictly more support) and conflict_with (the pair's other claims).

    A pair's claims are at most as many as there are relations, so the windows stay small.
    """
    pair = Window.partitionBy("subject", "object")
    ids = F.array_sort(F.collect_list(F.struct("relation", "claim_id")).over(pair))
    others = F.filter(F.transform(ids, lambda x: x["claim_id"]), lambda x: x != F.col("claim_id"))
    return claims.withColumn("superseded", F.col("support_count") < F.max("support_count").over(pair)).withColumn("conflict_with", others)


def evidence(claims: DataFrame, settings: Settings = DEFAULT, shown: tuple[str, ...] = _EVIDENCE) -> DataFrame:
    """(subject, relation, object, evidence): excerpts in order of time, near repeats of a kept one left out.

    A piece of evidence has the columns `shown`; those that a reader doesn't need are neither shuffled nor sent to Python.
    Of equal excerpts only the earliest counts, so most repeats go before the shuffle. A claim's mentions pass sorted, one
    after the other: what is held is what it keeps. One claim's mentions are judged by one task, as each depends on those
    kept before.
    """
    key, order = ["subject", "relation", "object"], ["t__", "pos"]
    held = [c for c in _EVIDENCE if c == "excerpt" or c in shown]
    rows = claims.select(F.lower("subject").alias("subject"), "relation", F.lower("object").alias("object"), F.coalesce("timestamp", F.lit("")).alias("t__"), "pos", *held)
    kinds = dict(rows.dtypes)
    typed = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    fewer = rows.mapInArrow(first_of_repeats(order, [*key, "excerpt"]), typed)
    spark = claims.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))  # rows are few bytes and much work
    in_time = fewer.repartition(parts, *key).sortWithinPartitions(F.xxhash64(*key), *key, *order, *held)
    items = ",".join(f"{c}:{kinds[c]}" for c in shown)
    return in_time.mapInArrow(
        distinct_excerpts(settings.claim_similarity, key, list(shown)), ", ".join(f"{c} {kinds[c]}" for c in key) + f", evidence array<struct<{items}>>"
    )


def deduplicated(claims: DataFrame, canonical: DataFrame | None = None, settings: Settings = DEFAULT, shown: tuple[str, ...] = _EVIDENCE) -> DataFrame:
    """The merged claims with evidence, supersession and conflicts: the claims table of the graph."""
    claims = canonical_claims(claims, canonical)
    return judged(merged(claims)).join(evidence(claims, settings, shown), ["subject", "relation", "object"])


def conflict_report(claims: DataFrame) -> DataFrame:
    """Pairs of claims that relate the same subject and object differently, ordered by relation."""
    a, b = (claims.select("subject", "object", F.col("relation").alias(f"relation_{k}"), F.col("claim_id").alias(f"claim_{k}")) for k in "ab")
    pairs = a.join(b, ["subject", "object"]).where("relation_a < relation_b")
    return pairs.select(
        "claim_a", "claim_b", "subject", "object", "relation_a", "relation_b",
        F.lit("same_subject_object_different_relation").alias("note"),
    )
