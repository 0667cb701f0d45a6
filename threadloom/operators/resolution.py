"""Entity resolution: names counted, compared by token sets through lossless blocking, clustered, and named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.similarity import similarity
from ..functions.text import normalized_name
from .components import checkpointed, components


def name_counts(mentions: DataFrame) -> DataFrame:
    """(name, type, pos) → (name, frequency, type): the most frequent type, of equals the one seen first."""
    by_type = mentions.groupBy("name", "type").agg(F.count("*").alias("n"), F.min("pos").alias("pos"))
    firsts = by_type.groupBy("name").agg(
        F.sum("n").alias("frequency"), F.min(F.struct((-F.col("n")).alias("n"), "pos", "type")).alias("top")
    )
    return firsts.select("name", "frequency", F.col("top.type").alias("type"))


def _bare(key) -> Column:
    """The words of a key, each once, as similarity counts them."""
    return F.array_join(F.array_distinct(F.split(key, " ")), " ")


def _can_reach(a: str, b: str, t: float) -> Column:
    """Whether the similarity can reach t: exact but for the common subsequence, which common letters bound from above."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    sx, sy = F.array_join(F.array_except(x, y), " "), F.array_join(F.array_except(y, x), " ")
    base = F.length(F.array_join(F.array_intersect(x, y), " "))
    nx, ny, total = F.length(sx), F.length(sy), F.length(_bare(a)) + F.length(_bare(b))
    times = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    letters = F.filter(F.array_distinct(F.split(sx, "")), lambda c: c != "")
    common = F.aggregate(letters, F.lit(0), lambda n, c: n + F.least(times(sx, c), times(sy, c)))
    apart = nx + ny - 2 * common
    inside = (base > 0) & (F.least(nx, ny) + 1 <= (1 - t) * (2 * base + F.least(nx, ny) + 1) + 1e-9)
    return ((base > 0) & ((nx == 0) | (ny == 0))) | inside | (apart <= (1 - t) * total + 1e-9)


def candidates(keys: DataFrame, threshold: float) -> DataFrame:
    """keys (key) → pairs (a, b), a < b, that hold every pair whose similarity can reach the threshold.

    Two ways lead there. Words: one key's words outside the other must be short, or none, so of its words, rarest first,
    one among those that outgrow that length is shared. Letters: insertions and deletions are few, and each takes one or
    two of the padded two-letter grams, so the rarest gram that two keys share has at most so many grams before it in
    either. Only such prefixes are joined; what meets must then share enough letters. Thresholds lie above two thirds.
    """
    t = threshold
    keys = keys.where("key <> ''").distinct()
    words = keys.select("key", F.explode(F.array_distinct(F.split("key", " "))).alias("w"))
    rare = words.groupBy("w").agg(F.count("*").alias("df"))
    ordered = Window.partitionBy("key").orderBy("df", "w").rowsBetween(Window.unboundedPreceding, -1)
    ranked = words.join(rare, "w").withColumn("before", F.coalesce(F.sum(F.length("w") + 1).over(ordered), F.lit(0)))
    outside = ((1 - t) * (2 * F.length(_bare("key")) + 1)) / (t + 2 * (1 - t)) + 1
    firsts = ranked.where(F.col("before") <= outside).select(F.col("key").alias("x"), "w")
    by_word = firsts.join(words.withColumnRenamed("key", "y"), "w").where("x <> y")

    padded = F.transform(F.array_distinct(F.split("key", " ")), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    grams = F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substr(w, i, F.lit(2)))))
    gram = keys.select("key", F.explode(grams).alias("g")).groupBy("key", "g").agg(F.count("*").alias("m"))
    gram_df = gram.groupBy("g").agg(F.count("*").alias("df"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("key").orderBy("df", "g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = gram.join(gram_df, "g").select("key", "g", before.alias("n"), F.length(_bare("key")).alias("l"))
    # of d <= (1 - t) * (lx + ly) edits (d + lx - ly) / 2 delete letters of x, each with two of its grams; the others part one
    lost = lambda l, other: (3 * (1 - t) * (l + other) + l - other) / 2 + 1e-9
    sides = (ranked.select(*(F.col(c).alias(f"{c}{k}" if c != "g" else "g") for c in ("key", "g", "n", "l"))) for k in "xy")
    x, y = next(sides).where(F.col("nx") <= lost(F.col("lx"), F.col("lx"))), next(sides)  # at its most where lengths are equal
    y = y.where(F.col("ny") <= lost(F.col("ly"), t / (2 - t) * F.col("ly")))  # and here where x is as short as it can be
    ahead = (F.struct("lx", "keyx") < F.struct("ly", "keyy")) & (t * F.col("ly") <= (2 - t) * F.col("lx") + 1e-9)
    met = (F.col("nx") <= lost(F.col("lx"), F.col("ly"))) & (F.col("ny") <= lost(F.col("ly"), F.col("lx")))
    by_gram = x.join(y, "g").where(ahead & met).select(F.col("keyx").alias("x"), F.col("keyy").alias("y"))
    pairs = by_word.select("x", "y").union(by_gram)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().where(_can_reach("a", "b", t))


def similar_keys(keys: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(a, b, similarity) of all keys that reach the threshold."""
    t = settings.entity_similarity
    pairs = candidates(keys, t).withColumn("similarity", similarity("a", "b"))
    return pairs.where(F.col("similarity") >= t)


def resolve(mentions: DataFrame, settings: Settings = DEFAULT, merge_equal_keys: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mentions → canonical_map (raw_name, canonical), alias_index, merge_log.

    Names with the same key stay apart unless a third key joins them (or merge_equal_keys is set). A cluster's name is
    the one with the greatest frequency, then length, then spelling.
    """
    names = checkpointed(name_counts(mentions).withColumn("key", normalized_name(F.col("name"))))
    log = checkpointed(similar_keys(names.select("key"), settings))
    found = components(names.select(F.col("key").alias("id")), log)
    joined = log.select(F.explode(F.array("a", "b")).alias("key")).distinct().withColumn("joined", F.lit(True))
    member = names.join(found, F.col("key") == F.col("id")).join(joined, "key", "left")
    apart = F.lit(False) if merge_equal_keys else F.col("joined").isNull()
    cluster = F.when(apart | (F.col("key") == ""), F.concat(F.lit("="), "name")).otherwise(F.concat(F.lit("~"), "component"))
    member = member.select("name", "frequency", "type", cluster.alias("cluster"))
    best = member.groupBy("cluster").agg(
        F.max(F.struct("frequency", F.length("name").alias("n"), "name", "type")).alias("best"),
        F.sum("frequency").alias("frequency"),
        F.array_sort(F.collect_list("name")).alias("names"),
    )
    best = best.select(
        "cluster",
        F.col("best.name").alias("canonical"),
        F.filter("names", lambda n: n != F.col("best.name")).alias("aliases"),
        F.col("best.type").alias("type"),
        "frequency",
    )
    canonical = member.join(best, "cluster").select(F.col("name").alias("raw_name"), "canonical")
    merge_log = log.select(
        F.col("a").alias("name_a"), F.col("b").alias("name_b"), F.round("similarity", 4).alias("similarity"), F.lit("fuzzy_token_set").alias("reason")
    )
    return canonical, best.drop("cluster"), merge_log
