"""URL verdicts by longest fitting rule, else by exact membership in a block list through a Bloom filter cascade.

Keys are domains: a host is listed if it or a domain above it is. The cascade's first level is a Bloom filter of the
listed keys. Over the complete key universe, all domains of all hosts of the table, the unlisted keys that it lets
through form the second level, the listed keys that the second lets through the third, and so on until none is left. A
key's answer is the level that first turns it away, so it is exact for every host of the table, and the test is an
expression of hashes and array look-ups: no join, no Python. The first level's false-positive rate follows the ratio of
listed to other keys, so that all levels together stay near listed * (log2(others / listed) + 3) bits. These come to the
driver and go into the plan, PART_KEYS listed keys at a time: a longer list is cut by a hash of the key into parts, each
with a cascade of its own over its part of the universe, and the table's hosts pass them one after the other. So neither
the driver nor a task ever holds more than one part's bits, whatever the list and the table.

A null url, or one without `://`, has an empty host and path, no rule and the verdict allow. One row for each row, also for
repeated ids and rows; urls of any length are read whole; of rules that fit equally long ones the greater text wins. An
empty table gives an empty result. Columns other than page_id and url are neither read nor in the way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Rules as the contract of the query gives them: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Domains of unwanted hosts.
LISTED = (
    "adult-x.example.com",
    "casino-win.example.net",
    "cheap-pills.example.net",
    "free-bets.example.net",
    "spam-farm.example.org",
)
#: Listed keys in one cascade at most on average: some four megabytes of bits at a thousand other keys for each.
PART_KEYS = 1 << 21
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def domains(host: Column) -> Column:
    """The host and the domains above it; empty for an empty host."""
    parts = F.split(host, r"\.")
    every = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), ".")
    )
    return F.when(F.length(host) > 0, every).otherwise(F.array().cast("array<string>"))


class Level:
    """One Bloom filter as an array of 64-bit words, held in the plan as a folded literal."""

    def __init__(self, keys: DataFrame, n: int, rate: float, seed: int):
        self.bits = max(64, 64 * math.ceil(n * 1.4427 * math.log2(1 / rate) / 64))
        self.hashes, self.seed = max(1, round(math.log2(1 / rate))), seed
        rows = (
            keys.select(F.explode(F.array(*self.places(F.col("key")))).alias("p"))
            .distinct()
            .groupBy(F.expr("p div 64").cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
            .toArrow()
        )
        words = [0] * (self.bits // 64)
        for at, bits in zip(rows.column("word").to_pylist(), rows.column("bits").to_pylist()):
            words[at] = bits
        self.words = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(k)), F.lit(self.bits)) for k in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        out = F.lit(True)
        for p in self.places(key):
            word = F.element_at(self.words, (F.floor(p / 64) + 1).cast("int"))
            out = out & (F.getbit(word, (p % 64).cast("int")) == 1)
        return out


def cascade(s: Scratch, universe: DataFrame, listed: DataFrame) -> list[Level]:
    """Levels for the keys of `listed` among those of `universe`; both have one column, key, without repeats."""
    inside = s.table(listed)
    outside = s.table(universe.join(inside, "key", "left_anti"))
    n_in, n_out = inside.count(), outside.count()
    rate = min(0.5, max(2.0**-30, n_in / (math.sqrt(2) * n_out))) if n_in and n_out else 0.5
    levels: list[Level] = []
    encoded, tested = inside, outside
    while n_in:
        levels.append(Level(encoded, n_in, rate, len(levels)))
        through = s.table(tested.where(levels[-1].holds(F.col("key"))))
        encoded, tested, rate = through, encoded, 0.5
        n_in = through.count()
    return levels


def listed(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is on the list: the number of levels that let it through before one does not."""
    out = F.lit(len(levels) % 2 == 1)
    for k in range(len(levels) - 1, -1, -1):
        out = F.when(levels[k].holds(key), out).otherwise(F.lit(k % 2 == 1))
    return out


def judge(pages: DataFrame, rules=RULES, block_list=LISTED) -> DataFrame:
    """Table (page_id, host, path, rule, verdict). block_list: strings, or a table whose first column holds domains."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not isinstance(block_list, DataFrame):
        block_list = spark.createDataFrame([(k,) for k in block_list], "key string")
    keys = block_list.select(F.translate(F.col(block_list.columns[0]), _UPPER, _LOWER).alias("key"))
    with Scratch(spark) as s:
        universe = s.table(rows.select("host").distinct().select(F.explode(domains(F.col("host"))).alias("key")).distinct())
        keys = s.table(keys.where("key <> ''").distinct().join(universe, "key", "left_semi"))
        parts = max(1, -(-keys.count() // PART_KEYS))
        part = lambda key: F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))
        on_list = F.lit(False)
        for p in range(parts):
            levels = cascade(s, universe.where(part(F.col("key")) == p), keys.where(part(F.col("key")) == p))
            if levels:
                here = F.exists(domains(F.col("host")), lambda k: (part(k) == p) & listed(levels, k) if parts > 1 else listed(levels, k))
                on_list = on_list | here
            if parts > 1:
                rows = s.table(rows.withColumn("listed", on_list))
                on_list = F.col("listed")
        rows = s.keep(rows) if parts > 1 else rows
    fits = []
    for rule_host, rule_path, verdict in rules:
        same = (F.col("host") == rule_host) | F.endswith(F.col("host"), F.lit("." + rule_host))
        here = same & F.startswith(F.col("path"), F.lit(rule_path))
        name = rule_host + rule_path
        fits.append(F.when(here, F.struct(F.lit(len(name)).alias("n"), F.lit(name).alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    other = F.when(on_list, F.lit("block")).otherwise(F.lit("allow"))
    return rows.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", other).alias("verdict")
    )
