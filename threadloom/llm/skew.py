"""Joins whose left side may hold very many rows of one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: A key is hot if it has more than one in so many of the left rows; there are always fewer hot keys than this.
SHARE = 512


def join_hot(s: Scratch, left: DataFrame, right: DataFrame, keys: list[str], share: int = SHARE) -> DataFrame:
    """left joined with right on keys, where right has a row for each key at most and column n__, its rows in left.

    Both are tables that can be read twice. Fewer than `share` keys can each have more than 1/share of left's rows, so
    right's rows for them are broadcast and left's stay where they are; all others are shuffled, and no key has more
    than 1/share of those. n__ goes. Keys are not null. An empty side gives an empty result.
    """
    right = s.table(right)
    hot = F.col("n__") * F.lit(share) > F.lit(left.count())
    hot_rows, rest = right.where(hot).drop("n__"), right.where(~hot).drop("n__")
    cold = left.join(F.broadcast(hot_rows.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot_rows), keys).unionByName(cold.join(rest, keys))
