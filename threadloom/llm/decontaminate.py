"""Documents that hold a benchmark item, also with its numbers, quantities and names changed.

One pass cuts a text into tokens: numbers, which take a unit behind or a currency sign before them along (quantities),
names (words with a capital first letter other than FUNCTION words, a run of them at once, wherever they stand) and other
words. A token's template word is a typed placeholder or the lower-cased word, its value is the token itself, so words
and values can't drift apart. Every window of WINDOW template words is hashed, unless half of it is placeholders; so is
every window of the plain lower-cased words, which find items that are mostly placeholders and copies in another case.
An item with fewer words is one window of its own length: of its plain words, and of its template words if these are SHORT
at least and more than half of them no placeholders.

1. The documents' windows are exploded and joined by hash with the distinct hashes of the benchmark's: these are broadcast
   while their counted number stays below BROADCAST, and joined by shuffle beyond, where adaptive execution splits a hash
   that very many documents have.
2. An item's windows are ordered by how often the documents have them. A document that has the share of an item's windows
   has one of the rarest (1 - share), so only these name candidates: a window that many items and many documents have
   never pairs them all.
3. A candidate's hits are gathered by shift (place in the document less place in the item). Shifts up to SLACK apart, as a
   few words put in or left out make them, count together, each of the item's windows once. Every place of a document
   that reaches the share is judged.
4. A place agrees if each of the item's slot values turns into one value there, with conflicts for at most half of them.
   The agreeing place with most windows wins, of equals that with fewest conflicts, then the first. Plain windows need no
   agreement.

Only DataFrame expressions are used. Texts are read whole, of any length: no pattern recurses or starts over.

Null texts, texts without words and null ids never match. Rows that repeat a doc_id count as one document: one row for
each document and item, a template match before a plain one. Repeated item_ids: one of their texts counts, the least.
Empty tables give an empty result. Columns other than the ids and texts are neither read nor in the way.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .names import fresh
from .scratch import Scratch

WINDOW, SHARE, SHORT, SLACK = 8, 0.5, 5, 8
#: Hashes and bytes of items' texts that are broadcast at most.
BROADCAST, BROADCAST_BYTES = 1_000_000, 32 << 20
#: Unit words and signs that turn a number into a quantity.
UNITS = "kg g mg km cm mm m mi miles mile feet ft inches inch lb lbs oz liters liter litres litre l ml hours hour hrs h minutes minute min seconds second sec s days day weeks week months month years year percent % dollars dollar usd eur euros euro $ € £ kmh mph degrees"
#: Words that are no names, though they begin sentences: English, German, French, Spanish.
FUNCTION = (
    "The An And Or But If When Where Which Who Whose What Why How Then There This That These Those It Its He She They We You In On At Of To "
    "For From By With As Is Are Was Were Be Do Does Did Has Have Had Not No So After Before Each Every All Some Der Die Das Ein Eine Und "
    "Oder Wenn Wer Wie Wo Was Es Er Sie Wir Ich Le La Les Un Une Et Ou Si Qui Que Il Elle Nous El Los Las Una De Du Des En Es Se Su"
)
_LETTER, _SPACE = r"[\p{L}\p{N}]", r"[\s\p{Z}]"
_END = rf"(?!{_LETTER})"
_UNIT = "|".join(re.escape(u) for u in sorted(UNITS.split(), key=len, reverse=True))
# loops are possessive, as Java's other loops over groups take stack for each turn and overflow on long runs
NUMBER = rf"(?:[$€£]{_SPACE}?+)?+[0-9]++(?:[.,:/][0-9]++)*+(?:{_SPACE}*+(?i:{_UNIT}){_END})?+"
_NAME = rf"(?=\p{{Lu}})(?!(?:{'|'.join(FUNCTION.split())}){_END})\p{{Lu}}{_LETTER}++"
NAME = rf"{_NAME}(?:(?:-|{_SPACE}++){_NAME})*+"
TOKEN = rf"\p{{Ll}}{_LETTER}*+|{NUMBER}|{NAME}|{_LETTER}++"  # most words are settled by the first branch
_QUANTITY, _NUMBER, _PERSON = "<quantity>", "<number>", "<name>"  # no word holds such signs
_FUNCTION_SQL = ", ".join(f"'{w}'" for w in sorted(set(FUNCTION.split())))


def plain(text: Column) -> Column:
    """Lower-cased words."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _slot(t: str) -> str:
    """SQL: the placeholder for a token, null for a word. Its first character tells: only numbers begin with a digit or sign."""
    digit = "ascii({}) BETWEEN 48 AND 57".format
    return (
        f"CASE WHEN ascii({t}) BETWEEN 97 AND 122 THEN NULL WHEN {digit(t)} THEN if({digit(f'right({t}, 1)')}, '{_NUMBER}', '{_QUANTITY}') WHEN left({t}, 1) IN ('$', '€', '£') THEN '{_QUANTITY}' "
        f"WHEN length({t}) > 1 AND left({t}, 1) <> lower(left({t}, 1)) AND {t} NOT IN ({_FUNCTION_SQL}) THEN '{_PERSON}' END"
    )


def template(tokens: str = "tokens") -> Column:
    """The template's words, from the name of a column of tokens."""
    return F.expr(f"transform({tokens}, t -> coalesce({_slot('t')}, lower(t)))")


def slots(tokens: str = "tokens") -> Column:
    """(at, slot, value) of each placeholder, from the name of a column of tokens."""
    every = f"transform({tokens}, (t, k) -> named_struct('at', k, 'slot', {_slot('t')}, 'value', regexp_replace(lower(t), '[\\\\s\\\\p{{Z}}]++', ' ')))"
    return F.expr(f"filter({every}, x -> x.slot IS NOT NULL)")


def with_window_hashes(df: DataFrame, hashes: str, seed: int) -> DataFrame:
    """Turns the column `hashes`, words in a row, into the hashes of each WINDOW (8) of them.

    Word hashes are combined to pairs, fours and eights, a column each, so that no step is computed twice.
    """
    df = df.withColumn(hashes, F.transform(hashes, lambda w: F.xxhash64(F.lit(seed), w)))
    for step in (1, 2, 4):
        ahead = F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes) - step, F.lit(0)))
        df = df.withColumn(hashes, F.zip_with(hashes, ahead, lambda a, b: F.xxhash64(a, b)))
    return df.withColumn(hashes, F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))))


def _of_length(words: str, n: int, seed: int) -> Column:
    """Hashes of n words in a row, for items of n words."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.xxhash64(F.lit(seed - 10 * n), F.slice(words, k, F.lit(n))))


def _free(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: ~w.isin(_QUANTITY, _NUMBER, _PERSON)))


def _windows(s: Scratch, items: DataFrame) -> tuple[DataFrame, dict[str, list[int]]]:
    """(item_id, exact, at, hash) of the items' windows, and the lengths of items that are one window, by kind of words."""
    out, lengths = [], {}
    for seed, kind in enumerate(("words", "plain")):
        mine = items.select("item_id", F.col(kind).alias("w"), F.size(kind).alias("n"))
        many = with_window_hashes(mine.withColumn("h", F.col("w")), "h", seed)
        many = many.select("item_id", "w", F.posexplode("h").alias("at", "hash"))
        few = mine.where(f"n between 1 and {WINDOW - 1}")
        if kind == "words":
            many = many.where(_free(F.slice("w", F.col("at") + 1, F.lit(WINDOW))) * 2 > WINDOW)
            few = few.where((F.col("n") >= SHORT) & (_free(F.col("w")) * 2 > F.col("n")))
        out.append(many.select("item_id", F.lit(seed == 1).alias("exact"), "at", "hash"))
        lengths[kind] = sorted(r["n"] for r in few.select("n").distinct().collect())
        for n in lengths[kind]:
            whole = few.where(F.col("n") == n).select("item_id", F.lit(seed == 1), F.posexplode(_of_length("w", n, seed)))
            out.append(whole)
    rows = out[0]
    for more in out[1:]:
        rows = rows.union(more)
    return s.table(rows), lengths


def _met(docs: DataFrame, hashes: DataFrame, lengths: dict[str, list[int]], small: bool) -> DataFrame:
    """(doc_id, key, place, hash) of the documents' windows that the benchmark has too."""
    probes = docs.select("doc_id", "key", tokens(F.col("text")).alias("tokens"), plain(F.col("text")).alias("plain"))
    probes = probes.select("doc_id", "key", template().alias("words"), "plain")
    for seed, kind in enumerate(("words", "plain")):
        probes = with_window_hashes(probes.withColumn(f"{kind}_hashes", F.col(kind)), f"{kind}_hashes", seed)
    rows = []
    for seed, kind in enumerate(("words", "plain")):
        rows += [F.col(f"{kind}_hashes"), *(_of_length(kind, n, seed) for n in lengths[kind])]
    begins = F.array(*(sum((F.size(h) for h in rows[:k]), F.lit(0)) for k in range(len(rows))))
    # the outer form, as a filter on the array's size would be pushed down and compute all its steps again
    probes = probes.select("doc_id", "key", begins.alias("begins"), F.posexplode_outer(F.concat(*rows)).alias("nth", "hash"))
    met = probes.join(F.broadcast(hashes) if small else hashes, "hash")
    begin = F.array_max(F.filter("begins", lambda b: b <= F.col("nth")))  # of equal ones all but the last are empty
    return met.select("doc_id", "key", (F.col("nth") - begin).alias("place"), "hash")


def _judged(place: Column) -> Column:
    """A place (n, shift) of a row with its item's slots and the document's (by place), with how far the values agree."""

    def pair(k: Column) -> Column:
        there = F.element_at("theirs", k["at"] + place["shift"])
        return F.when(there["slot"] == k["slot"], F.struct(k["value"].alias("a"), there["value"].alias("b")))

    pairs = F.array_distinct(F.filter(F.transform("slots", pair), lambda p: p.isNotNull()))
    return F.struct(place["n"].alias("n"), place["shift"].alias("shift"), pairs.alias("pairs"))


def leaks(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """Table (doc_id, item_id, n_windows, n_matched, n_slots, n_conflicts), a row for each document and item it holds.

    n_matched counts the item's windows at the place that won, n_slots its slot values that were compared there, and
    n_conflicts those pairs of values beyond one for each.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.where("doc_id is not null and text is not null").withColumn("key", F.xxhash64("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item"))
    items = items.where("item_id is not null and item is not null").groupBy("item_id").agg(F.min("item").alias("item"))
    with Scratch(documents.sparkSession) as s:
        items = items.withColumn("tokens", tokens(F.col("item"))).withColumn("plain", plain(F.col("item")))
        items = s.table(items.withColumn("words", template()))
        windows, lengths = _windows(s, items)
        hashes = s.table(windows.select("hash").distinct())
        small = hashes.count() <= BROADCAST
        met = s.table(_met(docs, hashes, lengths, small))

        seen = met.groupBy("hash").agg(F.count("*").alias("df"))
        whole = Window.partitionBy("item_id", "exact")
        ranked = windows.join(seen, "hash", "left").withColumn("n_windows", F.count("*").over(whole))
        ranked = ranked.withColumn("nth", F.row_number().over(whole.orderBy(F.coalesce("df", F.lit(0)), "at")))
        wanted = F.greatest(F.ceil(F.lit(share) * F.col("n_windows")), F.lit(1))
        windows = s.table(ranked.select("item_id", "exact", "at", "hash", "n_windows", (F.col("nth") <= F.col("n_windows") - wanted + 1).alias("rare"), F.col("df").isNotNull().alias("met")))
        few = lambda df: F.broadcast(df) if small and windows.count() <= BROADCAST else df
        rare = few(windows.where("rare and met").select("hash", "item_id", "exact").distinct())
        asked = met.join(rare, "hash").select("doc_id", "key", "item_id", "exact").distinct()
        asked = asked.join(few(windows.where("met").drop("rare", "met")), ["item_id", "exact"])
        hits = asked.join(met, ["doc_id", "key", "hash"]).withColumn("shift", F.col("place") - F.col("at"))

        group = ["doc_id", "key", "item_id", "exact", "n_windows"]
        aligned = hits.groupBy(*group, "shift").agg(F.collect_set("at").alias("ats"))
        span = 2 * SLACK  # each shift lies in two overlapping ranges, so that any SLACK apart share one
        ranges = F.explode(F.array(F.floor(F.col("shift") / span) * 2, F.floor((F.col("shift") + SLACK) / span) * 2 + 1))
        places = aligned.withColumn("range", ranges).groupBy(*group, "range")
        places = places.agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("n"),
            F.max_by("shift", F.struct(F.size("ats"), -F.col("shift"))).alias("shift"),
        )
        places = places.where(F.col("n") >= F.lit(share) * F.col("n_windows"))
        found = s.table(places.groupBy(*group).agg(F.collect_set(F.struct("n", "shift")).alias("places")))

        held = found.where("not exact")
        mine = items.join(held.select("item_id").distinct(), "item_id", "left_semi")
        size = mine.agg(F.sum(F.length("item"))).first()[0] or 0
        mine = mine.select("item_id", slots().alias("slots"))
        held = held.join(F.broadcast(mine) if size <= BROADCAST_BYTES else mine, "item_id")
        # tables of their own, as filters pushed down would cut the tokens anew for each pair; rows that repeat a document
        # meet in the minimum below
        held = docs.join(held, ["doc_id", "key"]).select(*group, "places", "slots", tokens(F.col("text")).alias("tokens"))
        theirs = F.map_from_entries(F.transform("x", lambda x: F.struct(x["at"], F.struct(x["slot"], x["value"]))))
        held = held.select(*group, "places", "slots", slots().alias("x")).withColumn("theirs", theirs)
        held = s.table(held.select(*group, F.explode_outer(F.transform("places", _judged)).alias("p")))
        n_slots = F.size(F.array_distinct(F.transform("p.pairs", lambda x: x["a"])))
        held = held.select(*group, "p.n", "p.shift", n_slots.alias("n_slots"), (F.size("p.pairs") - n_slots).alias("conflicts")).where("2 * conflicts <= n_slots")
        held = held.select(*group, F.struct((-F.col("n")).alias("less"), "conflicts", "shift", F.col("n_slots").alias("slots")).alias("best"))
        none = F.struct(*(F.lit(0).alias(c) for c in ("conflicts", "shift", "slots")))
        exact = found.where("exact").select(*group, F.struct((-F.array_max(F.transform("places", lambda p: p["n"]))).alias("less"), none["conflicts"], none["shift"], none["slots"]).alias("best"))
        best = held.union(exact).groupBy("doc_id", "item_id").agg(F.min(F.struct("exact", "best", "n_windows")).alias("x"))
        out = best.select(
            "doc_id", "item_id", "x.n_windows",
            (-F.col("x.best.less")).cast("long").alias("n_matched"), F.col("x.best.slots").cast("long").alias("n_slots"), F.col("x.best.conflicts").cast("long").alias("n_conflicts"),
        )
        return s.keep(out)


def drop_leaks(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents, all columns as they are, without those that hold a benchmark item."""
    ids = leaks(documents, benchmark, share).select("doc_id").distinct()
    (name,) = fresh(documents.columns, "leak")
    ids = ids.withColumnRenamed("doc_id", name)
    return documents.join(ids, documents["doc_id"].cast("long") == ids[name], "left_anti")
