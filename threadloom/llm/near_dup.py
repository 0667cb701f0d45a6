"""Near-duplicate documents: MinHash bands for candidates, odd sketches to estimate them, full sets to confirm.

Words are runs without white space, A-Z lower-cased; a document's set holds the hashes of its distinct shingles of
`words` words (with fewer words, its whole sequence as one; without words, nothing). Plan:

1. One pass over the texts gives each document 128 MinHash samples, folded twice: into 32 bands of 4, and into a parity
   bitmap of 512 bits (the odd sketch), of which the XOR of two estimates their similarity.
2. Documents with the same set are one class, found by a grouped minimum; only one of each goes further.
3. Each bucket of a band pairs its members with its smallest class, the hub, so a bucket of m gives m - 1 pairs.
   Pairs whose sketches or set sizes rule out the threshold go; the rest are confirmed on full sets.
4. Only buckets that still hold several components go on. Their members meet once for each hub, in blocks, with those
   outside the hub's component: first their sketches alone, which keep the members that have a candidate, then the full
   sets of these. A kernel confirms what may link and returns only links that join components. So no bucket is capped, no
   link between components is skipped, and no pair is ever a row. A block has BLOCK classes or BLOCK_BYTES of sets at
   most on average, or one longer document.

A pair at 0.8 shares no band with probability (1 - 0.8^4)^32 < 1e-7; the sketch's margin is over five standard
deviations of its estimate (0.037).

Nulls: a null or empty text has no set and links with nothing; a row with a null doc_id gets a null component and is
kept. Rows that repeat a doc_id are one node, also with different texts: its links are those of all its texts. Texts of any
length are read whole. An empty table gives an empty result. Other columns are neither read nor in the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .arrowgroups import by_key, fixed_width, sorted_groups
from .components import components
from .scratch import Scratch

BANDS, ROWS, BITS = 32, 4, 512
SAMPLES = BANDS * ROWS
MARGIN = 0.2
BLOCK, BLOCK_BYTES = 256, 8 << 20

_rng = np.random.Generator(np.random.PCG64(7))
_MULTIPLIERS = (_rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_PLACE = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_COLUMN = (_rng.integers(1, 1 << 62, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[None, :]
_BAND = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    for g in wh.groups(column):
        hashes = g.hashes(fold=True)
        shingles, _ = g.windows(hashes, words)
        for a, b in zip(g.word_of[:-1].tolist(), g.word_of[1:].tolist()):
            if b - a >= words:
                yield np.unique(shingles[a : b - words + 1])
            elif b > a:
                yield wh.span_hash(hashes, np.array([a]), np.array([b]))
            else:
                yield np.zeros(0, dtype=np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(x), 4096):
        np.minimum(least, (_MULTIPLIERS * x[None, k : k + 4096]).min(axis=1), out=least)
    return least.astype(np.uint64)


def bands(samples: np.ndarray) -> np.ndarray:
    return wh.mix((samples.reshape(BANDS, ROWS) * _COLUMN).sum(axis=1, dtype=np.uint64) + _BAND)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Bit p is the parity of the number of samples that fall on p."""
    at = (wh.mix(samples + _PLACE) >> np.uint64(40)) % np.uint64(BITS)
    odd = (np.bincount(at.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def most_bits(threshold: float) -> int:
    """XOR population count beyond which two sketches' estimated similarity is below the threshold less the margin."""
    differing = 2 * SAMPLES * (1 - max(0.0, threshold - MARGIN))
    return int(np.ceil(BITS / 2 * (1 - np.exp(-2 * differing / BITS))))


def _signatures(words: int):
    def run(batches):
        for batch in batches:
            n, k1, k2, bb, ss = [], [], [], [], []
            for shingles in shingle_sets(batch.column(2), words):
                n.append(len(shingles))
                k1.append(int(wh.mix(shingles ^ np.uint64(0x51)).sum(dtype=np.uint64)))
                k2.append(int(np.bitwise_xor.reduce(wh.mix(shingles + np.uint64(0xABCD)))) if len(shingles) else 0)
                if len(shingles):
                    samples = minhash(shingles)
                    bb.append(bands(samples).view(np.int64))
                    ss.append(odd_sketch(samples).view(np.int64))
            n = np.array(n, dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(n > 0)]).astype(np.int32)
            lists = lambda rows, w: pa.ListArray.from_arrays(
                pa.array(offsets * np.int32(w)), pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(n),
                    pa.array(np.array(k1, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(k2, dtype=np.uint64).view(np.int64)),
                    lists(bb, BANDS),
                    lists(ss, BITS // 64),
                ],
                ["doc_id", "at", "n_shingles", "k1", "k2", "bands", "sketch"],
            )

    return run


def _sets(words: int):
    """(id, text) → (id, shingles), the first of equal ids in a partition only."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            new = [k for k, i in enumerate(ids) if i not in seen and not seen.add(i)]
            batch = batch.take(pa.array(new, pa.int64()))
            sets = list(shingle_sets(batch.column(1), words))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
                ["id", "shingles"],
            )

    return run


def _may_link(percent: int):
    """Rows (hub, i, j, block, rep, comp, n, sketch) sorted by (hub, i, j) → those with a candidate in another component."""
    limit = most_bits(percent / 100)

    def run(batches):
        for t in sorted_groups(batches, ["hub", "i", "j"]):
            comp, n, block = (t.column(c).to_numpy() for c in ("comp", "n", "block"))
            sketch = fixed_width(t.column("sketch"), BITS // 64, np.int64).view(np.uint64)
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            wanted = np.zeros(t.num_rows, dtype=bool)
            for k in range(0, len(left), 64):
                a = left[k : k + 64][:, None]
                near = comp[a] != comp[right]
                near &= 100 * np.minimum(n[a], n[right]) >= percent * np.maximum(n[a], n[right])
                near &= np.bitwise_count(sketch[a] ^ sketch[right]).sum(axis=2, dtype=np.int64) <= limit
                wanted[a[near.any(axis=1), 0]] = True
                wanted[right[near.any(axis=0)]] = True
            if wanted.any():
                yield from t.filter(pa.array(wanted)).select(["hub", "i", "j", "block", "rep", "comp"]).combine_chunks().to_batches()

    return run


def _across(percent: int):
    """Rows (hub, i, j, block, rep, comp, n, sketch, shingles) sorted by (hub, i, j) → links across components.

    A member's candidates are the other components' members that size and sketch allow. The nearest few are confirmed
    first; the rest only as far as they are still apart from it. Both times one search counts all common shingles.
    """
    limit = most_bits(percent / 100)

    def run(batches):
        for t in sorted_groups(batches, ["hub", "i", "j"]):
            rep, comp, n, block = (t.column(c).to_numpy() for c in ("rep", "comp", "n", "block"))
            sketch = fixed_width(t.column("sketch"), BITS // 64, np.int64).view(np.uint64)
            lists = t.column("shingles").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            flat, size = lists.flatten().to_numpy().view(np.uint64), np.asarray(lists.value_lengths()).astype(np.int64)
            begin = np.cumsum(size) - size
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            names, label = np.unique(comp, return_inverse=True)
            label = label.copy()
            one, two = [], []

            def confirm(k, to):
                part = np.repeat(begin[to] - np.cumsum(size[to]) + size[to], size[to]) + np.arange(size[to].sum())
                own = flat[begin[k] : begin[k] + size[k]]
                at = np.minimum(np.searchsorted(own, flat[part]), len(own) - 1)
                common = np.add.reduceat((own[at] == flat[part]).astype(np.int64), np.cumsum(size[to]) - size[to])
                for m in to[100 * common >= percent * (size[k] + size[to] - common)].tolist():
                    if label[m] != label[k]:
                        label[label == label[m]] = label[k]
                        one.append(rep[k])
                        two.append(rep[m])

            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            for k in left.tolist():
                to = right[rep[right] > rep[k]] if i == j else right
                to = to[label[to] != label[k]]
                to = to[100 * np.minimum(n[to], n[k]) >= percent * np.maximum(n[to], n[k])]
                bits = np.bitwise_count(sketch[to] ^ sketch[k]).sum(axis=1, dtype=np.int64)
                order = np.argsort(bits, kind="stable")
                to = to[order][bits[order] <= limit]
                if len(to):
                    confirm(k, to[:8])
                    for start in range(8, len(to), 1024):
                        rest = to[start : start + 1024]
                        rest = rest[label[rest] != label[k]]
                        if len(rest):
                            confirm(k, rest)
            if one:
                yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["a", "b"])

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, c) whose full sets have at least `percent` hundredths in common."""
    one, two = (sets.select(F.col("id").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ac")
    common = F.size(F.array_intersect("sa", "sc"))
    return (
        pairs.join(one, "a")
        .join(two, "c")
        .select("a", "c", common.alias("common"), (F.size("sa") + F.size("sc")).alias("both"))
        .where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("both") - F.col("common")))
        .select("a", F.col("c").alias("b"))
        .distinct()
    )


def near_duplicates(documents: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """Table (doc_id, n_shingles, component_id, kept), one row per input row.

    Documents link where 100 * common >= percent * union; component_id is the smallest doc_id reachable by links.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("at"), "text")
    with Scratch(documents.sparkSession) as s:
        sig = s.table(
            docs.mapInArrow(
                _signatures(words),
                "doc_id long, at long, n_shingles long, k1 long, k2 long, bands array<long>, sketch array<long>",
            )
        )
        known = sig.where("n_shingles > 0 and doc_id is not null")
        classes = known.groupBy("k1", "k2").agg(
            F.min(F.struct("doc_id", "at")).alias("least"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
        classes = s.table(classes.withColumn("rep", F.monotonically_increasing_id()))
        several = known.groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("x"), F.max(F.struct("k1", "k2")).alias("y"))
        several = s.table(known.join(several.where("x <> y").select("doc_id"), "doc_id", "left_semi").select("doc_id", "k1", "k2").distinct())
        several = several.join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).select("doc_id", "rep")
        own = several.join(several.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b"))

        member = classes.select("rep", "n", F.explode("bands").alias("b"))
        buckets = s.table(
            member.groupBy("b")
            .agg(F.count("*").alias("m"), F.min("rep").alias("low"))
            .where("m > 1")
        )
        met = s.table(member.join(buckets, "b"))  # only rows of buckets with company
        wanted = met.select(F.col("rep").alias("id")).distinct().join(classes.select(F.col("rep").alias("id"), "least.*"), "id")
        wanted = wanted.withColumnsRenamed({"doc_id": "doc__", "at": "at__"}).hint("merge")
        texts = docs.join(wanted, (docs["doc_id"] == wanted["doc__"]) & (docs["at"] == wanted["at__"])).select("id", "text")
        sets = s.table(texts.mapInArrow(_sets(words), "id long, shingles array<long>"))

        traits = classes.select("rep", "n", "sketch")
        one, two = (traits.select(*(F.col(x).alias(f"{x}_{k}") for x in ("rep", "n", "sketch"))) for k in "ac")
        bits = F.aggregate(
            F.zip_with("sketch_a", "sketch_c", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x
        )
        stars = met.where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("c")).distinct()
        stars = (
            stars.join(one, F.col("a") == F.col("rep_a"))
            .join(two, F.col("c") == F.col("rep_c"))
            .where(F.least("n_a", "n_c") * 100 >= F.greatest("n_a", "n_c") * percent)
            .where(bits <= most_bits(percent / 100))
            .select("a", "c")
        )
        links = s.table(_confirm(s.table(stars), sets, percent).union(own))
        found = components(s, links)

        mixed = met.where("m > 2").select("b", "low", "rep", "n").join(found, F.col("rep") == F.col("node"), "left")
        mixed = s.table(mixed.select("b", "low", "rep", "n", F.coalesce("component", "rep").alias("comp")))
        apart = mixed.groupBy("b").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y")
        mixed = mixed.join(apart.select("b"), "b").groupBy("low", "rep").agg(F.first("comp").alias("comp"), F.first("n").alias("n"))
        hub = found.select(F.col("node").alias("low"), F.col("component").alias("hub_comp"))
        mixed = mixed.join(hub, "low", "left").withColumn("main", F.col("comp") == F.coalesce("hub_comp", "low"))
        mixed = s.table(mixed.select(F.col("low").alias("hub"), "rep", "comp", "n", "main"))
        size = lambda of: F.greatest(F.count_if(of) / BLOCK, F.sum(F.when(of, F.col("n")).otherwise(0)) * 8 / BLOCK_BYTES)
        sizes = mixed.groupBy("hub").agg(
            F.ceil(size(F.col("main"))).cast("int").alias("n_main"), F.ceil(size(~F.col("main"))).cast("int").alias("n_other")
        )
        n_main, n_other, place = F.col("n_main"), F.col("n_other"), F.xxhash64("rep")
        rest = (
            mixed.join(sizes.where("n_other > 0"), "hub")
            .withColumn("block", F.when(F.col("main"), F.pmod(place, n_main)).otherwise(n_main + F.pmod(place, n_other)).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.when(F.col("main"), n_main).otherwise(F.lit(0)), n_main + n_other - 1)))
            .select("hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "comp")
            .join(traits, "rep")
            .select("hub", "i", "j", "block", "rep", "comp", "n", "sketch")
        )
        rest = s.table(by_key(rest, "hub", "i", "j").mapInArrow(_may_link(percent), "hub long, i int, j int, block int, rep long, comp long"))
        rest = rest.join(traits, "rep").join(sets, F.col("rep") == F.col("id"))
        rest = rest.select("hub", "i", "j", "block", "rep", "comp", "n", "sketch", "shingles")
        more = s.table(by_key(rest, "hub", "i", "j").mapInArrow(_across(percent), "a long, b long"))
        if not more.isEmpty():
            found = components(s, links.union(more))

        named = classes.select("k1", "k2", "rep", "least.doc_id").join(found, F.col("rep") == F.col("node"), "left")
        named = named.select("k1", "k2", "doc_id", F.coalesce("component", "rep").alias("component"))
        smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        named = named.join(smallest, "component").select("k1", "k2", "component_id")
        out = sig.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return s.keep(
            out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, own).otherwise(F.col("doc_id")).alias("component_id")).withColumn(
                "kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
            )
        )
