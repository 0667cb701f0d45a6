"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, rerank with the original vectors.

1. Equal vectors are one class (by width and two 64-bit hashes of the normalised vector): a vector that a third of all
   rows have is one row from there on, and counts as many links as it has rows.
2. Rotations are learnt on at most SAMPLE vectors of each width (a documented bound): each starts at random and alternates
   between rounding to signs and the orthogonal map that best fits the signs, which balances the bits. Every class is
   coded, and its code cut into T substrings of b bits, one for each table; classes meet where they agree on a whole
   substring. b grows with the logarithm of the number of vectors, so a bucket holds about BUCKET classes on average, and
   T is chosen from b such that a pair at the threshold shares no bucket with probability below MISS, were the bits
   independent; README has the recall that was measured.
3. The tables' shuffle holds ids and codes, no vectors. A kernel keeps those members of a bucket that have another one
   within the Hamming distance that pairs at the threshold have, and whose first common table this is.
4. Only for these the vectors are fetched, and a second kernel compares them by exact cosines in double precision. It gives
   each class the rows it links to and one link of a spanning forest, so no pair is ever a row. Buckets beyond BLOCK
   classes are dealt as pairs of blocks to several tasks.

Widths are compared each by itself, all in the same jobs; their number (not their sizes) comes to the driver.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and so do rows whose vec_id
is null (their component is null and they are kept). Rows that repeat a vec_id are vectors of their own, each with its
links to other rows, but one node: a component holds all that any of them reaches. Empty tables give empty results; other
columns are neither read nor in the way.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .arrowgroups import by_key, fixed_width, sorted_groups
from .components import components
from .scratch import Scratch
from .skew import join_hot

SAMPLE, BUCKET, BLOCK, MISS, ROUNDS = 8192, 64, 512, 1e-3, 30
_KEY_BITS, _TABLE_BITS = 32, 12  # a bucket's number holds its key, its table and its width's place


def rotations(x: np.ndarray, how_many: int, seed: int = 11) -> np.ndarray:
    """how_many orthogonal maps (width x width), each fitted to its own signs."""
    rng, width = np.random.Generator(np.random.PCG64(seed)), x.shape[1]
    out = []
    for _ in range(how_many):
        r = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(ROUNDS if len(x) else 0):
            u, _, v = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
            r = (u @ v).T
        out.append(r)
    return np.stack(out)


def shape_of_tables(n: int, threshold: float) -> tuple[int, int]:
    """Bits in a table's key and number of tables for n vectors."""
    bits = int(np.clip(round(math.log2(max(n, 1) / BUCKET)), 6, 30))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - same))


def most_flips(bits: int, threshold: float) -> int:
    """Differing bits of a code beyond which a pair is not at the threshold: six standard deviations over the mean."""
    p = math.acos(threshold) / math.pi
    return math.ceil(bits * p + 6 * math.sqrt(bits * p * (1 - p)))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows as doubles of length 1; not finite where that cannot be."""
    with np.errstate(all="ignore"):
        x = x.astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
        return x / np.linalg.norm(x, axis=1, keepdims=True) + 0.0


def _by_width(column: pa.Array):
    """(width, rows, their vectors as a matrix) of a list column without nulls."""
    sizes = np.asarray(column.value_lengths())
    for width in np.unique(sizes).tolist():
        row = np.flatnonzero(sizes == width)
        flat = column.take(pa.array(row)).flatten()
        yield width, row, flat.to_numpy(zero_copy_only=False).reshape(len(row), width)


def _hashed(batches):
    """(vec_id, embedding) → (vec_id, w, k1, k2, v); rows that can link to nothing have nulls after the id."""
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        sizes = np.asarray(pc.list_value_length(column).fill_null(0))
        ok, k = (sizes > 0) & np.asarray(ids.is_valid()), np.zeros((2, batch.num_rows), dtype=np.uint64)
        rows = np.flatnonzero(ok)
        held = column.take(pa.array(rows))
        filled = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes[rows])]).astype(np.int32)), held.flatten().fill_null(float("nan"))
        )
        for width, at, x in _by_width(filled):
            x = _unit(x)
            ok[rows[at]] = np.isfinite(x).all(axis=1)
            for n in range(2):
                odd = wh.mix(np.arange(width, dtype=np.uint64) + np.uint64(1 + (n << 32))) | np.uint64(1)
                k[n, rows[at]] = wh.mix((wh.mix(x.view(np.uint64)) * odd).sum(axis=1, dtype=np.uint64))
        none = ~ok
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes.astype(np.int32), mask=none), *(pa.array(x.view(np.int64), mask=none) for x in k), pc.if_else(pa.array(ok), column, pa.scalar(None, column.type))],
            ["vec_id", "w", "k1", "k2", "v"],
        )


def codes_of(v: np.ndarray, maps: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Each unit vector's signs, packed to bytes: tables substrings of bits, one after the other."""
    signs = np.concatenate([v @ r >= 0 for r in maps], axis=1)[:, : bits * tables]
    return np.packbits(signs, axis=1)


def _coded(models: dict):
    def run(batches):
        for batch in batches:
            out: list = [None] * batch.num_rows
            for width, row, x in _by_width(batch.column(4)):
                maps, bits, tables, _ = models[width]
                for a in range(0, len(row), 4096):
                    codes = codes_of(_unit(x[a : a + 4096]), maps, bits, tables)
                    for r, c in zip(row[a : a + 4096].tolist(), codes):
                        out[r] = c.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.binary())], ["vec_id", "w", "k1", "k2", "code"])

    return run


def _placed(models: dict):
    """(w, cid, code) → a row for each table: (b, cid, code), b being the number of the bucket."""

    def run(batches):
        for batch in batches:
            w = batch.column(0).to_numpy()
            for width in np.unique(w).tolist():
                _, bits, tables, nth = models[width]
                mine = pa.array(np.flatnonzero(w == width))
                ids, codes = batch.column(1).take(mine), batch.column(2).take(mine)
                signs = np.unpackbits(_bytes(codes), axis=1)[:, : bits * tables].reshape(len(mine), tables, bits)
                keys = signs @ (1 << np.arange(bits, dtype=np.int64))
                keys += (np.arange(tables, dtype=np.int64) << _KEY_BITS) + (nth << (_KEY_BITS + _TABLE_BITS))
                each = pa.array(np.repeat(np.arange(len(mine)), tables))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), ids.take(each), codes.take(each)], ["b", "cid", "code"])

    return run


def _bytes(codes) -> np.ndarray:
    """A binary column, all of one length, as a matrix of bytes."""
    rows = codes.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), -1)


def _candidates(group: pa.Table, shapes: list, threshold: float):
    """Blocks of rows a and b of a bucket, with the matrix of pairs that may link and meet here first; each pair once."""
    b, i, j = (group.column(c)[0].as_py() for c in ("b", "i", "j"))
    bits, tables = shapes[b >> (_KEY_BITS + _TABLE_BITS)]
    table, limit = (b >> _KEY_BITS) & ((1 << _TABLE_BITS) - 1), most_flips(bits * tables, threshold)
    code, block = _bytes(group.column("code")), group.column("block").to_numpy()
    pad = -code.shape[1] % 8
    words = np.pad(code, ((0, 0), (0, pad))).view(np.uint64)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    for k in range(0, len(left), 128):
        a = left[k : k + 128]
        near = np.bitwise_count(words[a][:, None] ^ words[right][None]).sum(axis=2, dtype=np.int64) <= limit
        if i == j:
            near &= a[:, None] < right[None]
        x, y = np.nonzero(near)
        for m in range(0, len(x), 1 << 14):
            p, q = x[m : m + (1 << 14)], y[m : m + (1 << 14)]
            differ = np.unpackbits(code[a[p]] ^ code[right[q]], axis=1)[:, : bits * tables]
            near[p, q] = (differ.reshape(len(p), tables, bits).any(axis=2).argmin(axis=1)) == table
        if near.any():
            yield a, right, near


def _may_link(shapes: list, threshold: float):
    """Rows (b, i, j, block, cid, code) sorted by (b, i, j) → those that have a candidate, without the code."""

    def run(batches):
        for group in sorted_groups(batches, ["b", "i", "j"]):
            if group.num_rows > 1:
                wanted = np.zeros(group.num_rows, dtype=bool)
                for a, right, near in _candidates(group, shapes, threshold):
                    wanted[a[near.any(axis=1)]] = True
                    wanted[right[near.any(axis=0)]] = True
                if wanted.any():
                    yield from group.filter(pa.array(wanted)).select(["b", "i", "j", "block", "cid"]).combine_chunks().to_batches()

    return run


def _links(shapes: list, threshold: float):
    """Rows (b, i, j, block, cid, rep, n, code, v) sorted by (b, i, j) → (cid, links, a, b): counts, and links of reps."""

    def run(batches):
        for group in sorted_groups(batches, ["b", "i", "j"]):
            ids, rep, n = (group.column(c).to_numpy() for c in ("cid", "rep", "n"))
            v = _unit(fixed_width(group.column("v"), len(group.column("v")[0]), np.float64))
            count, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
            one, two = [], []
            for a, right, near in _candidates(group, shapes, threshold):
                near &= v[a] @ v[right].T >= threshold
                np.add.at(count, a, near @ n[right])
                np.add.at(count, right, n[a] @ near)
                x, y = np.nonzero(near)
                for p, q in zip(a[x].tolist(), right[y].tolist()):
                    while root[p] != p:
                        root[p] = p = root[root[p]]
                    while root[q] != q:
                        root[q] = q = root[root[q]]
                    if p != q:
                        root[max(p, q)] = min(p, q)
                        one.append(rep[p])
                        two.append(rep[q])
            linked = np.flatnonzero(count)
            if len(linked):
                tail, zero = pa.nulls(len(linked), pa.int64()), np.zeros(len(one), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ids[linked], zero])),
                        pa.array(np.concatenate([count[linked], zero])),
                        pa.concat_arrays([tail, pa.array(one, pa.int64())]),
                        pa.concat_arrays([tail, pa.array(two, pa.int64())]),
                    ],
                    ["cid", "links", "a", "b"],
                )

    return run


def near_vectors(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Table (vec_id, n_links, component_id, kept), one row per input row."""
    kind = "float" if embeddings.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    with Scratch(embeddings.sparkSession) as s:
        hashed = s.table(rows.mapInArrow(_hashed, f"vec_id long, w int, k1 long, k2 long, v array<{kind}>"))
        units = hashed.where("w is not null")
        models: dict = {}
        for r in units.groupBy("w").count().orderBy("w").collect():
            bits, tables = shape_of_tables(r["count"], threshold)
            sample = units.where(F.col("w") == r["w"]).orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id", "k1").limit(SAMPLE).select("v").toArrow()
            x = _unit(fixed_width(sample.column("v"), r["w"], np.float64))
            models[r["w"]] = (rotations(x, -(-bits * tables // r["w"])), bits, tables, len(models))
        shapes = [(bits, tables) for _, bits, tables, _ in models.values()]
        key = ["w", "k1", "k2"]
        coded = units.mapInArrow(_coded(models), "vec_id long, w int, k1 long, k2 long, code binary")
        classes = coded.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min("code").alias("code"))
        classes = s.table(classes.withColumn("cid", F.monotonically_increasing_id()))

        placed = classes.select("w", "cid", "code").mapInArrow(_placed(models), "b long, cid long, code binary")
        hot = s.table(placed.groupBy("b").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK))
        blocks = F.coalesce(F.ceil(F.col("m") / BLOCK), F.lit(1)).cast("int")
        dealt = (
            placed.join(hot, "b", "left")
            .withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("b", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "code")
        )
        wanted = by_key(dealt, "b", "i", "j").mapInArrow(_may_link(shapes, threshold), "b long, i int, j int, block int, cid long")
        wanted = s.table(wanted)
        named = classes.join(wanted.select("cid").distinct(), "cid", "left_semi")
        vectors = units.select(*key, F.col("vec_id").alias("rep"), "v").join(named, [*key, "rep"]).dropDuplicates(["cid"])
        ranked = wanted.join(vectors.select("cid", "rep", "n", "code", "v"), "cid")
        found = s.table(by_key(ranked, "b", "i", "j").mapInArrow(_links(shapes, threshold), "cid long, links long, a long, b long"))

        left = units.select("vec_id", *key)
        mine = s.table(join_hot(s, left, classes.select(*key, "cid", "rep", "n", F.col("n").alias("n__")), key).select("vec_id", "cid", "rep", "n"))
        several = mine.groupBy("vec_id").agg(F.min("cid").alias("x"), F.max("cid").alias("y")).where("x < y")
        own = mine.join(several, "vec_id", "left_semi").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
        node = components(s, found.where("a is not null").select("a", "b").union(own))
        counts = found.where("links > 0").groupBy("cid").agg(F.sum("links").alias("links"))
        traits = classes.join(counts, "cid", "left").join(node, F.col("rep") == F.col("node"), "left")
        traits = traits.select("cid", F.coalesce("links", F.lit(0)).alias("links"), "component", F.col("n").alias("n__"))
        out = join_hot(s, mine, traits, ["cid"]).select(
            "vec_id", (F.col("n") - 1 + F.col("links")).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
        )
        alone = hashed.where("w is null").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
        return s.keep(out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
