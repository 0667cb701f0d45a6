"""Best-fit packing planned on the histogram of lengths.

Texts become token ids, then an end id; a document longer than `size` is cut into pieces of `size`, of which the first
may be shorter. Best-fit decreasing then runs over counts of equal pieces, on the driver: it sees at most `size` counts,
whatever the corpus. Pieces of one length are interchangeable, so the plan is a list of slots: the ranks from..to of a
length go into such sequences at such offsets. Pieces find their slots by rank within their length. Ranks come from
row numbers within (length, salt) plus the salts' running counts, with as many salts as keep a numbered group near
RANKED rows, so a length that a third of all pieces have is spread over many tasks. A salt hashes the piece with its
number in its partition, so rows that are equal in all their columns are spread as well. The plan is broadcast: it has a
row for each length and remaining room that meet, bounded by size² / 2 and in practice by a few times `size`.

A null or empty text is one piece with the end id alone; so has a row with a null id. Repeated rows and ids are packed each
for itself; pieces of one length are interchangeable, so which of them gets which slot is open. Texts are encoded whole, of
any length and with any run of blanks. An empty table gives an empty result. Columns other than doc_id and text are
neither read nor in the way.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .tokens import byte_encoder

SIZE, END_ID, RANKED = 1024, 2, 50_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, nth int"


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing: {length: pieces} → slots (length, first rank, pieces, first sequence, offset, per sequence).

    Rank r of the length goes into sequence first + (r - first rank) // per, behind r's predecessors there.
    """
    room: list[list[list[int]]] = [[] for _ in range(size + 1)]  # by tokens free: [first sequence, sequences]
    slots, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank, free = counts[length], 0, length
        while left:
            while free < size and not room[free]:
                free += 1
            per = free // length
            wanted = -(-left // per)
            if room[free]:
                first, have = room[free].pop()
                if have > wanted:
                    room[free].append([first + wanted, have - wanted])
                used = min(have, wanted)
            else:
                first, used = opened, wanted
                opened += wanted
            n = min(left, used * per)
            slots.append((length, rank, n, first, size - free, per))
            full, over = divmod(n, per)
            if full and free - per * length:
                room[free - per * length].append([first, full])
            if over and free - over * length:
                room[free - over * length].append([first + full, 1])
            left, rank = left - n, rank + n
    return slots


def _pieces(path: str, size: int, end_id: int, with_ids: bool):
    def run(batches):
        encode, seen = byte_encoder(path), 0
        for batch in batches:
            texts, rows = batch.column(1), {k: [] for k in ("row", "piece", "start", "length", "crc", "ids")}
            for k in range(batch.num_rows):
                ids = np.array([*encode(texts[k].as_py() or ""), end_id], dtype="<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for c, v in zip(rows, (k, p, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b] if with_ids else None)):
                        rows[c].append(v)
            columns = [
                batch.column(0).take(pa.array(rows["row"], pa.int64())),
                pa.array(rows["piece"], pa.int32()),
                *(pa.array(rows[c], pa.int64()) for c in ("start", "length", "crc")),
                pa.array((np.arange(seen, seen + len(rows["row"])) & 0x7FFFFFFF).astype(np.int32)),
            ]
            seen += len(rows["row"])
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "nth"]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in rows["ids"]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack(
    documents: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Table (doc_id, piece, start, length, ids_crc32, sequence_id, offset), and ids if asked for; a row per piece."""
    spark = documents.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Scratch(spark) as s:
        schema = _PIECES + (", ids array<int>" if with_ids else "")
        pieces = s.table(docs.mapInArrow(_pieces(path, size, end_id, with_ids), schema))
        counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
        slots = spark.createDataFrame(
            plan(counts, size),
            "length_ long, rank_ long, pieces_ long, first_ long, offset_ long, per_ long",
        )
        salts = max(16, -(-sum(counts.values()) // RANKED))
        pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "nth"), F.lit(salts)))
        sizes = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
        before = F.sum("n").over(
            Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        sizes = sizes.select("length", "salt", (before - F.col("n")).alias("before"))
        order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32", "nth")
        ranked = (
            pieces.withColumn("number", F.row_number().over(order) - 1)
            .join(sizes, ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("number"))
        )
        here = (F.col("length") == F.col("length_")) & (F.col("rank") >= F.col("rank_"))
        placed = ranked.join(F.broadcast(slots), here & (F.col("rank") < F.col("rank_") + F.col("pieces_")))
        nth = F.col("rank") - F.col("rank_")
        out = placed.select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_") + F.floor(nth / F.col("per_"))).alias("sequence_id"),
            (F.col("offset_") + nth % F.col("per_") * F.col("length")).alias("offset"),
            *(["ids"] if with_ids else []),
        )
        return s.keep(out)
