"""Passages that an earlier document already has: winnowed seeds, extended to maximal repeats.

Words are runs of bytes other than space and 0x09-0x0D. A window is `window` consecutive words of one document; it is
repeated where the same words also start in a document with a smaller doc_id. Every window has one seed: of the 14-word
grams inside it, the one with the least hash, the leftmost of equals. Equal windows have equal seeds at equal places, so
documents need only meet on seeds, about one for 19 words. Plan:

1. One pass gives each run of windows with one seed as a row (seed, hash of the run's words, place, length).
2. Seeds that only one document has go: a grouped minimum and maximum.
3. A run that an earlier document has whole is a repeat: the seed extends both ways over the whole run.
4. Seeds with different runs are extended window by window, once for each different run and not for each document:
   the earliest document's windows are hashed and meet on the hash; those that an earlier document has are repeats.
5. A document's repeats are merged into maximal ones and cut out.

No pairs of documents are formed, so a passage that a third of all documents share costs a row for each of its runs.
Rows of hot seeds, runs and hashes are not shuffled to one task (see skew).
Texts are read whole; comparisons are by 64-bit hashes of seed and run.

Nulls: a null text has no words; a row with a null doc_id keeps all its words and does not count as earlier. Windows
within one document, also within rows that repeat its doc_id, do not count. Texts of any length are read whole. Of equal
passages the smallest doc_id's stays, whatever else ties. Empty tables give empty results. Other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .names import fresh
from .scratch import Scratch
from .skew import join_hot

WINDOW, GRAM = 50, 14
_LOW = np.uint64((1 << 24) - 1)
_SHIFT = np.uint64(0xA24BAED4963EE407)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def seed_runs(g: wh.Group, window: int, gram: int):
    """(document in g, seed, run hash, first window, windows) for each maximal run of windows with one seed."""
    hashes = g.hashes()
    n = len(hashes)
    if n < window:
        return None
    grams, _ = g.windows(hashes, gram)
    at = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min((grams & ~_LOW) | (at & _LOW), window - gram + 1)
    at = at[: len(least)]
    place = (at + ((least - at) & _LOW)).astype(np.int64)
    last_of = np.repeat(g.word_of[1:], g.counts())[: len(least)]
    ok = np.flatnonzero(np.arange(len(least)) + window <= last_of)
    if not len(ok):
        return None
    new = np.ones(len(ok), dtype=bool)
    new[1:] = (place[ok[1:]] != place[ok[:-1]]) | (ok[1:] != ok[:-1] + 1)
    cuts = np.flatnonzero(new)
    first, size = ok[cuts], np.diff(np.append(cuts, len(ok)))
    p = place[first]
    run = wh.mix(wh.span_hash(hashes, first, first + size + window - 1) + (p - first).astype(np.uint64) * _SHIFT)
    doc = np.searchsorted(g.word_of, first, side="right") - 1
    return doc, grams[p], run, first - g.word_of[doc], size


def _seeds(window: int, gram: int):
    def run(batches):
        for batch in batches:
            for g in wh.groups(batch.column(2)):
                found = seed_runs(g, window, gram)
                if found is not None:
                    doc, seed, run_hash, first, size = found
                    rows = pa.array(doc + g.first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                            pa.array(seed.view(np.int64)),
                            pa.array(run_hash.view(np.int64)),
                            pa.array(first.astype(np.int32)),
                            pa.array(size.astype(np.int32)),
                        ],
                        ["doc_id", "key", "seed", "run", "first", "size"],
                    )

    return run


def _extend(window: int):
    """Rows (doc_id, key, text, spans) → a row for each window of the spans: (doc_id, key, hash, first)."""

    def run(batches):
        for batch in batches:
            spans = batch.column(3)
            for g in wh.groups(batch.column(2)):
                windows, _ = g.windows(g.hashes(), window)
                for k in range(g.last - g.first):
                    mine = spans[g.first + k].values
                    first, size = (mine.field(f).to_numpy().astype(np.int64) for f in ("first", "size"))
                    local = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                    at = local + g.word_of[k]
                    fits = (at < len(windows)) & (local + window <= g.word_of[k + 1] - g.word_of[k])
                    at, local = at[fits], local[fits]
                    row = pa.array(np.full(len(at), g.first + k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(row),
                            batch.column(1).take(row),
                            pa.array(windows[at].view(np.int64)),
                            pa.array(local.astype(np.int32)),
                        ],
                        ["doc_id", "key", "hash", "first"],
                    )

    return run


def covered(spans: pa.StructArray | None, words: int, window: int) -> np.ndarray:
    """Which words lie in a window of the spans (first, size)."""
    edge = np.zeros(words + 1, dtype=np.int32)
    if spans is not None and len(spans):
        first, size = (spans.field(f).to_numpy().astype(np.int64) for f in ("first", "size"))
        np.add.at(edge, first, 1)
        np.add.at(edge, np.minimum(first + size + window - 1, words), -1)
    return np.cumsum(edge[:words]) > 0


def _cut(window: int, text: str, span: str):
    """The columns text and span → kept_text, n_words, n_removed; the other columns pass through."""

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts, spans = batch.column(names.index(text)), batch.column(names.index(span))
            kept, n, gone = [], [], []
            for k in range(batch.num_rows):
                words = (texts[k].as_py() or "").encode().split()
                n.append(len(words))
                if spans[k].is_valid:
                    cut = covered(spans[k].values, len(words), window)
                    gone.append(int(cut.sum()))
                    words = [words[i] for i in np.flatnonzero(~cut).tolist()]
                else:
                    gone.append(0)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i, x in enumerate(names) if x not in (text, span)), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())],
                [*(x for x in names if x not in (text, span)), "kept_text", "n_words", "n_removed"],
            )

    return run


def repeated_spans(s: Scratch, docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """docs (doc_id, key, text) → (doc_id, key, spans): runs (first window, number of windows) of repeated windows."""
    seeds = s.table(
        docs.where("doc_id is not null and text is not null").mapInArrow(
            _seeds(window, gram), "doc_id long, key long, seed long, run long, first int, size int"
        )
    )
    rows = F.count("*").alias("n__")
    least, most = F.min("doc_id").alias("x"), F.max("doc_id").alias("y")
    shared = seeds.groupBy("seed").agg(least, most, rows).where("x < y").select("seed", "n__")
    met = s.table(join_hot(s, seeds, shared, ["seed"]))
    s.drop(seeds)
    runs = s.table(met.groupBy("seed", "run").agg(F.min("doc_id").alias("earliest"), F.count("*").alias("n")))
    several = runs.groupBy("seed").agg(F.min("earliest").alias("x"), F.max("earliest").alias("y"), rows)
    runs = join_hot(s, runs, several.select("seed", (F.col("x") < F.col("y")).alias("differs"), "n__"), ["seed"])
    met = join_hot(s, met, runs.withColumnRenamed("n", "n__"), ["seed", "run"])
    met = s.table(met.select("doc_id", "key", "earliest", "differs", "first", "size"))
    span = F.struct("first", "size")
    whole = met.where("doc_id > earliest").select("doc_id", "key", span.alias("span"))

    heads = met.where("differs and doc_id = earliest").groupBy("doc_id", "key").agg(F.collect_list(span).alias("spans"))
    heads = docs.join(heads, ["doc_id", "key"]).select("doc_id", "key", "text", "spans")
    windows = s.table(heads.mapInArrow(_extend(window), "doc_id long, key long, hash long, first int"))
    earliest = windows.groupBy("hash").agg(least, most, rows).where("x < y").select("hash", "x", "n__")
    parts = join_hot(s, windows, earliest, ["hash"]).where("doc_id > x")
    parts = parts.select("doc_id", "key", F.struct("first", F.lit(1).alias("size")).alias("span"))
    return s.table(whole.union(parts).groupBy("doc_id", "key").agg(F.collect_set("span").alias("spans")))


def remove_repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents' columns plus kept_text (kept words joined by one space), n_words and n_removed, row for row.

    Columns of the input with one of the three new names are replaced.
    """
    if not 1 <= gram <= window:
        raise ValueError("a seed must fit into a window")
    new = ("kept_text", "n_words", "n_removed")
    own = [c for c in documents.columns if c not in new]
    text, key, span, id_ = fresh(documents.columns, "text", "key", "spans", "id")
    rows = documents.select(
        *(documents[f"`{c}`"] for c in own),
        F.col("text").cast("string").alias(text),
        F.xxhash64(F.col("text").cast("string")).alias(key),
    )
    with Scratch(documents.sparkSession) as s:
        docs = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(key).alias("key"), F.col(text).alias("text"))
        spans = repeated_spans(s, docs, window, gram)
        spans = s.keep(spans.select(F.col("doc_id").alias(id_), F.col("key").alias(f"{key}_"), F.col("spans").alias(span)))
    joined = rows.join(spans, (rows["doc_id"].cast("long") == spans[id_]) & (rows[key] == spans[f"{key}_"]), "left")
    joined = joined.drop(id_, key, f"{key}_")
    out = [f for f in joined.schema.fields if f.name not in (text, span)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in out), "kept_text string, n_words long, n_removed long"])
    return joined.mapInArrow(_cut(window, text, span), schema)
