"""Quality by a similarity-weighted vote of the nearest labelled documents in a latent-semantic space.

A document's terms are hashed: trigrams of its bytes, and the shapes of its words (case, length, closing symbols,
digits, equality with the words before). Term frequencies are taken as square roots of shares, so texts of any length
compare, and weighted by inverse document frequencies that one pass counts over all documents. The singular vectors of
the labelled sample span the space. The sample's vectors, at most 2 x PER_CLASS x RANK floats, are broadcast; every
document's cosines with all of them are computed exactly, in blocks of matrix products, and the labels of its
NEIGHBOURS nearest vote with weights that grow with the cosine and restore the labels' true rates.

Training takes at most PER_CLASS labelled rows of each class (a documented bound), none of them held out. Labels,
language, source and id are no inputs of a score. Texts are read whole; nothing of the corpus is shuffled but one
frequency vector for each partition. A null or empty text has a zero vector and gets the labels' base rate; so has
every text when labels of both classes are missing. One row comes out for each row that goes in, also for repeated rows
and ids and null ids, none for an empty table. Equal cosines at the last of the nearest places are settled by the sample's
order, which depends on its texts only. Memory follows GROUP bytes and GROUP_ROWS documents, or one longer text. Columns
other than doc_id and text are neither read nor in the way.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .labelled import held_out, training_rows
from .scratch import Scratch

PER_CLASS, RANK, NEIGHBOURS, THRESHOLD, POWER = 2000, 48, 15, 0.7, 8
TRIGRAMS, SHAPES = 3072, 1024
TERMS = TRIGRAMS + SHAPES
GROUP, GROUP_ROWS = 1 << 20, 512  # bytes and documents whose vectors are held at once

_RANDOM = np.random.Generator(np.random.PCG64(99)).integers(1, 1 << 32, (3, 256), dtype=np.uint32)
_KIND = np.zeros(256, dtype=np.int64)  # 0 other, 1 small letter, 2 capital, 3 digit, 4 stop, 5 symbol
_KIND[97:123] = _KIND[128:] = 1
_KIND[65:91], _KIND[48:58] = 2, 3
_KIND[[ord(c) for c in ".,;:!?"]] = 4
_KIND[[c for c in range(33, 127) if _KIND[c] == 0]] = 5


def shares(g: wh.Group) -> np.ndarray:
    """Square roots of each term's share among the document's trigrams, or words' shapes: documents x TERMS."""
    docs = g.last - g.first
    out = np.zeros((docs, TERMS), dtype=np.float32)
    d = g.data
    if len(d) > 2:
        code = _RANDOM[0][d[:-2]] + _RANDOM[1][d[1:-1]] * np.uint32(3) + _RANDOM[2][d[2:]] * np.uint32(5)
        code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(8)
        code = (code % np.uint32(TRIGRAMS)).astype(np.int64)
        doc = np.repeat(np.arange(docs, dtype=np.int64), np.diff(g.offsets))[:-2]
        ends = g.offsets[1:][doc]
        inside = np.arange(len(code)) + 3 <= ends
        n = np.bincount((doc * TRIGRAMS + code)[inside], minlength=docs * TRIGRAMS).reshape(docs, TRIGRAMS)
        out[:, :TRIGRAMS] = np.sqrt(n / np.maximum(n.sum(axis=1, keepdims=True), 1))
    if len(g.start):
        h = g.hashes()
        doc = np.repeat(np.arange(docs), g.counts())
        like = [np.zeros(len(h), dtype=np.int64) for _ in range(2)]
        for back in (1, 2):
            like[back - 1][back:] = (h[back:] == h[:-back]) & (doc[back:] == doc[:-back])
        first, last, size = _KIND[d[g.start]], _KIND[d[g.end - 1]], g.end - g.start
        before = _KIND[d[np.maximum(g.end - 2, g.start)]]
        length = np.minimum(np.log2(size).astype(np.int64), 3)
        code = (((((length * 6 + first) * 6 + last) * 6 + before) * 2 + like[0]) * 2 + like[1]) % SHAPES
        n = np.bincount(doc * SHAPES + code, minlength=docs * SHAPES).reshape(docs, SHAPES)
        out[:, TRIGRAMS:] = np.sqrt(n / np.maximum(n.sum(axis=1, keepdims=True), 1))
    return out


def _frequencies(batches):
    total, n = np.zeros(TERMS, dtype=np.int64), 0
    for batch in batches:
        for g in wh.groups(batch.column(0), GROUP, GROUP_ROWS):
            total += (shares(g) > 0).sum(axis=0)
            n += g.last - g.first
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, TERMS, dtype=np.int32)), pa.array(np.concatenate([[n], total]))], ["term", "n"]
        )


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """ln((1 + N) / (1 + df)) + 1 of every term, counted over all rows; TERMS numbers come to the driver."""
    rows = texts.select("text").mapInArrow(_frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    n = np.zeros(TERMS + 1)
    for r in rows.collect():
        n[r["term"] + 1] = r["n"]
    return (np.log((1 + n[0]) / (1 + n[1:])) + 1).astype(np.float32)


def _project(idf: np.ndarray, mean: np.ndarray | None = None, axes: np.ndarray | None = None):
    """Texts' vectors; `empty` rows are zero."""

    def of(g: wh.Group) -> np.ndarray:
        x = shares(g) * idf
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        x /= np.maximum(norm, 1e-12)
        if axes is None:
            return x
        z = (x - mean) @ axes
        z *= norm > 0
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    return of


def _sample_vectors(idf: np.ndarray):
    project = _project(idf)

    def run(batches):
        for batch in batches:
            for g in wh.groups(batch.column(0), GROUP, GROUP_ROWS):
                x = project(g).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in x], pa.binary()), batch.column(1).slice(g.first, g.last - g.first)],
                    ["x", "y"],
                )

    return run


@dataclass
class Neighbours:
    idf: np.ndarray
    mean: np.ndarray | None
    axes: np.ndarray | None
    vectors: np.ndarray | None  # labelled rows x RANK, of length 1
    y: np.ndarray | None
    weight: np.ndarray | None
    rate: float

    def score(self, z: np.ndarray) -> np.ndarray:
        if self.vectors is None:
            return np.full(len(z), self.rate)
        cosine = z @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        vote = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** POWER * self.weight[near]
        total = vote.sum(axis=1)
        out = (vote * self.y[near]).sum(axis=1) + 1e-9 * self.rate
        return out / (total + 1e-9)


def singular_axes(x: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration: no matrix of rows by rows is ever formed."""
    q = np.random.Generator(np.random.PCG64(5)).standard_normal((x.shape[1], rank + 16)).astype(np.float32)
    for _ in range(8):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, values, v = np.linalg.svd(x @ q, full_matrices=False)
    keep = values[:rank] > 1e-3 * values[0]
    return q @ v[:rank][keep].T


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, per_class: int = PER_CLASS) -> Neighbours:
    idf = inverse_frequencies(documents.select(F.col("text").cast("string").alias("text")))
    with Scratch(documents.sparkSession) as s:
        sample, counts = training_rows(documents, labels, "quality", modulus, remainder, per_class)
        rate = counts.get(1, 0) / max(1, sum(counts.values()))
        sample = s.table(sample.select("text", "y"))
        rows = sample.mapInArrow(_sample_vectors(idf), "x binary, y int").toArrow()
    y = rows.column("y").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return Neighbours(idf, None, None, None, None, None, rate)
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), dtype=np.float16).reshape(len(y), TERMS)
    del rows
    key = [int.from_bytes(hashlib.blake2b(x[k].tobytes(), digest_size=8).digest()) for k in range(len(y))]
    order = np.lexsort((y, np.array(key, dtype=np.uint64)))  # the same space whatever order the rows came in
    x, y = x[order].astype(np.float32), y[order]
    mean = x.mean(axis=0)
    x -= mean
    axes = singular_axes(x, min(RANK, len(y) - 1))
    z = x @ axes
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    n = np.bincount(y.astype(int), minlength=2)
    weight = np.where(y == 1, counts[1] / n[1], counts[0] / n[0])
    return Neighbours(idf, mean, axes.astype(np.float32), z.astype(np.float32), y, weight / weight.max(), rate)


def _score(model: Neighbours, threshold: float):
    project = _project(model.idf, model.mean, model.axes)

    def run(batches):
        for batch in batches:
            score = []
            for g in wh.groups(batch.column(batch.num_columns - 1), GROUP, GROUP_ROWS):
                z = project(g) if model.axes is not None else np.zeros((g.last - g.first, 1))
                score.extend(model.score(z[k : k + 256]) for k in range(0, len(z), 256))
            score = np.clip(np.concatenate(score) if score else np.zeros(0), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                [*batch.schema.names[:-1], "score", "predicted"],
            )

    return run


def score_quality(
    documents: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, threshold: float = THRESHOLD
) -> DataFrame:
    """Table (doc_id, held_out, score, predicted), one row per input row."""
    model = fit(documents, labels, modulus, remainder)
    rows = documents.select(
        F.col("doc_id"),
        held_out(F.col("doc_id"), modulus, remainder).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_score(model, threshold), f"doc_id {kind}, held_out boolean, score double, predicted int")
