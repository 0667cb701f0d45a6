"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities and weights of lexicon hits, hits close to a second-person pronoun, rates of
capitals, shouted words, punctuation, digits, stretched letters, and obfuscation (symbols or digits inside words, and
hits that only show once those are undone). The lexicon holds words and word beginnings of 4 to 7 bytes, learnt by
their log-odds on the training rows after undoing obfuscation, so inflected forms that were never seen still match.

Training takes at most PER_CLASS labelled rows of each class (a documented bound); rows held out for testing are never
among them. A term enters the lexicon if LEAST_ROWS toxic rows of these have it and its log-odds are LEAST_ODDS at least;
the LEXICON terms with the greatest log-odds times root of that number stay, ties by hash. These bounds shape the model
only, no row is dropped by them. Labels, language, source and id are no inputs of a score. Scoring covers every text
whole, in Arrow batches; nothing is shuffled but the lexicon's counts on the sample. Isotonic regression is fitted on
predictions made across FOLDS folds, by lexicons and trees that have not seen the fold, and weighted back to the labels'
true rates; a fiftieth of the raw probability orders equal steps. Equal texts share a fold.

A null or empty text has all rates 0 and gets the score that these give. Without labels of both classes every score is
the rate of the class there is, or 0. One row comes out for each row that goes in, also for repeated rows and ids and null
ids, none for an empty table. Equal scores stay equal. Memory follows a group of texts of some megabytes, or one longer
text. Columns other than doc_id and text are neither read nor in the way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .boosting import Boosted, Isotonic, boost, isotonic
from .labelled import held_out, training_rows
from .names import fresh
from .scratch import Scratch

PER_CLASS, LEXICON, LEAST_ROWS, LEAST_ODDS, FOLDS, THRESHOLD = 5000, 4096, 3, 2, 4, 0.7
PREFIXES = (4, 5, 6, 7)
NEAR = 6
#: Second-person pronouns in the corpus's languages.
YOU = "you your yours yourself u ur du dich dir dein deine deiner sie ihr euch tu te toi ton ta tes vous votre tú ti usted ustedes vos"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER, _DIGIT, _SYMBOL = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_UPPER[65:91] = _DIGIT[48:58] = True
_SYMBOL[33:127] = True
_SYMBOL &= ~(_LETTER | _DIGIT)
#: Characters that stand for letters in disguised words.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
for _a, _b in zip("0134578@$", "oieastbas"):
    _PLAIN[ord(_a)] = ord(_b)
_STAYS = wh._IS_WORD & ~(_SYMBOL | _DIGIT)
_STAYS[[ord(c) for c in "0134578@$"]] = True
_TAG = np.array([0, *(k + 1 for k in range(len(PREFIXES)))], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_N_FEATURES = 17


def undisguised(g: wh.Group) -> tuple[wh.Group, np.ndarray]:
    """The group with letters put back and symbols taken out of words, and which of g's words each word was."""
    stays = _STAYS[g.data] | ~wh._IS_WORD[g.data]
    place = np.concatenate([[0], np.cumsum(stays)])
    out = wh.split(_PLAIN[g.data[stays]], place[g.offsets])
    had = place[g.end] > place[g.start]
    return out, np.flatnonzero(had)


def terms(g: wh.Group) -> np.ndarray:
    """Hashes of each word of an undisguised group and of its beginnings (0 where it is too short): words x terms."""
    n = len(g.data)
    up, down = wh._BYTES.upto(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(wh._TABLE[g.data] * up[:n], out=total[1:])
    base, out = down[g.start], np.zeros((len(g.start), 1 + len(PREFIXES)), dtype=np.uint64)
    out[:, 0] = wh.mix((total[g.end] - total[g.start]) * base + _TAG[0])
    for k, size in enumerate(PREFIXES):
        long_enough = g.end - g.start >= size
        to = np.minimum(g.start + size, n)
        out[:, k + 1] = np.where(long_enough, wh.mix((total[to] - total[g.start]) * base + _TAG[k + 1]), 0)
    return out


def word_terms(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return terms(wh.split(data, np.array([0, len(data)])))[:, 0]


class Lexicon:
    """Weights by term hash. A bit table of 2**20 low bits answers for nearly all words that are not in it."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.weights = hashes[order], weights[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def of(self, found: np.ndarray) -> np.ndarray:
        """The greatest weight of each row's terms, or 0."""
        out = np.zeros(found.shape, dtype=np.float64)
        at = np.nonzero(self.maybe[(found & np.uint64(0xFFFFF)).astype(np.int64)])
        if len(at[0]) and len(self.hashes):
            h = found[at]
            k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out[at] = np.where(self.hashes[k] == h, self.weights[k], 0)
        return out.max(axis=1) if len(out) else np.zeros(0)


_YOU = np.sort(word_terms(YOU.split()))


def features(g: wh.Group, lexicon: Lexicon) -> np.ndarray:
    docs = g.last - g.first
    out = np.zeros((docs, _N_FEATURES))
    size = np.maximum(np.diff(g.offsets), 1)
    n_words = np.maximum(g.counts(), 1)
    if not len(g.data):
        return out
    byte_sum = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[g.offsets])
    upper, letters = byte_sum(_UPPER[g.data]), np.maximum(byte_sum(_LETTER[g.data]), 1)
    same = np.zeros(len(g.data), dtype=bool)
    same[2:] = (g.data[2:] == g.data[1:-1]) & (g.data[1:-1] == g.data[:-2]) & _LETTER[g.data[2:]]
    run = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    total = run(_UPPER[g.data])
    length = g.end - g.start
    shouted = (total[g.end] - total[g.start] >= 0.8 * length) & (length > 2)
    total = run(~_LETTER[g.data])
    inner = np.maximum(g.end - 1, g.start + 1)
    disguised = (total[inner] - total[np.minimum(g.start + 1, inner)] > 0) & (length > 2) & _LETTER[g.data[g.start]]
    doc = np.repeat(np.arange(docs), g.counts())
    per_doc = lambda mask: np.bincount(doc, mask, docs)

    plain, was = undisguised(g)
    found = terms(plain)
    weight = np.zeros(len(g.start))
    weight[was] = lexicon.of(found)
    you = np.zeros(len(g.start), dtype=bool)
    if len(found):
        k = np.minimum(np.searchsorted(_YOU, found[:, 0]), len(_YOU) - 1)
        you[was] = _YOU[k] == found[:, 0]
    hit = weight > 0
    seen = run(you)
    index = np.arange(len(g.start))
    low = np.maximum(index - NEAR, g.word_of[doc])
    high = np.minimum(index + NEAR + 1, g.word_of[doc + 1])
    near = hit & (seen[high] > seen[low])
    hits = per_doc(hit)
    out[:, 0] = np.log1p(g.counts())
    out[:, 1] = per_doc(weight) / n_words
    np.maximum.at(out[:, 2], doc, weight)
    out[:, 3] = np.log1p(hits)
    out[:, 4] = hits / n_words
    out[:, 5] = per_doc(near) / n_words
    out[:, 6] = per_doc(you) / n_words
    out[:, 7] = upper / letters
    out[:, 8] = per_doc(shouted) / n_words
    out[:, 9] = byte_sum(g.data == 33) / size
    out[:, 10] = byte_sum(g.data == 63) / size
    out[:, 11] = byte_sum(_SYMBOL[g.data]) / size
    out[:, 12] = byte_sum(_DIGIT[g.data]) / size
    out[:, 13] = per_doc(disguised) / n_words
    out[:, 14] = per_doc(hit & disguised) / n_words
    out[:, 15] = byte_sum(same) / size
    out[:, 16] = letters / n_words
    return out


def _sample_terms(batches):
    """(text, y, fold) → (term, y, fold) of each row's distinct terms."""
    for batch in batches:
        y, fold = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for g in wh.groups(batch.column(0)):
            plain, _ = undisguised(g)
            found = terms(plain)
            for k in range(g.last - g.first):
                mine = np.unique(found[plain.word_of[k] : plain.word_of[k + 1]])
                mine = mine[mine != 0].view(np.int64)
                same = (np.full(len(mine), v[g.first + k], dtype=np.int32) for v in (y, fold))
                yield pa.RecordBatch.from_arrays([pa.array(mine), *map(pa.array, same)], ["term", "y", "fold"])


def _sample_features(lexicons: list[Lexicon]):
    """(text, y, fold) → (x, y, fold), x holding the features by each lexicon, one after the other."""

    def run(batches):
        for batch in batches:
            for g in wh.groups(batch.column(0)):
                x = np.concatenate([features(g, lexicon) for lexicon in lexicons], axis=1)
                rest = (batch.column(k).slice(g.first, g.last - g.first) for k in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), *rest], ["x", "y", "fold"])

    return run


@dataclass
class Model:
    lexicon: Lexicon
    trees: Boosted | None
    steps: Isotonic | None
    rate: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.rate)
        margin = self.trees.margin(x)
        return np.clip(0.98 * self.steps(margin) + 0.02 / (1 + np.exp(-margin)), 0, 1)


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, per_class: int = PER_CLASS) -> Model:
    with Scratch(documents.sparkSession) as s:
        sample, counts = training_rows(documents, labels, "toxic", modulus, remainder, per_class)
        fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit(5)), F.lit(FOLDS)).cast("int")
        sample = s.table(sample.select("text", "y", fold.alias("fold")))
        rows = sample.groupBy("fold", "y").count().collect()
        have = np.zeros((FOLDS, 2), dtype=np.int64)
        for r in rows:
            have[r["fold"], r["y"]] = r["count"]
        n0, n1 = have.sum(axis=0).tolist()
        if not (n0 and n1):
            return Model(Lexicon(np.zeros(0, np.uint64), np.zeros(0)), None, None, 1.0 if n1 else 0.0)
        seen = sample.mapInArrow(_sample_terms, "term long, y int, fold int")
        seen = s.table(seen.groupBy("term").agg(*(F.count_if((F.col("y") == y) & (F.col("fold") == k)).alias(f"{x}{k}") for k in range(FOLDS) for y, x in enumerate("ft"))))
        lexicons = []
        for left_out in (None, *range(FOLDS)):
            t, f = (sum(F.col(f"{x}{k}") for k in range(FOLDS) if k != left_out) for x in "tf")
            m0, m1 = have[[k for k in range(FOLDS) if k != left_out]].sum(axis=0).tolist()
            found = seen.select("term", t.alias("t"), f.alias("f")).where(F.col("t") >= LEAST_ROWS)
            found = found.withColumn("w", F.log((F.col("t") + 0.5) / (m1 + 1)) - F.log((F.col("f") + 0.5) / (m0 + 1)))
            top = found.where(F.col("w") >= LEAST_ODDS).orderBy(F.desc(F.col("w") * F.sqrt("t")), "term").limit(LEXICON).select("term", "w").collect()
            lexicons.append(Lexicon(np.array([r["term"] for r in top], dtype=np.int64).view(np.uint64), np.array([r["w"] for r in top])))
        rows = sample.mapInArrow(_sample_features(lexicons), "x array<double>, y int, fold int").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, len(lexicons), _N_FEATURES)
    y, fold = rows.column("y").to_numpy().astype(float), rows.column("fold").to_numpy()
    order = np.lexsort(np.column_stack([x[:, 0], y]).T)  # the same model whatever order the rows came in
    x, y, fold = x[order], y[order], fold[order]
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        if (fold == k).any() and len(np.unique(y[fold != k])) == 2:
            margin[fold == k] = boost(x[fold != k, 1 + k], y[fold != k], trees=30).margin(x[fold == k, 1 + k])
    weight = np.where(y == 1, counts[1] / n1, counts[0] / n0)
    return Model(lexicons[0], boost(x[:, 0], y), isotonic(margin, y, weight), y.mean())


def _score(model: Model, threshold: float, new: tuple[str, str] = ("score", "predicted")):
    def run(batches):
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            score = [model.score(features(g, model.lexicon)) for g in wh.groups(text)]
            score = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                [*batch.schema.names[:-1], *new],
            )

    return run


def score_toxicity(
    documents: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, threshold: float = THRESHOLD
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


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns as they are, without those whose score reaches the threshold."""
    model = fit(documents, labels)
    names = documents.columns
    text, score, predicted = fresh(names, "text", "score", "predicted")
    rows = documents.select("*", F.col("text").cast("string").alias(text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    scored = rows.mapInArrow(_score(model, threshold, (score, predicted)), f"{schema}, {score} double, {predicted} int")
    return scored.where(F.col(predicted) == 0).select(*(f"`{c}`" for c in names))
