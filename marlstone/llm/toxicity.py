"""Toxicity by FTRL-proximal logistic regression.

Features are which word unigrams, bigrams and skip-grams (two words with one between) a text holds, hashed to
2**BITS coordinates. Every coordinate has its own learning rate, and L1 keeps only those weights that pay; the
model is the list of those that are not zero, a few thousand numbers that every executor gets.

The model is fitted on a bounded sample of labelled rows: at most train_rows toxic ones and CLEAN_PER_TOXIC times
as many clean ones, those whose id hashes lowest. Clean rows stay the greater part, as they are in a corpus: a
model of as many toxic ones finds too much. Features are extracted in all tasks; one task, not the driver, holds
those of the sample and fits. Scoring reads every text whole.

Defined results: a null or empty text has no features and the score of the bias; labels that are neither 0 nor 1
are left out, an id with several labels counts as toxic from an even split on, an id with several texts teaches the
least of them; without labels of both classes the bias alone decides; equal hashes are ordered by id; an empty table
gives no rows; columns named like the results are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import bounded_batches

BITS = 20
_WORD = re.compile(r"\w+")
#: Odd multipliers that mix a word's hash by its place in a pair.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_KNOWN_WORDS = 200_000
CLEAN_PER_TOXIC = 4


class Features:
    """Coordinates of a text. Hashes of words met before are kept, up to a bound."""

    def __init__(self, bits: int = BITS):
        self.shift, self.seen = np.uint64(64 - bits), {}

    def all(self, text: str) -> np.ndarray:
        """With repeats, in no order."""
        seen = self.seen
        if len(seen) > _KNOWN_WORDS:
            seen.clear()
        words = _WORD.findall(text.lower())
        for w in words:
            if w not in seen:
                seen[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) + 1
        h = np.array([seen[w] for w in words], dtype=np.uint64)
        with np.errstate(over="ignore"):
            mixed = np.concatenate([h * _MIX[0], h[:-1] * _MIX[1] + h[1:] * _MIX[2], h[:-2] * _MIX[3] + h[2:] * _MIX[4]])
            mixed ^= mixed >> np.uint64(31)
            mixed *= _MIX[0]
        return (mixed >> self.shift).astype(np.int64)

    def distinct(self, text: str) -> np.ndarray:
        return np.unique(self.all(text))


@dataclass
class Model:
    bias: float
    index: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))
    bits: int = BITS

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, dtype=np.float32)
        out[self.index] = self.weight
        return out


def fit_ftrl(examples: list[tuple[np.ndarray, int]], bits: int = BITS, alpha: float = 2.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.0, epochs: int = 6) -> Model:
    """FTRL-proximal over the examples in their order, epochs times. The bias is a coordinate without L1."""
    if not examples:
        return Model(0.0, bits=bits)
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(i) -> np.ndarray:
        w = -(z[i] - np.clip(z[i], -l1, l1)) / ((beta + np.sqrt(n[i])) / alpha + l2)
        w[-1] = -z[size] / ((beta + np.sqrt(n[size])) / alpha + l2)  # the bias comes last
        return w

    for _ in range(epochs):
        for features, label in examples:
            i = np.append(features, np.int32(size))
            w = weights(i)
            p = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, w.sum()))))
            g = p - label
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / alpha * w
    kept = np.append(np.flatnonzero(np.abs(z[:size]) > l1), size)
    w = weights(kept)
    return Model(float(w[-1]), kept[:-1].astype(np.int32), w[:-1].astype(np.float32), bits)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches:
        rows = [features.distinct(t or "").astype("<i4").tobytes() for t in batch["text"].to_pylist()]
        with np.errstate(over="ignore"):
            # Another order than that of the choice, which ends with rows of the class of which more were chosen.
            place = (batch["ord"].to_numpy().view(np.uint64) * _MIX[2]).view(np.int64)
        yield pa.record_batch([pa.array(place), batch["ord"], batch["toxic"], pa.array(rows, pa.binary())], names=["place", "ord", "toxic", "features"])


def _fitted(most_features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, held = [], 0
        for batch in batches:
            for toxic, features in zip(batch["toxic"].to_pylist(), batch["features"]):
                features = np.frombuffer(features.as_buffer(), dtype="<i4")
                held += len(features)
                if held <= most_features or not examples:
                    examples.append((features, toxic))
        model = fit_ftrl(examples)
        yield pa.record_batch([pa.array([model.bias]), pa.array([model.index.astype("<i4").tobytes()], pa.binary()), pa.array([model.weight.astype("<f4").tobytes()], pa.binary())], names=["bias", "index", "weight"])

    return run


def fit(documents: DataFrame, labels: DataFrame, learnable: Column, train_rows: int = 2000, most_features: int = 1 << 24, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model of labelled documents. learnable: a condition on the labels' id column. train_rows: the
    documented bound of toxic rows; that of clean rows is CLEAN_PER_TOXIC times as high. most_features: that of
    their distinct features together, four bytes each; rows beyond it, in an order of their hashes, are left out."""
    bounded_batches(documents.sparkSession)
    known = (
        labels.where(learnable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.avg(label_col) >= 0.5).cast("int").alias("toxic"))
        .withColumn("ord", F.xxhash64("id"))
    )
    most = {0: CLEAN_PER_TOXIC * train_rows, 1: train_rows}
    some = [known.where(F.col("toxic") == c).orderBy("ord", "id").limit(n) for c, n in most.items()]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # of bounded rows
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id")
    texts = texts.groupBy("id", "toxic", "ord").agg(F.min("text").alias("text"))
    rows = texts.select("text", "toxic", "ord").mapInArrow(_extract, "place long, ord long, toxic int, features binary")
    # The sample, which is bounded, in one task.
    rows = rows.repartition(1).sortWithinPartitions("place", "ord", "toxic", "features")
    got = rows.mapInArrow(_fitted(most_features), "bias double, index binary, weight binary").collect()
    if not got:
        return Model(0.0)
    return Model(got[0]["bias"], np.frombuffer(got[0]["index"], dtype="<i4"), np.frombuffer(got[0]["weight"], dtype="<f4"))


def scorer(model: Model):
    """A function of texts' arrays that gives their scores."""

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense, features = model.dense(), Features(model.bits)
        for texts in batches:
            out = np.empty(len(texts))
            for i, t in enumerate(texts):
                at = features.all(t.as_py() or "")
                hit = np.unique(at[dense[at] != 0])
                out[i] = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, model.bias + float(dense[hit].sum())))))
            yield pa.array(out)

    return scores


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with score (0 to 1) and predicted (1 from 0.5 on)."""
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from scorer(shared.value)(batches)

    out = df.withColumn("score", toxicity(F.col(text_col)))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
