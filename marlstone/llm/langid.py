"""Language identification by nearest centroids.

A text is the vector of its letter bigrams and trigrams (lower case, runs of anything else one space), hashed
to DIMS coordinates, weighed by inverse document frequency and normalised. Every language has several centroids
from spherical k-means over its sample; a text gets the language of the centroid with the highest cosine. It is
rejected if that cosine lies under the language's floor, a share of the lowest cosines its own sample has; for
short texts, whose cosines are low by nature, the floor sinks with the root of their n-grams.

The model is fitted on a bounded sample: at most train_rows texts of each language, those whose ids hash lowest.
Document frequencies are summed and centroids fitted in tasks, one language in each at a time; the driver gets
DIMS counts and the centroids. Prediction reads every text whole.

Defined results: a text that is null or has no letter is `und`, score 0, rejected; so is every text if no
language could be learned; rows without a language teach nothing; rows that repeat id and language teach once, the
least of their texts; of languages whose centroids are equally near the first by name is taken; an empty table gives
no rows; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import bounded_batches, fresh, save

DIMS = 8192
#: Texts of a language that are learned from, however many languages there are.
LEAST_ROWS = 8
#: Languages up to which the tables of them and of their chosen texts are broadcast.
BROADCAST_LANGUAGES = 10_000
UNDETERMINED = "und"
#: Distinct n-grams at which a text's floor is 0.7 of the language's.
FEW = 200
_PIECE = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Of every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def counts(text: str) -> np.ndarray | None:
    """How often each hashed bigram and trigram occurs; None without letters. A long text is counted in
    pieces that overlap by two."""
    total, seen = np.zeros(DIMS), False
    low = text.lower()
    for at in range(0, max(1, len(low)), _PIECE):
        codes = np.frombuffer(low[max(0, at - 2) : at + _PIECE].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letter = _letters()[codes]
        seen |= bool(letter.any())
        codes = np.where(letter, codes, 32)
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = letter[1:] | letter[:-1]  # a run of others is one space
        codes = codes[keep].astype(np.uint32)
        if at == 0:
            codes = np.concatenate([np.array([32], dtype=np.uint32), codes])
        two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x27D4EB2F)
        first = 1 if at else 0  # pairs that the last piece has counted
        for h in (two[first:], three):
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            total += np.bincount(h >> np.uint32(19), minlength=DIMS)
    return total if seen else None


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(norm > 0, norm, 1).astype(x.dtype)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # DIMS x centroids
    idf: np.ndarray
    floors: np.ndarray  # of each centroid's language

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        c = counts(text) if text else None
        if c is None or not self.languages:
            return UNDETERMINED, 0.0, True
        near = _unit(c * self.idf).astype(np.float32) @ self.centroids
        best = int(near.argmax())
        cosine = float(min(1.0, max(0.0, near[best])))
        n = np.count_nonzero(c)
        return self.languages[best], cosine, cosine < self.floors[best] * (n / (n + FEW)) ** 0.5


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k unit centroids of the unit rows. Starts from rows that are far from those before; no randomness."""
    start = [int((x @ x.mean(axis=0)).argmax())]
    while len(start) < min(k, len(x)):
        start.append(int((x @ x[start].T).max(axis=1).argmin()))
    c = x[start]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([_unit(x[own == i].sum(axis=0)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


def inverse_frequency(df: np.ndarray, texts: int) -> np.ndarray:
    return np.log((1 + texts) / (1 + df)) + 1


def fit_language(x: np.ndarray, idf: np.ndarray, k: int = 4, lowest: float = 0.01, slack: float = 0.6) -> tuple[np.ndarray, float]:
    """(centroids, floor) of a language from its texts' counts, float32, which are changed. The floor is slack times
    the lowest share's quantile of the cosines."""
    x *= idf.astype(np.float32)
    for i in range(len(x)):
        x[i] = _unit(x[i])
    c = spherical_kmeans(x, k)
    return c, slack * float(np.quantile((x @ c.T).max(axis=1), lowest))


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each coordinate occurs."""
    df = np.zeros(DIMS, dtype=np.int64)
    for batch in batches:
        for at in batch["at"].to_pylist():
            df[np.frombuffer(at, dtype="<u2")] += 1
    dims = np.flatnonzero(df)
    yield pa.record_batch([pa.array(dims.astype(np.int32)), pa.array(df[dims])], names=["dim", "n"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for lang, ord_, text in zip(batch["lang"].to_pylist(), batch["ord"].to_pylist(), batch["text"].to_pylist()):
            if (c := counts(text or "")) is not None:
                at = np.flatnonzero(c)
                out.append((lang, ord_, at.astype("<u2").tobytes(), c[at].astype("<f4").tobytes()))
        if out:
            yield pa.record_batch([pa.array(v) for v in zip(*out)], names=["lang", "ord", "at", "n"])


def fit(documents: DataFrame, learnable: Column, train_rows: int = 500, most_rows: int = 200_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """learnable: a condition on documents. train_rows: the documented bound of texts per language. Every language
    is learned; where there are so many that they would make more than most_rows together, each has its share of
    these, but not less than LEAST_ROWS. A task holds DIMS floats a row of one language, the driver and the model
    several times as many a language."""
    spark = documents.sparkSession
    bounded_batches(spark)
    rows = documents.where(learnable & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("ord"), F.col(id_col).alias("id"))
    kept = save(rows.groupBy("lang").count(), "languages")
    languages = kept.count()
    train_rows = min(train_rows, max(LEAST_ROWS, most_rows // max(1, languages)))
    small = (lambda t: F.broadcast(t)) if languages <= BROADCAST_LANGUAGES else (lambda t: t)
    # The lowest hashes of each language. A bound of the hash, from the language's count, lets through little more
    # than are wanted, so that a frequent language does not meet in one task.
    share = (F.lit(1.5 * train_rows + 100) / F.col("count") - 0.5) * float(2**64)
    low = rows.join(small(kept), "lang").where((F.col("count") <= 2 * train_rows) | (F.col("ord") < share)).select("id", "lang", "ord").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("ord", "id"))
    chosen = low.withColumn("r", place).where(F.col("r") <= train_rows).select("id", "lang", "ord")
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    texts = texts.join(small(chosen), ["id", "lang"]).groupBy("id", "lang", "ord").agg(F.min("text").alias("text"))
    sample = save(texts.select("lang", "ord", "text").mapInArrow(_extract, "lang string, ord long, at binary, n binary"), "language-sample")
    df, texts = np.zeros(DIMS), sample.count()
    for r in sample.select("at").mapInArrow(_present, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect():  # DIMS rows
        df[r["dim"]] = r["n"]
    idf = inverse_frequency(df, texts)

    def one(table: pa.Table) -> pa.Table:
        order = np.argsort(table["ord"].to_numpy(), kind="stable")
        x = np.zeros((len(order), DIMS), dtype=np.float32)
        for r, i in enumerate(order.tolist()):
            x[r, np.frombuffer(table["at"][i].as_buffer(), dtype="<u2")] = np.frombuffer(table["n"][i].as_buffer(), dtype="<f4")
        c, floor = fit_language(x, idf)
        return pa.table({"lang": [table["lang"][0].as_py()], "k": pa.array([len(c)], pa.int32()), "centroids": pa.array([c.astype("<f4").tobytes()], pa.binary()), "floor": [floor]})

    got = sample.groupBy("lang").applyInArrow(one, "lang string, k int, centroids binary, floor double").collect()
    got.sort(key=lambda r: r["lang"])
    matrix = np.concatenate([np.frombuffer(r["centroids"], dtype="<f4").reshape(r["k"], DIMS) for r in got]).T if got else np.zeros((DIMS, 0))
    each = lambda f: [f(r) for r in got for _ in range(r["k"])]
    return Model(each(lambda r: r["lang"]), np.ascontiguousarray(matrix, dtype=np.float32), idf, np.array(each(lambda r: r["floor"])))


def identify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with lang_pred, score (the cosine) and rejected."""
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            got = [m.predict(t.as_py()) for t in texts]
            yield pa.array([dict(zip(("lang_pred", "score", "rejected"), g)) for g in got], kind)

    name, = fresh(df, "mt_language")
    found = df.withColumn(name, language(F.col(text_col)))
    return found.withColumns({c: F.col(name)[c] for c in ("lang_pred", "score", "rejected")}).drop(name)
