"""Operator 9: quality scores by votes of the nearest labelled texts in a latent-semantic space.

Terms of a text are its byte trigrams, hashed to a fixed number of places, and one more that
counts words which repeat the word before them. Damped counts times inverse document frequency
give a term vector; the leading singular directions of the labelled texts' vectors make the
latent space. Every document is projected into it, its cosines with all labelled vectors are
computed exactly, block by block, and the nearest vote with their similarity as weight.

The model is fitted on a bounded sample of the labelled rows (``MOST_PER_LABEL`` of each label,
chosen by a hash of the doc_id; documented bound), so it is less than a megabyte whatever the corpus,
and it is broadcast. Scoring is a map over whole texts: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import named, table

#: Labelled rows of each label (good and bad) that a model is fitted on, at most.
MOST_PER_LABEL = 1000
#: Places that trigrams are hashed to; the term of repeated words has one more.
TRIGRAMS = 1024
#: Directions of the latent space.
DIRECTIONS = 64
NEIGHBOURS = 15
#: Votes weigh cosine to this power: near neighbours count more.
SHARPNESS = 4
#: Weight of the prior beside the votes: what is like nothing labelled is not rejected for it.
PRIOR_WEIGHT = 1.0
#: Least score of a document that counts as good. Fixed value.
GOOD = 0.7
#: Documents compared with all labelled vectors at a time.
BLOCK = 256
#: Bytes of a text whose trigrams are counted at a time.
PIECE = 1 << 20

_tables = np.random.default_rng(9).integers(0, TRIGRAMS, (3, 256), dtype=np.int32)


def terms(text: str | None) -> np.ndarray:
    """Damped counts of a whole text's terms, unit length (zeros for a text without any)."""
    data = (text or "").encode()
    counts = np.zeros(TRIGRAMS + 1)
    letters = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, max(len(letters) - 2, 0), PIECE):
        part = letters[at : at + PIECE + 2]
        places = _tables[0][part[:-2]] + _tables[1][part[1:-1]] + _tables[2][part[2:]]
        counts[:TRIGRAMS] += np.bincount(places & (TRIGRAMS - 1), minlength=TRIGRAMS)
    words = data.split()
    counts[TRIGRAMS] = sum(map(eq, words, words[1:]))
    damped = np.log1p(counts)
    # How often words repeat, not how long the text is, tells: this term's weight is its share.
    damped[TRIGRAMS] = counts[TRIGRAMS] / max(len(words), 1)
    length = np.linalg.norm(damped[:TRIGRAMS])
    if length:
        damped[:TRIGRAMS] /= length
    return damped


def project(rows: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Unit vectors of the latent space (zero for rows without terms)."""
    points = (rows @ projection).astype(np.float32)
    lengths = np.linalg.norm(points, axis=1, keepdims=True)
    return np.divide(points, lengths, out=np.zeros_like(points), where=lengths > 0)


@dataclass(frozen=True)
class Model:
    """Projection of term vectors, unit labelled vectors, their labels, and the prior score."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Scores from 0 to 1; a text without terms, or like none labelled, gets the prior."""
        scores = np.full(len(texts), self.prior)
        if not len(self.labels):
            return scores
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            rows = np.stack([terms(x) for x in texts[at : at + BLOCK]])
            points = project(rows, self.projection)
            cosines = points @ self.vectors.T
            nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weights = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0) ** SHARPNESS
            votes = (weights * self.labels[nearest]).sum(axis=1) + PRIOR_WEIGHT * self.prior
            found = votes / (weights.sum(axis=1) + PRIOR_WEIGHT)
            scores[at : at + BLOCK] = np.clip(found, 0, 1)
        return scores


def held_out(doc_id: Column) -> Column:
    """Rows whose labels a model never sees: crc32 of the id as text is 2 mod 4."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most_per_label: int = MOST_PER_LABEL) -> Model:
    """A model from the labelled rows that are not held out.

    Several labels of one doc_id are averaged and rounded, several texts of one doc_id count as
    the greatest. Null labels and ids are left out. Without any labelled row every score is 1:
    nothing is known against a document.
    """
    known = (
        labels.where("quality is not null and doc_id is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    shares = {row["good"]: row["n"] for row in known.groupBy("good").agg(F.count("*").alias("n")).collect()}
    prior = (shares.get(1, 0) + 1) / (sum(shares.values()) + 1)
    chosen = [
        known.where(F.col("good") == good).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_label)
        for good in (0, 1)
    ]
    # Broadcast: at most twice most_per_label rows of two numbers.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    sample = sample.groupBy("doc_id", "good").agg(F.max("text").alias("text"))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [terms(x).astype(np.float32).tobytes() for x in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "good": batch["good"], "terms": rows})

    found = sample.mapInPandas(vectors, "doc_id long, good int, terms binary").toPandas()
    if found.empty:
        empty = np.zeros((0, DIRECTIONS), np.float32)
        return Model(np.zeros((TRIGRAMS + 1, DIRECTIONS), np.float32), empty, np.zeros(0), prior)
    found = found.sort_values("doc_id")
    rows = np.stack([np.frombuffer(x, np.float32) for x in found.pop("terms")])
    inverse = (np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1).astype(np.float32)
    # The right singular vectors are the eigenvectors of the terms' products.
    products = np.zeros((len(inverse), len(inverse)))
    for at in range(0, len(rows), BLOCK):
        weighted = rows[at : at + BLOCK] * inverse
        products += weighted.T @ weighted
    _, directions = np.linalg.eigh(products)
    projection = (inverse[:, None] * directions[:, ::-1][:, :DIRECTIONS]).astype(np.float32)
    points = project(rows, projection)
    return Model(projection, points, found["good"].to_numpy(dtype=np.float64), prior)


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Every column of ``docs`` and the score of its whole ``text`` (null counts as empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores(list(texts)))

    return docs.withColumn(name, score("text"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score of at least GOOD, columns unchanged."""
    name = "_quality_score"
    scored = with_scores(docs, fit(docs, labels), name)
    return scored.where(F.col(name) >= GOOD).select(named(docs))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return with_scores(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )
