"""Quality classifier learnt from trusted positives and unlabelled text.

A linear model over the shape of a text: how often each pair of character kinds is found, and how
lines and words repeat. It minimises the non-negative unbiased risk: with positives P, unlabelled
U and class prior p, the loss on negatives is estimated as U's loss less p times P's, and kept from
falling below zero. Labels of negatives are counted for the prior and never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import id_and_text
from gradeloom.llm.langid import held_out

#: Rows that the model is fitted on: so many positives and as many unlabelled ones, those with the
#: smallest hashes of their ids. This bounds what comes to the driver (some 30 MB); everything else covers all rows.
FIT_ROWS = 5_000
#: A text with at least this score is predicted to be good.
CUT = 0.3
STEPS, RATE, DECAY = 300, 0.05, 1e-3
SEED = 10

#: Kinds of characters: each of these marks is its own, then the general ones.
MARKS = ".,!?|#$%&*-_@:;\"'/<>()="
LOWER, UPPER, DIGIT, BLANK, LINE, LETTER, MARK, OTHER = (len(MARKS) + n for n in range(8))
KINDS = OTHER + 1
STATISTICS = 8
WIDTH = KINDS * KINDS + STATISTICS


def kind_table() -> np.ndarray:
    """Kind of each character below 0x3000; what is beyond counts as a letter."""

    def kind(c: str) -> int:
        if c in MARKS:
            return MARKS.index(c)
        if c == "\n":
            return LINE
        if c.isspace():
            return BLANK
        if c.isdigit():
            return DIGIT
        if c.isalpha():
            return (LOWER if c.islower() else UPPER) if c.isascii() else LETTER
        return MARK if c.isascii() else OTHER

    return np.array([kind(chr(c)) for c in range(0x3000)], dtype=np.int64)


def features(text: str, kinds: np.ndarray) -> np.ndarray:
    """Root of the share of each pair of neighbouring kinds, then lengths and repetitions."""
    out = np.zeros(WIDTH, dtype=np.float32)
    points = np.frombuffer((text + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = kinds[np.minimum(points, len(kinds) - 1)]
    if len(kind) > 1:
        pairs = np.bincount(kind[:-1] * KINDS + kind[1:], minlength=KINDS * KINDS)
        out[:-STATISTICS] = np.sqrt(pairs / (len(kind) - 1))
    words, lines = text.split(), [line for line in text.split("\n") if line]
    lengths = np.array([len(w) for w in words] or [0])
    out[-STATISTICS:] = (
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(lengths.mean()), np.log1p(lengths.max()),
        len(set(words)) / max(1, len(words)), len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, len(words)),
    )
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Chance that each row of features is good."""
        value = ((rows - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def fitted(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk with logistic loss by Adam over all rows at once."""
    rows = np.concatenate([positive, unlabelled])
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    p, u = (np.c_[x, np.ones(len(x))].astype(np.float32) for x in (p, u))
    weights = np.zeros(p.shape[1], dtype=np.float32)  # like the rows: mixed products would copy them
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        value_p, value_u = p @ weights, u @ weights
        good_p, good_u = (1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (value_p, value_u))
        # gradients of the logistic losses: as positive on P, as negative on U and on P
        as_positive = p.T @ (good_p - 1) / len(p)
        as_negative = u.T @ good_u / len(u) - prior * (p.T @ good_p) / len(p)
        risk = np.logaddexp(0, value_u).mean() - prior * np.logaddexp(0, value_p).mean()
        # below zero the estimate overfits: step back on it alone
        gradient = prior * as_positive + as_negative if risk >= 0 else -as_negative
        gradient = (gradient + DECAY * np.r_[weights[:-1], 0]).astype(np.float32)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = (weights - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(mean, scale, weights[:-1].astype(np.float64), float(weights[-1]))


def _smallest(ids: DataFrame) -> DataFrame:
    """At most FIT_ROWS of the ids, the same ones on every run."""
    return ids.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(FIT_ROWS)


def learn(docs: DataFrame, labels: DataFrame, learnt: Column) -> Model | None:
    """Fit on the rows where ``learnt`` holds; None if there is no positive or no other row.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 not; null is no label). The prior is the share of
    1 among all labels learnt from.
    """
    known = labels.filter(learnt & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    ones, labelled = known.agg(F.count_if(F.col("quality") == 1), F.count("*")).first()
    prior = (ones + 1) / (labelled + 2)
    everyone = docs.filter(learnt & F.col("doc_id").isNotNull()).select("doc_id")
    positives = _smallest(known.filter("quality = 1").select("doc_id").join(everyone.distinct(), "doc_id", "left_semi"))
    wanted = positives.withColumn("group", F.lit(1)).union(_smallest(everyone.distinct()).withColumn("group", F.lit(0)))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = kind_table()
        for batch in found:
            rows = [features(t, kinds).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("key"), pa.array(rows, pa.binary())], names=["group", "key", "features"])

    # twice FIT_ROWS ids at most
    texts = id_and_text(docs).join(F.broadcast(wanted), "doc_id").select("group", F.xxhash64("doc_id", "text").alias("key"), "text")
    rows = sorted(texts.mapInArrow(run, "group int, key long, features binary").collect())
    groups = [np.array([np.frombuffer(r["features"], np.float32) for r in rows if r["group"] == g]) for g in (1, 0)]
    return fitted(*groups, prior) if all(len(g) for g in groups) else None


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from CUT on).

    Null and empty texts are scored as empty ones. Without a model every score is 0.5. Repeated rows
    stay rows; an empty table gives none. Only doc_id and text are read, and texts are read whole.
    """
    plain = None if model is None else (model.mean, model.scale, model.weights, model.bias)
    held = docs.sparkSession.sparkContext.broadcast(plain)  # plain data: executors may lack the package

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, own = kind_table(), None if held.value is None else Model(*held.value)
        for batch in found:
            texts = batch.column("text").to_pylist()
            scores = np.full(len(texts), 0.5)
            for at in range(0, len(texts) if own else 0, 500):
                scores[at:at + 500] = own.scores(np.array([features(t, kinds) for t in texts[at:at + 500]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = id_and_text(docs).select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
