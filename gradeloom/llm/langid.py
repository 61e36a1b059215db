"""Language identification of mixed texts.

Each language has a distribution over hashed letter trigrams, counted over all training texts.
A document is a mixture: expectation-maximisation estimates the share of each language, then the
set of languages is chosen by likelihood less a penalty for every further language.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import id_and_text, tidied

#: Bins of hashed trigrams. The model holds one float32 for each bin and language.
BINS = 1 << 16
#: Pseudo-count of each bin.
SMOOTHING = 0.1
#: Log-likelihood that a further language must add, in units of log(trigrams). Trigrams overlap, so
#: this is above the half that independent ones would ask for.
PENALTY = 3.0
STEPS, MOVE = 40, 1e-3
UNDETERMINED = "und"


def held_out() -> Column:
    """Whether a document is kept from learning; one without doc_id always is."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def letter_table() -> np.ndarray:
    """The code point of every letter, and a blank for all else."""
    return np.fromiter((c if chr(c).isalpha() else 32 for c in range(sys.maxunicode + 1)), dtype=np.uint32, count=sys.maxunicode + 1)


def trigrams(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Bins of the letter trigrams of a text with runs of other characters as one blank; None without letters."""
    points = letters[np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    blank = points == 32
    points = points[~(blank & np.r_[False, blank[:-1]])]
    if len(points) < 3:
        return None
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    return (((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    likelihood: np.ndarray  # languages x bins, float32

    def mixture(self, bins: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Languages of the chosen set, largest share first, and their shares."""
        grams = self.likelihood[:, bins]
        share = _shares(grams)
        order = np.argsort(-share, kind="stable")
        chosen, best = order[:1], float(np.log(grams[order[0]]).sum())
        shares = np.ones(1)
        for size in range(2, len(order) + 1):
            part = _shares(grams[order[:size]])
            value = float(np.log(part.astype(np.float32) @ grams[order[:size]]).sum()) - PENALTY * (size - 1) * math.log(len(bins))
            if value <= best:
                break
            chosen, best, shares = order[:size], value, part
        by_share = np.argsort(-shares, kind="stable")
        return [int(c) for c in chosen[by_share]], shares[by_share]

    def predict(self, text: str | None, letters: np.ndarray) -> tuple[str, float, str]:
        """Main language, its share, and all chosen ones with their shares."""
        bins = trigrams(text, letters) if text else None
        if bins is None or not self.languages:
            return UNDETERMINED, 0.0, ""
        chosen, shares = self.mixture(bins)
        named = ",".join(f"{self.languages[c]}:{s:.3f}" for c, s in zip(chosen, shares, strict=True))
        return self.languages[chosen[0]], min(1.0, float(shares[0])), named


def _shares(grams: np.ndarray) -> np.ndarray:
    """Shares of the rows of likelihoods that fit the columns best, by expectation-maximisation."""
    k, n = grams.shape
    share = np.full(k, 1 / k, dtype=np.float32)
    for _ in range(STEPS):
        new = share * (grams @ (1 / (share @ grams))) / n
        if np.abs(new - share).max() < MOVE:
            return new / new.sum()
        share = new
    return share / share.sum()


def learn(docs: DataFrame, learnt: Column) -> Model:
    """Trigram distributions of each non-null ``lang`` over all rows where ``learnt`` holds.

    The counts are summed by Spark; only languages x BINS numbers come to the driver.
    """

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = letter_table(), {}
        for batch in found:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                bins = trigrams(text, letters)
                own = sums.setdefault(lang, np.zeros(BINS, dtype=np.int64))
                if bins is not None:
                    np.add.at(own, bins, 1)
        for lang, own in sums.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(own[some])], names=["lang", "bin", "n"])

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros(BINS)
        dense[rows["bin"].to_numpy()] = rows["n"].to_numpy()
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "counts": [dense.tobytes()]})

    known = docs.filter(learnt & F.col("lang").isNotNull())
    sums = id_and_text(known, "lang").select("text", "lang").mapInArrow(tidied(count), "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    packed = sorted(sums.groupBy("lang").applyInPandas(pack, "lang string, counts binary").collect())
    table = np.array([np.frombuffer(r["counts"]) for r in packed]).reshape(-1, BINS) + SMOOTHING
    return Model([r["lang"] for r in packed], (table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` (share of that
    language, 0 to 1) and ``languages``, the chosen set with shares.

    Text that is null or has no letter, and all texts if nothing was learnt, are ``und`` with score
    0. Whole texts are read, of any length. Repeated rows stay rows; an empty table gives none. Of
    languages with equal shares the first by name counts. Only doc_id and text are read.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.likelihood))  # plain data: executors may lack the package

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, own = letter_table(), Model(*held.value)
        for batch in found:
            said = [own.predict(t, letters) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *(pa.array([s[k] for s in said], t) for k, t in enumerate((pa.string(), pa.float64(), pa.string())))],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, languages string"
    )


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose language could be told.

    Where no language was learnt, all texts with a letter stay.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.likelihood))  # plain data: executors may lack the package

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, own = letter_table(), Model(*held.value)
        for batch in found:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                texts = part.column("text").to_pylist()
                if own.languages:
                    told = [own.predict(t, letters)[0] != UNDETERMINED for t in texts]
                else:
                    told = [bool(t) and trigrams(t, letters) is not None for t in texts]
                yield part.filter(pa.array(told, pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)
