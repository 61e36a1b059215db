"""Runs of repeated word sequences, found online by dyadic catchers of squares.

Words are appended to a stream. Of every completed block of b = 1, 2, 4, ... words (at multiples of b)
a catcher is kept that waits for the block to come again 2b to 4b - 1 words later: each position has two
catchers of a size to be held against, by names of its next b words that are joined from names of
half the length. A run of period p holds p words twice in a row, so one of its blocks of
b <= p / 2 words comes again after p words: no square is missed. Catchers that fire p apart for
block after block are one square that goes on; its ends are found by comparing words, not names, and
it becomes a run. Runs that reach the end of the stream stay open: appended words advance them.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import id_and_text

#: Runs that count: so many periods, and so many words, at least.
EXPONENT, LENGTH = 3, 24
#: Words of documents that go to one catcher; a longer document has one of its own.
PIECE = 300_000
#: Words that are compared in one numpy step.
STEP = 2_000_000

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _agreeing(words: np.ndarray, x: np.ndarray, y: np.ndarray, step: int, room: np.ndarray) -> np.ndarray:
    """How many words agree from each x and y on, going by ``step``, at most ``room``."""
    count = np.zeros(len(x), dtype=np.int64)
    going, width = np.arange(len(x)), 16
    while len(going):
        left = []
        for at in range(0, len(going), STEP // width):
            own = going[at:at + STEP // width]
            offset = count[own, None] + np.arange(width)
            inside = offset < room[own, None]
            offset = np.where(inside, offset * step, 0)
            same = inside & (words[x[own, None] + offset] == words[y[own, None] + offset])
            whole = same.all(axis=1)
            count[own] += np.where(whole, width, same.argmin(axis=1))
            left.append(own[whole])
        going, width = np.concatenate(left), min(2 * width, 4_096)
    return count


class SquareCatcher:
    """Runs of at least ``exponent`` (a whole number from 2 on) periods and ``length`` words in a stream.

    ``append`` words (any numbers that fit 64 bits), as many at a time as there are: how they are dealt out
    changes no result. Blocks of b words are looked at when b more words have come, all others at the
    end, so a run is known at most that much later. No period above ``longest`` is looked for.
    """

    def __init__(self, exponent: int = 2, length: int = 2, longest: int | None = None):
        self.exponent, self.length, self.longest = exponent, length, longest
        self._words = np.zeros(1024, dtype=np.uint64)
        self.n = 0
        self.start = self.end = self.period = np.zeros(0, dtype=np.int64)
        #: Of each level the window starts that were held against their catchers.
        self._seen: list[int] = []

    def append(self, words: np.ndarray) -> None:
        more = np.asarray(words).astype(np.int64, copy=False).view(np.uint64)
        if self.n + len(more) > len(self._words):
            room = np.zeros(max(2 * len(self._words), self.n + len(more)), dtype=np.uint64)
            room[: self.n] = self._words[: self.n]
            self._words = room
        self._words[self.n:self.n + len(more)] = more
        before, self.n = self.n, self.n + len(more)
        opened = np.flatnonzero(self.end == before)
        if len(opened) and len(more):
            at = self.end[opened]
            self.end[opened] += _agreeing(self._words, at, at - self.period[opened], 1, np.full(len(at), self.n - before))
        self._advance(False)

    def finish(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and period of all runs, in order of start and period."""
        self._advance(True)
        order = np.lexsort((self.period, self.start))
        return self.start[order], (self.end - self.start)[order], self.period[order]

    def _levels(self) -> list[tuple[int, int, tuple[int, ...]]]:
        """Number, block length and distances (in blocks) of the levels a run can have by now."""
        most = self.n // self.exponent if self.longest is None else min(self.longest, self.n // self.exponent)
        found, b = [(0, 1, (1,))] if most else [], 1
        while 2 * b <= most:
            found.append((len(found), b, (2, 3)))
            b *= 2
        return found

    def _needed(self, b: int, period: np.ndarray) -> np.ndarray:
        """Whole blocks at the least that come again in a run of a period."""
        again = np.maximum((self.exponent - 1) * period, self.length - period)
        return np.maximum(1, (again - b + 1) // b)

    def _advance(self, last: bool) -> None:
        levels = self._levels()
        self._seen += [0] * (len(levels) - len(self._seen))
        due = [k for k, b, _ in levels if last or self.n - b - self._seen[k] >= b]
        if not due:
            return
        levels = levels[: max(due) + 1]
        begin = []
        for k, b, apart in levels:  # blocks of an unfinished run are looked at again
            again = int(self._needed(b, np.arange(apart[0] * b, (apart[-1] + 1) * b)).max()) + 1
            begin.append(max(0, (self._seen[k] - again * b) // b * b - 4 * b))
        names, low = None, min(begin)
        for k, b, apart in levels:
            if b == 1:
                names = self._words[low:self.n] * np.uint64(0x9E3779B97F4A7C15)
            else:
                names = names[: len(names) - b // 2] * np.uint64(0xBF58476D1CE4E5B9) + names[b // 2:]
                names ^= names >> np.uint64(32)
                names *= np.uint64(0x94D049BB133111EB)
            base = -(-max(low, begin[k]) // b) * b
            self._catch(names[base - low:], base, b, apart)
            self._seen[k] = max(0, self.n - b + 1)

    def _catch(self, names: np.ndarray, base: int, b: int, apart: tuple[int, ...]) -> None:
        """Hold the windows from ``base`` on against their catchers and keep the runs that follow."""
        rows = -(-len(names) // b)
        grid = np.zeros(rows * b, dtype=np.uint64)
        grid[: len(names)] = names
        grid = grid.reshape(rows, b)
        block, period = [], []
        for m in apart:
            if rows > m:
                at, word = np.nonzero(grid[m:] == grid[:-m, :1])
                inside = (at + m) * b + word < len(names)
                block.append(at[inside])
                period.append(m * b + word[inside])
        if not block:
            return
        block, period = np.concatenate(block), np.concatenate(period)
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        first = np.flatnonzero(np.r_[True, (np.diff(period) != 0) | (np.diff(block) != 1)][: len(block)])
        count = np.diff(np.r_[first, len(block)])
        x, p = base + block[first] * b, period[first]
        likely = count >= self._needed(b, p)
        x, p, count = x[likely], p[likely], count[likely]
        new = ~self._known(x, x + count * b + p, p)
        x, p = x[new], p[new]
        if not len(x):
            return
        back = _agreeing(self._words, x - 1, x + p - 1, -1, x)
        ahead = _agreeing(self._words, x, x + p, 1, self.n - p - x)
        start, end = x - back, x + ahead + p
        whole = end - start >= np.maximum(self.exponent * p, self.length)
        self.start = np.concatenate([self.start, start[whole]])
        self.end = np.concatenate([self.end, end[whole]])
        self.period = np.concatenate([self.period, p[whole]])

    def _known(self, x: np.ndarray, y: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether the words from x to y lie in a known run whose period divides p."""
        known = np.zeros(len(x), dtype=bool)
        if not len(x):
            return known
        long = self.end - self.start >= (y - x).min()
        for period in np.unique(self.period[long]):
            own = np.flatnonzero(self.period == period)
            own = own[np.argsort(self.start[own])]
            some = np.flatnonzero(p % period == 0)
            last = np.searchsorted(self.start[own], x[some], "right") - 1
            known[some] |= (last >= 0) & (self.end[own[last]] >= y[some])
        return known


Edit = Callable[[int | None, list[bytes]], list[bytes]]


def _whole_pieces(ids: list, texts: list[str], edit: Edit | None) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Documents as words, together about PIECE words."""
    some, held, size = [], [], 0
    for doc_id, text in zip(ids, texts, strict=True):
        words = text.encode("utf-8").split()  # bytes: blanks are 0x20 and 0x09-0x0D
        words = words if edit is None else edit(doc_id, words)
        some.append(doc_id)
        held.append(words)
        size += len(words)
        if size >= PIECE:
            yield some, held
            some, held, size = [], [], 0
    if some:
        yield some, held


def runs_of(documents: list[list[bytes]], exponent: int = EXPONENT, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Document, start, length and period of the runs in lists of words, in this order, and a mark for each
    word of all documents (one more after each): whether it repeats a run."""
    sizes = np.array([len(words) + 1 for words in documents])
    first = np.cumsum(sizes) - sizes
    number: dict[bytes, int] = {}
    line = np.empty(int(sizes.sum()), dtype=np.int64)
    for n, (words, at) in enumerate(zip(documents, first.tolist(), strict=True)):
        line[at:at + len(words)] = [number.setdefault(w, len(number)) for w in words]
        line[at + len(words)] = -1 - n  # no run goes over the end of a document
    catcher = SquareCatcher(exponent, length, int(sizes.max()) // exponent)
    catcher.append(line)
    start, size, period = catcher.finish()
    owner = np.searchsorted(first, start, "right") - 1
    change = np.zeros(len(line) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + size, -1)
    return owner, start - first[owner], size, period, np.cumsum(change[:-1]) > 0


def periodic(docs: DataFrame, exponent: int = EXPONENT, length: int = LENGTH, edit: Edit | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` (an array of start, length and period, by start and
    then period; words count from 0) and ``collapsed``, the words that no run repeats, joined by one blank.

    A run is a stretch of words with smallest period ``period`` that no neighbouring word extends, of at
    least ``exponent`` periods and ``length`` words; every word of it after its first period repeats. Words are
    parted by blanks 0x20 and 0x09-0x0D. ``edit`` changes the words of a document first.

    Null and empty texts have no words and no runs; rows without a doc_id and repeated rows stay rows. An
    empty table gives no rows; other columns are not read. A text is held by one task, whole, with a
    few numbers for each word.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            kind = batch.column("doc_id").type
            for ids, documents in _whole_pieces(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), edit):
                owner, start, size, period, repeats = runs_of(documents, exponent, length)
                offsets = np.searchsorted(owner, np.arange(len(documents) + 1)).astype(np.int32)
                runs = pa.StructArray.from_arrays([pa.array(start), pa.array(size), pa.array(period)], names=["start", "length", "period"])
                collapsed, at = [], 0
                for n, words in enumerate(documents):
                    if offsets[n] < offsets[n + 1]:
                        words = [words[i] for i in np.flatnonzero(~repeats[at:at + len(words)]).tolist()]
                    collapsed.append(b" ".join(words).decode("utf-8"))
                    at += len(documents[n]) + 1
                counts = pa.array([len(words) for words in documents], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, kind), counts, pa.ListArray.from_arrays(pa.array(offsets), runs), pa.array(collapsed, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return id_and_text(docs).mapInArrow(run, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")


def loop_some(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by crc32 of the doc_id, repeats some of its words from a place on to its end.
    Documents without a doc_id stay as they are."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def summarised(docs: DataFrame) -> DataFrame:
    """Per document, some of them looped first: the number of runs, the one with the greatest exponent, and
    digests of all runs and of the collapsed text. See ``periodic`` for rows out of the ordinary."""
    best = F.aggregate(
        "runs", F.lit(None).cast(RUN),
        lambda top, r: F.when(top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return periodic(docs, edit=loop_some).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
