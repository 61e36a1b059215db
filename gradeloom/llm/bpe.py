"""Byte-level BPE in batched numpy rounds.

Texts are cut at blanks into chunks; what a chunk encodes to is remembered. Chunks not yet known are
split into words, and the bytes of all their distinct words lie in one flat array of symbols. In
each round every word finds its lowest-ranked pair of neighbours, by binary search over the sorted
pair keys of the vocabulary, and all places of that pair in the word are merged at once; words that
have no pair left leave. Decoding gathers the bytes of the ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from gradeloom.llm.common import give_back, id_and_text, slices, tidied

#: White space by the Unicode property, as the words of a vocabulary are split; Python's own \s has four more.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNK = re.compile(rf" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
# Fixed value: the word pattern of the vocabulary.
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
#: Chunks that are remembered before the memory starts anew: some 60 MB.
REMEMBERED = 400_000
#: Characters of text that are encoded in one go.
GO = 1_000_000
#: Texts that are Python strings at a time, of those in a batch.
ROWS = 500


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable ones for themselves, the
    others numbered from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + n): b for n, b in enumerate(others)}


class Vocabulary:
    """Merges and bytes of a byte-level vocabulary file (its JSON as bytes)."""

    def __init__(self, content: bytes):
        held = json.loads(content)
        ids, letters = held["model"]["vocab"], byte_letters()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in held["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)  # by rank
        self.first = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.first[byte] = ids[letter]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        known = {i: bytes(letters[c] for c in t) for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        pieces = [known.get(i, b"") for i in range(max(known) + 1)]
        self.lengths = np.array([len(p) for p in pieces])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each word has."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        none = len(self.merged)
        rank = np.full(len(symbols), none)  # of the pair that starts at each symbol
        fresh = np.flatnonzero(word[:-1] == word[1:])  # pairs to look up
        while len(symbols):
            key = symbols[fresh] << 32 | symbols[fresh + 1]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank[fresh] = np.where(self.keys[at] == key, self.ranks[at], none)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbols)]))
            over = low == none  # words without a pair are done
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, rank, low = symbols[~over], word[~over], rank[~over], low[~over]
            hit = rank == low
            # in a run of overlapping places (aaa) every second one counts, from the left
            if (hit[1:] & hit[:-1]).any():
                index = np.arange(len(hit))
                began = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], index, 0))
                hit &= (index - began) % 2 == 0
            place = np.flatnonzero(hit)
            symbols[place] = self.merged[rank[place]]
            rank[place] = none
            keep = np.ones(len(symbols), dtype=bool)
            keep[place + 1] = False
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            now = place - np.arange(len(place))  # where the merged symbols have moved to
            changed = np.zeros(len(symbols), dtype=bool)
            changed[now] = changed[np.maximum(now - 1, 0)] = True
            fresh = np.flatnonzero(changed[:-1] & (word[:-1] == word[1:]))
        symbols, word = np.concatenate([symbols, *done_symbols]), np.concatenate([word, *done_words])
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes that the ids stand for."""
        return self.bytes[gathered(self.starts[ids], self.lengths[ids])].tobytes()


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs that start and last as given, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Codes(dict):
    """Running numbers of chunks; a chunk that is asked for the first time gets the next one."""

    def __missing__(self, chunk: str) -> int:
        code = self[chunk] = len(self)
        return code


class Encoder:
    """Encodes texts with a vocabulary and remembers chunks."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        marks = vocabulary.special
        self.split = re.compile("(" + "|".join(re.escape(m) for m in sorted(marks, key=len, reverse=True)) + ")") if marks else None
        self._forget()

    def _forget(self) -> None:
        self.known = Codes(zip(self.vocabulary.special, range(len(self.vocabulary.special)), strict=True))
        self.ids = np.zeros(0, dtype=np.int64)
        self.starts, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        marks = np.array(list(self.vocabulary.special.values()), dtype=np.int64)
        self._add(marks, np.ones(len(marks), dtype=np.int64))

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(lengths) - lengths]
        self.ids, self.lengths = np.r_[self.ids, ids], np.r_[self.lengths, lengths]

    def _parts(self, chunk: str) -> list[str]:
        """What a chunk is split into, at least one part; the ids of the parts are those of the chunk."""
        return WORD.findall(chunk)

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.vocabulary.encode_words([p.encode("utf-8") for p in parts])

    def _learn(self, chunks: list[str]) -> None:
        parts = [self._parts(c) for c in chunks]
        distinct = {w: n for n, w in enumerate(dict.fromkeys(w for p in parts for w in p))}
        ids, lengths = self._ids(list(distinct))
        starts = np.cumsum(lengths) - lengths
        used = np.array([distinct[w] for p in parts for w in p], dtype=np.int64)
        total = np.add.reduceat(lengths[used], np.cumsum([0, *map(len, parts)])[:-1])
        self._add(ids[gathered(starts[used], lengths[used])], total)

    def _chunks(self, text: str) -> list[str]:
        if self.split is None or not any(mark in text for mark in self.vocabulary.special):
            return CHUNK.findall(text)
        return [c for n, part in enumerate(self.split.split(text)) for c in ([part] if n % 2 else CHUNK.findall(part))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        chunks = [self._chunks(t) for t in texts]
        flat = [c for own in chunks for c in own]
        if len(self.known) > REMEMBERED:
            self._forget()
        before = len(self.known)
        codes = np.fromiter(map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        if len(self.known) > before:
            self._learn(list(islice(self.known, before, None)))
        lengths = self.lengths[codes]
        ends = np.r_[0, np.cumsum(lengths)]
        counts = np.cumsum([0, *map(len, chunks)])
        return self.ids[gathered(self.starts[codes], lengths)], np.diff(ends[counts])

    def each(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids of each text, and the text decoded from them."""
        for a, b in in_goes(texts):
            ids, lengths = self.encode(texts[a:b])
            ends = np.cumsum(lengths)
            for start, end in zip((ends - lengths).tolist(), ends.tolist(), strict=True):
                yield ids[start:end], self.vocabulary.decode(ids[start:end]).decode("utf-8", errors="replace")


def in_goes(texts: list[str], go: int = GO) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``go`` characters; a longer text is a range of its own."""
    start, total = 0, 0
    for n, t in enumerate(texts):
        if total and total + len(t) > go:
            yield start, n
            start, total = n, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def round_trips(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode and decode every whole text with the vocabulary file at the path ``vocabulary``.

    One row per document: ``doc_id``, ``n_tokens``, ``ids_sha256`` of the ids as little-endian
    unsigned 32-bit integers, and ``decoded_sha256`` of the decoded text. Null and empty texts have
    no ids. Repeated rows stay rows, an empty table gives none, and other columns are not read. The
    driver reads the file and sends its content, a few MB, to the executors.
    """
    content = _content(docs, vocabulary)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in found:
            encoder = encoder or Encoder(Vocabulary(content.value))
            counts, id_digests, text_digests = [], [], []
            for own, decoded in encoder.each(batch.column("text").to_pylist()):
                counts.append(len(own))
                id_digests.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                text_digests.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return id_and_text(docs).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, the ``ids`` of every whole text, and whether they decode to it (``exact``).

    The same rules as in ``round_trips``.
    """
    content = _content(docs, vocabulary)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in found:
            if encoder is None:
                encoder = Encoder(Vocabulary(content.value))
                give_back()
            for some in slices(batch, ROWS):
                texts = some.column("text").to_pylist()
                for a, b in in_goes(texts):
                    both = list(encoder.each(texts[a:b]))
                    lengths = np.cumsum([0, *(len(own) for own, _ in both)]).astype(np.int32)
                    flat = np.concatenate([own for own, _ in both]).astype(np.int32)
                    exact = [decoded == text for text, (_, decoded) in zip(texts[a:b], both, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*(some.column(c).slice(a, b - a) for c in ("doc_id", "source", "lang")), pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)), pa.array(exact, pa.bool_())],
                        names=["doc_id", "source", "lang", "ids", "exact"],
                    )
                    del both, flat
                    give_back()

    rows = id_and_text(docs, "source", "lang")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", "source", "lang"))
    return rows.mapInArrow(tidied(run), f"{kinds}, ids array<int>, exact boolean")


def _content(docs: DataFrame, vocabulary: str) -> Broadcast:
    with open(vocabulary, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())
