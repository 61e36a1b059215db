"""Token-ID files: Re-Pair grammars of shards, with random access.

Frequent pairs of neighbouring symbols are replaced by new ones, over and over, shard by shard. A
shard holds its rules, how many ids each rule expands to, and the sequence that is left; the ids of any
range are decoded from the few symbols that cover it. Several pairs are replaced in one round: all that
are at least a fraction as frequent as the most frequent one.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeloom.llm.bpe import REMEMBERED, Codes, Encoder, byte_letters, gathered, in_goes
from gradeloom.llm.common import id_and_text
from gradeloom.session import cut_lineage

#: The id that ends a document.
END = 1
#: Ids of a shard, about: a shard is closed with the document that reaches this many.
SHARD_IDS = 1 << 20
#: Characters of text that are encoded in one go.
GO = 4_000_000
#: Symbols, ids and rules together; two bytes hold one.
SYMBOLS = 1 << 16
#: A pair gets a rule if it is found this often; and in a round, if it is at least one FRACTIONth as frequent as the first.
LEAST = 16
FRACTION = 16
_MAGIC = b"RPG1"
_HEAD = "<4sIIIQI"
_BLANKS = re.compile(r"[^\t-\r ]+")
#: Letters of Latin-1 in lower case. No normalisation changes or joins them.
_LETTER = "a-z\xdf-\xf6\xf8-\xff"
_LETTERS = re.compile(f"[{_LETTER}]+")
#: What a byte of Latin-1 in lower case is: 0 a blank, 1 a letter, 2 anything else.
_KIND = np.array([0 if 9 <= b <= 13 or b == 32 else 1 if _LETTERS.fullmatch(chr(b)) else 2 for b in range(256)], dtype=np.uint8)
#: Characters that join letters or are letters themselves: a chunk with one of them stays whole.
_JOINS = np.isin(np.arange(256), list(b"'" + "ªµº".encode("latin-1")))


class WordEncoder(Encoder):
    """Encodes with the tokenizers library, a chunk between blanks at a time, and remembers chunks.

    The tokenizer drops blanks, so the ids of a text are those of its chunks. In Latin-1 texts case
    makes no difference, and letters are never joined with other characters but after an apostrophe: chunks without
    one are cut into runs of letters and of others. Of many such texts each distinct run is looked up once. Words of Latin
    letters go to the library's model directly, since nothing else would change or split them.
    """

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_buffer(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        of_byte = {b: c for c, b in byte_letters().items()}
        #: What the model sees of letters that are no ASCII: the letters that stand for their bytes.
        self.letters = {c: "".join(of_byte[b] for b in chr(c).encode("utf-8")) for c in range(0xDF, 0x100)}
        self._forget()

    def _forget(self) -> None:
        self.known = Codes()
        self.ids, self.held = np.zeros(1 << 16, dtype=np.int32), 0  # with room to grow
        self.starts, self.lengths = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        end = self.held + len(ids)
        if end > len(self.ids):
            self.ids = np.r_[self.ids[:self.held], np.zeros(2 * end - self.held, dtype=np.int32)]
        self.ids[self.held:end] = ids
        self.starts = np.r_[self.starts, (self.held + np.cumsum(lengths) - lengths).astype(np.int32)]
        self.lengths, self.held = np.r_[self.lengths, lengths.astype(np.int32)], end

    def _chunks(self, text: str) -> list[str]:
        return _BLANKS.findall(text)

    def _codes(self, chunks: list[str] | list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, chunks), dtype=np.int64, count=len(chunks))

    def _run_codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the runs of Latin-1 texts, and how many each text has."""
        data = np.frombuffer("\n".join(texts).lower().encode("latin-1"), dtype=np.uint8)
        kind, joins = _KIND[data], np.flatnonzero(_JOINS[data])
        if len(joins):
            chunk = np.cumsum((kind > 0) & np.r_[True, kind[:-1] == 0])
            whole = np.zeros(chunk[-1] + 1, dtype=bool)
            whole[chunk[joins]] = True
            kind[whole[chunk] & (kind > 0)] = 3
        starts = np.flatnonzero(np.r_[len(kind) > 0, kind[1:] != kind[:-1]])
        lengths = np.diff(np.r_[starts, len(kind)])
        real = kind[starts] > 0
        ends = np.cumsum(np.r_[0, lengths[real]]).astype(np.int32)
        runs = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data[kind > 0])]).dictionary_encode()
        codes = self._codes(runs.dictionary.to_numpy(zero_copy_only=False).tolist())
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return codes[runs.indices.to_numpy()], np.diff(np.searchsorted(starts[real], begins))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        if len(self.known) > REMEMBERED:
            self._forget()
        before = len(self.known)
        plain = np.array([_plain(t) for t in texts], dtype=bool)
        codes, counts = self._run_codes([t for t, p in zip(texts, plain, strict=True) if p])
        chunks = [self._chunks(t) for t, p in zip(texts, plain, strict=True) if not p]
        if chunks:  # back in the order of the texts
            codes = np.r_[codes, self._codes([c for own in chunks for c in own])]
            own = np.zeros(len(texts), dtype=np.int64)
            own[plain], own[~plain] = counts, [len(c) for c in chunks]
            begins, order = np.zeros(len(texts), dtype=np.int64), np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
            begins[order] = np.cumsum(own[order]) - own[order]
            codes, counts = codes[gathered(begins, own)], own
        if len(self.known) > before:
            self._learn(list(islice(self.known, before, None)))
        lengths = self.lengths[codes]
        ends = np.r_[0, np.cumsum(lengths)]
        return self.ids[gathered(self.starts[codes], lengths)], np.diff(ends[np.r_[0, np.cumsum(counts)]])

    def _learn(self, chunks: list[str | bytes]) -> None:
        self._add(*self._ids([c if isinstance(c, str) else c.decode("latin-1") for c in chunks]))

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, tokenize, letters = [], self.model.tokenize, _LETTERS.fullmatch
        for part in parts:
            if letters(part):  # one word of the model, normalised as it is
                found.append([t.id for t in tokenize(part if part.isascii() else part.translate(self.letters))])
            else:
                found.append(self.tokenizer.encode(part, add_special_tokens=False).ids)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(lengths.sum())), lengths


def _plain(text: str) -> bool:
    """Whether a text is Latin-1 and has no mark of a special id; these are case-sensitive."""
    if "<|" in text:
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=1)
def encoder_of(content: bytes) -> WordEncoder:
    """The encoder of a vocabulary, kept with the chunks it knows for the further tasks of a Python worker."""
    return WordEncoder(content)


def compressed(ids: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (left and right symbol of each, numbered from ``first``) and the sequence left of ids below ``first``."""
    left, right, rest = [], [], ids.astype(np.uint32)
    room = SYMBOLS - first
    while room > 0 and len(rest) > 1:
        keys = rest[:-1] << np.uint32(16) | rest[1:]
        ordered = np.sort(keys)
        ordered = ordered[:-LEAST + 1][ordered[LEAST - 1:] == ordered[:-LEAST + 1]]  # of each pair LEAST - 1 places fewer
        if not len(ordered):
            break
        edge = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        counts = np.diff(np.r_[edge, len(ordered)]) + LEAST - 1
        often = counts >= int(counts.max()) // FRACTION
        pairs, counts = ordered[edge[often]], counts[often]
        if len(pairs) > room:
            pairs = np.sort(pairs[np.argsort(-counts, kind="stable")[:room]])
        # most places are ruled out by a table of hashes before the search
        table = np.zeros(1 << 18, dtype=bool)
        table[pairs * np.uint32(0x9E3779B1) >> np.uint32(14)] = True
        place = np.flatnonzero(table[keys * np.uint32(0x9E3779B1) >> np.uint32(14)])
        rule = np.minimum(np.searchsorted(pairs, keys[place]), len(pairs) - 1)
        same = pairs[rule] == keys[place]
        place, rule = place[same], rule[same]
        # of places in a row, which overlap, every second one from the left is replaced
        began = np.maximum.accumulate(np.where(np.r_[True, place[1:] != place[:-1] + 1], np.arange(len(place)), 0))
        free = (np.arange(len(place)) - began) % 2 == 0
        place, rule = place[free], rule[free]
        used = np.bincount(rule, minlength=len(pairs))
        worth = np.flatnonzero(used >= LEAST // 2)
        if not len(worth):
            break
        number = np.full(len(pairs), -1)
        number[worth] = np.arange(len(worth)) + first + len(left)
        kept = number[rule] >= 0
        place, rule = place[kept], rule[kept]
        left += (pairs[worth] >> np.uint32(16)).tolist()
        right += (pairs[worth] & np.uint32(0xFFFF)).tolist()
        room -= len(worth)
        rest[place] = number[rule]
        stay = np.ones(len(rest), dtype=bool)
        stay[place + 1] = False
        rest = rest[stay]
    return np.array(left, dtype=np.uint16), np.array(right, dtype=np.uint16), rest.astype(np.uint16)


class Shard:
    """A shard of the file format, as bytes and back.

    Head, then as little-endian arrays: doc_ids, the end of each document, the number of ids each
    rule expands to, left and right symbols of the rules, and the sequence of symbols.
    """

    def __init__(self, first, doc_ids, ends, left, right, sizes, rest):
        self.first, self.doc_ids, self.ends = first, doc_ids, ends
        self.left, self.right, self.sizes, self.rest = left, right, sizes, rest
        # what each symbol stands for, one after the other: an id for itself, a rule for its two sides
        opened: list[list[int]] = []
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            opened.append((opened[a - first] if a >= first else [a]) + (opened[b - first] if b >= first else [b]))
        self.flat = np.concatenate([np.arange(first), np.fromiter(chain.from_iterable(opened), dtype=np.int64, count=int(sizes.sum()))])
        self.lengths = np.concatenate([np.ones(first, dtype=np.int64), sizes.astype(np.int64)])
        self.starts = np.cumsum(self.lengths) - self.lengths

    @classmethod
    def of(cls, doc_ids: list[int], documents: list[np.ndarray], first: int) -> Shard:
        """Shard of documents' ids, all below ``first``, of which two bytes must hold each."""
        if first > SYMBOLS:
            raise ValueError(f"a vocabulary of {first} ids does not fit {SYMBOLS} symbols")
        ids = np.concatenate(documents)
        left, right, rest = compressed(ids, first)
        sizes = [1] * first
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            sizes.append(sizes[a] + sizes[b])
        ends = np.cumsum([len(d) for d in documents], dtype=np.uint64)
        return cls(first, np.array(doc_ids, dtype=np.int64), ends, left, right, np.array(sizes[first:], dtype=np.uint32), rest)

    def write(self) -> bytes:
        head = struct.pack(_HEAD, _MAGIC, self.first, len(self.doc_ids), len(self.left), int(self.ends[-1]), len(self.rest))
        parts = (self.doc_ids.astype("<i8"), self.ends.astype("<u8"), self.sizes.astype("<u4"), self.left.astype("<u2"), self.right.astype("<u2"), self.rest.astype("<u2"))
        return head + b"".join(p.tobytes() for p in parts)

    @classmethod
    def read(cls, content: bytes) -> Shard:
        magic, first, docs, rules, _, symbols = struct.unpack_from(_HEAD, content)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        at, found = struct.calcsize(_HEAD), []
        for kind, count in (("<i8", docs), ("<u8", docs), ("<u4", rules), ("<u2", rules), ("<u2", rules), ("<u2", symbols)):
            found.append(np.frombuffer(content, kind, count, at))
            at += found[-1].nbytes
        doc_ids, ends, sizes, left, right, rest = found
        return cls(first, doc_ids, ends, left, right, sizes, rest)

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        """Ids the symbols stand for."""
        return self.flat[gathered(self.starts[symbols], self.lengths[symbols])]

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from start to end: only the symbols that cover them are opened."""
        ends = np.cumsum(self.lengths[self.rest])
        low, high = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "left") + 1
        began = ends[low - 1] if low else 0
        return self._expanded(self.rest[low:high])[start - began:end - began]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Id, first position and ids of each document."""
        ids, ends = self._expanded(self.rest), self.ends.astype(np.int64)
        for doc_id, start, end in zip(self.doc_ids.tolist(), np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
            yield doc_id, start, ids[start:end]


def written(docs: DataFrame, vocabulary: str, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode all texts and write them as shards in ascending order of doc_id; returns the stored
    table of shards: ``part`` and ``seq`` (their order), ``ids`` (their number) and ``content``.

    Documents are dealt out by ranges of doc_id and sorted in them. Shards lie in a table in the
    folder that all executors share, committed as a whole. Null ids come first, stored as the least long.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        held = spark.sparkContext.broadcast(file.read())

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, encoder = TaskContext.get().partitionId(), 0, None
        doc_ids: list[int] = []
        documents: list[np.ndarray] = []
        held_ids = 0

        def close():
            nonlocal seq, doc_ids, documents, held_ids
            content = Shard.of(doc_ids, documents, encoder.tokenizer.get_vocab_size()).write()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([held_ids], pa.int64()), pa.array([content], pa.binary())],
                names=["part", "seq", "ids", "content"],
            )
            seq, doc_ids, documents, held_ids = seq + 1, [], [], 0

        for batch in found:
            encoder = encoder or encoder_of(held.value)
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in in_goes(texts, GO):
                ids, lengths = encoder.encode(texts[a:b])
                ends = np.cumsum(lengths)
                for name, start, end in zip(names[a:b], (ends - lengths).tolist(), ends.tolist(), strict=True):
                    documents.append(np.r_[ids[start:end], END].astype(np.uint16))
                    doc_ids.append(name)
                    held_ids += end - start + 1
                    if held_ids >= shard_ids:
                        yield from close()
        if documents:
            yield from close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(-(1 << 63)).cast("long")
    rows = id_and_text(docs).select(F.coalesce(F.col("doc_id").cast("long"), least).alias("doc_id"), "text")
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return cut_lineage(ordered.mapInArrow(run, "part int, seq int, ids long, content binary"))


def read_back(shards: DataFrame) -> DataFrame:
    """One row per document of the stored shards: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Starts of parts are running sums over one row for each part, those of shards run inside a part.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part, seq, content in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "content")), strict=True):
                rows = [(d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, start, ids in Shard.read(content).documents()]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.int32()), pa.array([seq] * len(rows), pa.int32()), *columns],
                    names=["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = shards.groupBy("part").agg(F.sum("ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("ids").over(before.partitionBy("part").orderBy("seq")), F.lit(0))
    starts = shards.select("part", "seq", inside.alias("inside")).join(totals, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("first"))
    documents = shards.select("part", "seq", "content").mapInArrow(run, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return documents.join(starts, ["part", "seq"]).select(
        F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"), (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def stored(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents as shards and read every one back: one row per document.

    Null and empty texts have the end id alone. Rows with the same doc_id are in order of text. An empty
    table gives no rows; other columns are not read.
    """
    return read_back(written(docs, vocabulary))
