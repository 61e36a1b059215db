"""Records of files that cannot be cut just anywhere, read by many tasks a file.

A quoted line break makes a line of CSV less than a record, and a JSON array has no lines at all. Spark
cuts a file into pieces at any line (or closing brace) all the same. Whether a piece begins inside a
quoted cell, or how deep inside nested objects, is not known from itself, but what it does to either
case is: a first scan sums up each piece as a step from state to state, the steps are followed in order
(one row per piece), and a second scan, now with the state each piece begins in, gives out whole records.
The few records that go over the end of a piece are put together afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeloom.session import shared_folder

#: Inside quotes or not, and how deep.
State = tuple[bool, int]

_STRING = re.compile(r'"(?:[^"\\]|\\.)*("|\\?\Z)', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
_JSON_TOKEN = re.compile(r'"|[{}\[\]]')

WHOLE, HEAD, TAIL = 0, 1, 2


class CutError(RuntimeError):
    """The second scan met other pieces than the first."""


class CsvLines:
    """Lines of CSV whose quotes are doubled inside quoted cells. A quote opens a cell at its start only."""

    separator, joint = "\n", "\n"

    def step(self, line: str, state: State) -> State:
        inside, depth = state
        if '"' not in line:
            return state
        at = 0
        while True:
            if inside:
                while True:
                    at = line.find('"', at)
                    if at < 0:
                        return True, depth
                    at += 1
                    if line[at:at + 1] != '"':
                        break
                    at += 1
                inside = False
            elif line[at:at + 1] == '"':
                inside, at = True, at + 1
                continue
            at = line.find(",", at) + 1
            if not at:
                return False, depth

    def open(self, state: State) -> bool:
        return state[0]

    def records(self, lines: Iterator[str], state: State) -> Iterator[tuple[int, str]]:
        """Whole records and the halves at both ends, with their kind."""
        kind, held = (HEAD if state[0] else WHOLE), []
        for line in lines:
            state = self.step(line, state)
            held.append(line)
            if not state[0]:
                yield kind, "\n".join(held)
                kind, held = WHOLE, []
        if held:
            yield (HEAD if kind == HEAD else TAIL), "\n".join(held)


class JsonObjects:
    """Objects that are elements of the array at a depth: 1 for a file that is an array."""

    separator, joint = "}", ""

    def __init__(self, depth: int = 1):
        self.depth = depth

    def _tokens(self, text: str, inside: bool) -> Iterator[tuple[int, str]]:
        """Places of braces and brackets outside strings; at the end the place -1 if a string is open."""
        at = 0
        if inside:
            end = _STRING_END.match(text)
            if end is None:
                yield -1, '"'
                return
            at = end.end()
        while (token := _JSON_TOKEN.search(text, at)) is not None:
            if token[0] == '"':
                string = _STRING.match(text, token.start())
                if string[1] != '"':
                    yield -1, '"'
                    return
                at = string.end()
            else:
                yield token.start(), token[0]
                at = token.end()

    def step(self, text: str, state: State) -> State:
        inside, depth = state
        for at, sign in self._tokens(text, inside):
            if at < 0:
                return True, depth  # the brace that ended the text is part of a string
            depth += 1 if sign in "{[" else -1
        return False, depth - 1

    def open(self, state: State) -> bool:
        return state[0] or state[1] > self.depth

    def records(self, texts: Iterator[str], state: State) -> Iterator[tuple[int, str]]:
        inside, depth = state
        begun = self.open(state)
        kind, held = (HEAD if begun else WHOLE), []
        for text in texts:
            start, at = 0 if begun else None, 0
            for at, sign in self._tokens(text, inside):
                if at < 0:
                    break
                if sign == "{" and depth == self.depth and not begun:
                    begun, start = True, at
                depth += 1 if sign in "{[" else -1
            inside = at < 0
            if begun:
                held += [text[start:], "}"]
            if not inside:
                depth -= 1
                if begun and depth == self.depth:
                    yield kind, "".join(held)
                    kind, held, begun = WHOLE, [], False
        if held:
            yield (HEAD if kind == HEAD else TAIL), "".join(held)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """The pieces of a task, each with its texts; they must be used up in order."""

    def rows() -> Iterator[tuple[str, int, str]]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value")), strict=True)

    left = rows()
    ahead = next(left, None)

    def texts(file: str, start: int) -> Iterator[str]:
        nonlocal ahead
        while ahead is not None and ahead[0] == file and ahead[1] == start:
            value, ahead = ahead[2], next(left, None)
            yield value

    while ahead is not None:
        own = texts(ahead[0], ahead[1])
        yield ahead[0], ahead[1], own
        for _ in own:
            pass


def split_records(spark: SparkSession, path: str | list[str], form: CsvLines | JsonObjects) -> DataFrame:
    """``file``, ``start`` (of the piece), ``place`` and ``value``: the text of every record under the paths.

    Records are in order of file, start and place. The files are read twice, in pieces of
    ``spark.sql.files.maxPartitionBytes``; the driver holds two numbers for each piece, and executors get them. No piece is
    held as a whole. Compressed files are one piece.
    """
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    texts = spark.read.text(path, lineSep=form.separator).select("value", *at)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, own in _pieces(batches):
            out, inner = (False, 0), (True, 0)
            for text in own:
                out, inner = form.step(text, out), form.step(text, inner) if inner != out else form.step(text, out)
            yield pa.RecordBatch.from_pylist([{"file": file, "start": start, "out": [int(x) for x in out], "inner": [int(x) for x in inner]}])

    found = texts.mapInArrow(summed, "file string, start long, out array<long>, inner array<long>").collect()
    begins: dict[str, dict[int, State]] = {}
    state: State = (False, 0)
    for r in sorted(found, key=lambda r: (r["file"], r["start"])):
        if r["file"] not in begins:
            state = (False, 0)
        begins.setdefault(r["file"], {})[r["start"]] = state
        step = r["inner"] if state[0] else r["out"]
        state = (bool(step[0]), state[1] + step[1])
    known = spark.sparkContext.broadcast(begins)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, own in _pieces(batches):
            if start not in known.value.get(file, {}):
                raise CutError(f"{file} is cut into other pieces than before; read it again")
            rows, size = [], 0
            for place, (kind, value) in enumerate(form.records(own, known.value[file][start])):
                rows.append({"file": file, "start": start, "place": place, "kind": kind, "value": value})
                size += len(value)
                if len(rows) == 5_000 or size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    records = texts.mapInArrow(cut, "file string, start long, place long, kind long, value string")
    whole = records.filter(F.col("kind") == WHOLE).select("file", "start", "place", "value")
    if not any(form.open(state) for file in begins.values() for state in file.values()):
        return whole
    # Halves: a tail, then heads up to the piece in which the record ends. Two at most for each piece.
    order = Window.partitionBy("file").orderBy("start", "place")
    halves = records.filter(F.col("kind") != WHOLE).withColumn("number", F.count(F.when(F.col("kind") == TAIL, 1)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "place", "value")))
    joined = halves.groupBy("file", "number").agg(parts.alias("p")).select(
        "file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["place"].alias("place"),
        F.array_join(F.transform("p", lambda x: x["value"]), form.joint).alias("value"),
    )
    return whole.unionByName(joined)


def json_lines(spark: SparkSession, path: str | list[str], depth: int = 1) -> str:
    """Write the objects of JSON arrays one to a line; returns the folder. No JSON string has a line break."""
    folder = shared_folder(spark, "objects")
    split_records(spark, path, JsonObjects(depth)).select(F.translate("value", "\n\r", "  ").alias("value")).write.text(folder)
    return folder
