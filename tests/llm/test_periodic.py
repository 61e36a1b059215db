import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from gradeloom.llm import periodic


def brute_runs(words, exponent, length):
    """All runs by trying every period from every start."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        s = 0
        while s + p < n:
            if words[s] != words[s + p]:
                s += 1
                continue
            e = s
            while e + p < n and words[e] == words[e + p]:
                e += 1
            size = e + p - s
            if size >= max(length, exponent * p):
                found.setdefault((s, size), p)  # the smallest period comes first
            s = e + 1
    return sorted((s, size, p) for (s, size), p in found.items())


def texts():
    rand = random.Random(5)
    out = [[], [0], [0] * 2, [0] * 5, [0] * 400, [0] * 100 + [1] + [0] * 100, ([0] * 7 + [1]) * 30, [0, 1, 0] * 50 + [0, 1] * 40]
    for n in range(150):
        size, letters = rand.randrange(1, 160), rand.choice([1, 2, 2, 3, 30])
        words = [rand.randrange(letters) for _ in range(size)]
        for _ in range(rand.randrange(3)):  # repeat parts, parts of parts too
            a = rand.randrange(len(words))
            part = words[a:a + rand.randrange(1, 40)]
            words = words[:a] + part * rand.randrange(1, 7) + part[: rand.randrange(len(part))] + words[a:]
        out.append(words)
    return out


@pytest.mark.parametrize(("exponent", "length"), [(2, 2), (3, 24), (3, 1), (2, 10), (5, 24)])
def test_catcher_finds_all_runs(exponent, length):
    for words in texts():
        catcher = periodic.SquareCatcher(exponent, length)
        catcher.append(np.array(words, dtype=np.int64))
        assert list(zip(*(x.tolist() for x in catcher.finish()), strict=True)) == brute_runs(words, exponent, length), words


def test_words_may_come_one_at_a_time():
    rand = random.Random(8)
    for words in texts():
        whole, pieces = periodic.SquareCatcher(3, 6), periodic.SquareCatcher(3, 6)
        whole.append(np.array(words, dtype=np.int64))
        at = 0
        while at < len(words):
            size = rand.choice([1, 1, 2, 5, 40])
            pieces.append(np.array(words[at:at + size], dtype=np.int64))
            at += size
        assert [x.tolist() for x in whole.finish()] == [x.tolist() for x in pieces.finish()]


def test_runs_are_known_while_words_come():
    catcher = periodic.SquareCatcher(3, 24)
    for n in range(2000):
        catcher.append(np.array([n % 5]))
    assert (catcher.start.tolist(), catcher.end.tolist(), catcher.period.tolist()) == ([0], [2000], [5])


def test_long_streams_take_little_time():
    """Two long runs of one word, and a long period: quadratic work would not end."""
    words = np.r_[np.zeros(300_000), [1], np.zeros(300_000), np.tile(np.arange(70_000), 4)].astype(np.int64)
    catcher = periodic.SquareCatcher(3, 24)
    catcher.append(words)
    start, length, period = catcher.finish()
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0, 300_001, 600_001], [300_000, 300_001, 280_000], [1, 1, 70_000])


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    words = periodic.loop_some(doc_id, words)
    runs = brute_runs(words, 3, 24)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    keep = [True] * len(words)
    for s, size, p in runs:
        for i in range(s + p, s + size):
            keep[i] = False
    kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
    lines = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def order(rows):
    return sorted(rows, key=str)


def test_rows_against_brute_force(documents, messy):
    rand = random.Random(3)
    rows = [r for r in messy if len(r[1] or "") < 20_000]
    rows += [(1000 + n, " ".join(rand.choice("ab") for _ in range(rand.randrange(300)))) for n in range(60)]
    rows += [(2000, "  one\ttwo \x1c three\x85four " * 30), (2001, "x " * 500), (None, "y z " * 40)]
    found = periodic.summarised(documents(rows))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert dict(found.dtypes)["n_runs"] == "bigint"
    assert order(map(tuple, found.collect())) == order(brute_row(r[0], r[1]) for r in rows)


def test_collapsed_text_and_empty_table(documents):
    found = periodic.periodic(documents([(1, "start " + "go on " * 20 + "end"), (2, None)])).collect()
    assert sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found) == [(1, 42, [(1, 40, 2)], "start go on end"), (2, 0, [], "")]
    assert periodic.summarised(documents([])).collect() == []


def test_given_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 4_000]
    found = {r.doc_id: tuple(r) for r in periodic.summarised(docs).collect()}
    assert len(found) == docs.count()
    for doc_id, text in rows:
        assert found[doc_id] == brute_row(doc_id, text)
    assert any(found[r[0]][1] for r in rows)
