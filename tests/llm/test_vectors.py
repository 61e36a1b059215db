import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import gnat, pivots, queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, row string, part int, score long, v string"


def table(spark, rows):
    """Rows with columns that are named like those the operators make."""
    return spark.createDataFrame([(*r, "row", 1, 2, "v") for r in rows], SCHEMA)


def vector_rows(seed, n, dim=6, spread=1.0):
    rand = random.Random(seed)
    centres = [[rand.gauss(0, 1) for _ in range(dim)] for _ in range(7)]
    rows = []
    for i in range(n):
        centre = rand.choice(centres)
        rows.append((i, [c + spread * rand.gauss(0, 0.4) for c in centre], rand.randrange(4)))
    return rows


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls in every column, components that aren't finite, copies, ties, repeated and short vectors."""
    rows = vector_rows(1, 420)
    same = rows[100][1]
    rows += [(500 + n, same, n % 3) for n in range(150)]  # a hot group, as queries too
    rows += [(100, same, 1), (100, same, 1), (None, same, 2), (None, rows[3][1], 0), (None, None, None)]
    rows += [(800, None, 1), (801, [1.0, None, 0.5], 1), (900, [float("nan")] * 6, 2), (1000, [float("inf"), 1.0], 0), (1100, [3e30] * 6, 1)]
    rows += [(1200, [], 1), (1300, [0.25, -0.5], 2), (1400, [0.0] * 6, None), (-100, [-1.5, 2.0, 0.1, 0.0, 0.3, 1.0], 3), (2**62, same, 3)]
    return rows


def whole(row, scale):
    if row[1] is None or any(x is None or not math.isfinite(x) for x in row[1]):
        return None
    v = [math.floor(scale * float(np.float32(x))) for x in row[1]]
    return v if sum(x * x for x in v) < 2**62 else None


def known(rows, scale):
    return [(n, r[0], v, r[2]) for n, r in enumerate(rows) if (v := whole(r, scale)) is not None]


def product(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def first(found, k):
    """Highest scores, ties to the smaller id, rows without one last."""
    return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0] or 0))[:k]


def brute_top(rows, k, each, scale):
    rows, out = known(rows, scale), []
    for n, q, v, _ in rows:
        if q is not None and q % each == 0:
            found = first([(i, product(v, u)) for m, i, u, _ in rows if m != n], k)
            out += [(q, rank + 1, i, s) for rank, (i, s) in enumerate(found)]
    return out


def brute_negatives(rows, each, scale):
    rows, out = [r for r in known(rows, scale) if r[3] is not None], []
    for n, q, v, label in rows:
        if q is not None and q % each == 0:
            scored = [(i, product(v, u), other) for m, i, u, other in rows if m != n]
            for p, ps in first([(i, s) for i, s, other in scored if other == label], 5):
                found = first([(i, s) for i, s, other in scored if other != label and 80 * ps <= 100 * s <= 100 * ps], 5)
                out += [(q, p, rank + 1, i, ps, s) for rank, (i, s) in enumerate(found)]
    return out


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_top_k_against_brute_force(spark, odd_rows):
    found = pivots.top_k(table(spark, odd_rows), F.col("vec_id") % 100 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert order(found.collect()) == order(brute_top(odd_rows, 10, 100, 1024))


@pytest.mark.parametrize("seed", [2, 3])
def test_top_k_with_few_pivots_and_many_queries(spark, monkeypatch, seed):
    monkeypatch.setattr(vectors, "QUERIES", 40)  # several blocks of queries
    rows = vector_rows(seed, 600, spread=0.1)
    found = pivots.top_k(table(spark, rows).repartition(5), F.col("vec_id") % 7 == 0, k=4, scale=50, pivots=5)
    assert order(found.collect()) == order(brute_top(rows, 4, 7, 50))


def test_hard_negatives_against_brute_force(spark, odd_rows):
    found = gnat.hard_negatives(table(spark, odd_rows), F.col("vec_id") % 100 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert order(found.collect()) == order(brute_negatives(odd_rows, 100, 256))


def test_hard_negatives_with_many_anchors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERIES", 60)
    rows = vector_rows(4, 700, dim=3, spread=0.2)
    found = gnat.hard_negatives(table(spark, rows).repartition(5), F.col("vec_id") % 5 == 0)
    assert order(found.collect()) == order(brute_negatives(rows, 5, 256))


def test_empty_and_single(spark):
    for rows in ([], [(0, [1.0, 2.0], 1)], [(100, None, 1)], [(3, [1.0], 1)]):
        assert pivots.top_k(table(spark, rows), F.col("vec_id") % 100 == 0).collect() == []
        assert gnat.hard_negatives(table(spark, rows), F.col("vec_id") % 100 == 0).collect() == []


def test_large_components_are_exact(spark):
    rows = [(i, [2.0**20 + i, 2.0**19 - i, 1.0], i % 2) for i in range(0, 400, 50)]
    assert order(pivots.top_k(table(spark, rows), F.col("vec_id") % 100 == 0).collect()) == order(brute_top(rows, 10, 100, 1024))


def test_annuli_are_passed_over(spark):
    """Most rows of clustered data are never compared, and bounds never exclude a row."""
    rows = known(vector_rows(6, 2000, spread=0.05), 1024)
    ints = np.array([v for _, _, v, _ in rows])
    space = vectors.Space(6, float((ints**2).sum(axis=1).max()))
    places = space.rows(ints)
    queries_at = space.queries(ints[::100])
    true = vectors.distances(queries_at, places)
    near = space.reach((ints[::100].astype(float) ** 2).sum(axis=1), np.sort(vectors.scores(ints[::100], ints), axis=1)[:, -11])
    centres = pivots.pivots_of(places[:500], 32)
    apart = vectors.distances(places, centres)
    lower = np.abs(vectors.distances(queries_at, centres)[:, apart.argmin(axis=1)] - apart.min(axis=1))
    assert (lower <= true + space.slack).all()
    assert (lower <= near[:, None]).mean() < 0.5
    tree = gnat.grow(places[:500], leaf=16)
    leaf = np.zeros(len(places), dtype=int)
    for node, own, apart, child in tree.route(places):
        below = tree.children[node][child]
        leaf[own] = np.where(below < 0, ~below, -1)
        for j in np.unique(child):
            tree.low[node][:, j], tree.high[node][:, j] = apart[child == j].min(axis=0), apart[child == j].max(axis=0)
    least, most, _ = tree.limits(queries_at)
    assert (least[:, leaf] <= true + space.slack).all() and (most[:, leaf] >= true - space.slack).all()
    assert (least[:, leaf] <= near[:, None]).mean() < 0.5


def test_given_tables(spark, tables):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    assert order(queries.op11_topk_search(spark, tables).collect()) == order(brute_top(rows, 10, 100, 1024))
    moved = [(i, e, (y + 1) % 10 if i is not None and y is not None and i % 7 == 0 else y) for i, e, y in rows]
    assert order(queries.op13_hard_negatives(spark, tables).collect()) == order(brute_negatives(moved, 100, 256))
