import random

import numpy as np
import pytest

import corpus_pipeline
from gradeloom.llm import shingles, simhash

from .conftest import prose


def plain_set(text):
    words = text.encode().lower().split()
    return {tuple(words[n:n + 5]) for n in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def changed(text, n, seed):
    rand, words = random.Random(seed), text.split()
    for at in rand.sample(range(len(words)), n):
        words[at] = f"new{rand.random()}"
    return " ".join(words)


def near_rows():
    rows = []
    for g in range(40):
        base = prose(500 + g, 60 + 9 * g)
        rows += [base] + [changed(base, n, g * 10 + n) for n in (1, 2, 3, 5, 8)]
    hot = prose(9000, 120)
    rows += [changed(hot, 1 + n % 5, 7000 + n) for n in range(100)] + ["one two", "One  two", "one two three", ""]
    return [(n, t) for n, t in enumerate(rows)]


def plain_components(rows):
    sets, group = [plain_set(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and jaccard(sets[i], sets[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    return {rows[i][0]: min(rows[k][0] for k in range(len(rows)) if group[k] == group[i]) for i in range(len(rows))}


@pytest.mark.parametrize("tile", [7, 256])
def test_components_of_all_pairs(documents, tile):
    rows = near_rows()
    found = {r.doc_id: r.component_id for r in shingles.near_copies(documents(rows), tile).collect()}
    assert found == plain_components(rows)


def test_stage_drops_copies_with_changed_words(spark, documents):
    rows = near_rows()
    kept = corpus_pipeline.near(spark, documents(rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain_components(rows).values()))


def test_stage_meets_the_texts_of_a_fingerprint_component(documents, monkeypatch):
    """With no other buckets, texts that fingerprints link are compared, and all shingles decide: one passage repeated
    with other words at its end is alike to SimHash, which counts repeats, but not as sets of shingles."""
    monkeypatch.setattr(shingles, "PASSES", ((0, 0), (0, 0)))
    base, passage = prose(70, 900), "heron lamp stone river copper " * 60
    texts = [base, changed(base, 1, 1), base.replace(" ", "\n"), prose(71, 90)] + [passage + f"end {n} is other" for n in range(3)]
    docs = documents(list(enumerate(texts)))
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert groups == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 4, 6: 4}
    assert jaccard(plain_set(texts[4]), plain_set(texts[5])) < 0.8 <= jaccard(plain_set(texts[0]), plain_set(texts[1]))
    assert sorted(r.doc_id for r in corpus_pipeline.near(docs.sparkSession, docs, "").collect()) == [0, 3, 4, 5, 6]


def test_fingerprint_buckets_are_the_components_of_near_duplicates(documents):
    rows = near_rows() + [(1000 + n, t.upper()) for n, t in near_rows()[:50]]
    docs, groups = documents(rows), {}
    for r in simhash.text_groups(docs.select(docs.doc_id.alias("key"), "text")).collect():
        groups.setdefault(r.bucket, []).append(r.key)
    assert {i: min(g) for g in groups.values() for i in g} == {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}


def test_links_are_exact():
    texts = [t for _, t in near_rows()]
    a, b = shingles.links_of([shingles.shingles(t) for t in texts])
    assert all(jaccard(plain_set(texts[i]), plain_set(texts[j])) >= 0.8 for i, j in zip(a, b, strict=True))
    assert len(np.unique(b)) == len(b)


def test_a_large_group_is_not_copied_by_its_square(spark):
    """A bucket of one large tree and one other text: each text is in a few cells, however large the tree."""
    rows = [(n, 0, 7) for n in range(3_000)] + [(9_999, 9_999, 7)] + [(n, n, 8) for n in (1, 2)]
    own = spark.createDataFrame(rows, "key long, tree long, bucket long")
    for cells in (shingles.first_cells(own, 50), shingles.all_cells(own, 50)):
        assert 3_000 <= cells.count() <= 3_400
    met = shingles.all_cells(own, 50).alias("a").join(shingles.all_cells(own, 50).alias("b"), "cell").filter("a.key = 9999").select("b.key").distinct()
    assert met.count() == 3_001  # the other text meets all


def test_texts_with_one_number_are_told_apart(documents, monkeypatch):
    """Different texts under the same 64-bit number: both stay."""
    rows = [(n, prose(40 + n, 60)) for n in range(6)] + [(9, prose(40, 60))]
    found = {r.doc_id: r.component_id for r in shingles.near_copies(documents(rows)).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 9: 0}
    whole = shingles.F.xxhash64
    monkeypatch.setattr(shingles.F, "xxhash64", lambda *c: shingles.F.lit(5).cast("long") if isinstance(c[0], str) and c[0] == "text" else whole(*c))
    found = {r.doc_id: r.component_id for r in shingles.near_copies(documents(rows)).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 9: 0}
