import hashlib
import string

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gradeloom.llm import exact_dedup, simhash
from gradeloom.llm.fuse import FuseFilter

from .conftest import prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def low(text):
    return (text or "").translate(LOWER)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 20_000])
def test_fuse_filter_has_no_false_negatives(n):
    rand = np.random.default_rng(n)
    keys = rand.integers(0, 2**64, n, dtype=np.uint64)
    made = FuseFilter.build(np.concatenate([keys, keys]))
    assert made.may_hold(keys).all()
    assert made.may_hold(rand.integers(0, 2**64, 50_000, dtype=np.uint64)).mean() < 0.01


def expected_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(low(r[1]), []).append(r[0])
    out, seen = [], set()
    for r in rows:
        ids = [i for i in groups[low(r[1])] if i is not None]
        keep = max(ids) if ids else None
        first = (r[0], low(r[1])) not in seen
        seen.add((r[0], low(r[1])))
        out.append((r[0], keep, len(groups[low(r[1])]), r[0] == keep and first, hashlib.sha256(low(r[1]).encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("incoming", ["doc_id % 2 = 0", "true", "false", "doc_id > 8"])
def test_exact_duplicates(documents, messy, incoming):
    found = exact_dedup.exact_duplicates(documents(messy), F.expr(incoming))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected_exact(messy)


def test_exact_duplicates_with_few_keys_a_shard(documents, messy, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD_KEYS", 5)
    found = exact_dedup.exact_duplicates(documents(messy), F.expr("doc_id % 3 = 0"))
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected_exact(messy)


def test_dropped_exact_duplicates_keep_columns(documents, messy):
    docs = documents(messy)
    kept = exact_dedup.drop_exact_duplicates(docs, F.expr("doc_id % 2 = 0"))
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    wanted = {max(r[0] for r in messy if r[0] is not None and low(r[1]) == text) for text in {low(r[1]) for r in messy if r[0] is not None}}
    assert sorted(i for i in ids if i is not None) == sorted(wanted)
    assert sum(i is None for i in ids) == 2


def test_empty_tables(documents):
    assert exact_dedup.exact_duplicates(documents([]), F.expr("doc_id % 2 = 0")).collect() == []
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.drop_near_duplicates(documents([])).collect() == []


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[n:n + 4]) for n in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids):
    """Smallest id reachable by links of four bits or fewer."""
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    low_id = {g: min((ids[n] for n in range(len(ids)) if group[n] == g and ids[n] is not None), default=None) for g in group}
    return [low_id[g] for g in group]


def test_near_duplicates(documents, messy):
    found = simhash.near_duplicates(documents(messy))
    fps = [brute_fingerprint(r[1]) for r in messy]
    roots = brute_components(fps, [r[0] for r in messy])
    wanted = sorted(repr((r[0], f"{fp:016x}", root)) for r, fp, root in zip(messy, fps, roots, strict=True))
    assert sorted(repr(tuple(r)) for r in found.collect()) == wanted


@pytest.mark.parametrize("tile", [2, 50, 10_000])
def test_links_of_close_fingerprints_in_any_tiling(spark, tile):
    rand = np.random.default_rng(tile)
    base = rand.integers(0, 2**64, 6, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for _ in range(60):  # chains of links, up to five bits each
            for bit in rand.choice(64, rand.integers(1, 6), replace=False):
                b ^= 1 << int(bit)
            fps.add(b)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    edges = simhash.links(df, tile=tile).collect()
    ids = {int(np.uint64(f).view(np.int64)): n for n, f in enumerate(fps)}
    assert all((r.a != r.b) for r in edges)
    got = simhash.roots(np.array([ids[r.a] for r in edges], dtype=int), np.array([ids[r.b] for r in edges], dtype=int), len(fps))
    assert got.tolist() == brute_components(fps, list(range(len(fps))))


def test_components_of_long_chains(spark):
    rand = np.random.default_rng(5)
    nodes = rand.permutation(400).tolist()
    edges = [(nodes[n], nodes[n + 1]) for n in range(399) if n % 50]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = simhash.roots(np.array([e[0] for e in edges]), np.array([e[1] for e in edges]), 400)
    assert found == {n: int(root[n]) for n in range(400) if root[n] != n}


def test_one_of_each_near_group_stays(documents, messy):
    docs = documents(messy)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    fps = [brute_fingerprint(r[1]) for r in messy]
    roots = brute_components(fps, [r[0] for r in messy])
    named = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(named) == sorted({r for r in roots if r is not None})


def test_hot_group_of_copies(documents):
    rows = [(n, prose(9999, 60) if n % 3 == 0 else prose(n, 60)) for n in range(300)]
    found = {r.doc_id: r for r in exact_dedup.exact_duplicates(documents(rows), F.expr("doc_id % 5 = 0")).collect()}
    assert found[0].group_size == 100 and found[297].kept and sum(r.kept for r in found.values()) == 201
    assert {r.component_id for r in simhash.near_duplicates(documents(rows)).collect() if r.doc_id % 3 == 0} == {0}
