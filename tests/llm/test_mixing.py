import re
from collections import defaultdict

import pytest

from gradeloom.llm import mixing

from .conftest import prose


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_targets(sizes):
    """Targets by sharing the excess over and over."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weights = {s: n % 3 + 1 for n, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total > 3 * sizes[s]}
        if not full:
            for s in open_:
                target[s] = left * weights[s] / total
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def rows_of(messy):
    return [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a") for r in messy]


CASES = {
    "messy": None,
    "hot": [(n, prose(n, 3 + n % 50), "en", "hot" if n % 3 else f"s{n % 7}") for n in range(900)],
    "full": [(n, prose(n, 400 if n == 0 else 4), "en", "b" if n == 0 else "ac"[n % 2]) for n in range(40)],
    "wordless": [(1, None, "en", "a"), (2, "", "en", "b"), (3, "x", "en", "c")],
}


@pytest.mark.parametrize("case", CASES)
def test_targets_and_words_taken(documents, messy, case):
    rows = rows_of(messy) if CASES[case] is None else CASES[case]
    found = mixing.mixed(documents(rows)).collect()
    assert len(found) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += words(r[1])
    targets = expected_targets(sizes)
    wanted = sorted(repr((r[0], words(r[1]), sizes[r[3]], round(targets[r[3]], 6))) for r in rows)
    assert sorted(repr((r.doc_id, r["size"], r.source_size, round(r.target, 6))) for r in found) == wanted
    source = {(r[0], words(r[1])): r[3] for r in rows}
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id, r["size"]]] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 1, s


def test_only_one_document_of_a_source_is_cut(documents):
    found = mixing.mixed(documents(CASES["hot"])).collect()
    cut = [r for r in found if r["size"] and r.taken % r["size"]]
    assert len(cut) <= len({r[3] for r in CASES["hot"]})


def test_reruns_agree_in_any_partitioning(documents):
    docs = documents(CASES["hot"])
    one, two = ({(r.doc_id, r.taken) for r in mixing.mixed(d).collect()} for d in (docs, docs.repartition(7).orderBy("text")))
    assert one == two


def test_probabilities_hold_in_the_mean(documents, monkeypatch):
    docs, times = documents([(n, prose(n, 5 + n), "en", "ab"[n % 2]) for n in range(24)]), 12
    share = defaultdict(float)
    for seed in range(times):
        monkeypatch.setattr(mixing, "SEED", seed)
        for r in mixing.mixed(docs).collect():
            share[r.doc_id] += r.taken / r["size"] / times / (r.target / r.source_size)
    assert abs(sum(share.values()) / len(share) - 1) < 0.2 and len({round(s, 3) for s in share.values()}) > 3


def test_mixed_documents_have_the_words_taken(documents, messy):
    docs = documents(rows_of(messy))
    mix = mixing.mix_documents(docs)
    assert mix.columns == docs.columns
    got = defaultdict(int)
    for r in mix.collect():
        got[r.doc_id] += words(r.text)
    wanted = defaultdict(int)
    for r in mixing.mixed(docs).filter("doc_id is not null").collect():
        wanted[r.doc_id] += r.taken
    assert got == {d: n for d, n in wanted.items() if n}


SKEWED = [(n, prose(n, 4000 - n if n < 4 else 3 + n % 300), "en", "ab"[n % 2]) for n in range(700)]


@pytest.mark.parametrize("seed", range(3))
def test_whole_documents_come_near_the_target(documents, monkeypatch, seed):
    monkeypatch.setattr(mixing, "SEED", seed)
    docs = documents(SKEWED)
    found = mixing.mixed(docs, whole=True).collect()
    assert len(found) == len(SKEWED) and all(r.taken % r["size"] == 0 for r in found)
    taken, target = defaultdict(int), {}
    for r in found:
        taken["ab"[r.doc_id % 2]] += r.taken
        target["ab"[r.doc_id % 2]] = r.target
    for s in "ab":  # within the smallest documents, far below the largest ones of 4,000 words
        assert abs(taken[s] - target[s]) <= 60, (s, taken[s], target[s])


def test_whole_mix_has_only_whole_texts(documents):
    text = {r[0]: r[1] for r in SKEWED}
    docs = documents(SKEWED)
    got = defaultdict(int)
    for r in mixing.mix_documents(docs, whole=True).collect():
        assert r.text == text[r.doc_id]
        got[r.doc_id] += words(r.text)
    assert got == {r.doc_id: r.taken for r in mixing.mixed(docs, whole=True).collect() if r.taken}


def test_a_single_large_document_is_whole_or_absent(documents):
    rows = rows_of(CASES["full"])
    sizes = {r[0]: words(r[1]) for r in rows}
    assert all(r.taken % sizes[r.doc_id] == 0 for r in mixing.mixed(documents(rows), whole=True).collect())
    assert mixing.mix_documents(documents([]), whole=True).collect() == []


def test_empty_table(documents):
    assert mixing.mixed(documents([])).collect() == []
    assert mixing.mix_documents(documents([])).collect() == []
