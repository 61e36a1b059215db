"""The whole pipeline beside a plain version of each stage, and the registration of its queries."""

import re
from collections import defaultdict

import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from catalog import registry
from catalog.compare import oracle_rows, spark_rows
from gradeloom.llm import queries
from gradeloom.llm.common import slices
from gradeloom.llm.queries import vocabulary
from gradeloom.session import cut_lineage

from .conftest import prose
from .test_dedup import low
from .test_mixing import expected_targets, rows_of, words
from .test_shingles import plain_components

tokenizers = pytest.importorskip("tokenizers")


def test_stages_beside_plain_versions(spark, documents, messy, tmp_path):
    docs = documents(rows_of(messy))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "simhash_dedup", "source_mixing", "bpe"]

    def step(name, before):
        after = cut_lineage(stages[name](spark, before, str(tmp_path)))
        if name != "bpe":
            assert after.columns == docs.columns
        return after

    told = step("language_id", docs)
    have_letters = [r for r in rows_of(messy) if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(repr((r.doc_id, r.text)) for r in told.collect()) == sorted(repr(r[:2]) for r in have_letters)

    exact = step("exact_dedup", told)
    best = {}
    for r in have_letters:
        if r[0] is not None:
            best[low(r[1])] = max(r[0], best.get(low(r[1]), r[0]))
    named = [r for r in exact.collect() if r.doc_id is not None]
    assert sorted((r.doc_id, low(r.text)) for r in named) == sorted((i, t) for t, i in best.items())

    near = step("simhash_dedup", exact)
    roots = plain_components([(r.doc_id, r.text) for r in exact.collect() if r.doc_id is not None])
    assert sorted(r.doc_id for r in near.collect() if r.doc_id is not None) == sorted(set(roots.values()))

    mix = step("source_mixing", near)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in near.collect():
        sizes[r.source] += words(r.text)
    nameless = {r.source for r in near.collect() if r.doc_id is None}
    for r in mix.collect():
        taken[r.source] += words(r.text)
    for source, target in expected_targets(sizes).items():
        assert abs(taken[source] - target) <= 1 or source in nameless

    tool = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    encoded = step("bpe", mix).collect()
    assert sorted(repr((r.doc_id, list(r.ids), r.exact)) for r in encoded) == sorted(
        repr((r.doc_id, tool.encode(r.text, add_special_tokens=False).ids, True)) for r in mix.collect()
    )


def test_stages_take_empty_tables(spark, documents, tmp_path):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, str(tmp_path)))
    assert docs.collect() == []


def test_run_of_the_tables(spark, tables):
    found = corpus_pipeline.run(spark, tables)
    assert found.columns == ["doc_id", "source", "lang", "ids", "exact"]
    assert found.count() > 0 and found.filter("not exact").count() == 0


def test_every_operator_has_one_query():
    numbers = sorted(int(m[1]) for n in entry.queries() if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.ORACLES) <= set(queries.QUERIES) and set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, tables, name, monkeypatch):
    monkeypatch.setitem(registry.QUERIES, name, queries.QUERIES[name])
    monkeypatch.setitem(registry.ORACLES, name, queries.ORACLES[name])
    assert spark_rows(spark, name, tables) == oracle_rows(name, tables)


def test_duplicate_stages_keep_texts_that_are_no_copies(spark, documents, tmp_path):
    """Two texts of one doc_id, rows without a doc_id, and no language to be learnt lose nothing."""
    rows = [(1, prose(1, 80)), (1, prose(2, 80)), (2, prose(3, 80)), (2, prose(3, 80)), (3, prose(4, 80)), (None, prose(5, 80)), (4, prose(4, 80))]
    docs = documents([(i, t, None, "a") for i, t in rows])
    told = corpus_pipeline.language(spark, docs, str(tmp_path))
    assert told.count() == len(rows)
    exact = cut_lineage(corpus_pipeline.exact(spark, told, str(tmp_path)))
    wanted = [(1, prose(1, 80)), (1, prose(2, 80)), (2, prose(3, 80)), (None, prose(5, 80)), (4, prose(4, 80))]
    assert sorted(((r.doc_id, r.text) for r in exact.collect()), key=str) == sorted(wanted, key=str)
    near = corpus_pipeline.near(spark, exact, str(tmp_path))
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op5_token_counts"}))
def test_query_has_a_row_for_each_document(spark, tables, name):
    assert queries.QUERIES[name](spark, tables).count() == spark.read.parquet(f"{tables}/documents.parquet").count()


def test_stages_get_small_batches(spark, documents):
    """The JVM and a Python worker both hold a batch: 1,000 texts at most, of which 500 are strings at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    kept = spark.conf.get(name)
    try:
        spark.conf.set(name, "0")  # no limit
        rows = [(n, f"heron {n} lamp") for n in range(2_300)]
        found = corpus_pipeline.encode(spark, documents(rows).coalesce(1), "").collect()
        assert spark.conf.get(name) == "1000"
        assert sorted(r.doc_id for r in found) == list(range(2_300)) and all(r.exact and r.ids for r in found)
        spark.conf.set(name, "70")
        corpus_pipeline.encode(spark, documents(rows[:1]), "")
        assert spark.conf.get(name) == "70"
    finally:
        spark.conf.set(name, kept)
    batch = pa.RecordBatch.from_pydict({"n": list(range(7))})
    assert [s.column("n").to_pylist() for s in slices(batch, 3)] == [[0, 1, 2], [3, 4, 5], [6]]
