import re

import pytest

import corpus_pipeline
from clickloom.llm import language
from clickloom.llm.tables import read, stage
from tests.conftest import SMALL
from tests.llm.test_decontaminate import words as benchmark_words
from tests.llm.test_jaccard import brute as brute_groups
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_mixing import shared


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage got and what it returned."""
    docs, out = read(spark, SMALL, "documents"), []
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, SMALL))
        out.append((name, docs, after))
        docs = after
    return {name: (before.collect(), after) for name, before, after in out}


def test_columns(spark, stages):
    columns = read(spark, SMALL, "documents").columns
    for name, (_, after) in stages.items():
        assert after.columns == (columns if name != "source_mixing" else [*columns, "copy"])
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)


def test_language_stage_drops_texts_without_language(stages):
    before, after = stages["language_id"]
    kept = {r.doc_id for r in after.collect()}
    assert kept == {r.doc_id for r in before if re.search(r"[^\W\d_]", r.text or "")}


def test_line_stage(stages):
    before, after = stages["line_dedup"]
    want = brute_lines([(r.doc_id, r.text) for r in before], 10)
    assert sorted((r.doc_id, r.text) for r in after.collect()) == sorted((w[0], w[3]) for w in want)
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    want = {d for d, _, root in brute_groups([(r.doc_id, r.text) for r in before], 5, 80) if d == root}
    assert {r.doc_id for r in after.collect()} == want


def test_decontamination_stage(spark, stages):
    before, after = stages["benchmark_decontamination"]
    phrases = set()
    for r in read(spark, SMALL, "benchmark").collect():
        own = benchmark_words(r.text)
        n = min(10, len(own))
        phrases |= {tuple(own[k : k + n]) for k in range(len(own) - n + 1) if n}
    lengths = {len(p) for p in phrases}

    def clean(text):
        own = benchmark_words(text)
        return not any(tuple(own[k : k + n]) in phrases for n in lengths for k in range(len(own) - n + 1))

    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before if clean(r.text)}


def test_mixing_stage(stages):
    before, after = stages["source_mixing"]
    sizes, most = {}, {}
    for r in before:
        n = len((r.text or "").encode().split())
        sizes[r.source] = sizes.get(r.source, 0) + n
        most[r.source] = max(most.get(r.source, 0), n)
    target = shared(sizes, (5, 2, 1), 3)
    taken = dict.fromkeys(sizes, 0)
    for r in after.collect():
        taken[r.source] += len((r.text or "").encode().split())
    assert all(abs(taken[s] - target[s]) <= most[s] for s in sizes)


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["source_mixing"][1].collect()))


def test_language_does_not_read_labels(spark):
    docs = read(spark, SMALL, "documents")
    model = language.train(docs)
    plain = language.identify(docs, model).collect()
    blind = language.identify(docs.drop("lang", "source"), model).collect()
    assert sorted(plain) == sorted(blind)
