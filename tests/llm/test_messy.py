"""Odd rows through every stage of the pipeline: nulls, long texts, repeats, clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm.lines import without_common_lines
from clickloom.llm.tables import read, stage
from tests.conftest import SMALL

CLASHING = ("copy", "kept", "doc", "n_lines", "class", "root", "spans", "keep", "size", "target", "text_hash")
NULL_TEXT, EMPTY, LONG, BARE, TWICE = range(900_001, 900_006)


def prose(seed, n):
    rng = random.Random(seed)
    known = ("the house and water of a small river under old trees with many people who went there "
             "every year for work or food before winter came again").split()
    return " ".join(rng.choice(known) for _ in range(n))


@pytest.fixture(scope="module")
def stages(spark):
    docs = read(spark, SMALL, "documents").select(*corpus_pipeline.COLUMNS)
    rows = [
        (NULL_TEXT, None, "en", "a", None),
        (EMPTY, "", "en", "a", 0),
        (LONG, prose(1, 200_000), None, None, None),
        (BARE, prose(2, 80), None, None, None),
        (None, prose(3, 80), "en", "a", 1),
        (TWICE, prose(4, 80), "en", "a", 1),
        (TWICE, prose(4, 80), "en", "a", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    docs = stage(docs.withColumns({name: F.lit("x") for name in CLASHING}))
    out = {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL))
        out[name] = docs
    return out


def ids(df):
    return [r[0] for r in df.select("doc_id").collect()]


def test_columns_of_the_input_do_not_clash(stages):
    for name, after in stages.items():
        more = ["copy"] if name == "source_mixing" else []
        assert after.columns == [*corpus_pipeline.COLUMNS, *more]


def test_rows_without_text_go_first(stages):
    assert not {NULL_TEXT, EMPTY} & set(ids(stages["language_id"]))


def test_clean_rows_stay(stages):
    for name in list(stages)[:-1]:
        assert {LONG, BARE, None} <= set(ids(stages[name])), name


def test_repeated_rows_stay_once(stages):
    assert ids(stages["line_dedup"]).count(TWICE) == 2
    assert ids(stages["near_duplicates"]).count(TWICE) == 1


def test_long_text_is_whole(stages):
    row = stages["benchmark_decontamination"].where(F.col("doc_id") == LONG).first()
    assert row.text == prose(1, 200_000) and row.n_chars == len(row.text)
    assert row.lang is None and row.source is None


def test_empty_table(spark):
    docs = read(spark, SMALL, "documents").limit(0)
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL))
        assert docs.count() == 0, name
    assert docs.columns == [*corpus_pipeline.COLUMNS, "copy"]


def test_carried_names(spark):
    docs = spark.createDataFrame([(1, "a\nb", "k", None)], "doc_id long, text string, kept string, lang string")
    row = without_common_lines(docs, carry=("kept", "lang")).first()
    assert (row.kept, row.kept_carried, row.lang) == ("a\nb", "k", None)
