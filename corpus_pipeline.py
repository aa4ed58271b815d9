"""A corpus from raw documents: five stages, each written and read again before the next.

Every stage works on all rows that the one before has kept, judges them against each other, and
returns the columns of ``documents``; the last one returns the mix, a document as often as it is
taken, with the number of the copy in ``copy``.

Defined results, for every stage: a null id or source is a value like any other; rows that agree in
id and text are judged alike, and stage 3 leaves one of them; texts of any length are judged whole;
an empty table gives an empty one. Columns beyond those of ``documents``, whatever their names, are
left out. Null and empty texts go at stage 1, as they are in no language; in a later stage alone
they would stay: they have no shingles, hold no benchmark window and add no words to the mix. Ties:
of near copies the smallest id stays, nulls last, then the smaller hash of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm.decontaminate import decontaminated
from clickloom.llm.jaccard import one_of_each
from clickloom.llm.language import in_known_language
from clickloom.llm.lines import without_common_lines
from clickloom.llm.mixing import mixture
from clickloom.llm.tables import read, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; ``lang`` is left as it came."""
    return in_known_language(docs).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents share; ``n_chars`` follows the text. A
    document that has nothing but such lines stays, with an empty text."""
    kept = without_common_lines(docs.select(*COLUMNS), carry=("lang", "source"))
    return kept.select(
        "doc_id", F.col("kept").alias("text"), "lang", "source",
        F.char_length("kept").cast("bigint").alias("n_chars"),
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, at five words and a similarity of 0.8."""
    return one_of_each(docs, n=5, percent=80).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminated(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight."""
    return mixture(docs).select(*COLUMNS, "copy")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# Languages come from a fitted model and the mix from a hash that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
