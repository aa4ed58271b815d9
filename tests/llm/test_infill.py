import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from clickloom.llm import infill

SCHEMA = "doc_id long, text string, output string, form string, h1 string, n double"


def by_hand(doc_id, text, transformed=90, suffix_first=20):
    """One document after the other, with regular expressions and slices."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(parts)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= transformed:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < suffix_first:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "o", "plain", "h", 2.0) for i, t in rows], SCHEMA)


def compare(spark, rows, **options):
    found = infill.unfilled(infill.filled(frame(spark, rows), **options)).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in found), key=repr)
    want = sorted(((i, *by_hand(i, t, **options), t or "") for i, t in rows), key=repr)
    assert got == want
    return [r[2] for r in got]


@pytest.mark.parametrize("seed", range(3))
def test_equals_one_by_one(spark, seed):
    """Texts full of half marks, separators and characters of every width."""
    rng = random.Random(seed)
    bits = ["<", ">", "P", "S", "M", "<S", "S>", "\x00", "A", "\x00A", "A\x00", "é", "日", "😀", "\n", " ", "word", "\r\n", "\\1", ""]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randrange(40)))) for k in range(400)]
    forms = compare(spark, rows)
    assert {"plain", "psm", "spm"} == set(forms)


def test_edges(spark):
    long = "some words, and é <P " * 60_000
    rows = [(1, None), (2, ""), (3, "<M>"), (4, "a <S> b"), (5, long), (5, long), (None, "no id"), (6, "\x00A\x00"), (7, "x"), (-8, "minus")]
    compare(spark, rows)
    assert infill.filled(frame(spark, rows).limit(0)).count() == 0


def test_parameters(spark):
    rows = [(k, f"text number {k}, not long") for k in range(60)]
    assert set(compare(spark, rows, transformed=0)) == {"plain"}
    assert set(compare(spark, rows, transformed=100, suffix_first=100)) == {"spm"}
    assert set(compare(spark, rows, transformed=100, suffix_first=0)) == {"psm"}


def test_no_shuffle(spark):
    plan = infill.filled(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_given_documents_come_back(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = infill.op11_fill_in_middle(spark, sf_dir).alias("f").join(docs.alias("d"), "doc_id")
    same = F.sha2(F.col("d.text").cast("binary"), 256) == F.col("restored_sha256")
    assert found.count() == docs.count() and found.where(~same).count() == 0
