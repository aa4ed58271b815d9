import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm.lines import without_common_lines

SCHEMA = "doc_id long, text string, keep string, doc string"


def brute(rows, min_docs, min_chars=1):
    where = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").encode().lower().split(b"\n"):
            where[line.strip()].add((doc_id, text))
    out = []
    for doc_id, text in rows:
        lines = (text or "").encode().split(b"\n")
        left = [
            line for line in lines
            if len(line.lower().strip().decode()) < min_chars or len(where[line.lower().strip()]) < min_docs
        ]
        out.append((doc_id, len(lines), len(lines) - len(left), b"\n".join(left).decode()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    got = without_common_lines(frame, **options).select("doc_id", "n_lines", "n_dropped", "kept")
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("min_docs, min_chars", [(2, 1), (4, 1), (10, 1), (3, 3)])
def test_against_brute_force(spark, min_docs, min_chars):
    rng = random.Random(min_docs)
    pool = [f" Line {k % 23}\t" for k in range(60)] + ["", "  ", "é", "É", "ab", "x\r"]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 12)))) for k in range(60)]
    rows += [(100 + k, "hot\nhot\n" + str(k)) for k in range(80)]
    assert run(spark, rows, min_docs=min_docs, min_chars=min_chars) == brute(rows, min_docs, min_chars)


def test_edges(spark):
    long = "\n".join(f"line {k}" for k in range(50_000)) + "\nsame"
    rows = [(1, None), (2, ""), (3, "same"), (4, "SAME \n"), (4, "SAME \n"), (None, "same"), (6, long), (7, "a" * 300_000)]
    assert run(spark, rows, min_docs=4) == brute(rows, 4)
    assert run(spark, rows, min_docs=3) == brute(rows, 3)
    assert run(spark, [], min_docs=2) == []


def test_same_id_other_text(spark):
    rows = [(1, "a\nb"), (1, "b\na"), (2, "a")]
    assert run(spark, rows, min_docs=3) == brute(rows, 3)


def test_carried_columns(spark):
    frame = spark.createDataFrame([(1, "a", "k", "d"), (2, None, None, "e")], SCHEMA)
    got = without_common_lines(frame, min_docs=2, carry=("keep",)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.kept, r["carried.keep"] if "carried.keep" in r else r[-1]) for r in got] == [(1, "a", "k"), (2, "", None)]


def test_digest_of_the_text(spark):
    frame = spark.createDataFrame([(1, "a\né", "", "")], SCHEMA)
    row = without_common_lines(frame).select(F.sha2("kept", 256).alias("h")).first()
    assert row.h == hashlib.sha256("a\né".encode()).hexdigest()
