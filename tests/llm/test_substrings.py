import random

import pytest

from clickloom.llm.substrings import without_repeats

SCHEMA = "doc_id long, text string, hash string, runs string"


def brute(rows, window):
    least = {}
    cut = [(d, (t or "").encode().split()) for d, t in rows]
    for doc, words in cut:
        for k in range(len(words) - window + 1):
            if doc is not None:
                key = tuple(words[k : k + window])
                least[key] = min(doc, least.get(key, doc))
    out = []
    for doc, words in cut:
        gone = set()
        for k in range(len(words) - window + 1):
            if doc is not None and least[tuple(words[k : k + window])] < doc:
                gone.update(range(k, k + window))
        left = [w for k, w in enumerate(words) if k not in gone]
        out.append((doc, len(words), len(gone), b" ".join(left).decode()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    got = without_repeats(frame, **options).select("doc_id", "n_words", "n_removed", "kept")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def documents(seed):
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(6)}" for _ in range(rng.randrange(0, 60))]
        if k % 3 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[rng.randrange(10) : rng.randrange(15, 30)]
        rows.append((k, rng.choice([" ", "\n", "\t "]).join(words)))
    return rows + [(100 + k, "same text again and again and again") for k in range(40)]


@pytest.mark.parametrize("hot_rows, filter_bits", [(200_000, 26), (5, 26), (5, 10), (1, 9)])
def test_against_brute_force(spark, hot_rows, filter_bits):
    rows = documents(hot_rows)
    assert run(spark, rows, window=5, m=2, hot_rows=hot_rows, filter_bits=filter_bits) == brute(rows, 5)


def test_production_window(spark):
    rows = documents(9)
    assert run(spark, rows) == brute(rows, 13)


def test_edges(spark):
    long = " ".join(f"v{k}" for k in range(60_000))
    one = "w " * 30_000
    rows = [(1, None), (2, ""), (3, "a b"), (4, long), (5, "x " + long), (6, one), (7, one), (None, long),
            (8, "a b c d e f g h i j k l m"), (8, "a b c d e f g h i j k l m"), (9, "\n\t ")]
    assert run(spark, rows) == brute(rows, 13)
    assert run(spark, []) == []


def test_same_id_other_text(spark):
    rows = [(1, "a b c d e"), (2, "x a b c d e"), (2, "q r s t u v w x y z")]
    assert run(spark, rows, window=4, m=2) == brute(rows, 4)
