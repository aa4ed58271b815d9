import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import periodic

SCHEMA = "doc_id long, text string, runs string, n_words double, start string"


def by_hand(words, min_length=6, exponent=4):
    """All runs by trying every period at every place."""
    found, taken = [], set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, exponent * q) and (i, length) not in taken:
                # A stretch with a smaller period has been found with that one.
                taken.add((i, length))
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1.0, "s") for i, t in rows], SCHEMA)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def compare(spark, rows, **options):
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
           for r in periodic.periodic_runs(frame(spark, rows), **options).collect()]
    want = []
    for i, text in rows:
        words = split(text)
        runs = by_hand(words, **options)
        want.append((i, len(words), runs, without_repeats(words, runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return want


def words_of(rng, letters, size):
    """Random words with repetitions of repetitions in them."""
    words = [rng.choice(letters) for _ in range(rng.randrange(size))]
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(words) + 1)
        part = words[at : at + rng.randrange(1, 9)]
        words[at:at] = (part * rng.randrange(1, 9))[: rng.randrange(1, 60)]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(k, " ".join(words_of(rng, "abcdefgh"[: rng.randrange(1, 9)], 60))) for k in range(300)]
    want = compare(spark, rows)
    assert sum(len(r[2]) for r in want) > 100


@pytest.mark.parametrize(("min_length", "exponent"), [(2, 2), (4, 2), (6, 3), (10, 5)])
def test_other_bounds(spark, min_length, exponent):
    rng = random.Random(min_length)
    rows = [(k, " ".join(words_of(rng, "abc", 40))) for k in range(100)]
    compare(spark, rows, min_length=min_length, exponent=exponent)


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "a a a a a"), (5, "a a a a a a"), (6, "a\x0ba a\ra a\n a"),
        (7, "a b " * 4), (7, "a b " * 4), (None, "x " * 9), (8, "é 日 😀 " * 5), (9, "a b " * 8),
        (10, "one two " * 3 + "one " + "three " * 20 + "four"),
    ]
    compare(spark, rows)
    assert periodic.periodic_runs(frame(spark, rows).limit(0)).count() == 0


def test_long_text(spark):
    """Some 100,000 words: one word over and over, and a long period."""
    period = " ".join(f"w{k}" for k in range(9_000))
    rows = [(1, "same " * 100_000), (2, (period + " ") * 5 + "end"), (3, "a b a a b " * 12_000)]
    got = {r.doc_id: r for r in periodic.periodic_runs(frame(spark, rows)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 100_000, 1)] and got[1].collapsed == "same"
    assert [tuple(x) for x in got[2].runs] == [(0, 45_000, 9_000)] and got[2].collapsed == period + " end"
    assert [tuple(x) for x in got[3].runs] == [(0, 60_000, 5)]


def test_ties_of_the_longest(spark):
    rows = [(1, "a a a a a a x b b b b b b"), (2, "x y")]
    found = periodic.periodic_runs(frame(spark, rows)).select("doc_id", periodic.longest(F.col("runs")).alias("b"))
    assert {r.doc_id: r.b and tuple(r.b) for r in found.collect()} == {1: (0, 6, 1), 2: None}


def test_texts_do_not_mix():
    """The same word on both sides of the border of two texts."""
    words, first = np.zeros(7, np.int64), np.array([0, 3, 7])
    assert len(periodic.find_runs(words, first)) == 0
    assert periodic.find_runs(words, first, min_length=3, exponent=2).tolist() == [[0, 0, 3, 1], [1, 0, 4, 1]]


def test_planted_periods(spark):
    import zlib

    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(60)))) for k in range(300)]
    rows += [(-k, f" lead {k}\n\n  trail ") for k in range(50)] + [(None, "no id"), (501, None), (502, " ")]
    got = sorted(((r.doc_id, split(r.text)) for r in periodic.with_planted_periods(frame(spark, rows)).collect()), key=repr)
    want = []
    for i, text in rows:
        words = split(text)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        want.append((i, words))
    assert got == sorted(want, key=repr)


def test_no_shuffle(spark):
    plan = periodic.periodic_runs(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
