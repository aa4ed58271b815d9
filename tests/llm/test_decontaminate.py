import gc
import hashlib
import random
import re

import numpy as np
import pytest

from clickloom.llm import decontaminate
from clickloom.llm.decontaminate import FMIndex, contaminated_spans, decontaminated, report, suffix_order

DOCS = "doc_id long, text string, spans string, items string"
ITEMS = "item_id long, text string, doc_id string"
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        own = words(text)
        hit, found = set(), set()
        for item, phrase in items:
            p = words(phrase)
            n = min(window, len(p))
            for k in range(len(p) - n + 1 if n else 0):
                for at in range(len(own) - n + 1):
                    if own[at : at + n] == p[k : k + n]:
                        hit.update(range(at, at + n))
                        found.add(item)
        listed = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(own), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], DOCS).repartition(2)
    b = spark.createDataFrame([(*r, "z") for r in items], ITEMS)
    return sorted((tuple(r) for r in report(contaminated_spans(d, b, **options)).collect()), key=repr)


def material(seed):
    rng = random.Random(seed)

    def text(n, kinds):
        return " ".join(rng.choice(["W", "w", ""]) + f"{rng.randrange(kinds)}" for _ in range(n))

    items = [(k, text(rng.randrange(1, 9), 4)) for k in range(12)] + [(2, "w1 w1"), (None, "w3 w3 w3 w3 w3"), (99, None), (98, "...")]
    docs = [(k, text(rng.randrange(0, 60), 6)) for k in range(40)]
    return docs, items


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    docs, items = material(seed)
    assert run(spark, docs, items, window=4) == brute(docs, items, 4)


def test_blocks_of_phrases(spark):
    docs, items = material(7)
    docs += docs[:2] + [(50, None), (50, "")]
    assert run(spark, docs, items, window=3, block_words=4) == brute(docs, items, 3)


def test_blocks_are_let_go(spark):
    """The phrases of a block are gone before the next but one is read."""
    docs, items = material(9)
    alive = []
    made = decontaminate.phrases_of

    def counted(*args):
        gc.collect()
        alive.append(sum(isinstance(o, decontaminate.Phrases) for o in gc.get_objects()))
        return made(*args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decontaminate, "phrases_of", counted)
        assert run(spark, docs + docs[:3], items[:12], window=3, block_words=1) == brute(docs + docs[:3], items[:12], 3)
    assert len(alive) > 6 and max(alive[2:]) <= alive[0] + 3


def test_edges(spark):
    long = " ".join(f"u{k}" for k in range(40_000)) + " one, two; THREE four"
    docs = [(1, None), (2, ""), (3, long), (None, "one two three four"), (3, long), (4, "é one-two"), (5, "...")]
    items = [(7, "one two three four"), (10, "é"), (10, "é")]
    assert run(spark, docs, items) == brute(docs, items, 10)
    assert run(spark, docs, []) == brute(docs, [], 10)
    assert run(spark, [], items) == []


def test_documents_are_kept_whole(spark):
    d = spark.createDataFrame([(1, "a b c", "x", "y"), (2, "clean", "s", "t"), (None, None, "s", "t")], DOCS)
    b = spark.createDataFrame([(1, "b", "z")], ITEMS)
    assert sorted(decontaminated(d, b).collect(), key=repr) == sorted(
        [(2, "clean", "s", "t"), (None, None, "s", "t")], key=repr)


def test_index_against_naive_search():
    rng = np.random.default_rng(1)
    for size, kinds in ((1, 2), (50, 2), (400, 5), (300, 1)):
        text = rng.integers(1, kinds + 1, size)
        index = FMIndex(text, sample=3)
        phrases = rng.integers(1, kinds + 2, (40, 4))
        lengths = rng.integers(1, 5, 40)
        low, high = index.search(phrases, lengths)
        for p in range(40):
            n = lengths[p]
            want = [k for k in range(size - n + 1) if (text[k : k + n] == phrases[p, :n]).all()]
            assert sorted(index.locate(np.arange(low[p], high[p])).tolist()) == want


def test_suffix_order():
    text = np.array([2, 1, 2, 1, 2, 1, 1, 0])
    assert suffix_order(text).tolist() == sorted(range(8), key=lambda k: text[k:].tolist())
