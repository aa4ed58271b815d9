import random

import numpy as np
import pyarrow as pa

from clickloom.llm import arrays
from clickloom.llm.graph import components

TEXTS = ["Hello  World\tfoo", "", None, " é bar\n", "x", "  ", "a\x1cb c d", "ÀB ab12-cd"]


def test_split_words():
    words = arrays.split_words(pa.array(TEXTS), arrays.NOT_SPACE, lower=True)
    want = [(t or "").encode().lower().split() for t in TEXTS]
    assert words.as_binary().to_pylist() == [w for own in want for w in own]
    assert words.counts().tolist() == [len(w) for w in want]
    assert bytes(words.buffer) == b"".join(w + b" " for own in want for w in own)


def test_alnum_words():
    words = arrays.split_words(pa.array(["A-b_c 9é!Z", "--", None]), arrays.ALNUM, lower=True)
    assert words.as_binary().to_pylist() == [b"a", b"b", b"c", "9é".encode(), b"z"]
    assert words.counts().tolist() == [5, 0, 0]


def test_hashes_follow_the_words():
    words = arrays.split_words(pa.array(["a bc a cb ba bc"]), arrays.NOT_SPACE, lower=False)
    h = words.hashes()
    assert h[0] == h[2] and h[1] == h[5] and len(set(h.tolist())) == 4


def test_pieces_cover_the_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "b" * 50, "", "c"])], names=["text"])
    for most in (1, 3, 60, 1000):
        parts = [p.column("text").to_pylist() for p in arrays.pieces(batch, "text", most)]
        assert sum(parts, []) == batch.column("text").to_pylist()


def test_combine():
    values = np.arange(5, dtype=np.uint64)
    assert len(arrays.combine(values, 5)) == 1 and len(arrays.combine(values, 6)) == 0
    assert arrays.combine(values, 2)[1] == arrays.combine(values[1:], 2)[0]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(k, k + 1) for k in range(1000, 1040)] + [(5, 5), edges[0], edges[0][::-1]]
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    rows = [*edges, (None, 3), (4, None)]
    got = {r.id: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {v: find(v) for v in root if find(v) != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
