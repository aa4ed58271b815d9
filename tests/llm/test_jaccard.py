import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm import jaccard
from clickloom.llm.jaccard import Rarity, one_of_each, order_keys, prefix_sizes, shingle_sets, similar_groups

SCHEMA = "doc_id long, text string, class string, root string"


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                near[i].add(j)
    out = []
    for k, (doc, _) in enumerate(rows):
        seen, queue = {k}, [k]
        while queue:
            for j in near[queue.pop()] - seen:
                seen.add(j)
                queue.append(j)
        out.append((doc, len(sets[k]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "c", "r") for r in rows], SCHEMA).repartition(3)
    got = similar_groups(frame, **options).select("doc_id", "n_shingles", "component_id")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def documents(seed):
    rng = random.Random(seed)
    rows = []
    common = [f"common{k}" for k in range(25)]
    for _ in range(25):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(2, 50))]
        for _ in range(rng.randrange(1, 5)):
            copy = list(words)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(500)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, " ".join(common + [f"x{k}", f"y{k}", f"z{k}", f"u{k}", f"v{k}"] * (k % 3))) for k in range(30)]
    chain = [f"c{k}" for k in range(60)]
    for step in range(12):
        rows.append((500 + step, " ".join(chain)))
        chain[step * 5] = f"changed{step}"
    return rows


@pytest.mark.parametrize("n, percent, cell_tokens, bits, pair_rows, orders", [
    (4, 85, 2_000_000, 28, 16, 2), (4, 85, 200, 12, 1, 3), (2, 60, 100, 13, 3, 2), (5, 80, 60, 20, 1000, 2)])
def test_against_brute_force(spark, n, percent, cell_tokens, bits, pair_rows, orders):
    rows = documents(n * percent)
    options = dict(cell_tokens=cell_tokens, sketch_bits=bits, pair_rows=pair_rows, orders=orders)
    assert run(spark, rows, n=n, percent=percent, **options) == brute(rows, n, percent)


def test_edges(spark):
    long = " ".join(f"t{k}" for k in range(30_000))
    rows = [(9, None), (8, ""), (7, " \n"), (6, "one"), (5, "ONE "), (4, "one two three"), (3, "one two three four"), (3, "one two three four"),
            (2, long), (1, long + " end"), (None, "one"), (None, "alone x y z")]
    assert run(spark, rows) == brute(rows, 4, 85)
    assert run(spark, []) == []


def test_one_of_each(spark):
    words = " ".join(f"w{k}" for k in range(100))
    rows = [(3, words, "c", "r"), (5, words + " more", "c", "r"), (4, "other text", "c", "r"), (6, None, "c", "r"), (7, "", "c", "r")]
    kept = one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "class", "root"]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 7]


def test_one_of_each_with_repeated_and_null_ids(spark):
    words, other, third = (" ".join(f"{c}{k}" for k in range(100)) for c in "wxy")
    rows = [(1, words, "c", "r"), (2, words + " more", "c", "r"), (2, other, "c", "r"),
            (None, words + " end", "c", "r"), (None, third, "c", "r"), (None, third + " more", "c", "r"),
            (9, "alone here", "d", "r"), (9, "alone here", "c", "r"), (9, "alone here", "c", "r"),
            (3, other + " more", "c", "r"), (None, None, "c", "r"), (None, None, "c", "r")]
    for shuffled in (rows, rows[::-1]):
        kept = one_of_each(spark.createDataFrame(shuffled, SCHEMA).repartition(3))
        got = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:2], r["class"]) for r in kept.collect())
        assert got == [(False, 1, "w0", "c"), (False, 2, "x0", "c"), (False, 9, "al", "c"),
                       (True, 0, "", "c"), (True, 0, "", "c"), (True, 0, "y0", "c")]


def test_any_order_keeps_links():
    rng = np.random.default_rng(1)
    flags = rng.integers(0, 256, 1 << 9).astype(np.uint8).tobytes()
    levels = Rarity(12, flags, rng.integers(0, 16, 1 << 6).astype(np.uint8))
    for _ in range(200):
        size = int(rng.integers(1, 60))
        a = rng.integers(1, 2**63, size, dtype=np.uint64)
        b = np.concatenate([a[int(rng.integers(0, max(1, size // 6))) :], rng.integers(1, 2**63, int(rng.integers(0, size // 8 + 1)), dtype=np.uint64)])
        both = len(np.intersect1d(a, b))
        if not 100 * both >= 85 * (len(a) + len(b) - both):
            continue
        for order in range(3):
            first = [set(x[np.argsort(order_keys(x, levels, order), kind="stable")][: prefix_sizes(np.array([len(x)]), 85)[0]].tolist()) for x in (a, b)]
            assert first[0] & first[1]


def test_shingle_sets():
    tokens, first = shingle_sets(pa.array(["a b c d a b c d", "A  b c d", None, "x", "x y", "a b c d"]), 4)
    sets = [set(tokens[a:b].tolist()) for a, b in zip(first[:-1], first[1:])]
    assert [len(s) for s in sets] == [4, 1, 0, 1, 1, 1]
    assert sets[1] == sets[5] and sets[1] < sets[0] and sets[3] != sets[4]


def passages(n):
    """Texts of words of their own, each with a passage that the next one has as well, and a copy
    and a near copy of every tenth."""
    rows = []
    for k in range(n):
        own = [f"d{k}w{i}" for i in range(90)]
        words = [f"p{k}x{i}" for i in range(12)] + own + [f"p{k + 1}x{i}" for i in range(12)]
        rows.append((len(rows), " ".join(words)))
        if k % 10 == 0:
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join([*words, "end"]))]
    return rows


def test_sets_of_unrelated_texts_are_not_sent_when_tokens_outnumber_the_cells(spark, monkeypatch):
    rows, sent = passages(200), []
    cells = jaccard._cells

    def counting(sets, *rest):
        sent.append(sets.count())
        return cells(sets, *rest)

    monkeypatch.setattr(jaccard, "_cells", counting)
    # 23,000 tokens for 2^13 cells; some 4,000 come again.
    assert run(spark, rows, n=4, percent=85, sketch_bits=13, pair_rows=1) == brute(rows, 4, 85)
    assert 40 <= sent[0] <= 60
