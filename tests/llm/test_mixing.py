from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm.mixing import mixed, mixture, rounded, targets

SCHEMA = "doc_id long, text string, source string, copies int, copy string"


def shared(sizes, weights, most):
    """Share by weight, stop at the ceiling, share the excess again, until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, target, open_names = sum(sizes.values()), {}, list(names)
    while open_names:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_names)
        above = [s for s in open_names if level * weight[s] > most * sizes[s]]
        if not above:
            target |= {s: level * weight[s] for s in open_names}
            break
        target |= {s: most * sizes[s] for s in above}
        open_names = [s for s in open_names if s not in above]
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5}, {"a": 1}, {"b": 7, None: 3, "é": 1, "z": 100, "Z": 2},
    {f"s{k}": (k * 37) % 11 * 10 for k in range(30)}, {"a": 0, "b": 0}, {"a": 0, "b": 4}, {},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(rows).collect()}
    want = shared(sizes, (5, 2, 1), 3)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


def documents(n=400):
    rows = [(k, " ".join(["w"] * (k * 31 % 97 + 1)), ["hot", "hot", "b", "c", None, "d"][k % 6], 1, "x") for k in range(n)]
    return rows + [(n, None, "b", 1, "x"), (n + 1, "", "c", 1, "x"), (n + 2, "\t\n", None, 1, "x"), (0, *rows[0][1:]), (None, "q r", "b", 1, "x")]


def test_mixture_keeps_targets_and_bounds(spark):
    rows = documents()
    frame = spark.createDataFrame(rows, SCHEMA)
    plan = mixed(frame).collect()
    assert len(plan) == len(rows)
    size, taken, biggest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in plan:
        size[r.source] += r.size
        taken[r.source] += r.copies * r.size
        biggest[r.source] = max(biggest[r.source], r.size)
        target[r.source] = r.target
        assert 0 <= r.copies <= 3
    want = shared(size, (5, 2, 1), 3)
    for s in size:
        assert target[s] == pytest.approx(want[s])
        # A repeated row doubles the size of its unit.
        assert abs(taken[s] - target[s]) <= 2 * biggest[s]
    again = mixed(frame.repartition(7).orderBy(F.rand(3))).collect()
    assert sorted(plan, key=repr) == sorted(again, key=repr)


def test_mixture_repeats_rows(spark):
    frame = spark.createDataFrame(documents(60), SCHEMA)
    copies = sum(r.copies for r in mixed(frame).collect())
    out = mixture(frame)
    assert out.columns == ["doc_id", "text", "source", "copies", "copy"]
    rows = out.collect()
    assert len(rows) == copies and {r.copies for r in rows} == {1}
    assert mixture(frame.limit(0)).count() == 0
    assert mixed(frame.limit(0)).count() == 0


def test_rounding_keeps_expectations(spark):
    units = [("s", k, k, float(k % 5 + 1), 0.3) for k in range(300)]
    frame = spark.createDataFrame(units, "source string, h long, id long, w double, p double")
    total = 0
    for seed in range(6):
        got = {r.h: r.x for r in rounded(frame, fan=8, seed=seed).collect()}
        assert got.keys() == {k for _, k, *_ in units} and set(got.values()) <= {0, 1}
        words = sum(w for _, k, _, w, _ in units if got[k])
        assert abs(words - 0.3 * 900) <= 5
        total += got[7]
    assert total < 6


def test_a_source_that_is_taken_whole(spark):
    rows = [(k, "w " * 10, "only", 1, "x") for k in range(50)]
    plan = mixed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.copies for r in plan} == {1} and {r.target for r in plan} == {500.0}
