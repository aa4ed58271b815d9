import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import toxicity

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score double, worst string, toxic string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, "w", "t") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents of random words; one word, and words with one beginning, make a sentence toxic."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for k in range(900):
        parts = [[rng.choice(words) for _ in range(rng.randrange(2, 12))] for _ in range(rng.randrange(1, 40))]
        toxic = k % 5 == 0
        for _ in range(rng.randrange(1, 3) if toxic else 0):
            bad = rng.choice(["qwax", "zuv" + rng.choice(words), "zuv" + rng.choice(words)])
            rng.choice(parts).insert(0, bad)
        docs.append((k, ". ".join(" ".join(p) for p in parts) + "."))
        labels.append((k, 1, int(toxic), "extra"))
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"), dict(docs)


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.train(corpus[0], corpus[1])


def test_held_out_documents_and_sentences(spark, corpus, model):
    docs, labels, texts = corpus
    found = toxicity.scored(docs, model).join(labels.select("doc_id", F.col("toxic").alias("wanted")), "doc_id")
    held = found.where(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(held) > 150
    right = sum((r.score >= toxicity.THRESHOLD) == bool(r.wanted) for r in held)
    assert right >= 0.97 * len(held)
    spans = [(r, texts[r.doc_id][s.begin : s.end]) for r in held for s in r.offending]
    bad = [t for _, t in spans if re.search(r"\b(qwax|zuv)", t)]
    assert len(bad) >= 0.97 * len(spans) and len(bad) > 20
    for r in held:
        assert all("." not in texts[r.doc_id][s.begin : s.end] for s in r.offending)


def by_hand(text, model):
    """Noisy-or over the sentences of a text, split by regular expressions."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    chances, spans = [], []
    for part in re.finditer(r"[^.!?\n]+", low):
        words = re.findall(r"(?:[a-z]|[^\x00-\x7f])+", part[0])
        if not words:
            continue
        values = toxicity.sentences(pa.array([" ".join(words)]))
        total = sum(float(model.weights[c]) for c in values.cells()[0])
        chances.append(1 / (1 + math.exp(-(model.bias + total))))
        spans.append(part.span())
    clean = 1.0
    for p in chances:
        clean *= 1 - p
    return 1 - clean, len(chances), chances, spans


def test_score_equals_the_product(spark, corpus, model):
    rng = random.Random(8)
    bits = ["qwax", "zuvén", " ", ". ", "!", "?\n", "é😀 ", "Word", "ZUVA", "12", "..", "-", "日本 "]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randrange(30)))) for k in range(200)]
    got = {r.doc_id: r for r in toxicity.scored(frame(spark, rows), model).collect()}
    for k, text in rows:
        score, n, chances, spans = by_hand(text, model)
        r = got[k]
        assert r.n_sentences == n and r.score == pytest.approx(score, abs=1e-6)
        assert [(s.begin, s.end) for s in r.offending] == [x for x, p in zip(spans, chances) if p >= toxicity.THRESHOLD]
        if n:
            worst = max(range(n), key=lambda i: (round(chances[i], 9), -i))
            assert (r.worst.begin, r.worst.end) == spans[worst]
        else:
            assert r.worst is None


def test_slope_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    document = np.array([0, 0, 1, 1, 1, 2, 3])
    labels, weight = np.array([1, 0, 1, 0]), np.array([0.1, 0.4, 0.2, 0.3])
    z = rng.normal(size=7)
    _, slope = toxicity.loss_and_slope(z, document, labels, weight)
    for k in range(7):
        step = np.zeros(7)
        step[k] = 1e-6
        up, down = (toxicity.loss_and_slope(z + s, document, labels, weight)[0] for s in (step, -step))
        assert slope[k] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_edges(spark, model):
    long = "plain words here. " * 50_000 + "You qwax!"
    rows = [(1, None), (2, ""), (3, "12 ... !?\n"), (4, "qwax"), (4, "qwax"), (None, "qwax"), (5, long), (6, "a qwax. a qwax.")]
    got = [(r.doc_id, r.score >= 0.3, r.n_sentences) for r in toxicity.scored(frame(spark, rows), model).collect()]
    want = [(1, False, 0), (2, False, 0), (3, False, 0), (4, True, 1), (4, True, 1), (None, True, 1), (5, True, 50_001), (6, True, 2)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert toxicity.scored(frame(spark, rows).limit(0), model).count() == 0
    (tied,) = toxicity.scored(frame(spark, [(6, "a qwax. a qwax.")]), model).collect()
    assert tied.worst.begin == 0 and 0 <= tied.score <= 1


def test_without_labels_of_both_kinds(spark, corpus):
    docs, labels, _ = corpus
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert toxicity.train(docs.limit(0), labels) is None
    assert toxicity.train(docs, labels.limit(0)) is None
    assert {r.score for r in toxicity.scored(docs, None).collect()} == {0.0}


def test_only_rows_not_held_out_are_learned_from(spark, corpus):
    docs, labels, _ = corpus
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    messy = turned.unionByName(turned.limit(9).withColumn("toxic", F.lit(None).cast("int")))
    messy = messy.unionByName(messy.limit(9).withColumn("doc_id", F.lit(None).cast("long")))
    one, other = (toxicity.train(docs, x, rows=60, steps=20) for x in (labels, messy))
    assert one.bias == other.bias and (one.weights == other.weights).all()


def test_given_documents(spark):
    """Few toxic rows to learn from at this size: clean ones stay, most toxic ones are found."""
    found = toxicity.op12_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    held = found.where("held_out").collect()
    clean = [r.predicted for r in held if not r.toxic]
    assert sum(clean) <= 0.06 * len(clean)
    assert sum(r.predicted for r in held if r.toxic) >= 0.7 * sum(r.toxic for r in held)
