"""Toxicity by multiple-instance learning: labels stand on documents, the model scores sentences.

A sentence is a bag of features: its words and their first letters (``STEMS``), hashed into
``2 ** BITS`` cells, each counted once. A logistic model gives every sentence a probability; that of
the document is their noisy-or, one minus the product of their complements: a document is toxic if
any sentence is. With softplus s(z) = log(1 + exp(z)) of a sentence's value z, the document's
score is 1 - exp(-S), S the sum of s(z) over its sentences, and the log loss of the document's
label is differentiated through that sum. So training needs no labels of sentences, and
prediction says which ones are to blame.

Training reads a sample of at most ``ROWS`` labelled texts of each label, chosen by a hash of the
id among those of at most ``LONGEST`` bytes (documented bounds; the sample is drawn from the ids
of ``labels`` first, so only its texts are sent anywhere). Features are found in the tasks; their cells
come to the driver, 4 bytes each, where the loss is minimised by full-batch gradient steps with
momentum and a penalty on the weights. Rarely seen features are left out (``FEWEST``). Prediction is one
pass over whole texts without a shuffle.

Defined results: a text that is null, empty or without a letter has no sentence and score 0; without
training rows of both labels the score is 0 everywhere; of several labels of one id the largest counts;
a null id is never held out and never trained on, nor are null labels; repeated rows are answered one by one;
ties among the worst sentences go to the first; an empty table gives an empty one; other columns of the
input, whatever their names, are not read. Texts of any length are scored whole: batches are cut
into pieces of a few megabytes, a longer text is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.arrays import LOWER, mix, pieces
from clickloom.llm.tables import beside, read, stage

BITS = 18
BITS_MOST = 24
# Lengths in bytes of the beginnings of a word that are features besides the whole word.
STEMS = (3, 4, 5, 6)
ROWS = 1200
LONGEST = 50_000
# Documents of the sample in which a feature must occur.
FEWEST = 3
STEPS = 300
# After so many steps, features whose weight is 0 are given up.
PRUNED = 20
RATE = 0.1
PENALTY = 5e-5
THRESHOLD = 0.3

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_END = np.zeros(256, bool)
_END[[0x0A, 0x21, 0x2E, 0x3F]] = True
_LEADS = ~((np.arange(256) & 0xC0) == 0x80)
_random = np.random.default_rng(51)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64)
_POWER = np.multiply.accumulate(np.full(256, 0x9E3779B97F4A7C15, np.uint64))

SENTENCE = "struct<begin: bigint, end: bigint, score: double>"
SCORED = f"doc_id bigint, score double, n_sentences bigint, worst {SENTENCE}, offending array<{SENTENCE}>"


@dataclass
class Sentences:
    """Sentences of several texts that have a word: text, first and last byte; and the words, in
    order: the sentence each belongs to, and the cells of its features, ``None`` where it is too
    short for one."""

    data: np.ndarray
    starts: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    features: list[tuple[np.ndarray, np.ndarray]]

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Beginnings and ends as code points of their texts."""
        before = np.concatenate([[0], np.cumsum(_LEADS[self.data])])
        base = before[self.starts[self.text]]
        return before[self.begin] - base, before[self.end] - base

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """Cells of the features of every sentence, each once, and where each sentence's begin."""
        owner, cells = self.marked(np.ones(1 << BITS_MOST, bool))
        return cells, np.searchsorted(owner, np.arange(len(self.text) + 1))

    def marked(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sentences and the cells of their features that are ``wanted``, each once, in order."""
        pairs = [np.zeros(0, np.int64)]
        for words, cells in self.features:
            use = wanted[cells]
            pairs.append(self.owner[words[use]] << BITS_MOST | cells[use])
        pairs = np.unique(np.concatenate(pairs))
        return pairs >> BITS_MOST, pairs & ((1 << BITS_MOST) - 1)


def sentences(texts: pa.Array, bits: int = BITS) -> Sentences:
    """Split at ``. ! ?`` and line breaks, A to Z lower-cased; words are runs of letters (and all
    characters beyond ASCII)."""
    ended = pc.binary_join_element_wise(
        pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()),
        pa.scalar("\n", pa.large_string()),
    )
    starts = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset : ended.offset + len(ended) + 1]
    data = LOWER[np.frombuffer(ended.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]]
    starts = starts - starts[0]
    letter = _LETTER[data]
    borders = np.flatnonzero(np.diff(np.concatenate([[False], letter]).view(np.int8)))
    at, length = borders[0::2], borders[1::2] - borders[0::2]
    ends = np.flatnonzero(_END[data])
    # The sentence of a word ends at the first end behind it; sentences without a word are none.
    of = np.searchsorted(ends, at)
    fresh = np.concatenate([[True], of[1:] != of[:-1]])[: len(of)]
    owner, which = np.cumsum(fresh) - 1, of[fresh]
    begin = np.concatenate([[0], ends + 1])[which]
    text = np.searchsorted(starts, begin, side="right") - 1

    def cell(value: np.ndarray, salt: int) -> np.ndarray:
        return (mix(value ^ np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64)

    # Beginnings: the sum of one random value per byte and place, one place after the other.
    features, words, value = [], np.arange(len(at)), np.zeros(len(at), np.uint64)
    for k in range(max(STEMS)):
        use = length[words] > k
        words = words[use]
        value = value[use] + _BYTE[data[at[words] + k]] * _POWER[k]
        if k + 1 in STEMS:
            long = length[words] > k + 1
            features.append((words[long], cell(value[long], k + 1)))
    if len(at):
        inside = data[letter]
        first = np.cumsum(length) - length
        place = np.arange(len(inside)) - np.repeat(first, length)
        # Words of more bytes than there are powers use them again.
        whole = np.add.reduceat(_BYTE[inside] * _POWER[place % len(_POWER)], first)
        features.append((np.arange(len(at)), cell(whole, 0)))
    else:
        features.append((words, np.zeros(0, np.int64)))
    return Sentences(data, starts, text, begin, ends[which], owner, features)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def noisy_or(z: np.ndarray, document: np.ndarray, documents: int) -> np.ndarray:
    """Probability of every document, from the values of its sentences."""
    return -np.expm1(-np.bincount(document, softplus(z), documents))


@dataclass
class Model:
    """Weights of the feature cells, and a bias."""

    weights: np.ndarray
    bias: float
    bits: int

    def values(self, found: Sentences) -> np.ndarray:
        # Most weights are 0: few features are left to be told apart.
        owner, cells = found.marked(self.weights != 0)
        return self.bias + np.bincount(owner, self.weights[cells], len(found.text))


def loss_and_slope(
    z: np.ndarray, document: np.ndarray, labels: np.ndarray, weight: np.ndarray
) -> tuple[float, np.ndarray]:
    """Log loss of the documents' labels under the noisy-or, each with its weight, and its slope by
    every value."""
    total = np.maximum(np.bincount(document, softplus(z), len(labels)), 1e-12)
    positive = labels > 0
    loss = weight @ np.where(positive, -np.log(-np.expm1(-total)), total)
    by_total = weight * np.where(positive, -1 / np.expm1(np.minimum(total, 700)), 1.0)
    # The slope of softplus is the sentence's own probability.
    return float(loss), by_total[document] * np.exp(-softplus(-z))


def fit(
    cells: np.ndarray, first: np.ndarray, document: np.ndarray, labels: np.ndarray, share: float,
    bits: int = BITS, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY, fewest: int = FEWEST,
) -> Model:
    """Minimise the loss: sentence i of ``document[i]`` has ``cells[first[i]:first[i + 1]]``; of all
    labelled documents, ``share`` are toxic, and the sample is weighed accordingly.

    Gradient steps with running means of slope and squared slope per weight; the absolute size of
    weights is penalised by shrinking them after every step.
    """
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = np.unique(document[owner].astype(np.int64) << bits | cells)
    names = np.flatnonzero(np.bincount(pairs & ((1 << bits) - 1), minlength=1 << bits) >= fewest)
    del pairs
    weight = np.where(labels > 0, share / max(1, labels.sum()), (1 - share) / max(1, (1 - labels).sum()))

    def restricted(owner: np.ndarray, cells: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number = np.full(1 << bits, -1)
        number[names] = np.arange(len(names))
        use = number[cells] >= 0
        return owner[use], cells[use]

    owner, cells = restricted(owner, cells, names)
    feature = np.searchsorted(names, cells)
    # At first all sentences of an average document together are toxic at the rate seen.
    theta = np.zeros(len(names) + 1)
    theta[-1] = np.log(share * len(labels) / max(1, len(document)))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = np.bincount(owner, theta[feature], len(document)) + theta[-1]
        _, slope = loss_and_slope(z, document, labels, weight)
        grad = np.append(np.bincount(feature, slope[owner], len(names)), slope.sum())
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad * grad - square)
        size = np.sqrt(square / (1 - 0.99**step)) + 1e-8
        theta -= rate * (mean / (1 - 0.9**step)) / size
        shrink = rate * penalty / size[:-1]
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(np.abs(theta[:-1]) - shrink, 0)
        if step % PRUNED == 0:
            keep = np.append(theta[:-1] != 0, True)
            names = names[keep[:-1]]
            theta, mean, square = theta[keep], mean[keep], square[keep]
            owner, cells = restricted(owner, cells, names)
            feature = np.searchsorted(names, cells)
    weights = np.zeros(1 << bits, np.float32)
    weights[names] = theta[:-1]
    return Model(weights, float(theta[-1]), bits)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sampled(docs: DataFrame, labels: DataFrame, rows: int, longest: int) -> tuple[DataFrame, float]:
    """Texts to learn from, ``toxic, text, _k``, and the share of toxic ones among all labelled ids.
    Ids are drawn by hash, twice as many as wanted, so the side that is joined with the documents
    is small; copies of a text count once."""
    own = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    own = own.where("id is not null and toxic is not null").where(~held_out(F.col("id")))
    own = stage(own.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    counts = stage(own.groupBy("toxic").agg(F.count(F.lit(1)).alias("_n")))
    number = {r.toxic: r["_n"] for r in counts.collect()}
    rates = beside(counts.select("toxic", ((2.0 * rows + 60) / F.col("_n")).alias("_rate")))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    ids = own.withColumn("_r", draw).join(rates, "toxic").where("_r < _rate").select("id", "toxic", "_r")
    texts = docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    picked = texts.where(F.octet_length("text") <= longest).join(beside(stage(ids)), "id")
    picked = picked.groupBy("toxic", F.sha2(F.col("text").cast("binary"), 256).alias("_h")).agg(
        F.min("_r").alias("_r"), F.first("text").alias("text"))
    order = Window.partitionBy("toxic").orderBy("_r", "_h")
    sample = picked.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= rows)
    return sample, number.get(1, 0) / max(1, sum(number.values()))


def train(
    docs: DataFrame, labels: DataFrame, rows: int = ROWS, longest: int = LONGEST, bits: int = BITS,
    steps: int = STEPS, fewest: int = FEWEST,
) -> Model | None:
    """A model of the labelled documents that are not held out; None without both labels."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = sentences(piece.column("text"), bits)
                each, first = found.cells()
                of = np.searchsorted(found.text, np.arange(piece.num_rows + 1))
                edge, sizes = first[of], np.diff(first).astype(np.int32)
                each, own = each.astype(np.int32), range(piece.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("toxic"), piece.column("k"),
                     pa.array([sizes[of[t] : of[t + 1]].tobytes() for t in own], pa.binary()),
                     pa.array([each[edge[t] : edge[t + 1]].tobytes() for t in own], pa.binary())],
                    names=["toxic", "k", "sizes", "cells"],
                )

    sample, share = _sampled(docs, labels, rows, longest)
    sample = sample.select("toxic", F.col("_k").alias("k"), "text")
    found = sample.mapInArrow(cells, "toxic int, k int, sizes binary, cells binary").collect()
    found.sort(key=lambda r: (r.k, r.toxic))
    marks = np.array([r.toxic for r in found], np.int64)
    if len(set(marks.tolist())) < 2:
        return None
    sizes = [np.frombuffer(bytes(r.sizes), np.int32) for r in found]
    document = np.repeat(np.arange(len(found)), [len(s) for s in sizes])
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    joined = np.concatenate([np.frombuffer(bytes(r.cells), np.int32) for r in found]).astype(np.int64)
    return fit(joined, first, document, marks, share, bits, steps, fewest=fewest)


def _scored(model, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    for batch in batches:
        for piece in pieces(batch, "text"):
            rows = piece.num_rows
            found = sentences(piece.column("text"), model.value.bits if model else BITS)
            z = model.value.values(found) if model else np.full(len(found.text), -np.inf)
            own = np.exp(-softplus(-z))
            total = noisy_or(z, found.text, rows)
            begin, end = found.spans()
            spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(end), pa.array(own)], fields=list(kind))
            # The worst sentence of each text, the first of equals: in order of text, then score.
            order = np.lexsort((np.arange(len(own)), -own, found.text))
            edge = np.searchsorted(found.text, np.arange(rows + 1))
            some = np.diff(edge) > 0
            place = np.zeros(rows, np.int64)
            place[some] = order[edge[:-1][some]]
            worst = spans.take(pa.array(place, mask=~some))
            bad = np.flatnonzero(own >= threshold)
            offsets = np.searchsorted(found.text[bad], np.arange(rows + 1)).astype(np.int32)
            offending = pa.ListArray.from_arrays(pa.array(offsets), spans.take(pa.array(bad)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(total), pa.array(np.diff(edge)), worst, offending],
                names=["doc_id", "score", "n_sentences", "worst", "offending"],
            )


def scored(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row ``doc_id, score, n_sentences``, its ``worst`` sentence, and the ``offending`` ones, of
    ``threshold`` or more: from code point ``begin`` to ``end`` (the mark that ends it, not included)."""
    # About a megabyte, whatever the input.
    sent = docs.sparkSession.sparkContext.broadcast(model) if model else None
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lambda b: _scored(sent, threshold, b), SCORED)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` scored by a model of ``labels.toxic``. Nulls, empty and long texts,
    repeated rows and empty tables as the module says."""
    docs = read(spark, sf_dir, "documents")
    found = scored(docs, train(docs, read(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_sentences", F.size("offending").cast("bigint").alias("n_offending"),
        F.col("worst.begin").alias("worst_begin"), F.col("worst.end").alias("worst_end"),
    )
