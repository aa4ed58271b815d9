"""Language identification with string kernels.

The kernel of two texts counts the character n-grams, n from 1 to ``N``, that both contain
(blended spectrum, presence only), divided by the geometric mean of each with itself. Nyström
landmarks turn it into features, one ridge regression per language (one against the rest) is
fitted on them, and texts are scored in batches by two matrix products: presence by landmark
presence, then kernel by coefficients.

N-grams are hashed into ``2 ** BITS`` cells. Every label is learned, from every labelled text that
is not held out: tasks sum the moments of their kernel values, Spark adds these up in the order of the
tasks, and the driver gets one row of sums for each landmark and label. Landmarks are chosen by a hash of
the id; only their bit sets, ``2 ** BITS / 8`` bytes each, come to the driver. A label has at least one
landmark, so with more than ``LANDMARKS`` labels the model grows with them. Prediction is one
pass over whole texts without a shuffle.

Defined results: a text that is null or has no letter is ``und`` with score 0; without training
rows every text is; ties go to the first language in order of names; repeated rows are answered
one by one; a null id is never held out and never trained on; an empty table gives an empty one.
Language, source and id of a row have no part in its prediction, other columns of the input,
whatever their names, are not read. Batches are cut into pieces of a few megabytes, a longer text
is a piece of its own and scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.arrays import mix, pieces
from clickloom.llm.tables import beside, read, stage

N = 3
BITS = 15
LANDMARKS = 128
# Texts of a label that a bound on the rows in all leaves at least.
FEWEST = 8
# Which of the overlaps of all labelled rows that are held out is looked at, the share of it that is
# enough, and the cells they are counted in to find it.
RARE = 0.002
MARGIN = 0.7
CELLS = 4096
RIDGE = 1e-3
UNKNOWN = "und"
# Texts per matrix product.
ROWS = 256
# Characters looked at together; longer texts are cut, with an overlap, and their sets united.
CHARS = 1 << 20

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def presence(text: str | None, bits: int = BITS, n: int = N) -> np.ndarray | None:
    """Flags of the n-grams of a text, lower-cased, everything between letters one blank; None
    if it has no letter."""
    if not text:
        return None
    flags = np.zeros(1 << bits, bool)
    seen = False
    for begin in range(0, len(text), CHARS):
        part = text[max(0, begin - 64) : begin + CHARS].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        if not letter.any():
            continue
        seen = True
        codes = np.where(letter, codes, 32)
        keep = letter | np.concatenate([[True], letter[:-1]])
        codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
        value = np.zeros(len(codes), np.uint64)
        for k in range(min(n, len(codes))):
            value = value[: len(codes) - k] * np.uint64(0x1F0A2BE71D163FA1) + codes[k:]
            flags[mix(value + np.uint64(k)) >> np.uint64(64 - bits)] = True
    return flags if seen else None


@dataclass
class Model:
    """Landmark n-gram sets and the coefficients that turn kernel values into language scores."""

    languages: list[str]
    landmarks: np.ndarray
    bits: int
    n: int
    coefficients: np.ndarray

    def scores(self, flags: np.ndarray) -> np.ndarray:
        """One row per text, one column per language."""
        return kernel(flags, np.unpackbits(self.landmarks, axis=1)) @ self.coefficients


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Normalised presence kernel between the rows of two 0/1 matrices."""
    left, right = left.astype(np.float32), right.astype(np.float32)
    sizes = np.outer(left.sum(axis=1), right.sum(axis=1))
    return (left @ right.T) / np.sqrt(np.maximum(sizes, 1))


def _fitted(marks: np.ndarray, square: np.ndarray, sums: np.ndarray, ridge: float) -> np.ndarray:
    """Coefficients of the kernel ridge regression on Nyström features, from weighted moments of
    kernel values: their products, landmark by landmark, and their sums, label by landmark."""
    inner = kernel(marks, marks).astype(np.float64)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    use = values > 1e-6 * values.max()
    whiten = vectors[:, use] / np.sqrt(values[use])
    # A row is wanted at 1 for its own language and at -1 for the others.
    wanted = whiten.T @ (2 * sums.T - sums.sum(axis=0)[:, None])
    solved = np.linalg.solve(whiten.T @ square @ whiten + ridge * np.eye(whiten.shape[1]), wanted)
    return (whiten @ solved).astype(np.float32)


def held_out(doc_id) -> object:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _learnable(docs: DataFrame) -> DataFrame:
    """All rows to learn from, ``lang, text, _r, _id``; ``_r`` is a hash of the id from 0 to 1."""
    rows = docs.where("lang is not null and text is not null and doc_id is not null")
    rows = rows.where(~held_out(F.col("doc_id")))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(1 << 30)) / float(1 << 30)
    return rows.select("lang", "text", draw.alias("_r"), F.col("doc_id").cast("bigint").alias("_id"))


def _drawn(rows: DataFrame, counts: DataFrame, per_language: int) -> DataFrame:
    """By hash, more than twice as many rows per language as wanted. ``counts``, ``lang, rows``, is
    staged; the 30 more see that no label is left without rows when few are wanted."""
    rates = stage(counts.select("lang", ((2.0 * per_language + 30) / F.col("rows")).alias("_rate")))
    return rows.join(beside(rates), "lang").where("_r < _rate").drop("_rate")


def _first(rows: DataFrame, most: int, tie: str) -> DataFrame:
    order = Window.partitionBy("lang").orderBy("_r", "_id", tie)
    return rows.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= most)


def _bounded(rows: DataFrame, per_language: int | None, rows_in_all: int | None) -> DataFrame:
    """Of rows to learn from only so many, for callers who ask for that."""
    counts = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")))
    if rows_in_all is not None:
        share = max(FEWEST, rows_in_all // max(1, counts.count()))
        per_language = share if per_language is None else min(per_language, share)
    return stage(_first(_drawn(rows, counts, per_language), per_language, "text").drop("_k"))


def _with_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each label have a letter."""
    seen: dict[str, int] = {}
    for batch in batches:
        for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if any(map(str.isalpha, text)):
                seen[name] = seen.get(name, 0) + 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["lang", "rows"]
    )


def _near(texts: list, marks: np.ndarray, sizes: np.ndarray, bits: int, n: int):
    """Of the texts with letters: their places, kernel values, common n-grams and own n-grams; None
    if there are none."""
    sets = [presence(t, bits, n) for t in texts]
    rows = [k for k, s in enumerate(sets) if s is not None]
    if not rows:
        return None
    flags = np.stack([sets[k] for k in rows]).astype(np.float32)
    both, own = flags @ marks.T, flags.sum(axis=1)
    return rows, both / np.sqrt(np.maximum(np.outer(own, sizes), 1)), both, own


def _moments(
    packed: np.ndarray, counts: dict[str, int], bits: int, n: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Rows of one task's weighted sums: products with each landmark, then the sum of each label."""
    marks = np.unpackbits(packed, axis=1).astype(np.float32)
    sizes = marks.sum(axis=1)
    number = {name: k for k, name in enumerate(sorted(counts))}
    # Every language weighs the same, however many rows it has.
    weight = np.array([1 / counts[name] for name in sorted(counts)])
    square, sums = np.zeros((len(marks), len(marks))), np.zeros((len(number), len(marks)))
    for batch in batches:
        for piece in pieces(batch, "text"):
            for begin in range(0, piece.num_rows, ROWS):
                part = piece.slice(begin, ROWS)
                found = _near(part.column("text").to_pylist(), marks, sizes, bits, n)
                if found is None:
                    continue
                named = part.column("lang").to_pylist()
                place = np.array([number[named[k]] for k in found[0]])
                near = found[1].astype(np.float64)
                weighted = near * weight[place][:, None]
                square += near.T @ weighted
                np.add.at(sums, place, weighted)
    rows = np.concatenate([square, sums])
    used = np.flatnonzero(rows.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([TaskContext.get().partitionId()] * len(used), pa.int32()),
         pa.array(list(rows[used]), pa.list_(pa.float64()))],
        names=["k", "task", "sums"],
    )


def train(
    docs: DataFrame, per_language: int | None = None, landmarks: int = LANDMARKS,
    rows_in_all: int | None = None, ridge: float = RIDGE, bits: int = BITS, n: int = N,
) -> Model | None:
    """A model of all labelled documents that are not held out, or of so many as the caller bounds
    them to; None if there are none."""

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [presence(t, bits, n) for t in batch.column("text").to_pylist()]
            packed = [None if s is None else np.packbits(s).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("lang", "_r", "_id")), pa.array(packed, pa.binary())],
                names=["lang", "_r", "_id", "flags"],
            )

    rows = _learnable(docs)
    if per_language is not None or rows_in_all is not None:
        rows = _bounded(rows, per_language, rows_in_all)
    texts = rows.select("lang", "text")
    counted = texts.mapInArrow(_with_letters, "lang string, rows bigint")
    counted = stage(counted.groupBy("lang").agg(F.sum("rows").alias("rows")))
    counts = {r.lang: r.rows for r in counted.collect()}
    if not counts:
        return None
    share = max(1, landmarks // len(counts))
    chosen = _drawn(rows, counted, share).mapInArrow(flagged, "lang string, _r double, _id bigint, flags binary")
    chosen = _first(chosen.where("flags is not null"), share, "flags").select("lang", "_k", "flags").collect()
    if not chosen:
        return None
    packed = b"".join(bytes(r.flags) for r in sorted(chosen, key=lambda r: (r.lang, r._k)))
    packed = np.frombuffer(packed, np.uint8).reshape(len(chosen), -1)
    size = len(packed)
    parts = texts.mapInArrow(
        lambda b: _moments(packed, counts, bits, n, b), "k int, task int, sums array<double>"
    )
    # Added in the order of the tasks, so that reruns agree.
    parts = parts.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("task", "sums"))).alias("parts"))
    added = F.aggregate(
        "parts", F.array_repeat(F.lit(0.0), size),
        lambda total, part: F.zip_with(total, part["sums"], lambda a, b: a + b),
    )
    moments = np.zeros((size + len(counts), size))
    for row in parts.select("k", added.alias("sums")).collect():
        moments[row.k] = row.sums
    marks = np.unpackbits(packed, axis=1)
    return Model(sorted(counts), packed, bits, n, _fitted(marks, moments[:size], moments[size:], ridge))


def _predict(model: Model | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = np.unpackbits(model.landmarks, axis=1).astype(np.float32) if model else None
    sizes = marks.sum(axis=1) if model else None
    for batch in batches:
        for piece in pieces(batch, "text"):
            texts = piece.column("text")
            names, scores = [UNKNOWN] * piece.num_rows, np.zeros(piece.num_rows)
            overlaps = np.zeros(piece.num_rows)
            for begin in range(0, piece.num_rows if model else 0, ROWS):
                found = _near(texts.slice(begin, ROWS).to_pylist(), marks, sizes, model.bits, model.n)
                if found is None:
                    continue
                rows, near, both, own = found
                overlaps[[begin + k for k in rows]] = both.max(axis=1) / own
                value = near @ model.coefficients
                best = value.argmax(axis=1)
                for k, b, v in zip(rows, best, value.max(axis=1), strict=True):
                    names[begin + k] = model.languages[b]
                    scores[begin + k] = min(1.0, max(0.0, (float(v) + 1) / 2))
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in piece.schema.names if c != "text"),
                 pa.array(names, pa.string()), pa.array(scores), pa.array(overlaps)],
                names=[*(c for c in piece.schema.names if c != "text"), "lang_pred", "score", "overlap"],
            )


def identify(docs: DataFrame, model: Model | None, judges: Column | None = None) -> DataFrame:
    """Per row ``doc_id, text_hash, lang_pred, score, overlap``; the score is that of the best
    language, its regression target -1 to 1 mapped to 0 to 1; the overlap is the share of the text's
    n-grams that the landmark nearest in this sense has. ``judges``, a condition, comes along."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text",
        *([] if judges is None else [judges.alias("judges")]),
    )
    more = "" if judges is None else ", judges boolean"
    return texts.mapInArrow(
        lambda b: _predict(model, b),
        f"doc_id bigint, text_hash bigint{more}, lang_pred string, score double, overlap double",
    )


def _judges() -> Column:
    """The rows whose overlaps set the least one: labelled and held out."""
    return F.expr("lang is not null and text is not null") & held_out(F.col("doc_id"))


def _quantile(values: DataFrame, share: float) -> float | None:
    """The quantile of ``overlap``, interpolated; None without rows. Rows are counted in cells, then the
    distinct values of the one or two cells that it lies in: fractions of n-gram numbers below
    ``2 ** BITS``, which are few however many rows there are."""
    cell = F.floor(F.col("overlap") * CELLS)
    counts = sorted(tuple(r) for r in values.groupBy(cell.alias("cell")).count().collect())
    place = (sum(c for _, c in counts) - 1) * share
    if place < 0:
        return None
    ranks, cells, least = (math.floor(place), math.ceil(place)), {}, 0
    for name, count in counts:
        for rank in ranks:
            if least <= rank < least + count:
                cells.setdefault(name, least)
        least += count
    inside = values.where(cell.isin(*cells)).groupBy("overlap").count().collect()
    # The cells are neighbours among those that have rows.
    at, least = {}, min(cells.values())
    for value, count in sorted(tuple(r) for r in inside):
        at |= {rank: value for rank in ranks if least <= rank < least + count}
        least += count
    low, high = at[ranks[0]], at[ranks[1]]
    return low + (high - low) * (place - ranks[0])


def _least(judged: DataFrame, margin: float) -> float:
    """Of staged rows of ``identify`` that judge."""
    return margin * (_quantile(judged.where(F.col("lang_pred") != UNKNOWN), RARE) or 0.0)


def least_overlap(docs: DataFrame, model: Model, margin: float = MARGIN) -> float:
    """The overlap below which a text is in no learned language: ``margin`` times the ``RARE``
    quantile among all labelled rows that are held out; 0 if there are none."""
    return _least(stage(identify(docs.where(_judges()), model)), margin)


def in_known_language(docs: DataFrame, model: Model | None = None, least: float | None = None) -> DataFrame:
    """The documents in a learned language, all columns as they were: those with letters whose
    overlap reaches ``least``, by default that of ``least_overlap``. Rows that agree in id and text
    are judged alike."""
    model = model or train(docs)
    if least is None:
        # One pass finds all overlaps, those that judge and those that are judged.
        judged = stage(identify(docs, model, _judges()))
        least = _least(judged.where("judges"), MARGIN)
    else:
        judged = identify(docs, model)
    bad = judged.where((F.col("lang_pred") == UNKNOWN) | (F.col("overlap") < least))
    bad = beside(stage(bad.select("doc_id", "text_hash").distinct()))
    bad = bad.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"))
    return docs.join(
        bad,
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text")),
        "left_anti",
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of ``documents``; odd rows as the module says."""
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
