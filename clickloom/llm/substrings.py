"""Substring deduplication: windows of words that an earlier document already has are removed.

Super-k-mer partitioning. The minimiser of a window is the smallest hash among its runs of
``MINIMISER`` words. Consecutive windows with the same minimiser travel together as one packed
string to the bucket of that minimiser, where sorting brings equal windows of all documents
together and finds the smallest document of each.

* A first pass sends only (minimiser, document) with map-side combine: buckets that hold one
  document can't hold a repeat, so strings of other minimisers need not be packed. The tasks
  know the shared minimisers by a bit set of ``2 ** filter_bits`` bits, whatever the size of the
  corpus: a bit that two minimisers have in common costs a string that is sent in vain, and none
  is ever left out.
* A minimiser with more than ``hot_rows`` strings would be one task's work. Its windows travel
  one by one instead and are reduced by a group-by with map-side combine; there are at most
  rows / ``hot_rows`` such minimisers.
* Removal spans are per document. A second bit set tells which documents have some; only their
  texts are shuffled to meet the spans, all others are answered where they are read.

Defined results: null and empty texts have no words; a document with fewer words than a window
loses none; rows with a null id neither lose words nor make others lose some; rows that share an
id are one document, so none of them is earlier than another, each is answered, and a span is
applied only to the row whose words it was found in; an empty table gives an empty one. Batches are
cut into pieces of a few megabytes, a longer text is a piece of its own; other columns of the input,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm.arrays import (
    NOT_SPACE, Words, binary_slices, combine, longs, mix, pieces, ranges, split_words,
)
from clickloom.llm.bitsets import FILTER_BITS, bit_set, in_set
from clickloom.llm.tables import beside, read, stage

WINDOW = 13
MINIMISER = 3
# Windows in one packed string at most; a document that repeats one word has no end otherwise.
LONGEST = 64
HOT_ROWS = 200_000

PAIRS = "minimiser bigint, doc_id bigint"
STRINGS = "minimiser bigint, doc_id bigint, start int, packed binary"
RUNS = "doc_id bigint, start int, windows int, check bigint"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done = 1
    out = values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


def _super_kmers(
    piece: pa.RecordBatch, window: int, m: int
) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and per packed string: row, first word (in the piece), windows, minimiser."""
    words = split_words(piece.column("text"), NOT_SPACE, lower=False)
    n = len(words.at)
    none = np.zeros(0, np.int64)
    known = ~piece.column("doc_id").is_null().to_numpy(zero_copy_only=False)
    if n < window or not known.any():
        return words, none, none, none, none.astype(np.uint64)
    text = words.text_of()
    least = _sliding_min(mix(combine(words.hashes(), m)), window - m + 1)
    whole = (text[: len(least)] == text[window - 1 :]) & known[text[: len(least)]]
    at = np.flatnonzero(whole)
    if not len(at):
        return words, none, none, none, none.astype(np.uint64)
    least = least[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1]) | (text[at[1:]] != text[at[:-1]])
    begin = np.flatnonzero(fresh)
    within = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(fresh | (within % LONGEST == 0))
    counts = np.diff(np.append(begin, len(at)))
    return words, text[at[begin]], at[begin], counts, least[begin]


def _pairs(window: int, m: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            _, row, _, _, least = _super_kmers(piece, window, m)
            yield pa.RecordBatch.from_arrays(
                [longs(least), piece.column("doc_id").take(pa.array(row))], names=["minimiser", "doc_id"]
            )


def _strings(
    window: int, m: int, wanted, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Packed strings; with ``wanted``, a broadcast bit set, only of minimisers in it."""
    only = np.frombuffer(wanted.value, np.uint8) if wanted is not None else None
    for batch in batches:
        for piece in pieces(batch, "text"):
            words, row, at, counts, least = _super_kmers(piece, window, m)
            if only is not None and len(least):
                use = np.flatnonzero(in_set(only, least))
                row, at, counts, least = row[use], at[use], counts[use], least[use]
            if not len(least):
                continue
            end = at + counts + window - 2
            starts = words.at[at]
            yield pa.RecordBatch.from_arrays(
                [
                    longs(least),
                    piece.column("doc_id").take(pa.array(row)),
                    pa.array((at - words.first[row]).astype(np.int32)),
                    binary_slices(words.buffer, starts, words.at[end] + words.length[end] - starts),
                ],
                names=["minimiser", "doc_id", "start", "packed"],
            )


def _windows_of(rows: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Per window of packed strings: the string, its place in it, its hash; and the words."""
    words = split_words(rows.column("packed").cast(pa.string()), NOT_SPACE, lower=False)
    counts = words.counts() - window + 1
    at = ranges(words.first[:-1], counts)
    string = np.repeat(np.arange(rows.num_rows), counts)
    return string, at - words.first[string], combine(words.hashes(), window)[at], words


def _repeats(window: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    """Runs of windows, in whole buckets, that a smaller document has as well."""
    bucket = rows.column("minimiser").to_numpy()
    doc = rows.column("doc_id").to_numpy()
    start = rows.column("start").to_numpy()
    string, place, hashes, _ = _windows_of(rows, window)
    order = np.lexsort((doc[string], hashes, bucket[string]))
    b, h, d = bucket[string][order], hashes[order], doc[string][order]
    head = np.concatenate([[True], (b[1:] != b[:-1]) | (h[1:] != h[:-1])])
    least = d[np.flatnonzero(head)][np.cumsum(head) - 1]
    repeat = np.zeros(len(string), bool)
    repeat[order] = d > least
    at = np.flatnonzero(repeat)
    if not len(at):
        return _runs(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, np.uint64))
    fresh = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (string[at[1:]] != string[at[:-1]])])
    begin = np.flatnonzero(fresh)
    first = at[begin]
    return _runs(
        doc[string[first]], start[string[first]] + place[first],
        np.diff(np.append(begin, len(at))), hashes[first],
    )


def _runs(doc: np.ndarray, start: np.ndarray, windows: np.ndarray, check: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)),
         longs(check)],
        names=["doc_id", "start", "windows", "check"],
    )


def _buckets(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut a stream sorted by minimiser into whole buckets."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("minimiser").to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if held and held[-1].column("minimiser")[0].as_py() != keys[0]:
            yield _repeats(window, _joined(held))
            held = []
        if last:
            held.append(batch.slice(0, last))
            yield _repeats(window, _joined(held))
            held = []
        held.append(batch.slice(last))
    if held:
        yield _repeats(window, _joined(held))


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]


def _single_windows(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        string, place, hashes, words = _windows_of(batch, window)
        first = words.first[string] + place
        begin = words.at[first]
        end = words.at[first + window - 1] + words.length[first + window - 1]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(string)),
                pa.array((batch.column("start").to_numpy()[string] + place).astype(np.int32)),
                longs(hashes),
                binary_slices(words.buffer, begin, end - begin).cast(pa.string()),
            ],
            names=["doc_id", "start", "check", "words"],
        )


def _hot_runs(strings: DataFrame, window: int) -> DataFrame:
    """The same answer for the windows of hot minimisers, by group-by and join."""
    single = strings.mapInArrow(
        lambda b: _single_windows(window, b), "doc_id bigint, start int, check bigint, words string"
    )
    keyed = single.withColumn("words", F.sha2("words", 256))
    least = (
        keyed.groupBy("words").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most").select("words", "least")
    )
    return (
        keyed.join(least, "words").where("doc_id > least")
        .select("doc_id", "start", F.lit(1).alias("windows"), "check")
    )


def repeated_runs(
    docs: DataFrame, window: int = WINDOW, m: int = MINIMISER, hot_rows: int = HOT_ROWS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``(doc_id, start, windows, check)``: from word ``start``, that many consecutive windows
    also start in a smaller document; ``check`` is the hash of the first. Written to the
    shared folder."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pairs = texts.mapInArrow(lambda b: _pairs(window, m, b), PAIRS)
    shared = stage(
        pairs.groupBy("minimiser")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n"))
        .where("least < most").select("minimiser", (F.col("n") > hot_rows).alias("hot"))
    )
    hot = beside(stage(shared.where("hot").select("minimiser")))
    known = bit_set(shared.where("not hot").select(F.col("minimiser").alias("hash")), filter_bits)
    wanted = docs.sparkSession.sparkContext.broadcast(known)
    strings = texts.mapInArrow(lambda b: _strings(window, m, wanted, b), STRINGS)
    strings = strings.join(hot, "minimiser", "left_anti")
    dealt = strings.repartition("minimiser").sortWithinPartitions("minimiser")
    runs = dealt.mapInArrow(lambda b: _buckets(window, b), RUNS)
    if not hot.isEmpty():
        every = texts.mapInArrow(lambda b: _strings(window, m, None, b), STRINGS)
        runs = runs.unionAll(_hot_runs(every.join(hot, "minimiser", "left_semi"), window))
    return stage(runs)


def _marked(flags, wanted: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose document is in the bit set, or those whose is not."""
    bits = np.frombuffer(flags.value, np.uint8)
    for batch in batches:
        use = in_set(bits, batch.column("hash").to_numpy().view(np.uint64)) == wanted
        yield batch.select(["doc_id", "text"]).filter(pa.array(use))


def _apply(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            words = split_words(piece.column("text"), NOT_SPACE, lower=False)
            counts = words.counts()
            drop = np.zeros(len(words.at) + 1, np.int32)
            runs = piece.column("runs").to_pylist() if "runs" in piece.schema.names else []
            if any(runs):
                hashes = combine(words.hashes(), window).view(np.int64)
                for row, own in enumerate(runs):
                    for run in own or ():
                        at = int(words.first[row]) + run["start"]
                        end = at + run["windows"] + window - 1
                        if end <= words.first[row + 1] and hashes[at] == run["check"]:
                            drop[at] += 1
                            drop[end] -= 1
            keep = np.cumsum(drop[:-1]) == 0
            left = np.add.reduceat(np.append(keep, False).astype(np.int64), words.first[:-1])
            left = np.where(counts > 0, left, 0)
            if keep.all():
                buffer, length = words.buffer, words.length
            else:
                length = words.length[keep]
                buffer = words.buffer[ranges(words.at[keep], length + 1)]
            # Each word has a space behind it; the last one of a text is left out.
            ends = np.concatenate([[0], np.cumsum(length + 1)])
            first = np.concatenate([[0], np.cumsum(left)])
            begin = ends[first[:-1]]
            size = np.maximum(ends[first[1:]] - begin - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(counts - left, pa.int64()),
                    binary_slices(buffer, begin, size).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )


def without_repeats(
    docs: DataFrame, window: int = WINDOW, m: int = MINIMISER, hot_rows: int = HOT_ROWS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Per row ``doc_id, n_words, n_removed, kept``: the words that are left, joined by spaces."""
    runs = repeated_runs(docs, window, m, hot_rows, filter_bits)
    spans = runs.groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_list(F.struct("start", "windows", "check")).alias("runs")
    )
    named = runs.select(F.xxhash64("doc_id").alias("hash")).distinct()
    marked = docs.sparkSession.sparkContext.broadcast(bit_set(named, filter_bits))
    doc_id = F.col("doc_id").cast("bigint")
    texts = docs.select(doc_id.alias("doc_id"), "text", F.xxhash64(doc_id).alias("hash"))
    result = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    clean = texts.mapInArrow(lambda b: _apply(window, _marked(marked, False, b)), result)
    rest = texts.mapInArrow(lambda b: _marked(marked, True, b), "doc_id bigint, text string")
    joined = rest.join(spans, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "runs")
    return clean.unionAll(joined.mapInArrow(lambda b: _apply(window, b), result))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` without repeated windows, as a digest; odd rows as the module says."""
    kept = without_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS p
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT p, min(doc_id) AS least FROM k GROUP BY p HAVING min(doc_id) < max(doc_id)),
bad AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i
  FROM k JOIN m USING (p) WHERE doc_id > least),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM words ANTI JOIN bad USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
