"""Benchmark decontamination with an FM-index per shard of the training text.

Words of the benchmark get numbers. A word outside that vocabulary can't be part of an
occurrence, so in a shard it acts as a separator, and stretches between separators that are
shorter than the shortest phrase are left out of the index; every word of every text is read
for that. Over the rest of a shard a task builds the index: suffix order, Burrows-Wheeler
transform in a wavelet matrix, every ``SAMPLE``-th suffix position. All phrases are searched
backwards at once, their occurrences located by walking to sampled positions, and the word
spans merged per document. Documents are never shuffled.

The phrases are the stated query set. They are read in blocks of at most ``BLOCK_WORDS`` words,
each sent to the tasks as one array. With more than one block the texts are searched once per
block, one block after the other, and what was found is written before the next block is read: the
driver never holds more than three blocks. Spans and items of a document are merged afterwards.

Defined results: a null text and an empty one have no words; a null or empty item has no
phrase; an item with a null id marks words but is not listed; repeated rows of documents are
answered one by one, repeated items count once; without benchmark rows nothing is hit. Columns
of the input beyond ``doc_id`` and ``text`` are not touched. There are no ties: every occurrence
counts. Batches are cut into pieces of a few megabytes, a longer text is a piece of its own;
a shard holds whole pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm.arrays import ALNUM, Words, pieces, ranges, split_words
from clickloom.llm.tables import beside, read, stage

WINDOW = 10
SAMPLE = 8
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 2_000_000

SPANS = "doc_id bigint, text string, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


class WaveletMatrix:
    """Rank and access over a sequence of numbers, one bit level after the other."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.bits = bits
        for bit in range(bits - 1, -1, -1):
            ones = ((sequence >> bit) & 1).astype(bool)
            before = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            zeros = len(sequence) - int(before[-1])
            self.levels.append((before, zeros))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``at``."""
        low, high = np.zeros_like(at), at.copy()
        for k, (before, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            low = np.where(one, zeros + before[low], low - before[low])
            high = np.where(one, zeros + before[high], high - before[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol, at = np.zeros_like(at), at.copy()
        for before, zeros in self.levels:
            one = (before[at + 1] - before[at]).astype(bool)
            symbol = (symbol << 1) | one
            at = np.where(one, zeros + before[at], at - before[at])
        return symbol


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of a sequence ordered by the suffixes that start there (prefix doubling)."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        tail = np.full(n, -1, np.int64)
        tail[: n - step] = rank[step:]
        key = rank * (n + 1) + tail + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if step >= n or new[-1] == n - 1:
            return order


class FMIndex:
    """Backward search and location over symbols that are at least 1."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        text = np.concatenate([symbols.astype(np.int64), [0]])
        order = suffix_order(text)
        last = text[order - 1]
        top = int(text.max())
        self.wavelet = WaveletMatrix(last, max(1, top.bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.size = len(text)
        marked = order % sample == 0
        self.marked = marked
        self.mark_rank = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases; row p of ``phrases`` has ``lengths[p]`` symbols."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        top = len(self.before) - 2
        for k in range(phrases.shape[1]):
            at = lengths - 1 - k
            live = np.flatnonzero((at >= 0) & (high > low))
            symbol = phrases[live, at[live]]
            known = symbol <= top
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.before[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to a sampled one."""
        found = np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(left):
            done = self.marked[rows]
            found[left[done]] = self.sampled[self.mark_rank[rows[done]]] + steps
            left, rows, steps = left[~done], rows[~done], steps + 1
            if len(left):
                symbol = self.wavelet.access(rows)
                rows = self.before[symbol] + self.wavelet.rank(symbol, rows)
        return found


@dataclass
class Phrases:
    """Distinct windows as rows of word numbers, and the items each of them comes from."""

    vocabulary: pa.Array
    rows: np.ndarray
    lengths: np.ndarray
    item_at: np.ndarray
    items: list[str | None]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def phrases_of(items: list[str | None], texts: list[str | None], window: int) -> Phrases:
    words = split_words(pa.array(texts, pa.string()), ALNUM, lower=True)
    coded = words.as_binary().dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64) + 1
    owners: dict[tuple, set[int]] = {}
    for k in range(len(items)):
        own = numbers[words.first[k] : words.first[k + 1]]
        length = min(window, len(own))
        for start in range(len(own) - length + 1 if length else 0):
            owners.setdefault(tuple(own[start : start + length]), set()).add(k)
    rows = np.zeros((len(owners), window), np.int64)
    lengths = np.zeros(len(owners), np.int64)
    listed, counts = [], []
    for p, (phrase, who) in enumerate(owners.items()):
        rows[p, : len(phrase)] = phrase
        lengths[p] = len(phrase)
        counts.append(len(who))
        listed.extend(items[k] for k in sorted(who))
    return Phrases(
        coded.dictionary, rows, lengths, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), listed
    )


def _occurrences(symbols: np.ndarray, known: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Phrase numbers and start positions of all occurrences in a sequence (0: separator)."""
    inside = symbols > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    long_enough = ends - starts >= known.shortest
    starts, ends = starts[long_enough], ends[long_enough]
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none
    # Every stretch with one separator behind it; symbols move up by one for the separator.
    takes = ends - starts + 1
    place = ranges(starts, takes)
    kept = np.where(place < np.repeat(ends, takes), symbols[np.minimum(place, len(symbols) - 1)] + 1, 1)
    index = FMIndex(kept)
    low, high = index.search(known.rows + 1, known.lengths)
    counts = high - low
    phrase = np.repeat(np.arange(len(low)), counts)
    return phrase, place[index.locate(ranges(low, counts))]


def _search(known: Phrases, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple[pa.RecordBatch, Words, np.ndarray]] = []
    held = 0
    for batch in batches:
        for piece in pieces(batch, "text"):
            words = split_words(piece.column("text"), ALNUM, lower=True)
            coded = pc.index_in(words.as_binary(), value_set=known.vocabulary)
            waiting.append((piece, words, pc.fill_null(coded, -1).to_numpy().astype(np.int64) + 1))
            held += len(words.at)
            if held >= SHARD_WORDS:
                yield from _shard(known, waiting)
                waiting, held = [], 0
    if waiting:
        yield from _shard(known, waiting)


def _shard(known: Phrases, waiting: list) -> Iterator[pa.RecordBatch]:
    # A separator between texts keeps phrases from running across them.
    counts = np.concatenate([w.counts() for _, w, _ in waiting])
    begins = np.concatenate([[0], np.cumsum(counts + 1)])
    symbols = np.zeros(begins[-1], np.int64)
    symbols[ranges(begins[:-1], counts)] = np.concatenate([n for _, _, n in waiting])
    phrase, at = _occurrences(symbols, known) if len(known.lengths) else (np.zeros(0, np.int64),) * 2
    text = np.searchsorted(begins, at, side="right") - 1
    order = np.lexsort((at, text))
    phrase, at, text = phrase[order], at[order], text[order]
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    for t, begin, p in zip(text.tolist(), (at - begins[text]).tolist(), phrase.tolist(), strict=True):
        end = begin + int(known.lengths[p])
        own = spans.setdefault(t, [])
        if own and begin <= own[-1]["end"]:
            own[-1]["end"] = max(own[-1]["end"], end)
        else:
            own.append({"start": begin, "end": end})
        items.setdefault(t, set()).update(known.items[known.item_at[p] : known.item_at[p + 1]])
    done = 0
    for piece, words, _ in waiting:
        rows = range(done, done + piece.num_rows)
        done += piece.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                piece.column("text").cast(pa.string()),
                pa.array(words.counts(), pa.int64()),
                pa.array([spans.get(t, []) for t in rows],
                         pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array([sorted(i for i in items.get(t, ()) if i is not None) for t in rows],
                         pa.list_(pa.string())),
            ],
            names=["doc_id", "text", "n_words", "spans", "items"],
        )


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list]:
    """The items in blocks of bounded size, streamed to the driver."""
    rows = benchmark.select(F.col("item_id").cast("string"), "text").where("text is not null")
    block, held = [], 0
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        held += len(text) // 2 + 1
        if held >= block_words:
            yield block
            block, held = [], 0
    if block:
        yield block


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per document ``doc_id, text, n_words``, the merged word ``spans`` that occurrences of
    benchmark windows cover, and the sorted ids of the ``items`` that occur."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = _blocks(benchmark, block_words)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return _searched(texts, first, window)
    written = [
        stage(
            _searched(texts, block, window).where("size(spans) > 0")
            .select("doc_id", _text_key().alias("_text"), "spans", "items").distinct()
        )
        for block in chain([first, second], blocks)
    ]
    return _merged(_searched(texts, [], window), written)


def _searched(texts: DataFrame, block: list, window: int) -> DataFrame:
    known = phrases_of([i for i, _ in block], [t for _, t in block], window)
    return texts.mapInArrow(lambda b: _search(known, b), SPANS)


def _text_key():
    return F.sha2("text", 256)


def _merged(every: DataFrame, written: list[DataFrame]) -> DataFrame:
    """All rows with what several phrase blocks found in them; rows that agree in ``doc_id`` and
    ``text`` hold the same."""
    found = reduce(DataFrame.unionAll, written).groupBy("doc_id", "_text").agg(
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("_spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"),
    )
    merged = F.aggregate(
        F.array_sort("_spans"),
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(
                    F.element_at(acc, -1)["start"].alias("start"),
                    F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                ).cast("struct<start:int,end:int>")),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    hits = stage(found.select(F.col("doc_id").alias("_id"), "_text", merged.alias("_merged"), "_items"))
    joined = every.join(
        beside(hits), F.col("doc_id").eqNullSafe(F.col("_id")) & (_text_key() == F.col("_text")), "left"
    )
    return joined.select(
        "doc_id", "text", "n_words", F.coalesce("_merged", "spans").alias("spans"),
        F.coalesce("_items", "items").alias("items"),
    )


def report(spans: DataFrame) -> DataFrame:
    """The digest columns of ``contaminated_spans``."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return spans.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, all columns as they were.

    The keys of the others are written first and kept out by an anti-join, broadcast only when
    small; rows that agree in ``doc_id`` and ``text`` are judged alike.
    """
    bad = contaminated_spans(docs, benchmark, window).where("size(spans) > 0")
    bad = stage(bad.select("doc_id", F.xxhash64("text").alias("_text")).distinct())
    right = beside(bad).select(F.col("doc_id").alias("__bad_id"), F.col("_text").alias("__bad_text"))
    left = docs.join(
        right,
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("__bad_id"))
        & (F.xxhash64("text") == F.col("__bad_text")),
        "left_anti",
    )
    return left


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark windows in every text of ``documents``, counted; odd rows as the module says."""
    return report(contaminated_spans(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


OP6_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ph AS (
  SELECT DISTINCT item_id, len(w[i:i + least(10, len(w)) - 1]) AS n,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
        FROM bw WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM ph),
cand AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM dw, ns WHERE len(w) >= n)),
occ AS (SELECT c.doc_id, c.i, c.n, ph.item_id FROM cand c JOIN ph ON c.p = ph.p AND c.n = ph.n),
hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(t.n_items, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hits h USING (doc_id) LEFT JOIN its t USING (doc_id)
"""
