"""Periodic runs of words: maximal stretches that repeat a shorter one several times over.

A run is a stretch of consecutive words with smallest period q, at least ``max(min_length,
exponent * q)`` words long, that no neighbouring word extends keeping the period. Texts are
partitioned by Spark; the search works on whole Arrow batches, a few megabytes at a time:

1. Words are numbered. Ranks of the stretches of 1, 2, 4, ... words from every position follow by
   prefix doubling, only for positions whose shorter stretch occurs elsewhere in the same text; for
   all others the suffix is told apart already. The last ranks put the suffixes in order, and those
   of all levels give the longest common prefix (LCP) of neighbours in that order.
2. Kruskal by descending LCP: every neighbouring pair of suffixes is an edge with its LCP as weight.
   A union-find keeps for every class its positions in order. When two classes are united at
   weight l, positions that become neighbours in the united set, at distance d <= l, have d as a
   period over d + l words. All pairs that share more than l words have been united before, so a
   seed that is not followed from the left (the words before the two positions differ) is a
   maximal run, and its period is the smallest: with a smaller one, some position between the two
   would already be there. Every run is seeded by its first position and the one a period later.

Only edges of at least ``least_lcp`` words can seed a run, and lesser ones are left out: ordinary
text has next to none.

Defined results: null and empty texts have no words and no runs; ties of the longest run go to the
smallest start, then period; repeated rows are answered one by one and alike; a null id stays null; an
empty table gives an empty one; other columns of the input, whatever their names, are not read. The
memory of a task follows its batch piece or longest text (4 bytes a word for each doubling that
still has repeated stretches). No shuffle. Classes are united small to large; a list
of positions is moved in memory at an insertion, which for texts of millions of words, all in few
classes, takes most of the time.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.arrays import NOT_SPACE, binary_slices, pieces, split_words
from clickloom.llm.tables import read

MIN_LENGTH = 6
EXPONENT = 4
# Up to this many positions are inserted one by one into a larger set; more are merged with it.
FEW = 32

RUN = "struct<start: bigint, length: bigint, period: bigint>"
FOUND = f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string"


def least_lcp(min_length: int, exponent: int) -> int:
    """The fewest words that the first two periods of a run have in common: its length less its period."""
    return min(max(min_length, exponent * q) - q for q in range(1, min_length + 1))


def levels(words: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... words at every position, as far as any is repeated,
    and the ranks that tell all suffixes apart.

    ``words`` are numbers that differ from text to text, ``end`` is where each position's text
    ends. A rank is the place of the first suffix that begins so, in the order of all suffixes:
    it is final once a stretch occurs only once, and only the others are sorted again.
    """
    size = len(words)
    sorted_words = np.sort(words)
    rank = np.searchsorted(sorted_words, words).astype(np.int64)
    out, length, active = [], 1, np.arange(size)
    while True:
        active = active[np.bincount(rank, minlength=size)[rank[active]] > 1]
        if not len(active):
            return out, rank
        out.append(rank.astype(np.int32))
        behind = active + length
        # A text that ends here comes first; there is one such suffix in a class at most.
        follow = np.full(len(active), -1, np.int64)
        on = behind < end[active]
        follow[on] = rank[behind[on]]
        order = np.lexsort((follow, rank[active]))
        active, old, follow = active[order], rank[active][order], follow[order]
        fresh = np.concatenate([[True], old[1:] != old[:-1]])
        split = fresh | np.concatenate([[True], follow[1:] != follow[:-1]])
        place = np.arange(len(active))
        in_class = np.maximum.accumulate(np.where(split, place, 0)) - np.maximum.accumulate(np.where(fresh, place, 0))
        rank[active] = old + in_class
        length *= 2


def common(ranks: list[np.ndarray], left: np.ndarray, right: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many words the suffixes at two positions of a text share, by binary lifting."""
    length = np.zeros(len(left), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = left + length, right + length
        # Positions are in order: the right one reaches the end of the text first.
        on = np.flatnonzero(y < end[right])
        same = on[ranks[k][x[on]] == ranks[k][y[on]]]
        length[same] += 1 << k
    return length


def edges(
    ranks: list[np.ndarray], last: np.ndarray, end: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the order of suffixes that share at least ``least`` words, and how many."""
    # Their stretch at the highest level not above ``least`` is repeated.
    base = least.bit_length() - 1
    if len(ranks) <= base:
        return (np.zeros(0, np.int64),) * 3
    at = np.flatnonzero(np.bincount(ranks[base], minlength=len(last))[ranks[base]] > 1)
    order = at[np.argsort(last[at])]
    a, b = order[:-1], order[1:]
    same = ranks[base][a] == ranks[base][b]
    a, b = np.minimum(a[same], b[same]), np.maximum(a[same], b[same])
    shared = common(ranks, a, b, end)
    enough = shared >= least
    return a[enough], b[enough], shared[enough]


def _unite(small: list[int], large: list[int]) -> list[tuple[int, int]]:
    """Put the positions of ``small`` in their places in ``large``; those that are neighbours now
    but were in different sets."""
    if len(small) <= FEW:
        for x in small:
            insort(large, x)
    else:
        large.extend(small)
        large.sort()
    met, inside = [], set(small)
    for x in small:
        k = bisect_left(large, x)
        if k and large[k - 1] not in inside:
            met.append((large[k - 1], x))
        if k + 1 < len(large) and large[k + 1] not in inside:
            met.append((x, large[k + 1]))
    return met


def seeds(a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Kruskal over the edges: positions that become neighbours no further apart than the words
    that they share, with that number."""
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    order = np.argsort(-shared, kind="stable")
    for x, y, weight in zip(a[order].tolist(), b[order].tolist(), shared[order].tolist(), strict=True):
        x, y = find(x), find(y)
        if x == y:
            continue
        left, right = members.pop(x, None) or [x], members.pop(y, None) or [y]
        if len(left) > len(right):
            x, y, left, right = y, x, right, left
        root[x] = y
        members[y] = right
        for p, q in _unite(left, right):
            if q - p <= weight:
                yield p, q, weight


def find_runs(
    words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT
) -> np.ndarray:
    """Runs of several texts at once as rows ``text, start, length, period``, in this order.

    ``words`` are the words of all texts as numbers; text t has those from ``first[t]`` on.
    """
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(first[1:], sizes)
    own = text * np.int64(int(words.max(initial=0)) + 1) + words
    ranks, last = levels(own, end)
    found = []
    for p, q, shared in seeds(*edges(ranks, last, end, least_lcp(min_length, exponent))):
        period = q - p
        begin = first[text[p]]
        # Followed from the left, it is part of the run that the positions before it seed.
        if p > begin and words[p - 1] == words[q - 1]:
            continue
        if period + shared >= max(min_length, exponent * period):
            found.append((text[p], p - begin, period + shared, period))
    return np.array(sorted(found), np.int64).reshape(-1, 4)


def repeated(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words lie in a run behind its first period."""
    steps = np.zeros(int(first[-1]) + 1, np.int64)
    text, start, length, period = runs.T
    np.add.at(steps, first[text] + start + period, 1)
    np.add.at(steps, first[text] + start + length, -1)
    return np.cumsum(steps[:-1]) > 0


def _found(min_length: int, exponent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            words = split_words(piece.column("text"), NOT_SPACE, lower=False)
            numbers = pc.dictionary_encode(words.as_binary()).indices.to_numpy().astype(np.int64)
            runs = find_runs(numbers, words.first, min_length, exponent)
            keep = ~repeated(runs, words.first)
            kept = np.concatenate([[0], np.cumsum(keep)])[words.first]
            # Every kept word with the space behind it; the last space of a text is cut off.
            joined = words.buffer[np.repeat(keep, words.length + 1)]
            place = np.concatenate([[0], np.cumsum((words.length + 1)[keep])])[kept]
            bytes_each = np.maximum(np.diff(place) - 1, 0)
            collapsed = binary_slices(joined, place[:-1], bytes_each).cast(pa.string())
            offsets = np.searchsorted(runs[:, 0], np.arange(piece.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(runs[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"])
            )
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(words.counts().astype(np.int64)), lists, collapsed],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """Per row ``doc_id, n_words``, its ``runs`` by start, then period, and ``collapsed``, the text
    without the words that repeat a run's first period, joined by one space."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lambda b: _found(min_length, exponent, b), FOUND)


def longest(runs: Column) -> Column:
    """The run with the greatest length; of those the one with the smallest start, then period."""
    keys = F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(keys)
    return F.when(best.isNotNull(), F.struct(
        best["start"].alias("start"), (-best["l"]).alias("length"), best["period"].alias("period")))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: one text of ten ends in a repetition, at a place, with a period and for
    a number of times that follow from its id and its number of words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    trimmed = F.regexp_replace(F.coalesce("text", F.lit("")), r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")

    def planted(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("bigint")
        place = F.transform(
            F.sequence(F.lit(0).cast("bigint"), n - 1),
            lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)),
        )
        # One array of one list: the list is made once and read for every word.
        return F.array_join(F.transform(place, lambda i: F.get(words, i.cast("int"))), " ")

    words = F.array(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    changed = F.get(F.transform(words, planted), F.lit(0))
    use = (F.pmod(h, F.lit(10)) == 0) & (trimmed != "")
    return docs.select("doc_id", F.when(use, changed).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every text of ``documents``, one text of ten given a repetition, as digests.
    Nulls, empty and long texts, repeated rows and empty tables as the module says."""
    found = periodic_runs(with_planted_periods(read(spark, sf_dir, "documents")))
    best = longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT doc_id, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
      lambda k: [ord(substr(doc_id::VARCHAR, k, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT DISTINCT doc_id FROM documents)),
v AS (
  SELECT doc_id, xor(c, 4294967295) AS h, xor(c, 4294967295) // 10 AS g,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents JOIN crc USING (doc_id)),
m AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) ELSE len(w) END AS a FROM v),
d AS (
  SELECT doc_id, n, CASE WHEN a < n THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i
    ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM m),
s AS (
  SELECT doc_id, n, i, hash(array_to_string(w[i + 1:i + 5], ' ')) AS x
  FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS i FROM d WHERE n >= 6)),
p AS (
  SELECT l.doc_id, l.i, r.i - l.i AS q FROM s l JOIN s r ON l.doc_id = r.doc_id AND l.x = r.x AND r.i > l.i
  WHERE 4 * (r.i - l.i) <= l.n),
island AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM p) GROUP BY doc_id, q, k),
run AS (
  SELECT doc_id, start, length, min(q) AS period FROM island WHERE length >= greatest(6, 4 * q)
  GROUP BY doc_id, start, length),
best AS (
  SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
lists AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period,
  1000 * b.length // b.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
