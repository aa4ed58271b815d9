"""Line deduplication: lines that many documents share go from all of them.

Every line travels as a 128-bit hash of its key with document and position, never as text.
Hashes are dealt by range on (hash, document), so a line that a third of all documents share
spreads over many partitions, and sorted by hash, document and position. A task streams its
range, counts documents at their first occurrence and releases positions as soon as a line has
enough of them; it holds rows of fewer than ``min_docs`` documents. A line that may continue in
a neighbouring range, at most two per partition, is settled by adding up the counts of its
parts. What comes back per document is a compressed bitmap of the lines to keep.

Defined results: a null or empty text is one empty line; keys without characters are never
dropped; rows that agree in ``doc_id`` and ``text`` are one document for counting, each is
answered; null ids answered; null ids are a document like any other; an empty table gives an empty one. There are
no ties: a key is dropped by its number of documents alone. Batches are cut into pieces of a few
megabytes, a longer text is a piece of its own. Columns that are not carried are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm.arrays import pieces
from clickloom.llm.tables import beside, read, stage

MIN_DOCS = 10
MIN_CHARS = 1

LINES = "h1 bigint, h2 bigint, doc_id bigint, doc bigint, pos int"
MARKS = "kind int, h1 bigint, h2 bigint, docs bigint, doc_id bigint, doc bigint, pos int"
FREQUENT, PENDING, PART = 0, 1, 2


def _hashes(min_chars: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        for piece in pieces(batch, "text"):
            keys, rows, places = [], [], []
            for row, text in enumerate(piece.column("text").cast(pa.large_binary()).to_pylist()):
                for at, line in enumerate((text or b"").lower().split(b"\n")):
                    key = line.strip()
                    # The number of bytes bounds the number of code points from above.
                    if len(key) >= min_chars and (
                        min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars
                    ):
                        keys.append(digest(key))
                        rows.append(row)
                        places.append(at)
            halves = np.frombuffer(b"".join(keys), ">i8").reshape(-1, 2).astype(np.int64)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    piece.column("doc_id").take(taken),
                    piece.column("doc").take(taken),
                    pa.array(places, pa.int32()),
                ],
                names=["h1", "h2", "doc_id", "doc", "pos"],
            )


class _Run:
    """The rows of one line in one partition, as far as they have come."""

    def __init__(self, key: tuple[int, int], first: bool):
        self.key, self.first = key, first
        self.docs, self.last = 0, None
        self.held: list[pa.RecordBatch] = []

    def add(self, rows: pa.RecordBatch, doc_id: np.ndarray, doc: np.ndarray, new: np.ndarray) -> None:
        """``new``: rows whose document differs from the row before."""
        continues = self.last == (doc_id[0], doc[0])
        self.docs += int(new[1:].sum()) + (not continues)
        self.last = (doc_id[-1], doc[-1])
        self.held.append(rows)


def _marked(kind: int, rows: pa.RecordBatch, docs: int) -> pa.RecordBatch:
    n = rows.num_rows
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, kind, np.int32)),
            rows.column("h1"),
            rows.column("h2"),
            pa.array(np.full(n, docs, np.int64)),
            rows.column("doc_id"),
            rows.column("doc"),
            rows.column("pos"),
        ],
        names=["kind", "h1", "h2", "docs", "doc_id", "doc", "pos"],
    )


def _ended(run: _Run, edge: bool, min_docs: int) -> Iterator[pa.RecordBatch]:
    if edge:
        h1, h2 = run.key
        yield pa.RecordBatch.from_pylist(
            [{"kind": PART, "h1": h1, "h2": h2, "docs": run.docs, "doc_id": None, "doc": None, "pos": None}],
            schema=_MARK_SCHEMA,
        )
    if edge and run.docs < min_docs:
        for rows in run.held:
            yield _marked(PENDING, rows, 0)


_MARK_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("docs", pa.int64()),
     ("doc_id", pa.int64()), ("doc", pa.int64()), ("pos", pa.int32())]
)


def _frequent(min_docs: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one sorted range: rows of frequent lines, and what is open at its two ends."""
    run: _Run | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h1 = batch.column("h1").to_numpy()
        h2 = batch.column("h2").to_numpy()
        ids = batch.column("doc_id")
        doc_id = ids.fill_null(-(2**63)).to_numpy()
        doc = batch.column("doc").to_numpy()
        new_line = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        new_doc = new_line | np.concatenate(
            [[True], (doc[1:] != doc[:-1]) | (doc_id[1:] != doc_id[:-1])]
        )
        starts = np.flatnonzero(new_line)
        ends = np.append(starts[1:], n)
        docs = np.add.reduceat(new_doc.astype(np.int64), starts)
        # Runs that begin and end inside this batch need no state.
        inner = (np.arange(len(starts)) > 0) & (np.arange(len(starts)) < len(starts) - 1)
        often = np.repeat(inner & (docs >= min_docs), ends - starts)
        if often.any():
            yield _marked(FREQUENT, batch.filter(pa.array(often)), 0)
        for k in sorted({0, len(starts) - 1}):
            key = (int(h1[starts[k]]), int(h2[starts[k]]))
            if run is None or run.key != key:
                if run is not None:
                    yield from _ended(run, run.first, min_docs)
                run = _Run(key, first=run is None)
            part = slice(starts[k], ends[k])
            run.add(batch.slice(starts[k], ends[k] - starts[k]), doc_id[part], doc[part], new_doc[part])
            if run.docs >= min_docs:
                for rows in run.held:
                    yield _marked(FREQUENT, rows, 0)
                run.held = []
    if run is not None:
        yield from _ended(run, True, min_docs)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of dropped positions to compressed bitmaps; bits beyond the last one are kept."""
    for batch in batches:
        maps = []
        for places in batch.column("places").to_pylist():
            # Whole bytes, padded with kept lines.
            keep = np.ones((max(places) // 8 + 1) * 8, bool)
            keep[places] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("doc"), pa.array(maps, pa.binary())],
            names=["doc_id", "doc", "keep"],
        )


def _identified(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    doc_id = F.col("doc_id").cast("bigint")
    more = [F.struct(*carry).alias("carried")] if carry else []
    return docs.select(doc_id.alias("doc_id"), "text", F.xxhash64(doc_id, "text").alias("doc"), *more)


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, doc, keep)`` for every document that loses a line; ``doc`` is the hash of id
    and text, ``keep`` a zlib-compressed bitmap by line. Written to the shared folder."""
    lines = _identified(docs).mapInArrow(lambda b: _hashes(min_chars, b), LINES)
    dealt = lines.repartitionByRange("h1", "h2", "doc_id", "doc")
    ordered = dealt.sortWithinPartitions("h1", "h2", "doc_id", "doc", "pos")
    marks = stage(ordered.mapInArrow(lambda b: _frequent(min_docs, b), MARKS))
    # At most two lines per partition are open, and each row of this is one of them.
    settled = (
        marks.where(F.col("kind") == PART).groupBy("h1", "h2")
        .agg(F.sum("docs").alias("total")).where(F.col("total") >= min_docs).select("h1", "h2")
    )
    pending = marks.where(F.col("kind") == PENDING).join(settled, ["h1", "h2"], "left_semi")
    columns = ["doc_id", "doc", "pos"]
    dropped = marks.where(F.col("kind") == FREQUENT).select(columns).unionAll(pending.select(columns))
    places = dropped.groupBy("doc_id", "doc").agg(F.collect_set("pos").alias("places"))
    return stage(places.mapInArrow(_bitmaps, "doc_id bigint, doc bigint, keep binary"))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            total, lost, kept = [], [], []
            texts = piece.column("text").cast(pa.large_binary()).to_pylist()
            for text, bitmap in zip(texts, piece.column("keep").to_pylist(), strict=True):
                text = text or b""
                lines = text.count(b"\n") + 1
                n_lost = 0
                if bitmap is not None:
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)
                    cut = text.split(b"\n")
                    rest = [x for k, x in enumerate(cut) if k >= len(keep) or keep[k]]
                    n_lost = lines - len(rest)
                    text = b"\n".join(rest)
                total.append(lines)
                lost.append(n_lost)
                kept.append(text)
            carried = [c for c in piece.schema.names if c == "carried"]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("doc"), pa.array(total, pa.int64()),
                 pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                 *(piece.column(c) for c in carried)],
                names=["doc_id", "doc", "n_lines", "n_dropped", "kept", *carried],
            )


def without_common_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Per row ``doc_id, doc, n_lines, n_dropped, kept``: the text without the lines whose key
    stands in at least ``min_docs`` documents; and the columns in ``carry`` as they were, one
    with the name of a result as ``<name>_carried``."""
    keep = beside(keep_bitmaps(docs, min_docs, min_chars))
    keep = keep.select(F.col("doc_id").alias("_id"), F.col("doc").alias("_doc"), "keep")
    rows = _identified(docs, carry)
    carried = [c for c in rows.columns if c == "carried"]
    joined = rows.join(
        keep, (rows.doc == F.col("_doc")) & rows.doc_id.eqNullSafe(F.col("_id")), "left"
    ).select("doc_id", "doc", "text", "keep", *carried)
    schema = "doc_id bigint, doc bigint, n_lines bigint, n_dropped bigint, kept string"
    if carry:
        schema += f", carried {rows.schema['carried'].dataType.simpleString()}"
    applied = joined.mapInArrow(_apply, schema)
    own = applied.columns[:5]
    return applied.select(
        *own, *(F.col(f"carried.`{c}`").alias(f"{c}_carried" if c in own else c) for c in carry)
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` without its common lines, as a digest; odd rows as the module says."""
    kept = without_common_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
f AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f USING (key) GROUP BY doc_id
"""
