"""Fill-in-middle: a text is cut in three and its middle is moved to the end.

Everything of a batch happens in ``pyarrow.compute``. Texts are split into units (runs of letters
A to Z, or any other single code point) as list arrays; the lists are flattened beside the index
of their row; a unit's ordinal in its row gives it the role prefix, middle or suffix; the units of
each role are filtered, put in lists again, and every list is joined to one piece. The pieces are
then joined with the marks. ``unfilled`` is the way back, from output and form alone.

Units are told apart by a separator put behind each of them, NUL A NUL. It cannot be mistaken: a
unit is a run of letters, which has no NUL, or one code point; if that is a NUL, another NUL and no
A follows.

Defined results: a null text counts as empty; an empty text, one that holds a mark, and one that
the dice leave out are ``plain``, the text itself, with null piece lengths; a null id rolls the dice
of the empty string; repeated rows are answered one by one and alike; an empty table gives an empty
one; other columns of the input, whatever their names, are not read. There are no ties. Batches are cut into
pieces of a few megabytes; a longer text is a piece of its own, so the memory of a task follows the
longest text (about 60 bytes a unit). No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.arrays import pieces
from clickloom.llm.tables import read

UNIT = "([A-Za-z]+|[^A-Za-z])"
SEPARATOR = "\x00A\x00"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Of 100 texts, the number that is transformed, and of 100 of those, the number in suffix-first form.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = 1

OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
RESTORED = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored string"


def dice(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the id: the first groups of eight hexadecimal digits of a hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Lists of units, each with an empty string at its end, and the number of units."""
    marked = pc.replace_substring_regex(texts, UNIT, r"\1" + SEPARATOR)
    lists = pc.split_pattern(marked, SEPARATOR)
    return lists, pc.subtract(pc.cast(pc.list_value_length(lists), pa.int64()), 1)


def _joined(flat: pa.Array, chosen: pa.Array, sizes: pa.Array) -> pa.Array:
    """The chosen units as one string per row; ``sizes`` says how many each row has."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes)])
    lists = pa.LargeListArray.from_arrays(offsets, pc.filter(flat, chosen))
    return pc.binary_join(lists, pa.scalar("", flat.type))


def cut(lists: pa.Array, n: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Prefix, middle and suffix of every row: the units before ``first``, those from there up to
    ``second``, and the rest."""
    flat, row = pc.list_flatten(lists), pc.cast(pc.list_parent_indices(lists), pa.int64())
    begins = pc.cast(lists.offsets.slice(0, len(lists)), pa.int64())
    begins = pc.subtract(begins, begins[0]) if len(begins) else begins
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(begins, row))
    before = pc.less(ordinal, pc.take(first, row))
    until = pc.less(ordinal, pc.take(second, row))
    inside = pc.less(ordinal, pc.take(n, row))
    return (
        _joined(flat, before, first),
        _joined(flat, pc.and_not(until, before), pc.subtract(second, first)),
        _joined(flat, pc.and_not(inside, until), pc.subtract(n, second)),
    )


def _remainder(value: pa.Array, by: pa.Array | int) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def _with_marks(*parts: str | pa.Array) -> pa.Array:
    parts = [pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in parts]
    return pc.binary_join_element_wise(*parts, pa.scalar("", pa.large_string()))


def _filled(transformed: int, suffix_first: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            texts = pc.fill_null(piece.column("text").cast(pa.large_string()), "")
            h = [piece.column(f"h{k}") for k in range(1, 5)]
            lists, n = units(texts)
            ends = [_remainder(x, pc.add(n, 1)) for x in h[:2]]
            first, second = pc.min_element_wise(*ends), pc.max_element_wise(*ends)
            prefix, middle, suffix = cut(lists, n, first, second)
            plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_remainder(h[2], 100), transformed))
            for mark in (PREFIX, SUFFIX, MIDDLE):
                plain = pc.or_(plain, pc.match_substring(texts, mark))
            spm = pc.less(_remainder(h[3], 100), suffix_first)
            form = pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM))
            output = pc.if_else(plain, texts, pc.if_else(
                spm,
                _with_marks(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
                _with_marks(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle),
            ))
            none = pa.scalar(None, pa.int64())
            lengths = (pc.if_else(plain, none, pc.cast(pc.utf8_length(p), pa.int64())) for p in (prefix, middle))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), n, form, *lengths, output.cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def filled(
    docs: DataFrame, seed: int = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """Per row ``doc_id, n, form, prefix_chars, middle_chars, output``: ``n`` units, and the text in
    its form, ``<P>prefix<S>suffix<M>middle`` (psm), ``<S>suffix<P>prefix<M>middle`` (spm) or as it
    was (plain)."""
    h = dice(F.col("doc_id"), seed)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *(value.alias(f"h{k}") for k, value in enumerate(h, 1)),
    )
    return rows.mapInArrow(lambda b: _filled(transformed, suffix_first, b), OUTPUT)


def _halves(texts: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and behind the first ``mark``; the second is empty where there is none."""
    lists = pc.split_pattern(texts, mark, max_splits=1)
    padded = pc.list_slice(lists, 0, 2, return_fixed_size_list=True)
    return pc.list_element(padded, 0), pc.fill_null(pc.list_element(padded, 1), "")


def _unfilled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "output"):
            output, form = piece.column("output").cast(pa.large_string()), piece.column("form")
            spm = pc.equal(form, SPM)
            # The first mark opens the output; the other two divide what follows.
            opened = pc.utf8_slice_codeunits(output, len(PREFIX))
            head, middle = _halves(opened, MIDDLE)
            suffix_s, prefix_s = _halves(head, PREFIX)
            prefix_p, suffix_p = _halves(head, SUFFIX)
            text = pc.if_else(
                spm, _with_marks(prefix_s, middle, suffix_s), _with_marks(prefix_p, middle, suffix_p)
            )
            text = pc.if_else(pc.equal(form, PLAIN), output, text).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*piece.columns, text], names=[*piece.schema.names, "restored"])


def unfilled(rows: DataFrame) -> DataFrame:
    """The rows of ``filled`` and in ``restored`` their texts, rebuilt from ``output`` and ``form``.

    A transformed text holds no mark, and no mark can begin in a piece and end in the mark behind
    it, as "<" stands only at the beginning of a mark; so the first mark found is the right one.
    """
    return rows.mapInArrow(_unfilled, RESTORED)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` in its fill-in-middle form, as digests of output and of the text
    rebuilt from it. Nulls, empty and long texts, repeated rows and empty tables as the module says."""
    rows = unfilled(filled(read(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
r AS (
  SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
    ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM h),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
    array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
