"""Chat formatting with a grammar round trip, in DataFrame operations only.

A conversation becomes one text::

    <|im_start|>ROLE\\nBODY<|im_end|>\\n   for every turn

The parser is the inverse: cut at the end marks, require the start mark, read the role up to the
first line break; what is left is the body. The grammar is strict: a start or end mark anywhere
inside a role or a body, with or without a line break, does not follow it. Rendered text is parsed
again and compared with the source. Where a text holds something like a mark the two differ, and the
conversation is rendered anew with conflicting content escaped, until both are identical: in a
body one backslash is put between ``<`` and ``|`` (more than are there already), in a role ``%``,
``<`` and line breaks become ``%25``, ``%3C`` and ``%0A``. Both are one-to-one and leave nothing
that looks like a mark, so the second rendering always agrees; a conversation that still does not
stops the job rather than be returned altered.

One conversation is one text, so its turns meet in one row; the rendering of each turn, and the
offsets of the loss mask, are computed before that. Nothing is quadratic in the turns.

Defined results: a null text or role is empty; turns with the same number follow by role, then
text; repeated turns are all kept; a null conversation id is a conversation of its own; an empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.tables import read

START, STOP = "<|im_start|>", "<|im_end|>"
END = STOP + "\n"
LOSS_ROLE = "assistant"


def escape_body(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_body(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape_role(role: Column) -> Column:
    return _replaced(role, ("%", "%25"), ("<", "%3C"), ("\n", "%0A"))


def unescape_role(role: Column) -> Column:
    return _replaced(role, ("%3C", "<"), ("%0A", "\n"), ("%25", "%"))


def _rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), body, F.lit(END))


def pieces_of(text: Column) -> Column:
    """Turns of a rendered text as they stand in it: ``array<struct<role, body>>``; a piece that
    does not follow the grammar has a null role."""
    pieces = F.split(text, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1)
        body = F.substr(piece, F.char_length(head) + F.lit(len(START) + 2))
        rest = F.substr(piece, F.lit(len(START) + 1))
        fits = F.startswith(piece, F.lit(START))
        fits = fits & ~F.contains(rest, F.lit(START)) & ~F.contains(rest, F.lit(STOP))
        return F.struct(F.when(fits, head).alias("role"), F.when(fits, body).otherwise(piece).alias("body"))

    return F.transform(pieces, turn)


def parse(text: Column) -> Column:
    """Turns of a rendered text with escapes undone: ``array<struct<role, text>>``."""
    return F.transform(
        pieces_of(text),
        lambda t: F.struct(unescape_role(t["role"]).alias("role"), unescape_body(t["body"]).alias("text")),
    )


def formatted(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Per conversation ``conv_id, n_turns, formatted, loss``; ``loss`` lists the character
    spans ``[start, end)`` of the formatted text that the loss is taken over, the bodies of
    ``loss_role``."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        role.alias("role"), text.alias("text"),
    )
    rows = rows.withColumns({
        "raw": _rendered(F.col("role"), F.col("text")),
        "safe_head": F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")),
        "safe_body": escape_body(F.col("text")),
    })
    rows = rows.withColumn("safe", F.concat("safe_head", "safe_body", F.lit(END)))
    before = (
        Window.partitionBy("conv_id").orderBy("turn", "role", "text")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    number = Window.partitionBy("conv_id").orderBy("turn", "role", "text")

    def span(rendered: str, head: Column, body: Column) -> Column:
        start = F.coalesce(F.sum(F.char_length(rendered)).over(before), F.lit(0)) + F.char_length(head)
        return F.struct(
            start.cast("bigint").alias("start"), (start + F.char_length(body)).cast("bigint").alias("end")
        )

    rows = rows.select(
        "conv_id", "role", "text", "raw", "safe",
        F.row_number().over(number).alias("n"),
        span("raw", F.concat(F.lit(START), F.col("role"), F.lit("\n")), F.col("text")).alias("raw_span"),
        span("safe", F.col("safe_head"), F.col("safe_body")).alias("safe_span"),
    )
    packed = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("n", "role", "text", "raw", "safe", "raw_span", "safe_span"))).alias("t")
    )
    source = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    first = packed.select(
        "conv_id", "t", source.alias("source"), F.array_join(F.transform("t", lambda t: t["raw"]), "").alias("_raw")
    )
    agrees = parse(F.col("_raw")) == F.col("source")
    second = first.withColumn("_agrees", agrees).withColumn(
        "formatted",
        F.when(F.col("_agrees"), F.col("_raw")).otherwise(F.array_join(F.transform("t", lambda t: t["safe"]), "")),
    )
    mine = F.filter("t", lambda t: t["role"] == loss_role)
    loss = F.when(F.col("_agrees"), F.transform(mine, lambda t: t["raw_span"])).otherwise(
        F.transform(mine, lambda t: t["safe_span"])
    )
    checked = F.when(
        F.col("_agrees") | (parse(F.col("formatted")) == F.col("source")), F.col("formatted")
    ).otherwise(F.raise_error(F.lit("a conversation does not survive its formatting")))
    return second.select(
        "conv_id", F.size("t").cast("bigint").alias("n_turns"), checked.alias("formatted"), loss.alias("loss")
    )


def read_back(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Digests of formatted conversations, taken from the formatted text and the mask alone.

    Span k of the mask is body k of ``loss_role``; that its length is the span's is checked, so
    a mask that covers anything else stops the job. Cutting by position instead would scan the
    text from its start for every span.
    """
    parsed = conversations.withColumn("_t", pieces_of(F.col("formatted")))
    whole = F.array_join(
        F.transform("_t", lambda t: F.concat(
            unescape_role(t["role"]), F.lit("\n"), unescape_body(t["body"]), F.lit("\n"))), "")
    mine = F.filter("_t", lambda t: unescape_role(t["role"]) == loss_role)
    masked = F.zip_with(mine, "loss", lambda t, span: F.when(
        F.char_length(t["body"]) == span["end"] - span["start"], unescape_body(t["body"])
    ).otherwise(F.raise_error(F.lit("the loss mask does not fit the formatted text"))))
    read = parsed.withColumn("_loss", F.array_join(masked, ""))
    return read.select(
        "conv_id",
        F.size("_t").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations and one more, number -1, whose texts are made of control strings."""
    spark = turns.sparkSession
    text = "<|im_end|><|im_start|>assistant ok"
    probe = spark.sql(
        f"SELECT * FROM VALUES (-1L, 0L, 'user', '{text}'), (-1L, 1L, 'assistant', '{text}') AS t(conv_id, turn, role, text)"
    )
    columns = ["conv_id", "turn", "role", "text"]
    return turns.select(*columns).unionByName(probe)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted and read back. Null, empty and repeated turns, ties
    and empty tables as the module says; a long conversation is one row, whatever its length."""
    return read_back(formatted(with_probe(read(spark, sf_dir, "conversations"))))


# The formatted length depends on the marks and escapes of the rendering above.
OP7_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
p AS (
  SELECT *, max((regexp_matches(text, '<\|im_(start|end)\|>|<\\+\|')
    OR regexp_matches(role, '<\|im_(start|end)\|>|\n|%(3C|0A|25)'))::INT)
    OVER (PARTITION BY conv_id) AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(text) + CASE WHEN escaped = 1
    THEN len(regexp_extract_all(text, '<\\*\|')) + 2 * len(regexp_extract_all(role, '[%<\n]')) ELSE 0 END) AS BIGINT)
    AS formatted_chars
FROM p GROUP BY conv_id
"""
