"""When does an account first reach a greater session number?

Neither answer pairs intents with events. ``session_summary`` needs one aggregate row per
(account, session number); ``first_greater_after`` handles what that leaves open, which are
accounts whose session numbers step back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickloom.functions import floor_div, is_blank, parse_session_number

# Session numbers one window task looks at together; at most 2**31 / BLOCK blocks follow.
BLOCK = 65_536

_BITS = 31


def _sessions(events: DataFrame) -> DataFrame:
    return events.where(~is_blank("acc_id")).select(
        "acc_id",
        parse_session_number("session_id").alias("session_no"),
        "session_id",
        F.col("seq").cast("long").alias("seq"),
    )


def session_summary(events: DataFrame) -> DataFrame:
    """One row per (account, session number), over all events of the account.

    ``greater``: the first event of any greater number, the last one, and the greatest
    number (null when there is none). ``steps_back``: an event of this number comes after
    one of a greater number. ``rows``: events of this number.

    The aggregates combine on the map side. The window sees session numbers, not events or
    texts (all texts without digits are number 0), and at most ``BLOCK`` of them at a time: an
    account shared by many visitors may have any number of sessions.
    """
    # Grouping by the id text first keeps that aggregate, the one over all events, on
    # fixed-width buffers.
    texts = (
        _sessions(events)
        .groupBy("acc_id", "session_no", "session_id")
        .agg(
            F.min("seq").alias("first_seq"),
            F.max("seq").alias("last_seq"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    seen = (
        texts.groupBy("acc_id", "session_no")
        .agg(
            F.min(F.struct("first_seq", "session_id")).alias("first"),
            F.max("last_seq").alias("last_seq"),
            F.sum("rows").alias("rows"),
        )
        .withColumn("block", floor_div(F.col("session_no").cast("long"), BLOCK))
    )
    above = (
        Window.partitionBy("acc_id", "block")
        .orderBy(F.desc("session_no"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    folded = seen.select(
        "acc_id",
        "block",
        "session_no",
        F.min("first").over(above).alias("head"),
        F.max("last_seq").over(above).alias("last"),
        F.max("session_no").over(above).alias("top"),
        F.col("last_seq").alias("own_last"),
        "rows",
    )
    head = F.least("head", "head_beyond")
    greater = F.struct(
        head["first_seq"].alias("first_seq"),
        head["session_id"].alias("first_session_id"),
        F.greatest("last", "last_beyond").alias("last_seq"),
        F.greatest("top", "top_beyond").alias("top_no"),
    )
    return folded.join(_beyond(seen), ["acc_id", "block"], "left").select(
        "acc_id",
        "session_no",
        F.when(head.isNotNull(), greater).alias("greater"),
        F.coalesce(F.col("own_last") > head["first_seq"], F.lit(False)).alias("steps_back"),
        "rows",
    )


def _beyond(seen: DataFrame) -> DataFrame:
    """For each block of session numbers, what the account's higher blocks hold.

    Empty, and dropped at the scan, for accounts with fewer than ``BLOCK`` sessions.
    """
    upper = (
        seen.where(F.col("session_no") >= BLOCK)
        .groupBy("acc_id", "block")
        .agg(
            F.min("first").alias("head"),
            F.max("last_seq").alias("last"),
            F.max("session_no").alias("top"),
        )
    )
    downwards = Window.partitionBy("acc_id").orderBy(F.desc("block"))
    so_far = downwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return upper.select(
        "acc_id",
        F.coalesce(F.lead("block").over(downwards), F.lit(0)).alias("block"),
        F.min("head").over(so_far).alias("head_beyond"),
        F.max("last").over(so_far).alias("last_beyond"),
        F.max("top").over(so_far).alias("top_beyond"),
    )


def _nodes(bits, number):
    """(bit, number above that bit) for each listed bit position."""
    return F.transform(
        bits, lambda b: F.struct(b.alias("bit"), _shift(number, b + 1).alias("prefix"))
    )


def _shift(number, places):
    return F.call_function("shiftright", number.cast("long"), places.cast("int"))


def _bit(number, b):
    return _shift(number, b).bitwiseAND(F.lit(1))


def first_greater_after(stale: DataFrame, events: DataFrame, span: int) -> DataFrame:
    """For each intent the first later event of a greater session, up to its end.

    ``m > n`` holds exactly when, at some bit where ``n`` has 0, ``m`` has 1 and both agree
    above it. So each intent asks one node per zero bit and each event stands in one node
    per one bit, and within a node the question is only "which event comes next", a running
    window over ``seq``. Rows grow by the bit length of the numbers, never by pairs. Nodes
    are cut into ranges of ``span`` sequence numbers; the first event of a node beyond a
    range is copied to the end of that range.
    """
    positions = F.sequence(F.lit(0), F.lit(_BITS - 1))
    number = F.col("session_no")
    in_range = Window.partitionBy("acc_id", "range").orderBy("seq")
    visits = (
        _sessions(events)
        .join(stale.select("acc_id").distinct(), "acc_id", "left_semi")
        .withColumn("range", floor_div("seq", span))
        .repartition("acc_id", "range")
        .withColumn("earlier_no", F.lag(number).over(in_range))
    )
    # Of consecutive events with one number only the first can be the next greater one.
    points = visits.where((number > 0) & ~number.eqNullSafe(F.col("earlier_no"))).select(
        "acc_id",
        F.inline(_nodes(F.filter(positions, lambda b: _bit(number, b) == 1), number)),
        "seq",
        F.struct("seq", "session_id").alias("point"),
        F.lit(None).cast("string").alias("product_id"),
        F.lit(None).cast("string").alias("start_session_id"),
        F.lit(None).cast("long").alias("end_seq"),
    )
    asked = F.filter(
        positions, lambda b: (_bit(number, b) == 0) & (_shift(F.col("top_no"), b) > 0)
    )
    questions = stale.select(
        "acc_id",
        F.inline(_nodes(asked, number)),
        F.col("start_seq").alias("seq"),
        F.lit(None).cast("struct<seq: bigint, session_id: string>").alias("point"),
        "product_id",
        "start_session_id",
        "end_seq",
    )
    node = ["acc_id", "bit", "prefix"]
    rows = points.unionByName(questions).withColumn(
        "range", floor_div("seq", span)
    )
    beyond = (
        Window.partitionBy(*node)
        .orderBy(F.desc("range"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    copies = (
        rows.groupBy(*node, "range")
        .agg(F.min("point").alias("head"))
        .withColumn("point", F.last("head", ignorenulls=True).over(beyond))
        .where(F.col("point").isNotNull())
        .select(*node, "range", F.col("point.seq").alias("seq"), "point")
    )
    onwards = (
        Window.partitionBy(*node, "range")
        .orderBy(F.desc("seq"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answered = (
        rows.unionByName(copies, allowMissingColumns=True)
        .withColumn("next", F.last("point", ignorenulls=True).over(onwards))
        .where(F.col("point").isNull() & F.col("next").isNotNull())
        .where(F.col("end_seq").isNull() | (F.col("next.seq") <= F.col("end_seq")))
    )
    return (
        answered.groupBy("acc_id", "product_id", F.col("seq").alias("start_seq"))
        .agg(
            F.min("next").alias("next"),
            F.first("start_session_id").alias("start_session_id"),
        )
        .select(
            "acc_id",
            "product_id",
            F.col("next.seq").alias("seq"),
            "start_session_id",
            F.col("next.session_id").alias("current_session_id"),
        )
    )
