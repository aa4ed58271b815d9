"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A document of a source with rate r = target / size is due r copies: floor(r) for sure and one
more with probability r - floor(r). The fractional parts are rounded dependently: two units
exchange probability, weighted by their sizes so that the expected words stay as they are, until
one of them is 0 or 1. The one that is left goes on to meet the next, so of any group of units
all but one are settled, and the words taken by the group differ from their expectation by the
residual of that one.

Units are dealt by hash into groups of about ``FAN`` within their source and folded there; the
residuals form the next, ``FAN`` times smaller level of a reduction tree, until one is left per
source, which is rounded on its own. A source with most of the rows has most of the groups, never
a larger one. Chance is a hash of seed and units: reruns agree, whatever the partitioning.

Defined results: a null or empty text has size 0 and is taken 0 words; null is a source of its
own, last in order; units that agree in every way (id, source, size) are folded into one with a
number and share the same decision; an empty table gives an empty one. Ties between sources are
none, as their names differ; a text of any length is only counted, in the JVM. Other columns are not
read, and come along unchanged in the mix, except one named ``copy``. The targets order all
sources in one task, one narrow row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.tables import beside, read, stage

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
FAN = 64
SEED = 17

UNIT = "struct<h:bigint,id:bigint,w:double,p:double>"
SETTLED = "array<struct<h:bigint,x:int>>"


def size_in_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]++")).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target``.

    Sharing by weight with a ceiling per source, what is above it shared again, ends where every
    source gets ``level * weight`` or its ceiling. In the order of ceiling / weight the sources
    at their ceiling come first, so the level follows from running sums. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ceiling = sizes.withColumn("_w", weight).withColumn("_c", F.col("source_size") * float(most))
    ratio = F.col("_c") / F.col("_w")
    before = Window.orderBy("_r", "source").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # What the sources from this one on get per weight if all earlier ones are at their ceiling.
    level = (
        (F.sum("source_size").over(every) - F.coalesce(F.sum("_c").over(before), F.lit(0.0)))
        / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    )
    levels = ceiling.withColumn("_r", ratio).withColumn("_level", level)
    levels = levels.withColumn("_k", F.row_number().over(Window.orderBy("_r", "source")))
    reached = F.when(F.col("_level") <= F.col("_r"), F.struct("_k", "_level"))
    share = F.coalesce(F.min(reached).over(every)["_level"], F.lit(0.0)) * F.col("_w")
    return levels.select("source", "source_size", F.least(share, F.col("_c")).alias("target"))


def _chance(*parts: Column) -> Column:
    """A number in [0, 1) that depends on its arguments only."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / float(1 << 53)


def _fold(units: Column, seed: int) -> Column:
    """Settle all units of an array but one: ``settled`` and the ``rest``, null if none is left.

    The unit at hand, ``rest``, meets the next one, ``u``. Raising ``rest`` by d words lowers
    ``u`` by as many; the directions are chosen so that neither expectation moves.
    """
    start = F.struct(
        F.array().cast(SETTLED).alias("settled"), F.lit(None).cast(UNIT).alias("rest")
    )

    def unit(u: Column, p: Column) -> Column:
        return F.struct(u["h"].alias("h"), u["id"].alias("id"), u["w"].alias("w"), p.alias("p"))

    def settle(acc: Column, u: Column, x: Column) -> Column:
        return F.array_append(acc["settled"], F.struct(u["h"].alias("h"), x.cast("int").alias("x")))

    def state(settled: Column, rest: Column) -> Column:
        return F.struct(settled.alias("settled"), rest.cast(UNIT).alias("rest"))

    def meet(acc: Column, u: Column) -> Column:
        r = acc["rest"]
        r_room, r_has = r["w"] * (1 - r["p"]), r["w"] * r["p"]
        u_room, u_has = u["w"] * (1 - u["p"]), u["w"] * u["p"]
        up, down = F.least(r_room, u_has), F.least(r_has, u_room)
        rises = _chance(F.lit(seed), r["h"], u["h"]) * (up + down) < down
        # Rising, the smaller of the two bounds says which unit is settled; so does falling.
        r_done = F.when(rises, r_room <= u_has).otherwise(r_has <= u_room)
        u_left = u["p"] + F.when(rises, -up).otherwise(down) / u["w"]
        r_left = r["p"] + F.when(rises, up).otherwise(-down) / r["w"]
        r_value, u_value = rises.cast("int"), (~rises).cast("int")
        settled = F.when(r_done, settle(acc, r, r_value)).otherwise(settle(acc, u, u_value))
        rest = F.when(r_done, unit(u, u_left)).otherwise(unit(r, r_left))
        return state(settled, rest)

    def step(acc: Column, u: Column) -> Column:
        # A unit at 0 or 1, or one that rounding error has put there, is settled as it is.
        whole = (u["p"] <= 1e-12) | (u["p"] >= 1 - 1e-12)
        held = acc["rest"]
        held_whole = held.isNotNull() & ((held["p"] <= 1e-12) | (held["p"] >= 1 - 1e-12))
        return (
            F.when(whole, state(settle(acc, u, F.round(u["p"])), held))
            .when(held.isNull(), state(acc["settled"], u))
            .when(held_whole, state(settle(acc, held, F.round(held["p"])), u))
            .otherwise(meet(acc, u))
        )

    return F.aggregate(units, start, step)


def _level(units: DataFrame, groups: Column, seed: int) -> DataFrame:
    """Fold every group of one level; one row per group with what is settled and the rest."""
    dealt = units.withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), "h"), groups))
    packed = dealt.groupBy("source", "_group").agg(
        F.array_sort(F.collect_list(F.struct("h", "id", "w", "p"))).alias("_units")
    )
    return packed.select("source", _fold(F.col("_units"), seed).alias("_f")).select(
        "source", F.col("_f.settled").alias("settled"), F.col("_f.rest").alias("rest")
    )


def rounded(units: DataFrame, fan: int = FAN, seed: int = SEED) -> DataFrame:
    """``source, h, id, w, p`` to ``h, x``: every unit's probability p rounded to x, 0 or 1.

    ``h`` names a unit. Levels follow from the largest source's number of units, which is
    counted; each level is written to the shared folder.
    """
    units = stage(units.where("w > 0"))
    done = []
    level = 0
    while True:
        counts = units.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
        largest = counts.agg(F.max("_n")).first()[0]
        if largest is None:
            break
        counts = beside(stage(counts.withColumnRenamed("source", "_source")))
        sized = units.join(counts, units.source.eqNullSafe(F.col("_source"))).drop("_source")
        folded = stage(_level(sized, F.ceil(F.col("_n") / fan), seed + 1000 * level))
        done.append(folded.select(F.inline("settled")))
        rest = folded.where("rest is not null").select("source", "rest.*")
        if largest <= fan:
            last = _chance(F.lit(seed), F.col("h")) < F.col("p")
            done.append(rest.select("h", last.cast("int").alias("x")))
            break
        units = stage(rest)
        level += 1
    if not done:
        return units.select("h", F.lit(0).alias("x"))
    every = done[0]
    for more in done[1:]:
        every = every.unionAll(more)
    return stage(every)


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_COPIES, seed: int = SEED
) -> DataFrame:
    """Per row ``doc_id, source, size, source_size, target, copies``; ``_h`` names the unit."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", size_in_words(F.col("text")).alias("size"))
    rows = stage(rows.withColumn("_h", F.xxhash64("doc_id", "source", "size")))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    due = beside(stage(targets(sources, weights, most).withColumnRenamed("source", "_source")))
    rows = rows.join(due, rows.source.eqNullSafe(F.col("_source")), "left").drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A rate that is whole but for rounding error has no fractional part.
    near = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    rows = rows.withColumn("_sure", F.floor(near).cast("int")).withColumn("_p", near - F.floor(near))
    units = (
        rows.where("_p > 0").groupBy("source", F.col("_h").alias("h"), F.col("doc_id").alias("id"), F.col("_p").alias("p"))
        .agg(F.sum("size").cast("double").alias("w"))
    )
    more = beside(rounded(units, seed=seed)).withColumnRenamed("h", "_h")
    return rows.join(more, "_h", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_sure") + F.coalesce("x", F.lit(0))).alias("copies"), "_h",
    )


def mixture(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_COPIES, seed: int = SEED
) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns as they were, with
    the number of the copy in ``copy`` (which replaces a column of that name)."""
    plan = mixed(docs, weights, most, seed).select(
        F.col("_h").alias("__unit"), F.col("copies").alias("__copies")
    )
    plan = stage(plan.distinct())
    unit = F.xxhash64(F.col("doc_id").cast("bigint"), "source", size_in_words(F.col("text")))
    taken = docs.withColumn("__unit", unit).join(beside(plan), "__unit").where("__copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return taken.withColumn("copy", copies).drop("__unit", "__copies")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each row of ``documents`` the mix takes; odd rows as the module says."""
    plan = mixed(read(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
