"""Related products: same category first, then same brand, in catalog order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.plans import small_or_shuffled, stage
from clickloom.schema import BROWSE_TYPES
from clickloom.sources.catalog import catalog_lookup

LIMIT = 5

# Up to this many rows per group Spark cuts a rank before the shuffle on its own.
CUT_BEFORE_SHUFFLE = 1000
SALTS = 64


def _distinct_lines(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("product_id", "category_id", "brand_id").agg(
        F.min("catalog_ord").alias("catalog_ord")
    )


def _shortlist(lines: DataFrame, group: str, limit: int) -> DataFrame:
    """The rows of each category (or brand) that any of its products can need.

    A product skips its own rows and, in the brand list, fewer than ``limit`` rows already
    taken from its category. So the first ``2 * limit`` rows of an id, and the rows up to the
    ``2 * limit + 1``-th id, always hold ``limit`` rows to take. Both ranks are cut before
    the shuffle too, so a category holding most of the catalog costs no more. Where Spark would
    not do that, for limits above 15, a group is first cut in ``SALTS`` parts of its own.
    """
    ids, rows_per_id = 2 * limit + 1, 2 * limit
    by_line = Window.partitionBy(group, "product_id").orderBy("catalog_ord")
    by_ord = Window.partitionBy(group).orderBy("catalog_ord")
    so_far = by_ord.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = (
        lines.withColumn("line", F.row_number().over(by_line))
        .where(F.col("line") <= rows_per_id)
    )
    if ids * rows_per_id > CUT_BEFORE_SHUFFLE:
        salt = F.pmod(F.xxhash64("product_id", "catalog_ord"), F.lit(SALTS))
        by_part = Window.partitionBy(group, "salt").orderBy("catalog_ord")
        head = (
            head.withColumn("salt", salt)
            .withColumn("place", F.row_number().over(by_part))
            .where(F.col("place") <= ids * rows_per_id)
        )
    head = (
        head.withColumn("place", F.row_number().over(by_ord))
        .where(F.col("place") <= ids * rows_per_id)
        .withColumn("ids", F.count(F.when(F.col("line") == 1, 1)).over(so_far))
        .where(F.col("ids") <= ids)
    )
    item = F.struct("catalog_ord", "product_id", "category_id", "brand_id")
    return head.groupBy(group).agg(F.sort_array(F.collect_list(item)).alias(f"{group}_list"))


def _tagged(items: Column, tier: int) -> Column:
    return F.transform(
        items,
        lambda x: F.struct(
            x["product_id"].alias("product_id"),
            x["category_id"].alias("category_id"),
            x["brand_id"].alias("brand_id"),
            F.lit(tier).alias("tier"),
        ),
    )


def recommendation_lists(catalog: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``product_id, recommendations`` for every catalog product that has any.

    Work and data movement are linear in the catalog: each product meets two short lists.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    targets = catalog_lookup(catalog)
    lines = _distinct_lines(catalog)
    by_category = _shortlist(lines, "category_id", limit)
    by_brand = _shortlist(lines, "brand_id", limit)
    joined = targets.join(by_category, "category_id").join(by_brand, "brand_id")
    target, category = F.col("product_id"), F.col("category_id")
    same_category = F.slice(
        F.filter("category_id_list", lambda x: x["product_id"] != target), 1, limit
    )
    # Brand rows of the target's own category were all offered by the first list already.
    same_brand = F.filter(
        "brand_id_list",
        lambda x: (x["product_id"] != target) & (x["category_id"] != category),
    )
    chosen = F.slice(
        F.concat(_tagged(same_category, 1), _tagged(same_brand, 2)), 1, limit
    )
    return joined.select("product_id", chosen.alias("recommendations")).where(
        F.size("recommendations") > 0
    )


def explode_ranked(lists: DataFrame, *keys: str) -> DataFrame:
    """One row per recommended product with its ``rank`` and ``tier``."""
    exploded = lists.select(*keys, F.posexplode("recommendations").alias("place", "item"))
    return exploded.select(
        *keys,
        (F.col("place") + 1).alias("rank"),
        F.col("item.tier").alias("tier"),
        F.col("item.product_id").alias("recommended_id"),
        F.col("item.category_id").alias("recommended_category"),
        F.col("item.brand_id").alias("recommended_brand"),
    )


def browse_events(events: DataFrame) -> DataFrame:
    """VIEW, CLICK and SEARCH events with a product; blank accounts are not excluded."""
    return events.where(F.col("event_type").isin(*BROWSE_TYPES) & (F.col("product_id") != ""))


def recommend_events(
    events: DataFrame, catalog: DataFrame, limit: int = LIMIT
) -> DataFrame:
    """Recommendations for each browse event; unknown products give no row.

    The lists are staged and measured. Small ones are broadcast and the events are not
    shuffled; others meet the events in a shuffle join.
    """
    return join_recommendations(events, prepare_recommendations(catalog, limit))


def prepare_recommendations(catalog: DataFrame, limit: int = LIMIT) -> DataFrame:
    return small_or_shuffled(stage(recommendation_lists(catalog, limit)))


def join_recommendations(events: DataFrame, lists: DataFrame) -> DataFrame:
    """Batch or streaming events against prepared lists."""
    return browse_events(events).join(lists, "product_id")


def catalog_enrich(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Category and brand of each event's product; null for unknown products."""
    lookup = small_or_shuffled(
        stage(catalog_lookup(catalog).select("product_id", "category_id", "brand_id"))
    )
    return events.join(lookup, "product_id", "left")
