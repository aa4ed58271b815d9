import random

import pytest

from clickloom.operators import recommend
from clickloom.plans import small_or_shuffled, stage
from clickloom.schema import CATALOG_SCHEMA
from tests.model import recommend as model


def catalog(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], CATALOG_SCHEMA)


def lists(df):
    return {
        r.product_id: [(x.product_id, x.category_id, x.brand_id) for x in r.recommendations]
        for r in df.collect()
    }


def random_catalog(seed, unique):
    rng = random.Random(seed)
    size = rng.randint(1, 60)
    ids = [f"P{i if unique else rng.randint(0, size // 2)}" for i in range(size)]
    categories, brands = rng.choice([1, 3, 12]), rng.choice([1, 4, 15])
    return [(p, f"C{rng.randrange(categories)}", f"B{rng.randrange(brands)}") for p in ids]


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("limit", [1, 2, 5, 9, 15, 16, 40])
def test_lists_equal_the_sequential_rule(spark, unique, limit):
    """One catalog made of many: category and brand names are told apart by the seed."""
    rows = []
    for seed in range(25):
        rows += [tuple(f"{seed}-{x}" for x in row) for row in random_catalog(seed, unique)]
    got = lists(recommend.recommendation_lists(catalog(spark, rows), limit))
    assert got == model(rows, limit)


def test_tiers_and_ranks(spark):
    rows = [("P1", "C1", "B1"), ("P2", "C1", "B2"), ("P3", "C2", "B1"), ("P4", "C3", "B3")]
    ranked = recommend.explode_ranked(
        recommend.recommendation_lists(catalog(spark, rows)), "product_id")
    got = sorted((r.product_id, r.rank, r.tier, r.recommended_id) for r in ranked.collect())
    assert got == [("P1", 1, 1, "P2"), ("P1", 2, 2, "P3"), ("P2", 1, 1, "P1"), ("P3", 1, 2, "P1")]


def test_limit_must_be_positive(spark):
    with pytest.raises(ValueError):
        recommend.recommendation_lists(catalog(spark, []), 0)


def test_browse_events(spark):
    rows = [("A", "VIEW", "P1"), ("", "CLICK", "P1"), (None, "SEARCH", "P2"), ("A", "view", "P1"),
            ("A", "PURCHASE", "P1"), ("A", "VIEW", ""), ("A", "VIEW", None), ("A", "VIEW", "??"),
            ("A", "VIEW", " ")]
    events = spark.createDataFrame(rows, "acc_id string, event_type string, product_id string")
    products = catalog(spark, [("P1", "C1", "B1"), ("P2", "C1", "B1")])
    got = recommend.recommend_events(events, products).collect()
    assert sorted((r.acc_id if r.acc_id is not None else "-", r.event_type, r.product_id) for r in got) == [
        ("", "CLICK", "P1"), ("-", "SEARCH", "P2"), ("A", "VIEW", "P1")]
    enriched = recommend.catalog_enrich(events, products).collect()
    assert len(enriched) == len(rows)
    assert {r.product_id: r.category_id for r in enriched}["??"] is None


def test_lists_beyond_the_limit_are_not_broadcast(spark):
    staged = stage(recommend.recommendation_lists(catalog(spark, [("P1", "C", "B"),
                                                                  ("P2", "C", "B")])))
    small = small_or_shuffled(staged)._jdf.queryExecution().analyzed().toString()
    large = small_or_shuffled(staged, limit=10)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in small.lower() and "broadcast" not in large.lower()
