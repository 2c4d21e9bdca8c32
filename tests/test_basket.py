"""Pairs by two passes against a plain count of all pairs."""
import itertools
import random
from collections import Counter

import pytest

from strata.plans import basket


def tables(spark, orders):
    lines = [(o, p) for o, ps in orders.items() for p in ps]
    return (spark.createDataFrame([*lines, *lines[:7], (None, "p1"), ("o1", None)], "order_id string, product_id string"),
            spark.createDataFrame([(p, f"name {p}") for p in sorted({p for _, p in lines} - {"p0"})], "product_id string, product_name string"))


def by_hand(orders, least):
    n, by = Counter(), Counter()
    for ps in orders.values():
        by.update(set(ps))
        n.update(itertools.combinations(sorted(set(ps)), 2))
    total = len({o for o, ps in orders.items() if ps} | {"o1"} - {"o1"})
    return {(a, b): (c, total, c / total, c / by[b], c / by[a], c * total / (by[a] * by[b])) for (a, b), c in n.items() if c >= least and "p0" not in (a, b)}


@pytest.mark.parametrize("block", [256, 5])
def test_pairs_equal_a_plain_count(spark, monkeypatch, block):
    monkeypatch.setattr(basket, "BLOCK", block)  # 5: large orders are split into pairs of blocks
    r = random.Random(block)
    orders = {f"o{i}": r.sample([f"p{k}" for k in range(60)], min(60, r.choice([1, 2, 3, 4, 5, 6, 40]))) for i in range(150)}
    got = basket.basket_pairs(*tables(spark, orders), min_count=5).collect()
    want = by_hand(orders, 5)
    assert len(got) == len(want) > 20
    for x in got:
        assert tuple(x)[4:] == want[x["product_a_id"], x["product_b_id"]] and x["product_a_name"] == f"name {x['product_a_id']}"
    order = [(-x["lift"], x["product_a_id"], x["product_b_id"]) for x in got]
    assert order == sorted(order)
    assert len(basket.basket_pairs(*tables(spark, orders), min_count=5, top=7).collect()) == 7


def test_few_buckets_and_a_tree_of_tasks(spark, monkeypatch):
    """Pairs that share buckets are still counted one by one."""
    monkeypatch.setattr(basket, "BUCKETS", 16)
    monkeypatch.setattr(basket, "FAN_IN", 2)
    r = random.Random(3)
    orders = {f"o{i}": r.sample([f"p{k}" for k in range(30)], 3) for i in range(200)}
    got = basket.basket_pairs(*tables(spark, orders), min_count=4).collect()
    assert {(x["product_a_id"], x["product_b_id"]): x["co_occurrence_count"] for x in got} == {k: v[0] for k, v in by_hand(orders, 4).items()}


def test_no_pairs(spark):
    assert basket.basket_pairs(*tables(spark, {"o1": ["p1"], "o2": ["p2"]}), min_count=1).collect() == []
    empty = spark.createDataFrame([], "order_id string, product_id string")
    assert basket.basket_pairs(empty, spark.createDataFrame([], "product_id string, product_name string")).collect() == []
