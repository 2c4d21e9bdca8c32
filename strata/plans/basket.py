"""Products bought together, in two passes over the baskets.

A pair is reported if at least ``min_count`` orders hold both products.

1.  *Products.*  Only products in at least ``min_count`` orders can be in such a pair.
    They are numbered densely in the order of their ids.
2.  *Baskets.*  An order's products are one row, or, beyond ``BLOCK`` products, one row for
    each pair of blocks of about ``BLOCK``: no row and no task holds a large order whole,
    and every pair of an order's products is in just one row.
3.  *Buckets.*  Every task counts the pairs of its rows in a fixed array of ``BUCKETS`` hash
    buckets.  Counts stop at ``min_count``: sums of such counts reach it just where the real
    ones do.  The arrays are added up in a tree of tasks, and what remains is one bit a bucket.
4.  *Pairs.*  Only pairs whose bucket reached ``min_count`` are counted one by one, added up in
    the task's batch before they are shuffled.  A pair below the minimum gets here only by
    sharing a bucket.

The bits (``BUCKETS`` / 8 bytes) are the only thing sent to the tasks, whatever the input.

Confidences are named as probabilities (D14): A given B is count / orders with B.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.keys import assign_keys
from strata.session import materialize

BLOCK = 256
BUCKETS = 1 << 22
FAN_IN = 64


def frequent_products(bought: DataFrame, min_count: int) -> DataFrame:
    """(product_id, orders, number) of the products in at least ``min_count`` orders."""
    counts = bought.groupBy("product_id").agg(F.count("*").alias("orders")).where(F.col("orders") >= min_count)
    return assign_keys(counts, [F.col("product_id")], "number")


def baskets(bought: DataFrame, products: DataFrame) -> DataFrame:
    """(own, other): numbers of products of one order.  Every two of ``own``, or, where there
    are any, each of ``own`` with each of ``other``, are a pair."""
    rows = bought.join(products.select("product_id", "number"), "product_id").select("order_id", "number")
    sizes = rows.groupBy("order_id").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1")
    small = rows.join(sizes.where("blocks = 1").select("order_id"), "order_id", "left_semi")
    whole = small.groupBy("order_id").agg(F.collect_list("number").alias("own")).select("own", F.array().cast("array<bigint>").alias("other"))
    large = rows.join(sizes.where("blocks > 1").select("order_id", "blocks"), "order_id")
    large = large.withColumn("mine", F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = large.select("order_id", "number", F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"), "mine")
    side = lambda c: F.collect_list(F.when(F.col("mine") == F.col(c), F.col("number")))
    split = large.groupBy("order_id", "i", "j").agg(side("i").alias("own"), side("j").alias("them"))
    other = F.when(F.col("i") == F.col("j"), F.array().cast("array<bigint>")).otherwise(F.col("them"))
    # two blocks of which one is empty hold no pair; a block with itself holds those inside it
    split = split.select("own", other.alias("other"), "i", "j").where("i = j and size(own) > 1 or i < j and size(own) > 0 and size(other) > 0")
    return whole.unionByName(split.select("own", "other"))


def pairs_of(own: pd.Series, other: pd.Series) -> Iterator[np.ndarray]:
    """The pairs of the rows as (lower number << 32 | higher number), in bounded arrays."""
    own, other = [np.asarray(x, np.int64) for x in own], [np.asarray(x, np.int64) for x in other]
    sizes = np.array([len(x) if not len(y) else -1 for x, y in zip(own, other, strict=True)])
    for size in np.unique(sizes[sizes > 1]).tolist():  # rows of one size at once
        left, right = np.triu_indices(size, 1)
        at = np.flatnonzero(sizes == size)
        step = max(1, (1 << 20) // len(left))
        for k in range(0, len(at), step):
            rows = np.stack([own[i] for i in at[k:k + step].tolist()])
            yield _keys(rows[:, left].ravel(), rows[:, right].ravel())
    for i in np.flatnonzero(sizes < 0).tolist():
        yield _keys(np.repeat(own[i], len(other[i])), np.tile(other[i], len(own[i])))


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (np.minimum(a, b) << 32) | np.maximum(a, b)


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)


def frequent_buckets(rows: DataFrame, min_count: int) -> bytes:
    """One bit for each bucket: whether its pairs occur ``min_count`` times or more."""
    buckets = BUCKETS

    def count(batches):
        total = np.zeros(buckets, np.uint8)
        for pdf in batches:
            for pairs in pairs_of(pdf["own"], pdf["other"]):
                at, n = np.unique(bucket_of(pairs, buckets), return_counts=True)
                total[at] = np.minimum(total[at] + np.minimum(n, min_count), min_count)
        if total.any():
            yield pd.DataFrame({"slot": [TaskContext.get().partitionId()], "counts": [_packed(total)]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(buckets, np.uint8)
        for data in group["counts"]:
            np.minimum(total + _unpacked(data), min_count, out=total)
        return pd.DataFrame({"slot": [group["slot"].iat[0]], "counts": [_packed(total)]})

    if min_count > 127:
        raise ValueError("bucket counts are bytes: the minimum must be below 128")
    found, left = rows.mapInPandas(count, "slot int, counts binary"), rows.rdd.getNumPartitions()
    while left > 1:
        found = found.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int")).groupBy("slot").applyInPandas(add, "slot int, counts binary")
        left = -(-left // FAN_IN)
    last = found.collect()  # one array of fixed size
    return np.packbits(_unpacked(last[0]["counts"]) >= min_count).tobytes() if last else bytes(buckets // 8)


def pair_counts(rows: DataFrame, bits: bytes, min_count: int) -> DataFrame:
    """(a, b, n): the pairs of product numbers in at least ``min_count`` rows."""

    def count(batches):
        frequent = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        for pdf in batches:
            held = [p[frequent[bucket_of(p, len(frequent))]] for p in pairs_of(pdf["own"], pdf["other"])]
            held = [h for h in held if len(h)]
            if held:
                pairs, n = np.unique(np.concatenate(held), return_counts=True)
                yield pd.DataFrame({"pair": pairs, "n": n})

    counted = rows.mapInPandas(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return counted.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "n")


def basket_pairs(foi: DataFrame, dim_products: DataFrame, min_count: int = 5, top: int = 10_000) -> DataFrame:
    """The ``top`` pairs by lift, with support and both confidences.  Ties in lift go by
    the products' ids."""
    bought = materialize(foi.where("order_id is not null and product_id is not null").select("order_id", "product_id").distinct())
    products = materialize(frequent_products(bought, min_count))
    rows = materialize(baskets(bought, products))
    pairs = pair_counts(rows, frequent_buckets(rows, min_count), min_count)
    orders = foi.agg(F.count_distinct("order_id")).first()[0]  # one number
    names = dim_products.select(F.col("product_id").alias("id"), "product_name")

    def named(df: DataFrame, side: str) -> DataFrame:
        p = products.select(F.col("number").alias(side), F.col("product_id").alias(f"product_{side}_id"), F.col("orders").alias(f"orders_{side}"))
        df = df.join(p, side)
        return df.join(names.select(F.col("id").alias(f"product_{side}_id"), F.col("product_name").alias(f"product_{side}_name")), f"product_{side}_id")

    j = named(named(pairs, "a"), "b").withColumn("total_orders", F.lit(orders).cast("long"))
    n, total = F.col("n").cast("double"), F.col("total_orders")
    out = j.select(
        "product_a_id", "product_a_name", "product_b_id", "product_b_name", F.col("n").alias("co_occurrence_count"), "total_orders",
        (n / total).alias("support"), (n / F.col("orders_b")).alias("confidence_a_given_b"), (n / F.col("orders_a")).alias("confidence_b_given_a"),
        ((F.col("n") * total).cast("double") / (F.col("orders_a") * F.col("orders_b")).cast("double")).alias("lift"))
    return out.orderBy(F.desc("lift"), "product_a_id", "product_b_id").limit(top)
