"""Recommendations per page view as one pure Structured Streaming query.

Bounded form of the job: a product counts as bought if the user bought it within
``lookback`` before the view. No ``foreachBatch``, no state kept by hand; Spark
expires all of it with the watermarks of the two topics:

1. clicks -> category of the product (stream-static join) -> distinct views
   (``dropDuplicatesWithinWatermark``: a replayed click within the watermark is one);
2. views LEFT JOIN purchases on user and category, the purchase at most
   ``lookback`` before the view (stream-stream outer join; a view without a
   purchase comes out with nulls once both watermarks have passed);
3. per view and category: the distinct bought products, and with the category's
   top products (stream-static join) its k best candidates as one sorted array;
4. per view: the arrays of its categories merged, sorted and cut to k.

Steps 3 and 4 are two chained aggregates; a view is sent once, when its time has
passed the watermark (append mode). The same function runs on bounded frames.

A view joins the purchases of its user and category within the lookback: choose it
so that these are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators import recommend as rec
from basketry.operators.common import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded


def distinct_views(clicks: DataFrame, inventory: DataFrame) -> DataFrame:
    """Distinct (user_id, event_time, category) of the clicks of known products."""
    keys = ["user_id", "event_time", "category"]
    rows = clicks.join(inventory.select("product_id", "category").distinct(), "product_id").select(*keys)
    return rows.dropDuplicatesWithinWatermark(keys) if rows.isStreaming else rows.dropDuplicates(keys)


def with_purchases(views: DataFrame, sales: DataFrame, stocked: DataFrame, lookback: str) -> DataFrame:
    """Views with each purchase of an in-stock product of the category by the user
    at most ``lookback`` before (``item``), or null."""
    item = F.struct("product_id", "stock", "rating").alias("item")
    bought = sales.join(stocked, "product_id").select(
        F.col("user_id").alias("b_user"), F.col("category").alias("b_category"), "purchase_time", item
    )
    same = (F.col("user_id") == F.col("b_user")) & (F.col("category") == F.col("b_category"))
    before = F.expr(f"purchase_time <= event_time AND purchase_time >= event_time - INTERVAL {lookback}")
    return views.join(bought, same & before, "left").select("user_id", "event_time", "category", "item")


def view_lists(
    clicks: DataFrame,
    sales: DataFrame,
    inventory: DataFrame,
    lookback: str = "1 hour",
    k: int = rec.DEFAULT_K,
    rating_order: str = "numeric",
    click_delay: str = "10 seconds",
    sale_delay: str = "10 seconds",
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``user_id, event_time, candidates`` per view: its k best candidates, best
    first (``grp`` 0: bought), from clicks (``user_id, product_id, event_time``) and
    sales (``user_id, product_id, purchase_time``). A view without a candidate has no row."""
    inventory = broadcast_if_bounded(inventory, max_broadcast_rows)
    top = broadcast_if_bounded(rec.category_lists(rec.category_top(inventory, k, rating_order)), max_broadcast_rows)
    if clicks.isStreaming:
        clicks = clicks.withWatermark("event_time", click_delay)
        sales = sales.withWatermark("purchase_time", sale_delay)
    joined = with_purchases(distinct_views(clicks, inventory), sales, rec.stocked(inventory), lookback)
    per_category = joined.groupBy("user_id", "event_time", "category").agg(F.collect_set("item").alias("items")).join(top, "category", "left")

    def candidate(grp: int):
        return lambda x: F.struct(
            F.lit(grp).alias("grp"), x["product_id"].alias("product_id"), x["stock"].alias("stock"), x["rating"].alias("rating"),
            F.col("category").alias("category"),
        )

    better = rec.candidate_comparator(rating_order)
    bought = F.transform("items", candidate(0))
    ids = F.transform("items", lambda x: x["product_id"])
    rest = F.transform(F.filter("top_list", lambda x: ~F.array_contains(ids, x["product_id"])), candidate(1))
    best = F.slice(F.array_sort(F.concat(bought, F.coalesce(rest, F.array())), better), 1, k)
    per_category = per_category.select("user_id", "event_time", best.alias("each"))
    merged = per_category.groupBy("user_id", "event_time").agg(F.flatten(F.collect_list("each")).alias("each"))
    lists = merged.select("user_id", "event_time", F.slice(F.array_sort("each", better), 1, k).alias("candidates"))
    return lists.where(F.size("candidates") > 0)


def recommendations(lists: DataFrame) -> DataFrame:
    """``user_id, top_product_ids, event_time``: the lists as comma-joined ids."""
    ids = F.array_join(F.transform("candidates", lambda x: x["product_id"].cast("string")), ",")
    return lists.select("user_id", ids.alias("top_product_ids"), "event_time")
