"""Recommendations as a batch job over raw inputs.

    click messages (``user_id,product_id`` + record timestamp)
    + sale messages (``invoice_id,user_id,product_id,quantity,unit_cost`` + timestamp)
    + inventory CSV (``product_id,category,stock,rating``; bad rows skipped, and counted)
    -> ranked lists per user and window (or per view)
    -> keyed CSV records (key ``user_id``, value ``user_id,"p1,...",event_time``)
       and the latest record per user (what a compacted keyed topic holds).

Ids are text. A malformed click or sale line (a field missing or too many)
fails the job unless ``--on-error drop`` is given; skipped lines are counted and
reported.

Usage::

    python -m basketry.plans.recommend_job --clicks c/ --sales s/ \\
        --inventory inventory.csv --out out/ [--scope view | --no-repeat]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from basketry import schemas
from basketry.functions import encode, parse
from basketry.operators import recommend as rec
from basketry.operators.common import latest_per_key
from basketry.session import build_session
from basketry.sources import files


def recommendations(
    click_messages: DataFrame,
    sale_messages: DataFrame,
    inventory: DataFrame,
    scope: str = "user",
    window: str = "5 seconds",
    k: int = rec.DEFAULT_K,
    rating_order: str = "numeric",
    repeat: bool = True,
    on_error: str = "fail",
) -> DataFrame:
    clicks = parse.decode_clicks(click_messages, on_error=on_error, keep=["timestamp"])
    clicks = clicks.withColumnRenamed("timestamp", "event_time")
    sales = parse.decode_sales(sale_messages, on_error=on_error)
    return rec.Recommender(clicks, sales, inventory, k, rating_order).recommend(scope, window, repeat)


def keyed_records(recs: DataFrame) -> DataFrame:
    return recs.select(encode.recommendation_key().alias("key"), encode.recommendation_value().alias("value"))


def run(spark: SparkSession, clicks_path: str, sales_path: str, inventory_path: str, out: str,
        scope: str = "user", window: str = "5 seconds", k: int = rec.DEFAULT_K,
        rating_order: str = "numeric", repeat: bool = True, on_error: str = "fail") -> dict[str, int]:
    """Run the job; returns how many malformed lines of each input were left out."""
    clicks = spark.read.schema(schemas.MESSAGE).parquet(clicks_path)
    sales = spark.read.schema(schemas.MESSAGE).parquet(sales_path)
    inventory = files.csv_table(spark, inventory_path, schemas.INVENTORY, on_error="drop")
    dropped = {"inventory": parse.malformed_count(files.text_lines(spark, inventory_path), schemas.INVENTORY)}
    if on_error == "drop":
        dropped["clicks"] = parse.malformed_count(clicks, schemas.CLICK)
        dropped["sales"] = parse.malformed_count(sales, schemas.PURCHASE)
    recs = recommendations(clicks, sales, inventory, scope, window, k, rating_order, repeat, on_error)
    recs.write.mode("overwrite").parquet(f"{out}/recommendations")
    written = spark.read.parquet(f"{out}/recommendations")
    keyed_records(written).write.mode("overwrite").parquet(f"{out}/records")
    if scope == "user":
        keyed_records(latest_per_key(written, ["user_id"], ["event_time"])).write.mode("overwrite").parquet(
            f"{out}/latest"
        )
    return dropped


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--clicks", required=True)
    ap.add_argument("--sales", required=True)
    ap.add_argument("--inventory", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--scope", default="user", choices=rec.SCOPES)
    ap.add_argument("--window", default="5 seconds")
    ap.add_argument("--k", type=int, default=rec.DEFAULT_K)
    ap.add_argument("--rating-order", default="numeric", choices=rec.RATING_ORDERS)
    ap.add_argument("--no-repeat", action="store_true",
                    help="suggest each product once per user, at the first view of its category (user scope)")
    ap.add_argument("--on-error", default="fail", choices=("fail", "drop"),
                    help="malformed click and sale lines: stop, or leave out and count")
    args = ap.parse_args(argv)
    if args.no_repeat and args.scope != "user":
        ap.error("--no-repeat needs --scope user")
    spark = build_session()
    dropped = run(spark, args.clicks, args.sales, args.inventory, args.out, args.scope, args.window, args.k,
                  args.rating_order, not args.no_repeat, args.on_error)
    print(json.dumps({"malformed_lines_left_out": dropped}))


if __name__ == "__main__":
    main()
