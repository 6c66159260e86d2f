"""Sales by category as a batch job over raw inputs.

    sales lines (text, ``invoice_id,user_id,product_id,quantity,unit_cost``)
    + product lines (text, ``product_id,category,stock,rating``)
    -> parse -> latest product row per id -> enrich -> windowed sums
    -> JSON messages (and the typed sums as parquet).

Sales lines carry no time of their own; the time column comes from a
message source (``value, timestamp`` files) or, for plain text, must be
given as ``time_col`` in a parquet/CSV table. Usage::

    python -m basketry.plans.sales_job --sales msgs/ --products products.csv \\
        --out out/ --window "1 hour"
"""

from __future__ import annotations

import argparse
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import encode, parse
from basketry.operators import sales as sal
from basketry.session import build_session
from basketry.sources import files


def products_from_lines(lines: DataFrame, on_error: str = "fail") -> DataFrame:
    """Product rows; a later line for the same id replaces an earlier one.

    Line order of a file source: file path, then the byte offset of the split
    (``_metadata.file_block_start``), then the position in the split
    (``monotonically_increasing_id``). That id alone is no line order across
    files or splits: Spark packs splits into partitions largest first, so a
    small earlier file can land after a large later one. Lines that do not
    come from a file scan fall back to the id alone."""
    try:
        ordered = lines.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
        order = ["_file", "_block", "_seq"]
    except AnalysisException:  # not a file scan
        ordered, order = lines, ["_seq"]
    ordered = ordered.withColumn("_seq", F.monotonically_increasing_id())
    parsed = parse.parse_products(ordered, on_error=on_error, keep=order)
    return sal.latest_products(parsed, order).drop(*order)


def sales_by_category_job(
    messages: DataFrame,
    product_lines: DataFrame,
    window: str = "10 seconds",
    slide: str | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Typed windowed sums from sale messages (``value, timestamp``)."""
    sales = parse.parse_sales(messages, on_error=on_error, keep=["timestamp"]).withColumnRenamed(
        "timestamp", "purchase_time"
    )
    products = products_from_lines(product_lines, on_error)
    return sal.sales_by_category(sal.enrich_sales(sales, products), "purchase_time", window, slide)


def run(spark: SparkSession, sales_path: str, products_path: str, out: str, window: str = "10 seconds",
        slide: str | None = None, on_error: str = "fail") -> dict[str, int]:
    """Run the job; returns how many malformed lines of each input were left out."""
    messages = spark.read.schema(schemas.MESSAGE).parquet(sales_path)
    lines = files.text_lines(spark, products_path)
    dropped = {}
    if on_error != "fail":
        bad = lambda parsed: parsed.where("_corrupt_record is not null").count()
        dropped = {"sales": bad(parse.parse_sales(messages, on_error="quarantine")),
                   "products": bad(parse.parse_products(lines, on_error="quarantine"))}
    sums = sales_by_category_job(messages, lines, window, slide, on_error)
    sums.write.mode("overwrite").parquet(f"{out}/sums")
    spark.read.parquet(f"{out}/sums").select(encode.sales_by_category_json().alias("value")).write.mode(
        "overwrite"
    ).text(f"{out}/messages")
    return dropped


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sales", required=True, help="parquet files of value,timestamp sale messages")
    ap.add_argument("--products", required=True, help="product CSV text file")
    ap.add_argument("--out", required=True)
    ap.add_argument("--window", default="10 seconds")
    ap.add_argument("--slide", default=None)
    ap.add_argument("--on-error", default="fail", choices=("fail", "drop"),
                    help="malformed lines: stop, or leave out and count")
    args = ap.parse_args(argv)
    spark = build_session()
    dropped = run(spark, args.sales, args.products, args.out, args.window, args.slide, args.on_error)
    print(json.dumps({"malformed_lines_left_out": dropped}))


if __name__ == "__main__":
    main()
