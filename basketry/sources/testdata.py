"""Adapters from the generated parquet tables onto the retail record shapes.

The mapping (fixed, so that the Spark queries and the SQL oracle agree):

* inventory  <- part:   product_id=p_partkey, category=p_type,
                        stock=p_size % 10, rating=p_size
* clicks     <- events where event_type='click': user_id, event_time=ts,
                        product_id=props.k
* sales      <- events where event_type='purchase': invoice_id=event_id,
                        user_id, product_id=props.k, quantity=1 + event_id % 3,
                        unit_cost=floor(value), purchase_time=ts
* sales_bulk <- lineitem join orders: invoice_id=l_orderkey,
                        user_id=o_custkey, product_id=l_partkey,
                        quantity=l_quantity, unit_cost=floor(l_extendedprice /
                        l_quantity), purchase_time=o_orderdate

Every adapter selects only the columns it needs and filters on the event type
first, so parquet column pruning and predicate pushdown reach the scan.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import scratch_path

# The declared schemas of the generated tables this library
# reads (declared, so no schema-inference job runs per read).
TABLE_SCHEMAS = {
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _props_key(col: str = "props") -> Column:
    return F.get_json_object(F.col(col), "$.k").cast("bigint")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        (F.col("p_size") % 10).alias("stock"),
        F.col("p_size").alias("rating"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "click")
        .select(
            F.col("user_id"),
            _props_key().alias("product_id"),
            F.col("ts").alias("event_time"),
        )
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("invoice_id"),
            F.col("user_id"),
            _props_key().alias("product_id"),
            (F.lit(1) + F.col("event_id") % 3).alias("quantity"),
            F.floor("value").cast("int").alias("unit_cost"),
            F.col("ts").alias("purchase_time"),
        )
    )


def sales_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales: the large fact table of the test data."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )
    # orders is the smaller side but still grows with the data: no hint,
    # the planner / AQE choose broadcast or sort-merge from measured sizes.
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("int").alias("unit_cost"),
        F.col("o_orderdate").alias("purchase_time"),
    )


def event_lines(spark: SparkSession, sf_dir: str, drop_invoice: bool = False) -> DataFrame:
    """Every event as a message line (``value, purchase_time``): a purchase as a
    whole sale line, any other event without quantity and cost. With
    ``drop_invoice`` the line starts at the user id, as a click line does."""
    purchase = F.col("event_type") == "purchase"
    fields = [F.col("event_id"), F.col("user_id"), _props_key(), F.when(purchase, 1 + F.col("event_id") % 3),
              F.when(purchase, F.floor("value").cast("int"))]
    line = F.concat_ws(",", *[f.cast("string") for f in fields[1 if drop_invoice else 0 :]])
    return table(spark, sf_dir, "events").select(line.alias("value"), F.col("ts").alias("purchase_time"))


def inventory_file(spark: SparkSession, sf_dir: str) -> str:
    """Path of the inventory written as a CSV text file in the shared folder;
    a product without stock holds a word in place of the number."""
    inv = inventory(spark, sf_dir)
    stock = F.when(F.col("stock") > 0, F.col("stock").cast("string")).otherwise("none")
    path = scratch_path(spark, f"inventory-{uuid.uuid4().hex}")
    inv.select(F.concat_ws(",", F.col("product_id"), F.col("category"), stock, F.col("rating"))).write.text(path)
    return path


#: the order in which ``product_updates`` were loaded
LOAD_ORDER = ["shipped", "order_key", "line"]


def product_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product dimension as it was loaded over time: one row per order line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_returnflag").alias("category"),
        F.col("l_quantity").cast("int").alias("stock"), F.col("l_linenumber").alias("rating"),
        F.col("l_shipdate").alias("shipped"), F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
    )


def listed_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory listed once per order line: identical rows, and for parts
    with returned lines also rows that differ in the rating."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"), "l_returnflag")
    rows = lines.join(inventory(spark, sf_dir), "product_id")
    return rows.select("product_id", "category", "stock", (F.col("rating") + (F.col("l_returnflag") == "R").cast("int")).alias("rating"))


# The same mapping as SQL text, for the DuckDB oracle (views over the tables).
ORACLE_VIEWS = {
    "inv": "SELECT p_partkey AS product_id, p_type AS category, "
    "p_size % 10 AS stock, p_size AS rating FROM part",
    "clicks": "SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, "
    "ts AS event_time FROM events WHERE event_type = 'click'",
    "sales": "SELECT event_id AS invoice_id, user_id, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, "
    "1 + event_id % 3 AS quantity, CAST(floor(value) AS INTEGER) AS unit_cost, "
    "ts AS purchase_time FROM events WHERE event_type = 'purchase'",
    "sales_bulk": "SELECT l_orderkey AS invoice_id, o_custkey AS user_id, l_partkey AS product_id, "
    "CAST(l_quantity AS BIGINT) AS quantity, "
    "CAST(floor(l_extendedprice / l_quantity) AS INTEGER) AS unit_cost, "
    "o_orderdate AS purchase_time FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
}


def oracle_with(*names: str) -> str:
    """A ``WITH`` prefix defining the named adapter views for the oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({ORACLE_VIEWS[n]})" for n in names) + "\n"
