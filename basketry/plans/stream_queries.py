"""The streaming jobs as registered queries.

Each writes its topics from the test tables as files of messages, runs the stream
until all are processed (``availableNow``) and returns what its sink has committed.
A last message of a far later time moves the watermarks, so that every window of
the tables is sent. The SQL is the batch meaning of the job.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import parse
from basketry.operators import recommend as rec
from basketry.plans import catalog
from basketry.plans.registry import register
from basketry.session import scratch_path
from basketry.sources import files
from basketry.sources import testdata as td
from basketry.streaming import committed, recommend_stream, sales_stream, sinks, view_stream

_END = "2100-01-01 00:00:00"
_DONE = {"availableNow": True}


def _root(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def _one_state_per_core(spark: SparkSession) -> Iterator[None]:
    """A stream keeps the number of its state partitions from its first start, and
    loads and commits each of them in every batch: one per core is enough here."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _topic(rows: DataFrame, path: str, value: Column, time: str, last: str) -> DataFrame:
    """The rows as messages in files, with a last one (a whole line of no known
    product); returns the stream over them."""
    spark = rows.sparkSession
    rows.select(value.alias("value"), F.col(time).cast("timestamp").alias("timestamp")).write.parquet(path)
    end = spark.sql(f"SELECT '{last}' AS value, TIMESTAMP '{_END}' AS timestamp")
    end.write.mode("append").parquet(path)
    return files.message_file_stream(spark, path)


def _clicks(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    return _topic(td.clicks(spark, sf_dir), f"{root}/clicks", parse.to_line(schemas.CLICK_FIELDS), "event_time", "-1,-1")


def _sales(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    return _topic(td.sales(spark, sf_dir), f"{root}/sales", parse.to_line(schemas.SALES_FIELDS), "purchase_time", "-1,-1,-1,1,1")


@register(
    "stream_sales_by_category",
    catalog._enriched_sql() + f", sums AS ({catalog._sums_sql('10 seconds')})\n"
    "SELECT window_end AS timestamp, json_object('category', category, 'sales', sales)::VARCHAR AS value FROM sums",
)
def stream_sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales job: message topic -> enriched -> windowed sums -> message topic."""
    root = _root(spark, "stream-sales")
    with _one_state_per_core(spark):
        q = sales_stream.start(_sales(spark, sf_dir, root), td.inventory(spark, sf_dir), f"{root}/out", f"{root}/checkpoint", trigger=_DONE)
    q.awaitTermination()
    return sinks.messages(spark, f"{root}/out").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register(
    "stream_recommend_latest",
    "WITH rec AS (" + catalog._recommend_user_sql() + ")\nSELECT CAST(user_id AS VARCHAR) AS user_id, "
    "arg_max(top_product_ids, event_time) AS top_product_ids, max(event_time) AS event_time FROM rec GROUP BY user_id",
)
def stream_recommend_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recommendation job: both topics -> state per user -> keyed lists."""
    root = _root(spark, "stream-recommend")
    job = recommend_stream.RecommendationStream(spark, root, td.inventory(spark, sf_dir))
    with _one_state_per_core(spark):
        q = job.start(_clicks(spark, sf_dir, root), _sales(spark, sf_dir, root), trigger=_DONE)
    q.awaitTermination()
    return job.latest().withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


_LOOKBACK = "7 days"
_LOOKBACK_SQL = catalog._CANDIDATES_SQL.replace(
    "FROM owned WHERE owned.user_id = viewed.user_id AND owned.product_id = stocked.product_id",
    "FROM sales WHERE sales.user_id = viewed.user_id AND sales.product_id = stocked.product_id "
    f"AND sales.purchase_time <= viewed.event_time AND sales.purchase_time >= viewed.event_time - INTERVAL '{_LOOKBACK}'",
)


@register(
    "stream_recommend_per_view",
    _LOOKBACK_SQL + f", ranked AS (SELECT {catalog._CAND_COLS}, {catalog._rank_sql('user_id, event_time', 'rating', False)} AS rn FROM candidates)\n"
    "SELECT CAST(user_id AS VARCHAR) AS user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rn) AS top_product_ids, event_time "
    "FROM ranked WHERE rn <= 6 GROUP BY user_id, event_time",
)
def stream_recommend_per_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists per page view in pure Structured Streaming; bought within a week."""
    root = _root(spark, "stream-views")
    inventory = td.inventory(spark, sf_dir)
    product = F.col("product_id").try_cast("bigint")
    clicks = parse.decode_clicks(_clicks(spark, sf_dir, root), keep=["timestamp"]).withColumnRenamed("timestamp", "event_time")
    sales = parse.decode_sales(_sales(spark, sf_dir, root), keep=["timestamp"]).withColumnRenamed("timestamp", "purchase_time")
    clicks, sales = (df.withColumn("product_id", product) for df in (clicks, sales.select("user_id", "product_id", "purchase_time")))
    lists = view_stream.recommendations(view_stream.view_lists(clicks, sales, inventory, _LOOKBACK))
    committed.register(spark)
    writer = lists.writeStream.format(committed.NAME).option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    with _one_state_per_core(spark):
        q = writer.trigger(**_DONE).start()
    q.awaitTermination()
    found = committed.read(spark, f"{root}/out", schemas.RECOMMENDATION).drop(committed.RUN, committed.BATCH)
    return found.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@register(
    "stream_late_clicks",
    "WITH clicks AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, ts FROM events WHERE event_type = 'click')\n"
    "SELECT CAST(c.user_id AS VARCHAR) AS user_id, p.p_type AS category, c.ts AS event_time FROM clicks c JOIN part p ON p.p_partkey = c.product_id "
    "WHERE c.user_id % 5 = 0 AND c.ts < (SELECT max(ts) FROM clicks WHERE user_id % 5 <> 0) - INTERVAL '7 days' GROUP BY ALL",
)
def stream_late_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks that come after the watermark of both topics has passed them: the
    clicks of a fifth of the users are sent a batch after all others."""
    root = _root(spark, "stream-late")
    clicks, sales = td.clicks(spark, sf_dir), td.sales(spark, sf_dir)
    line = parse.to_line(schemas.CLICK_FIELDS)
    job = recommend_stream.RecommendationStream(spark, root, td.inventory(spark, sf_dir), lateness=7 * 86400)
    send = lambda df: df.select(line, F.col("event_time").cast("timestamp").alias("timestamp")).coalesce(1).write.mode("append").parquet(f"{root}/clicks")
    send(clicks.where("user_id % 5 <> 0"))
    send(clicks.where("user_id % 5 = 0"))
    # the sales topic stands at least as late as the clicks
    newest = clicks.agg(F.max("event_time").alias("purchase_time"))
    whole = sales.select(*schemas.SALES_FIELDS, "purchase_time").unionByName(
        newest.select(*[F.lit(-1).alias(c) for c in schemas.SALES_FIELDS], "purchase_time"))
    sale = [parse.to_line(schemas.SALES_FIELDS), F.col("purchase_time").cast("timestamp").alias("timestamp")]
    whole.select(*sale).coalesce(1).write.parquet(f"{root}/sales")
    streams = [files.message_file_stream(spark, f"{root}/{t}", max_files_per_trigger=1) for t in ("clicks", "sales")]
    with _one_state_per_core(spark):
        q = job.start(*streams, trigger=_DONE)
    q.awaitTermination()
    return job.late_clicks().withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).distinct()
