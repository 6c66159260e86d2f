"""Streaming sales by category (the sales job on Structured Streaming).

sale messages (``value`` text, record ``timestamp``)
  -> strict line parser
  -> stream-static join with the (broadcast) product dimension
  -> sum of quantity per category per tumbling window
  -> JSON message per (window, category) and optional console print.

Two time modes:

* ``event`` (default): windows on the record timestamp with a watermark
  (default 1 s); a window is emitted once, when the watermark passes its
  end (append mode); rows older than the watermark are dropped.
* ``processing``: windows on the wall clock at which each micro-batch is
  processed (stamped per batch, so not repeatable), with a watermark on that
  stamp.

Both emit one final message per window, when the watermark passes its end
(append mode), so the messages of a category can be added up. Spark moves the
watermark with the rows it sees: the last window is sent once later rows come.

The product dimension is fixed, or (a frame with ``valid_from``) a table of
versions: each sale then gets the category that its product had at the time. The
versions are read anew for every micro-batch if they come from
``committed.read(..., live=True)``: a version added while the stream runs takes
effect with the next batch.

Malformed lines stop the stream (``on_error="fail"``) or are left out and
counted: every progress report holds the observed metric ``sale_lines``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.functions import encode, parse
from basketry.operators import sales as sal
from basketry.session import checkpoint_root, scratch_path
from basketry.streaming import committed, sinks

TIME_MODES = ("event", "processing")


def sales_by_category_stream(
    messages: DataFrame,
    products: DataFrame,
    window: str = "10 seconds",
    watermark: str = "1 second",
    time_mode: str = "event",
    on_error: str = "fail",
) -> DataFrame:
    """Windowed sums per category from a stream of sale messages."""
    if time_mode not in TIME_MODES:
        raise ValueError(f"time_mode must be one of {TIME_MODES}, not {time_mode!r}")
    parsed = parse.parse_sales(messages, on_error=on_error, keep=["timestamp"], observe="sale_lines")
    sales = parsed.withColumnRenamed("timestamp", "purchase_time")
    if time_mode == "processing":
        sales = sal.with_processing_time(sales.drop("purchase_time"), "purchase_time")
    sales = sales.withWatermark("purchase_time", watermark)
    if "valid_from" in products.columns:
        enriched = sal.enrich_sales_from_lists(sales, sal.version_lists(products, version_order=_version_order(products)))
    else:
        enriched = sal.enrich_sales(sales, products)
    return sal.sales_by_category(enriched, "purchase_time", window)


def _version_order(versions: DataFrame) -> list[str]:
    """Versions of one instant are ordered by the load that brought them."""
    return [c for c in (committed.RUN, committed.BATCH) if c in versions.columns]


def as_messages(sums: DataFrame) -> DataFrame:
    """The topic record: JSON value ``{"category", "sales"}``; the window end
    rides along as the record timestamp (it is not part of the message)."""
    return sums.select(F.col("window_end").alias("timestamp"), encode.sales_by_category_json().alias("value"))


def start(
    messages: DataFrame,
    products: DataFrame,
    output_path: str,
    checkpoint_path: str | None = None,
    window: str = "10 seconds",
    watermark: str = "1 second",
    time_mode: str = "event",
    print_rows: int = 0,
    trigger: dict | None = None,
    query_name: str = "sales_by_category",
    on_error: str = "fail",
    extra_sinks: tuple[sinks.BatchSink, ...] = (),
) -> StreamingQuery:
    """Run the job: JSON messages to ``output_path`` (each batch of a query once,
    see ``committed``) and, when ``print_rows`` > 0, a console print of each batch.
    The checkpoint defaults to the session's shared ``spark.checkpoint.dir``.
    ``on_error``: see the module text."""
    if checkpoint_path is None:
        checkpoint_path = scratch_path(messages.sparkSession, f"checkpoints/{query_name}")
    out = as_messages(sales_by_category_stream(messages, products, window, watermark, time_mode, on_error))
    targets = [sinks.json_messages(output_path)]
    if print_rows:
        targets.append(sinks.console(print_rows))
    targets.extend(extra_sinks)
    writer = (
        out.writeStream.queryName(query_name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(sinks.fan_out(*targets))
    )
    writer = writer.trigger(**trigger) if trigger else writer
    return writer.start()


def main(argv: list[str] | None = None) -> None:
    """Start the job from the command line and block.

    Sources: ``--kafka SERVERS --topic T`` or ``--messages DIR`` (files of
    ``value, timestamp`` rows). Products: a CSV text file, one product per
    line, read once (later lines for an id replace earlier ones).
    """
    import argparse

    from basketry.plans.sales_job import products_from_lines
    from basketry.session import build_session
    from basketry.sources import files

    ap = argparse.ArgumentParser(description="streaming sales by category")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--messages", help="folder of value,timestamp parquet files")
    ap.add_argument("--topic", default="sales.records")
    ap.add_argument("--products", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint", default=None)
    ap.add_argument("--window", default="10 seconds")
    ap.add_argument("--watermark", default="1 second")
    ap.add_argument("--time-mode", default="event", choices=TIME_MODES)
    ap.add_argument("--print-rows", type=int, default=20)
    ap.add_argument("--on-error", default="fail", choices=("fail", "drop"),
                    help="malformed sale lines: stop, or leave out and count")
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--kafka-out-topic", default=None, help="also send the JSON messages to this topic")
    args = ap.parse_args(argv)
    spark = build_session(app_name="sales-by-category")
    if args.kafka:
        messages = files.kafka_stream(spark, args.kafka, args.topic)
    else:
        messages = files.message_file_stream(spark, args.messages)
    # The dimension is read once: materialised with a reliable checkpoint (in
    # the shared spark.checkpoint.dir), which also takes the line-order id out
    # of the streaming plan (Spark rejects it there).
    checkpoint_root(spark)
    products = products_from_lines(files.text_lines(spark, args.products)).checkpoint()
    extra = ()
    if args.kafka_out_topic:
        to_topic = sinks.kafka(args.kafka, args.kafka_out_topic)
        extra = (lambda df, batch_id: to_topic(df.select("value"), batch_id),)
    query = start(messages, products, args.out, args.checkpoint, args.window, args.watermark,
                  args.time_mode, args.print_rows, {"availableNow": True} if args.available_now else None,
                  on_error=args.on_error, extra_sinks=extra)
    query.awaitTermination()
    malformed = sum(p.observedMetrics["sale_lines"]["malformed"] for p in query.recentProgress if p.observedMetrics)
    print(f"malformed lines left out: {malformed}")


if __name__ == "__main__":
    main()
