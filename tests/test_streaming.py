"""Structured Streaming forms: stream result = batch result on the same rows.

Message topics are stood in for by folders of parquet files holding
``value, timestamp`` rows (the shape of a topic read)."""

import datetime as dt
import os
import tempfile
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.functions import parse
from basketry.operators import recommend as rec
from basketry.operators import sales as sal
from basketry.operators.common import latest_per_key
from basketry.schemas import CLICK_FIELDS, SALES_FIELDS
from basketry.sources import files, testdata
from basketry.streaming import committed, recommend_stream, sales_stream, sinks
from basketry.streaming.recommend_stream import SettingsMismatch

SF = "/root/testdata/sf0.001"


def scratch():
    return tempfile.mkdtemp(prefix="basketry-test-")


def write_chunks(df, path, chunks, order_col="timestamp"):
    """Append ``df`` as ``chunks`` files in time order (one file per chunk)."""
    ranked = df.withColumn("_chunk", F.ntile(chunks).over(__import__("pyspark.sql").sql.Window.orderBy(order_col)))
    for i in range(1, chunks + 1):
        ranked.where(F.col("_chunk") == i).drop("_chunk").coalesce(1).write.mode("append").parquet(path)


def sale_messages(spark):
    s = testdata.sales(spark, SF)
    return s.select(parse.to_line(SALES_FIELDS), F.col("purchase_time").cast("timestamp").alias("timestamp"))


def click_messages(spark):
    c = testdata.clicks(spark, SF)
    return c.select(parse.to_line(CLICK_FIELDS), F.col("event_time").cast("timestamp").alias("timestamp"))


def sentinel(spark, when):
    return spark.createDataFrame([("-1,-1,-1,1,1", when)], "value string, timestamp timestamp")


def sent(spark, path):
    """The JSON messages of a sink, parsed."""
    return sinks.messages(spark, path).select(F.from_json("value", "category string, sales long").alias("m")).select("m.*")


def run_available_now(query):
    query.awaitTermination(600)
    assert query.exception() is None


@pytest.mark.parametrize("chunks", [1, 3, 10])
def test_sales_stream_equals_batch(spark, chunks):
    root = scratch()
    src = os.path.join(root, "in")
    msgs = sale_messages(spark)
    write_chunks(msgs, src, chunks)
    far = dt.datetime(2030, 1, 1)
    sentinel(spark, far).coalesce(1).write.mode("append").parquet(src)
    sentinel(spark, far + dt.timedelta(hours=1)).coalesce(1).write.mode("append").parquet(src)

    inv = testdata.inventory(spark, SF)
    stream = files.message_file_stream(spark, src, max_files_per_trigger=1)
    q = sales_stream.start(stream, inv, os.path.join(root, "out"), os.path.join(root, "ckpt"),
                           window="10 seconds", trigger={"availableNow": True})
    run_available_now(q)
    got = sent(spark, os.path.join(root, "out"))
    got = sorted((r.category, r.sales) for r in got.select("category", "sales").collect())

    batch_sales = parse.parse_sales(msgs, keep=["timestamp"]).withColumnRenamed("timestamp", "purchase_time")
    want = sal.sales_by_category(sal.enrich_sales(batch_sales, inv), "purchase_time", "10 seconds")
    want = sorted((r.category, r.sales) for r in want.collect())
    assert got == want and len(want) > 0


def test_late_sale_dropped(spark):
    # Spark drops a row once it is older than the watermark of the previous
    # micro-batch (the batch right after the watermark moves may still take
    # it): the late row therefore comes two batches after the advance.
    root = scratch()
    src = os.path.join(root, "in")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    msg = "value string, timestamp timestamp"
    first = spark.createDataFrame([("1,1,1,2,5", t0 + dt.timedelta(seconds=100))], msg)
    second = spark.createDataFrame([("3,1,1,4,5", t0 + dt.timedelta(seconds=101))], msg)
    late = spark.createDataFrame([("2,1,1,7,5", t0 + dt.timedelta(seconds=10))], msg)
    for df in (first, second, late, sentinel(spark, t0 + dt.timedelta(days=1)),
               sentinel(spark, t0 + dt.timedelta(days=2))):
        df.coalesce(1).write.mode("append").parquet(src)
    inv = spark.createDataFrame([(1, "toys", 5, 5)], "product_id long, category string, stock int, rating int")
    stream = files.message_file_stream(spark, src, max_files_per_trigger=1)
    q = sales_stream.start(stream, inv, os.path.join(root, "out"), os.path.join(root, "ckpt"),
                           trigger={"availableNow": True})
    run_available_now(q)
    got = [(r.category, r.sales) for r in sent(spark, os.path.join(root, "out")).collect()]
    assert got == [("toys", 6)]


def batch_latest(spark, clicks, sales_df, inv, repeat=True):
    recs = rec.Recommender(clicks, sales_df, inv).recommend("user", "5 seconds", repeat)
    return latest_per_key(recs, ["user_id"], ["event_time"])


def rows(df):
    return sorted((r.user_id, r.top_product_ids, r.event_time) for r in df.collect())


def test_recommend_single_query_over_both_topics(spark):
    root = scratch()
    clicks_src, sales_src = os.path.join(root, "clicks"), os.path.join(root, "sales")
    write_chunks(click_messages(spark), clicks_src, 3)
    write_chunks(sale_messages(spark), sales_src, 3)
    inv = testdata.inventory(spark, SF)
    job = recommend_stream.RecommendationStream(spark, os.path.join(root, "state"), inv)
    q = job.start(
        files.message_file_stream(spark, clicks_src, max_files_per_trigger=1),
        files.message_file_stream(spark, sales_src, max_files_per_trigger=1),
        trigger={"availableNow": True},
    )
    run_available_now(q)
    clicks = parse.decode_clicks(spark.read.parquet(clicks_src), keep=["timestamp"]).withColumnRenamed(
        "timestamp", "event_time")
    sales_df = parse.decode_sales(spark.read.parquet(sales_src), keep=["timestamp"]).withColumnRenamed(
        "timestamp", "purchase_time")
    assert rows(job.latest()) == rows(batch_latest(spark, clicks, sales_df, inv))


def test_recommend_stream_without_repeats_equals_batch(spark):
    root = scratch()
    clicks_src, sales_src = os.path.join(root, "clicks"), os.path.join(root, "sales")
    write_chunks(click_messages(spark), clicks_src, 3)
    write_chunks(sale_messages(spark), sales_src, 2)
    inv = testdata.inventory(spark, SF)
    job = recommend_stream.RecommendationStream(spark, os.path.join(root, "state"), inv, repeat=False)
    q = job.start(
        files.message_file_stream(spark, clicks_src, max_files_per_trigger=1),
        files.message_file_stream(spark, sales_src, max_files_per_trigger=1),
        trigger={"availableNow": True},
    )
    run_available_now(q)
    clicks = parse.decode_clicks(spark.read.parquet(clicks_src), keep=["timestamp"]).withColumnRenamed(
        "timestamp", "event_time")
    sales_df = parse.decode_sales(spark.read.parquet(sales_src), keep=["timestamp"]).withColumnRenamed(
        "timestamp", "purchase_time")
    want = rows(batch_latest(spark, clicks, sales_df, inv, repeat=False))
    assert rows(job.latest()) == want
    assert want != rows(batch_latest(spark, clicks, sales_df, inv))


MSG = "value string, timestamp timestamp"
T0 = dt.datetime(2024, 1, 1)
TWO = [("1", "a", "5", "3"), ("2", "b", "5", "9")]


def at(s):
    return T0 + dt.timedelta(seconds=s)


def inventory_of(spark, rows_):
    return spark.createDataFrame(rows_, "product_id string, category string, stock string, rating string")


def job_of(spark, root, rows_=TWO, **settings):
    inv = rows_ if callable(rows_) else inventory_of(spark, rows_)
    return recommend_stream.RecommendationStream(spark, os.path.join(root, "state"), inv, **settings)


def feed(spark, root, clicks=(), sales=()):
    """Add one file of messages to each topic that has some."""
    for topic, rows_ in (("clicks", clicks), ("sales", sales)):
        path = os.path.join(root, topic)
        os.makedirs(path, exist_ok=True)
        if rows_:
            spark.createDataFrame(list(rows_), MSG).coalesce(1).write.mode("append").parquet(path)


def run(spark, job, root, checkpoint="ckpt", files_per_batch=1, expect=None):
    """One start of the query over what the topics hold; a restart if the checkpoint is there."""
    topics = [files.message_file_stream(spark, os.path.join(root, t), max_files_per_trigger=files_per_batch) for t in ("clicks", "sales")]
    q = job.start(*topics, os.path.join(root, checkpoint), {"availableNow": True})
    try:
        q.awaitTermination(300)
    except Exception as e:
        if not expect:
            raise
        assert expect in str(e), e
    return q


def step(spark, job, root, clicks=(), sales=(), **kw):
    feed(spark, root, clicks, sales)
    return run(spark, job, root, **kw)


def lists(job):
    return sorted((r.user_id, r.top_product_ids) for r in job.latest().collect())


def all_lists(spark, job):
    return sorted(map(tuple, committed.read(spark, job.log, recommend_stream.schemas.RECOMMENDATION).collect()))


@pytest.mark.parametrize("changed", [{"k": 4}, {"rating_order": "string"}, {"rows_": [*TWO, ("3", "a", "1", "1")]}])
def test_other_settings_on_old_state_are_refused(spark, changed):
    root = scratch()
    step(spark, job_of(spark, root, k=2), root, [("7,1", at(0))])
    with pytest.raises(SettingsMismatch):
        run(spark, job_of(spark, root, **({"k": 2} | changed)), root)
    # the same settings, and the same inventory in another order, go on
    job = job_of(spark, root, TWO[::-1], k=2)
    step(spark, job, root, [("7,2", at(1))])
    assert lists(job) == [("7", "2,1")]


def test_restart_goes_on_from_the_state(spark):
    """A new job on the old checkpoint: the state and the output are those before it."""
    root = scratch()
    step(spark, job_of(spark, root), root, [("7,1", at(0))], [("1,8,1,1,1", at(0))])
    job = job_of(spark, root)
    step(spark, job, root, [("7,2", at(1)), ("8,1", at(1))])
    # the view of the first start is still ranked; each user in a batch of the second
    assert lists(job) == [("7", "2,1"), ("8", "1")]
    assert {r[3] for r in all_lists(spark, job)} == {0}


def test_new_checkpoint_adds_a_run(spark):
    """It starts from an empty state and wins over the older run's lists, by user."""
    root = scratch()
    job = job_of(spark, root)
    step(spark, job, root, [("7,1", at(50)), ("8,1", at(50))])
    other = scratch()
    step(spark, job, other, [("8,2", at(0))])
    assert lists(job) == [("7", "1"), ("8", "2")]
    assert {r[3] for r in all_lists(spark, job)} == {0, 1}


@pytest.mark.parametrize("stop_at", ["before the output", "after the output"])
def test_crash_and_replay(spark, stop_at, monkeypatch):
    """A batch that crashed around its output runs again with the same state."""
    root = scratch()
    step(spark, job_of(spark, root), root, [("7,1", at(0))])
    real = recommend_stream.committed.write_batch

    def crash(*a, **b):
        if stop_at == "after the output":
            real(*a, **b)
        raise RuntimeError("crash")

    monkeypatch.setattr(recommend_stream.committed, "write_batch", crash)
    step(spark, job_of(spark, root), root, [("7,2", at(1))], expect="crash")
    monkeypatch.setattr(recommend_stream.committed, "write_batch", real)
    job = job_of(spark, root)
    step(spark, job, root, [("8,2", at(2))])
    assert lists(job) == [("7", "2,1"), ("8", "2")]
    rows_ = all_lists(spark, job)
    assert len(rows_) == len(set(rows_)) == 3 and [r[4] for r in sorted(rows_, key=lambda r: r[4])] == [0, 1, 2]


def test_unchanged_users_send_nothing(spark):
    root = scratch()
    job = job_of(spark, root, k=2)
    step(spark, job, root, [("7,1", at(0)), ("7,1", at(1)), ("8,1", at(0))])
    # a later view of a category seen twice before changes nothing
    step(spark, job, root, [("7,1", at(9)), ("8,1", at(5))])
    assert {r[0] for r in all_lists(spark, job) if r[4] == 1} == {"8"}


def test_hot_user_is_cut_before_the_state(spark):
    """Half of all messages are one user's: the tasks that read them send few rows on, the result is the batch's."""
    root = scratch()
    inv = [(str(p), "ab"[p % 2], "5", str(p % 11)) for p in range(60)]
    clicks = [(f"hot,{i % 60}", at(i % 700)) for i in range(6000)] + [(f"u{i},{i % 60}", at(i)) for i in range(300)]
    sales = [(f"{i},hot,{i % 50},1,1", at(i)) for i in range(3000)]
    feed(spark, root, clicks, sales)
    job = job_of(spark, root, inv)
    topics = [spark.read.parquet(os.path.join(root, t)) for t in ("clicks", "sales")]
    rows_ = job.reduced(*topics)
    hot = rows_.where("user_id = 'hot'").count()
    assert 0 < hot <= rows_.rdd.getNumPartitions() * 2 * 2 * job.k
    run(spark, job, root)
    messages = [spark.read.parquet(os.path.join(root, t)) for t in ("clicks", "sales")]
    clicked = parse.decode_clicks(messages[0], keep=["timestamp"]).withColumnRenamed("timestamp", "event_time")
    assert rows(job.latest()) == rows(batch_latest(spark, clicked, parse.decode_sales(messages[1]), inventory_of(spark, inv)))


def test_late_clicks_go_to_a_table(spark):
    """Both topics hold the watermark: a slow one holds it back. No click is lost."""
    root = scratch()
    job = job_of(spark, root, lateness=10)
    # one file of each topic is a batch
    feed(spark, root, [("7,1", at(100))], [("1,9,1,1,1", at(50))])
    # the sales topic stands at 50: a click of 45 is in time, one of 39 is not
    feed(spark, root, [("8,1", at(45)), ("10,1", at(39))], [("2,9,2,1,1", at(300))])
    # now the clicks hold it, at 100; a purchase is never late
    feed(spark, root, [("11,1", at(91)), ("12,2", at(89))], [("3,12,1,1,1", at(0))])
    feed(spark, root, [("12,1", at(400))], [("4,9,1,1,1", at(400))])
    run(spark, job, root)
    assert lists(job) == [("11", "1"), ("12", "1"), ("7", "1"), ("8", "1")]
    late = sorted((r.user_id, r.category, r.event_time) for r in job.late_clicks().collect())
    assert late == [("10", "a", at(39)), ("12", "b", at(89))]
    bought = committed.read(spark, job.log, recommend_stream.schemas.RECOMMENDATION).where("user_id = '12'").count()
    assert bought == 1


def test_inventory_is_refreshed_per_batch(spark):
    root = scratch()
    stock = {"rows": [("1", "a", "5", "3"), ("2", "a", "0", "9")]}
    job = job_of(spark, root, lambda: inventory_of(spark, stock["rows"]))
    step(spark, job, root, sales=[("1,7,2,1,1", at(0))])  # bought while out of stock
    step(spark, job, root, [("7,1", at(1)), ("8,1", at(1))])
    assert lists(job) == [("7", "1"), ("8", "1")]
    # product 2 is back: bought by 7, so first; 8 keeps its list until touched
    stock["rows"] = [("1", "a", "5", "3"), ("2", "a", "4", "1"), ("3", "a", "1", "2")]
    step(spark, job, root, [("7,1", at(2))])
    assert dict(lists(job))["7"].startswith("2,2") and dict(lists(job))["8"] == "1"
    step(spark, job, root, [("8,3", at(3))])
    assert dict(lists(job))["8"].split(",")[0] == "1"


def test_malformed_lines_stop_the_stream_or_are_counted(spark):
    clicks = [("u7,1", at(0)), ("broken", at(0)), ("", at(0)), (None, at(0))]
    root = scratch()
    step(spark, job_of(spark, root), root, clicks, expect="malformed click")
    root = scratch()
    job = job_of(spark, root, on_error="drop")
    q = step(spark, job, root, clicks)
    assert lists(job) == [("u7", "1")]
    counts = [p.observedMetrics["click_lines"] for p in q.recentProgress if "click_lines" in p.observedMetrics]
    assert [sum(c[n] for c in counts) for n in ("lines", "empty", "malformed")] == [4, 2, 1]


def test_upsert_newest_window_stays(spark):
    root = scratch()
    job = job_of(spark, root)
    step(spark, job, root, [("7,1", at(2)), ("7,1", at(7))])
    # a late click for the first window
    step(spark, job, root, [("7,2", at(3))])
    out = job.latest().collect()
    assert [r.user_id for r in out] == ["7"] and out[0].event_time == at(10)


@pytest.mark.parametrize("order", rec.RATING_ORDERS)
def test_reduced_state_orders_products_as_the_batch(spark, order):
    """Ratings that are no numbers, tie or differ in text and number; numeric and text ids."""
    ratings = ["9", "10", "2", "x", None, "1e1", "9.0", "NaN", "-1", "10"]
    for id_type in ("string", "long"):
        inv = spark.createDataFrame(
            [(str(p), "a", str(1 + p % 3), ratings[p % 10]) for p in range(40)], "product_id string, category string, stock string, rating string"
        ).withColumn("product_id", F.col("product_id").cast(id_type))
        root = scratch()
        feed(spark, root, [("7,1", at(0))], [(f"{p},7,{p},1,1", at(p)) for p in range(0, 40, 3)])
        job = recommend_stream.RecommendationStream(spark, os.path.join(root, "state"), inv, k=9, rating_order=order)
        run(spark, job, root)
        clicks = parse.decode_clicks(spark.read.parquet(os.path.join(root, "clicks")), keep=["timestamp"]).withColumnRenamed("timestamp", "event_time")
        bought = parse.decode_sales(spark.read.parquet(os.path.join(root, "sales")))
        want = rec.Recommender(clicks, bought, inv, 9, order).recommend("user")
        assert lists(job) == sorted((r.user_id, r.top_product_ids) for r in want.collect())


def test_processing_time_sends_one_final_sum_per_window(spark, capsys):
    """Batches that share a window add up to one message; nothing is sent twice."""
    root = scratch()
    src = os.path.join(root, "in")
    inv = spark.createDataFrame([(1, "toys", 5, 5)], "product_id long, category string, stock int, rating int")
    spark.createDataFrame([("1,1,1,2,5", T0)], MSG).coalesce(1).write.parquet(src)
    stream = files.message_file_stream(spark, src, max_files_per_trigger=1)
    q = sales_stream.start(stream, inv, os.path.join(root, "out"), os.path.join(root, "ckpt"), window="3 seconds",
                           watermark="0 seconds", time_mode="processing", print_rows=5)
    for i in range(2):  # three batches of 2 in all
        q.processAllAvailable()
        spark.createDataFrame([(f"{2 + i},1,1,2,5", T0)], MSG).coalesce(1).write.mode("append").parquet(src)
    q.processAllAvailable()
    # later rows of an unknown product move the watermark past the windows
    for _ in range(3):
        time.sleep(3.1)
        sentinel(spark, T0).coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
    q.stop()
    sums = [r.sales for r in sent(spark, os.path.join(root, "out")).collect()]
    assert sum(sums) == 6 and all(s in (2, 4, 6) for s in sums)
    assert "-- batch 0, preview of at most 5 rows" in capsys.readouterr().out


def test_sales_stream_leaves_out_and_reports_malformed_lines(spark):
    root = scratch()
    src = os.path.join(root, "in")
    lines = [("1,1,1,2,5", T0), ("bad", T0), ("2,1,1,3,x", T0), ("-1,-1,-1,1,1", at(1e5))]
    spark.createDataFrame(lines, MSG).coalesce(1).write.parquet(src)
    sentinel(spark, at(2e5)).coalesce(1).write.mode("append").parquet(src)
    inv = spark.createDataFrame([(1, "toys", 5, 5)], "product_id long, category string, stock int, rating int")

    def run(on_error):
        q = sales_stream.start(files.message_file_stream(spark, src, max_files_per_trigger=1), inv,
                               os.path.join(root, on_error), os.path.join(root, "ckpt" + on_error),
                               trigger={"availableNow": True}, on_error=on_error)
        q.awaitTermination(300)
        return q

    q = run("drop")
    assert q.exception() is None
    assert [r.sales for r in sent(spark, os.path.join(root, "drop")).collect()] == [2]
    assert sum(p.observedMetrics["sale_lines"]["malformed"] for p in q.recentProgress if p.observedMetrics) == 2
    with pytest.raises(Exception):
        run("fail")


def test_recommend_extra_output_gets_keyed_records(spark):
    root = scratch()
    out = os.path.join(root, "records")
    job = job_of(spark, root, outputs=(sinks.table(out),))
    step(spark, job, root, [("7,1", at(2))])
    got = [(r.key, r.value) for r in committed.read(spark, out, "key string, value string").collect()]
    assert got == [("7", '7,"1",2024-01-01 00:00:05.000')] or got == [("7", "7,1,2024-01-01 00:00:05.000")]


def message_stream(spark, src, out, checkpoint, **kw):
    df = files.message_file_stream(spark, src, max_files_per_trigger=1)
    committed.register(spark)
    q = df.writeStream.format(committed.NAME).option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(300)


def values(spark, out):
    return sorted(r.value for r in sinks.messages(spark, out).collect())


@pytest.mark.parametrize("kind", ["format", "foreachBatch"])
def test_messages_survive_a_new_checkpoint_and_a_replay(spark, kind):
    """Every message once: a second run of a batch, and a query that counts its batches from 0 again."""
    import shutil

    root = scratch()
    out, src = os.path.join(root, "out"), [os.path.join(root, f"in{i}") for i in range(2)]
    for i in range(2):
        spark.createDataFrame([(f"m{i}", at(i)), (f"n{i}", at(i))], MSG).coalesce(2).write.parquet(src[i])

    def go(i, checkpoint):
        if kind == "format":
            message_stream(spark, src[i], out, checkpoint)
        else:
            df = files.message_file_stream(spark, src[i], max_files_per_trigger=1)
            run_available_now(df.writeStream.foreachBatch(sinks.json_messages(out)).option("checkpointLocation", checkpoint)
                              .trigger(availableNow=True).start())

    ckpt = os.path.join(root, "a")
    go(0, ckpt)
    # the batch was written and committed by the sink, but the query did not note it: it runs again
    shutil.rmtree(os.path.join(ckpt, "commits"))
    go(0, ckpt)
    assert values(spark, out) == ["m0", "n0"]
    go(1, os.path.join(root, "b"))
    assert values(spark, out) == ["m0", "m1", "n0", "n1"]


def test_files_without_a_commit_are_not_read(spark, monkeypatch):
    """A crash between the tasks' writes and the commit, and an aborted batch."""
    out = os.path.join(scratch(), "out")
    sinks.json_messages(out)(spark.createDataFrame([("a", at(0))], MSG), 0)
    (there,) = os.listdir(os.path.join(out, "files"))
    import shutil

    shutil.copy(os.path.join(out, "files", there), os.path.join(out, "files", "left-over.parquet"))
    broken = spark.createDataFrame([("b", at(0)), ("c", at(0))], MSG).repartition(2)
    broken = broken.withColumn("value", F.when(F.col("value") == "c", F.raise_error(F.lit("stop"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="stop"):
        sinks.json_messages(out)(broken, 1)
    assert values(spark, out) == ["a"]
    sinks.json_messages(out)(spark.createDataFrame([("b", at(0)), ("c", at(0))], MSG), 1)
    assert values(spark, out) == ["a", "b", "c"]


def test_a_committed_batch_stays_as_it_is(spark):
    out = os.path.join(scratch(), "out")
    for text in ("first", "second"):
        sinks.json_messages(out)(spark.createDataFrame([(text, at(0))], MSG), 7)
    assert values(spark, out) == ["first"] and len(os.listdir(os.path.join(out, "files"))) == 1
    # nothing at all: no commit, no rows
    empty = os.path.join(scratch(), "empty")
    sinks.json_messages(empty)(spark.createDataFrame([], MSG), 0)
    assert values(spark, empty) == []


def test_upserts_are_ordered_by_run_and_batch_not_by_clock(spark):
    out, schema = os.path.join(scratch(), "log"), "user_id long, top_product_ids string, event_time timestamp"
    write = lambda rows_, batch, query: committed.write_batch(spark.createDataFrame(rows_, schema), out, batch, query)
    write([(1, "old", at(50)), (2, "kept", at(0))], 7, "query-a")
    write([(1, "new", at(0)), (1, "newer window", at(5))], 0, "query-b")
    current = lambda: sorted((r.user_id, r.top_product_ids) for r in sinks.upserts(spark, out, schema, ["user_id"], ["event_time"]).collect())
    assert current() == [(1, "newer window"), (2, "kept")]
    write([(2, "later", at(9))], 1, "query-b")
    assert current() == [(1, "newer window"), (2, "later")]


def test_kafka_factories_fail_fast_without_the_connector(spark):
    """Offline the connector package is absent: both factories build their
    reader and fail at ``load()`` with Spark's data-source error, before any
    query starts."""
    from pyspark.errors import AnalysisException

    for factory in (files.kafka_stream, files.kafka_batch):
        with pytest.raises(AnalysisException, match="kafka"):
            factory(spark, "localhost:9", "sales.records")


def test_sales_stream_takes_new_product_versions_while_it_runs(spark):
    """A product moves to another category midway: each sale counts for the one it had then."""
    root = scratch()
    dim, src = os.path.join(root, "dim"), os.path.join(root, "in")
    schema = "product_id long, category string, valid_from timestamp"
    load = lambda rows_, n: committed.write_batch(spark.createDataFrame(rows_, schema), dim, n, "load")
    load([(1, "toys", at(0)), (2, "food", at(0))], 0)
    send_ = lambda rows_: spark.createDataFrame(rows_, MSG).coalesce(1).write.mode("append").parquet(src)
    send_([("1,9,1,2,5", at(10)), ("2,9,2,1,5", at(10)), ("9,9,1,7,5", at(-1))])  # the last before its first version
    products = committed.read(spark, dim, schema, live=True)
    q = sales_stream.start(files.message_file_stream(spark, src, max_files_per_trigger=1), products, os.path.join(root, "out"),
                           os.path.join(root, "ckpt"), watermark="100 seconds")
    try:
        q.processAllAvailable()
        load([(1, "games", at(20)), (3, "new", at(0))], 1)
        send_([("3,9,1,3,5", at(19)), ("4,9,1,4,5", at(20)), ("5,9,3,5,5", at(12))])
        q.processAllAvailable()
        # a version of the same instant from a later load wins
        load([(2, "fruit", at(0))], 2)
        send_([("6,9,2,6,5", at(30))])
        q.processAllAvailable()
        for far in (1e5, 2e5):
            sentinel(spark, at(far)).coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.category, r.sales) for r in sent(spark, os.path.join(root, "out")).collect())
    assert got == [("food", 1), ("fruit", 6), ("games", 4), ("new", 5), ("toys", 5)]


def test_a_batch_of_many_users_is_cut_as_one(monkeypatch):
    """Few rows of each of many users: one frame a batch, not one a user."""
    reducer = recommend_stream.Reducer(2, 2, False, {"product_id"})
    users = [None, *(str(u) for u in range(2000))]
    rows = [(u, "view", g, t, None, None, None, None) for u in users for g in ("a", None) for t in (3, 1, 2, 1)]
    rows += [(u, "bought", "a", None, p, "1", r, x) for u in users for p, r, x in (("10", "2", 2.0), ("9", "2", 2.0), ("7", "1", 1.0), ("8", None, None))]
    frame = pd.DataFrame(rows, columns=["user_id", *recommend_stream._NAMES]).sample(frac=1, random_state=1)
    built = []
    build = recommend_stream.Reducer.rows
    monkeypatch.setattr(recommend_stream.Reducer, "rows", lambda self, *a: built.append(1) or build(self, *a))
    out = list(reducer.cut(iter([frame, frame[:0]])))
    assert len(out) == len(built) == 1
    plain = lambda x: None if x is None or x is pd.NA or x != x else x
    got = sorted((tuple(map(plain, r)) for r in out[0].itertuples(index=False)), key=str)
    want = [(u, "view", g, t, None, None, None, None) for u in users for g in ("a", None) for t in (1, 2)]
    want += [(u, "bought", "a", None, p, "1", "2", 2.0) for u in users for p in ("9", "10")]
    assert got == sorted(want, key=str)
