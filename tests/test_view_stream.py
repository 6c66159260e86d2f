"""The pure streaming form of the lists per view, against plain loops."""

import datetime as dt
import random
import tempfile

import pytest

from basketry.operators import recommend as rec
from basketry.streaming import committed, view_stream

T0 = dt.datetime(2024, 1, 1)
CLICK = "user_id long, product_id long, event_time timestamp"
SALE = "user_id long, product_id long, purchase_time timestamp"
INV = [(p, "abc"[p % 3], p % 4, (p * 7) % 11) for p in range(30)]
FAR = T0 + dt.timedelta(days=400)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def inventory(spark):
    return spark.createDataFrame(INV, "product_id long, category string, stock int, rating int")


def loop(clicks, sales, lookback, k):
    out = {}
    category = {p: c for p, c, _, _ in INV}
    for u, t in {(u, t) for u, p, t in clicks if p in category}:
        seen = {category[p] for u2, p, t2 in clicks if (u2, t2) == (u, t) and p in category}
        owned = {p for u2, p, t2 in sales if u2 == u and t - dt.timedelta(seconds=lookback) <= t2 <= t}
        rows = sorted((p not in owned, -r, p) for p, c, s, r in INV if s > 0 and c in seen)[:k]
        if rows:
            out[u, t] = ",".join(str(p) for _, _, p in rows)
    return out


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def read(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def start(spark, root, lists, **trigger):
    committed.register(spark)
    writer = lists.writeStream.format(committed.NAME).option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    return writer.trigger(**trigger).start() if trigger else writer.start()


def result(spark, root):
    rows = committed.read(spark, f"{root}/out", "user_id long, top_product_ids string, event_time timestamp").collect()
    got = {(r.user_id, r.event_time): r.top_product_ids for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("chunks", [1, 4])
def test_stream_equals_a_plain_loop(spark, chunks):
    """Views with and without purchases, of several categories at once, clicks sent twice."""
    rng = random.Random(chunks)
    clicks = sorted([(rng.randrange(6), rng.randrange(33), at(rng.randrange(600))) for _ in range(250)], key=lambda r: r[2])
    clicks += [(7, 0, at(600)), (7, 1, at(600)), (7, 2, at(600))]
    sales = sorted([(rng.randrange(7), rng.randrange(33), at(rng.randrange(600))) for _ in range(200)], key=lambda r: r[2])
    root = tempfile.mkdtemp(prefix="basketry-test-")
    for i in range(chunks):
        part = lambda rows: rows[i * len(rows) // chunks : (i + 1) * len(rows) // chunks]  # noqa: E731, B023
        put(spark, f"{root}/c", part(clicks) + part(clicks)[-5:], CLICK)
        put(spark, f"{root}/s", part(sales), SALE)
    for day in range(2):
        put(spark, f"{root}/c", [(-1, -1, FAR + dt.timedelta(days=day))], CLICK)
        put(spark, f"{root}/s", [(-1, -1, FAR + dt.timedelta(days=day))], SALE)
    lists = view_stream.view_lists(read(spark, f"{root}/c", CLICK), read(spark, f"{root}/s", SALE), inventory(spark), "60 seconds", 4)
    q = start(spark, root, view_stream.recommendations(lists), availableNow=True)
    q.awaitTermination(300)
    want = loop(clicks, sales, 60, 4)
    assert result(spark, root) == want and len(want) > 100
    # the same function over bounded frames
    bounded = view_stream.view_lists(spark.createDataFrame(clicks, CLICK), spark.createDataFrame(sales, SALE), inventory(spark), "60 seconds", 4)
    assert {(r.user_id, r.event_time): r.top_product_ids for r in view_stream.recommendations(bounded).collect()} == want


def test_a_view_waits_for_both_topics_and_state_expires(spark):
    root = tempfile.mkdtemp(prefix="basketry-test-")
    put(spark, f"{root}/c", [(1, 0, at(0)), (1, 0, at(0))], CLICK)
    put(spark, f"{root}/s", [(1, 3, at(-5))], SALE)
    lists = view_stream.view_lists(read(spark, f"{root}/c", CLICK), read(spark, f"{root}/s", SALE), inventory(spark), "60 seconds", 2)
    q = start(spark, root, view_stream.recommendations(lists))
    try:
        q.processAllAvailable()
        put(spark, f"{root}/c", [(1, 0, at(0)), (2, 0, at(1000))], CLICK)  # the click once more
        q.processAllAvailable()
        # the clicks are far ahead, but a purchase before the view may still come
        assert result(spark, root) == {}
        held = sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"])
        put(spark, f"{root}/s", [(1, 6, at(-10)), (9, 3, at(1000))], SALE)
        q.processAllAvailable()
        put(spark, f"{root}/s", [(9, 3, at(1001))], SALE)
        q.processAllAvailable()
        best = sorted((p not in (3, 6), -r, p) for p, c, s, r in INV if s > 0 and c == "a")[:2]
        assert result(spark, root) == {(1, at(0)): ",".join(str(p) for _, _, p in best)}
        left = sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"])
        assert 0 < left < held + 4
        dedup = [s for s in q.lastProgress["stateOperators"] if s["operatorName"] == "dedupeWithinWatermark"]
        assert dedup and dedup[0]["numRowsTotal"] == 1  # the first view's key has gone
    finally:
        q.stop()


def test_lists_of_a_view_without_stock(spark):
    inv = spark.createDataFrame([(0, "a", 0, 1)], "product_id long, category string, stock int, rating int")
    clicks, sales = spark.createDataFrame([(1, 0, at(0))], CLICK), spark.createDataFrame([(1, 0, at(0))], SALE)
    assert view_stream.view_lists(clicks, sales, inv).count() == 0


def test_an_inventory_listed_many_times_adds_no_rows(spark):
    """The lookup joins one row per product and category."""
    many = inventory(spark).crossJoin(spark.range(50)).drop("id")
    clicks = spark.createDataFrame([(1, p, at(p)) for p in range(30)], CLICK)
    recommender = rec.Recommender(clicks, spark.createDataFrame([], SALE), many)
    assert recommender.click_rows().count() == 30 and recommender.clicked().count() == 30
    assert recommender.lookup().count() == 30
