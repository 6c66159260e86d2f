import datetime as dt

from basketry.operators import sales as sal
from basketry.operators.common import broadcast_if_bounded, latest_per_key

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def sales_df(spark, rows):
    return spark.createDataFrame(
        [(i, 1, p, q, 10, t) for i, (p, q, t) in enumerate(rows)],
        "invoice_id long, user_id long, product_id long, quantity long, unit_cost int, purchase_time timestamp_ntz",
    )


def products_df(spark, rows):
    return spark.createDataFrame(rows, "product_id long, category string, stock int, rating int")


def test_unknown_product_dropped_and_reported(spark):
    s = sales_df(spark, [(1, 2, ts(0)), (999, 5, ts(1))])
    p = products_df(spark, [(1, "toys", 3, 4)])
    assert [(r.category, r.sales) for r in sal.enrich_sales(s, p).collect()] == [("toys", 2)]
    assert [r.product_id for r in sal.unmatched_sales(s, p).collect()] == [999]


def test_window_edges(spark):
    s = sales_df(spark, [(1, 1, ts(0)), (1, 2, ts(9.999)), (1, 4, ts(10))])
    p = products_df(spark, [(1, "toys", 3, 4)])
    out = sal.sales_by_category(sal.enrich_sales(s, p), window="10 seconds").orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.sales) for r in out] == [
        (ts(0), ts(10), 3),
        (ts(10), ts(20), 4),
    ]


def test_single_sale_and_gap(spark):
    s = sales_df(spark, [(1, 2, ts(0)), (1, 3, ts(100))])
    p = products_df(spark, [(1, "toys", 3, 4)])
    out = sal.sales_by_category(sal.enrich_sales(s, p), window="10 seconds").collect()
    assert sorted(r.sales for r in out) == [2, 3]  # empty windows emit nothing


def test_sum_of_windows_equals_matched_quantity(spark):
    rows = [(i % 5, 1 + i % 3, ts(i * 7)) for i in range(200)]
    s = sales_df(spark, rows)
    p = products_df(spark, [(i, f"c{i % 2}", 1, 1) for i in range(4)])  # product 4 unknown
    out = sal.sales_by_category(sal.enrich_sales(s, p), window="1 minute").collect()
    assert sum(r.sales for r in out) == sum(q for pid, q, _ in rows if pid < 4)


def test_sliding_windows_count_each_sale_per_window(spark):
    s = sales_df(spark, [(1, 1, ts(30))])
    p = products_df(spark, [(1, "toys", 3, 4)])
    out = sal.sales_by_category(sal.enrich_sales(s, p), window="1 minute", slide="20 seconds").collect()
    assert len(out) == 3 and all(r.sales == 1 for r in out)


def test_dimension_latest_row_wins(spark):
    p = spark.createDataFrame([(5, "a", 1, 1, 0), (5, "b", 1, 1, 1)], "product_id long, category string, stock int, rating int, seq long")
    latest = sal.latest_products(p, ["seq"]).drop("seq")
    s = sales_df(spark, [(5, 2, ts(0)), (5, 3, ts(1))])
    out = sal.sales_by_category(sal.enrich_sales(s, latest), window="1 minute").collect()
    assert [(r.category, r.sales) for r in out] == [("b", 5)]


def test_latest_per_key_tie_breaks_on_later_columns(spark):
    df = spark.createDataFrame([(1, "x", 5, 1), (1, "y", 5, 2), (2, "z", 1, 1)], "k long, v string, t long, b long")
    out = {r.k: r.v for r in latest_per_key(df, ["k"], ["t", "b"]).collect()}
    assert out == {1: "y", 2: "z"}


def test_latest_products_needs_an_order(spark):
    import pytest

    with pytest.raises(ValueError):
        sal.latest_products(products_df(spark, [(5, "a", 1, 1)]), [])


def test_panes_equal_plain_sliding_windows(spark, capsys):
    from pyspark.sql import functions as F

    s = sales_df(spark, [(i % 5, 1 + i % 3, ts(i * 37)) for i in range(300)])
    enriched = sal.enrich_sales(s, products_df(spark, [(i, f"c{i % 2}", 1, 1) for i in range(4)]))
    got = sal.sales_by_category(enriched, window="10 minutes", slide="2 minutes")
    plain = enriched.groupBy(F.window("purchase_time", "10 minutes", "2 minutes").alias("w"), "category").agg(F.sum("sales").alias("s"))
    assert sorted(map(tuple, got.collect())) == sorted((r.w.start, r.w.end, r.category, r.s) for r in plain.collect())
    # no row is spread over windows before the first sum
    capsys.readouterr()
    got.explain()
    plan = capsys.readouterr().out
    assert "Expand" in plan and "Expand" not in plan[plan.rindex("partial_sum") :]
    # a window that is no whole number of slides is spread directly
    odd = sal.sales_by_category(enriched, window="5 minutes", slide="2 minutes").agg(F.sum("sales")).first()[0]
    want = enriched.groupBy(F.window("purchase_time", "5 minutes", "2 minutes")).agg(F.sum("sales").alias("s")).agg(F.sum("s")).first()[0]
    assert odd == want


def test_broadcast_bound_counts_bytes_too(spark, capsys):
    from basketry.operators.common import fits_broadcast

    df = spark.createDataFrame([("x" * 1000,)] * 50, "s string")
    assert fits_broadcast(df, 50) and not fits_broadcast(df, 49)
    assert fits_broadcast(df, 50, 50_000) and not fits_broadcast(df, 50, 49_999)


def test_broadcast_only_below_bound(spark):
    df = spark.range(100)
    small = broadcast_if_bounded(df, 1000)
    big = broadcast_if_bounded(df, 10)
    assert small is not df and big is df
