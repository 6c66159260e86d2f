"""The physical plans keep the properties the design relies on at scale."""

import re
import random

import pytest

import __spark_entry__ as entry
from basketry.plans import catalog
from tests.test_recommend import brute, frames, rows
from basketry.operators import recommend as rec
from basketry.sources import testdata as td

SF = "/root/testdata/sf0.001"


def plan_text(df, capsys):
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_size_proof_counts_per_task(spark, capsys):
    """The proof is a plain count, summed per task: no rows reach one task."""
    capsys.readouterr()
    td.inventory(spark, SF).groupBy().count().explain()
    plan = capsys.readouterr().out
    assert "partial_count" in plan and "ReadSchema: struct<>" in plan and "Limit" not in plan


def test_per_view_lists_move_one_row_per_view(spark, capsys):
    plan = plan_text(entry.queries()["recommend_per_view"](spark, SF), capsys)
    # the lists are merged as arrays: no candidate rows are made on the way
    assert "flatten(" in plan and "Generate" not in plan.split("Scan parquet")[0]


@pytest.mark.parametrize("name", ["recommend_user_rank", "recommend_per_view", "topk_per_user", "recommend_unseen"])
def test_recommend_plan(spark, capsys, name):
    plan = plan_text(entry.queries()[name](spark, SF), capsys)
    # every top-k is cut per map task before its shuffle
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan
    # no all-pairs operator anywhere
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    # filters and column pruning reach the scans
    assert "EqualTo(event_type,click)" in plan and "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan
    # the dimension lookups are broadcast
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", ["recommend_user_rank", "recommend_unseen"])
def test_user_scope_never_shuffles_all_views(spark, capsys, name):
    plan = plan_text(entry.queries()[name](spark, SF), capsys)
    # the k earliest views are cut per map task (dense_rank) before the only
    # shuffle of the clicks; no exchange carries every view
    assert "dense_rank(event_time" in plan
    assert not re.search(r"hashpartitioning\(user_id#\w+, event_time#\w+, category#\w+", plan)


def test_purchases_filtered_by_broadcast_semi_join(spark, capsys):
    plan = plan_text(entry.queries()["recommend_user_rank_bulk"](spark, SF), capsys)
    # unknown and out-of-stock products leave before the purchases shuffle;
    # the semi-join is broadcast, never a shuffle of every purchase
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert not re.search(r"SortMergeJoin (\[[^\]]*\], ){2}LeftSemi", plan)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_all_pairs_operator_in_any_registered_query(spark, capsys, name):
    plan = plan_text(entry.queries()[name](spark, SF), capsys)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_sales_plan_aggregates_before_shuffle(spark, capsys):
    plan = plan_text(entry.queries()["sales_by_category_10s"](spark, SF), capsys)
    assert "partial_sum" in plan and "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,props:string>" in plan


def test_skewed_fixture_matches_brute_force(spark):
    """One user with a third of the clicks, one category with a third of the
    products, one product bought by everyone many times."""
    rnd = random.Random(5)
    inv = [(p, "hot" if p % 3 == 0 else f"c{p % 5}", str(rnd.randrange(4)), rnd.randrange(1, 9)) for p in range(60)]
    clicks = []
    for i in range(150):
        user = 0 if i % 3 == 0 else rnd.randrange(1, 8)
        product = rnd.choice([p for p in range(60) if p % 3 == 0]) if i % 2 else rnd.randrange(60)
        clicks.append((user, product, __import__("datetime").datetime(2024, 1, 1, 0, 0, rnd.randrange(60))))
    sales = [(rnd.randrange(8), 3) for _ in range(40)] + [(rnd.randrange(8), rnd.randrange(60)) for _ in range(40)]
    clk, sal, inv_df = frames(spark, inv, clicks, sales)
    for scope in ("user", "view"):
        got = rec.Recommender(clk, sal, inv_df).ranked(scope)
        assert rows(got) == rows(brute(spark, clk, sal, inv_df, scope))


def test_hot_pair_is_split_by_aqe(spark, capsys):
    """One (user, category) with most of the views: with broadcasts off, the
    per-view join is a sort-merge join whose hot partition AQE splits."""
    import datetime as dt

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        inv = [(p, f"c{p % 4}", "5", p % 9) for p in range(40)]
        t0 = dt.datetime(2024, 1, 1)
        clicks = [(0, 0, t0 + dt.timedelta(seconds=i)) for i in range(3000)]  # hot pair (0, c0)
        clicks += [(u, p, t0 + dt.timedelta(seconds=u * 7 + p)) for u in range(1, 30) for p in range(1, 40, 9)]
        sales = [(0, 4), (0, 8), (3, 1)]
        clk, sal, inv_df = frames(spark, inv, clicks, sales)
        r = rec.Recommender(clk, sal, inv_df, max_broadcast_rows=None)
        got = r.ranked("view")
        cols = ["user_id", "event_time", "product_id", "purchased", "rn"]
        result = sorted(tuple(row[c] for c in cols) for row in got.collect())
        plan = plan_text(got, capsys)  # the final adaptive plan of that run
        assert "isFinalPlan=true" in plan and "skew=true" in plan
        assert result == rows(brute(spark, clk, sal, inv_df, "view"))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_product_in_unbroadcast_enrichment_is_split(spark, capsys):
    """A product with most of the sales, dimension not broadcast: the
    enrichment join's hot partition is split by AQE, sums unchanged."""
    import datetime as dt

    from basketry.operators import sales as sal

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        t0 = dt.datetime(2024, 1, 1)
        rows_ = [(i, 1, 1 if i % 3 else i % 50, 1 + i % 3, 10, t0 + dt.timedelta(seconds=i)) for i in range(6000)]
        sales_df = spark.createDataFrame(
            rows_, "invoice_id long, user_id long, product_id long, quantity long, unit_cost int, "
            "purchase_time timestamp_ntz")
        products = spark.createDataFrame([(p, f"c{p % 5}", 1, 1) for p in range(50)],
                                         "product_id long, category string, stock int, rating int")
        enriched = sal.enrich_sales(sales_df, products, max_broadcast_rows=None)
        total = enriched.groupBy("category").agg({"sales": "sum"})
        got = {r[0]: r[1] for r in total.collect()}
        plan = plan_text(total, capsys)
        assert "skew=true" in plan
        want = {}
        for _, _, p, q, _, _ in rows_:
            want[f"c{p % 5}"] = want.get(f"c{p % 5}", 0) + q
        assert got == want
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
