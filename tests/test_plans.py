"""End-to-end batch jobs over raw files (text / CSV / message parquet)."""

import datetime as dt
import json
import os
import tempfile

import pytest

from basketry.plans import recommend_job, sales_job

T0 = dt.datetime(2024, 1, 1)
MSG = "value string, timestamp timestamp"


def scratch():
    return tempfile.mkdtemp(prefix="basketry-plan-")


def test_sales_job_files(spark):
    root = scratch()
    products = os.path.join(root, "products.csv")
    with open(products, "w") as fh:
        fh.write("1,toys,5,3\n2,games,7,8\n1,games,5,3\n")  # product 1 moves to games
    sales = [("1,7,1,2,10", T0), ("2,7,2,3,10", T0 + dt.timedelta(seconds=1)), ("3,7,9,1,1", T0)]
    spark.createDataFrame(sales, MSG).coalesce(1).write.parquet(os.path.join(root, "sales"))
    sales_job.run(spark, os.path.join(root, "sales"), products, os.path.join(root, "out"), window="1 minute")
    got = [r.value for r in spark.read.text(os.path.join(root, "out", "messages")).collect()]
    assert got == ['{"category":"games","sales":5}']


def test_recommend_job_files(spark):
    root = scratch()
    inventory = os.path.join(root, "inventory.csv")
    with open(inventory, "w") as fh:
        fh.write("1,a,5,3\n2,a,0,9\n3,a,4,7\nbad,a,x,1\n4,b,1,1\n")
    clicks = [("7,1", T0 + dt.timedelta(seconds=1)), ("7,4", T0 + dt.timedelta(seconds=8))]
    sales = [("1,7,1,1,1", T0)]
    spark.createDataFrame(clicks, MSG).write.parquet(os.path.join(root, "clicks"))
    spark.createDataFrame(sales, MSG).write.parquet(os.path.join(root, "sales"))
    out = os.path.join(root, "out")
    recommend_job.run(spark, os.path.join(root, "clicks"), os.path.join(root, "sales"), inventory, out)
    records = sorted((r.key, r.value) for r in spark.read.parquet(os.path.join(out, "records")).collect())
    assert records == [
        ("7", '7,"1,3",2024-01-01 00:00:05.000'),
        ("7", "7,4,2024-01-01 00:00:10.000"),
    ]
    latest = [(r.key, r.value) for r in spark.read.parquet(os.path.join(out, "latest")).collect()]
    assert latest == [("7", "7,4,2024-01-01 00:00:10.000")]


def test_recommend_job_takes_text_ids_and_unparsed_costs(spark, capsys):
    root = scratch()
    inventory = os.path.join(root, "inventory.csv")
    with open(inventory, "w") as fh:
        fh.write("p1,a,5,3\np2,a,9,9\nshort,a\n")
    spark.createDataFrame([("u7,p1", T0 + dt.timedelta(seconds=1)), ("no comma", T0)], MSG).write.parquet(os.path.join(root, "clicks"))
    spark.createDataFrame([("i1,u7,p1,1,9.99", T0), ("a,b", T0)], MSG).write.parquet(os.path.join(root, "sales"))
    args = ["--clicks", os.path.join(root, "clicks"), "--sales", os.path.join(root, "sales"), "--inventory", inventory]
    with pytest.raises(Exception, match="malformed"):
        recommend_job.main([*args, "--out", os.path.join(root, "fail")])
    capsys.readouterr()
    recommend_job.main([*args, "--out", os.path.join(root, "out"), "--on-error", "drop"])
    assert json.loads(capsys.readouterr().out) == {"malformed_lines_left_out": {"inventory": 1, "clicks": 1, "sales": 1}}
    records = [(r.key, r.value) for r in spark.read.parquet(os.path.join(root, "out", "records")).collect()]
    assert records == [("u7", 'u7,"p1,p2",2024-01-01 00:00:05.000')]


def test_sales_job_counts_what_it_leaves_out(spark, capsys):
    root = scratch()
    products = os.path.join(root, "products.csv")
    with open(products, "w") as fh:
        fh.write("1,toys,5,3\nbad\n")
    spark.createDataFrame([("1,7,1,2,10", T0), ("1,7,1,2,x", T0)], MSG).write.parquet(os.path.join(root, "sales"))
    sales_job.main(["--sales", os.path.join(root, "sales"), "--products", products, "--out", os.path.join(root, "out"), "--on-error", "drop"])
    assert json.loads(capsys.readouterr().out) == {"malformed_lines_left_out": {"sales": 1, "products": 1}}
    assert [r.sales for r in spark.read.parquet(os.path.join(root, "out", "sums")).collect()] == [2]


def test_recommend_job_no_repeat_cli(spark):
    root = scratch()
    inventory = os.path.join(root, "inventory.csv")
    with open(inventory, "w") as fh:
        fh.write("1,a,5,3\n3,a,4,7\n")
    clicks = [("7,1", T0 + dt.timedelta(seconds=1)), ("7,3", T0 + dt.timedelta(seconds=8))]
    spark.createDataFrame(clicks, MSG).write.parquet(os.path.join(root, "clicks"))
    spark.createDataFrame([("1,8,1,1,1", T0)], MSG).write.parquet(os.path.join(root, "sales"))
    args = ["--clicks", os.path.join(root, "clicks"), "--sales", os.path.join(root, "sales"),
            "--inventory", inventory]
    recommend_job.main(args + ["--out", os.path.join(root, "literal")])
    recommend_job.main(args + ["--out", os.path.join(root, "once"), "--no-repeat"])

    def records(name):
        return sorted(r.value for r in spark.read.parquet(os.path.join(root, name, "records")).collect())

    # literal: both products again for the second view; no repeat: once, at the first view
    assert records("literal") == ['7,"3,1",2024-01-01 00:00:05.000', '7,"3,1",2024-01-01 00:00:10.000']
    assert records("once") == ['7,"3,1",2024-01-01 00:00:05.000']


def test_products_later_line_wins_across_files_and_splits(spark):
    from basketry.plans import sales_job
    from basketry.sources import files

    d = os.path.join(scratch(), "products")
    os.makedirs(d)
    with open(os.path.join(d, "a.txt"), "w") as fh:
        fh.write("1,early,5,3\n")
    with open(os.path.join(d, "b.txt"), "w") as fh:
        fh.write("2,first,5,1\n" + "".join(f"{i},c,5,1\n" for i in range(3, 40)) + "1,late,5,3\n2,second,5,1\n")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    saved = {k: spark.conf.get(k) for k in keys}
    # tiny splits: Spark packs them largest first, so the small earlier file
    # lands in a later partition than the lines of the large later file
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = files.text_lines(spark, d)
        assert lines.rdd.getNumPartitions() > 2
        got = {r.product_id: r.category for r in sales_job.products_from_lines(lines).collect()}
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert got[1] == "late" and got[2] == "second" and len(got) == 39
