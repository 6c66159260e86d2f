"""The command-line entry points, run in-process on small inputs."""

import datetime as dt
import os
import tempfile

from basketry.streaming import recommend_stream, sales_stream
from basketry import schemas
from basketry.streaming import sinks

T0 = dt.datetime(2024, 1, 1)
MSG = "value string, timestamp timestamp"


def test_sales_stream_cli(spark):
    root = tempfile.mkdtemp(prefix="basketry-cli-")
    products = os.path.join(root, "products.csv")
    with open(products, "w") as fh:
        fh.write("1,toys,5,3\n")
    rows = [("1,7,1,2,10", T0), ("2,7,1,3,10", T0 + dt.timedelta(seconds=1)),
            ("-1,-1,-1,1,1", T0 + dt.timedelta(days=1))]
    spark.createDataFrame(rows, MSG).coalesce(1).write.parquet(os.path.join(root, "in"))
    spark.createDataFrame([("-1,-1,-1,1,1", T0 + dt.timedelta(days=2))], MSG).write.mode("append").parquet(
        os.path.join(root, "in"))
    sales_stream.main(["--messages", os.path.join(root, "in"), "--products", products, "--out",
                       os.path.join(root, "out"), "--checkpoint", os.path.join(root, "ckpt"),
                       "--print-rows", "0", "--available-now"])
    got = [r.value for r in sinks.messages(spark, os.path.join(root, "out")).collect()]
    assert got == ['{"category":"toys","sales":5}']


def test_recommend_stream_cli(spark):
    root = tempfile.mkdtemp(prefix="basketry-cli-")
    inventory = os.path.join(root, "inventory.csv")
    with open(inventory, "w") as fh:
        fh.write("1,a,5,3\n2,a,5,9\nx,a\n")
    spark.createDataFrame([("7,1", T0 + dt.timedelta(seconds=1))], MSG).write.parquet(os.path.join(root, "clicks"))
    spark.createDataFrame([("1,7,1,1,1", T0)], MSG).write.parquet(os.path.join(root, "sales"))
    state = os.path.join(root, "state")
    recommend_stream.main(["--clicks", os.path.join(root, "clicks"), "--sales", os.path.join(root, "sales"),
                           "--inventory", inventory, "--root", state, "--available-now"])
    latest = sinks.upserts(spark, os.path.join(state, "recommendations"), schemas.RECOMMENDATION, ["user_id"], ["event_time"])
    assert [(r.user_id, r.top_product_ids) for r in latest.collect()] == [("7", "1,2")]
