"""Streaming recommendations: keyed, always-current lists per user.

One query over both topics:

1. decode the messages, look up categories (stream-static join), cut each task's
   rows to what the ranking can use (the k earliest views and the k best bought
   products per user and category), so that a hot user sends few rows;
2. per user, Spark's state store (RocksDB) keeps, for each of the user's
   categories, the k earliest views and the k best in-stock products bought. That
   is all the per-user ranking reads (see ``operators.recommend``), and
   ``top-k(old + new) = top-k(top-k(old) + new)``, so merging is exact; the state
   is bounded by 2k rows per user and category, however long the stream runs.
   A user whose state changes sends all of it on;
3. ``foreachBatch`` ranks the changed users with the batch operators and adds
   their complete current lists to the keyed output (``sinks.upserts``).

The state belongs to the query's checkpoint: a restart goes on from it, a batch
that is run again starts from the same version. Stream result = batch result on
the same rows (checked in the tests).

Both topics carry a watermark when ``lateness`` is given; the slower of them holds
it (Spark's ``min`` policy). Clicks behind it are not ranked: they go to a table
of late rows and none is lost. A purchase is never late, as "bought" is not tied
to a time. With a refreshed inventory the categories are looked up after the
state, which then holds views and purchases by product.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from basketry import schemas
from basketry.functions import encode, parse
from basketry.operators import recommend as rec
from basketry.operators.common import DEFAULT_MAX_BROADCAST_ROWS, fits_broadcast
from basketry.session import path_exists, read_file, scratch_path, ship_package, write_file
from basketry.streaming import committed, sinks

_DIMENSION = ["product_id", "category", "stock", "rating"]
_STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# a row of the reduced state: a view (``at``) or a purchase of the group, which is
# the category (the product, if the inventory is refreshed). Values as text, and
# the rating also as the number it is compared by.
_ROW = "user_id string, kind string, grp string, at long, product_id string, stock string, rating string, rated double"
_ITEM = ["product_id", "stock", "rating", "rated"]
_NAMES = ["kind", "grp", "at", *_ITEM]


class SettingsMismatch(ValueError):
    """The checkpoint's state was built with other settings."""


class Reducer:
    """Keeps per group the k earliest view times and the k best products bought.

    Products are ordered as in ``operators.recommend``: rating from high to low
    (by its number, or its text with ``by_text``), none last, then product and
    stock. ``whole`` names the columns that compare as integers. ``k_bought`` None
    keeps every product.
    """

    def __init__(self, k: int, k_bought: int | None, by_text: bool, whole: set[str]):
        self.k, self.k_bought, self.by_text, self.whole = k, k_bought, by_text, whole

    def views(self, times: set[int]) -> list[int]:
        return sorted(times)[: self.k]

    def bought(self, items: set[tuple]) -> list[tuple]:
        def place(item: tuple) -> tuple:
            typed = (int(x) if x is not None and n in self.whole else x for n, x in zip(_ITEM[:2], item))
            return tuple((x is not None, x if x is not None else 0) for x in typed)

        rated: dict = {}
        for item in items:
            rated.setdefault(item[2 if self.by_text else 3], []).append(item)
        best = sorted((r for r in rated if r is not None), reverse=True) + [r for r in rated if r is None]
        return [item for r in best for item in sorted(rated[r], key=place)][: self.k_bought]

    def merge(self, state: dict, rows: pd.DataFrame) -> dict:
        """``state``: group -> (times, items), with the rows merged in."""
        for row in zip(*(rows[n].tolist() for n in _NAMES)):
            self._add(state, *row)
        return self._kept(state)

    def _add(self, state: dict, kind: str, grp: str | None, at: int | None, *item) -> None:
        grp, *item = (None if x is None or x != x else x for x in (grp, *item))
        times, items = state.setdefault(grp, (set(), set()))
        if kind == "view":
            times.add(int(at))
        else:
            items.add(tuple(item))

    def _kept(self, state: dict) -> dict:
        few = lambda items: self.k_bought is None or len(items) <= self.k_bought
        return {g: (t if len(t) <= self.k else set(self.views(t)), i if few(i) else set(self.bought(i))) for g, (t, i) in state.items()}

    def rows(self, states: dict) -> pd.DataFrame:
        """``states``: user -> state, as rows in one frame."""
        out = []
        for user, state in states.items():
            for g, (times, items) in state.items():
                out += [(user, "view", g, t, None, None, None, None) for t in sorted(times)]
                out += [(user, "bought", g, None, *i) for i in sorted(items, key=str)]
        columns = dict(zip(["user_id", *_NAMES], zip(*out) if out else [()] * (1 + len(_NAMES))))
        kinds = {"at": "Int64", "rated": "float64"}
        return pd.DataFrame({n: pd.array(list(v), dtype=kinds[n]) if n in kinds else np.array(v, object) for n, v in columns.items()})

    def dump(self, state: dict) -> str:
        return json.dumps([[g, sorted(t), sorted(map(list, i), key=str)] for g, (t, i) in state.items()])

    def load(self, text: str) -> dict:
        return {g: (set(t), {tuple(x) for x in i}) for g, t, i in json.loads(text)}

    # --- the functions that Spark calls ---------------------------------------
    def cut(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each batch of rows cut per user and group: what its k earliest views and
        k best products leave out can never enter the state. A batch holds few rows
        of each of many users, so it is one frame in and one out."""
        for rows in batches:
            users: dict = {}
            for user, *row in zip(*(rows[n].tolist() for n in ["user_id", *_NAMES])):
                self._add(users.setdefault(user if user == user else None, {}), *row)
            if users:
                yield self.rows({user: self._kept(state) for user, state in users.items()})

    def update(self, key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Merge a user's rows into the state; if it changes, give all of it. Clicks
        behind the watermark are given as ``late`` and change nothing."""
        before = state.get[0] if state.exists else None
        held = self.load(before) if before else {}
        for rows in batches:
            if "event_time" in rows:
                watermark = state.getCurrentWatermarkMs() * 1000
                late = (rows["kind"] == "view") & (rows["at"] < watermark)
                if late.any():
                    yield rows[late].assign(user_id=key[0], kind="late")[["user_id", *_NAMES]]
                rows = rows[~late]
            held = self.merge(held, rows)
        after = self.dump(held)
        if held and after != before:
            state.update((after,))
            yield self.rows({key[0]: held})


class RecommendationStream:
    """The query, its settings and its keyed output."""

    def __init__(
        self,
        spark: SparkSession,
        root: str | None,
        inventory: DataFrame | Callable[[], DataFrame],
        k: int = rec.DEFAULT_K,
        window: str = "5 seconds",
        rating_order: str = "numeric",
        max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
        outputs: tuple[sinks.BatchSink, ...] = (),
        repeat: bool = True,
        on_error: str = "fail",
        lateness: float | None = None,
    ) -> None:
        """``inventory``: a frame, read once at the start, or a function that is
        called for every batch (the batch then uses one snapshot throughout;
        users it does not touch keep their lists until they are touched).
        ``repeat=False``: each product once per user, at the first view of its
        category (the state keeps the earliest views, so this is exact here too).
        ``outputs``: further sinks for each refresh's keyed records (``key`` =
        user id, ``value`` = ``user_id,"p1,...",event_time``), e.g.
        ``sinks.kafka`` for a compacted topic. ``on_error``: a malformed click or
        sale line stops the stream (``fail``) or is left out (``drop``); either
        way the observed metrics ``click_lines`` and ``sale_lines`` count lines,
        empty and malformed ones. ``lateness``: clicks more than so many seconds
        behind the newest rows of both topics go to the late table."""
        if rating_order not in rec.RATING_ORDERS:
            raise ValueError(f"rating_order must be one of {rec.RATING_ORDERS}, not {rating_order!r}")
        self.spark = spark
        self.outputs = tuple(outputs)
        self.root = root or scratch_path(spark, "recommendations")
        self.log = os.path.join(self.root, "recommendations")
        self.late_log = os.path.join(self.root, "late-clicks")
        self.k = k
        self.window = window
        self.rating_order = rating_order
        self.repeat = repeat
        self.max_broadcast_rows = max_broadcast_rows
        self.on_error = on_error
        self.lateness = lateness
        self.refreshed = callable(inventory)
        self._read_inventory = inventory if self.refreshed else lambda: inventory
        first = self._read_inventory().select(*_DIMENSION)
        self.types = {f.name: f.dataType for f in first.schema.fields}
        self._digest = "read for every batch" if self.refreshed else _digest(first)
        self._fixed = None if self.refreshed else self._snapshot()

    # --- inventory ---------------------------------------------------------
    def _snapshot(self) -> dict:
        """The inventory as it is now, with its category lists, written under the
        root: its size cannot change after it has been checked, and all steps of
        a batch see the same rows."""
        folder = os.path.join(self.root, "inventory", uuid.uuid4().hex)
        self._read_inventory().select(*_DIMENSION).write.parquet(os.path.join(folder, "rows"))
        rows = self.spark.read.parquet(os.path.join(folder, "rows"))
        small = self.max_broadcast_rows is not None and fits_broadcast(rows, self.max_broadcast_rows)
        lists = os.path.join(folder, "category_top")
        rec.category_lists(rec.category_top(rows, self.k, self.rating_order)).write.parquet(lists)
        top = self.spark.read.parquet(lists)
        return {"rows": F.broadcast(rows) if small else rows, "small": small, "top": F.broadcast(top) if small else top}

    # --- the stream up to the state ------------------------------------------
    def _reducer(self) -> Reducer:
        whole = {n for n in ("product_id", "stock") if isinstance(self.types[n], T.IntegralType)}
        return Reducer(self.k, None if self.refreshed else self.k, self.rating_order == "string", whole)

    def _rows(self, kind: str, grp: Column, at: Column | None, product: bool) -> list[Column]:
        item = [F.col(n).cast("string") if product else F.lit(None).cast("string") for n in _ITEM[:3]]
        rated = F.col("rating").try_cast("double") if product else F.lit(None).cast("double")
        item.append(F.when(F.isnan(rated), F.lit(float("inf"))).otherwise(rated))  # as in Spark's order
        at = F.unix_micros(at) if at is not None else F.lit(None).cast("long")
        columns = [F.lit(kind), grp.cast("string"), at, *item]
        return [F.col("user_id").cast("string").alias("user_id"), *(c.alias(n) for n, c in zip(_NAMES, columns))]

    def reduced(self, click_messages: DataFrame, sale_messages: DataFrame) -> DataFrame:
        """Both topics as rows for the state, cut in the tasks that read them."""
        product = F.col("product_id").try_cast(self.types["product_id"])
        clicks = parse.decode_clicks(click_messages, on_error=self.on_error, keep=["timestamp"], observe="click_lines")
        sales = parse.decode_sales(sale_messages, on_error=self.on_error, keep=["timestamp"], observe="sale_lines")
        clicks, sales = (df.withColumn("product_id", product).where("product_id is not null") for df in (clicks, sales))
        if self.refreshed:
            views = clicks.select(*self._rows("view", F.col("product_id"), F.col("timestamp"), False), "timestamp")
            bought = sales.select(*self._rows("bought", F.col("product_id"), None, False), "timestamp")
        else:
            known = self._fixed["rows"].select("product_id", "category").distinct()
            views = clicks.join(known, "product_id").select(*self._rows("view", F.col("category"), F.col("timestamp"), False), "timestamp")
            stocked = rec.stocked(self._fixed["rows"])
            bought = sales.join(stocked, "product_id").select(*self._rows("bought", F.col("category"), None, True), "timestamp")
        reducer = self._reducer()
        if self.lateness is None:
            both = views.drop("timestamp").unionByName(bought.drop("timestamp"))
            return both.mapInPandas(reducer.cut, _ROW)
        # what is late is known only where the state is, so no view may be cut before
        delay = f"{self.lateness} seconds"
        late = lambda df: df.withColumnRenamed("timestamp", "event_time").withWatermark("event_time", delay)
        return late(views).unionByName(late(bought))

    def changed(self, click_messages: DataFrame, sale_messages: DataFrame) -> DataFrame:
        """The reduced state of every user whose state changes, and late clicks."""
        rows = self.reduced(click_messages, sale_messages)
        return rows.groupBy("user_id").applyInPandasWithState(
            self._reducer().update, _ROW, "body string", "update", GroupStateTimeout.NoTimeout
        )

    # --- the micro-batch ---------------------------------------------------
    def on_batch(self, changed: DataFrame, batch_id: int) -> None:
        """Rank the changed users and add their lists to the outputs."""
        changed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.lateness is not None:
                late = changed.where("kind = 'late'").select("user_id", F.col("grp").alias("category"), F.timestamp_micros("at").alias("event_time"))
                committed.write_batch(late, self.late_log, batch_id)
            if not changed.where("kind <> 'late'").isEmpty():
                self._refresh(changed, batch_id)
        finally:
            changed.unpersist()

    def _typed(self, name: str, source: str | None = None) -> Column:
        return F.col(source or name).cast(self.types[name]).alias(name)

    def _refresh(self, changed: DataFrame, batch_id: int) -> None:
        snapshot = self._fixed or self._snapshot()
        views, bought = (changed.where(F.col("kind") == kind) for kind in ("view", "bought"))
        at = F.timestamp_micros("at").alias("event_time")
        if self.refreshed:
            known = snapshot["rows"].select("product_id", "category").distinct()
            views = views.select("user_id", self._typed("product_id", "grp"), at).join(known, "product_id")
            views = views.select("user_id", "event_time", "category").distinct()
            bought = bought.select("user_id", self._typed("product_id", "grp"))
            bought = rec.bought_products(bought, snapshot["rows"], None, prefilter=snapshot["small"])
        else:
            views = views.select("user_id", at, self._typed("category", "grp"))
            bought = bought.select("user_id", self._typed("product_id"), self._typed("category", "grp"), self._typed("stock"), self._typed("rating"))
        recommender = rec.Recommender.from_reduced(
            views, rec.bought_top(bought, self.k, self.rating_order), snapshot["rows"], self.k, self.rating_order, None, snapshot["top"]
        )
        lists = recommender.recommend("user", self.window, self.repeat)
        lists = lists.persist(StorageLevel.MEMORY_AND_DISK) if self.outputs else lists
        try:
            committed.write_batch(lists, self.log, batch_id)
            for sink in self.outputs:
                sink(lists.select(encode.recommendation_key().alias("key"), encode.recommendation_value().alias("value")), batch_id)
        finally:
            if self.outputs:
                lists.unpersist()

    def latest(self) -> DataFrame:
        """One current row per user."""
        return sinks.upserts(self.spark, self.log, schemas.RECOMMENDATION, ["user_id"], ["event_time"])

    def late_clicks(self) -> DataFrame:
        """Clicks left out as late: ``user_id, category, event_time``."""
        columns = f"user_id string, category {'string' if self.refreshed else self.types['category'].simpleString()}, event_time timestamp"
        return committed.read(self.spark, self.late_log, columns).drop(committed.RUN, committed.BATCH)

    # --- running -------------------------------------------------------------
    def _check_settings(self, checkpoint: str) -> None:
        """The settings the state depends on lie beside it; other ones are refused."""
        own = {"k": self.k, "rating_order": self.rating_order, "inventory": self._digest}
        path = os.path.join(checkpoint, "recommendation-settings.json")
        if not path_exists(self.spark, path):
            write_file(self.spark, path, json.dumps(own))
        elif (there := json.loads(read_file(self.spark, path))) != own:
            raise SettingsMismatch(f"the state in {checkpoint} was built with {there}, not {own}")

    def start(
        self,
        click_messages: DataFrame,
        sale_messages: DataFrame,
        checkpoint_path: str | None = None,
        trigger: dict | None = None,
        query_name: str = "recommendations",
    ) -> StreamingQuery:
        """Start the query over both topics (``value, timestamp`` rows each)."""
        checkpoint = checkpoint_path or os.path.join(self.root, "checkpoints", query_name)
        self._check_settings(checkpoint)
        ship_package(self.spark)
        writer = (
            self.changed(click_messages, sale_messages).writeStream.queryName(query_name)
            .outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(self.on_batch)
        )
        writer = writer.trigger(**trigger) if trigger else writer
        # a query keeps the settings its session has when it starts
        before = self.spark.conf.get(_STORE_SETTING, None)
        self.spark.conf.set(_STORE_SETTING, _STATE_STORE)
        try:
            return writer.start()
        finally:
            self.spark.conf.unset(_STORE_SETTING) if before is None else self.spark.conf.set(_STORE_SETTING, before)


def _digest(inventory: DataFrame) -> str:
    """The same for the same rows in any order."""
    row = inventory.select(F.xxhash64(*_DIMENSION).cast("decimal(38,0)").alias("h"))
    found = row.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).first()
    return f"{found.n} rows, {found.h}"


def main(argv: list[str] | None = None) -> None:
    """Start the recommendation stream from the command line and block.

    Sources: ``--kafka SERVERS`` with ``--clicks-topic``/``--sales-topic``, or
    ``--clicks DIR --sales DIR`` (files of ``value, timestamp`` rows).
    Inventory: a CSV file (bad rows skipped), read once, or for every batch
    with ``--refresh-inventory``. Output and checkpoints go under ``--root``
    (default: the shared checkpoint folder).
    """
    import argparse

    from basketry.session import build_session
    from basketry.sources import files

    ap = argparse.ArgumentParser(description="streaming recommendations")
    ap.add_argument("--kafka", help="bootstrap servers")
    ap.add_argument("--clicks-topic", default="click.streams")
    ap.add_argument("--sales-topic", default="sales.records")
    ap.add_argument("--clicks", help="folder of click value,timestamp parquet files")
    ap.add_argument("--sales", help="folder of sale value,timestamp parquet files")
    ap.add_argument("--inventory", required=True)
    ap.add_argument("--root", default=None)
    ap.add_argument("--k", type=int, default=rec.DEFAULT_K)
    ap.add_argument("--window", default="5 seconds")
    ap.add_argument("--rating-order", default="numeric", choices=rec.RATING_ORDERS)
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--kafka-out-topic", default=None, help="also send keyed CSV records to this (compacted) topic")
    ap.add_argument("--no-repeat", action="store_true",
                    help="suggest each product once per user, at the first view of its category")
    ap.add_argument("--on-error", default="fail", choices=("fail", "drop"),
                    help="malformed click and sale lines: stop, or leave out and count")
    ap.add_argument("--lateness", type=float, default=None,
                    help="clicks more than so many seconds behind both topics go to the late table")
    ap.add_argument("--refresh-inventory", action="store_true", help="read the inventory anew for every batch")
    args = ap.parse_args(argv)
    if not args.kafka and not (args.clicks and args.sales):
        ap.error("give --kafka or both --clicks and --sales")
    spark = build_session(app_name="recommendations")
    if args.kafka:
        clicks = files.kafka_stream(spark, args.kafka, args.clicks_topic)
        sales = files.kafka_stream(spark, args.kafka, args.sales_topic)
    else:
        clicks = files.message_file_stream(spark, args.clicks)
        sales = files.message_file_stream(spark, args.sales)
    read_inventory = lambda: files.csv_table(spark, args.inventory, schemas.INVENTORY, on_error="drop")
    inventory = read_inventory if args.refresh_inventory else read_inventory()
    outputs = (sinks.kafka(args.kafka, args.kafka_out_topic),) if args.kafka_out_topic else ()
    job = RecommendationStream(spark, args.root, inventory, args.k, args.window, args.rating_order, outputs=outputs,
                               repeat=not args.no_repeat, on_error=args.on_error, lateness=args.lateness)
    trigger = {"availableNow": True} if args.available_now else None
    job.start(clicks, sales, trigger=trigger).awaitTermination()


if __name__ == "__main__":
    main()
