"""Sales by category: enrichment with the product dimension and windowed sums.

Spark form of the sales job: the product dimension is joined to every sale
(inner: a sale of an unknown product is dropped), the sold quantity is kept
as ``sales`` and summed per category per tumbling window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.common import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded, latest_per_key
from basketry.operators.ordered import as_of_join, trailing_sums

SALE_COLUMNS = ["invoice_id", "user_id", "product_id", "quantity", "unit_cost"]


def latest_products(products: DataFrame, order_by: list[str]) -> DataFrame:
    """Dimension upsert: per product id, the last row by ``order_by`` (the load
    order, which must be total per product) wins."""
    if not order_by:
        raise ValueError("order_by must name the load order of the rows")
    return latest_per_key(products, ["product_id"], order_by)


def _dimension(products: DataFrame, max_broadcast_rows: int | None) -> DataFrame:
    return broadcast_if_bounded(products.select("product_id", "category"), max_broadcast_rows)


def enrich_sales(
    sales: DataFrame,
    products: DataFrame,
    time_col: str = "purchase_time",
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Sales of known products with their category; quantity kept as ``sales``.

    The dimension is broadcast when its row count is proven small, so the
    sales side is never shuffled for the lookup (works for streams too:
    stream-static joins are stateless).
    """
    keep = [c for c in ("invoice_id", "user_id", "product_id") if c in sales.columns]
    if time_col in sales.columns:
        keep.append(time_col)
    dim = _dimension(products, max_broadcast_rows)
    return sales.join(dim, "product_id", "inner").select(
        *keep, "category", F.col("quantity").alias("sales")
    )


def enrich_sales_as_of(
    sales: DataFrame,
    versions: DataFrame,
    time_col: str = "purchase_time",
    valid_from: str = "valid_from",
    version_order: Sequence[str] = (),
) -> DataFrame:
    """Sales with the category their product had then: of the product's versions
    the last one at or before the sale (``operators.ordered.as_of_join``). A sale
    before its product's first version is dropped, as one of an unknown product."""
    keep = [c for c in ("invoice_id", "user_id", "product_id", time_col) if c in sales.columns]
    used = versions.select("product_id", "category", valid_from, *version_order)
    found = as_of_join(sales.select(*keep, "quantity"), used, "product_id", time_col, valid_from, version_order)
    return found.where("version is not null").select(*keep, F.col("version.category").alias("category"), F.col("quantity").alias("sales"))


def version_lists(versions: DataFrame, valid_from: str = "valid_from", version_order: Sequence[str] = ()) -> DataFrame:
    """Per product its versions as one array, oldest first: the lookup form of a
    dimension that changes seldom, for streams and for small dimensions."""
    item = F.struct(F.col(valid_from).alias("since"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(version_order)], F.col("category").alias("category"))
    rows = versions.where(F.col("product_id").isNotNull() & F.col(valid_from).isNotNull())
    return rows.groupBy("product_id").agg(F.array_sort(F.collect_list(item)).alias("versions"))


def enrich_sales_from_lists(sales: DataFrame, lists: DataFrame, time_col: str = "purchase_time") -> DataFrame:
    """``enrich_sales_as_of`` from ``version_lists``: a stateless join, also of a
    stream, where the lists are computed anew for every micro-batch."""
    keep = [c for c in ("invoice_id", "user_id", "product_id", time_col) if c in sales.columns]
    then = F.filter("versions", lambda v: v["since"] <= F.col(time_col))
    rows = sales.join(lists, "product_id").select(*keep, F.try_element_at(then, F.lit(-1)).alias("version"), "quantity")
    return rows.where("version is not null").select(*keep, F.col("version.category").alias("category"), F.col("quantity").alias("sales"))


def trailing_sales(enriched: DataFrame, time_col: str = "purchase_time", interval: str = "1 hour") -> DataFrame:
    """``category, time_col, sales``: at every instant with a sale of the category,
    the quantity sold in the ``interval`` up to it. A category of any size is
    spread over tasks by time."""
    return trailing_sums(enriched, "category", time_col, "sales", interval, "sales")


def unmatched_sales(
    sales: DataFrame,
    products: DataFrame,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Sales whose product id is not in the dimension (dropped by the join)."""
    dim = _dimension(products, max_broadcast_rows).select("product_id")
    return sales.join(dim, "product_id", "left_anti")


def sales_by_category(
    enriched: DataFrame,
    time_col: str = "purchase_time",
    window: str = "10 seconds",
    slide: str | None = None,
) -> DataFrame:
    """Sum of ``sales`` per category per window (tumbling, or sliding when
    ``slide`` is given).

    Partial sums are taken in every task before the shuffle on
    (window, category), so a dominant category costs one row per task. A sliding
    window that is a whole number of slides is summed from panes: the sales are
    summed once per slide-sized pane, and only the few pane sums are spread over
    the windows they lie in. (Otherwise, and on a stream, which takes one
    aggregation, every sale is spread over its windows.)
    """
    panes = _panes(window, slide) if slide and not enriched.isStreaming else None
    if panes:
        pane = _window_sums(enriched, F.window(time_col, slide)).withColumn("_pane", F.col("window.start"))
        sums = _window_sums(pane, F.window("_pane", window, slide))
    else:
        sums = _window_sums(enriched, F.window(time_col, window, slide) if slide else F.window(time_col, window))
    return sums.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "category", "sales"
    )


def _window_sums(df: DataFrame, window: Column) -> DataFrame:
    return df.groupBy(window.alias("window"), F.col("category")).agg(F.sum("sales").cast("bigint").alias("sales"))


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(interval: str) -> int | None:
    """Seconds of an interval like ``10 minutes``; None for other forms."""
    parts = interval.split()
    unit = parts[1].lower().rstrip("s") if len(parts) == 2 else ""
    return int(parts[0]) * _UNIT_SECONDS[unit] if unit in _UNIT_SECONDS and parts[0].isdigit() else None


def _panes(window: str, slide: str) -> int | None:
    """How many slides a window has, if it is a whole number of at least one."""
    width, step = _seconds(window), _seconds(slide)
    return width // step if width and step and width % step == 0 else None


def with_processing_time(df: DataFrame, col: str = "processing_time") -> DataFrame:
    """Stamp rows with the wall clock (per micro-batch in a stream)."""
    return df.withColumn(col, F.current_timestamp())
