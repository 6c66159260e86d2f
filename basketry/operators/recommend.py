"""Recommendations: the k best in-stock products of the clicked categories.

Semantics (the recommendation job, made deterministic):

* a *view* is a distinct (user, event_time, category) of a click joined to
  the inventory (clicks of two products of one category at the same instant
  are one view);
* the candidates of a view are the in-stock products (stock > 0) of its
  category, each flagged ``purchased`` (= user_id) when the user ever bought
  it, else NULL (repeat purchases count once);
* identical inventory rows count once; rows of one product that differ are
  separate candidates;
* candidates are ordered: purchased first, then rating descending, then
  product_id, event_time and stock ascending (the last three make the order
  total);
* ``scope="user"`` ranks all candidate rows of a user together (the literal
  job: one ranking per user, then grouped into event-time windows);
  ``scope="view"`` ranks per view (six products for the page being viewed);
* ``repeat=False`` (user scope; the job's "do not repeat suggestions from
  earlier page views" intent): a product is suggested once, at the user's
  first view of its category, and the slots its later repeats held go to the
  next best products.

Exact pruning instead of the all-pairs candidate join
----------------------------------------------------
Joining each view to its whole category is |views| x |category| rows. Only
the first k rows of each ranking are ever used, and these come from a small
set, so it is never built:

1. ``category_top``: the k best in-stock products per category.
2. ``bought_top``: per (user, category) the k best in-stock products the
   user bought.
3. ``pair_candidates``: per clicked (user, category), ``bought_top`` plus
   ``category_top`` minus what the user bought, cut to the k best. A bought
   product of the category top k has at most k-1 better in-stock products,
   so it is in ``bought_top``: the subtraction only needs ``bought_top``.
   Every better product has a row wherever a worse one does, so the k best
   rows of any ranking only use the k best products of each (user, category).
   Both inputs are arrays of at most k items per key (``bought_lists``,
   ``category_lists``), combined with array functions: no join fan-out and
   no shuffle beyond the (user, category) clustering they already have.
4. per view: each (view, category) carries its pair's list of at most k items
   as one array; the lists of a view are merged and cut to k, so one row per
   (view, category) moves, not one per candidate. Per user: only the k earliest
   views of each (user, category) can place a row in the user's first k, so at
   most k x k rows per pair. These are cut from the raw click rows per map task
   (``first_distinct``), so the per-user plans never shuffle every view.

Every per-key step is a partial aggregate (distinct), a top-k (map-side
WindowGroupLimit: at most k rows per group leave a task), a join whose
build side holds at most k rows per key, or a lookup of the product
dimension / category lists, broadcast after a size proof. The one join with
an unbounded side per key, views x pair candidates (per-view scope), is left
to AQE's skew-join split when a (user, category) pair is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.common import (
    DEFAULT_MAX_BROADCAST_ROWS,
    broadcast_if_bounded,
    first_distinct,
    fits_broadcast,
    top_k,
)

RATING_ORDERS = ("numeric", "string")
SCOPES = ("user", "view")
DEFAULT_K = 6

CANDIDATE_COLUMNS = ["user_id", "event_time", "product_id", "category", "stock", "rating", "purchased"]


def _rating_key(rating_order: str) -> Column:
    if rating_order == "numeric":
        return F.col("rating").try_cast("double")
    if rating_order == "string":
        # text order: "9" > "2" > "10" > "1"
        return F.col("rating").cast("string")
    raise ValueError(f"rating_order must be one of {RATING_ORDERS}, not {rating_order!r}")


def _product_order(rating_order: str) -> list[Column]:
    return [_rating_key(rating_order).desc_nulls_last(), F.col("product_id").asc(), F.col("stock").asc()]


def _candidate_order(rating_order: str) -> list[Column]:
    rating, product, stock = _product_order(rating_order)
    return [F.col("purchased").desc_nulls_last(), rating, product, F.col("event_time").asc(), stock]


def in_stock(inventory: DataFrame) -> DataFrame:
    """Products with stock > 0; stock text that is not a number is dropped."""
    return inventory.where(F.col("stock").try_cast("int") > 0)


def stocked(inventory: DataFrame) -> DataFrame:
    """In-stock products, identical rows once (before any ranking, so that a
    product listed twice does not take two places)."""
    return in_stock(inventory).select("product_id", "category", "stock", "rating").distinct()


def clicked_products(
    clicks: DataFrame,
    inventory: DataFrame,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Distinct (user_id, event_time, product_id, category) of known products. A
    product and category listed many times is looked up once (with
    ``max_broadcast_rows`` None the caller has seen to that)."""
    dim = inventory.select("product_id", "category")
    dim = dim if max_broadcast_rows is None else broadcast_if_bounded(dim.distinct(), max_broadcast_rows)
    return (
        clicks.select("user_id", "event_time", "product_id")
        .join(dim, "product_id")
        .select("user_id", "event_time", "product_id", "category")
        .distinct()
    )


def views(clicked: DataFrame) -> DataFrame:
    """Distinct (user_id, event_time, category) of clicked products."""
    return clicked.select("user_id", "event_time", "category").distinct()


def category_top(inventory: DataFrame, k: int = DEFAULT_K, rating_order: str = "numeric") -> DataFrame:
    """The k best in-stock products of each category (rank in ``crank``)."""
    return top_k(
        stocked(inventory),
        ["category"],
        _product_order(rating_order),
        k,
        rank_col="crank",
    )


def bought_products(
    sales: DataFrame,
    inventory: DataFrame,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
    prefilter: bool = False,
) -> DataFrame:
    """Distinct in-stock products each user bought, with category and rating.

    With a broadcast dimension (proven small here, or ``prefilter=True``
    from a caller that broadcast it), purchases of unknown or out-of-stock
    products are dropped by a map-side semi-join before the (user, product)
    de-duplication shuffles them. Without a broadcast that semi-join would
    itself shuffle every purchase by product, so it is left out."""
    dim = stocked(inventory)
    if max_broadcast_rows is not None and not dim.isStreaming and fits_broadcast(dim, max_broadcast_rows):
        dim = F.broadcast(dim)
        prefilter = True
    bought = sales.select("user_id", "product_id")
    if prefilter:
        bought = bought.join(dim.select("product_id"), "product_id", "left_semi")
    return bought.distinct().join(dim, "product_id")


def bought_top(bought: DataFrame, k: int = DEFAULT_K, rating_order: str = "numeric") -> DataFrame:
    """Per (user, category), the k best products the user bought (rank in
    ``brank``)."""
    return top_k(bought, ["user_id", "category"], _product_order(rating_order), k, rank_col="brank")


def category_lists(top_category: DataFrame) -> DataFrame:
    """Per category its top products as one small array (at most k)."""
    item = F.struct("crank", "product_id", "stock", "rating")
    return top_category.groupBy("category").agg(F.collect_list(item).alias("top_list"))


def bought_lists(top_bought: DataFrame) -> DataFrame:
    """Per (user, category) the bought top products as one array (at most k).

    ``top_bought`` is already clustered by (user, category), so this adds no
    shuffle."""
    item = F.struct("brank", "product_id", "stock", "rating")
    return top_bought.groupBy("user_id", "category").agg(F.collect_list(item).alias("bought_list"))


def pair_lists(
    pairs: DataFrame,
    bought: DataFrame,
    top: DataFrame,
    k: int = DEFAULT_K,
) -> DataFrame:
    """Per clicked (user, category): its k best candidates as one array, best
    first (``candidates``: grp, r, product_id, stock, rating; grp 0 is bought).

    ``bought`` is ``bought_lists`` (joined on user and category, co-partitioned
    with ``pairs``); ``top`` is ``category_lists`` (small, broadcast by the
    caller). Per pair both arrays hold at most k items; the result is the
    bought items in their order, then the category's top items the user did
    not buy, cut to k -- array functions on bounded arrays, no extra shuffle.
    """
    joined = pairs.join(bought, ["user_id", "category"], "left").join(top, "category", "left")

    def item(group: int, rank: str):
        return lambda x: F.struct(
            F.lit(group).alias("grp"),
            x[rank].alias("r"),
            x["product_id"].alias("product_id"),
            x["stock"].alias("stock"),
            x["rating"].alias("rating"),
        )

    # a pair without purchases (or a category without stock) has a NULL list
    empty = F.array()
    bought_ids = F.coalesce(F.transform("bought_list", lambda x: x["product_id"]), empty)
    first = F.coalesce(F.transform("bought_list", item(0, "brank")), empty)
    unbought = F.filter("top_list", lambda x: ~F.array_contains(bought_ids, x["product_id"]))
    rest = F.coalesce(F.transform(unbought, item(1, "crank")), empty)
    candidates = F.slice(F.array_sort(F.concat(first, rest)), 1, k)
    return joined.select("user_id", "category", candidates.alias("candidates"))


def pair_candidates(lists: DataFrame) -> DataFrame:
    """``pair_lists`` with one row per candidate, ``purchased`` as a flag."""
    return lists.select("user_id", "category", F.inline("candidates")).select(
        "user_id",
        "category",
        "product_id",
        "stock",
        "rating",
        F.when(F.col("grp") == 0, F.col("user_id")).alias("purchased"),
    )


def candidate_comparator(rating_order: str):
    """Comparator of two candidates of one view: bought first, rating
    descending (nulls last), product id, stock."""

    def rating(x: Column) -> Column:
        return x["rating"].try_cast("double") if rating_order == "numeric" else x["rating"].cast("string")

    def compare(a: Column, b: Column) -> Column:
        ra, rb = rating(a), rating(b)
        steps = [
            (a["grp"] < b["grp"], -1), (a["grp"] > b["grp"], 1),
            (ra.isNotNull() & rb.isNull(), -1), (ra.isNull() & rb.isNotNull(), 1), (ra > rb, -1), (ra < rb, 1),
            (a["product_id"] < b["product_id"], -1), (a["product_id"] > b["product_id"], 1),
            (a["stock"] < b["stock"], -1), (a["stock"] > b["stock"], 1),
        ]
        out = F.when(steps[0][0], steps[0][1])
        for test, sign in steps[1:]:
            out = out.when(test, sign)
        return out.otherwise(0)

    return compare


class Recommender:
    """Builds the recommendation frames from clicks, sales and inventory.

    Shared intermediate frames are built once per instance; each is a lazy
    DataFrame, so Spark plans the whole chain (and reuses exchanges).
    """

    def __init__(
        self,
        clicks: DataFrame,
        sales: DataFrame,
        inventory: DataFrame,
        k: int = DEFAULT_K,
        rating_order: str = "numeric",
        max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
        top_lists: DataFrame | None = None,
    ) -> None:
        """``top_lists``: precomputed ``category_lists`` for this inventory, k
        and rating order (a stream computes them once, not per batch)."""
        _rating_key(rating_order)
        self.top_lists = top_lists
        self.k = k
        self.rating_order = rating_order
        self.max_broadcast_rows = max_broadcast_rows
        # a product id that is none in the inventory's type cannot be in it
        product = inventory.schema["product_id"].dataType
        typed = lambda df: df if df is None or df.schema["product_id"].dataType == product else df.withColumn(
            "product_id", F.col("product_id").try_cast(product)
        )
        self.clicks = typed(clicks)
        self.sales = typed(sales)
        self.inventory = inventory
        self._cache: dict[str, DataFrame] = {}
        self._dimension_bounded: bool | None = None

    @classmethod
    def from_reduced(
        cls,
        first_views: DataFrame,
        top_bought: DataFrame,
        inventory: DataFrame,
        k: int = DEFAULT_K,
        rating_order: str = "numeric",
        max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
        top_lists: DataFrame | None = None,
    ) -> "Recommender":
        """A recommender over already reduced inputs: the k earliest views per
        (user, category) (``user_id, event_time, category``) and the k best
        bought products per (user, category) (``bought_top`` rows, with
        ``brank``). This is all the per-user ranking reads, so a stream can
        keep just these instead of the raw history. Only ``ranked("user")``
        and ``recommend("user")`` are available."""
        recommender = cls(None, None, inventory, k, rating_order, max_broadcast_rows, top_lists)
        recommender._cache["first_views"] = first_views.select("user_id", "event_time", "category")
        recommender._cache["bought_top"] = top_bought
        return recommender

    def _memo(self, name: str, build) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    # --- building blocks -------------------------------------------------
    def _dimension_is_small(self) -> bool:
        if self._dimension_bounded is None:
            dim = self.inventory.select("product_id", "category", "stock", "rating")
            self._dimension_bounded = self.max_broadcast_rows is not None and fits_broadcast(
                dim, self.max_broadcast_rows
            )
        return self._dimension_bounded

    def dimension(self) -> DataFrame:
        """The product lookup, broadcast once its size is proven small."""
        dim = self.inventory.select("product_id", "category", "stock", "rating")
        return self._memo("dimension", lambda: F.broadcast(dim) if self._dimension_is_small() else dim)

    def lookup(self) -> DataFrame:
        """Distinct (product_id, category), broadcast once its size is proven small:
        an inventory that lists a product many times adds no click rows."""

        def build() -> DataFrame:
            pairs = self.inventory.select("product_id", "category").distinct()
            small = self._dimension_is_small() or (self.max_broadcast_rows is not None and fits_broadcast(pairs, self.max_broadcast_rows))
            return F.broadcast(pairs) if small else pairs

        return self._memo("lookup", build)

    def clicked(self) -> DataFrame:
        return self._memo("clicked", lambda: clicked_products(self.clicks, self.lookup(), None))

    def views(self) -> DataFrame:
        return self._memo("views", lambda: views(self.clicked()))

    def click_rows(self) -> DataFrame:
        """(user, event_time, category) of every click of a known product,
        not de-duplicated."""
        return self._memo(
            "click_rows",
            lambda: self.clicks.select("user_id", "event_time", "product_id")
            .join(self.lookup(), "product_id")
            .select("user_id", "event_time", "category"),
        )

    def first_views(self) -> DataFrame:
        """The k earliest views of each (user, category), straight from the
        click rows: each map task sends only the rows of its k earliest times
        per (user, category), never every view (``first_distinct``)."""
        return self._memo(
            "first_views",
            lambda: first_distinct(self.click_rows(), ["user_id", "category"], "event_time", self.k),
        )

    def first_seen(self) -> DataFrame:
        """Per clicked (user, category), the user's first view of it. Derived
        from ``first_views``, whose rows are already clustered by (user,
        category), so the minimum adds no shuffle."""
        return self._memo(
            "first_seen",
            lambda: self.first_views().groupBy("user_id", "category").agg(F.min("event_time").alias("event_time")),
        )

    def pairs(self, scope: str = "user") -> DataFrame:
        """Distinct clicked (user, category), taken from the views the ranking
        of ``scope`` reads, so each plan reads the clicks once: from
        ``first_views`` (user scope), or per view from ``views`` through a
        top-1 per pair. A plain distinct over ``views`` would be folded into
        the views' own aggregate by the optimizer and read the clicks again."""
        if scope == "view":
            build = lambda: top_k(
                self.views(), ["user_id", "category"], [F.col("event_time").asc()], 1, "prank"
            ).select("user_id", "category")
        else:
            build = lambda: self.first_views().select("user_id", "category").distinct()
        return self._memo(f"pairs:{scope}", build)

    def category_top(self) -> DataFrame:
        return self._memo("category_top", lambda: category_top(self.inventory, self.k, self.rating_order))

    def category_lists(self) -> DataFrame:
        """Broadcast: it has at most one row per category, so it is bounded
        whenever the dimension is; otherwise the planner decides, from the size
        it has at run time (a check here would compute the lists twice)."""

        def build() -> DataFrame:
            lists = self.top_lists if self.top_lists is not None else category_lists(self.category_top())
            return F.broadcast(lists) if self._dimension_is_small() else lists

        return self._memo("category_lists", build)

    def bought(self) -> DataFrame:
        return self._memo(
            "bought",
            lambda: bought_products(self.sales, self.dimension(), None, prefilter=self._dimension_is_small()),
        )

    def bought_top(self) -> DataFrame:
        return self._memo("bought_top", lambda: bought_top(self.bought(), self.k, self.rating_order))

    def purchased_in_clicked(self) -> DataFrame:
        """Every in-stock product of a clicked category that the user bought:
        at most one row per distinct purchase, so it is not cut."""
        return self._memo(
            "purchased_in_clicked",
            lambda: self.pairs().join(self.bought(), ["user_id", "category"])
            .select("user_id", "category", "product_id", "stock", "rating", F.col("user_id").alias("purchased")),
        )

    def pair_lists(self, scope: str = "user") -> DataFrame:
        return self._memo(
            f"pair_lists:{scope}",
            lambda: pair_lists(self.pairs(scope), bought_lists(self.bought_top()), self.category_lists(), self.k),
        )

    def pair_candidates(self, scope: str = "user") -> DataFrame:
        return self._memo(f"pair_candidates:{scope}", lambda: pair_candidates(self.pair_lists(scope)))

    def view_candidates(self) -> DataFrame:
        """Per view, the k best candidates of the view's category (a ranking's
        first rows only use these; all candidates would be views x category)."""
        return self._memo(
            "view_candidates",
            lambda: self.views().join(self.pair_candidates("view"), ["user_id", "category"])
            .select(*CANDIDATE_COLUMNS),
        )

    def view_lists(self) -> DataFrame:
        """Per view (user, time), its k best candidates over all its categories
        as one array, best first. A view's categories are merged as arrays of at
        most k items: one row per (view, category) is shuffled."""

        def build() -> DataFrame:
            each = F.transform("candidates", lambda x: x.withField("category", F.col("category")))
            merged = (
                self.views().join(self.pair_lists("view"), ["user_id", "category"])
                .select("user_id", "event_time", each.alias("each"))
                .groupBy("user_id", "event_time")
                .agg(F.flatten(F.collect_list("each")).alias("candidates"))
            )
            best = F.slice(F.array_sort("candidates", candidate_comparator(self.rating_order)), 1, self.k)
            return merged.select("user_id", "event_time", best.alias("candidates")).where(F.size("candidates") > 0)

        return self._memo("view_lists", build)

    # --- rankings ----------------------------------------------------------
    def ranked(self, scope: str = "user", repeat: bool = True) -> DataFrame:
        """The first k candidate rows per user (or per view), rank in ``rn``.

        ``repeat=False`` (user scope only): one row per (user, product), at
        the first view of the product's category. A product's rows differ
        only in ``event_time`` and its earliest row ranks best, so this drops
        exactly the repeats from later views. Per view it would need each
        view's list before the next one's (a sequential dependency): refused.
        """
        if scope == "user":
            seen = self.first_views() if repeat else self.first_seen()
            rows = seen.join(self.pair_candidates(), ["user_id", "category"]).select(*CANDIDATE_COLUMNS)
            return top_k(rows, ["user_id"], _candidate_order(self.rating_order), self.k)
        if scope == "view":
            if not repeat:
                raise ValueError('repeat=False is defined for scope="user" only')
            rows = self.view_lists().select("user_id", "event_time", F.posexplode("candidates").alias("i", "c"))
            purchased = F.when(F.col("c.grp") == 0, F.col("user_id")).alias("purchased")
            product = [F.col(f"c.{c}") for c in ("product_id", "category", "stock", "rating")]
            return rows.select("user_id", "event_time", *product, purchased, (F.col("i") + 1).alias("rn"))
        raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")

    def recommend(self, scope: str = "user", window: str = "5 seconds", repeat: bool = True) -> DataFrame:
        """Comma list of product ids in rank order.

        ``scope="user"``: per user and tumbling event-time window, stamped
        with the window end (the job's keyed output rows).
        ``scope="view"``: one list per view, stamped with the view's time.
        ``repeat``: see ``ranked``.
        """
        if scope == "view" and repeat:
            ids = F.transform("candidates", lambda x: x["product_id"].cast("string"))
            return self.view_lists().select("user_id", F.array_join(ids, ",").alias("top_product_ids"), "event_time")
        grouped = self.ranked(scope, repeat).groupBy("user_id", F.window("event_time", window).alias("w"))
        return grouped.agg(ordered_list("rn", "product_id").alias("top_product_ids")).select(
            "user_id", "top_product_ids", F.col("w.end").alias("event_time")
        )


def ordered_list(order_col: str, value_col: str, sep: str = ",") -> Column:
    """``LISTAGG(value, sep) WITHIN GROUP (ORDER BY order)`` for small groups
    (at most k rows here); also allowed in streaming aggregations."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(value_col).alias("v"))))
    return F.array_join(F.transform(items, lambda x: x["v"].cast("string")), sep)
