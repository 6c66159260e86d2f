"""Rankings per page view that depend on what came before the view.

``ranked_bought_before``: a product counts as bought only from its purchase on.
Per (user, category) the list of the k best products bought changes when one is
bought that belongs to the k best by then. Products that never do (k better ones
were bought by the time of their first purchase) cannot show up at any view; what
is left is short, is looked up by the time of each view, and can be found in parts:
the left of all parts together has the same left as the whole.

``ranked_unseen``: no product is suggested twice to a user; each view takes the k
best not shown before. Within a category a user's candidates have one order, and
views take them from its start, so what was shown of a category is a prefix of
that order: one number per (user, category), carried from view to view. Views of
one set of categories beyond the one that exhausts them show nothing and are cut
first, so a user's history is bounded by the products in stock, not by the clicks;
long ones go in chunks, the numbers carried between them.

``ranked_excluding_viewed``: the products clicked at the view itself are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators import recommend as rec
from basketry.operators.common import broadcast_if_bounded
from basketry.session import checkpoint_root

#: parts of a hot (user, category) or (user, set of categories)
SALTS = 16
#: views of a user that one round folds
CHUNK_VIEWS = 500


def _written(df: DataFrame) -> DataFrame:
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def _item(grp: int):
    """A candidate as the comparator of ``recommend`` takes it."""

    def build(x: Column) -> Column:
        fields = [x[c].alias(c) for c in ("product_id", "stock", "rating")]
        return F.struct(F.lit(grp).alias("grp"), *fields, F.col("category").alias("category"))

    return build


def _rows(lists: DataFrame) -> DataFrame:
    """``user_id, event_time, candidates`` as one row per candidate, rank in ``rn``."""
    rows = lists.select("user_id", "event_time", F.posexplode("candidates").alias("i", "c"))
    purchased = F.when(F.col("c.grp") == 0, F.col("user_id")).alias("purchased")
    product = [F.col(f"c.{c}") for c in ("product_id", "category", "stock", "rating")]
    return rows.select("user_id", "event_time", *product, purchased, (F.col("i") + 1).alias("rn"))


# --- bought before the view -----------------------------------------------------


def lasting(items: str, k: int, rating_order: str) -> Column:
    """Of an array of (since, product_id, stock, rating, grp): those that are among
    the k best of the ones with a ``since`` not after their own."""
    better = rec.candidate_comparator(rating_order)

    def by_time(a: Column, b: Column) -> Column:
        return F.when(a["since"] < b["since"], -1).when(a["since"] > b["since"], 1).otherwise(better(a, b))

    def step(acc: Column, x: Column) -> Column:
        top = F.slice(F.array_sort(F.array_append(acc["top"], x), better), 1, k)
        kept = F.when(F.array_contains(top, x), F.array_append(acc["kept"], x)).otherwise(acc["kept"])
        return F.struct(top.alias("top"), kept.alias("kept"))

    none = F.slice(items, 1, 0)
    return F.aggregate(F.array_sort(items, by_time), F.struct(none.alias("top"), none.alias("kept")), step, lambda acc: acc["kept"])


def bought_over_time(sales: DataFrame, stocked: DataFrame, k: int, rating_order: str, time_col: str = "purchase_time") -> DataFrame:
    """Per (user, category) the products that are among its k best bought ones at
    some time, with the time of the first purchase (``items``)."""
    since = sales.groupBy("user_id", "product_id").agg(F.min(time_col).alias("since")).where("since is not null")
    item = F.struct("since", "product_id", "stock", "rating", F.lit(0).alias("grp"))
    rows = since.join(stocked, "product_id").select("user_id", "category", F.pmod(F.xxhash64("product_id"), F.lit(SALTS)).alias("salt"), item.alias("item"))
    parts = rows.groupBy("user_id", "category", "salt").agg(F.collect_list("item").alias("items"))
    parts = parts.select("user_id", "category", lasting("items", k, rating_order).alias("items"))
    whole = parts.groupBy("user_id", "category").agg(F.flatten(F.collect_list("items")).alias("items"))
    return whole.select("user_id", "category", lasting("items", k, rating_order).alias("items"))


def ranked_bought_before(recommender: rec.Recommender, time_col: str = "purchase_time") -> DataFrame:
    """The first k candidate rows per view, where ``purchased`` says that the user
    had bought the product at the time of the view or before."""
    k, better = recommender.k, rec.candidate_comparator(recommender.rating_order)
    stocked = rec.stocked(recommender.dimension())
    bought = bought_over_time(recommender.sales, stocked, k, recommender.rating_order, time_col)
    views = recommender.views().join(bought, ["user_id", "category"], "left").join(recommender.category_lists(), "category", "left")
    then = F.filter(F.coalesce("items", F.array()), lambda x: x["since"] <= F.col("event_time"))
    views = views.select("user_id", "event_time", "category", F.transform(then, _item(0)).alias("own"), "top_list")
    ids = F.transform("own", lambda x: x["product_id"])
    rest = F.transform(F.filter(F.coalesce("top_list", F.array()), lambda x: ~F.array_contains(ids, x["product_id"])), _item(1))
    each = F.slice(F.array_sort(F.concat("own", rest), better), 1, k)
    merged = views.select("user_id", "event_time", each.alias("each")).groupBy("user_id", "event_time").agg(F.flatten(F.collect_list("each")).alias("each"))
    return _rows(merged.select("user_id", "event_time", F.slice(F.array_sort("each", better), 1, k).alias("candidates")))


# --- without the products of the view itself ---------------------------------------


def ranked_excluding_viewed(recommender: rec.Recommender) -> DataFrame:
    """The first k candidate rows per view among the products that the view did not
    click itself. A view of n products of a category needs its k + n best; lists are
    as deep as the largest n asks (at most what Spark cuts per task, see ``top_k``)."""
    k, better = recommender.k, rec.candidate_comparator(recommender.rating_order)
    views = recommender.clicked().groupBy("user_id", "event_time", "category").agg(F.collect_set("product_id").alias("seen"))
    views = _written(views)
    most = views.agg(F.max(F.size("seen"))).first()[0] or 0
    deeper = rec.Recommender(
        recommender.clicks, recommender.sales, recommender.inventory, k + most, recommender.rating_order, recommender.max_broadcast_rows
    )
    rows = views.join(deeper.pair_lists("view"), ["user_id", "category"])
    others = F.filter("candidates", lambda x: ~F.array_contains("seen", x["product_id"]))
    each = F.transform(F.slice(others, 1, k), lambda x: x.withField("category", F.col("category")))
    merged = rows.select("user_id", "event_time", each.alias("each")).groupBy("user_id", "event_time").agg(F.flatten(F.collect_list("each")).alias("each"))
    return _rows(merged.select("user_id", "event_time", F.slice(F.array_sort("each", better), 1, k).alias("candidates")))


# --- each product once ------------------------------------------------------------


def _productive_views(recommender: rec.Recommender, sizes: DataFrame) -> DataFrame:
    """``user_id, event_time, categories, place``: the views that can show something,
    numbered by time per user. ``sizes``: ``category, n`` in stock."""
    views = recommender.views().join(sizes, "category")
    sets = views.groupBy("user_id", "event_time").agg(
        F.sort_array(F.collect_set("category")).alias("categories"), F.ceil(F.sum("n") / recommender.k).alias("most")
    )
    # n views of one set show at least min(n k, all) of its products
    salted = sets.withColumn("salt", F.pmod(F.xxhash64("event_time"), F.lit(SALTS)))
    for keys in (["user_id", "categories", "salt"], ["user_id", "categories"]):
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("event_time"))
        salted = salted.withColumn("nth", nth).where("nth <= most")
    return salted.select("user_id", "event_time", "categories", F.row_number().over(Window.partitionBy("user_id").orderBy("event_time")).alias("place"))


def _category_prefixes(recommender: rec.Recommender, needs: DataFrame) -> DataFrame:
    """Per ``category, scale`` of ``needs`` the category's first 2 ** scale products
    in order (``all``). Ranked in parts first, so no task holds a whole category."""
    most = 1 << (needs.agg(F.max("scale")).first()[0] or 0)
    ranked = rec.stocked(recommender.dimension()).where("product_id is not null")
    ranked = ranked.withColumn("salt", F.pmod(F.xxhash64("product_id"), F.lit(SALTS)))
    for keys in (["category", "salt"], ["category"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*rec._product_order(recommender.rating_order)))
        ranked = ranked.withColumn("place", place).where(F.col("place") <= most)
    rows = ranked.join(broadcast_if_bounded(needs, recommender.max_broadcast_rows), "category").where("place <= shiftleft(1L, scale)")
    first = rows.groupBy("category", "scale").agg(F.collect_list(F.struct("place", "product_id", "stock", "rating")).alias("all"))
    first = _written(first.select("category", "scale", F.transform(F.array_sort("all"), _item(1)).alias("all")))
    # the lists of small needs are a few rows; long ones may be more than the dimension
    held = first.agg(F.sum(F.size("all"))).first()[0] or 0
    return F.broadcast(first) if held <= (recommender.max_broadcast_rows or 0) else first


def _pair_orders(recommender: rec.Recommender, views: DataFrame) -> DataFrame:
    """Per (user, category) of the views its candidates in order (``order``), as many
    as its views can show. Of a category's first ``depth`` + n products a user who
    bought n leaves ``depth`` or more, so a pair reads the shortest prefix of 1, 2,
    4, ... products that holds so many, never the whole category."""
    k, better = recommender.k, rec.candidate_comparator(recommender.rating_order)
    pairs = views.select("user_id", F.explode("categories").alias("category")).groupBy("user_id", "category")
    pairs = pairs.agg((F.count(F.lit(1)) * k).cast("int").alias("depth"))
    one = F.struct("product_id", "stock", "rating")
    bought = recommender.bought().groupBy("user_id", "category").agg(F.collect_list(one).alias("own"))
    rows = pairs.join(bought, ["user_id", "category"], "left")
    need = F.col("depth") + F.size(F.coalesce("own", F.array()))
    rows = _written(rows.withColumn("scale", F.ceil(F.log2(need)).cast("int")))
    prefixes = _category_prefixes(recommender, rows.select("category", "scale").distinct())
    rows = rows.join(prefixes, ["category", "scale"], "left")
    own = F.array_sort(F.transform(F.coalesce("own", F.array()), _item(0)), better)
    ids = F.transform(F.coalesce("own", F.array()), lambda x: x["product_id"])
    rest = F.filter(F.coalesce("all", F.array()), lambda x: ~F.array_contains(ids, x["product_id"]))
    return rows.select("user_id", "category", F.slice(F.concat(own, rest), 1, F.col("depth")).alias("order"))


def ranked_unseen(recommender: rec.Recommender) -> DataFrame:
    """The first k candidate rows per view that no earlier view of the user has shown."""
    k, better = recommender.k, rec.candidate_comparator(recommender.rating_order)
    sizes = rec.stocked(recommender.dimension()).where("category is not null").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    sizes = F.broadcast(sizes) if recommender._dimension_is_small() else sizes
    views = _written(_productive_views(recommender, sizes))
    orders = _pair_orders(recommender, views)
    lists = _written(orders.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("category", "order"))).alias("orders")))

    def step(acc: Column, view: Column) -> Column:
        shown = lambda c: F.coalesce(F.try_element_at(acc["shown"], c), F.lit(0))
        heads = F.flatten(F.transform(view["categories"], lambda c: F.slice(F.try_element_at("orders", c), shown(c) + 1, k)))
        picks = F.slice(F.array_sort(heads, better), 1, k)
        moved = F.transform(view["categories"], lambda c: F.struct(c, shown(c) + F.size(F.filter(picks, lambda p: p["category"] == c))))
        still = F.map_filter(acc["shown"], lambda c, _: ~F.array_contains(view["categories"], c))
        out = F.array_append(acc["out"], F.struct(view["event_time"].alias("event_time"), picks.alias("candidates")))
        return F.struct(F.map_concat(still, F.map_from_entries(moved)).alias("shown"), out.alias("out"))

    rounds = views.agg(F.max("place")).first()[0] or 0
    done, carried = None, None
    for first in range(0, rounds, CHUNK_VIEWS):
        chunk = views.where(f"place > {first} and place <= {first + CHUNK_VIEWS}")
        chunk = chunk.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_time", "categories"))).alias("views")).join(lists, "user_id")
        if carried is None:
            shown = F.map_from_arrays(F.slice(F.map_keys("orders"), 1, 0), F.array().cast("array<int>"))
        else:
            chunk, shown = chunk.join(carried, "user_id"), F.col("shown")
        # an empty array of the type of the result
        no_picks = F.slice(F.flatten(F.map_values("orders")), 1, 0).alias("candidates")
        empty = F.slice(F.transform("views", lambda v: F.struct(v["event_time"].alias("event_time"), no_picks)), 1, 0)
        folded = F.aggregate("views", F.struct(shown.alias("shown"), empty.alias("out")), step)
        rows = _written(chunk.select("user_id", folded.alias("f")))
        carried = rows.select("user_id", "f.shown")
        found = rows.select("user_id", F.inline("f.out"))
        done = found if done is None else done.unionByName(found)
    if done is None:
        done = views.join(lists, "user_id").select("user_id", "event_time", F.flatten(F.map_values("orders")).alias("candidates")).limit(0)
    return _rows(done)
