"""Registered queries over the generated test tables, with their SQL oracles.

Each entry is a Spark query ``(spark, sf_dir) -> DataFrame`` built from the
library's operators, plus an independent DuckDB SQL text over the raw tables.
For the recommendation queries the SQL is the literal, unpruned form (every
view joined to its whole category, one ROW_NUMBER over it), so the oracle
checks the pruned Spark plan against brute force.

Column names are aliased identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry import schemas
from basketry.functions import encode, parse
from basketry.operators import history
from basketry.operators import recommend as rec
from basketry.operators import sales as sal
from basketry.operators.common import latest_per_key
from basketry.plans.registry import REGISTRY, oracle_sql, queries, register  # noqa: F401
from basketry.schemas import SALES_FIELDS
from basketry.sources import files
from basketry.sources import testdata as td


W = td.oracle_with

# --------------------------------------------------------------------------
# Parsing and sources
# --------------------------------------------------------------------------


def _split_sql(src: str, fields: list[tuple[str, str]], carry: str) -> str:
    cols = ", ".join(f"CAST(f[{i + 1}] AS {t}) AS {n}" if t != "VARCHAR" else f"f[{i + 1}] AS {n}"
                     for i, (n, t) in enumerate(fields))
    line = "concat_ws(',', " + ", ".join(n for n, _ in fields) + ")"
    return (
        f"SELECT {cols}{', ' + carry if carry else ''} FROM ("
        f"SELECT string_split(replace({line}, '\"', ''), ',') AS f{', ' + carry if carry else ''} FROM {src})"
    )


_TEXT_SALES = [(n, "VARCHAR") for n in SALES_FIELDS]
_SALES_TYPES = [("invoice_id", "BIGINT"), ("user_id", "BIGINT"), ("product_id", "BIGINT"),
                ("quantity", "BIGINT"), ("unit_cost", "INTEGER")]
_PRODUCT_TYPES = [("product_id", "BIGINT"), ("category", "VARCHAR"), ("stock", "INTEGER"), ("rating", "INTEGER")]
_CLICK_TYPES = [("user_id", "VARCHAR"), ("product_id", "VARCHAR")]


# Every event as a line of the sales topic: a purchase is a full sale line, any
# other event has no quantity and cost and is a malformed one.
_EVENT_LINES = (
    "event_lines AS (SELECT event_id, ts, event_type = 'purchase' AS whole, concat_ws(',', event_id, user_id, "
    "json_extract_string(props, '$.k'), CASE WHEN event_type = 'purchase' THEN 1 + event_id % 3 END, "
    "CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS INTEGER) END) AS line FROM events)\n"
)


@register(
    "parse_sales_csv",
    W("sales") + ", " + _EVENT_LINES + "SELECT " + ", ".join(f"CAST(s.{n} AS VARCHAR) AS {n}" for n in SALES_FIELDS)
    + ", CASE WHEN e.whole THEN NULL ELSE e.line END AS _corrupt_record, e.ts AS purchase_time "
    "FROM event_lines e LEFT JOIN sales s ON e.whole AND s.invoice_id = e.event_id",
)
def parse_sales_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_sales(td.event_lines(spark, sf_dir), on_error="quarantine", keep=["purchase_time"])
    # as text: a number that can be null may be compared through a float
    return parsed.withColumns({n: parsed[n].cast("string") for n in SALES_FIELDS})


@register("parse_products_csv", W("inv") + _split_sql("inv WHERE stock > 0", _PRODUCT_TYPES, ""))
def parse_products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = files.text_lines(spark, td.inventory_file(spark, sf_dir))
    return parse.parse_products(lines, on_error="drop")


@register(
    "clicks_scan",
    "SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS product_id, ts AS event_time "
    "FROM events WHERE event_type <> 'purchase'",
)
def clicks_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click topic's decoder over all events: sale lines have too many fields."""
    lines = td.event_lines(spark, sf_dir, drop_invoice=True)
    return parse.decode_clicks(lines, on_error="drop", keep=["purchase_time"]).withColumnRenamed("purchase_time", "event_time")


@register("sales_scan", W("sales") + _split_sql("sales", _TEXT_SALES, "purchase_time"))
def sales_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.decode_sales(td.event_lines(spark, sf_dir), on_error="drop", keep=["purchase_time"])


@register("inventory_scan", W("inv") + _split_sql("inv WHERE stock > 0", _PRODUCT_TYPES, ""))
def inventory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file with bad lines: products without stock hold a word for it."""
    return files.csv_table(spark, td.inventory_file(spark, sf_dir), schemas.PRODUCT, on_error="drop")


# --------------------------------------------------------------------------
# Sales by category
# --------------------------------------------------------------------------

def _enriched_sql(src: str = "sales") -> str:
    """Views ``inv``, ``src`` and ``enriched`` (sales of known products)."""
    return W("inv", src) + (
        ", enriched AS (SELECT s.invoice_id, s.user_id, s.product_id, s.purchase_time, p.category, "
        f"s.quantity AS sales FROM {src} s JOIN inv p ON s.product_id = p.product_id)\n"
    )


def _sums_sql(width: str) -> str:
    bucket = f"time_bucket(INTERVAL '{width}', purchase_time)"
    return (
        f"SELECT {bucket} AS window_start, {bucket} + INTERVAL '{width}' AS window_end, "
        "category, CAST(sum(sales) AS BIGINT) AS sales FROM enriched GROUP BY 1, 2, 3"
    )


@register(
    "dim_latest",
    "SELECT l_partkey AS product_id, arg_max(l_returnflag, load) AS category, arg_max(stock, load) AS stock, "
    "arg_max(l_linenumber, load) AS rating FROM (SELECT *, CAST(l_quantity AS INTEGER) AS stock, "
    "(l_shipdate, l_orderkey, l_linenumber) AS load FROM lineitem) GROUP BY l_partkey",
)
def dim_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with many rows per product, in load order: its order lines."""
    return sal.latest_products(td.product_updates(spark, sf_dir), td.LOAD_ORDER).drop(*td.LOAD_ORDER)


@register("sales_enriched", _enriched_sql() + "SELECT * FROM enriched")
def sales_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sal.enrich_sales(td.sales(spark, sf_dir), td.inventory(spark, sf_dir))


@register(
    "sales_unmatched",
    W("inv", "sales") + "SELECT * FROM sales WHERE product_id NOT IN (SELECT product_id FROM inv WHERE stock > 0)",
)
def sales_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of products that a dimension of the products in stock does not hold."""
    return sal.unmatched_sales(td.sales(spark, sf_dir), rec.in_stock(td.inventory(spark, sf_dir)))


@register(
    "sales_matched",
    W("inv", "sales") + "SELECT invoice_id, user_id, product_id, purchase_time, (SELECT max(category) FROM inv "
    "WHERE inv.product_id = sales.product_id) AS category, quantity AS sales FROM sales "
    "WHERE product_id IN (SELECT product_id FROM inv WHERE stock > 0)",
)
def sales_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other side: an unknown product's sale is dropped by the enrichment."""
    return sal.enrich_sales(td.sales(spark, sf_dir), rec.in_stock(td.inventory(spark, sf_dir)))


@register(
    "sales_as_of",
    W("sales_bulk") + ", versions AS (SELECT l_partkey AS product_id, l_returnflag AS category, l_shipdate AS since, "
    "(l_shipdate, l_orderkey, l_linenumber) AS load FROM lineitem)\n, numbered AS (SELECT row_number() OVER () AS id, * FROM sales_bulk)\n"
    "SELECT any_value(invoice_id) AS invoice_id, any_value(user_id) AS user_id, any_value(s.product_id) AS product_id, "
    "any_value(purchase_time) AS purchase_time, arg_max(category, load) AS category, any_value(quantity) AS sales "
    "FROM numbered s JOIN versions v ON v.product_id = s.product_id AND v.since <= s.purchase_time GROUP BY id",
)
def sales_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the category their product had when ordered; the
    dimension's versions are its shipped lines, in load order."""
    return sal.enrich_sales_as_of(td.sales_bulk(spark, sf_dir), td.product_updates(spark, sf_dir), "purchase_time", "shipped", td.LOAD_ORDER)


@register(
    "sales_trailing_hour",
    _enriched_sql() + "SELECT DISTINCT category, purchase_time, CAST(sum(sales) OVER (PARTITION BY category ORDER BY purchase_time "
    "RANGE BETWEEN INTERVAL '1 hour' PRECEDING AND CURRENT ROW) AS BIGINT) AS sales FROM enriched",
)
def sales_trailing_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last hour's sales of a category, exact at every sale."""
    return sal.trailing_sales(sal.enrich_sales(td.sales(spark, sf_dir), td.inventory(spark, sf_dir)))


@register(
    "sales_trailing_month",
    _enriched_sql("sales_bulk") + "SELECT DISTINCT category, purchase_time, CAST(sum(sales) OVER (PARTITION BY category ORDER BY purchase_time "
    "RANGE BETWEEN INTERVAL '30 days' PRECEDING AND CURRENT ROW) AS BIGINT) AS sales FROM enriched",
)
def sales_trailing_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over order lines, whose days hold many sales each."""
    return sal.trailing_sales(sal.enrich_sales(td.sales_bulk(spark, sf_dir), td.inventory(spark, sf_dir)), interval="30 days")


def _by_category_sql(width: str, src: str = "sales") -> str:
    return _enriched_sql(src) + _sums_sql(width)


def _by_category(spark: SparkSession, sf_dir: str, width: str, bulk: bool = False) -> DataFrame:
    source = td.sales_bulk(spark, sf_dir) if bulk else td.sales(spark, sf_dir)
    return sal.sales_by_category(sal.enrich_sales(source, td.inventory(spark, sf_dir)), "purchase_time", width)


@register("sales_by_category_10s", _by_category_sql("10 seconds"))
def sales_by_category_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_category(spark, sf_dir, "10 seconds")


@register("sales_by_category_hour", _by_category_sql("1 hour"))
def sales_by_category_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_category(spark, sf_dir, "1 hour")


@register("sales_by_category_day", _by_category_sql("1 day"))
def sales_by_category_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_category(spark, sf_dir, "1 day")


@register("sales_by_category_bulk_day", _by_category_sql("1 day", "sales_bulk"))
def sales_by_category_bulk_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_category(spark, sf_dir, "1 day", bulk=True)


@register(
    "sales_by_category_rolling",
    _enriched_sql() + (
        ", spread AS (SELECT time_bucket(INTERVAL '10 minutes', purchase_time) - to_minutes(10 * j) AS window_start, "
        "category, sales FROM enriched, range(0, 6) r(j))\n"
        "SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, category, "
        "CAST(sum(sales) AS BIGINT) AS sales FROM spread GROUP BY 1, 2, 3"
    ),
)
def sales_by_category_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = sal.enrich_sales(td.sales(spark, sf_dir), td.inventory(spark, sf_dir))
    return sal.sales_by_category(enriched, "purchase_time", "1 hour", "10 minutes")


@register(
    "sales_by_category_json",
    _enriched_sql() + f", sums AS ({_sums_sql('10 seconds')})\n"
    "SELECT window_end, json_object('category', category, 'sales', sales)::VARCHAR AS value FROM sums",
)
def sales_by_category_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = sales_by_category_10s(spark, sf_dir)
    return sums.select("window_end", encode.sales_by_category_json().alias("value"))


# --------------------------------------------------------------------------
# Recommendations
# --------------------------------------------------------------------------

# Unpruned form, step by step: what is in stock, who saw which category when,
# who owns what; then every stocked product of a seen category is a candidate.
def _candidates_sql(purchases: str = "sales", inventory: str = "inv") -> str:
    return W("inv", "clicks", purchases) + f""", stocked AS (
  SELECT DISTINCT product_id, category, stock, rating FROM {inventory} WHERE stock > 0
), viewed AS (
  SELECT user_id, event_time, category FROM clicks NATURAL JOIN (SELECT product_id, category FROM inv) GROUP BY ALL
), owned AS (
  SELECT DISTINCT user_id, product_id FROM {purchases}
), candidates AS (
  SELECT viewed.user_id, viewed.event_time, stocked.*,
         CASE WHEN EXISTS (FROM owned WHERE owned.user_id = viewed.user_id AND owned.product_id = stocked.product_id)
              THEN viewed.user_id END AS purchased
  FROM stocked, viewed WHERE stocked.category = viewed.category
)
"""


_CANDIDATES_SQL = _candidates_sql()


def _rank_sql(partition: str, rating: str, with_time: bool = True) -> str:
    order = f"purchased DESC NULLS LAST, {rating} DESC, product_id ASC"
    if with_time:
        order += ", event_time ASC"
    order += ", stock ASC"
    return f"CAST(ROW_NUMBER() OVER (PARTITION BY {partition} ORDER BY {order}) AS INTEGER)"


_RATING_SQL = {"numeric": "rating", "string": "CAST(rating AS VARCHAR)"}
_CAND_COLS = "user_id, event_time, product_id, category, stock, rating, purchased"
# Output form: ``purchased`` (the buyer's id or NULL) as text, as the original
# tables declared their ids, so a nullable integer never goes through a float
# conversion when results are compared.
_CAND_OUT = "user_id, event_time, product_id, category, stock, rating, CAST(purchased AS VARCHAR) AS purchased"


def _purchased_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("purchased", df["purchased"].cast("string"))


def _topk_user_sql(rating_order: str = "numeric", k: int = 6, purchases: str = "sales") -> tuple[str, str]:
    return (
        _candidates_sql(purchases)
        + f", ranked AS (SELECT {_CAND_COLS}, {_rank_sql('user_id', _RATING_SQL[rating_order])} AS rn "
        f"FROM candidates)\n"
    ), f"SELECT {_CAND_OUT}, rn FROM ranked WHERE rn <= {k}"


def _topk_view_sql(k: int = 6) -> tuple[str, str]:
    return (
        _CANDIDATES_SQL
        + f", ranked AS (SELECT {_CAND_COLS}, {_rank_sql('user_id, event_time', 'rating', False)} AS rn "
        f"FROM candidates)\n"
    ), f"SELECT {_CAND_OUT}, rn FROM ranked WHERE rn <= {k}"


def _recommend_user_sql(rating_order: str = "numeric", width: str = "5 seconds", purchases: str = "sales") -> str:
    prefix, _ = _topk_user_sql(rating_order, purchases=purchases)
    bucket = f"time_bucket(INTERVAL '{width}', event_time)"
    return prefix + (
        f"SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rn) AS top_product_ids, "
        f"{bucket} + INTERVAL '{width}' AS event_time FROM ranked WHERE rn <= 6 "
        f"GROUP BY user_id, {bucket}"
    )


def _unseen_sql(k: int = 6) -> tuple[str, str]:
    """Literal candidates, each (user, product) kept once at its first view
    (the "do not repeat suggestions from earlier page views" intent)."""
    return (
        _CANDIDATES_SQL
        + ", seen AS (SELECT user_id, product_id, category, stock, rating, purchased, "
        "min(event_time) AS event_time FROM candidates "
        "GROUP BY user_id, product_id, category, stock, rating, purchased)\n"
        f", ranked AS (SELECT {_CAND_COLS}, {_rank_sql('user_id', 'rating')} AS rn FROM seen)\n"
    ), f"SELECT {_CAND_OUT}, rn FROM ranked WHERE rn <= {k}"


def _recommender(spark: SparkSession, sf_dir: str, rating_order: str = "numeric", bulk: bool = False) -> rec.Recommender:
    purchases = td.sales_bulk(spark, sf_dir) if bulk else td.sales(spark, sf_dir)
    return rec.Recommender(
        td.clicks(spark, sf_dir), purchases, td.inventory(spark, sf_dir), k=6, rating_order=rating_order
    )


@register(
    "clicked_products",
    W("inv", "clicks") + "SELECT user_id, event_time, product_id, category FROM clicks NATURAL JOIN inv GROUP BY ALL",
)
def clicked_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir).clicked()


@register("candidates_in_stock", W("inv") + "SELECT * FROM inv WHERE stock > 0")
def candidates_in_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.in_stock(td.inventory(spark, sf_dir))


@register(
    "category_top",
    W("inv") + "SELECT * FROM (SELECT product_id, category, stock, rating, CAST(ROW_NUMBER() OVER "
    "(PARTITION BY category ORDER BY rating DESC, product_id ASC) AS INTEGER) AS crank "
    "FROM inv WHERE stock > 0) WHERE crank <= 6",
)
def category_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir).category_top()


@register(
    "candidates_purchased",
    _CANDIDATES_SQL + "SELECT DISTINCT user_id, category, product_id, stock, rating, purchased FROM candidates "
    "WHERE purchased IS NOT NULL",
)
def candidates_purchased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir).purchased_in_clicked()


# An inventory with many identical rows and several differing rows per product:
# each order line lists its part, with the part's stock and size as rating (the
# same on every line), or on returned lines one more than the size.
_LISTED = (
    "(SELECT p_partkey AS product_id, p_type AS category, p_size % 10 AS stock, "
    "p_size + (l_returnflag = 'R')::INTEGER AS rating FROM lineitem JOIN part ON p_partkey = l_partkey)"
)


@register(
    "topk_per_user_listed_twice",
    _candidates_sql(inventory=_LISTED)
    + f", ranked AS (SELECT {_CAND_COLS}, {_rank_sql('user_id', 'rating')} AS rn FROM candidates)\n"
    f"SELECT {_CAND_OUT}, rn FROM ranked WHERE rn <= 6",
)
def topk_per_user_listed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    recommender = rec.Recommender(td.clicks(spark, sf_dir), td.sales(spark, sf_dir), td.listed_inventory(spark, sf_dir))
    return _purchased_as_text(recommender.ranked("user"))


@register(
    "category_candidates",
    _CANDIDATES_SQL + f"SELECT {_CAND_OUT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_time, "
    "category ORDER BY purchased DESC NULLS LAST, rating DESC, product_id ASC) AS r FROM candidates) "
    "WHERE r <= 6",
)
def category_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six best candidates of each view and category. The listing without
    the cut is every view times its whole category, an all-pairs set that no
    later step reads; it is not built."""
    return _purchased_as_text(_recommender(spark, sf_dir).view_candidates())


@register("topk_per_user", "".join(_topk_user_sql("numeric")))
def topk_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchased_as_text(_recommender(spark, sf_dir).ranked("user"))


@register("topk_per_user_string_rating", "".join(_topk_user_sql("string")))
def topk_per_user_string_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchased_as_text(_recommender(spark, sf_dir, "string").ranked("user"))


@register("topk_per_view", "".join(_topk_view_sql()))
def topk_per_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchased_as_text(_recommender(spark, sf_dir).ranked("view"))


@register("recommend_user_rank", _recommend_user_sql())
def recommend_user_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir).recommend("user", "5 seconds")


@register("recommend_user_rank_string_rating", _recommend_user_sql("string"))
def recommend_user_rank_string_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir, "string").recommend("user", "5 seconds")


@register("recommend_user_rank_day", _recommend_user_sql("numeric", "1 day"))
def recommend_user_rank_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir).recommend("user", "1 day")


@register(
    "recommend_per_view",
    _topk_view_sql()[0] + "SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rn) "
    "AS top_product_ids, event_time FROM ranked WHERE rn <= 6 GROUP BY user_id, event_time",
)
def recommend_per_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir).recommend("view")


@register(
    "recommend_latest",
    "WITH rec AS (" + _recommend_user_sql() + ")\nSELECT user_id, arg_max(top_product_ids, event_time) "
    "AS top_product_ids, max(event_time) AS event_time FROM rec GROUP BY user_id",
)
def recommend_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(recommend_user_rank(spark, sf_dir), ["user_id"], ["event_time"])


@register(
    "recommend_csv",
    "WITH rec AS (" + _recommend_user_sql() + ")\nSELECT CAST(user_id AS VARCHAR) AS key, "
    "CAST(user_id AS VARCHAR) || ',' || CASE WHEN contains(top_product_ids, ',') "
    "THEN '\"' || top_product_ids || '\"' ELSE top_product_ids END || ',' || "
    "strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') AS value FROM rec",
)
def recommend_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_user_rank(spark, sf_dir).select(
        encode.recommendation_key().alias("key"), encode.recommendation_value().alias("value")
    )


@register("recommend_user_rank_bulk", _recommend_user_sql(purchases="sales_bulk"))
def recommend_user_rank_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir, bulk=True).recommend("user", "5 seconds")


@register("topk_per_user_unseen", "".join(_unseen_sql()))
def topk_per_user_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchased_as_text(_recommender(spark, sf_dir).ranked("user", repeat=False))


@register(
    "recommend_unseen",
    _unseen_sql()[0] + "SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rn) AS top_product_ids, "
    "time_bucket(INTERVAL '5 seconds', event_time) + INTERVAL '5 seconds' AS event_time FROM ranked "
    "WHERE rn <= 6 GROUP BY user_id, time_bucket(INTERVAL '5 seconds', event_time)",
)
def recommend_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommender(spark, sf_dir).recommend("user", "5 seconds", repeat=False)


# --------------------------------------------------------------------------
# Per view, with what came before it
# --------------------------------------------------------------------------

_BEFORE_SQL = _CANDIDATES_SQL.replace(
    "FROM owned WHERE owned.user_id = viewed.user_id AND owned.product_id = stocked.product_id",
    "FROM sales WHERE sales.user_id = viewed.user_id AND sales.product_id = stocked.product_id AND sales.purchase_time <= viewed.event_time",
)


@register(
    "topk_per_view_bought_before",
    _BEFORE_SQL + f", ranked AS (SELECT {_CAND_COLS}, {_rank_sql('user_id, event_time', 'rating', False)} AS rn FROM candidates)\n"
    f"SELECT {_CAND_OUT}, rn FROM ranked WHERE rn <= 6",
)
def topk_per_view_bought_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product counts as bought from its first purchase on."""
    return _purchased_as_text(history.ranked_bought_before(_recommender(spark, sf_dir)))


# view by view: of the view's candidates in order, the first six not shown before
_UNSEEN_VIEW_SQL = _CANDIDATES_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""", ordered AS (
  SELECT user_id, event_time, list({{'p': product_id, 'c': category, 's': stock, 'r': rating, 'b': purchased}}
         ORDER BY {_rank_sql('user_id, event_time', 'rating', False).split('ORDER BY ')[1].split(') AS INTEGER')[0]}) AS cands
  FROM candidates GROUP BY user_id, event_time
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time) AS n FROM ordered
), fold(user_id, n, event_time, picks, shown) AS (
  SELECT user_id, n, event_time, cands[1:6], cands[1:6] FROM numbered WHERE n = 1
  UNION ALL
  SELECT v.user_id, v.n, v.event_time, list_filter(v.cands, lambda x: NOT list_contains(f.shown, x))[1:6],
         list_concat(f.shown, list_filter(v.cands, lambda x: NOT list_contains(f.shown, x))[1:6])
  FROM fold f JOIN numbered v ON v.user_id = f.user_id AND v.n = f.n + 1
)
SELECT user_id, event_time, x.p AS product_id, x.c AS category, x.s AS stock, x.r AS rating, CAST(x.b AS VARCHAR) AS purchased, CAST(rn AS INTEGER) AS rn
FROM (SELECT user_id, event_time, unnest(picks) AS x, generate_subscripts(picks, 1) AS rn FROM fold)
"""


@register("topk_per_view_unseen", _UNSEEN_VIEW_SQL)
def topk_per_view_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No product twice for a user: each view takes the best six not yet shown."""
    return _purchased_as_text(history.ranked_unseen(_recommender(spark, sf_dir)))


@register(
    "topk_per_view_other_products",
    _CANDIDATES_SQL + ", others AS (SELECT * FROM candidates c WHERE NOT EXISTS (FROM clicks v WHERE v.user_id = c.user_id "
    "AND v.event_time = c.event_time AND v.product_id = c.product_id))\n"
    f", ranked AS (SELECT {_CAND_COLS}, {_rank_sql('user_id, event_time', 'rating', False)} AS rn FROM others)\n"
    f"SELECT {_CAND_OUT}, rn FROM ranked WHERE rn <= 6",
)
def topk_per_view_other_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six products per view besides the viewed ones."""
    return _purchased_as_text(history.ranked_excluding_viewed(_recommender(spark, sf_dir)))
