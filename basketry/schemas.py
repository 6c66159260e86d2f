"""Declared schemas of the retail records (never inferred).

The sales job reads typed records; its ids are widened to 64 bit, as at cluster
scale product and user ids exceed the 32-bit range the original records used.
The recommendation job declares every field as text: ids may be any text, and a
measure it does not use is never parsed.
"""

from pyspark.sql import types as T

# sale line: invoice_id,user_id,product_id,quantity,unit_cost
SALES_FIELDS = ["invoice_id", "user_id", "product_id", "quantity", "unit_cost"]
SALES = T.StructType(
    [
        T.StructField("invoice_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_cost", T.IntegerType()),
    ]
)

# product / inventory line: product_id,category,stock,rating
PRODUCT_FIELDS = ["product_id", "category", "stock", "rating"]
PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("stock", T.IntegerType()),
        T.StructField("rating", T.IntegerType()),
    ]
)



def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# the recommendation job's records, all text: click line (event_time comes from
# record metadata), sale line, inventory line
CLICK_FIELDS = ["user_id", "product_id"]
CLICK = _texts(CLICK_FIELDS)
PURCHASE = _texts(SALES_FIELDS)
INVENTORY = _texts(PRODUCT_FIELDS)

# sales by category result (the encoded message holds category and sales)
SALES_BY_CATEGORY = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("sales", T.LongType()),
    ]
)

# keyed recommendation record; user_id is the primary key
RECOMMENDATION = T.StructType(
    [
        T.StructField("user_id", T.StringType(), nullable=False),
        T.StructField("top_product_ids", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

# file-stream form of a message topic: the value text plus the record time
MESSAGE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
