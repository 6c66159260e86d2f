"""Record encoders for the sinks: JSON messages and CSV key/value text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the millisecond timestamp text of the keyed CSV records.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def json_value(*fields: str) -> Column:
    """One JSON object per row holding the named fields, in the given order."""
    return F.to_json(F.struct(*[F.col(f) for f in fields]))


def csv_value(*fields: str) -> Column:
    """CSV text of the named fields; a field holding a comma is quoted."""
    options = {
        "timestampFormat": CSV_TIMESTAMP_FORMAT,
        "timestampNTZFormat": CSV_TIMESTAMP_FORMAT,
    }
    return F.to_csv(F.struct(*[F.col(f) for f in fields]), options)


def sales_by_category_json() -> Column:
    """The sales-by-category message: ``{"category": ..., "sales": ...}``."""
    return json_value("category", "sales")


def recommendation_key() -> Column:
    return csv_value("user_id")


def recommendation_value() -> Column:
    """All fields, key included: ``user_id,"p1,p2,...",event_time``."""
    return csv_value("user_id", "top_product_ids", "event_time")
