"""Line -> typed record parsers, as column expressions (no per-row Python).

Two decoders:

* ``split_fields``: the hand-rolled record constructors of the sales job. All
  double quotes are removed, the line is split on commas, fields are taken
  by position (extra fields are ignored, missing ones are an error) and
  numbers are read strictly: an optional sign and digits, no blanks, in
  range for the type.
* ``csv_fields``: a CSV-format table/topic (quoted fields honoured), the
  recommendation job's sources, via ``from_csv``. Its topics' fields are text.

Both take ``on_error``: ``fail`` raises on the first bad line, ``drop`` leaves
bad lines out, ``quarantine`` keeps them with null fields and the raw text in
``_corrupt_record``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas

ON_ERROR = ("fail", "drop", "quarantine")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_STRICT_INTEGER = r"^[+-]?[0-9]+$"


def _check_mode(on_error: str) -> None:
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")


def _apply_errors(df: DataFrame, ok: Column, typed: list[tuple[str, Column]], value_col: str,
                  carry: list[str], on_error: str, what: str) -> DataFrame:
    if on_error == "fail":
        # A filter is never pruned away, so the check runs even when a later
        # projection drops some of the parsed fields.
        guard = F.when(ok, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"malformed {what} record: "), F.coalesce(F.col(value_col), F.lit("(null)"))))
        )
        return df.where(guard).select(*carry, *[c.alias(n) for n, c in typed])
    if on_error == "drop":
        return df.where(ok).select(*carry, *[c.alias(n) for n, c in typed])
    return df.select(
        *carry,
        *[F.when(ok, c).alias(n) for n, c in typed],
        F.when(~ok, F.col(value_col)).alias("_corrupt_record"),
    )


def split_fields(
    lines: DataFrame,
    schema: T.StructType,
    value_col: str = "value",
    on_error: str = "fail",
    keep: list[str] | None = None,
    what: str = "",
    observe: str | None = None,
) -> DataFrame:
    """Positional split parser (quotes removed, comma split, strict numbers).

    ``observe`` names a Spark observed metric with the counts ``lines`` and
    ``malformed`` (a stream reports it with every batch's progress).
    """
    _check_mode(on_error)
    keep = list(keep or [])
    # Split once, as the output of a one-row explode. Catalyst pushes a filter
    # below a projection by inlining the projected expression at every
    # reference (here one per field check), and filter code does not share
    # common subexpressions; a generator's output cannot be inlined, so every
    # check below reads the same array attribute.
    split = F.split(F.translate(F.col(value_col), '"', ""), ",")
    lines = lines.select(*keep, F.col(value_col), F.explode(F.array(split)).alias("_fields"))
    parts = F.col("_fields")
    checks = [F.size(parts) >= len(schema.fields)]
    typed = []
    for i, field in enumerate(schema.fields):
        raw = F.get(parts, i)
        if isinstance(field.dataType, _INTEGRAL):
            value = raw.try_cast(field.dataType)
            checks.append(raw.rlike(_STRICT_INTEGER) & value.isNotNull())
        else:
            value = raw.cast(field.dataType)
            checks.append(raw.isNotNull())
        typed.append((field.name, value))
    ok = F.coalesce(reduce(lambda a, b: a & b, checks), F.lit(False))
    if observe:
        lines = lines.observe(observe, F.count(F.lit(1)).alias("lines"), F.count_if(~ok).alias("malformed"))
    return _apply_errors(lines, ok, typed, value_col, keep, on_error, what)


def csv_fields(
    lines: DataFrame,
    schema: T.StructType,
    value_col: str = "value",
    on_error: str = "drop",
    keep: list[str] | None = None,
    what: str = "",
    observe: str | None = None,
) -> DataFrame:
    """CSV-format decoder: ``from_csv`` with the declared schema.

    A line is malformed when a field does not convert, a field is missing or
    there are extra fields. Null and empty lines carry no record and are skipped.
    The whole line is always decoded and judged, whatever fields are used later.
    ``observe`` names a Spark observed metric with the counts ``lines``, ``empty``
    (skipped) and ``malformed``.
    """
    _check_mode(on_error)
    keep = list(keep or [])
    if observe:
        counts = [c.alias(n) for n, c in _line_counts(value_col).items()]
        decoded = _decoded(lines, schema, value_col, keep).observe(observe, *counts)
        decoded = decoded.where(~_empty(value_col))
    else:  # a filter before the decoder
        decoded = _decoded(lines.where(~_empty(value_col)), schema, value_col, keep)
    typed = [(f.name, F.col(f"_rec.{f.name}")) for f in schema.fields]
    return _apply_errors(decoded, F.col("_rec._corrupt_record").isNull(), typed, value_col, keep, on_error, what)


def _empty(value_col: str) -> Column:
    return F.coalesce(F.col(value_col) == "", F.lit(True))


def _line_counts(value_col: str) -> dict[str, Column]:
    empty = _empty(value_col)
    bad = ~empty & F.col("_rec._corrupt_record").isNotNull()
    return {"lines": F.count(F.lit(1)), "empty": F.count_if(empty), "malformed": F.count_if(bad)}


def _decoded(lines: DataFrame, schema: T.StructType, value_col: str, keep: list[str]) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl += ", `_corrupt_record` string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    # decoded once, as the output of a one-row explode (see ``split_fields``)
    record = F.explode(F.array(F.from_csv(F.col(value_col), ddl, options))).alias("_rec")
    return lines.select(*keep, F.col(value_col), record)


def line_counts(lines: DataFrame, schema: T.StructType, value_col: str = "value") -> dict[str, int]:
    """How many lines there are, how many ``csv_fields`` skips as empty and how
    many it calls malformed."""
    counts = [c.alias(n) for n, c in _line_counts(value_col).items()]
    return _decoded(lines, schema, value_col, []).agg(*counts).first().asDict()


def malformed_count(lines: DataFrame, schema: T.StructType, value_col: str = "value") -> int:
    """How many lines ``csv_fields`` would call malformed."""
    return line_counts(lines, schema, value_col)["malformed"]


# Record-specific shorthands.

def parse_sales(lines: DataFrame, value_col: str = "value", on_error: str = "fail",
                keep: list[str] | None = None, observe: str | None = None) -> DataFrame:
    return split_fields(lines, schemas.SALES, value_col, on_error, keep, what="sales", observe=observe)


def parse_products(lines: DataFrame, value_col: str = "value", on_error: str = "fail",
                   keep: list[str] | None = None) -> DataFrame:
    return split_fields(lines, schemas.PRODUCT, value_col, on_error, keep, what="product")


def decode_clicks(lines: DataFrame, value_col: str = "value", on_error: str = "fail",
                  keep: list[str] | None = None, observe: str | None = None) -> DataFrame:
    return csv_fields(lines, schemas.CLICK, value_col, on_error, keep, what="click", observe=observe)


def decode_sales(lines: DataFrame, value_col: str = "value", on_error: str = "fail",
                 keep: list[str] | None = None, observe: str | None = None) -> DataFrame:
    return csv_fields(lines, schemas.PURCHASE, value_col, on_error, keep, what="sale", observe=observe)


def decode_inventory(lines: DataFrame, value_col: str = "value", on_error: str = "drop",
                     keep: list[str] | None = None) -> DataFrame:
    return csv_fields(lines, schemas.INVENTORY, value_col, on_error, keep, what="inventory")


def to_line(fields: list[str], alias: str = "value") -> Column:
    """Comma-joined text of the given columns (the record's wire form)."""
    return F.concat_ws(",", *[F.col(c).cast("string") for c in fields]).alias(alias)
