import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import encode, parse
from basketry.sources import files

GOOD = '"7",3,12,2,450'
BAD = ["x,3,12,2,450", "7,3,12", "7,3,12,,", " 7,3,12,2,450", "7,3,99999999999,2,450x"]
EXTRA = "7,3,12,2,450,9"


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_ok_removes_quotes(spark):
    row = parse.parse_sales(lines(spark, [GOOD])).collect()[0]
    assert tuple(row) == (7, 3, 12, 2, 450)


def test_extra_field_is_ignored(spark):
    row = parse.parse_sales(lines(spark, [EXTRA])).collect()[0]
    assert tuple(row) == (7, 3, 12, 2, 450)


@pytest.mark.parametrize("bad", BAD)
def test_fail_mode_raises(spark, bad):
    with pytest.raises((PySparkException, Py4JJavaError)):
        parse.parse_sales(lines(spark, [GOOD, bad]), on_error="fail").collect()


def test_fail_mode_raises_even_when_fields_are_pruned(spark):
    # unit_cost is bad and never selected: the record still fails, as the
    # constructor would have thrown.
    df = parse.parse_sales(lines(spark, ["7,3,12,2,x"]), on_error="fail").select("product_id")
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.collect()


def test_drop_mode(spark):
    out = parse.parse_sales(lines(spark, [GOOD, *BAD, EXTRA]), on_error="drop").collect()
    assert [r.invoice_id for r in out] == [7, 7]


def test_quarantine_mode_keeps_raw_line(spark):
    out = parse.parse_sales(lines(spark, [GOOD, *BAD]), on_error="quarantine").collect()
    assert len(out) == 1 + len(BAD)
    bad = [r for r in out if r._corrupt_record is not None]
    assert sorted(r._corrupt_record for r in bad) == sorted(BAD)
    assert all(r.invoice_id is None for r in bad)


def test_products_parse(spark):
    row = parse.parse_products(lines(spark, ['5,"toys",17,1'])).collect()[0]
    assert tuple(row) == (5, "toys", 17, 1)


def test_csv_decoder_modes(spark):
    df = lines(spark, ["7,3", "x,3", "7", "7,3,9", ""])
    assert [tuple(r) for r in parse.decode_clicks(df, on_error="drop").collect()] == [("7", "3"), ("x", "3")]
    assert parse.malformed_count(df, schemas.CLICK) == 2
    q = parse.decode_clicks(df, on_error="quarantine").collect()
    assert len(q) == 4 and sum(r._corrupt_record is not None for r in q) == 2
    with pytest.raises((PySparkException, Py4JJavaError)):
        parse.decode_clicks(df).collect()
    # the line is judged even if no field of it is used
    with pytest.raises((PySparkException, Py4JJavaError)):
        parse.decode_clicks(df).count()


def test_text_ids_and_unparsed_measures(spark):
    clicks = parse.decode_clicks(lines(spark, ["u7,p1"])).collect()
    assert [tuple(r) for r in clicks] == [("u7", "p1")]
    sales = parse.decode_sales(lines(spark, ["i1,u7,p1,many,9.99"])).collect()
    assert [(r.user_id, r.product_id, r.unit_cost) for r in sales] == [("u7", "p1", "9.99")]


def test_csv_table_has_the_same_rows_for_any_projection(spark, tmp_path):
    path = tmp_path / "inventory.csv"
    path.write_text('1,a,5,3\n2,"b, c",x,9\n3,a,4\n4,a,1,1,1\n\n5,"d, e",2,2\n')
    for projection in (["*"], ["product_id", "category"], ["category"]):
        got = files.csv_table(spark, str(path), schemas.PRODUCT, on_error="drop").select(*projection)
        assert got.count() == 2 and len(got.collect()) == 2
    table = files.csv_table(spark, str(path), schemas.PRODUCT, on_error="drop")
    assert [tuple(r) for r in table.collect()] == [(1, "a", 5, 3), (5, "d, e", 2, 2)]
    quarantined = files.csv_table(spark, str(path), schemas.PRODUCT, on_error="quarantine")
    assert quarantined.count() == 5 and quarantined.where("_corrupt_record is not null").count() == 3
    for projection in (["*"], ["product_id"]):
        with pytest.raises((PySparkException, Py4JJavaError)):
            files.csv_table(spark, str(path), schemas.PRODUCT, on_error="fail").select(*projection).collect()


def test_unknown_mode_rejected(spark):
    with pytest.raises(ValueError):
        parse.parse_sales(lines(spark, [GOOD]), on_error="skip")


def test_csv_list_is_quoted(spark):
    df = spark.createDataFrame([(7, "1,2,3"), (8, "4")], "user_id long, top_product_ids string")
    out = [r[0] for r in df.select(encode.csv_value("user_id", "top_product_ids")).collect()]
    assert out == ['7,"1,2,3"', "8,4"]


def test_json_message(spark):
    df = spark.createDataFrame([("toys", 5)], "category string, sales long")
    assert df.select(encode.sales_by_category_json()).collect()[0][0] == '{"category":"toys","sales":5}'


def test_round_trip_line(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "invoice_id long, user_id long, product_id long, quantity long, unit_cost int")
    back = parse.parse_sales(df.select(parse.to_line(["invoice_id", "user_id", "product_id", "quantity", "unit_cost"])))
    assert tuple(back.collect()[0]) == (1, 2, 3, 4, 5)
    assert F is not None


def test_empty_lines_are_counted_apart(spark):
    rows = [("1,2",), ("",), (None,), ("1",), ("1,2,3",)]
    lines = spark.createDataFrame(rows, "value string")
    assert parse.line_counts(lines, schemas.CLICK) == {"lines": 5, "empty": 2, "malformed": 2}
    assert parse.malformed_count(lines, schemas.CLICK) == 2
    got = parse.decode_clicks(lines, on_error="drop", observe="seen")
    assert [tuple(r) for r in got.collect()] == [("1", "2")]
    # the strict parser names a null line in its error
    with pytest.raises(Exception, match=r"malformed sales record: \(null\)"):
        parse.parse_sales(lines.where("value is null")).collect()
