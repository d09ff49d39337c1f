"""Raw CSV ingest (strict), extract-layer cleaning (lenient), constraints.

Rules 18-22 and the VARCHAR(n) limit.
"""

from __future__ import annotations

import pytest
from conftest import frame, ts
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from emporia.functions.casts import lenient, nullify_tokens, strict, strict_int_via_double
from emporia.operators import checks
from emporia.schemas import ENTITIES
from emporia.session import fresh_dir
from emporia.sources import raw_csv, staging


def _write_text(spark, header: list[str], rows: list[list[str]]) -> str:
    path = fresh_dir(spark, "raw") + "/file.csv"
    lines = [",".join(header)] + [",".join(r) for r in rows]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_rule18_strict_raises_lenient_gives_null(spark):
    df = spark.createDataFrame([("2018-01-02 03:04:05",), ("not a date",)], "t string")
    got = df.select(lenient("t", "timestamp_ntz").alias("x")).collect()
    assert got[0].x is not None and got[1].x is None
    with pytest.raises(Exception, match="cannot parse column t"):
        df.select(strict("t", "timestamp_ntz", "t")).collect()


def test_rule19_20_numbers(spark):
    df = spark.createDataFrame([("1.0", "01037"), ("x", "1037.0")], "item string, zip string")
    rows = df.select(
        lenient("item", "double").alias("item"), strict_int_via_double("zip", "zip").alias("zip")
    ).collect()
    assert [r.item for r in rows] == [1.0, None]
    assert [r.zip for r in rows] == [1037, 1037]


def test_rule21_null_tokens(spark):
    df = spark.createDataFrame([("",), ("NA",), ("NaN",), ("toys",), (None,)], "c string")
    got = [r.c for r in df.select(nullify_tokens("c").alias("c")).collect()]
    assert got == [None, None, None, "toys", None]


def test_ingest_matches_columns_by_header_and_types_them(spark):
    e = ENTITIES["seller"]
    # header order differs from the table's; an extra column is ignored
    path = _write_text(
        spark,
        ["seller_city", "extra", "seller_id", "seller_state", "seller_zip_code_prefix"],
        [["sao paulo", "x", "s1", "SP", "01037"], ["NA", "y", "s2", "RJ", "1037.0"]],
    )
    out = fresh_dir(spark, "src_seller")
    raw_csv.ingest(spark, path, e, out)
    rows = sorted(raw_csv.read_source(spark, out, e).collect())
    assert [tuple(r) for r in rows] == [("s1", 1037, "sao paulo", "SP"), ("s2", 1037, None, "RJ")]
    assert raw_csv.read_source(spark, out, e).schema == e.source


def test_ingest_rejects_bad_values(spark):
    e = ENTITIES["seller"]
    too_long = "x" * 30
    path = _write_text(spark, ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"], [["s1", "1", "c", too_long]])
    with pytest.raises(Exception, match="value too long for seller.seller_state"):
        raw_csv.ingest(spark, path, e, fresh_dir(spark, "bad"))
    path = _write_text(spark, ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"], [["s1", "", "c", "SP"]])
    with pytest.raises(Exception, match="missing value to integer"):
        raw_csv.ingest(spark, path, e, fresh_dir(spark, "bad"))


def test_item_line_number_is_text_in_source_and_double_after_cleaning(spark):
    e = ENTITIES["order_item"]
    header = [f.name for f in e.source.fields]
    row = ["o1", "1", "p1", "s1", "2018-01-02 00:00:00", "10.5", "1", "2018-01-01 10:00:00"]
    out = fresh_dir(spark, "src_item")
    raw_csv.ingest(spark, _write_text(spark, header, [row]), e, out)
    src = raw_csv.read_source(spark, out, e)
    assert src.first().order_item_id == "1.0"
    cleaned = staging.clean(src, e).first()
    assert cleaned.order_item_id == 1.0 and cleaned.price == 10.5


def test_rule22_required_null_fails_the_staging_load(spark):
    e = ENTITIES["customer"]
    df = frame(spark, "customer", [{"customer_id": "c1", "first_purchase_date": None}, {"customer_id": "c2"}])
    with pytest.raises(checks.ConstraintViolation) as err:
        staging.stage(spark, df, fresh_dir(spark, "stg"), e)
    assert ("first_purchase_date", "required", 2) in err.value.problems
    assert "first_purchase_date required: 2" in str(err.value)


def test_length_limit_is_reported(spark):
    e = ENTITIES["customer"]
    df = frame(spark, "customer", [{"customer_id": "c1", "customer_state": "x" * 30}])
    rows = {
        (r.column_name, r.check_name): r.violations
        for r in checks.violations(df, e.required, e.max_length).collect()
    }
    assert rows[("customer_state", "length>20")] == 1
    assert rows[("customer_id", "required")] == 0
    assert rows[("first_purchase_date", "required")] == 1


def test_require_inline_fails_the_consuming_job(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    with pytest.raises(PySparkException):
        checks.require_inline(df, ["k"], "t").collect()
    assert checks.require_inline(df.filter(F.col("k").isNotNull()), ["k"], "t").count() == 1


def test_failed_staging_load_leaves_staging_unchanged(spark):
    e = ENTITIES["orders"]
    path = fresh_dir(spark, "stg_atomic")
    good = frame(spark, "orders", [{"order_id": "a", "order_purchase_timestamp": ts("2018-03-09 10:00:00")}])
    staging.stage(spark, good, path, e)
    bad = frame(
        spark,
        "orders",
        [
            {"order_id": "b", "order_purchase_timestamp": ts("2018-03-09 11:00:00")},
            {"order_id": None, "order_purchase_timestamp": ts("2018-03-09 12:00:00")},
        ],
    )
    with pytest.raises(checks.ConstraintViolation) as err:
        staging.stage(spark, bad, path, e)
    assert ("order_id", "required", 1) in err.value.problems
    assert [r.order_id for r in staging.read_staging(spark, path, e).collect()] == ["a"]


def test_files_with_another_header_fail(spark):
    folder = fresh_dir(spark, "raw")
    for name, header in (("a", "seller_city,seller_state"), ("b", "seller_state,seller_city")):
        spark.createDataFrame([(header,), ("x,y",)], "value string").coalesce(1).write.text(f"{folder}/{name}")
    with pytest.raises(Exception, match="(?i)header"):
        raw_csv.read_raw(spark, f"{folder}/*").collect()


def test_quoted_raw_values(spark):
    path = fresh_dir(spark, "raw") + "/file.csv"
    text = 'seller_id,seller_city\ns1,"sao ""x"", paulo"\ns2,"two\nlines"\ns3, spaced '
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    got = {r.seller_id: r.seller_city for r in raw_csv.read_raw(spark, path).collect()}
    assert got == {"s1": 'sao "x", paulo', "s2": "two\nlines", "s3": " spaced "}
