"""CSV in byte ranges against pandas and Spark's own reader."""

from __future__ import annotations

import os
import random
from contextlib import ExitStack

import pandas as pd
import pytest
from pyspark.sql import types as T

from emporia.operators.catalog import setting
from emporia.schemas import ENTITIES
from emporia.sources import csv_ranges, raw_csv

COLUMNS = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


@pytest.fixture
def small_ranges(spark):
    with ExitStack() as stack:
        stack.enter_context(setting(spark, "spark.sql.files.maxPartitionBytes", "700"))
        stack.enter_context(setting(spark, "spark.sql.files.openCostInBytes", "10"))
        yield


def _value(rng):
    kinds = ["plain", 'a "b" c', "line\nbreak", ", comma", "\n\n", "  spaces ", " é\r\nx", '"', '""\n""', "y" * rng.randrange(2, 60), ""]
    return rng.choice(kinds)


def _write(folder, files, rows, seed, crlf=False):
    rng, expected = random.Random(seed), []
    for n in range(files):
        data = [[_value(rng), str(i), _value(rng) + ("\n" * 2500 if i == rows // 2 else "")] for i in range(rows)]
        pd.DataFrame(data, columns=list("abc")).to_csv(f"{folder}/f{n}.csv", index=False, lineterminator="\r\n" if crlf else "\n")
        expected += data
    return expected


def _rows(df):
    return sorted([x or "" for x in r] for r in df.collect())


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
@pytest.mark.parametrize("crlf", [False, True])
def test_ranges_equal_what_was_written(spark, small_ranges, tmp_path, max_bytes, crlf):
    expected = _write(tmp_path, 2, 150, 3, crlf)
    got = csv_ranges.read(spark, str(tmp_path), COLUMNS, raw_csv.CSV_QUOTING, max_bytes=max_bytes)
    assert _rows(got) == sorted(expected)
    lines = csv_ranges._lines(spark, str(tmp_path), None)
    assert lines.select("file", "range").distinct().count() > 15  # a value spans several whole ranges


def test_read_raw_equals_pandas_and_the_whole_file_reader(spark, small_ranges, tmp_path):
    _write(tmp_path, 1, 200, 9)
    path = f"{tmp_path}/f0.csv"
    expected = sorted(pd.read_csv(path, dtype=str, keep_default_na=False).values.tolist())
    assert _rows(raw_csv.read_raw(spark, path)) == expected
    whole = spark.read.options(**raw_csv.CSV_QUOTING).option("header", True).option("multiLine", True).csv(path)
    assert _rows(whole) == expected
    assert raw_csv.read_raw(spark, path).columns == ["a", "b", "c"]


def _one(spark, tmp_path, text):
    with open(f"{tmp_path}/x.csv", "w", newline="") as f:
        f.write(text)
    return [tuple(r) for r in csv_ranges.read(spark, f"{tmp_path}/x.csv", COLUMNS, raw_csv.CSV_QUOTING).collect()]


def test_odd_files(spark, tmp_path):
    assert _one(spark, tmp_path, "a,b,c\n") == [] and _one(spark, tmp_path, "a,b,c") == []
    assert _one(spark, tmp_path, "") == []
    assert _one(spark, tmp_path, '﻿a,"b",c\r\n1,2,3\r\n\r\n4,,"6\r\n"') == [("1", "2", "3"), ("4", None, "6\r\n")]
    for text, message in (
        ("a,b,x\n1,2,3\n", "header does not match"),
        ("a,b\n1,2\n", "header does not match"),
        ('a,b,c\n1,"2,3\n', "don't pair up"),
        ("a,b,c\n1,2\n", "(?i)malformed"),
        ("a,b,c\n1,2,3,4\n", "(?i)malformed"),
    ):
        with pytest.raises(Exception, match=message):
            _one(spark, tmp_path, text)


def test_ingest_can_skip_counting_quotes(spark, tmp_path):
    e = ENTITIES["seller"]
    with open(f"{tmp_path}/raw_seller.csv", "w") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01037,x,SP\n")
    for multi_line in (True, False):
        out = f"{tmp_path}/out-{multi_line}"
        raw_csv.ingest(spark, f"{tmp_path}/raw_seller.csv", e, out, multi_line=multi_line)
        assert [tuple(r) for r in raw_csv.read_source(spark, out, e).collect()] == [("s1", 1037, "x", "SP")]
    assert os.path.exists(f"{tmp_path}/out-True/_current")
