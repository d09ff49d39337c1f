from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from emporia.schemas import ENTITIES  # noqa: E402
from emporia.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def frame(spark, entity: str, rows: list[dict], money: str = "double"):
    """A DataFrame of an entity's final-table schema from partial dict rows."""
    schema = ENTITIES[entity].table
    fields = []
    for f in schema.fields:
        if money == "decimal" and f.name in ("price", "freight_value"):
            fields.append(T.StructField(f.name, T.DecimalType(18, 2), True))
        else:
            fields.append(f)
    schema = T.StructType(fields)
    data = []
    for r in rows:
        row = []
        for f in schema.fields:
            v = r.get(f.name)
            if money == "decimal" and f.name in ("price", "freight_value") and v is not None:
                v = Decimal(str(v))
            row.append(v)
        data.append(tuple(row))
    return spark.createDataFrame(data, schema)


def empty_tables(spark, money: str = "double") -> dict:
    return {e.final_name: frame(spark, e.name, [], money) for e in ENTITIES.values()}


__all__ = ["SF", "ts", "frame", "empty_tables"]
