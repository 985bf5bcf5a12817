from __future__ import annotations

import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from syncloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def values(df, *columns):
    """Rows as sorted tuples of plain values."""

    def plain(value):
        if isinstance(value, Decimal):
            return int(value) if value == value.to_integral_value() else float(value)
        return value

    chosen = df.select(*columns) if columns else df
    return sorted((tuple(plain(v) for v in row) for row in chosen.collect()), key=repr)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def frame(spark, rows, ddl):
    """A table of plain values; whole numbers serve for decimals too."""
    kinds = T.StructType.fromDDL(ddl).fields

    def typed(value, field):
        decimal = isinstance(field.dataType, T.DecimalType) and value is not None
        return Decimal(value) if decimal else value

    typed_rows = [tuple(typed(v, f) for v, f in zip(row, kinds)) for row in rows]
    return spark.createDataFrame(typed_rows, ddl)
