from __future__ import annotations

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ratiolens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day_of(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


BLANK = {
    "period": "D",
    "usersource": "S",
    "bu": "B",
    "platform": "p1",
    "paycategory": "c1",
    "new_post_flag": "prepay",
    "paytype": "card",
    "label_a": "other",
    "amt": 0.0,
    "self_amt": 0.0,
    "self_amt_payonly": 0.0,
    "self_amt_refund": 0.0,
    "amt_payonly": 0.0,
    "cnt_payonly": 0,
    "self_cnt_payonly": 0,
    "card_cnt": 0,
    "nqh_cnt": 0,
    "quickpay_haveself_cnt_payonly": 0,
}


def make_fact(spark, rows):
    """A fact table from dictionaries; ``label_period`` also fills ``d`` unless given."""
    from ratiolens.sources.fact import FACT_SCHEMA

    full = []
    for row in rows:
        values = BLANK | row
        values.setdefault("d", values["label_period"])
        full.append(tuple(values[f.name] for f in FACT_SCHEMA.fields))
    return spark.createDataFrame(full, FACT_SCHEMA)
