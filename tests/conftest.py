from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session
from tidemark.sources.transactions import TRANSACTIONS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, app="tests", memory="6g")
    yield session
    session.stop()


def line(invoice, stock, qty, when, price, customer):
    ts = when if isinstance(when, datetime) else datetime.fromisoformat(when)
    return (invoice, stock, float(qty), ts, price, customer)


@pytest.fixture(scope="session")
def lines(spark):
    """Build a transaction table from tuples."""

    def make(rows):
        return spark.createDataFrame([line(*r) for r in rows], TRANSACTIONS)

    return make


# Customer 31 buys on both sides of the midpoint, returns one item and later only returns; 58 buys late, and again in
# the last hour of the outcome window.
SMALL = [
    ("7001", "mug", 3, "2009-12-24 09:15", 4.5, 31),
    ("7002", "lamp", 1, "2010-03-03 17:40", 22.25, 31),
    ("R7002", "lamp", -1, "2010-03-20 08:05", 22.25, 31),
    ("7003", "clock", 2, "2010-02-27 12:00", 9.0, 58),
    ("R7005", "mug", -2, "2010-05-02 10:00", 4.5, 31),
    ("7004", "mug", 1, "2010-07-31 23:30", 4.5, 58),
]


@pytest.fixture(scope="session")
def small(lines):
    return lines(SMALL)


def rows_of(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]
