from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
T0 = datetime(2026, 1, 1, 9, 0, 0, tzinfo=timezone.utc)
RULE_SCHEMA = (
    "idempotency_key string, account_id string, amount_cents bigint, "
    "merchant_category string, city string, occurred_at timestamp"
)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        8,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def sf_dir():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables are not here")
    return SF_SMALL


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def txn(key="k", account="acct-1", amount=1000, category="5814", seconds=0.0, city=None):
    return (key, account, amount, category, city, at(seconds))


def frame(spark, rows, schema=RULE_SCHEMA):
    return spark.createDataFrame(rows, schema)
