from __future__ import annotations

import datetime as dt
import os
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"
CHECK_DIR = "/root/testdata/sf0.01"

EVENTS_ARROW = pa.schema([
    ("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
    ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string()),
])
CUSTOMER_ARROW = pa.schema([
    ("c_custkey", pa.int64()), ("c_name", pa.string()), ("c_nationkey", pa.int32()),
    ("c_acctbal", pa.float64()), ("c_mktsegment", pa.string()),
])


@pytest.fixture(scope="session")
def spark():
    from carebook.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="carebook-tests")
    yield s
    s.stop()


def write_events(folder, rows: list[tuple], name: str = "events.parquet") -> str:
    """Write made-up diary entries (event_id, ts, user_id, event_type, value, props)."""
    os.makedirs(folder, exist_ok=True)
    cols = list(zip(*rows)) if rows else [[] for _ in EVENTS_ARROW]
    table = pa.Table.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(cols, EVENTS_ARROW)],
                                 schema=EVENTS_ARROW)
    path = os.path.join(str(folder), name)
    pq.write_table(table, path)
    return path


def write_customers(folder, keys: list[int], nation: int = 0) -> str:
    os.makedirs(folder, exist_ok=True)
    table = pa.Table.from_pylist(
        [{"c_custkey": k, "c_name": f"person {k}", "c_nationkey": nation, "c_acctbal": 0.0,
          "c_mktsegment": "x"} for k in keys], schema=CUSTOMER_ARROW)
    path = os.path.join(str(folder), "customer.parquet")
    pq.write_table(table, path)
    return path


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)
