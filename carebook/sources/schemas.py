"""Explicit schemas of the tables the jobs read.

The diary and its register are read with a fixed ``StructType`` (no inference,
no footer sampling on many files, and the streaming file source needs one).
The physical column names are those of the stand-in tables:

==============  ============  ==============================================
domain noun     table         columns used
==============  ============  ==============================================
diary entry     ``events``    event_id, ts, user_id (person), event_type
                              (kind of care), value (amount), props (JSON)
person          ``customer``  c_custkey, c_name, c_nationkey (district)
district        ``nation``    n_nationkey, n_name, n_regionkey (area)
area            ``region``    r_regionkey, r_name
visit           ``orders``    o_orderkey, o_custkey (person), o_orderdate
service line    ``lineitem``  l_orderkey (visit), l_suppkey (worker), l_quantity
social worker   ``supplier``  s_suppkey, s_name, s_nationkey (district)
==============  ============  ==============================================
"""

from __future__ import annotations

from pyspark.sql import types as T

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])

NATION = T.StructType([
    T.StructField("n_nationkey", T.IntegerType()),
    T.StructField("n_name", T.StringType()),
    T.StructField("n_regionkey", T.IntegerType()),
])

REGION = T.StructType([
    T.StructField("r_regionkey", T.IntegerType()),
    T.StructField("r_name", T.StringType()),
])

ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])

LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])

SUPPLIER = T.StructType([
    T.StructField("s_suppkey", T.LongType()),
    T.StructField("s_name", T.StringType()),
    T.StructField("s_nationkey", T.IntegerType()),
    T.StructField("s_acctbal", T.DoubleType()),
])

SCHEMAS = {
    "events": EVENTS,
    "customer": CUSTOMER,
    "nation": NATION,
    "region": REGION,
    "orders": ORDERS,
    "lineitem": LINEITEM,
    "supplier": SUPPLIER,
}

# Fixed-size domain. Districts (with their areas) are a closed list for the
# region (the stand-ins have 25 districts in 5 areas); this bound is what makes
# broadcasting them safe at any data size. It is checked, not assumed.
MAX_DISTRICTS = 10_000

# Kinds of care an entry records (fixed list; the pivot report has one column each).
ENTRY_KINDS = ["click", "error", "purchase", "signup", "view"]
