"""Entry attributes of any shape, and a table function."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.functions.columns import day_of
from carebook.session import fresh_dir
from carebook.sources.tables import Tables

FAULTS = ("malformed", "missing", "not_object")
ROTA = "carebook_rota"

_TYPES = {"VOID": "null", "BOOLEAN": "boolean", "STRING": "string", "OBJECT": "object", "ARRAY": "array"}  # any other: number


def profile(rows: DataFrame, column: str) -> DataFrame:
    """What a JSON text column holds: one row per ``part`` and attribute.

    ``part`` is ``attribute`` for each key of the outermost objects, with ``entries``
    (rows that have it), ``distinct_values`` (by JSON text; a null is a value) and
    ``types`` (sorted, comma-joined). The parts ``malformed``, ``missing`` (null) and
    ``not_object`` (valid JSON that is no object) always have a row, with
    ``entries`` alone. A text that repeats a key in one object is malformed. Nested
    objects and arrays are values.

    One scan: rows become (attribute, value) pairs and are counted per distinct pair in
    every task before the shuffle, so an attribute that all rows have is no hot key.
    """
    text = F.col(column).cast("string")
    parsed = rows.select(text.alias("_text"), F.try_parse_json(text).alias("_json"))
    kind = F.regexp_extract(F.schema_of_variant("_json"), "^[A-Z]+", 0)
    part = (F.when(F.col("_text").isNull(), "missing").when(F.col("_json").isNull(), "malformed")
            .when(kind == "OBJECT", "attribute").otherwise("not_object"))
    told = parsed.select(part.alias("part"), "_json").withColumn("_json", F.when(F.col("part") == "attribute", F.col("_json")))
    pairs = told.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("_json").outer()))
    value_kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    types = F.coalesce(F.create_map(*[F.lit(x) for pair in _TYPES.items() for x in pair])[value_kind], F.lit("number"))
    counted = (pairs.where((F.col("part") != "attribute") | F.col("key").isNotNull())
               .select("part", F.col("key").alias("attribute"), F.when(F.col("key").isNotNull(), F.to_json("value")).alias("_value"),
                       F.when(F.col("key").isNotNull(), types).alias("_type"))
               .groupBy("part", "attribute", "_value", "_type").agg(F.count(F.lit(1)).alias("_n")))
    none = rows.sparkSession.sql("SELECT part, 0L AS _n FROM VALUES " + ", ".join(f"('{p}')" for p in FAULTS) + " AS t(part)")
    return (counted.unionByName(none, allowMissingColumns=True).groupBy("part", "attribute")
            .agg(F.sum("_n").alias("entries"), F.count("_value").alias("distinct_values"),
                 F.array_join(F.array_sort(F.collect_set("_type")), ",").alias("types")))


def attribute_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every attribute in ``props``: entries, distinct values and types; and entries whose ``props`` are
    missing, malformed or no object."""
    return profile(Tables(spark, sf_dir).events, "props")


def create_rota(spark: SparkSession, name: str = ROTA) -> str:
    """Define the table function ``name(worker, first_day, last_day)`` in this session, and return its name.

    It gives a row for every working day (Monday to Friday) of the worker in
    [first_day, last_day]: ``worker_id``, ``day``. A null argument or a last day before the first
    gives none. Written in SQL, so its rows are made by Spark's own operators; call
    it from SQL text (``SELECT * FROM name(7, DATE'2024-01-01', DATE'2024-01-31')``)
    or laterally per row of a table.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(worker BIGINT, first_day DATE, last_day DATE)
        RETURNS TABLE (worker_id BIGINT, day DATE)
        RETURN SELECT worker, d.day
               FROM explode(CASE WHEN first_day <= last_day THEN sequence(first_day, last_day) END) AS d(day)
               WHERE worker IS NOT NULL AND weekday(d.day) < 5
    """)
    return name


def worker_rota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each worker's working days from the first day of their first visit's month to the last day of their last one's.

    A worker's visits are those with a service line of theirs. Lines are reduced
    to one first and last date per worker in every task before the shuffle.
    """
    t = Tables(spark, sf_dir)
    lines = t.lineitem.where(F.col("l_suppkey").isNotNull()).select("l_orderkey", "l_suppkey")
    dated = lines.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    spans = dated.groupBy("l_suppkey").agg(F.min(day_of("o_orderdate")).alias("_first"), F.max(day_of("o_orderdate")).alias("_last"))
    spans = spans.select("l_suppkey", F.trunc("_first", "month").alias("first_day"), F.last_day("_last").alias("last_day"))
    path = fresh_dir(spark, "worker-spans")  # one row a worker; a lateral join reads its outer side more than once
    spans.write.parquet(path)
    view = f"carebook_spans_{uuid.uuid4().hex}"
    spark.read.schema(spans.schema).parquet(path).createOrReplaceTempView(view)
    return spark.sql(f"SELECT r.worker_id AS l_suppkey, r.day FROM {view}, LATERAL {create_rota(spark)}(l_suppkey, first_day, last_day) AS r")
