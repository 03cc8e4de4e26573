"""Small tables for the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASHING = ("row", "text_key", "key_id", "key_text", "_id", "_key", "_copies", "drops", "lines", "lines_dropped", "leaf", "masked",
            "template", "fingerprint", "component", "shard", "start", "tokens", "length", "spans", "gone_id", "dotted.name")
WORDS = "the of and to in is it was for on are as with his they at be this from have or by one had not but what all were".split()


def documents(spark, rows: list[tuple]) -> DataFrame:
    """(doc_id, text[, lang]) rows with the clashing columns besides."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string")
    return df.select("doc_id", "text", "lang", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


def empty(spark) -> DataFrame:
    return documents(spark, [])


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ",", "."]) for _ in range(n))


def odd_rows(rnd: random.Random) -> list[tuple]:
    """Null and repeated ids, null, empty, blank, repeated and very long texts."""
    same = prose(rnd, 40)
    return [(1, prose(rnd, 60)), (2, None), (3, ""), (4, "  \n \t "), (5, same), (5, same), (6, same), (None, same), (None, prose(rnd, 30)),
            (None, None), (7, "\n".join(prose(rnd, 12) for _ in range(900))), (8, "x" * 60_000), (9, "ÄÖ ß  é 日本語 \U0001f600 a  b"), (10, "one")]
