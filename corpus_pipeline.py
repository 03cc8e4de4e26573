"""The corpus pipeline over the ``documents`` table.

``STAGES`` lists the stages in order; each is called with the session, the rows
that its predecessor kept and the input folder, and its rows are written as
Parquet and read again before the next one. All but the last return the columns
of ``documents``.

Every stage takes any rows of these columns: a null text is kept or dropped as the
stage says, texts of any length are read whole, rows with a null or repeated
doc_id are rows of their own (told apart by their text, so rows that agree in both
share their fate), an empty table gives an empty one, and columns besides
``doc_id`` and ``text`` (``lang`` for the first stage) are carried, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.llm import decontaminate, language, line_templates, packing, simhash
from carebook.llm.common import table
from carebook.llm.queries import TOKENIZER
from carebook.session import fresh_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: documents that it rejects go.

    Null texts and texts without a letter go. If no document is labelled with a
    language, there is nothing to judge by and all others stay.
    """
    return language.accepted(docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line deduplication: lines whose template an earlier document has go, and
    documents of which nothing but blank lines is left. ``n_chars`` follows the text."""
    found = line_templates.deduplicated(docs)
    emptied = (F.col("lines_dropped") > 0) & (F.trim(F.translate("text", "\n", " ")) == "")
    left = found.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("lines_dropped") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
        left = left.withColumn("row", F.col("row").withField("n_chars", length.cast(kind)))
    return line_templates.as_documents(left, docs.columns)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates (3-word shingles, at most 2 differing bits): one document of each group stays.

    Texts without a word have fingerprint zero and are one group.
    """
    return simhash.one_per_component(docs, shingle=3, max_distance=2)


def no_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a copy of an item go. A null text holds none; without items all stay."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: one row per sequence, with its ids. A null text is the empty one: its end id alone."""
    return packing.pack(docs, TOKENIZER, end_id=1, max_length=2048)


STAGES = [
    ("language", known_language),
    ("line_templates", fresh_lines),
    ("simhash", no_near_copies),
    ("decontamination", no_test_items),
    ("packing", packed),
]

# Language models, fingerprints, alignment and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = fresh_dir(spark, f"llm-stage-{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
