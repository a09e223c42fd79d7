"""From raw documents to packed training sequences, one operator after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulback.llm.jaccard_join import one_of_each
from haulback.llm.language_id import keep_identified, train_dictionaries
from haulback.llm.line_dedup import dedup_lines
from haulback.llm.mixing import mixed
from haulback.llm.packing import pack
from haulback.llm.tables import documents
from haulback.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language compression tells."""
    return keep_identified(docs, train_dictionaries(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that a smaller doc_id holds."""
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least 0.8 of its shingles of five words."""
    return one_of_each(docs, size=5, num=80, den=100)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; those taken twice are two rows."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the training sequence each goes to."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each written and read again before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Compression and tokenizing can't be expressed in SQL.
ORACLE_SQL = None
