"""A corpus pipeline of five stages, from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes every stage's rows as Parquet in the shared folder and
reads them back as the next one's documents. All but the last stage return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from locuspark.llm.common import materialise, own_run, quoted, sweep
from locuspark.llm.line_dedup import dedup_lines
from locuspark.llm.packing import pack_documents
from locuspark.llm.quality_rules import keep_by_rules
from locuspark.llm.simhash import near_duplicates
from locuspark.llm.substring_dedup import dedup_substrings
from locuspark.shipping import ship


def _own(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` by their exact names; what an operator adds never takes one of these."""
    return [quoted(c) for c in docs.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. A null or empty text has too few words and goes; repeated rows stay or go alike."""
    return keep_by_rules(docs)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five documents or more stay in the one with the largest id only. No row goes; a null text becomes the empty one."""
    return dedup_lines(docs).select(*_own(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id stays, a null id last, of rows that repeat it one. Texts without a word are one group."""
    return near_duplicates(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words within windows that occur again go from all texts. No row goes; a null text becomes the empty one; repeated rows lose all windows they share."""
    return dedup_substrings(docs).select(*_own(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins. Every row is packed, one with an empty or null text as its end mark; columns other than id, text and source are not read."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_common_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("best-fit packing", pack),
]

#: SimHash needs XXH64 with a seed and packing a sequential search; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. An empty table gives an empty result; extra columns pass through up to the last stage, whatever their names."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with own_run(spark, "pipeline") as tables:
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            sweep(spark, tables, docs)  # what the stage and its predecessor wrote
    return docs
