"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before kept, written as Parquet and read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carryall.llm import decontaminate, packing, quality, simhash, substring
from carryall.sources.tables import fresh_path

# Pieces of text whose ids a worker keeps as it packs: a quarter of the usual, as the executor
# has grown in the stages before.
REMEMBERED = 150_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.7 or more; null and empty texts are scored too."""
    return quality.of_quality(docs, _table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of every SimHash component; rows without doc_id all stay."""
    return simhash.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words that repeat an earlier one; those with no word left go, texts without words stay."""
    return substring.without_repeats(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth are benchmark passages."""
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    return packing.pack(docs, remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_copies),
    ("substrings", without_repeated_passages),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: SimHash and subword ids cannot be expressed in SQL: tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage's result is a table in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
