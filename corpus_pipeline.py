"""Training-corpus pipeline: raw documents to packed token sequences, in five stages.

Each stage is written as Parquet into the shared folder and reread as the next
one's documents, so a lost executor repeats at most its own tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.llm import ngram_join, packing, quality, secret_scan, toxicity
from loyalflow.llm.common import materialize, ship, table, unused


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject; all columns stay.

    Verdicts are joined back by row, so that ids that are null or stand on
    several texts keep the right ones.
    """
    columns, key = docs.columns, unused(docs, "row_key")
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text", "source"))
    kept = (quality.judge(rows, id_cols=("doc_id", key)).where("kept")
            .select(F.col("doc_id").alias("_id"), F.col(key).alias("_key")).distinct().hint("merge"))
    same = (rows[key] == kept["_key"]) & rows["doc_id"].eqNullSafe(kept["_id"])
    return rows.join(kept, same, "left_semi").select(*[rows[c] for c in columns])


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are predicted toxic; all columns stay."""
    ship(spark)
    return toxicity.clean_only(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near duplicates: that of the smallest id."""
    ship(spark)
    return ngram_join.one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; n_chars follows."""
    ship(spark)
    return secret_scan.redact(docs, secret_scan.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences of 2048 ids."""
    ship(spark)
    return packing.pack(materialize(packing.pieces(docs), "pieces"))


STAGES = [("quality rules", quality_rules), ("toxicity", toxicity_filter), ("near duplicates", near_duplicates),
          ("secret scans", secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained networks and tokenizers are no SQL; the operators' tests hold them against brute-force versions and the libraries.
ORACLE_SQL = None
