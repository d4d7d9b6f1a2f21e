"""The corpus pipeline: quality classifier, fertility rules, near copies, packing.

STAGES are functions of (spark, docs, sf_dir). Each gets what its predecessor kept, written as Parquet
and read again; all but the last return the columns of documents. ORACLE_SQL is None: SQL can't
express the learned and the tokenising stages, so tests compare with a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.llm import fertility, ngramjoin, packing, quality
from tessella.llm.common import materialize, table, unused
from tessella.llm.queries import BYTE_RANKS, BYTE_SPECIAL, PIECES, trained_quality

#: a document of lower score goes
LEAST_QUALITY = 0.7


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on them and their labels, predicts to be good."""
    model, _ = trained_quality(docs, table(spark, sf_dir, "labels"))
    score = quality.quality_score(quality.statistics_of(F.col("text")), model, spark)
    name = unused(docs, "_score")
    return docs.withColumn(name, score).where(F.col(name) >= LEAST_QUALITY).drop(name)


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie within the fertility bands of their language."""
    name = unused(docs, "_verdict")
    return fertility.judge(docs, PIECES, verdict=name).where(F.col(f"{name}.kept")).drop(name)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.

    Documents link at a Jaccard similarity of 0.8 of their five-word shingles; those without words link
    with nothing and stay. Every row is a document of its own: rows that share an id stay both unless
    their texts link, and of rows without an id a group keeps one only if none of it has an id. Of rows
    with the same smallest id the one that was read first stays.
    """
    if docs.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        found = ngramjoin.jaccard_components(docs, words=5, percent=80)
        dropped = found.where("id <> component").select(F.col("id").alias("doc_id"))
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    row = unused(docs, "_row")
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = ngramjoin.jaccard_components(rows, words=5, percent=80, id_col=row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).getField(row).alias(row)
    kept = (rows.select("doc_id", row).join(found.select(F.col("id").alias(row), "component"), row)
            .groupBy("component").agg(first).select(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 2048 tokens."""
    return packing.pack(docs, BYTE_RANKS, special=BYTE_SPECIAL).withColumnRenamed("id", "doc_id")


STAGES = [("quality_classifier", classified), ("quality_rules", ruled), ("ngram_join", deduplicated),
          ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
