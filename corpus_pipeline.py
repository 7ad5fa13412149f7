"""The corpus pipeline: quality rules, near-duplicate removal, personal data, source mixing, packing.

Each stage takes the documents its predecessor kept and returns documents; the last returns the packed pieces. Rows, not
ids, are what stages keep: null and repeated ids are separate documents. Empty tables give empty tables; further columns
stay as they are, whatever their names; very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import jaccard_join, mixing, packing, pii, quality
from harborline.llm.common import few, numbered, table, written

ROW, TIMES, TIME = "__row__", "__times__", "__time__"  # names that no table of documents has


def columns_of(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows but for the dropped ones; these are few and travel to the rows, texts stay where they are (beyond a count, both are shuffled)."""
    return rows.join(few(written(dropped, "dropped")), ROW, "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose perplexity lies in their language's band; null and empty texts fail."""
    rows = numbered(docs, ROW)
    failed = quality.rules(rows.withColumn("doc_id", F.col(ROW))).where("not kept").select(F.col("doc_id").alias(ROW))
    return without(rows, failed).select(*columns_of(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts: the one with the smallest id; of equal ids, one row; null ids come last.

    Five-word shingles, Jaccard similarity 0.8 or more. Texts without words link with nothing and stay.
    """
    rows = numbered(docs, ROW)
    groups = jaccard_join.join(rows.withColumn("doc_id", F.col(ROW)), k=5, percent=80).select(F.col("doc_id").alias(ROW), "component_id")
    several = groups.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1")
    named = groups.join(several.select("component_id"), "component_id").join(rows.select(ROW, "doc_id"), ROW)
    named = written(named, "groups")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("first")).select(F.col(f"first.{ROW}").alias(ROW))
    return without(rows, named.select(ROW).join(first, ROW, "left_anti")).select(*columns_of(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every personal span replaced by its kind; n_chars follows the text; null texts stay null."""
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(*columns_of(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, none to CAP times."""
    rows = numbered(docs, ROW)
    copies = mixing.mix(rows, carry=(ROW,)).where("copies > 0").select(ROW, F.col("copies").cast("int").alias(TIMES))
    each = rows.join(few(written(copies, "copies")), ROW)
    return each.withColumn(TIME, F.explode(F.sequence(F.lit(1), F.col(TIMES)))).select(*columns_of(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix_sources", mix_sources), ("packing", pack)]

#: Perplexity, exact similarity, the field and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
