"""Corpus pipeline: quality rules, line dedup, near duplicates, benchmark
decontamination, packing.  Each stage is written and read again, works on all
its predecessor kept, and all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm.common import stage, table
from martkit.llm.decontaminate import drop_contaminated
from martkit.llm.jaccard_join import near_duplicates
from martkit.llm.line_dedup import drop_repeated_lines
from martkit.llm.packing import default_tokenizer, pack_texts, pieces_digest
from martkit.llm.quality import quality_filter

SHINGLE_WORDS = 5
SIMILARITY = 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated lines go; a text left without words goes."""
    out = drop_repeated_lines(docs)
    left = out.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group stays, one without an id only
    where no other has one.  Rows are told apart by a number of their own, so
    each goes or stays by its own text; of equal rows one stays."""
    row, taken = "_row", {c.lower() for c in docs.columns}
    while row in taken:  # a caller's column of that name stays as it is
        row += "_"
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(rows, key=row, words=SHINGLE_WORDS, threshold=SIMILARITY)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row)
    kept = found.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(kept.select(f"first.{row}"), row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces_digest(pack_texts(docs, default_tokenizer()))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
