"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents, whatever they are called
and in their order. Only doc_id, text and source must be there. An empty table goes through all stages and gives no rows; rows with a null key
or a null text, and rows that repeat a key, are treated as each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.llm import line_dedup, mixing, ngram_join, packing, quality, tokens
from clickledger.llm.common import drop_stored, kept, read, temporary
from clickledger.llm.registry import RANKS, TOKENIZER


def _recounted(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of documents, n_chars after the text has changed."""
    if "n_chars" in like.columns:
        df = df.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(like.schema["n_chars"].dataType))
    return df.select(like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, each row by its own text. A null or empty text has no words and goes."""
    return quality.judge(docs).where("kept").select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; a line found in several documents stays in the one with the smallest doc_id. Rows with a null doc_id keep their lines; a null text comes back empty."""
    return _recounted(line_dedup.dedup_lines(docs), docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, with all rows that repeat it. Texts without words and rows with a null doc_id stay."""
    groups = ngram_join.near_duplicates(docs, n=5, percent=80)
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as its draw says, in random order. Null is a source; rows that repeat a doc_id draw alike, null ones too; a source without bytes goes."""
    return mixing.mix(docs).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence. Each row is a document; an empty or null text is one piece of one id."""
    return packing.pack(docs, tokens.public_path(TOKENIZER), tokens.public_path(RANKS))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup_stage), ("ngram_jaccard_join", jaccard_join), ("mixing", mixing_stage), ("packing", packing_stage)]

#: Packing cuts token ids, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents. Each stage's result is written and read again, and the tables it made on its way are deleted."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        with temporary(spark):
            out = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if i:
            drop_stored(docs)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
