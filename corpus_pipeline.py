"""A corpus pipeline of five of the operators: each stage takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontaminate, jaccard, lines, quality
from tidemark.llm.common import table, uncarried, written

#: The near-duplicate stage: shingles of five words, similarity of 80 per cent or more.
NEAR_WORDS, NEAR_LINK = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among docs, gives a score under the threshold go."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, weights, score_col="_score").where(F.col("_score") >= quality.THRESHOLD).drop("_score")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later runs of repeated lines, and later copies of single long lines, go from the texts; a document of which nothing else stays goes."""
    out = lines.dedup_lines(docs, carry=True, long_line=lines.LONG, contexts=True)
    return counted(uncarried(out.where("n_removed = 0 or trim(text) <> ''"), docs))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The lowest id of each group of near-duplicates stays; documents with a null id stay."""
    gone = jaccard.near_documents(docs, NEAR_WORDS, NEAR_LINK).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go from the texts; a document that is mostly such goes."""
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return counted(uncarried(out, docs))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(docs)


def counted(docs: DataFrame) -> DataFrame:
    """n_chars of the new texts."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", drop_near),
    ("decontamination", drop_benchmark),
    ("byte_bpe", to_tokens),
]
#: The first stage is a trained model, so SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
