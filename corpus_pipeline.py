"""The corpus pipeline: documents in, encoded documents out, stage by stage.

Every stage works on all that the one before it kept, and is written as
Parquet in the cluster's shared folder and read back, so a lost executor costs
at most its part of one stage; what a stage wrote on the way is deleted once its
result is there. All stages but the last return the columns of
their input. Limits are those of the operators' contracts.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botsieve.llm import bpe, decontaminate, pii, simhash, toxicity
from botsieve.llm.common import only_result, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity limit, learned from ``labels``."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate group."""
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose share of benchmark passages stays below the limit, and
    without the passages of at least ``MAX_SPAN`` words (n_chars follows)."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), max_span=decontaminate.MAX_SPAN, chars="n_chars")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind (n_chars follows)."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, and their count."""
    encoded = docs.select("doc_id", "lang", "source", bpe.encode_column(bpe.vocabulary(spark), "text").alias("e"))
    return encoded.selectExpr("doc_id", "lang", "source", "cast(size(e.ids) AS bigint) AS n_tokens", "e.ids AS ids",
                              "e.decoded AS decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("bpe_encoding", encode_tokens),
]

# Trained weights, a suffix automaton and BPE merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = only_result(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
