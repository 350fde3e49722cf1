"""A training-corpus pipeline over ``documents``: five stages, each over all that its predecessor kept.

toxicity -> near-duplicates -> benchmark decontamination -> secrets -> BPE.  All but the last return the columns
of ``documents``; the last returns the encoded documents.  Every stage is judged on its own
input, rows with null texts included (they are clean, link with nothing and encode to no tokens).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import odd_minhash, secret_forest, simhash_decontam, toxicity_ssk, trie_bpe
from tessera.llm.common import stored, table
from tessera.llm.queries import BPE_VOCABULARY


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more by the string-kernel machine go."""
    model = toxicity_ssk.train(docs, table(spark, sf_dir, "labels").where(~toxicity_ssk.held_out()))
    return toxicity_ssk.keep_clean(docs, model, 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at similarity 0.8 of 5-word shingles, the document with the smallest id stays."""
    found = odd_minhash.near_duplicates(docs, width=5, percent=80)
    gone = found.where(~F.col("kept")).select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return simhash_decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; n_chars follows."""
    trees = secret_forest.train(secret_forest.labelled_findings(spark))
    out = secret_forest.mask(docs, trees)
    if "n_chars" in out.columns:
        kind = dict(out.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their count and the checksums of ids and decoded text."""
    return trie_bpe.encode(docs, BPE_VOCABULARY, with_ids=True)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("encoding", encoding)]
#: No SQL can express the trained models and sketches; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
