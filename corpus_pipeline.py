"""The training-data pipeline: documents through the stages of STAGES, each
written as Parquet and read back as the next one's input.

1. toxicity      documents scored 0.5 or more go
2. near_duplicates one document of each group of linked texts stays (the smallest id)
3. secrets       secrets in the text are replaced by '[SECRET]'; n_chars follows
4. mixing        documents repeat or go as the mix takes their words (0 to 3 times)
5. bpe           token ids (little-endian unsigned 32-bit), count and digests of each whole text

Nulls: a null text is kept as an empty one would be (clean, linked with nothing,
without secrets, never taken by the mix). An empty table passes as an empty
table. ORACLE_SQL is None: SQL can express neither the trained model nor the
byte-pair encoding; tests/llm holds the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import bpe, jaccard, mixing, secrets, toxicity
from cohortkit.llm.common import fresh_path, table, written
from cohortkit.llm.registry import vocabulary

ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scores every row; the model learns from the labelled rows of the stage's own input."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.filtered(docs, model)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.kept(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = vocabulary()
    ids = bpe.encode_packed(docs.select("doc_id", "lang", "source", "text"), path, out="ids").drop("text")
    # written, so that a task runs one Python operator, and an executor half the workers
    rows = bpe.decode_packed(written(ids, "pipeline-ids"), path, out="decoded")
    return rows.select("doc_id", "lang", "source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity_stage), ("near_duplicates", near_duplicates_stage), ("secrets", secrets_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
