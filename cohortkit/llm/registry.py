"""The queries of the training-data operators, one per operator, over whole
tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, fingerprint, hardneg, jaccard, mixing, neighbours, pitmanyor, secrets, spelling, toxicity, urlrules, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_bpe_tree_concatenation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op1(table(spark, sf_dir, "documents"), vocabulary())


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op2(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op7(table(spark, sf_dir, "documents"))


@query
def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op4(table(spark, sf_dir, "pages"))


ORACLE_SQL["op4_warc_transactions"] = warc.ORACLE


@query
def op10_url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.op10(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op5_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op5(table(spark, sf_dir, "documents"))


@query
def op6_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op6(table(spark, sf_dir, "documents"))


@query
def op8_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op8(table(spark, sf_dir, "documents"))


@query
def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.op9(table(spark, sf_dir, "documents"))


@query
def op3_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.op3(table(spark, sf_dir, "embeddings"))


@query
def op13_training_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op13(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op13_training_suffix_arrays"] = decontaminate.ORACLE


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op12(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_spelling_variants"] = spelling.ORACLE


@query
def op11_hyperplane_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.op11(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op11_hyperplane_hard_negatives"] = hardneg.ORACLE
