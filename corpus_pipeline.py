"""From raw documents to encoded training documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept:
1. quality rules: documents that fail them go, and so do lines above the limit of their host;
2. near duplicates: one document of each group stays, the one of smallest id;
3. decontamination: documents that hold benchmark passages go;
4. personal data: every span found is replaced by its kind;
5. pieces: adds ``ids``, the piece ids of the text.
All stages but the last return the columns of documents. Empty and repeated rows, nulls and further columns are treated
as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, line_rules, near_dup, pii_crf, piece_viterbi
from starloom.llm.queries import importable
from starloom.session import materialize, work_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return line_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return near_dup.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return pii_crf.redact(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return piece_viterbi.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

#: A random field and a Viterbi search are beyond SQL; tests hold the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), work_folder(spark))
    return docs
